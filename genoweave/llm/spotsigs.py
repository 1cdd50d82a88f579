"""Document fingerprints by SpotSigs: chains of content words behind common-word anchors, compared by Jaccard.

All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, written

#: Residues that signatures and sets are counted by, a byte of the plan each.
BUCKETS = 1 << 16
#: Up to so many rows of two numbers are broadcast; for more, both sides are shuffled.
BROADCAST_ROWS = 200_000

#: Common words of four languages, the anchors; fixed values.
ANCHORS = tuple(
    dict.fromkeys(
        """
        the a an is are was were be been to of in it that this for on with as at by from and or
        der die das den dem ein eine ist war und zu von mit auf für im nicht sich des
        le la les un une de du est était et en que qui dans pour pas sur au
        el los las una es era y del por para con se su lo al como
        """.split()
    )
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value worked out once."""
    return F.transform(F.array(value), body)[0]


def spot_signatures(text: str | Column, anchors: tuple[str, ...] = ANCHORS, chain: int = 3) -> Column:
    """The set of a text's signatures, ascending 64-bit hashes: array<bigint>.

    A signature is an anchor and the next `chain` words that aren't anchors, or those there are near the end. Words are runs
    of letters and digits, in lower case. Without any anchor that content words follow, every word is taken for one, so short
    texts have signatures too. Texts without words, null ones included, have none.
    """
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def of(w: Column) -> Column:
        numbered = F.transform(w, lambda x, i: F.struct(x.alias("x"), i.alias("i")))
        spots = F.filter(numbered, lambda s: s.x.isin(*anchors))
        content = F.filter(w, lambda x: ~x.isin(*anchors))

        def chains(c: Column) -> Column:
            # the k-th anchor, at place i, has i - k content words before it
            hashed = F.transform(spots, lambda s, k: F.when(s.i - k < F.size(c), F.xxhash64(s.x, F.array_join(F.slice(c, s.i - k + 1, chain), " "))))
            return F.array_distinct(F.filter(hashed, lambda h: h.isNotNull()))

        every = F.array_distinct(F.transform(w, lambda x, i: F.xxhash64(F.array_join(F.slice(w, i + 1, chain + 1), " "))))
        return let(let(content, chains), lambda found: F.when(F.size(found) > 0, found).otherwise(every))

    return F.array_sort(let(words, of))


def fingerprint(signatures: str | Column) -> Column:
    """A set of signatures as a string: 16 hex digits each, with blanks between."""
    return F.array_join(F.transform(signatures, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), " ")


def likeness(a: str, b: str, least: float = 0.0) -> Column:
    """The Jaccard likeness of two sets of signatures; 1 if both are empty. Where their sizes alone keep it under `least`, it is 0 without a look."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return F.when(large == 0, 1.0).when(small < least * large, 0.0).otherwise(common / (F.size(a) + F.size(b) - common))


def at_or_below(keys: list[int], value: Column) -> Column:
    """How many of the ascending keys are at or below a value. Found in two steps, so the cost is the square root of their number."""
    if not keys:
        return F.lit(0)
    w = math.isqrt(len(keys)) + 1
    groups = [keys[i : i + w] for i in range(0, len(keys), w)]
    tops, whole = F.array(*[F.lit(g[0]) for g in groups]), F.array(*[F.array(*map(F.lit, g)) for g in groups])

    def count(of: Column) -> Column:
        return F.size(F.filter(of, lambda k: k <= value))

    return let(F.greatest(count(tops), F.lit(1)), lambda g: (g - 1) * w + count(F.element_at(whole, g)))


def id_bucket(ids: DataFrame, rows: int, most_buckets: int, coarse: int) -> Column:
    """A bucket number, ascending with "id", for the longs of ids: about `rows` ids each, or more where there would be over most_buckets.

    Approximate quantiles cut the ids coarsely; each piece is cut into buckets of equal width, as many as its count asks for. The plan and
    the driver have at most `coarse` figures of a kind.
    """
    n = ids.count()
    share = max(rows, n / most_buckets)
    pieces = min(coarse, math.ceil(n / share))
    points = ids.agg(F.percentile_approx("id", [k / pieces for k in range(1, pieces)] or [0.5], 20 * coarse)).first()[0] or []
    cuts = sorted(set(points)) if pieces > 1 else []
    piece = at_or_below(cuts, F.col("id"))
    found = {r.p: r for r in ids.where("id IS NOT NULL").groupBy(piece.alias("p")).agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).collect()}
    of, base = [], 0
    for p in range(len(cuts) + 1):
        k = max(1, math.ceil(found[p].n / share)) if p in found else 1
        lo, width = (float(found[p].lo), (float(found[p].hi) - float(found[p].lo)) / k or 1.0) if p in found else (0.0, 1.0)
        of.append((base, k - 1, lo, width))
        base += k
    bases, lasts, los, widths = (F.array(*map(F.lit, x)) for x in zip(*of))
    inside = let(piece, lambda p: bases[p] + F.least(lasts[p], F.greatest(F.lit(0), F.floor((F.col("id").cast("double") - los[p]) / widths[p]))).cast("int"))
    return F.coalesce(inside, F.lit(0))


def with_next(docs: DataFrame, id_col: str, text_col: str, rows: int = 1_000, most_buckets: int = 100_000, coarse: int = 500, beside: DataFrame | None = None) -> DataFrame:
    """id_col, text_col, g_bucket, g_hash and next_text for every row, and g_more, given beside: the text of the row after it by ascending id; of the first, after the last.

    Ids are dealt into buckets of neighbours (see id_bucket), so no task sees them all, and texts are shuffled once. A bucket's
    last row takes the first text of the next bucket; those first rows, one a bucket, are found on ids alone. Null ids come first; equal ids go by
    a hash of the text. g_more is that of the row of beside (id_col, g_hash, g_more) with the same id and hash, at most one: it comes with
    the texts' shuffle, right before its rows.
    """
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    bucket = id_bucket(ids, rows, most_buckets, coarse)
    keyed = docs.select(id_col, F.coalesce(text_col, F.lit("")).alias(text_col)).withColumns({"id": F.col(id_col).cast("long"), "g_hash": F.xxhash64(text_col)}).withColumn("g_bucket", bucket).drop("id")

    place = F.struct(F.col("id").isNotNull(), "id")
    heads = cut(ids.groupBy(bucket.alias("g_bucket")).agg(F.min(place).alias("place")).select("g_bucket", F.col("place.id").alias("g_id")))
    around = Window.orderBy("g_bucket")  # a row of two numbers for each bucket, most_buckets at most
    after = heads.withColumn("g_of", F.coalesce(F.lag("g_bucket").over(around), F.max("g_bucket").over(around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    first = keyed.join(F.broadcast(after.select("g_id", "g_of", F.col("g_bucket").alias("g_own"))), F.col(id_col).cast("long").eqNullSafe(F.col("g_id")) & (F.col("g_bucket") == F.col("g_own")))
    heads = first.groupBy(F.col("g_of").alias("g_bucket")).agg(F.min_by(text_col, "g_hash").alias("g_head"))

    if beside is None:
        led = keyed.withColumn("g_lead", F.lead(text_col).over(Window.partitionBy("g_bucket").orderBy(F.asc_nulls_first(id_col), F.asc("g_hash"))))
    else:
        own = beside.withColumn("id", F.col(id_col).cast("long")).withColumn("g_bucket", bucket).drop("id")
        rows_and = keyed.withColumn("g_row", F.lit(1)).unionByName(own.withColumn("g_row", F.lit(0)), allowMissingColumns=True)
        order = Window.partitionBy("g_bucket").orderBy(F.asc_nulls_first(id_col), F.asc("g_hash"), F.asc("g_row"))
        more = F.last("g_more", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
        spec = f"PARTITION BY g_bucket ORDER BY `{id_col}` ASC NULLS FIRST, g_hash ASC, g_row ASC"
        led = rows_and.withColumns({"g_more": more, "g_lead": F.expr(f"lead(`{text_col}`) IGNORE NULLS OVER ({spec})")}).where("g_row = 1").drop("g_row")
    return led.join(heads, "g_bucket", "left").withColumn("next_text", F.coalesce("g_lead", "g_head")).drop("g_lead", "g_head")


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chain: int = 3, threshold: float | None = None) -> DataFrame:
    """Per row: id_col, n_chars, edited_text, signatures, edited_signatures, near_edited and near_next; given a threshold, class_id and n_links too (see class_links).

    The edited text has the last half of the characters replaced by as many of the next row's first; see with_next. near_edited
    and near_next are the likeness of the row's signatures to those of the edited and of the next text. A null text counts as
    empty; equal texts have equal signatures. Other columns are not returned. An empty table gives no rows.
    """
    beside = None if threshold is None else written(class_links(docs, threshold, id_col, text_col, chain))
    rows = with_next(docs, id_col, text_col, beside=beside).withColumn("n_chars", F.char_length(text_col).cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited_text", F.concat(F.substring(F.col(text_col), F.lit(1), F.col("n_chars").cast("int") - half), F.substring(F.col("next_text"), F.lit(1), half)))
    rows = rows.withColumn("signatures", spot_signatures(text_col, chain=chain)).withColumn("edited_signatures", spot_signatures("edited_text", chain=chain))
    order = Window.partitionBy("g_bucket").orderBy(F.asc_nulls_first(id_col), F.asc("g_hash"))
    # the next row's signatures are there already, but for the last row of a bucket
    rows = rows.withColumn("g_lead", F.lead("signatures").over(order))
    rows = rows.withColumn("g_next", F.when(F.col("g_lead").isNotNull(), F.col("g_lead")).otherwise(spot_signatures("next_text", chain=chain)))
    linked = () if threshold is None else (F.col("g_more.class_id").alias("class_id"), F.col("g_more.n_links").alias("n_links"))
    return rows.select(id_col, "n_chars", "edited_text", "signatures", "edited_signatures", likeness("signatures", "edited_signatures").alias("near_edited"), likeness("signatures", "g_next").alias("near_next"), *linked)


def in_bytes(rows: DataFrame, value: Column, of: Callable[[Column], Column]) -> bytes:
    """For each of BUCKETS residues of a long: a byte, 64 and of(the number of rows with it), below 192. So many bytes at any input size."""
    counted = rows.groupBy(F.pmod(value, F.lit(BUCKETS)).cast("int").alias("b")).agg(F.count("*").alias("n"))
    every = rows.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(counted, "b", "left")
    letters = every.select("b", F.char(64 + of(F.coalesce("n", F.lit(0)))).alias("c"))
    parts = letters.groupBy(F.floor(F.col("b") / 1024).alias("part")).agg(F.array_sort(F.collect_list(F.struct("b", "c"))).alias("x"))
    joined = parts.select("part", F.array_join(F.transform("x", lambda x: x.c), "").alias("x"))
    return "".join(r.x for r in joined.orderBy("part").collect()).encode()


def byte_of(table: bytes, value: Column) -> Column:
    """What in_bytes noted for a long's residue."""
    at = F.substring(F.lit(bytearray(table)), (F.pmod(value, F.lit(BUCKETS)) + 1).cast("int"), F.lit(1))
    return F.ascii(at.cast("string")) - 64


def signature_sets(docs: DataFrame, id_col: str, text_col: str, chain: int) -> DataFrame:
    """(g_id, g_hash, g_key, n, sigs) for every row: hashes of the text and of its set, the set and its size."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sets = docs.select(F.col(id_col).alias("g_id"), F.xxhash64(text).alias("g_hash"), spot_signatures(text_col, chain=chain).alias("sigs"))
    return sets.select("g_id", "g_hash", F.xxhash64("sigs").alias("g_key"), F.size("sigs").alias("n"), "sigs")


def candidates(classes: DataFrame, levels: bytes, threshold: float, most: int) -> DataFrame:
    """(ka, kb), each once: pairs of classes (g_key, n, prefix) that may be of at least threshold, the smaller set first.

    Sets are partitioned by length: a partition's lengths are within the threshold, so a set's larger partners are in its own and in
    the next one. The smaller and the larger set of a pair share a signature early in both prefixes, early enough for those after it
    to reach the overlap; others are pruned. A signature that over `most` classes list is cut into pieces of about so many, and each piece
    of smaller sets meets each of larger ones under a key of its own.
    """
    listed = classes.select("g_key", "n", F.posexplode("prefix").alias("i", "sig"))
    counted = listed.where(byte_of(levels, F.col("sig")) >= int(math.log2(most))).groupBy("sig").agg(F.count("*").alias("often"))
    hot = cut(counted.where(F.col("often") > most).select("sig", F.ceil(F.col("often") / most).cast("int").alias("pieces")))
    n_hot = hot.count()
    if n_hot:
        listed = listed.join(F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot, "sig", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    else:
        listed = listed.withColumn("pieces", F.lit(1))
    own = F.pmod(F.xxhash64("g_key", F.lit(1)), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other")
    part = F.floor(F.log("n") / F.lit(-math.log(threshold)) + 1e-9).cast("int")
    early = F.col("i") <= F.col("n") - F.ceil(F.col("n") * (2 * threshold / (1 + threshold)) - 1e-9)
    small = listed.where(early).select("*", own.alias("own"), other).select("*", F.explode(F.array(part, part + 1)).alias("part"))
    small = small.select(F.col("g_key").alias("ka"), F.col("n").alias("na"), F.col("i").alias("ia"), F.xxhash64("sig", "part", "own", "other").alias("h"))
    large = listed.select("*", own.alias("own"), other, part.alias("part"))
    large = large.select(F.col("g_key").alias("kb"), F.col("n").alias("nb"), F.col("i").alias("ib"), F.xxhash64("sig", "part", "other", "own").alias("h"))
    ordered = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ka") < F.col("kb")))
    overlap = F.ceil((F.col("na") + F.col("nb")) * (threshold / (1 + threshold)) - 1e-9)
    reach = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= overlap
    return small.join(large, "h").where(ordered & (F.col("na") >= F.col("nb") * threshold - 1e-9) & reach).select("ka", "kb").distinct()


def linked_classes(docs: DataFrame, threshold: float, id_col: str, text_col: str, chain: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(members, links): (g_id, g_hash, g_key) of every row, and (ka, kb, likeness), each pair of different sets of at least threshold once.

    The order of a set's signatures is one of levels, powers of two of how often their residues occur, rare ones first; any order
    that all sets share gives the same links. Sets are compared whole; those that are in no candidate are left out by their residue before the shuffle.
    """
    sets = signature_sets(docs, id_col, text_col, chain)
    levels = in_bytes(sets.select(F.explode("sigs").alias("sig")), F.col("sig"), lambda n: F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int"))
    ranked = F.array_sort(F.transform("sigs", lambda s: F.struct(byte_of(levels, s).alias("level"), s.alias("sig"))))
    prefix = F.transform(F.slice(ranked, F.lit(1), (F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1).cast("int")), lambda x: x.sig)
    rows = written(sets.select("g_id", "g_hash", "g_key", "n", F.when(F.col("n") > 0, prefix).alias("prefix")))
    classes = rows.where("n > 0").groupBy("g_key").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    pairs = written(candidates(classes, levels, threshold, most))
    wanted = in_bytes(pairs.select(F.explode(F.array("ka", "kb")).alias("k")), F.col("k"), lambda n: (n > 0).cast("int"))
    found = sets.where(byte_of(wanted, F.col("g_key")) > 0).groupBy("g_key").agg(F.first("sigs").alias("sigs"))
    both = pairs.join(found.toDF("ka", "sa"), "ka").join(found.toDF("kb", "sb"), "kb").select("ka", "kb", likeness("sa", "sb", threshold).alias("likeness"))
    return rows.select("g_id", "g_hash", "g_key"), written(both.where(F.col("likeness") >= threshold))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", chain: int = 3, most: int = 2_000) -> tuple[DataFrame, DataFrame]:
    """(members, pairs): each row's id_col and class_id, and (a, b, likeness) for classes a < b of at least threshold.

    A class is all rows with the same signatures, named by the smallest id; copies give no pairs. No pair is lost; see candidates. Rows with
    a null id belong to a class but never name it, and a class without a name has no pairs; texts without words, null ones included, form one
    class without pairs. An empty table gives none of either.

    pairs has each pair of different sets that are alike, so its rows grow with the square of a group of different near copies.
    """
    members, links = linked_classes(docs, threshold, id_col, text_col, chain, most)
    names = members.groupBy("g_key").agg(F.min("g_id").alias("class_id"))
    named = names.where("class_id IS NOT NULL")
    ends = links.join(named.toDF("ka", "a"), "ka").join(named.toDF("kb", "b"), "kb")
    pairs = ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "likeness")
    return members.join(names, "g_key").select(F.col("g_id").alias(id_col), "class_id"), pairs


def class_links(docs: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", chain: int = 3, most: int = 2_000) -> DataFrame:
    """(id_col, g_hash, g_more), a row for each id and hash of a text: class_id as in near_duplicates, and n_links, the number of other classes of at least threshold."""
    members, links = linked_classes(docs, threshold, id_col, text_col, chain, most)
    names = members.groupBy("g_key").agg(F.min("g_id").alias("class_id"))
    counts = links.select(F.explode(F.array("ka", "kb")).alias("g_key")).groupBy("g_key").agg(F.count("*").alias("n_links"))
    each = names.join(counts, "g_key", "left").select("g_key", F.struct("class_id", F.coalesce("n_links", F.lit(0)).alias("n_links")).alias("g_more"))
    return members.distinct().join(each, "g_key").select(F.col("g_id").alias(id_col), "g_hash", "g_more")
