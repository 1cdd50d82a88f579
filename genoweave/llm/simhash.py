"""Near-duplicates by SimHash: covering locality-sensitive hashing finds every pair within the radius."""

from __future__ import annotations

import math
import random
from dataclasses import dataclass
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, utf8, written

BITS = 64
#: Up to so many rows of a number or two are broadcast to pick those that join them; for more, both sides are shuffled.
BROADCAST_ROWS = 200_000


def shingle_hashes(raw: bytes, shingle: int):
    """The XXH64 hashes (seed 42) of a text's word shingles, in order and with repeats, as rows of 8 bytes, the highest first.

    A-Z are lower-cased, words end at the blanks of ASCII; fewer words than a shingle has are one shingle, no words none.
    """
    import numpy as np
    from xxhash import xxh64_digest

    words = raw.lower().split()  # of bytes: ASCII only, both
    if len(words) <= shingle:
        rows = [b" ".join(words)] if words else []
    else:
        rows = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    return np.frombuffer(b"".join(map(xxh64_digest, rows, repeat(42))), dtype=np.uint8).reshape(-1, 8)


def majority(hashes) -> bytes:
    """The fingerprint of rows of 8 bytes: each bit that is set in over half of them; zero if there are none."""
    import numpy as np

    n = len(hashes)
    if n == 1:
        return hashes.tobytes()
    if n < 256:
        counts = np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
    else:
        of_byte = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)
        counts = np.concatenate([np.bincount(hashes[:, k], minlength=256) @ of_byte for k in range(8)])
    return np.packbits(2 * counts > n).tobytes()


def simhash(raw: bytes, shingle: int = 3) -> bytes:
    """The fingerprint of a text in UTF-8, of all its shingles: 8 bytes, the highest bit first; zero without words."""
    return majority(shingle_hashes(raw, shingle))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """id_col and fp, the text's 64-bit fingerprint as a signed long, for every row; a null text counts as empty."""

    def run(batches):
        import numpy as np

        for b in batches:
            raw = b"".join([simhash(t, shingle) for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.frombuffer(raw, dtype=">i8").astype(np.int64))], ["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).mapInArrow(run, f"id {kind}, fp long").withColumnRenamed("id", id_col)


def covering_masks(radius: int, vectors: list[int]) -> list[int]:
    """Masks of BITS bits such that, of any `radius` bits or fewer, one mask has none.

    Bit i goes with vectors[i], a non-zero vector of radius + 1 bits. For each non-zero v, the mask has the bits whose
    vector has odd overlap with v. So few vectors never span the space, so some v is orthogonal to all of them.
    """
    masks = [sum(1 << i for i, x in enumerate(vectors) if (x & v).bit_count() % 2) for v in range(1, 2 << radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]  # signed, as Spark's longs


def masks_of(radius: int, level: int) -> list[int]:
    """level 0: masks of about half the bits; level 1: others, that cut what each of those leaves free in half again.

    The second deal is a shuffle by a seed for which two masks together never leave over 18 bits free.
    """
    span = (2 << radius) - 1
    if level == 0:
        return covering_masks(radius, [1 + (i + i // span * 4) % span for i in range(BITS)])
    vectors = [1 + i % span for i in range(BITS)]
    random.Random(7).shuffle(vectors)
    return covering_masks(radius, vectors)


def _bucket_links(radius: int, most: int):
    """For rows (bucket, fp) sorted by both: links (a, b) that join each bucket's fingerprints as far as they are linked.

    Fingerprints of a bucket with over `most` of them come back as (bucket, fp) with kind 1 instead, unless most is None.
    """
    import numpy as np

    def within(held):
        """Links of one bucket that span its components; no more than its fingerprints."""
        bits = np.array(held, dtype=np.int64).view(np.uint64)  # of signed numbers, bitwise_count takes the absolute value
        if len(held) == 2:
            return [tuple(held)] if np.bitwise_count(bits[0] ^ bits[1]) <= radius else []
        label, out = np.arange(len(held)), []
        for i in range(1, len(held)):
            near = np.flatnonzero(np.bitwise_count(bits[i] ^ bits[:i]) <= radius)
            if near.size:
                roots, first = np.unique(label[near], return_index=True)
                out += [(held[i], held[near[j]]) for j in first]
                label[i] = roots[0]
                if roots.size > 1:
                    label[:i][np.isin(label[:i], roots[1:])] = roots[0]
        return out

    def batch(kind, a, b):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), kind, np.int32)), pa.array(np.asarray(a, dtype=np.int64)), pa.array(np.asarray(b, dtype=np.int64))], ["kind", "a", "b"])

    def run(batches):
        held, last, passing = [], None, False  # the fingerprints of the bucket that the next batch may continue
        for rows in batches:
            keys, fps = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            links = []
            edges = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else []
            ends = np.append(edges[1:], len(keys)) if len(keys) else []
            for s, e in zip(edges, ends):
                if keys[s] != last:
                    if not passing and len(held) > 1:
                        links += within(held)
                    held, last, passing = [], keys[s], False
                if e - s == 1 and not held and not passing and e < len(keys):
                    continue  # alone in its bucket
                if passing:
                    yield batch(1, keys[s:e], fps[s:e])
                    continue
                held += fps[s:e].tolist()
                if most is not None and len(held) > most:
                    yield batch(1, np.full(len(held), last), held)
                    held, passing = [], True
            if links:
                yield batch(0, *zip(*links))
        if not passing and len(held) > 1 and (links := within(held)):
            yield batch(0, *zip(*links))

    return run


def links(distinct: DataFrame, radius: int = 3, bucket_rows: int = 2048) -> DataFrame:
    """Links (a, b) between the distinct fingerprints fp that connect all those within radius bits, by way of others or directly.

    Every pair within the radius meets in a bucket of some table (covering masks), and each bucket gives links that span
    its components, not all pairs. A bucket of over bucket_rows fingerprints is dealt again with a second set of masks on top of
    its own; no two masks leave over 18 bits free together, which bounds a bucket there whatever the input.
    """

    def dealt(df: DataFrame, level: int, *by: str) -> DataFrame:
        masks = masks_of(radius, level)
        tables = F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)]))
        keyed = df.select("fp", *by, tables.alias("x")).select(F.xxhash64(*by, "x.t", "x.key").alias("bucket"), "fp")
        return keyed.repartition("bucket").sortWithinPartitions("bucket", "fp")

    # buckets go by a hash of table and key: a collision only adds fingerprints to compare
    first = cut(dealt(distinct, 0).mapInArrow(_bucket_links(radius, bucket_rows), "kind int, a long, b long"))
    large = first.where("kind = 1").select(F.col("a").alias("outer"), F.col("b").alias("fp"))
    second = dealt(large, 1, "outer").mapInArrow(_bucket_links(radius, None), "kind int, a long, b long")
    return first.where("kind = 0").unionByName(second).select("a", "b").distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of edges (a, b): the smallest node that it is connected to.

    Large-star and small-star by turns, each a few joins and groupings, until nothing changes; each turn is a checkpoint.
    Self-loops are ignored; repeated edges and both directions are allowed.
    """
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first())

    now = state(edges)
    for _ in range(rounds):
        if not now[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written first: joined with plain rows, Spark can split the rows of a hot centre
        least = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = cut(large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
        least = cut(down.groupBy("u").agg(F.min("v").alias("m")))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        was, now = now, state(edges)
        if was == now:
            break
    else:
        raise RuntimeError(f"components didn't settle in {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, shingle: int = 3) -> DataFrame:
    """id_col, fp and component_id for every row: the smallest id reachable over fingerprints at most radius bits apart.

    Equal fingerprints are one node of the graph, so copies cost one row each and no pairs. Texts without words, null and empty
    ones included, have fingerprint zero and are linked like any other. Rows with a null id get their component's
    smallest id too, null if there is none; repeated rows are kept. Other columns are not returned. An empty table gives no rows.
    """
    prints = cut(fingerprints(docs, id_col, text_col, shingle))
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("least"))
    found = components(links(distinct.select("fp"), radius))
    rooted = cut(distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    smallest = cut(rooted.groupBy("root").agg(F.min("least").alias("component_id")))  # apart: one root may have most of the rows
    of_print = cut(rooted.join(smallest, "root").select("fp", "component_id"))
    return prints.join(of_print, "fp").select(id_col, "fp", "component_id")


@dataclass(frozen=True)
class Likeness:
    """What near-duplicates are, and how pairs of them are looked for.

    Bits of fingerprints at a Jaccard similarity of 0.8 differ with a chance of 0.15, so the radius alone, for which masks can cover all
    differences, finds few such pairs. Parts of the shingle set are compared besides: a hash deals shingles out to 2 ** k parts of two to four,
    and of the first `parts` of them a pair at 0.8 has each alike with a chance of 0.41 or more, so that
    none is with one of 3e-6. Texts of under `few` shingles have single ones instead. Large buckets, of over
    bucket_rows sets or bucket_hashes hashes, are dealt again by each other part that their sets have: pairs that meet only there need two
    parts alike, and none has with a chance of 5e-5. Those that are large even then are compared piece by piece. Sets are compared by the
    first 32 bits of their hashes, which puts a similarity wrong by under n / 2 ** 32 for n shingles.
    """

    shingle: int = 5
    similarity: float = 0.8
    radius: int = 3
    parts: int = 24
    few: int = 64
    bucket_rows: int = 2048
    bucket_hashes: int = 4_000_000


def part_keys(found, how: Likeness = Likeness()):
    """A number for each part of a set of hashes that is compared, equal for equal parts of sets of nearly the same size.

    Parts depend on the size by powers of two. A set near such a bound has the parts of both sides, so that of sets whose
    sizes allow for how.similarity there always are parts of a common power.
    """
    import numpy as np

    near = math.sqrt(how.similarity)
    mixed = np.sort((found ^ (found >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15))
    out = []
    for single, k in {(x < how.few, max(0, int(math.log2(x / (how.parts if x < how.few else 2))))) for x in (found.size * near, found.size / near) if x}:
        most = 1 if single else how.parts
        held = mixed[: np.searchsorted(mixed, np.uint64(most << (64 - k)))] if most < 1 << k else mixed
        if not held.size:
            continue
        hashes = (held ^ (held >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        if not single and k:
            part = held >> np.uint64(64 - k)
            hashes = np.add.reduceat(hashes, np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))))
        out.append((hashes ^ (hashes >> np.uint64(32)) ^ np.uint64(2 * k + single)) * np.uint64(0x94D049BB133111EB))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _sketch(how: Likeness):
    def run(batches):
        import numpy as np
        from xxhash import xxh64_digest

        for b in batches:
            names, prints, parts, sets = [], [], [], []
            for t in b.column(1).to_pylist():
                found = np.unique(shingle_hashes(t, how.shingle).view(">u8").astype(np.uint64))
                sets.append(np.unique((found >> np.uint64(32)).astype(np.uint32)).tobytes())
                names.append(xxh64_digest(found.tobytes(), 7))
                prints.append(majority(found.astype(">u8").view(np.uint8).reshape(-1, 8)))
                parts.append(part_keys(found, how).view(np.int64))
            at = pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())
            signed = [pa.array(np.frombuffer(b"".join(x), dtype=">i8").astype(np.int64)) for x in (names, prints)]
            sizes = pa.array([len(s) // 4 for s in sets], pa.int32())
            keys = pa.ListArray.from_arrays(at, pa.array(np.concatenate([np.zeros(0, np.int64), *parts])))
            yield pa.RecordBatch.from_arrays([b.column(0), *signed, sizes, keys, pa.array(sets, pa.binary())], ["id", "cls", "fp", "n", "parts", "hashes"])

    return run


def jaccard(a, b) -> float:
    """Of two ascending sets of numbers; 1 if both are empty."""
    import numpy as np

    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (a.size + b.size - both) if a.size + b.size else 1.0


def _verified(similarity: float):
    """Of rows (a, b, hashes of a, hashes of b), the pairs (a, b) that are alike enough."""

    def run(batches):
        import numpy as np

        for rows in batches:
            read = [[np.frombuffer(x, dtype=np.uint32) for x in rows.column(k).to_pylist()] for k in (2, 3)]
            yield rows.select(["a", "b"]).filter(pa.array([jaccard(x, y) >= similarity for x, y in zip(*read)], pa.bool_()))

    return run


def _bucket_sets(similarity: float):
    """For rows (bucket, cls, root, hashes) sorted by bucket: links (a, b) between sets of different roots, as many as join their components."""
    import numpy as np

    def within(held):
        """Sets that are alike have one of the rarest shingles of each in common, of so many that the others are too few; shingles are
        rare by their number in the bucket. So only sets that share one of those are compared, and a passage that all have costs nothing."""
        names, root = np.array([c for c, *_ in held], dtype=np.int64), np.array([r for _, r, _ in held], dtype=np.int64)
        sets = [np.frombuffer(s, dtype=np.uint32) for *_, s in held]
        sizes = np.array([s.size for s in sets])
        ends = np.cumsum(sizes)
        starts = ends - sizes
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, codes, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        rank = np.empty(len(often), np.int64)
        rank[np.argsort(often, kind="stable")] = np.arange(len(often))
        codes = rank[codes]
        often = np.sort(often)
        order = np.lexsort((codes, owner))  # a set's shingles, the rarest first
        codes = codes[order]
        place = np.arange(len(codes)) - np.repeat(starts, sizes)
        listed = (place < np.repeat(sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1, sizes)) & (often[codes] > 1)
        by = np.argsort(codes[listed], kind="stable")
        key, holder = codes[listed][by], owner[listed][by]  # the sets that have a shingle among their rarest
        roots, n = np.unique(root, return_counts=True)
        flag = np.zeros(len(often), dtype=bool)
        for i in np.flatnonzero(root != roots[n.argmax()]):  # pairs of the commonest root are linked already
            own = codes[starts[i] : ends[i]]
            rarest = own[listed[starts[i] : ends[i]]]
            low, high = np.searchsorted(key, rarest, "left"), np.searchsorted(key, rarest, "right")
            near = np.unique(np.concatenate([np.zeros(0, np.int64), *[holder[x:y] for x, y in zip(low, high)]]))
            near = near[(root[near] != root[i]) & (np.minimum(sizes[near], sizes[i]) >= similarity * np.maximum(sizes[near], sizes[i]))]
            flag[own] = True
            for j in near.tolist():
                both = np.count_nonzero(flag[codes[starts[j] : ends[j]]])
                if both >= similarity * (sizes[i] + sizes[j] - both) and root[j] != root[i]:
                    yield int(names[i]), int(names[j])
                    root[root == root[j]] = root[i]
            flag[own] = False

    def run(batches):
        held, last = [], None
        for rows in batches:
            links = []
            for bucket, *row in zip(*(c.to_pylist() for c in rows.columns)):
                if bucket != last:
                    links += within(held) if len(held) > 1 else []
                    held, last = [], bucket
                held.append(row)
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])
        links = list(within(held)) if len(held) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return run


def small(numbers: DataFrame) -> DataFrame:
    """A table on disk of a number or two a row, to be broadcast if its rows, which are counted, are few."""
    return F.broadcast(numbers) if numbers.count() <= BROADCAST_ROWS else numbers


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Likeness = Likeness()) -> DataFrame:
    """id and least for every row with an id: the smallest id that it is connected to by links of Jaccard similarity how.similarity or more.

    Texts with equal shingle sets are one node, so copies make no pairs. A node's buckets are those of its fingerprint under covering masks
    and its parts (see Likeness). Each node is first compared with the one set in its buckets that most others share
    parts with; then, in buckets that still hold several components, all sets of different components are, by whole sets.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    given = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), utf8(text_col).alias("t"))
    base = written(given.mapInArrow(_sketch(how), f"id {kind}, cls long, fp long, n int, parts array<long>, hashes binary"))
    nodes = written(base.groupBy("cls").agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("parts").alias("parts")))

    covers = F.array(*[F.xxhash64(F.lit(t), F.col("fp").bitwiseAND(F.lit(m))) for t, m in enumerate(masks_of(how.radius, 0))])
    keyed = nodes.select("cls", "n", F.explode(F.array_distinct(F.concat("parts", covers))).alias("bucket"))
    shared = cut(keyed.groupBy("bucket").agg(F.count("*").alias("held")).where("held > 1"))
    near = written(keyed.join(shared, "bucket"))
    weights = cut(near.groupBy("cls").agg(F.sum("held").alias("weight")))
    centres = cut(near.join(weights, "cls").groupBy("bucket").agg(F.max(F.struct("weight", "cls", "n")).alias("c")))
    fits = F.least("n", "c.n") >= how.similarity * F.greatest("n", "c.n")
    pairs = near.join(centres, "bucket").where((F.col("cls") != F.col("c.cls")) & fits).groupBy("cls").agg(F.max("c").alias("c")).select(F.col("cls").alias("a"), F.col("c.cls").alias("b"))

    sets = written(base.join(small(weights), "cls", "left_semi").groupBy("cls").agg(F.first("hashes").alias("hashes")))
    sided = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
    first = cut(sided.mapInArrow(_verified(how.similarity), "a long, b long"))
    linked = components(first).withColumnRenamed("node", "cls")

    rooted = written(near.join(linked, "cls", "left").select("bucket", "cls", "n", F.coalesce("root", "cls").alias("root")))

    def still_open(of: DataFrame) -> DataFrame:
        """Buckets of several components, and how many pieces of a bounded size they make; of those that hold the same sets, one."""
        found = of.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("rows"), F.sum("n").alias("all"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("held"))
        one = found.where("x <> y").groupBy("rows", "all", "held").agg(F.min("bucket").alias("bucket"))
        return cut(one.select("bucket", F.greatest(F.ceil(F.col("rows") / how.bucket_rows), F.ceil(F.col("all") / how.bucket_hashes)).cast("int").alias("pieces")))

    left = rooted.join(still_open(rooted), "bucket")
    again = left.where("pieces > 1").join(nodes.select("cls", "parts"), "cls").select("bucket", "cls", "n", "root", F.explode("parts").alias("part")).where("part <> bucket")
    again = written(again.select(F.xxhash64("bucket", "part").alias("bucket"), "cls", "n", "root"))
    # what is large even so is cut into pieces, and each two of them are compared: no task holds more than two
    cuts = again.join(still_open(again), "bucket").withColumn("own", F.pmod(F.xxhash64("cls"), "pieces").cast("int"))
    cuts = cuts.select("*", F.explode(F.expr("sequence(0, pieces - 1)")).alias("other"))
    cuts = cuts.select(F.when(F.col("pieces") > 1, F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))).otherwise(F.col("bucket")).alias("bucket"), "cls", "root")
    both = left.where("pieces = 1").select("bucket", "cls", "root").unionByName(cuts)
    dealt = both.join(sets, "cls").select("bucket", "cls", "root", "hashes").repartition("bucket").sortWithinPartitions("bucket", "cls")
    second = dealt.mapInArrow(_bucket_sets(how.similarity), "a long, b long")

    found = components(first.unionByName(second)).withColumnRenamed("node", "cls")
    ids = cut(nodes.select("cls", "least").join(found, "cls", "left").withColumn("root", F.coalesce("root", "cls")))
    smallest = cut(ids.groupBy("root").agg(F.min("least").alias("smallest")))
    of_class = cut(ids.join(smallest, "root").select("cls", "smallest"))
    return base.select("id", "cls").join(of_class, "cls").select("id", F.col("smallest").alias("least"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", how: Likeness = Likeness()) -> DataFrame:
    """The rows of docs whose id is the smallest that it is connected to by near-duplicates; see similar_classes.

    Rows with a null id are kept and take no part. Texts without words, null and empty ones included, are copies of each
    other; repeated rows stay or go together. An empty table gives no rows.
    """
    found = similar_classes(docs, id_col, text_col, how)
    gone = cut(found.where(F.col("id") > F.col("least")).select(F.col("id").alias(id_col)).distinct())
    return docs.join(small(gone), id_col, "left_anti")


def fingerprint_hex(fp: str | Column) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
