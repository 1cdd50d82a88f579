"""Filter interaction audit: what each filter removes in every order, from Walsh-Hadamard sums of the documents' failure masks."""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: A: few words, B: few distinct words, C: many capitals, D: odd symbols, E: a copy. Filter k has bit 2 ** k of a mask.
FILTERS = "ABCDE"
CELLS = 1 << len(FILTERS)
ORDERS = ["".join(p) for p in permutations(FILTERS)]
LABELS = ("all", "good", "toxic")


def text_failures(text: Column) -> Column:
    """The mask of the filters A to D that a text fails; null counts as empty. All of them are functions of the text alone.

    A: under 50 words, B: 100 x distinct words < 65 x words, C: 100 x capitals of ASCII > 5 x code points, D: any of #$%&*|.
    Words are what the blanks of ASCII part, and are told apart by case.
    """
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")  # an edge that is blank gives an empty word
    return F.aggregate(
        F.array(F.struct(F.size(words).cast("long").alias("n"), F.size(F.array_distinct(words)).cast("long").alias("kinds"))),
        F.lit(0),
        lambda _, w: F.when(w.n < 50, 1).otherwise(0) + F.when(100 * w.kinds < 65 * w.n, 2).otherwise(0),
    ) + (
        F.when(100 * (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long") > 5 * F.length(text).cast("long"), 4).otherwise(0)
        + F.when(text.rlike("[#$%&*|]"), 8).otherwise(0)
    )


def failure_masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(part, mask, good, toxic) of every row: the filters it fails and whether a label says quality 1 or toxic 1 (of several labels, any).

    Texts are read once, for their masks and digests; what is shuffled after that is narrow. A digest's smallest id is
    gathered with partial sums and joined back only where there are copies, as plain rows on both sides, so that Spark can split a text
    that a third of all rows have. A null part is the empty string. A row with a null id has no label, is no copy and makes none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(text).alias("mask"))
    narrow = written(narrow)
    copies = narrow.groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last").drop("last")
    found = narrow.join(copies, "digest", "left").select("id", "part", (F.col("mask") + F.when(F.col("id") > F.col("first"), 16).otherwise(0)).alias("mask"))
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    return found.join(known, "id", "left").select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def parity_sums(masks: DataFrame) -> DataFrame:
    """A row for each part: for every label an array of 32 sums over its rows, the s-th of +1 or -1 by the parity of mask AND s.

    The sums are added up in every task before the shuffle, so a part of any size is a row of 96 numbers from each.
    """
    weight = {"all": F.lit(1), "good": F.col("good"), "toxic": F.col("toxic")}
    sign = [F.lit(1) - 2 * (F.bit_count(F.col("mask").bitwiseAND(F.lit(s))) % 2) for s in range(CELLS)]
    sums = masks.groupBy("part").agg(*[F.sum((sign[s] * weight[x]).cast("long")).alias(f"{x}_{s}") for x in LABELS for s in range(CELLS)])
    return sums.select("part", *[F.array(*[F.col(f"{x}_{s}") for s in range(CELLS)]).alias(x) for x in LABELS])


def invert(sums: DataFrame) -> DataFrame:
    """The arrays of sums as the counts of rows with each mask, exactly: five turns of sums and differences, and a division by 32."""
    for k in range(len(FILTERS)):
        step = 1 << k

        def turn(name: str, step: int = step) -> Column:
            at = F.col(name)
            return F.transform(at, lambda x, i: F.when(i.bitwiseAND(F.lit(step)) == 0, x + F.get(at, i + step)).otherwise(F.get(at, i - step) - x))

        sums = sums.withColumns({x: turn(x) for x in LABELS})
    return sums.withColumns({x: F.transform(x, lambda v: F.shiftright(v, len(FILTERS))) for x in LABELS})


def evaluate(cells: DataFrame) -> DataFrame:
    """Every order's five steps over each part's counts: (part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley).

    shapley: a document that fails k filters is removed by each of them in 120 / k orders.
    """

    def total(name: str, holds: Callable[[Column], Column], share: Callable[[Column], Column] | None = None) -> Column:
        value = lambda m: F.get(F.col(name), m) * share(m) if share else F.get(F.col(name), m)
        return F.aggregate(F.sequence(F.lit(0), F.lit(CELLS - 1)), F.lit(0).cast("long"), lambda a, m: a + F.when(holds(m), value(m)).otherwise(F.lit(0).cast("long")))

    bits = lambda letters: sum((F.when(F.contains(letters, F.lit(f)), 1 << k).otherwise(0) for k, f in enumerate(FILTERS)), F.lit(0))
    steps = cells.select("*", F.explode(F.split(F.lit(",".join(ORDERS)), ",")).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    steps = steps.withColumns({"own": bits(F.substr("filter_order", "step", F.lit(1))), "before": bits(F.substr("filter_order", F.lit(1), F.col("step") - 1))})
    own, before = F.col("own"), F.col("before")
    fails, earlier = (lambda m: m.bitwiseAND(own) != 0), (lambda m: m.bitwiseAND(before) != 0)
    removed = lambda m: fails(m) & ~earlier(m)
    orders = F.array(*[F.lit(len(ORDERS) // n if n else 0) for n in range(len(FILTERS) + 1)])
    return steps.select(
        "part", "filter_order", "step",
        total("all", lambda m: ~fails(m) & ~earlier(m)).alias("kept"),
        total("all", removed).alias("removed"),
        total("all", lambda m: fails(m) & earlier(m)).alias("redundant"),
        total("all", lambda m: m == own).alias("unique_fails"),
        total("good", removed).alias("good_lost"),
        total("toxic", removed).alias("toxic_lost"),
        total("all", fails, lambda m: F.get(orders, F.bit_count(m))).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What the five filters keep, remove and find removed already, by part, order and step: 600 rows for each part, zeros included.

    Null and empty texts fail A alone (and E, where they repeat). Rows with the same id count each, and are no copies of each other.
    An empty table gives no rows. Other columns of docs take no part.
    """
    return evaluate(invert(parity_sums(failure_masks(docs, labels, id_col, text_col, part_col))))


#: The same rows in DuckDB, from counts of masks rather than their sums.
SQL = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
  CASE WHEN len(words) < 50 THEN 1 ELSE 0 END AS a, CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 1 ELSE 0 END AS b,
  CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 1 ELSE 0 END AS c,
  CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 1 ELSE 0 END AS d, CASE WHEN w.doc_id > first_id THEN 1 ELSE 0 END AS e
  FROM w LEFT JOIN l ON w.doc_id = l.doc_id),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
o AS (SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM f a, f b, f c, f d, f e
  WHERE a.f NOT IN (b.f, c.f, d.f, e.f) AND b.f NOT IN (c.f, d.f, e.f) AND c.f NOT IN (d.f, e.f) AND d.f <> e.f),
s AS (SELECT filter_order, unnest(range(1, 6))::int AS step FROM o),
p AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before FROM s),
h AS (SELECT part, CASE WHEN a = 1 THEN 'A' ELSE '' END || CASE WHEN b = 1 THEN 'B' ELSE '' END || CASE WHEN c = 1 THEN 'C' ELSE '' END || CASE WHEN d = 1 THEN 'D' ELSE '' END || CASE WHEN e = 1 THEN 'E' ELSE '' END AS fails,
  count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
x AS (SELECT *, contains(fails, own) AS hit, fails <> translate(fails, before, '') AS earlier FROM h, p)
SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT hit AND NOT earlier), 0)::bigint AS kept, coalesce(sum(n) FILTER (hit AND NOT earlier), 0)::bigint AS removed,
  coalesce(sum(n) FILTER (hit AND earlier), 0)::bigint AS redundant, coalesce(sum(n) FILTER (fails = own), 0)::bigint AS unique_fails,
  coalesce(sum(good) FILTER (hit AND NOT earlier), 0)::bigint AS good_lost, coalesce(sum(toxic) FILTER (hit AND NOT earlier), 0)::bigint AS toxic_lost,
  coalesce(sum(n * (120 // greatest(length(fails), 1))) FILTER (hit), 0)::bigint AS shapley
FROM x GROUP BY part, filter_order, step
"""
