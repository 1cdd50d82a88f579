"""Operators that route, deduplicate, shape and number rows.

Wherever the first row counts, its order is a column: partitions have none.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean_null, non_empty
from ..shared import scratch, written

RESOLVED, UNRESOLVED = "resolved", "unresolved"


def route(df: DataFrame, rejects: Sequence[tuple[Column, Column | str]]) -> DataFrame:
    """df with status and reason: the reason of the first condition that holds, and `unresolved`; else null and `resolved`.

    One pass gives every row one place, so what goes in comes out over the routes; see taken.
    """
    reason = F.coalesce(*[F.when(F.coalesce(c, F.lit(False)), F.lit(r) if isinstance(r, str) else r) for c, r in rejects])
    out = df.withColumn("reason", reason)
    return out.withColumn("status", F.when(F.col("reason").isNull(), RESOLVED).otherwise(UNRESOLVED))


def taken(routed: DataFrame, status: str = RESOLVED) -> DataFrame:
    """The rows of one route; the resolved ones without the routing columns."""
    rows = routed.where(F.col("status") == status).drop("status")
    return rows.drop("reason") if status == RESOLVED else rows


def routes(routed: DataFrame, column: str = "status") -> dict[str, DataFrame]:
    """The rows of every route, each to be read by itself: routed is worked out once and written to the shared folder, parted by the column,
    without which the routes come. A route without rows has the same columns. The routes are what status may be.
    """
    place = scratch(routed.sparkSession)
    routed.write.partitionBy(column).parquet(place)
    kept = routed.drop(column).schema
    found = routed.sparkSession.read.schema(T.StructType([*kept, T.StructField(column, T.StringType())])).parquet(place)
    return {r: found.where(F.col(column) == r).drop(column) for r in (RESOLVED, UNRESOLVED)}


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of each key (null is one) the row that comes first by order.

    Spark plans this limit on a rank with a partial limit before the shuffle, so a hot key sends one row from each task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("g_n", F.row_number().over(w)).where("g_n = 1").drop("g_n")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return keep_first(df, keys, [F.desc(c) for c in order])


def prefer_filled(df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str]) -> DataFrame:
    """Of each key the first row whose value isn't null, else the first row."""
    return keep_first(df, keys, [F.desc(F.col(value).isNotNull()), *order])


def rank_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str | Column], name: str = "number") -> DataFrame:
    """df with name: the place of each row, from 0, among the rows with the same `by` (null is a value), or among all rows where by is empty.

    The places are row_number's, but no key needs to fit a task. Sampled splitters of by and order, of any type, deal the rows out to
    ranges, which are written once; places are counted within a range, and a key that reaches into several ranges gets the sums of
    those before. A range has at most one key that began before it, so these sums are no more rows than there are ranges, and are broadcast.
    Rows that are equal in by and in order stay in one range: end the order with a column that tells rows apart. An empty table stays empty.
    """
    ranged = written(df.repartitionByRange(*by, *order).withColumn("g_range", F.spark_partition_id()))
    counts = ranged.groupBy("g_range", *by).agg(F.count("*").alias("g_count"))
    ahead = F.sum("g_count").over(Window.partitionBy(*by).orderBy("g_range").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.withColumn("g_before", ahead).where("g_before > 0").drop("g_count")
    before = before.withColumnsRenamed({c: f"g_of_{k}" for k, c in enumerate(["g_range", *by])})
    same = reduce(Column.__and__, [ranged[c].eqNullSafe(before[f"g_of_{k}"]) for k, c in enumerate(["g_range", *by])])
    local = F.row_number().over(Window.partitionBy("g_range", *by).orderBy(*order)) - 1
    placed = ranged.withColumn("g_local", local)
    return placed.join(F.broadcast(before), same, "left").select(*[placed[c] for c in df.columns if c != name], (F.col("g_local") + F.coalesce("g_before", F.lit(0))).alias(name))


def batches(df: DataFrame, order: Sequence[str | Column], size: int) -> DataFrame:
    """df with batch: rows in order, `size` to a batch, counted from 0. The order may be of any types; see numbered."""
    return numbered(df, [], order, "g_place").withColumn("batch", F.floor(F.col("g_place") / size)).drop("g_place")


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows by order; each task keeps n at most."""
    return df.orderBy(*order).limit(n)


def sampled(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """n rows drawn by a hash of their key: the same ones in any run."""
    return df.orderBy(F.xxhash64(key, F.lit(seed)), key).limit(n)


def batch_count(n: Column, size: int) -> Column:
    return F.ceil(n / size)


# ---- shape ----


def renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Columns by new names; a missing one raises an error that lists all that are missing."""
    missing = [c for c in names if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {', '.join(missing)}")
    return df.withColumnsRenamed(dict(names))


def alias_filled(df: DataFrame, aliases: Mapping[str, str]) -> DataFrame:
    """For each alias and its column: the column where it's given, else the alias, which goes."""
    for source, target in aliases.items():
        if source in df.columns:
            value = F.coalesce(F.col(target), F.col(source)) if target in df.columns else F.col(source)
            df = df.withColumn(target, value).drop(source)
    return df


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Columns that aren't there, with a value."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def conform(df: DataFrame, schema: T.StructType, false: Sequence[str] = ()) -> DataFrame:
    """The schema's columns in order: missing ones null (or False), others cast where the cast can't fail a row."""
    out = []
    for f in schema:
        if f.name not in df.columns:
            value = F.lit(False) if f.name in false else F.lit(None)
        else:
            value = F.coalesce(F.col(f.name).try_cast(f.dataType), F.lit(False)) if f.name in false else F.col(f.name).try_cast(f.dataType)
        out.append(value.cast(f.dataType).alias(f.name))
    return df.select(*out)


def reordered(df: DataFrame, first: Sequence[str]) -> DataFrame:
    """The named columns first, others after them."""
    return df.select(*[c for c in first if c in df.columns], *[c for c in df.columns if c not in first])


def without_repeated_columns(df: DataFrame) -> DataFrame:
    """Of columns with the same name, the first."""
    seen, names = set(), []
    for k, c in enumerate(df.columns):
        names.append(c if c not in seen else f"g_repeated_{k}")
        seen.add(c)
    return df.toDF(*names).drop(*[n for n in names if n.startswith("g_repeated_")])


def nulls_cleaned(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """Every text column with the tokens read as null."""
    lowered = [t.lower() for t in tokens]
    return df.withColumns({f.name: clean_null(F.col(f.name), lowered) for f in df.schema if isinstance(f.dataType, T.StringType)})


def nulled(df: DataFrame, column: str, *values: str) -> DataFrame:
    """Placeholders of a column as null."""
    return df.withColumn(column, F.when(~F.col(column).isin(*values), F.col(column)))


def coordinates_given(df: DataFrame) -> DataFrame:
    """df routed: `missing_coordinates` where the chromosome is null or blank, or start and end are both null."""
    return route(df, [(non_empty(F.col("chrom")).isNull() | (F.col("start").isNull() & F.col("end").isNull()), "missing_coordinates")])


def first_present(df: DataFrame, names: Sequence[str], default: str = "unknown") -> Column:
    """The first of the named columns that the table has, its nulls as the default."""
    there = next((c for c in names if c in df.columns), None)
    return F.coalesce(F.col(there).cast("string"), F.lit(default)) if there else F.lit(default)


def matching(df: DataFrame, column: str, pattern: str, reason: str) -> DataFrame:
    """df routed by a pattern that the column has to match."""
    return route(df, [(~F.coalesce(F.col(column).rlike(pattern), F.lit(False)), reason)])


def map_or_reject(df: DataFrame, column: str, mapped: Column, gate: Column, reason_prefix: str) -> DataFrame:
    """df routed: where gate holds, column takes the mapped value, or the row is rejected as reason_prefix and the old value."""
    old = F.col(column)
    routed = route(df.withColumn("g_mapped", mapped), [(gate & F.col("g_mapped").isNull(), F.concat(F.lit(reason_prefix), old.cast("string")))])
    return routed.withColumn(column, F.when(F.coalesce(gate, F.lit(False)) & F.col("g_mapped").isNotNull(), F.col("g_mapped")).otherwise(old)).drop("g_mapped")


def prefixed_or_inferred(df: DataFrame, keep: Column, inferred: Column) -> DataFrame:
    """The rows that keep holds for; only if there are none at all, those with an inferred value. This looks at the data once."""
    first = df.where(keep)
    return first if not first.isEmpty() else df.where(inferred.isNotNull())


# ---- sets of rows ----


def in_priority_order(streams: Sequence[DataFrame]) -> DataFrame:
    """All rows of the streams, with stream_prio: the place of their stream. Missing columns are null."""
    out = None
    for k, df in enumerate(streams):
        df = df.withColumn("stream_prio", F.lit(k))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no streams")
    return out


def rejects_of(df: DataFrame, default_source: str = "plant") -> DataFrame:
    """transcript_id, db_source and reason of a reject table of any of its shapes; without a source it is the default one."""
    source = F.col("db_source") if "db_source" in df.columns else F.lit(default_source)
    return df.select("transcript_id", source.alias("db_source"), "reason")


def difference(expected: DataFrame, present: DataFrame, on: Sequence[str]) -> DataFrame:
    """What is expected and not present, each once; nulls are equal."""
    return expected.select(*on).distinct().exceptAll(present.select(*on).distinct())


def intersection(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    return a.select(*on).intersect(b.select(*on))


def union_distinct(parts: Sequence[DataFrame], column: str) -> DataFrame:
    """The values of a column over the parts, each once, without null, with the first place they come at."""
    rows = in_priority_order([p.select(column) for p in parts]).where(F.col(column).isNotNull())
    return rows.groupBy(column).agg(F.min("stream_prio").alias("stream_prio"))
