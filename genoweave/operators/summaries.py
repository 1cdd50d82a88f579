"""Counts, funnels, pivots, guards and ambiguity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, *columns: str, top: int | None = None) -> DataFrame:
    """n of each combination, the most frequent first, then by the values; the first `top`."""
    out = df.groupBy(*columns).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *columns)
    return out.limit(top) if top else out


def funnel(df: DataFrame, **conditions: Column) -> DataFrame:
    """One row: total, and for each name the rows its condition holds for."""
    return df.agg(F.count("*").alias("total"), *[F.count_if(c).alias(n) for n, c in conditions.items()])


def balanced(counts: DataFrame, equations: Mapping[str, tuple[str, Sequence[str]]]) -> DataFrame:
    """For each name, whether the first column of a one-row table is the sum of the others."""
    checks = [F.struct(F.lit(n).alias("name"), F.col(a).alias("expected"), sum((F.col(c) for c in rest), F.lit(0)).alias("got")) for n, (a, rest) in equations.items()]
    return counts.select(F.inline(F.array(*checks))).withColumn("holds", F.col("expected") == F.col("got"))


def first_example(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.min_by(value, order).alias(f"example_{value}"), F.count("*").alias("n"))


def first_filled_of(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """The first value by order that isn't null."""
    return df.groupBy(*keys).agg(F.min_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order))).alias(value))


def match_rates(attempted: DataFrame, matched: DataFrame, group: str, least_rate: float = 0.02, least_attempts: int = 5) -> DataFrame:
    """Per group of attempted (group, n): n_matched, n_attempted, rate and flagged, where the rate is under least_rate after enough attempts."""
    m = matched.select(group, F.col("n").alias("g_m"))
    out = attempted.join(m, group, "left").select(group, F.coalesce("g_m", F.lit(0)).cast("bigint").alias("n_matched"), F.col("n").cast("bigint").alias("n_attempted"))
    out = out.withColumn("rate", F.when(F.col("n_attempted") > 0, F.col("n_matched") / F.col("n_attempted")).otherwise(0.0))
    return out.withColumn("flagged", (F.col("n_attempted") >= least_attempts) & (F.col("rate") < least_rate))


def guard(rates: DataFrame, group: str) -> None:
    """Raises an error that names the flagged groups, if there are any."""
    bad = rates.where("flagged").orderBy(group).limit(20).collect()
    if bad:
        raise RuntimeError("hardly any match: " + ", ".join(f"{r[group]} {r.n_matched}/{r.n_attempted}" for r in bad))


def pivot_mean(df: DataFrame, row: str, column: str, values: Sequence[str], value: str) -> DataFrame:
    """Means of value by row and column, 0 where there are none."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.avg(value)).na.fill(0)


def pivot_rate(df: DataFrame, row: str, column: str, values: Sequence[str], part: Column, total: Column) -> DataFrame:
    """100 * sum(part) / sum(total) by row and column, rounded half to even to one place; null where the total is 0."""
    rate = F.bround(100.0 * F.sum(part) / F.nullif(F.sum(total), F.lit(0)), 1)
    return df.groupBy(row).pivot(column, list(values)).agg(rate)


def counted_share(df: DataFrame, keys: Sequence[str], flag: Column, least: int = 0) -> DataFrame:
    """n, hits and pct of each group with at least `least` rows."""
    out = df.groupBy(*keys).agg(F.count("*").alias("n"), F.coalesce(F.sum(flag.cast("bigint")), F.lit(0)).alias("hits")).where(F.col("n") >= least)
    return out.withColumn("pct", F.bround(100.0 * F.col("hits") / F.col("n"), 2))


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def collisions(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys that stand for several values, how many and which."""
    return df.groupBy(key).agg(F.count_distinct(value).alias("n"), F.array_join(F.array_sort(F.collect_set(value)), ";").alias("which")).where("n > 1")


def long_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(metric, value) for each column of a one-row table."""
    return df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns])))


def joined_text(df: DataFrame, keys: Sequence[str], order: str, value: Column, sep: str, name: str) -> DataFrame:
    """The values of a group as one text, in order, each once."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), value.alias("v")))), lambda r: r.v)
    return df.groupBy(*keys).agg(F.array_join(F.array_distinct(rows), sep).alias(name))


def strategy_counts(matches: DataFrame, tools: DataFrame, strategies: Sequence[str]) -> DataFrame:
    """Per tool of tools (those without a match too) the number of matches by each strategy, and total."""
    counts = matches.groupBy("tool").agg(*[F.count_if(F.col("strategy") == s).alias(s) for s in strategies], F.count("*").alias("total"))
    return tools.select("tool").distinct().join(counts, "tool", "left").na.fill(0)


def ambiguity(hits: DataFrame, row_id: str, gene: str, order: Sequence[str]) -> DataFrame:
    """hits with rank, is_ambiguous (more than one distinct gene) and role: `primary`, `alternative` (another gene than the primary's), or `repeat`."""
    w = Window.partitionBy(row_id)
    by = w.orderBy(*order)
    out = hits.withColumn("rank", F.row_number().over(by)).withColumn("g_primary", F.first(gene).over(by))
    out = out.withColumn("is_ambiguous", F.size(F.collect_set(gene).over(w)) > 1)
    other = ~F.col(gene).eqNullSafe(F.col("g_primary"))
    again = F.row_number().over(Window.partitionBy(row_id, gene).orderBy(*order)) > 1
    return out.withColumn("role", F.when(F.col("rank") == 1, "primary").when(other & ~again, "alternative").otherwise("repeat")).drop("g_primary")


def ambiguous_by_count(hits: DataFrame, row_id: str) -> DataFrame:
    return hits.withColumn("is_ambiguous", F.count("*").over(Window.partitionBy(row_id)) > 1)
