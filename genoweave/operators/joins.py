"""Joins of identifiers with tables: candidates in turn, versions, fills, overlaps, memberships."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import drop_last_part, first_part
from ..functions.text import key
from .rows import keep_first


def first_match_join(df: DataFrame, index: DataFrame, candidates: Column, row_id: Sequence[str], index_key: str = "key", how: str = "left") -> DataFrame:
    """df with the columns of index for the first candidate that it has, and matched_key and matched_pos.

    candidates is an array of keys in order. index has a key once (see operators.rows.keep_first); row_id names each row of df.
    Candidates are spread out, joined on equality, and the first hit of each row is kept, so neither side is collected. A hit
    is found by partial minima before the shuffle. Rows without a hit stay with nulls (how="left").
    """
    values = [c for c in index.columns if c != index_key]
    spread = df.select(*row_id, F.posexplode(F.array_distinct(candidates)).alias("g_pos", "g_key"))
    hits = spread.join(index.select(F.col(index_key).alias("g_key"), F.struct(*values).alias("g_value") if values else F.lit(1).alias("g_value")), "g_key")
    best = hits.groupBy(*row_id).agg(F.min_by(F.struct("g_key", "g_pos", "g_value"), "g_pos").alias("g_hit"))
    picked = best.select(*[F.col(c).alias(f"g_id_{c}") for c in row_id], F.col("g_hit.g_key").alias("matched_key"), F.col("g_hit.g_pos").alias("matched_pos"), *[F.col(f"g_hit.g_value.{v}").alias(v) for v in values])
    on = [F.col(c).eqNullSafe(F.col(f"g_id_{c}")) for c in row_id]
    return df.join(picked, on, how).drop(*[f"g_id_{c}" for c in row_id])


def first_source_join(df: DataFrame, sources: DataFrame, on: str, priority: str, how: str = "left") -> DataFrame:
    """df with the columns of the source that has the key and the smallest priority; ties are an error of the snapshot, not ours:
    the smallest row by all columns counts."""
    values = [c for c in sources.columns if c != on]
    best = sources.groupBy(on).agg(F.min(F.struct(priority, *[v for v in values if v != priority])).alias("g_hit"))
    return df.join(best, on, how).select(*df.columns, *[F.col(f"g_hit.{v}").alias(v) for v in values])


def versioned_then_base(df: DataFrame, table: DataFrame, row_id: str, table_id: str, base: Callable[[Column], Column] = first_part) -> DataFrame:
    """All rows of table with df's identifier as it is, and, only for identifiers with none, those with the same base.

    Several hits of a row stay; match_type is `versioned` or `base`. Rows without any hit don't come out.
    """
    exact = df.join(table.withColumnRenamed(table_id, "g_id"), F.col(row_id) == F.col("g_id")).withColumn("match_type", F.lit("versioned"))
    rest = df.join(table.select(F.col(table_id).alias("g_id")), F.col(row_id) == F.col("g_id"), "left_anti")
    loose = rest.withColumn("g_base", base(F.col(row_id))).join(table.withColumn("g_base", base(F.col(table_id))).withColumnRenamed(table_id, "g_id"), "g_base").drop("g_base").withColumn("match_type", F.lit("base"))
    return exact.unionByName(loose).withColumnRenamed("g_id", f"matched_{table_id}")


def two_probes(df: DataFrame, index: DataFrame, identifier: str, row_id: Sequence[str], index_key: str = "key") -> DataFrame:
    """first_match_join with an identifier and the same without its last part."""
    return first_match_join(df, index, F.array(F.col(identifier), drop_last_part(F.col(identifier))), row_id, index_key)


def lookup_chain(df: DataFrame, dim: DataFrame, keys: Sequence[Column], dim_key: str, value: str, default: str = "") -> DataFrame:
    """df with value: that of the first key whose value in dim isn't empty, else the default."""
    found = []
    for k, col in enumerate(keys):
        part = dim.select(F.col(dim_key).alias(f"g_k{k}"), F.nullif(F.col(value), F.lit("")).alias(f"g_v{k}"))
        df = df.join(part, col == F.col(f"g_k{k}"), "left").drop(f"g_k{k}")
        found.append(f"g_v{k}")
    return df.withColumn(value, F.coalesce(*found, F.lit(default))).drop(*found)


def fill_from(df: DataFrame, dim: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """df with nulls of the columns filled from dim: by the first key, what is then still null by the second, and so on.

    Keys are compared trimmed and in lower case; of dim's rows with the same key the first by order counts. What is given stays.
    """
    for k in keys:
        side = keep_first(dim.withColumn("g_key", key(F.col(k))).where("g_key <> ''"), ["g_key"], order)
        side = side.select("g_key", *[F.col(c).alias(f"g_{c}") for c in columns])
        joined = df.withColumn("g_key", key(F.col(k))).join(side, "g_key", "left")
        df = joined.select(*[F.coalesce(F.col(c), F.col(f"g_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])
    return df


def validated_join(df: DataFrame, dim: DataFrame, on: Sequence[str], strict: bool = True, order: Sequence[str] = ()) -> DataFrame:
    """A left join in which dim may have a key once only: else an error (strict), or its first row by order counts."""
    if strict:
        twice = dim.groupBy(*on).count().where("count > 1").limit(5).collect()
        if twice:
            raise ValueError(f"keys found more than once: {[tuple(r)[:-1] for r in twice]}")
    else:
        dim = keep_first(dim, on, order or [c for c in dim.columns if c not in on] or on)
    return df.join(dim, list(on), "left")


def semi(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key isn't in keys; a null key is in none."""
    return df.join(keys, on, "left_anti")


def overlap_join(records: DataFrame, tools: DataFrame) -> DataFrame:
    """(record_id, tool, prio, tokens): for each record and tool, the first strategy by which they share tokens, and those, sorted.

    records has (record_id, prio, token), tools (tool, prio, token): the sets are spread out, so that an overlap is an equality.
    What a record shares with a tool is at most its own tokens, so one grouping finds the strategy and its tokens.
    """
    hits = records.join(tools.distinct(), ["prio", "token"])
    shared = hits.groupBy("record_id", "tool").agg(F.min("prio").alias("prio"), F.collect_set(F.struct("prio", "token")).alias("g_all"))
    first = F.transform(F.filter("g_all", lambda x: x.prio == F.col("prio")), lambda x: x.token)
    return shared.select("record_id", "tool", "prio", F.array_sort(first).alias("tokens"))


def key_bits(keys: DataFrame, column: str | Column, bits: int = 24) -> DataFrame:
    """(word, bits): a Bloom filter of the keys, of 2 ** bits bits, two for a key, as rows of 64: at most 2 ** (bits - 6) rows whatever the keys are."""
    key = F.col(column) if isinstance(column, str) else column
    place = keys.where(key.isNotNull()).select(F.explode(F.array(*[h.bitwiseAND(F.lit((1 << bits) - 1)) for h in (F.xxhash64(key), F.xxhash64(key, F.lit(1)))])).alias("place"))
    return place.groupBy(F.shiftright("place", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(place & 63))")).alias("bits"))


def maybe_in(df: DataFrame, column: str | Column, filter_rows: DataFrame, bits: int = 24) -> DataFrame:
    """The rows of df whose key may be one of key_bits' keys: all that are, and some that aren't. The filter has a bounded size and is broadcast, so
    df isn't shuffled, and the rows that a join has no use for end at its scan."""
    key = F.col(column) if isinstance(column, str) else column
    small = F.broadcast(filter_rows)
    out = df
    for k, h in enumerate((F.xxhash64(key), F.xxhash64(key, F.lit(1)))):
        out = out.withColumn("g_place", h.bitwiseAND(F.lit((1 << bits) - 1))).withColumn("g_word", F.shiftright("g_place", 6))
        own = small.select(F.col("word").alias("g_word"), F.col("bits").alias("g_bits"))
        out = out.join(own, "g_word").where(F.expr("(shiftright(g_bits, int(g_place & 63)) & 1L) = 1L")).select(*df.columns)
    return out


def membership(ids: DataFrame, column: str, known: DataFrame, known_column: str, filter_bits: int = 0) -> DataFrame:
    """ids with match_type: `exact`, `unversioned` (equal without versions) or null.

    With filter_bits, a filter of the ids (see key_bits) goes to the scan of known, of which few rows are left to be shuffled then: for a mapping
    that is much larger than ids. The rows are the same.
    """
    known = known.select(known_column)
    if filter_bits:
        known = maybe_in(known, first_part(F.col(known_column)), key_bits(ids, first_part(F.col(column)), filter_bits), filter_bits)
    exact = known.select(F.col(known_column).alias(column)).distinct().withColumn("g_exact", F.lit(True))
    loose = known.select(first_part(F.col(known_column)).alias("g_base")).distinct().withColumn("g_loose", F.lit(True))
    joined = ids.withColumn("g_base", first_part(F.col(column))).join(exact, column, "left").join(loose, "g_base", "left")
    return joined.withColumn("match_type", F.when(F.col("g_exact"), "exact").when(F.col("g_loose"), "unversioned")).select(*ids.columns, "match_type")


def presence_counts(ids: DataFrame, keys: DataFrame, column: str, key_column: str) -> DataFrame:
    """One row: total, present and absent of the distinct ids."""
    known = keys.select(F.col(key_column).alias(column)).distinct().withColumn("g_there", F.lit(True))
    joined = ids.select(column).distinct().join(known, column, "left")
    return joined.agg(F.count("*").alias("total"), F.count_if(F.col("g_there").isNotNull()).alias("present"), F.count_if(F.col("g_there").isNull()).alias("absent"))


def expanded(df: DataFrame, array: str, table: DataFrame, on: str, row_id: Sequence[str], order: Sequence[str] = (), first_only: bool = False) -> DataFrame:
    """df joined with table on each element of an array column, or only on the first element that hits."""
    spread = df.select("*", F.posexplode(array).alias("g_pos", on)).join(table, on)
    return keep_first(spread, row_id, ["g_pos", *order]).drop("g_pos") if first_only else spread.drop("g_pos")


def with_exceptions(df: DataFrame, column: str, exceptions: DataFrame, snapshot: DataFrame, value: str) -> DataFrame:
    """df with value: that of the exceptions for the column, else that of the snapshot. Both have a key once."""
    for name, dim in (("g_first", exceptions), ("g_second", snapshot)):
        df = df.join(dim.select(column, F.col(value).alias(name)), column, "left")
    return df.withColumn(value, F.coalesce("g_first", "g_second")).drop("g_first", "g_second")


def stem_join(left: DataFrame, right: DataFrame, stem: str, name: str, prefer: Sequence[Column]) -> DataFrame:
    """left with the first row of right, by prefer, whose name starts with the stem and a dot. A name is spread out to all its stems, and joined on equality."""
    dots = F.size(F.split(name, r"\.")) - 1
    stems = F.when(dots > 0, F.transform(F.sequence(F.lit(1), dots), lambda k: F.call_function("substring_index", F.col(name), F.lit("."), k)))
    hits = left.join(right.select("*", F.explode(F.array_distinct(stems)).alias("g_stem")), F.col(stem) == F.col("g_stem"), "left").drop("g_stem")
    w = Window.partitionBy(*left.columns).orderBy(*prefer)
    return hits.withColumn("g_n", F.row_number().over(w)).where("g_n = 1").drop("g_n")
