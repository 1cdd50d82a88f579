"""Sharding by sampled splitters: size-weighted key samples give the boundaries of key ranges."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, without

#: No ranges beyond this, so that what the driver samples has a bound: 16 keys of three numbers for each.
MOST_RANGES = 50_000


def sampled_splitters(keyed: DataFrame, ranges: int, total: int, per_range: int = 16) -> np.ndarray:
    """At most ranges - 1 ascending, distinct keys (rows of k1, k2) that cut keyed (k1, k2, size) into ranges of about equal size.

    A row is drawn with a probability in proportion to its size, by a hash of its key, so a retry draws the same rows.
    About per_range * ranges rows are drawn: that bounds what the driver gets.
    """
    step = total / (ranges * per_range)
    if ranges < 2 or step <= 0:
        return np.zeros((0, 2), dtype=np.int64)
    draw = F.pmod(F.xxhash64("k1", "k2", F.lit(7)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = keyed.where(draw < F.col("size") / F.lit(step)).select("k1", "k2", F.greatest("size", F.lit(step)).cast("double").alias("w")).toArrow()
    keys, w = np.stack([drawn[c].to_numpy() for c in ("k1", "k2")], axis=1), drawn["w"].to_numpy()
    return quantile_keys(keys, w, ranges)


def quantile_keys(keys: np.ndarray, w: np.ndarray, ranges: int) -> np.ndarray:
    """The first keys, by ascending key, before which at least 1, 2, ... of `ranges` parts of the weight lie."""
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    keys, before = keys[order], np.cumsum(w[order]) - w[order]
    at = np.searchsorted(before, w.sum() * np.arange(1, ranges) / ranges)
    return np.unique(keys[at[at < len(keys)]], axis=0)


def range_of(splitters: np.ndarray) -> Column:
    """The number of splitters (ascending rows of k1, k2) at or below the row's key: 0 to len(splitters). They go to the tasks as arrays."""
    firsts, starts = np.unique(splitters[:, 0], return_index=True)
    seconds, ends = splitters[:, 1], np.append(starts[1:], len(splitters))

    @F.arrow_udf("int")
    def place(k1: pa.Array, k2: pa.Array) -> pa.Array:
        a, b = k1.to_numpy(zero_copy_only=False), k2.to_numpy(zero_copy_only=False)
        at = np.searchsorted(firsts, a, side="right")  # of the distinct first numbers, those at or below
        out = np.append(0, ends)[at]
        same = np.flatnonzero((at > 0) & (firsts[at - 1] == a)) if len(firsts) else []
        for g in np.unique(at[same]) - 1 if len(same) else []:  # rows that share a splitter's first number: by the second
            rows = same[at[same] == g + 1]
            out[rows] = starts[g] + np.searchsorted(seconds[starts[g] : ends[g]], b[rows], side="right")
        return pa.array(out.astype(np.int32))

    return place("k1", "k2") if len(splitters) else F.lit(0)


def shard_records(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = 256 << 20,
    per_range: int = 16,
    overfull: float = 1.5,
) -> DataFrame:
    """docs with size, shard (0 to shards - 1) and slot (0, 1, ... in each shard) added; shards have nearly equal bytes.

    A row's size is its text's UTF-8 bytes (null: none) plus 8. Its key is a hash of the text and then the id, so equal
    texts stand next to each other and a group of copies of any size is cut between its ids. Splitters are quantiles of a
    size-weighted sample; ranges measured at over `overfull` times their share are sampled again and subdivided. The exact
    running size over the ranges then gives the shards' boundaries, so a shard's bytes differ from the mean by less than
    the size of the largest row. There is a range, and so a task, for range_bytes of the input, at least 4 a shard and about MOST_RANGES at
    most; the driver gets about per_range keys for each and a figure or two.

    Null ids come first among equal texts. Rows with the same text and id can't be told apart and stay in one shard.
    Columns named size, shard or slot, and k1, k2 and piece, are replaced or dropped. Ids have to be integers, or texts of them; others
    count as null. An empty table gives no rows.
    """
    docs = without(docs, "size", "shard", "slot", "k1", "k2", "piece")
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 8
    keyed = docs.withColumns({"size": size, "k1": F.xxhash64(text_col), "k2": F.coalesce(F.expr(f"try_cast(`{id_col}` AS bigint)"), F.lit(-(1 << 63)))})
    slim = cut(keyed.select("k1", "k2", "size"))
    total = slim.agg(F.sum("size")).first()[0] or 0
    ranges = min(max(4 * shards, math.ceil(total / range_bytes)), max(4 * shards, MOST_RANGES))
    splitters = sampled_splitters(slim, ranges, total, per_range)

    def measured(by: np.ndarray, what: Column) -> np.ndarray:
        got, out = slim.groupBy(range_of(by).alias("piece")).agg(what.alias("n")).collect(), np.zeros(len(by) + 1, dtype=np.int64)
        for piece, n in got:
            out[piece] = n
        return out

    sizes = measured(splitters, F.sum("size"))
    for _ in range(5):
        large = np.flatnonzero(sizes > overfull * total / ranges).tolist()
        if not large:
            break
        inside = slim.withColumn("piece", range_of(splitters)).where(F.col("piece").isin(large))
        held = int(sizes[large].sum())
        finer = np.unique(np.concatenate([splitters, sampled_splitters(inside, math.ceil(2 * held * ranges / total), held, per_range)]), axis=0)
        if len(finer) == len(splitters):  # single rows as large as that
            break
        splitters = finer
        sizes = measured(splitters, F.sum("size"))

    before = (np.cumsum(sizes) - sizes).tolist()
    starts = docs.sparkSession.createDataFrame(list(enumerate(before)), "piece int, before long")
    run = Window.partitionBy("piece").orderBy("k1", "k2").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("before") + F.sum("size").over(run) - F.col("size") / 2
    placed = slim.withColumn("piece", range_of(splitters)).join(F.broadcast(starts), "piece", "left")  # one row a range; an inner join would place rows twice, to see that none is null
    shard = F.least(F.floor(middle * shards / F.lit(float(max(total, 1)))), F.lit(shards - 1))
    firsts = placed.withColumn("shard", shard.cast("int")).groupBy("shard").agg(F.min(F.struct("k1", "k2")).alias("k")).collect()
    bounds = {(r.k.k1, r.k.k2): r.shard for r in firsts}

    cuts = np.unique(np.concatenate([splitters, np.array(sorted(bounds), dtype=np.int64).reshape(-1, 2)]), axis=0)
    counts = measured(cuts, F.count("*")).tolist()
    info, filled, here = [], dict.fromkeys(range(shards), 0), 0
    for i, key in enumerate([None, *map(tuple, cuts.tolist())]):  # a piece is in the shard of the last boundary at or below its first key
        here = bounds.get(key, here)
        info.append((i, here, filled[here]))
        filled[here] += counts[i]
    info = docs.sparkSession.createDataFrame(info, "piece int, shard int, base long")
    order = Window.partitionBy("piece").orderBy("k1", "k2")
    dealt = keyed.withColumn("piece", range_of(cuts)).repartitionById(len(cuts) + 1, "piece")  # a task for each piece
    numbered = dealt.withColumn("rank", F.row_number().over(order))
    return numbered.join(F.broadcast(info), "piece", "left").withColumn("slot", F.col("base") + F.col("rank") - 1).drop("piece", "rank", "base", "k1", "k2")
