"""Slices of indexed FASTA files: only the bytes that regions touch are read, on the executors."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .packed import FAILURES, opened

#: Regions with fewer bytes between them are read at once, as long as that is no more than MOST_BYTES.
GAP, MOST_BYTES = 1 << 14, 1 << 23


def byte_at(letter: Column | str) -> Column:
    """The place in the file of a record's letter, counted from 0, by its index."""
    n = F.col(letter) if isinstance(letter, str) else letter
    return F.col("offset") + F.floor(n / F.col("line_bases")) * F.col("line_width") + n % F.col("line_bases")


def indexed_slices(regions: DataFrame, index: DataFrame, row_id: str) -> DataFrame:
    """regions (row_id, assembly, seqid, ext_start, ext_end) with seq, in upper case, null if nothing is there or it can't be read, and
    bytes_read: what was read for the row, with others near it if it is the first of them.

    index is records.fasta_index, or files.fai_index of an index file. Regions are ranged by file and place, so a task reads neighbours
    together and opens a file once; a hot place is many ranges, as rows are told apart by their id. Records whose lines aren't regular can't be
    sliced by an index; use slices over their chunks.
    """
    low, high = F.greatest(F.col("ext_start"), F.lit(0)), F.least(F.col("ext_end"), F.col("g_length"))
    own = index.select("assembly", "seqid", F.col("path").alias("g_path"), F.col("length").alias("g_length"), "offset", "line_bases", "line_width")
    found = regions.select(row_id, "assembly", "seqid", "ext_start", "ext_end").join(own, ["assembly", "seqid"]).withColumns({"g_low": low, "g_high": high}).where("g_high > g_low and line_bases > 0")
    planned = found.select(row_id, "g_path", byte_at("g_low").alias("g_from"), (byte_at(F.col("g_high") - 1) + 1).alias("g_to"))

    def run(batches):
        at, f = None, None
        for b in batches:
            ids, paths, lows, highs = b.column(0), *(c.to_pylist() for c in b.columns[1:])
            s = 0
            while s < len(paths):
                e, high = s + 1, highs[s]
                while e < len(paths) and paths[e] == paths[s] and lows[e] - high <= GAP and max(high, highs[e]) - lows[s] <= MOST_BYTES:
                    high, e = max(high, highs[e]), e + 1
                try:
                    if at != paths[s]:
                        if f is not None:
                            f.close()
                        f = None
                        f, at = opened(paths[s]), paths[s]
                    raw = f.read_at(high - lows[s], lows[s])
                except FAILURES:
                    raw = at = None
                seqs = [None if raw is None else raw[lows[k] - lows[s] : highs[k] - lows[s]].translate(None, b"\r\n").decode("ascii", "replace").upper() or None for k in range(s, e)]
                yield pa.RecordBatch.from_arrays([ids.slice(s, e - s), pa.array(seqs, pa.string()), pa.array([len(raw or b"")] + [0] * (e - s - 1), pa.int64())], ["id", "seq", "bytes_read"])
                s = e

    kind = regions.schema[row_id].dataType.simpleString()
    dealt = planned.repartitionByRange("g_path", "g_from", row_id).sortWithinPartitions("g_path", "g_from", row_id)
    cut = dealt.mapInArrow(run, f"id {kind}, seq string, bytes_read long").withColumnRenamed("id", row_id)
    return regions.drop("seq", "bytes_read").join(cut, row_id, "left").withColumn("bytes_read", F.coalesce("bytes_read", F.lit(0)))
