"""Substring dedup: content-defined chunks by a gear rolling hash. What is deduplicated, by digest, are windows of chunks one after
another, so that common phrases which happen to follow each other are no repeat."""

from __future__ import annotations

import functools
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, utf8, without

#: The bytes a text may be cut after: ASCII white space.
BLANK = b"\t\n\x0b\x0c\r "
#: Of the rolling hash, as many bytes count as it is doubled: 2 ** 4.
DOUBLINGS = 4


@dataclass(frozen=True)
class Chunking:
    """word_bits: after a blank, a chunk ends with a chance of 1 in 2 ** word_bits; any_bits: after any other byte,
    or 2 ** dense_bits where the last dense_window bytes hold no blank; most_bytes: no chunk is longer; least_run: bytes of a window, the fewest chunks in a row that have so many;
    filter_bits: 2 ** filter_bits bits say which digests may be repeated."""

    word_bits: int = 2
    any_bits: int = 12
    dense_bits: int = 4
    dense_window: int = 64
    most_bytes: int = 1 << 16
    least_run: int = 120
    filter_bits: int = 25


@functools.cache
def gears():
    """A fixed random number for each byte."""
    import numpy as np

    return np.random.default_rng(20).integers(0, 1 << 32, 256, dtype=np.uint32), np.isin(np.arange(256), list(BLANK))


def chunk_ends(raw: bytes, how: Chunking = Chunking()) -> list[int]:
    """Where the chunks of a text in UTF-8 end, ascending, the last at its end.

    The gear hash of the last 16 bytes decides on an end, and whether the last dense_window bytes hold a blank, so an insertion
    moves the ends near it and no others. Ends stand after blanks mostly, and never inside a character.
    """
    import numpy as np

    if not raw:
        return []
    gear, blank = gears()
    b = np.frombuffer(raw, dtype=np.uint8)
    h = gear[b]
    for k in range(DOUBLINGS):  # h[i] = sum of gear[b[i - j]] << j over j < 16
        step = 1 << k
        h[step:] += h[:-step] << np.uint32(step)
    at = blank[b]
    stop = np.where(at, h >> np.uint32(32 - how.word_bits) == 0, h >> np.uint32(32 - how.any_bits) == 0)
    if len(raw) > how.dense_window:
        seen = np.cumsum(at)
        dense = seen[how.dense_window :] == seen[: -how.dense_window]
        dense[:-1] &= b[how.dense_window : -1] != b[how.dense_window + 1 :]  # not inside a run of one byte
        stop[how.dense_window :] |= dense & (h[how.dense_window :] >> np.uint32(32 - how.dense_bits) == 0)
    stop[:-1] &= (b[1:] & 0xC0) != 0x80
    stop[:-1] &= ~(at[:-1] & at[1:])  # not inside a run of blanks
    stop[-1] = True
    ends = (np.flatnonzero(stop) + 1).tolist()
    if len(raw) <= how.most_bytes:
        return ends
    out, start = [], 0
    for end in ends:
        while end - start > how.most_bytes:
            start += how.most_bytes
            while b[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        out.append(end)
        start = end
    return out


def digests(raw: bytes, starts: list[int], ends: list[int]):
    """The 64-bit digests of stretches of a text, as signed integers."""
    import numpy as np
    from xxhash import xxh64_digest

    return np.frombuffer(b"".join([xxh64_digest(raw[s:e]) for s, e in zip(starts, ends)]), dtype=">i8").astype(np.int64)


def windows(raw: bytes, how: Chunking = Chunking()):
    """(edges, low, high, digest) of a text: the edges of its chunks, and its windows, in order, from edge low to edge high.

    From each edge to the right, and from each to the left, a window is the fewest chunks that have least_run bytes; so a run of chunks of that size
    or more is covered by the windows in it. A window's digest is of its bytes, whatever edges are inside it.
    """
    import numpy as np

    ends = chunk_ends(raw, how)
    edges = np.array([0, *ends], np.int64)
    n = len(ends)
    right = np.searchsorted(edges, edges + how.least_run, "left")
    left = np.searchsorted(edges, edges - how.least_run, "right") - 1
    at = np.arange(n + 1)
    both = np.unique(np.concatenate([(at * (n + 1) + right)[right <= n], (left * (n + 1) + at)[left >= 0]]))
    low, high = both // (n + 1), both % (n + 1)
    return edges, low, high, digests(raw, edges[low].tolist(), edges[high].tolist())


def repeated_windows(docs: DataFrame, how: Chunking = Chunking(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, digest) of the windows that a document with a smaller id has too. Each is given once a document.

    A digest's smallest and largest id are gathered with partial sums before the shuffle; only digests of several ids are written. Bits by
    their digests, of a fixed number, go to the tasks, which leave out most windows that aren't repeated; the others are joined with what
    was written. Both sides of that join are plain rows of two numbers dealt by digest, so Spark splits those of a digest that is in very many
    documents. Rows with a null id take no part.
    """
    import numpy as np

    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    mask = (1 << how.filter_bits) - 1

    def reader(sent):
        def run(batches):
            import numpy as np

            for b in batches:
                found = [np.unique(windows(t, how)[3]) if t else np.zeros(0, np.int64) for t in b.column(1).to_pylist()]
                at = np.repeat(np.arange(len(found)), [len(x) for x in found])
                digest = np.concatenate(found)
                if sent is not None:
                    place = digest & mask
                    some = np.flatnonzero(sent.value[place >> 6] >> (place & 63).astype(np.uint64) & np.uint64(1))
                    at, digest = at[some], digest[some]
                for start in range(0, len(at), 50_000):  # small batches: a batch of texts has many windows
                    part = slice(start, start + 50_000)
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at[part])), pa.array(digest[part])], ["id", "digest"])

        return docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).mapInArrow(run, f"id {kind}, digest long")

    first = cut(reader(None).groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last").drop("last"))
    place = F.col("digest").bitwiseAND(F.lit(mask))
    words = first.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, int(digest & 63))")).alias("bits")).toArrow()
    bits = np.zeros(max(1, mask + 1 >> 6), np.uint64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    found = reader(spark.sparkContext.broadcast(bits))
    return found.join(first, "digest").where(F.col("id") > F.col("first")).select(F.col("id").alias(id_col), "digest")


def strip_repeats(raw: bytes, repeated, how: Chunking = Chunking()) -> tuple[bytes, int, list[tuple[int, int]]]:
    """(text without repeats, number of chunks, byte spans cut out): the windows in repeated go, and those that this text has had before, in whole."""
    import numpy as np

    edges, low, high, digest = windows(raw, how)
    if not len(digest):
        return raw, len(edges) - 1, []
    _, first, which = np.unique(digest, return_index=True, return_inverse=True)
    gone = np.isin(digest, np.asarray(repeated, np.int64)) | (edges[low] >= edges[high][first[which]])
    if not gone.any():
        return raw, len(edges) - 1, []
    cover = np.zeros(len(edges) + 1, np.int64)
    np.add.at(cover, low[gone], 1)
    np.add.at(cover, high[gone], -1)
    inside = np.concatenate(([False], np.cumsum(cover)[: len(edges) - 1] > 0, [False]))
    change = np.flatnonzero(inside[1:] != inside[:-1])
    spans = [(int(edges[s]), int(edges[e])) for s, e in change.reshape(-1, 2)]
    kept, at = [], 0
    for s, e in spans:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]]), len(edges) - 1, spans


def dedup_substrings(docs: DataFrame, how: Chunking = Chunking(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with text_col cut down, and n_chunks, removed_spans (byte offsets in the old text) and removed_bytes added.

    Of the texts that hold a passage, the one with the smallest id keeps it, at its first place. A passage is found if the chunks inside
    it have at least how.least_run bytes; its first and last few words, up to the next end of a chunk, stay. What goes is made of
    windows of so many bytes that stand in one piece in a text with a smaller id, or before in the same one. Rows with the same id keep what they share, and rows with a null id lose only what they repeat
    themselves. Null texts stay null; all rows stay, those left empty too. Columns with the new names are replaced. An
    empty table gives no rows.
    """
    docs = without(docs, "n_chunks", "removed_spans", "removed_bytes", "g_repeated", "g_out")
    lists = repeated_windows(docs.select(id_col, text_col), how, id_col, text_col).groupBy(id_col).agg(F.collect_list("digest").alias("g_repeated"))

    @F.arrow_udf("struct<text:string,n_chunks:int,removed_spans:array<struct<start:int,end:int>>,removed_bytes:int>")
    def strip(texts: pa.Array, repeated: pa.Array) -> pa.Array:
        rows = []
        for t, r in zip(texts.to_pylist(), repeated.to_pylist()):
            new, n, spans = strip_repeats((t or "").encode(), r or (), how)
            rows.append({"text": None if t is None else new.decode() if spans else t, "n_chunks": n, "removed_spans": [{"start": s, "end": e} for s, e in spans], "removed_bytes": sum(e - s for s, e in spans)})
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.array(rows, pa.struct([("text", pa.string()), ("n_chunks", pa.int32()), ("removed_spans", span), ("removed_bytes", pa.int32())]))

    # else a filter on the result, pushed below it, would work it out twice
    out = docs.join(lists, id_col, "left").withColumn("g_out", strip.asNondeterministic()(text_col, "g_repeated"))
    kept = [F.col("g_out.text").alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return out.select(*kept, "g_out.n_chunks", "g_out.removed_spans", "g_out.removed_bytes")
