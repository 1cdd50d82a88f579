"""FASTA by lines: chunks of sequences and indexes from the splits of a file, whatever the length of a record.

The lines of a split are one block. A task reads a block's lines in order and knows the records that begin there, and how much of the
record before it holds. Sums over the blocks of a file, a row each, then say where each block's first lines stand in their record.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..shared import written

#: Letters in a chunk.
CHUNK = 1 << 16
BLANKS = b" \t\n\x0b\x0c\r"


def lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(key, block, file, value): the lines of text files in binary, key for the file and block for the split. file is given for header lines only.

    Within a partition a block's lines stand together and in order.
    """
    place = F.col("_metadata.file_path")
    header = F.col("value").startswith(">")
    read = spark.read.option("lineSep", "\n").text(path)
    return read.select(F.xxhash64(place).alias("key"), F.col("_metadata.file_block_start").alias("block"), F.when(header, place).alias("file"), F.col("value").cast("binary").alias("value"))


class Run(NamedTuple):
    """Lines of one block one after another: a header, if one begins them, and what follows: the lines' bytes without their ends, their
    number, and the first one's length."""

    key: int
    block: int
    file: str | None
    header: bytes | None
    body: bytes
    n: int
    first: int


def runs(batches) -> Iterator[Run]:
    """The runs of batches of lines (key, block, file, value). The bytes of lines stand together in Arrow, so a run is one slice of them."""
    import numpy as np

    for b in batches:
        if not b.num_rows:
            continue
        key, block, value = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
        at = np.frombuffer(value.buffers()[1], np.int32)[value.offset : value.offset + len(value) + 1]
        data = value.buffers()[2] or pa.py_buffer(b"")
        raw = np.frombuffer(data, np.uint8)
        marked = np.zeros(len(value), bool)
        filled = np.flatnonzero(at[1:] > at[:-1])
        marked[filled] = raw[at[filled]] == ord(">")
        starts = marked.copy()
        starts[0] = True
        starts[1:] |= (key[1:] != key[:-1]) | (block[1:] != block[:-1])
        edges = np.flatnonzero(starts)
        view = memoryview(data)
        for s, e in zip(edges.tolist(), [*edges[1:].tolist(), len(value)]):
            header = bytes(view[at[s] : at[s + 1]]) if marked[s] else None
            low = s + 1 if marked[s] else s
            yield Run(int(key[s]), int(block[s]), b.column(2)[s].as_py() if marked[s] else None, header, bytes(view[at[low] : at[e]]), e - low, int(at[low + 1] - at[low]) if e > low else 0)


def pieces(batches, size: int):
    """(key, block, record, file, header, start, seq) of lines: sequences in pieces of up to size letters, without white space.

    record counts the headers of a block from 1; with 0, without file and header, are the lines before its first one. start counts
    the letters of the record in this block. Every header has a piece, an empty one where nothing follows in the block.
    """
    schema = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("record", pa.int32()), ("file", pa.string()), ("header", pa.string()), ("start", pa.int64()), ("seq", pa.string())])
    now: tuple | None = None
    names: tuple = (None, None)
    record, start, held, out, letters = 0, 0, bytearray(), [], 0

    def take(most: int) -> None:
        nonlocal start, letters
        part = bytes(held[:most])
        del held[:most]
        out.append((*now, record, *names, start, part.decode("ascii", "replace")))
        start += len(part)
        letters += len(part) + 200

    def batch() -> pa.RecordBatch:
        nonlocal letters
        done, letters = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema), 0
        out.clear()
        return done

    for run in runs(batches):
        if now != (run.key, run.block) or run.header is not None:
            if now is not None and (held or record and not start):
                take(len(held))
            record = record + 1 if now == (run.key, run.block) else int(run.header is not None)
            now, start = (run.key, run.block), 0
            names = (run.file, run.header[1:].decode("utf-8", "replace").strip()) if run.header is not None else (None, None)
        held += run.body.translate(None, BLANKS)
        while len(held) >= size:
            take(size)
            if letters > 1 << 22:
                yield batch()
        if letters > 1 << 22:
            yield batch()
    if now is not None and (held or record and not start):
        take(len(held))
    if out:
        yield batch()


def _open_records(records: DataFrame, *sums: str) -> DataFrame:
    """(key, block, of_block, of_record, file, header, before_...): for every block of records (key, block, record, file, header, sums), the record
    that is open where it begins, and what of it lies before. Blocks before a file's first header aren't there.

    Blocks are gathered to a row each, and the window that sums them up has as many rows for a file as it has splits.
    """
    head = [F.sum(F.when(F.col("record") == 0, F.col(s)).otherwise(0)).alias(f"head_{s}") for s in sums]
    blocks = records.groupBy("key", "block").agg(F.max("record").alias("n"), F.max_by(F.struct("file", "header", "record", *sums), "record").alias("tail"), *head)
    earlier = Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumns({f"ahead_{s}": F.coalesce(F.sum(f"head_{s}").over(earlier), F.lit(0)) for s in sums})
    opened = F.when(F.col("n") > 0, F.struct("block", "tail", *[(F.col(f"ahead_{s}") + F.col(f"head_{s}")).alias(f"after_{s}") for s in sums]))
    blocks = blocks.withColumn("open", F.last(opened, ignorenulls=True).over(earlier)).where("open is not null")
    before = [(F.col(f"open.tail.{s}") + F.col(f"ahead_{s}") - F.col(f"open.after_{s}")).alias(f"before_{s}") for s in sums]
    return blocks.select("key", "block", F.col("open.block").alias("of_block"), F.col("open.tail.record").alias("of_record"), "open.tail.file", "open.tail.header", *before)


def _placed(rows: DataFrame, opened: DataFrame, *sums: str) -> DataFrame:
    """rows (key, block, record, file, header, ...) with of_block, of_record and before_ columns. Only rows with record 0 belong to an earlier
    block's record and are joined with it; rows before a file's first header are left out."""
    own = rows.where("record > 0").withColumns({"of_block": F.col("block"), "of_record": F.col("record"), **{f"before_{s}": F.lit(0).cast("long") for s in sums}})
    rest = rows.where("record = 0").drop("file", "header").join(opened, ["key", "block"])
    return own.unionByName(rest)


def _placed_pieces(read: DataFrame, size: int) -> DataFrame:
    """(file, header, of_block, of_record, key, at, seq) of lines as `lines` gives them: pieces of sequences, and the letters of their record before
    each. Pieces are written once; their sums by block give their place."""
    found = written(read.mapInArrow(lambda batches: pieces(batches, size), "key long, block long, record int, file string, header string, start long, seq string"))
    sums = found.groupBy("key", "block", "record").agg(F.max("file").alias("file"), F.max("header").alias("header"), F.sum(F.length("seq").cast("long")).alias("letters"))
    rows = _placed(found, _open_records(sums, "letters"), "letters")
    return rows.select("file", "header", "of_block", "of_record", "key", (F.col("start") + F.col("before_letters")).alias("at"), "seq")


def _named(rows: DataFrame, *columns: str | Column) -> DataFrame:
    order = F.struct("file", F.col("of_block").alias("block"), F.col("of_record").alias("record"))
    return rows.select("file", "header", F.split("header", r"\s+")[0].alias("id"), order.alias("row_ord"), *columns)


def _joined() -> Column:
    """The sequence of a group's pieces."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "seq"))), lambda p: p.seq), "")


def wholes_of(read: DataFrame, size: int = CHUNK) -> DataFrame:
    """(file, header, id, row_ord, seq): chunks_of's records, each as one row, for sequences that fit one. Sequences are shuffled once."""
    rows = _placed_pieces(read, size)
    return _named(rows.groupBy("key", "of_block", "of_record").agg(F.max("file").alias("file"), F.max("header").alias("header"), _joined().alias("seq")), "seq")


def chunks_of(read: DataFrame, size: int = CHUNK) -> DataFrame:
    """(file, header, id, row_ord, chunk_no, seq) of lines as `lines` gives them: each record's sequence in chunks of size letters, an empty one
    as one empty chunk. row_ord orders records by file and place.

    No row is larger than a chunk, and a record's chunks come from all the tasks that read it. Pieces are written once; their sums by block give
    their place in the record; a piece then lies in one chunk or two, and chunks are put together by their number.
    """
    at = F.col("at")
    rows = _placed_pieces(read, size).select("file", "header", "of_block", "of_record", "key", "at", F.floor(at / size).alias("chunk_no"), (size - at % size).cast("int").alias("room"), "seq")
    first = F.struct(F.col("chunk_no").alias("chunk_no"), F.col("at").alias("at"), F.substring("seq", F.lit(1), F.col("room")).alias("seq"))
    rest = F.struct((F.col("chunk_no") + 1).alias("chunk_no"), (F.col("at") + F.col("room")).alias("at"), F.substring("seq", F.col("room") + 1, F.lit(size)).alias("seq"))
    cut = rows.select("file", "header", "of_block", "of_record", "key", F.explode(F.when(F.length("seq") > F.col("room"), F.array(first, rest)).otherwise(F.array(first))).alias("x"))
    parts = cut.select("file", "header", "of_block", "of_record", "key", "x.*")
    whole = parts.groupBy("key", "of_block", "of_record", "chunk_no").agg(F.max("file").alias("file"), F.max("header").alias("header"), _joined().alias("seq"))
    return _named(whole, F.col("chunk_no").cast("int").alias("chunk_no"), "seq")


def fasta_chunks(spark: SparkSession, path: str | Sequence[str], assembly: str, size: int = CHUNK) -> DataFrame:
    """(assembly, seqid, chunk_no, seq) of a genome's FASTA files, plain or gz: what operators.genome.slices joins."""
    return chunks_of(lines(spark, path), size).select(F.lit(assembly).alias("assembly"), F.col("id").alias("seqid"), "chunk_no", "seq")


def _measured(batches):
    """(key, block, record, file, header, letters, bytes, first, first_bytes, skipped): what a block has of a record; first is its first line's
    letters, and first_bytes that line's bytes with its end; skipped are the block's bytes before the line after the header."""
    schema = pa.schema([(n, t) for n, t in zip(("key", "block", "record", "file", "header", "letters", "bytes", "first", "first_bytes", "skipped"), (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.string(), *[pa.int64()] * 5))])
    now, row, total, out = None, None, 0, []
    for run in runs(batches):
        if now != (run.key, run.block):
            now, total, record = (run.key, run.block), 0, 0
            row = None
        if row is None or run.header is not None:
            record = record + 1 if run.header is not None else 0
            total += len(run.header) + 1 if run.header is not None else 0
            name = run.header[1:].decode("utf-8", "replace").strip() if run.header is not None else None
            row = [*now, record, run.file, name, 0, 0, None, None, total]
            out.append(row)
        if run.n and row[7] is None:
            row[7], row[8] = len(run.body[: run.first].translate(None, BLANKS)), run.first + 1
        row[5] += len(run.body.translate(None, BLANKS))
        row[6] += len(run.body) + run.n
        total += len(run.body) + run.n
        if len(out) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out[:-1]], f.type) for k, f in enumerate(schema)], schema=schema)
            del out[:-1]
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)


def fasta_index(spark: SparkSession, path: str | Sequence[str], assembly: str) -> DataFrame:
    """(assembly, path, seqid, length, offset, line_bases, line_width, regular) of plain FASTA files, as samtools' index has them: the place
    of a record's first letter in the file, and the letters and bytes of its lines.

    regular is false where the lines' bytes aren't what lines of that length would have; such a record can't be sliced by its index.
    """
    found = written(lines(spark, path).mapInArrow(_measured, "key long, block long, record int, file string, header string, letters long, bytes long, first long, first_bytes long, skipped long"))
    # a block's lines begin where the lines of the blocks before it end
    sizes = found.groupBy("key", "block").agg(F.max(F.col("skipped") + F.col("bytes")).alias("total"))
    ahead = F.sum("total").over(Window.partitionBy("key").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    begin = sizes.select("key", "block", F.coalesce(ahead, F.lit(0)).alias("begin"))
    placed = _placed(found, _open_records(found, "letters"), "letters").join(begin, ["key", "block"])
    one = placed.groupBy("file", "key", "of_block", "of_record").agg(
        F.first("header").alias("header"), F.sum("letters").alias("length"), F.sum("bytes").alias("bytes"),
        F.min_by(F.struct("first", "first_bytes"), F.when(F.col("first").isNotNull(), F.struct("block"))).alias("line"),
        F.min(F.when(F.col("record") > 0, F.col("begin") + F.col("skipped"))).alias("offset"),
    )
    bases, width = F.coalesce("line.first", F.lit(0)), F.coalesce("line.first_bytes", F.lit(0))
    full = F.when(bases > 0, F.ceil(F.col("length") / bases)).otherwise(0)
    expected = F.col("length") + full * (width - bases)
    return one.select(F.lit(assembly).alias("assembly"), F.col("file").alias("path"), F.split("header", r"\s+")[0].alias("seqid"), "length", "offset", bases.alias("line_bases"), width.alias("line_width"), (F.col("bytes") == expected).alias("regular"))
