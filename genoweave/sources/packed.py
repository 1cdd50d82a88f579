"""Texts out of zip, tar and gz files, and plain ones, read on the executors in pieces, with a row for each file that can't be read.

A zip file's directory and a tar file's headers are read first, and members go to tasks one by one. A compressed tar file is a stream of
one task. No task holds more of a text than a piece. Paths are those of file systems that pyarrow knows.
"""

from __future__ import annotations

import tarfile
import zipfile
import zlib
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import written
from . import records

#: Bytes of a piece, of a line that is cut although it hasn't ended, and of a plain file that one task reads.
PIECE, LONGEST_LINE, SPLIT = 1 << 20, 1 << 24, 1 << 26
FAILURES = (OSError, EOFError, zlib.error, tarfile.TarError, zipfile.BadZipFile, NotImplementedError, RuntimeError, ValueError)
ENTRY = "file string, member string, kind string, start long, size long, error string"
TEXT = "file string, member string, block long, part long, text string, error string"


def opened(path: str):
    """A file of any file system that pyarrow knows, to read anywhere in it. Spark's ways to write a local path are known too."""
    from pyarrow import fs

    if path.startswith("file:///"):
        return fs.LocalFileSystem().open_input_file(unquote(path[7:]))
    if path.startswith("file:/") or "://" not in path:
        return fs.LocalFileSystem().open_input_file(path.removeprefix("file:"))
    system, place = fs.FileSystem.from_uri(path)
    return system.open_input_file(place)


def _kind(path: str) -> str:
    low = path.lower()
    return next((k for k, ends in (("zip", (".zip",)), ("tgz", (".tgz", ".tar.gz", ".tar.bz2", ".tar.xz")), ("tar", (".tar",)), ("gz", (".gz",))) if low.endswith(ends)), "plain")


def _entries(path: str, length: int, suffixes: tuple[str, ...], split: int) -> Iterator[tuple]:
    kind = _kind(path)
    if kind == "zip":
        with opened(path) as f, zipfile.ZipFile(f) as z:
            yield from ((path, m.filename, kind, 0, m.file_size) for m in z.infolist() if m.filename.lower().endswith(suffixes))
    elif kind == "tar":
        with opened(path) as f, tarfile.open(fileobj=f, mode="r:") as t:  # goes from header to header
            yield from ((path, m.name, kind, m.offset_data, m.size) for m in t if m.isfile() and m.name.lower().endswith(suffixes))
    elif kind == "plain":
        yield from ((path, None, kind, start, min(split, length - start)) for start in range(0, length, split))
    else:
        yield path, None, kind, 0, length


def entries(spark: SparkSession, path: str | Sequence[str], suffixes: Sequence[str], split: int = SPLIT) -> DataFrame:
    """(file, member, kind, start, size, error): what a task reads at a time. A file whose directory can't be read is a row with the error."""
    ends = tuple(suffixes)

    def run(batches):
        for b in batches:
            out = []
            for file, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                try:
                    for e in _entries(file, length, ends, split):
                        out.append((*e, None))
                        if len(out) >= 10_000:
                            yield _batch(out, ENTRY)
                            out = []
                except FAILURES as e:
                    out.append((file, None, _kind(file), 0, 0, str(e) or type(e).__name__))
            yield _batch(out, ENTRY)

    listed = spark.read.format("binaryFile").load(path).select("path", "length")  # contents aren't read
    return listed.mapInArrow(run, ENTRY)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])


def _pieces(stream, size: int) -> Iterator[bytes]:
    """A stream's bytes in pieces of about `size` that end with lines, without the last line's end. What was read before a failure is given first."""
    held = bytearray()
    while True:
        try:
            data = stream.read(size)
        except FAILURES:
            if held:
                yield bytes(held)
            raise
        held += data
        cut = held.rfind(b"\n") if not data or len(held) >= size else -1
        if data and cut >= 0:
            yield bytes(held[:cut])
            del held[: cut + 1]
        elif held and (not data or len(held) >= LONGEST_LINE):
            yield bytes(held.removesuffix(b"\n") if not data else held)
            held.clear()
        if not data:
            return


class _Inflated:
    """A gz stream, which gives all that can be inflated before it fails."""

    def __init__(self, f):
        self.f, self.inside, self.left = f, None, b""

    def read(self, n: int) -> bytes:
        while True:
            data = self.left or self.f.read(1 << 16)
            if not data:
                if self.inside is not None:
                    raise EOFError("the file ends inside a gz stream")
                return b""
            self.inside = self.inside or zlib.decompressobj(wbits=31)
            out = self.inside.decompress(data, n)
            self.left = self.inside.unconsumed_tail
            if self.inside.eof:
                self.left, self.inside = self.inside.unused_data.lstrip(b"\0"), None
            if out:
                return out


class _Split:
    """The lines that begin in [start, start + size) of a file, as a stream."""

    def __init__(self, f, start: int, size: int):
        self.f, self.end, self.at = f, start + size, start
        f.seek(max(start - 1, 0))
        if start:
            self._to_line_end()
        self.over = self.at >= self.end

    def _to_line_end(self) -> bytes:
        """What is left of the line; the file stands after its end then."""
        begin, found = self.f.tell(), b""
        while data := self.f.read(1 << 16):
            cut = data.find(b"\n")
            if cut >= 0:
                found += data[: cut + 1]
                break
            found += data
        self.at = begin + len(found)
        self.f.seek(self.at)
        return found

    def read(self, n: int) -> bytes:
        if self.over:
            return b""
        data = self.f.read(min(n, self.end - self.at))
        self.at += len(data)
        if self.at >= self.end or not data:
            self.over = True
            if data and not data.endswith(b"\n"):
                data += self._to_line_end()
        return data


def _texts(file: str, member: str | None, kind: str, start: int, size: int, suffixes: tuple[str, ...], piece: int) -> Iterator[tuple[str | None, Iterator[bytes]]]:
    """The members of an entry, each with its pieces."""

    def inflated(name: str, stream):
        return _Inflated(stream) if name.lower().endswith(".gz") else stream

    with opened(file) as f:
        if kind == "zip":
            with zipfile.ZipFile(f) as z, z.open(member) as m:
                yield member, _pieces(inflated(member, m), piece)
        elif kind == "tgz":
            with tarfile.open(fileobj=f, mode="r|*") as t:
                for m in t:
                    if m.isfile() and m.name.lower().endswith(suffixes):
                        yield m.name, _pieces(inflated(m.name, t.extractfile(m)), piece)
        elif kind == "gz":
            yield None, _pieces(_Inflated(f), piece)
        elif kind == "tar":
            f.seek(start)
            yield member, _pieces(inflated(member, _Part(f, size)), piece)
        else:
            yield None, _pieces(_Split(f, start, size), piece)


class _Part:
    """The next `size` bytes of a file as a stream."""

    def __init__(self, f, size: int):
        self.f, self.left = f, size

    def read(self, n: int = -1) -> bytes:
        data = self.f.read(self.left if n < 0 else min(n, self.left))
        if not data and self.left:
            raise EOFError("the file ends inside a member")
        self.left -= len(data)
        return data


def text_pieces(spark: SparkSession, path: str | Sequence[str], suffixes: Sequence[str] = ("",), piece: int = PIECE, split: int = SPLIT) -> DataFrame:
    """(file, member, block, part, text, error) of files and, of archives, the members with the suffixes: texts in pieces of whole lines.

    block counts the bytes before a plain file's split, and part the pieces of a block. A file or member that
    can't be read, or not to its end, gives what was read and a row with the error; the others aren't touched. Written once, so that
    rows and errors come of the same reading.
    """
    ends = tuple(suffixes)

    def run(batches):
        for b in batches:
            for file, member, kind, start, size, error in zip(*(c.to_pylist() for c in b.columns)):
                if error is not None:
                    yield _batch([(file, None, 0, 0, None, error)], TEXT)
                    continue
                name, part = member, 0
                try:
                    for name, found in _texts(file, member, kind, start, size, ends, piece):
                        for part, data in enumerate(found):
                            yield _batch([(file, name, start, part, data.decode("utf-8", "replace"), None)], TEXT)
                except FAILURES as e:
                    yield _batch([(file, name, start, part + 1, None, str(e) or type(e).__name__)], TEXT)

    # one entry after another in a task's batch: entries are dealt out one by one
    dealt = entries(spark, path, ends, split).repartition("file", "member", "start")
    return written(dealt.mapInArrow(run, TEXT))


def failures(pieces: DataFrame) -> DataFrame:
    """(file, member, error) of text_pieces."""
    return pieces.where("error is not null").select("file", "member", "error")


def lines(pieces: DataFrame) -> DataFrame:
    """The lines of text_pieces as sources.records reads them. Each piece is a block of its own, so a long text is many tasks' from here on."""
    name = F.concat_ws("/", "file", "member")
    block = F.col("block") + F.col("part")  # a split has fewer pieces than bytes
    spread = pieces.where("error is null").select(F.xxhash64("file", "member").alias("key"), block.alias("block"), name.alias("name"), F.explode(F.split("text", "\n")).alias("value"))
    return spread.select("key", "block", F.when(F.col("value").startswith(">"), F.col("name")).alias("file"), F.col("value").cast("binary").alias("value"))


def fasta(pieces: DataFrame, size: int = records.CHUNK) -> DataFrame:
    """(file, header, id, row_ord, chunk_no, seq) of text_pieces' FASTA records, in chunks. A record that an error cuts short has what was read."""
    return records.chunks_of(lines(pieces), size)


def whole_fasta(pieces: DataFrame) -> DataFrame:
    """fasta's records, each as one row, without chunk_no."""
    return records.wholes_of(lines(pieces))
