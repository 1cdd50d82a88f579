"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import functools
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8, without

#: Texts over so many characters are cut at safe boundaries before they are encoded.
LONG_CHARS = 50_000
#: Before a blank that follows a visible ASCII sign, and between ASCII letters and digits: no match of the pattern goes across.
SAFE = re.compile(r"(?<=[!-~])(?=[ \t\n])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")


@functools.cache
def encoding(rank_file: str, pattern: str):
    """The tiktoken encoding of a rank file, once in each Python worker."""
    import tiktoken

    with open(rank_file, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def safe_parts(text: str, most: int = LONG_CHARS) -> Iterator[str]:
    """text in parts of about `most` characters, cut where the pattern never matches across. A stretch without such a place stays whole."""
    start = 0
    while len(text) - start > most:
        found = SAFE.search(text, start + most)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encode_text(enc, pattern: str, text: str) -> bytes:
    """The ids of a text as little-endian unsigned 32-bit integers."""
    import numpy as np

    out = []
    for part in safe_parts(text) if len(text) > LONG_CHARS else (text,):
        try:
            ids = enc.encode_to_numpy(part, disallowed_special=())
        except BaseException as e:  # its regex engine gives up on very long runs; the panic isn't an Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, MemoryError)):
                raise
            import regex

            ids = [i for m in regex.finditer(pattern, part) for i in enc._encode_single_piece(m[0])]
        out.append(np.asarray(ids, dtype="<u4").tobytes())
    return b"".join(out)


def encode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every text's ids: id_col, n_tokens long, ids binary (little-endian unsigned 32-bit integers).

    Every match of pattern is encoded on its own, without special tokens; whole texts, of any length, row by row,
    without a shuffle. A null text counts as empty and has no ids. Repeated rows, null ids and extra columns are
    allowed: each row gives one row, and other columns are not returned. An empty table gives no rows.
    rank_file must be at the same place on every executor; it is read once in each Python worker.
    """

    def run(batches):
        enc = encoding(rank_file, pattern)
        for b in batches:
            ids = [encode_text(enc, pattern, t.decode()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).mapInArrow(run, f"id {kind}, n long, ids binary").toDF(id_col, "n_tokens", "ids")


def decode(encoded: DataFrame, rank_file: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """encoded with a column more: the bytes that its ids stand for, binary. Ids of no token raise an error.

    The bytes are those of the tokens one after another: cut at any id they need not be whole UTF-8 characters,
    so they aren't made a string here. Null ids give no bytes. A column of the new name is replaced.
    """

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        import numpy as np

        enc = encoding(rank_file, pattern)
        return pa.array([enc.decode_bytes(np.frombuffer(x.as_py() or b"", dtype="<u4").tolist()) for x in ids], pa.binary())

    return without(encoded, out_col).withColumn(out_col, run(ids_col))
