"""Quality rules by compression bands: zstandard ratios over whole documents and over fixed chunks."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


@dataclass(frozen=True)
class Bands:
    """Limits of compressed size over size, for documents of up to so many bytes.

    A whole document under low is repetitive, over high incompressible. Chunks are held against the limits of their
    own length; a document is rejected if over chunk_share of its chunks' bytes lie outside.
    """

    level: int = 3
    chunk_bytes: int = 4096
    least_bytes: int = 200
    chunk_share: float = 0.5
    #: (up to so many bytes, low, high), ascending; the last one holds for all beyond.
    bands: tuple[tuple[float, float, float], ...] = (
        (500, 0.48, 0.85),
        (1000, 0.46, 0.80),
        (2000, 0.445, 0.70),
        (4500, 0.415, 0.63),
        (20000, 0.385, 0.58),
        (100_000, 0.355, 0.54),
        (500_000, 0.335, 0.54),
        (float("inf"), 0.31, 0.54),
    )

    def of(self, size: int) -> tuple[float, float]:
        return next((low, high) for most, low, high in self.bands if size <= most)


def base_counts(raw: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text in UTF-8."""
    import numpy as np

    text = raw.decode()
    words = raw.split()  # of bytes: at the six blanks of ASCII and no others
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = 0
    if len(words) >= 4:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
        pairs = ids[:-1] * len(number) + ids[1:]
        if len(number) >= 1 << 20:
            pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
        _, at, n = np.unique(pairs[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
        twice = n[at] > 1
        held = np.zeros(len(words), dtype=bool)
        for k in range(3):
            held[k : k + len(twice)] |= twice
        repeat = int(held.sum())
    return len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup, repeat


def ratios(raw: bytes, compress, bands: Bands) -> tuple[float, float]:
    """Compressed size over size of the whole text, and the share of its chunks' bytes that lie outside their bands."""
    if not raw:
        return 0.0, 0.0
    whole = len(compress(raw)) / len(raw)
    if len(raw) <= bands.chunk_bytes:
        return whole, 0.0
    bad = 0
    for start in range(0, len(raw), bands.chunk_bytes):
        chunk = raw[start : start + bands.chunk_bytes]
        if len(chunk) >= bands.least_bytes:
            low, high = bands.of(len(chunk))
            bad += len(chunk) * (not low <= len(compress(chunk)) / len(chunk) <= high)
    return whole, bad / len(raw)


def judged(raw: bytes, compress, bands: Bands) -> tuple:
    """What compression_rules returns of a text, in the order of NAMES."""
    counts = base_counts(raw)
    failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
    whole, bad = ratios(raw, compress, bands)
    low, high = bands.of(len(raw))
    good = len(raw) < bands.least_bytes or (low <= whole <= high and bad <= bands.chunk_share)
    return (*counts, failed, whole, bad, not failed and good)


def compressor(bands: Bands):
    import zstandard

    return zstandard.ZstdCompressor(level=bands.level, write_content_size=False).compress


def compression_rules(docs: DataFrame, bands: Bands = Bands(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, ratio, bad_share, kept.

    base_failed: under 50 words, or over half of the words in 3-word windows that come twice or more. kept is false for
    these, and where the ratio of the whole text or of too many chunks is outside the limits of its length. Under
    bands.least_bytes only the base rules judge. A null text counts as empty, and so fails. Each row gives one row, without
    a shuffle; repeated rows, null ids and extra columns (not returned) are allowed. An empty table gives no rows.
    """

    def run(batches):
        compress = compressor(bands)
        for b in batches:
            rows = [judged(raw, compress, bands) for raw in b.column(1).to_pylist()]
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
            cols = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], ["id", *NAMES])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, ratio double, bad_share double, kept boolean"
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, bands: Bands = Bands(), text_col: str = "text") -> DataFrame:
    """The rows of docs that compression_rules keeps, with all their columns, row by row."""

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        compress = compressor(bands)
        return pa.array([judged((t.as_py() or "").encode(), compress, bands)[-1] for t in texts], pa.bool_())

    return docs.where(good(text_col))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "ratio", "bad_share", "kept"]
