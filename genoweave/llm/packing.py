"""Packing of tokenized documents into sequences by best-two-fit."""

from __future__ import annotations

import functools
import math
import os
import re
import sys
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, utf8, without

#: Words in the younger half of a worker's cache, after which it becomes the older half.
CACHED_WORDS = 100_000
#: A word and the ASCII signs after it. The tokenizer always parts the two, so one word isn't encoded anew for each run of signs.
TAILED = re.compile(rb"(.*(?:[a-z0-9]|\xc3[\x9f-\xb6\xb8-\xbf]))([!-/:-@\[-`{-~]+)", re.DOTALL)
#: Words that the normalizer leaves as they are and that stay whole: the merges alone make their ids.
LETTERS = re.compile("[a-zß-öø-ÿ]+")


def byte_letters() -> dict[int, int]:
    """The character by which byte-level vocabularies write each byte: itself where it is visible, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: b if b in seen else 256 + k for k, b in enumerate(sorted(set(range(256)) - set(seen)))} | {b: b for b in seen}


@functools.cache
def words_encoder(tokenizer_file: str):
    """A function from texts in UTF-8 to their ids as bytes, once in each Python worker.

    The tokenizer splits at white space before all else and its normalizer maps character by character, so the ids of a
    text are those of its words one after another. Words are looked up; new ones of letters go straight to the merges,
    others through the whole tokenizer. Texts that spell out a special token, which the tokenizer takes for the token itself
    and looks for before anything else, go through it whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from array import array
    from itertools import pairwise

    import numpy as np
    import pyarrow.compute as pc
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_file)
    merges, letters = tokenizer.model.tokenize, byte_letters()
    special = [t.content.encode().lower() for t in tokenizer.get_added_tokens_decoder().values()]
    known: dict[bytes, bytes] = {}
    older: dict[bytes, bytes] = {}

    def packed(ids: list[int]) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def learn(words: set[bytes]) -> None:
        rest = []
        for w in words:
            if w.isalpha():  # ASCII's letters, which stand for themselves
                known[w] = packed([t.id for t in merges(w.decode())])
            elif LETTERS.fullmatch(text := w.decode().lower()):
                known[w] = packed([t.id for t in merges(text.encode().decode("latin-1").translate(letters))])
            else:
                rest.append(w)
        for start in range(0, len(rest), 5000):
            part = rest[start : start + 5000]
            ids = tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            known.update((w, packed(x.ids)) for w, x in zip(part, ids))

    def recalled(words: list[bytes]) -> list[bytes]:
        """The words that aren't known; those of the older half are from now on in the younger."""
        missing = [w for w in words if w not in known]
        known.update((w, older[w]) for w in missing if w in older)
        return [w for w in missing if w not in older]

    def encode(texts: list[bytes]) -> list[bytes]:
        nonlocal known, older
        lower = [t.lower() for t in texts]
        whole = {i: packed(tokenizer.encode(texts[i].decode(), add_special_tokens=False).ids) for i, t in enumerate(lower) if any(s in t for s in special)}
        if len(known) > CACHED_WORDS:
            known, older = {}, known
        split = pc.ascii_split_whitespace(pa.array([b"" if i in whole else t for i, t in enumerate(lower)], pa.string()))
        each = split.flatten().dictionary_encode()
        word_at, data = each.dictionary.buffers()[1:]
        bounds, data = np.frombuffer(word_at or b"", np.int32)[: len(each.dictionary) + 1].tolist(), (data or b"") and data.to_pybytes()
        words = [data[a:b] for a, b in pairwise(bounds)]  # each once
        tailed = {w: m.groups() for w in recalled(words) if (m := TAILED.fullmatch(w))}
        learn(set(recalled([x for w in words for x in tailed.get(w, (w,))])))
        known.update((w, known[a] + known[b]) for w, (a, b) in tailed.items())
        ids = pa.array(map(known.__getitem__, words), pa.large_binary()).take(each.indices)
        # where each text's words begin, and where their ids do
        at = np.frombuffer(ids.buffers()[1], np.int64)[split.offsets.to_numpy()] if len(ids) else np.zeros(len(texts) + 1, np.int64)
        packed_ids = memoryview(ids.buffers()[2] or b"")
        return [whole[i] if i in whole else bytes(packed_ids[at[i] : at[i + 1]]) for i in range(len(texts))]

    return encode


def token_pieces(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most capacity tokens: id_col, piece int, start long, length long, ids binary (little-endian u32).

    A document is its text's ids, without special tokens, and then end_id; only longer ones are cut. A null text counts as
    empty and so is end_id alone. Each row is cut on its own: repeated rows give repeated pieces, an empty table none.
    """

    def run(batches):
        encode, end, most = words_encoder(tokenizer_file), end_id.to_bytes(4, "little"), 4 * capacity
        for b in batches:
            at, piece, start, length, ids = [], [], [], [], []
            texts = b.column(1).to_pylist()
            for i, doc in enumerate(encode(texts)):
                doc += end
                for k, s in enumerate(range(0, len(doc), most)):
                    at.append(i)
                    piece.append(k)
                    start.append(s // 4)
                    ids.append(doc[s : s + most])
                    length.append(len(ids[-1]) // 4)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())], ["id", "piece", "start", "length", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("t")).mapInArrow(run, f"id {kind}, piece int, start long, length long, ids binary").withColumnRenamed("id", id_col)


def best_two_fit(counts: dict[int, int], capacity: int) -> list[tuple[list[int], int]]:
    """Bins for so many documents of each length: (lengths in a bin, how many bins are filled like it).

    A bin takes the longest document left, then ever the longest that still fits. Then its smallest document gives way
    to the two unpacked ones that fill the gap so widened most tightly, if they fill more than it did. The same
    bin is filled as often as the counts allow, so the work follows the number of lengths and not that of documents.
    """
    import numpy as np

    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} doesn't fit a sequence of {capacity}")
        left[length] = n
    out = []
    while (there := np.flatnonzero(left)).size:
        free, use, gap = left.copy(), Counter(), capacity
        while gap and (fits := there[(there <= gap) & (free[there] > 0)]).size:
            length = int(fits[-1])
            n = min(int(free[length]), gap // length)
            use[length] += n
            free[length] -= n
            gap -= n * length
        if gap:
            small = min(use)
            free[small] += 1
            have = np.flatnonzero(free[: gap + small + 1])
            # the largest partner for each length a >= b, with a + b at most the widened gap
            best, pair = small, None
            at = np.searchsorted(have, np.minimum(gap + small - have, have), side="right") - 1
            for a, i in zip(have[::-1].tolist(), at[::-1].tolist()):
                if i >= 0 and have[i] == a and free[a] < 2:
                    i -= 1
                if i >= 0 and a + int(have[i]) > best:
                    best, pair = a + int(have[i]), (a, int(have[i]))
            if pair:
                use[small] -= 1
                use.update(pair)
        use = +use
        n = min(int(left[k]) // v for k, v in use.items())
        for k, v in use.items():
            left[k] -= n * v
        out.append((sorted(use.elements(), reverse=True), n))
    return out


def pack(pieces: DataFrame, capacity: int = 2048, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), salt_rows: int = 100_000) -> DataFrame:
    """pieces with sequence_id and offset added: as few sequences of at most capacity tokens as best-two-fit finds.

    Lengths are 1 to capacity, anything else (null too) raises an error. The bins are planned on the number of pieces of each
    length, at most capacity figures whatever the input; then each piece takes the place of its rank among those of its
    length. Ranks are counted in salted groups of about salt_rows, so one length may hold any share of the pieces.
    Rows are never merged: repeated rows each get a place. Columns named sequence_id or offset are replaced. An
    empty table gives no rows. pieces is read twice: give a table or a checkpoint.
    """
    import numpy as np

    pieces = without(pieces, "sequence_id", "offset", "g_salt", "g_rank", "g_before")
    counts = {r[0]: r[1] for r in pieces.groupBy(F.coalesce(F.col(length_col), F.lit(0))).count().collect()}
    starts, firsts, offsets = [], [], []
    ranks, sequences = Counter(), 0
    for lengths, n in best_two_fit(counts, capacity):
        offset = 0
        for length in lengths:
            starts.append(length * (1 << 42) + ranks[length])
            firsts.append(sequences)
            offsets.append(offset)
            ranks[length] += n
            offset += length
        sequences += n
    starts, firsts, offsets = (np.array(x, dtype=np.int64) for x in (starts, firsts, offsets))
    by = np.argsort(starts)
    starts, firsts, offsets = starts[by], firsts[by], offsets[by]

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        key = length.to_numpy(zero_copy_only=False).astype(np.int64) * (1 << 42) + rank.to_numpy(zero_copy_only=False)
        at = np.searchsorted(starts, key, side="right") - 1
        return pa.StructArray.from_arrays([pa.array(firsts[at] + key - starts[at]), pa.array(offsets[at])], ["sequence_id", "offset"])

    salts = max(8, math.ceil(max(counts.values(), default=0) / salt_rows))
    salted = pieces.withColumn("g_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sums = salted.groupBy(length_col, "g_salt").count()
    before = F.sum("count").over(Window.partitionBy(length_col).orderBy("g_salt").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(length_col, "g_salt", F.coalesce(before, F.lit(0)).alias("g_before"))
    ranked = salted.withColumn("g_rank", F.row_number().over(Window.partitionBy(length_col, "g_salt").orderBy(*order)) - 1)
    placed = ranked.join(sums, [length_col, "g_salt"]).withColumn("g_rank", place(F.col(length_col), F.col("g_rank") + F.col("g_before")))
    return placed.select(*pieces.columns, "g_rank.sequence_id", "g_rank.offset")


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text", ids_digest: bool = False) -> DataFrame:
    """docs tokenized, cut into pieces and packed: id_col, piece, start, length, ids, sequence_id, offset.

    With ids_digest, ids gives way to ids_crc32 (long, unsigned) before anything is shuffled. See token_pieces and pack.
    """
    pieces = token_pieces(docs, tokenizer_file, capacity, id_col=id_col, text_col=text_col)
    if ids_digest:
        pieces = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return pack(cut(pieces), capacity, order=(id_col, "piece"))
