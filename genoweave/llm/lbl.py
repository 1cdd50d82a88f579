"""LM scoring by a log-bilinear neural model, trained in numpy with noise-contrastive estimation, and corpus counts that follow the input.

A token's probability is P(unit | the words before) x P(word | unit). Units are what the network tells apart: the end of a text, the most
frequent words, and classes of words with the same ending. Words share a unit by their counts in all training texts, with one more for
each known word and one for all unknown ones, so the probabilities of all tokens, an unknown one of each unit included, sum up to one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import TYPE_CHECKING

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import utf8, written

if TYPE_CHECKING:
    import numpy as np

#: Of a signature, the low 8 bits are the class of the word's ending; the 16 bits above them its input row.
CLASS_BITS = 8
END, END_SIGNATURE = b"", 1 << 24
#: A text is cut up into words so many bytes at a time.
SLICE_BYTES = 1 << 20
BLANK = re.compile(rb"[\t-\r ]")


@dataclass(frozen=True)
class Shape:
    """inputs: rows of word vectors, shared by hash; width: of a vector; context: words before; tops: units of the most frequent words;
    endings: units of the others, by a hash of their last three bytes; noise: noise units a batch; batch: tokens a step; rate: of learning;
    rounds: eighths of the texts trained on before the tasks' models are averaged; all texts are in one of them.

    A section is texts, or a part of a long one, with about section_words different words, section_tokens tokens or section_bytes
    bytes. A training task takes about task_tokens.
    """

    inputs: int = 65535
    width: int = 16
    context: int = 4
    tops: int = 95
    endings: int = 160
    noise: int = 32
    batch: int = 2048
    rate: float = 0.1
    rounds: tuple[int, ...] = (1, 3, 4)
    section_words: int = 1 << 18
    section_bytes: int = 1 << 26
    section_tokens: int = 1 << 22
    task_tokens: int = 1 << 26

    @property
    def units(self) -> int:
        return 1 + self.tops + self.endings


def held_out(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    """Rows that nothing is learned from; a null id's text is empty."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


# ---- texts as numbers ----


def signature(word: bytes, shape: Shape) -> int:
    """The unit of a word and its input row are functions of this."""
    return signatures([word], shape)[0]


def signatures(words: list[bytes], shape: Shape) -> list[int]:
    from xxhash import xxh32_intdigest, xxh64_intdigest

    inputs, endings = shape.inputs, shape.endings
    return [END_SIGNATURE if w == END else xxh64_intdigest(w) % inputs << CLASS_BITS | xxh32_intdigest(w[-3:]) % endings for w in words]


def slices(raw: bytes):
    """A text in pieces that end after a blank."""
    at = 0
    while at < len(raw):
        found = BLANK.search(raw, at + SLICE_BYTES) if len(raw) - at > SLICE_BYTES else None
        end = found.end() if found else len(raw)
        yield raw[at:end]
        at = end


class Words:
    """The words of a few texts, A-Z in lower case: those of text k are ids[ends[k]:ends[k + 1]], numbers in the list of different words."""

    def __init__(self, texts: pa.Array):
        import numpy as np
        import pyarrow.compute as pc

        texts = texts.cast(pa.binary())
        plain = pa.StringArray.from_buffers(len(texts), texts.buffers()[1], texts.buffers()[2], offset=texts.offset)  # bytes of any kind: the kernels look at ASCII only
        parts = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        flat, self.ends = parts.flatten(), parts.offsets.to_numpy() - parts.offsets[0].as_py()
        some = pc.not_equal(pc.binary_length(flat), 0)  # blanks at an end have empty words beside them
        self.ends = np.concatenate(([0], np.cumsum(some.to_numpy(zero_copy_only=False))))[self.ends]
        coded = flat.filter(some).dictionary_encode()
        self.ids, found = coded.indices.to_numpy(), coded.dictionary
        at = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1].tolist() if len(found) else [0]
        raw = found.buffers()[2].to_pybytes() if at[-1] else b""
        self.words = [raw[s:e] for s, e in zip(at, at[1:])]


def runs(texts: pa.Array):
    """(first text, texts, whether they end there): texts side by side, and long ones alone, piece by piece."""
    import numpy as np
    import pyarrow.compute as pc

    begin = 0
    for k in [*np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > SLICE_BYTES).tolist(), len(texts)]:
        if k > begin:
            yield begin, texts.slice(begin, k - begin), True
        if k < len(texts):
            at, raw = 0, texts[k].as_buffer().to_pybytes()
            for piece in slices(raw):
                at += len(piece)
                yield k, pa.array([piece], pa.binary()), at == len(raw)
        begin = k + 1


SECTION = "section long, words array<binary>, counts array<int>, signatures array<int>, ids binary, rows array<long>, docs array<{kind}>, held array<boolean>, lens array<int>, carries array<int>"


def sections(docs: DataFrame, shape: Shape, id_col: str, text_col: str) -> DataFrame:
    """Texts as sections, a row each: the different words with their counts in training texts and signatures; the texts' words as
    numbers in this list, packed; and of each text, or part of one, its row, id, fold, length, and how many of its numbers are
    words before it that are in the section before."""

    def run(batches):
        import numpy as np
        import pyarrow.compute as pc
        from pyspark import TaskContext
        from zstandard import ZstdCompressor

        first = TaskContext.get().partitionId() << 33
        schema = None

        class Section:
            def __init__(self):
                self.numbers, self.parts, self.pieces, self.tokens, self.bytes = {END: 0}, [], [], 0, 0
                self.words, self.known = None, None  # the words that were added last, and their numbers here, -1 for those without

            def numbered(self, words: list[bytes]) -> list[int]:
                numbers = self.numbers
                return [numbers.setdefault(w, len(numbers)) for w in words]

            def add(self, words: list[bytes]):
                self.parts.append(np.array(self.numbered(words), np.uint32))
                self.tokens += len(words)

            def add_text(self, words: Words, ids: np.ndarray, size: int):
                if self.words is not words:
                    self.words, self.known = words, np.full(len(words.words), -1, np.int64)
                numbers = self.known[ids]
                new = list(dict.fromkeys(ids[numbers < 0].tolist()))
                if new:
                    self.known[new] = self.numbered([words.words[w] for w in new])
                    numbers = self.known[ids]
                self.parts.append(numbers.astype(np.uint32))
                self.tokens += len(ids)
                self.bytes += size

            def full(self) -> bool:
                return len(self.numbers) >= shape.section_words or self.tokens >= shape.section_tokens or self.bytes >= shape.section_bytes

            def row(self, number: int) -> pa.RecordBatch:
                ids = np.concatenate(self.parts)
                words = list(self.numbers)
                carries, lens, held = (np.array([p[k] for p in self.pieces], t) for k, t in ((3, np.int64), (4, np.int64), (2, bool)))
                learned = np.repeat(~held, carries + lens) & (np.arange(len(ids)) - np.repeat(np.cumsum(carries + lens) - carries - lens, carries + lens) >= np.repeat(carries, carries + lens))
                columns = [number, words, np.bincount(ids[learned], minlength=len(words)), signatures(words, shape), ZstdCompressor(level=1).compress(ids.tobytes()), *[[p[k] for p in self.pieces] for k in range(3)], lens, carries]
                return pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(columns, schema)], schema=schema)

        now = Section()
        for b in batches:
            if schema is None:
                kinds = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(b.column(1).type), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                schema = pa.schema(list(zip(["section", "words", "counts", "signatures", "ids", "rows", "docs", "held", "lens", "carries"], kinds)))
            keys, begun = [b.column(c).to_pylist() for c in range(3)], None
            for begin, texts, last in runs(b.column(3)):
                words, sizes = Words(texts), pc.binary_length(texts).to_pylist()
                ends = words.ends.tolist()
                for k in range(len(texts)):
                    if begun != begin + k:
                        begun, start, carry = begin + k, now.tokens, 0
                        own, recent = [c[begun] for c in keys], []
                    ids = words.ids[ends[k] : ends[k + 1]]
                    if now.full() and now.tokens > start + carry and len(ids):  # a long text goes on in a new section
                        now.pieces.append((*own, carry, now.tokens - start - carry))
                        yield now.row(first)
                        first, now, start, carry = first + 1, Section(), 0, len(recent)
                        now.add(recent)
                    now.add_text(words, ids, sizes[k])
                    if not last:
                        recent = [*recent, *(words.words[w] for w in ids[-shape.context :])][-shape.context :]
                        continue
                    now.add([END])
                    now.pieces.append((*own, carry, now.tokens - start - carry))
                    if now.full():
                        yield now.row(first)
                        first, now = first + 1, Section()
        if now.pieces:
            yield now.row(first)

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), held_out(id_col).alias("held"), utf8(text_col).alias("text"))
    return rows.mapInArrow(run, SECTION.format(kind=kind))


def counted(cut: DataFrame) -> DataFrame:
    """(section, ix, signature, n, once) of every section's words: n is a word's count in all training texts, once holds in one of its rows.

    A section has a word once, so a word's rows are at most as many as there are sections, each of very many words: no key is hot.
    """
    zipped = F.posexplode(F.arrays_zip("words", "counts", "signatures")).alias("ix", "w")
    rows = cut.select("section", zipped).select("section", "ix", F.col("w.words").alias("word"), F.col("w.counts").alias("n"), F.col("w.signatures").alias("signature"))
    own = Window.partitionBy("word").orderBy("section")
    every = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select("section", "ix", "signature", F.sum(F.col("n").cast("long")).over(every).alias("n"), (F.row_number().over(own) == 1).alias("once"))


# ---- the network ----


@dataclass
class Counts:
    """tops: the signatures with units of their own, ascending; top_units: these units; endings: the first unit of endings; tokens and
    words: how many tokens and different words of each unit the training texts have."""

    tops: np.ndarray
    top_units: np.ndarray
    endings: int
    tokens: np.ndarray
    words: np.ndarray

    def units(self, signatures: np.ndarray) -> np.ndarray:
        import numpy as np

        out = (self.endings + (signatures & (1 << CLASS_BITS) - 1)).astype(np.uint16)
        if len(self.tops):
            at = np.minimum(np.searchsorted(self.tops, signatures), len(self.tops) - 1)
            found = self.tops[at] == signatures
            out[found] = self.top_units[at[found]]
        out[signatures == END_SIGNATURE] = 0
        return out


def unit_counts(words: DataFrame, shape: Shape) -> tuple[Counts, int, int]:
    """(counts, tokens, different words) of the training texts; the driver gets as many rows as there are units."""
    import numpy as np

    once = words.where("once")
    kinds = written(once.groupBy("signature").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("words")))
    top = [r["signature"] for r in kinds.where((F.col("signature") != END_SIGNATURE) & (F.col("n") > 0)).orderBy(F.desc("n"), "signature").limit(shape.tops).collect()]
    own = F.when(F.col("signature") == END_SIGNATURE, 0)
    for k, s in enumerate(top):
        own = own.when(F.col("signature") == s, k + 1)
    unit = own.otherwise(1 + shape.tops + F.col("signature").bitwiseAND(F.lit((1 << CLASS_BITS) - 1)))
    tokens, kinds_of = np.zeros(shape.units, np.int64), np.zeros(shape.units, np.int64)
    for r in kinds.groupBy(unit.alias("unit")).agg(F.sum("n").alias("n"), F.sum("words").alias("words")).collect():
        tokens[r["unit"]], kinds_of[r["unit"]] = r["n"], r["words"]
    order = np.argsort(np.array(top, np.int64))
    counts = Counts(np.array(top, np.int64)[order], (np.arange(len(top)) + 1)[order], 1 + shape.tops, tokens, kinds_of)
    return counts, int(tokens.sum()), int(kinds_of.sum())


class Network:
    """The parameters: vectors of input rows (the last for what stands before a text), a weight for each place and dimension, vectors
    and biases of units. A unit's score is its bias, and the product of its vector with the weighted sum of the words' vectors.

    Each has sums of squared gradients beside it, by which its steps shrink (Adagrad).
    """

    NAMES = ("inputs", "places", "outputs", "biases")

    def __init__(self, shape: Shape, counts: Counts):
        import numpy as np

        rng = np.random.default_rng(1)
        noise = (counts.tokens + 1) / (counts.tokens + 1).sum()
        self.shape, self.log_noise, self.noise_sums = shape, np.log(noise).astype(np.float32), np.cumsum(noise)
        self.inputs = (rng.standard_normal((shape.inputs + 1, shape.width)) * 0.1).astype(np.float32)
        self.outputs = (rng.standard_normal((shape.units, shape.width)) * 0.1).astype(np.float32)
        self.places = np.ones((shape.context, shape.width), np.float32)
        self.biases = self.log_noise.copy()
        self.squares = {"inputs": len(self.inputs), "places": self.places.shape, "outputs": shape.units, "biases": shape.units}
        self.squares = {k: np.full(v, 1e-3, np.float32) for k, v in self.squares.items()}

    def copy(self) -> Network:
        import copy

        out = copy.copy(self)
        for n in self.NAMES:
            setattr(out, n, getattr(self, n).copy())
        out.squares = {k: v.copy() for k, v in self.squares.items()}
        return out

    def hidden(self, before: np.ndarray) -> np.ndarray:
        """For rows of input rows, the nearest word's first: the predicted vectors."""
        h = rows_of(self.inputs, before[:, 0])
        h *= self.places[0]
        for k in range(1, self.shape.context):
            e = rows_of(self.inputs, before[:, k])
            e *= self.places[k]
            h += e
        return h

    def log_probabilities(self, before: np.ndarray, units: np.ndarray) -> np.ndarray:
        """Natural logarithms of P(unit | before), normalised over all units, by products of matrices."""
        import numpy as np

        out, step = np.empty(len(units)), 1024  # what a step works on stays in the processor's cache
        by_unit, room = np.ascontiguousarray(self.outputs.T), np.empty((step, self.shape.units), np.float32)
        with np.errstate(over="ignore", invalid="ignore"):
            powers = np.exp(self.biases)
            for s in range(0, len(units), step):
                part = slice(s, s + step)
                scores = np.matmul(self.hidden(before[part]), by_unit, out=room[: len(units) - s])
                own = scores[np.arange(len(scores)), units[part]] + self.biases[units[part]]
                total = np.exp(scores, out=scores) @ powers
                out[part] = own - np.log(np.where(total > 0, total, 1))
                far = np.flatnonzero(~((total > 1e-30) & (total < 1e30)))
                if far.size:  # scores too far from logarithms of probabilities for their powers: the highest is taken off first
                    scores = self.hidden(before[part][far]) @ by_unit + self.biases
                    high = scores.max(axis=1)
                    out[s + far] = own[far] - high - np.log(np.exp(scores - high[:, None]).sum(axis=1))
        return out

    def _step(self, name: str, rows, gradient: np.ndarray, by_row: bool) -> None:
        import numpy as np

        squares, values = self.squares[name], getattr(self, name)
        taken = lambda table: table[rows] if isinstance(rows, slice) else rows_of(table, rows)
        now, value = taken(squares), taken(values)
        now += np.einsum("rd,rd->r", gradient, gradient) / gradient.shape[1] if by_row else gradient * gradient
        scale = self.shape.rate / np.sqrt(now)
        value += gradient * (scale[:, None] if by_row else scale)
        squares[rows] = now
        if by_row:  # a row as one item: numpy puts it in its place at once
            item = f"V{values[0].nbytes}"
            values.view(item)[rows] = value.view(item)
        else:
            values[rows] = value

    def learn(self, before: np.ndarray, units: np.ndarray, rng) -> None:
        """A step of noise-contrastive estimation: each token's unit is told from noise units, which the batch shares."""
        import numpy as np

        shape, flat = self.shape, before.T.reshape(-1)
        e = [rows_of(self.inputs, rows) for rows in flat.reshape(shape.context, -1)]
        h = e[0] * self.places[0]
        for k in range(1, shape.context):
            h += e[k] * self.places[k]
        noise = np.minimum(np.searchsorted(self.noise_sums, rng.random(shape.noise)), shape.units - 1)
        offset = self.biases - self.log_noise - np.float32(np.log(shape.noise))
        own, others = rows_of(self.outputs, units), self.outputs[noise]
        clip = lambda x: np.clip(x, -30, 30, out=x)
        hit = 1 / (1 + np.exp(clip(np.einsum("td,td->t", h, own) + offset[units])))
        miss = h @ others.T
        miss += offset[noise]
        np.negative(clip(miss), out=miss)
        np.exp(miss, out=miss)
        miss += 1
        np.divide(-1, miss, out=miss)
        of_hidden = miss @ others
        own *= hit[:, None]
        of_hidden += own
        outputs, biases = np.zeros_like(self.outputs), np.zeros_like(self.biases)
        np.add.at(outputs, noise, miss.T @ h)
        np.add.at(biases, noise, miss.sum(axis=0))
        order, at = grouped(units)
        rows = units[order[at]]
        outputs[rows] += np.add.reduceat(rows_of(hit[:, None] * h, order), at)
        biases[rows] += np.add.reduceat(hit[order], at)
        order, at = grouped(flat)
        of_inputs = group_sums((of_hidden * self.places[:, None]).reshape(-1, shape.width), order, at)
        places = np.stack([np.einsum("td,td->d", of_hidden, x) for x in e]) * np.float32(0.3)
        self._step("inputs", flat[order[at]], of_inputs, True)
        self._step("outputs", slice(None), outputs, True)
        self._step("biases", slice(None), biases, False)
        self._step("places", slice(None), places, False)

    def difference(self, trained: Network) -> dict[str, np.ndarray]:
        """What a trained copy has learned: for every row the gradients' squares, and its move times these."""
        out = {}
        for n in self.NAMES:
            weight = trained.squares[n] - self.squares[n]
            move = getattr(trained, n) - getattr(self, n)
            out[n], out[f"{n}-squares"] = move * (weight[:, None] if weight.ndim < move.ndim else weight), weight
        return out

    def moved(self, sums: dict[str, np.ndarray]) -> Network:
        """The network with the mean of many differences, given their sums: a row's moves count by its gradients in each."""
        import numpy as np

        out = self.copy()
        for n in self.NAMES:
            weight, move = sums[f"{n}-squares"], sums[n]
            divisor = np.where(weight > 0, weight, 1)
            getattr(out, n)[...] += (move / (divisor[:, None] if divisor.ndim < move.ndim else divisor)).astype(np.float32)
            out.squares[n] += weight.astype(np.float32)
        return out


def rows_of(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """table[at], which numpy takes about half the time for in this form; at is within the table."""
    return table.take(at, axis=0, mode="clip")


def grouped(keys: np.ndarray):
    """(order, starts): an order in which equal keys stand together, and where each group begins."""
    import numpy as np

    order = np.argsort(keys, kind="stable")  # by radix: keys have 16 bits
    at = keys[order]
    return order, np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))


def group_sums(values: np.ndarray, order: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The sum of each group's rows. Most groups have one row, which is taken as it is: numpy's sums cost as much for a row as for many."""
    import numpy as np

    sizes = np.diff(at, append=len(order))
    several = sizes > 1
    out = rows_of(values, order[at])
    if several.any():
        inside, sizes = np.repeat(several, sizes), sizes[several]
        out[several] = np.add.reduceat(rows_of(values, order[inside]), np.cumsum(sizes) - sizes)
    return out


def windows(ids: np.ndarray, lens: np.ndarray, rows: np.ndarray, context: int, pad: int) -> np.ndarray:
    """For each number of texts one after another, the input rows of the `context` words before it in its text, the nearest first."""
    import numpy as np

    place = np.arange(len(ids)) - np.repeat(np.cumsum(lens) - lens, lens)
    at, out = rows[ids], np.full((len(ids), context), pad, np.uint16)
    for k in range(1, context + 1):
        out[k:, k - 1] = np.where(place[k:] >= k, at[:-k], pad)
    return out


def unpacked(batch, k: int):
    """ids, input rows of words, signatures, held, lens and carries of a section's row."""
    import numpy as np
    from zstandard import ZstdDecompressor

    column = lambda name: batch.column(batch.schema.get_field_index(name))[k]
    ids = np.frombuffer(ZstdDecompressor().decompress(column("ids").as_py()), np.uint32)
    array = lambda name: column(name).values.to_numpy(zero_copy_only=False)
    signatures = array("signatures").astype(np.int64)
    return ids, (signatures >> CLASS_BITS).astype(np.uint16), signatures, array("held"), array("lens").astype(np.int64), array("carries").astype(np.int64), array("rows")


def train(cut: DataFrame, counts: Counts, tokens: int, shape: Shape) -> Network:
    """The network, trained once on every training text: in each round tasks go on from the same parameters, and their moves are averaged.

    What a task learned goes to the next round by way of sums in two steps, slice by slice of the parameters, so neither a task nor
    the driver holds more than one model's size. A lost task begins anew with the same parameters, rows and random numbers.
    """
    import numpy as np

    spark = cut.sparkSession
    network, begin = Network(shape, counts), 0
    tasks = max(spark.sparkContext.defaultParallelism, tokens // shape.task_tokens)
    read = cut.select("section", "signatures", "ids", "rows", "held", "lens", "carries").coalesce(tasks)
    for share in shape.rounds:
        sent = spark.sparkContext.broadcast((network, counts))
        some = read.mapInArrow(_trainer(sent, shape, begin, begin + share), "part int, salt int, sums binary")
        for keys in (["part", "salt"], ["part"]):
            some = some.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_summer, "part int, salt int, sums binary")
        rows = sorted((r["part"], bytes(r["sums"])) for r in some.collect())  # of one model's size
        if rows:
            flat = np.concatenate([np.frombuffer(s, np.float64) for _, s in rows])
            sums, at = {}, 0
            for name, like in network.difference(network).items():
                sums[name] = flat[at : at + like.size].reshape(like.shape)
                at += like.size
            network = network.moved(sums)
        sent.unpersist()
        begin += share
    return network


def _trainer(sent, shape: Shape, begin: int, end: int):
    def run(batches):
        import numpy as np
        from pyspark import TaskContext

        network, counts = sent.value
        trained, any_rows = network.copy(), False
        for b in batches:
            for k in range(b.num_rows):
                ids, inputs, signatures, held, lens, carries, rows = unpacked(b, k)
                eighth = (rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(61)
                mine = ~held & (begin <= eighth) & (eighth < end)
                if not mine.any():
                    continue
                chosen = np.repeat(mine, lens + carries)
                ids, lens, carries = ids[chosen], (lens + carries)[mine], carries[mine]
                before = windows(ids, lens, inputs, shape.context, shape.inputs)
                place = np.arange(len(ids)) - np.repeat(np.cumsum(lens) - lens, lens)
                rng = np.random.default_rng([begin, b.column(0)[k].as_py()])
                order = rng.permutation(np.flatnonzero(place >= np.repeat(carries, lens)))
                units = counts.units(signatures)[ids]
                for s in range(0, len(order), shape.batch):
                    trained.learn(rows_of(before, order[s : s + shape.batch]), units[order[s : s + shape.batch]], rng)
                any_rows = True
        if any_rows:
            flat = np.concatenate([x.reshape(-1) for x in network.difference(trained).values()]).astype(np.float64)
            salt = TaskContext.get().partitionId() // 64
            for part, s in enumerate(range(0, len(flat), 1 << 16)):
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([salt], pa.int32()), pa.array([flat[s : s + (1 << 16)].tobytes()])], ["part", "salt", "sums"])

    return run


def _summer(batches):
    """Rows (part, salt, sums) sorted by their keys as one row for each key, one array held at a time."""
    import numpy as np

    key, total = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([total.tobytes()])], ["part", "salt", "sums"])
    for b in batches:
        for part, salt, sums in zip(*(c.to_pylist() for c in b.columns)):
            if key != (part, salt):
                if key is not None:
                    yield row()
                key, total = (part, salt), np.frombuffer(sums, np.float64).copy()
            else:
                total += np.frombuffer(sums, np.float64)
    if key is not None:
        yield row()


def log_bilinear_scores(docs: DataFrame, shape: Shape = Shape(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row: log10 probabilities of the whole text and
    its end, by counts of words alone (one added), and by the network.

    A null text counts as empty and a null id as the id "" for its fold; rows with the same id are a text each. Words of any length are words. Without
    training texts nothing is known and all probabilities are those of one unknown word. An empty table gives no rows. Other columns take no part.
    """
    import numpy as np

    spark = docs.sparkSession
    cut = written(sections(docs, shape, id_col, text_col))
    words = written(counted(cut))
    counts, tokens, kinds = unit_counts(words, shape)
    network = train(cut, counts, tokens, shape)
    sent = spark.sparkContext.broadcast((network, counts))

    def run(batches):
        network, counts = sent.value
        for b in batches:
            for k in range(b.num_rows):
                ids, inputs, signatures, held, lens, carries, rows = unpacked(b, k)
                info = b.column(b.schema.get_field_index("info"))[k].values.flatten()
                n = np.zeros(len(signatures), np.int64)
                n[info[0].to_numpy()] = info[1].to_numpy()
                all_units = counts.units(signatures)
                in_unit = np.log10((n + 1) / (counts.tokens + counts.words + 1)[all_units])
                base = np.log10((n + 1) / (tokens + kinds + 1))
                starts = np.cumsum(lens + carries) - lens - carries
                place = np.arange(len(ids)) - np.repeat(starts, lens + carries)
                scored = np.flatnonzero(place >= np.repeat(carries, lens + carries))
                before = windows(ids, lens + carries, inputs, shape.context, shape.inputs)[scored]
                ids = ids[scored]
                score = network.log_probabilities(before, all_units[ids]) / np.log(10) + in_unit[ids]
                first = np.cumsum(lens) - lens  # no text is without a token
                sums = [np.add.reduceat(x, first) for x in ((n > 0)[ids].astype(np.int64), base[ids], score)]
                docs_of = b.column(b.schema.get_field_index("docs"))[k].values
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), docs_of, pa.array(held), pa.array(lens), *map(pa.array, sums)], ["row", "id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    info = words.groupBy("section").agg(F.collect_list(F.struct("ix", "n")).alias("info"))
    joined = cut.drop("words", "counts").join(info, "section")
    kind = docs.schema[id_col].dataType.simpleString()
    parts = joined.mapInArrow(run, f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    total = parts.groupBy("row").agg(F.first("id").alias(id_col), F.first("held_out").alias("held_out"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return total.select(id_col, "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
