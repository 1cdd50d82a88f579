"""The log-bilinear scores against plain Python: counts, sections, normalised probabilities, and what training gains on texts it hasn't seen."""

import math
import os
import random
import re
import sys
import zlib
from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from genoweave.llm import lbl

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # Python workers can't import tests

SCHEMA = "doc_id long, text string, score double, ids string, held_out string"
SMALL = lbl.Shape(inputs=211, width=4, context=3, tops=3, endings=5, batch=64)


def documents(seed=3):
    rnd = random.Random(seed)
    words = ["the", "of", "Ünder", "ünder", "THE", "a", "\x1cx", "\xa0y", "z" * 90] + [f"w{k}" for k in range(40)]
    out = [(i, rnd.choice([" ", "\n", "\t\x0b", " \f\r "]).join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(60)]
    out += [(100, None), (101, ""), (102, " \n"), (None, "no id the of"), (None, None), (7, "twice"), (7, "twice"), (103, "long words " * 3000), (-5, "the")]
    rnd.shuffle(out)
    return [(*r, 1.0, "clash", "clash") for r in out]


def folded(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tokens_of(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())) + [b""]


def plain_base(rows):
    counts = Counter(w for i, t, *_ in rows if not folded(i) for w in tokens_of(t))
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, folded(i), len(tokens_of(t)), sum(counts[w] > 0 for w in tokens_of(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens_of(t)), 6)) for i, t, *_ in rows), key=repr), counts


def fixed(shape, counts):
    """A network with large random parameters, as if trained."""
    net, rng = lbl.Network(shape, counts), np.random.default_rng(5)
    net.inputs, net.outputs, net.biases = (rng.standard_normal(x.shape).astype(np.float32) for x in (net.inputs, net.outputs, net.biases))
    return net


def plain_scores(rows, counts, shape):
    by_signature = Counter()
    for w, n in counts.items():
        if w:
            by_signature[lbl.signature(w, shape)] += n
    tops = sorted(by_signature, key=lambda s: (-by_signature[s], s))[: shape.tops]
    unit = lambda w: 0 if not w else 1 + tops.index(s) if (s := lbl.signature(w, shape)) in tops else 1 + shape.tops + (s & 255)
    tokens, kinds = Counter(), Counter()
    for w, n in counts.items():
        tokens[unit(w)] += n
        kinds[unit(w)] += 1
    of = [[tokens[u] for u in range(shape.units)], [kinds[u] for u in range(shape.units)]]
    net = fixed(shape, lbl.Counts(np.array([]), np.array([]), 0, *map(np.array, of)))

    def units(before):
        h = sum(net.inputs[lbl.signature(before[-k], shape) >> 8 if k <= len(before) else shape.inputs].astype(float) * net.places[k - 1] for k in range(1, shape.context + 1))
        e = np.exp(net.outputs.astype(float) @ h + net.biases)
        return e / e.sum()

    def p(before, w):
        u = unit(w)
        return units(before)[u] * (counts[w] + 1) / (tokens[u] + kinds[u] + 1)

    scores = [(i, sum(math.log10(p(ws[:k], w)) for k, w in enumerate(ws))) for i, t, *_ in rows for ws in [tokens_of(t)]]
    every = sum(p([b"the", b"w1"], w) for w in counts) + sum(units([b"the", b"w1"])[u] / (tokens[u] + kinds[u] + 1) for u in range(shape.units))
    return scores, every


@pytest.mark.parametrize("cut", [{}, {"section_words": 20}, {"section_tokens": 30}, {"section_bytes": 100}])
def test_counts_and_scores_equal_plain_python(spark, cut, monkeypatch):
    monkeypatch.setattr(lbl, "SLICE_BYTES", 50)
    shape, rows = replace(SMALL, **cut), documents()
    monkeypatch.setattr(lbl, "train", lambda cut, counts, tokens, shape: fixed(shape, counts))
    got = lbl.log_bilinear_scores(spark.createDataFrame(rows, SCHEMA).repartition(3), shape).collect()
    want, counts = plain_base(rows)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got), key=repr) == want
    scores, every = plain_scores(rows, counts, shape)
    assert every == pytest.approx(1)
    mine, theirs = (sorted((str(i), s) for i, s in x) for x in ([(r.doc_id, r.score) for r in got], scores))
    assert [i for i, _ in mine] == [i for i, _ in theirs]
    assert [s for _, s in mine] == pytest.approx([s for _, s in theirs], rel=1e-4)


def test_words_of_many_texts_at_once_are_those_of_each(monkeypatch):
    """A batch's texts are split together, whatever bytes they hold, and long ones by pieces; a word of a batch is a number in one list."""
    monkeypatch.setattr(lbl, "SLICE_BYTES", 20)
    rnd = random.Random(5)
    texts = [bytes(rnd.randrange(256) for _ in range(rnd.randrange(15))) for _ in range(300)] + [b"", b" ", b" a ", b"\x1cA\x00 \xff\x85\xa0 a\n", b"one two A " * 30, b"x" * 90]
    rnd.shuffle(texts)
    found = [[] for _ in texts]
    for begin, some, last in lbl.runs(lbl.pa.array([b"before", *texts], lbl.pa.binary()).slice(1)):
        words = lbl.Words(some)
        assert len(set(words.words)) == len(words.words)
        for k in range(len(some)):
            found[begin + k] += [words.words[w] for w in words.ids[words.ends[k] : words.ends[k + 1]]]
    assert found == [t.lower().split() for t in texts]


def test_sums_of_groups():
    rng = np.random.default_rng(2)
    keys, values = np.array([5, 1, 5, 2, 5, 9, 1], np.uint16), rng.standard_normal((7, 3)).astype(np.float32)
    order, at = lbl.grouped(keys)
    assert np.allclose(lbl.group_sums(values, order, at), [values[keys == k].sum(axis=0) for k in (1, 2, 5, 9)])
    order, at = lbl.grouped(keys[[0, 1]])
    assert np.array_equal(lbl.group_sums(values[:2], order, at), values[[1, 0]])


def test_training_passes_over_every_training_text_and_no_other(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    learn = lbl.Network.learn

    def counting(self, before, units, rng):
        seen.add(len(units))
        learn(self, before, units, rng)

    rows = documents()
    shape = replace(SMALL, section_tokens=500)
    cut = lbl.written(lbl.sections(spark.createDataFrame(rows, SCHEMA).repartition(4), shape, "doc_id", "text"))
    counts, tokens, _ = lbl.unit_counts(lbl.written(lbl.counted(cut)), shape)
    monkeypatch.setattr(lbl, "_trainer", lambda sent, shape, begin, end, f=lbl._trainer: _patched(f(sent, shape, begin, end), counting))
    lbl.train(cut, counts, tokens, shape)
    assert seen.value == tokens == sum(len(tokens_of(t)) for i, t, *_ in rows if not folded(i))


def _patched(run, learn):
    def inner(batches):
        lbl.Network.learn = learn
        yield from run(batches)

    return inner


def test_a_step_follows_the_gradient_of_noise_contrastive_estimation():
    shape = replace(SMALL, noise=4, batch=8)
    counts = lbl.Counts(np.array([]), np.array([]), 4, np.arange(1, 10), np.ones(9, int))
    net, rng = fixed(shape, counts), np.random.default_rng(2)
    before, units = rng.integers(0, 211, (8, 3)).astype(np.uint16), rng.integers(0, 9, 8).astype(np.uint16)
    noise = np.minimum(np.searchsorted(net.noise_sums, np.random.default_rng(9).random(4)), 8)

    def objective(biases):
        s = net.hidden(before).astype(float) @ net.outputs.T + biases - net.log_noise - np.log(4)
        return -np.log1p(np.exp(-s[np.arange(8), units])).sum() - np.log1p(np.exp(s[:, noise])).sum()

    gradient = [(objective(net.biases + (e := np.eye(9)[u] * 1e-4)) - objective(net.biases - e)) / 2e-4 for u in range(9)]
    moved = net.copy()
    moved.learn(before, units, np.random.default_rng(9))
    assert np.allclose((moved.biases - net.biases), shape.rate * np.array(gradient) / np.sqrt(np.square(gradient) + 1e-3), atol=1e-2)


def test_scores_of_any_size_are_normalised():
    net, rng = fixed(SMALL, lbl.Counts(np.array([]), np.array([]), 4, np.arange(1, 10), np.ones(9, int))), np.random.default_rng(3)
    before = rng.integers(0, 212, (20, 3)).astype(np.uint16)
    for size in (1, 50, 1e4):
        net.biases = (rng.standard_normal(9) * size).astype(np.float32)
        every = np.stack([net.log_probabilities(before, np.full(20, u)) for u in range(9)])
        assert np.isfinite(every).all() and np.allclose(np.exp(every).sum(axis=0), 1, atol=1e-4)


def test_averaging_one_model_gives_that_model():
    counts = lbl.Counts(np.array([]), np.array([]), 4, np.arange(1, 10), np.ones(9, int))
    net = fixed(SMALL, counts)
    moved, rng = net.copy(), np.random.default_rng(1)
    moved.learn(rng.integers(0, 211, (64, 3)).astype(np.uint16), rng.integers(0, 9, 64).astype(np.uint16), rng)
    same = net.moved(net.difference(moved))
    assert all(np.allclose(getattr(same, n), getattr(moved, n), atol=1e-5) for n in net.NAMES)


def test_empty_and_untrained(spark):
    assert lbl.log_bilinear_scores(spark.createDataFrame([], SCHEMA), SMALL).collect() == []
    one = next(i for i in range(50) if folded(i))
    got = lbl.log_bilinear_scores(spark.createDataFrame([(one, "never seen", 0.0, "", "")], SCHEMA), SMALL).collect()
    assert len(got) == 1 and (got[0].n_tokens, got[0].n_known, got[0].train_tokens, got[0].base_score) == (3, 0, 0, 0)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test data")
def test_texts_that_nothing_was_learned_from_are_likelier_than_by_counts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = lbl.log_bilinear_scores(docs).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens"), F.avg((F.col("score") > F.col("base_score")).cast("int"))).first()
    assert (got[0] - got[1]) / got[2] > 0.08 and got[3] > 0.9
