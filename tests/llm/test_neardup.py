"""Near-duplicates by Jaccard similarity against brute force."""

import random

import pytest

from genoweave.llm import simhash

from . import data
from .test_simhash_quality import plain_roots


def plain_set(text):
    words = (text or "").lower().split(" ")
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def edited(rnd, text, n):
    words = text.split()
    for k in rnd.sample(range(len(words)), n):
        words[k] = f"new{rnd.random()}"
    return " ".join(words)


@pytest.mark.parametrize("bucket_rows", [None, 3])
def test_stage_drops_what_is_alike_and_nothing_else(spark, bucket_rows):
    corpus_pipeline = __import__("corpus_pipeline")
    rnd = random.Random(3)
    words = ["".join(rnd.choice("abcdefghij") for _ in range(6)) for _ in range(900)]
    rows = []
    for _ in range(25):
        text = " ".join(rnd.choice(words) for _ in range(150))
        rows += [text] + [edited(rnd, text, rnd.randint(1, 5)) for _ in range(8)]
    for _ in range(15):  # chains
        rows.append(edited(rnd, rows[-1], 2))
    rows += [rows[0]] * 5
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)] + [(None, rows[0])], "doc_id long, text string").repartition(5)
    sets = [plain_set(t) for t in rows]
    roots = plain_roots(range(len(rows)), lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8)
    out = (corpus_pipeline.near_duplicate_stage(spark, docs, "") if bucket_rows is None else simhash.drop_near_duplicates(docs, how=simhash.Likeness(bucket_rows=bucket_rows))).collect()
    assert sorted(r.doc_id for r in out if r.doc_id is not None) == sorted(set(roots.values()))
    assert sum(r.doc_id is None for r in out) == 1 and 25 < len(set(roots.values())) < 220


def test_rows_of_a_bucket_are_compared_across_batches_and_roots():
    import numpy as np
    import pyarrow as pa

    a, b, c = (np.arange(k, k + 100, dtype=np.uint32).tobytes() for k in (0, 50, 55))
    rows = [(1, 1, 1, a), (1, 2, 2, b), (1, 3, 1, c), (2, 4, 4, a)]
    for size in (1, 2, 4):
        parts = [pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows[k : k + size])], ["bucket", "cls", "root", "s"]) for k in range(0, 4, size)]
        assert [(r["a"], r["b"]) for x in simhash._bucket_sets(0.8)(parts) for r in x.to_pylist()] == [(2, 3)]


def test_awkward_rows(spark):
    kept = simhash.drop_near_duplicates(data.frame(spark))
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == data.frame(spark).columns and 3 in ids and not ids & set(range(121, 160)) and None in ids
    assert simhash.drop_near_duplicates(data.frame(spark, [])).count() == 0


def test_parts_of_alike_sets_meet():
    import numpy as np

    rnd = np.random.default_rng(1)
    for n in (3, 8, 20, 45, 63, 70, 127, 146, 500, 3000):
        for _ in range(40):
            common = int(np.ceil(1.6 * n / 1.8))
            both, *own = (rnd.integers(0, 1 << 63, k, dtype=np.uint64) for k in (common, n - common, n - common))
            keys = [set(simhash.part_keys(np.unique(np.concatenate([both, x]))).tolist()) for x in own]
            assert keys[0] & keys[1], n
            part = set(simhash.part_keys(np.sort(rnd.permutation(both)[: int(np.ceil(0.8 * len(both)))])).tolist())
            assert part & set(simhash.part_keys(np.sort(both)).tolist()), n
    assert simhash.part_keys(np.zeros(0, np.uint64)).size == 0
