"""Toxicity, licences and SpotSigs against held-out labels and brute force."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from genoweave.llm import licenses, spotsigs, toxicity

from . import data


def labelled(n=900, seed=3):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(500)]
    docs, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.2
        text = [rnd.choice(words) for _ in range(rnd.randint(20, 80))]
        if toxic:
            for _ in range(3):
                text.insert(rnd.randrange(len(text)), rnd.choice(["idiot", "scum,", "zorgan", "zorgel", "zorgiz."]) if i % 2 else f"zorg{rnd.choice(words)}")
        docs.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_labels(spark):
    docs, labels = labelled()
    extra = [(None, "a text"), (9000, None), (9001, ""), (9002, "you are an idiot scum zorgan zorgel"), (9002, "you are an idiot scum zorgan zorgel")]
    d = spark.createDataFrame(docs + extra, "doc_id long, text string")
    lab = spark.createDataFrame([(i, t, 9) for i, t in labels] + [(None, 1, 9), (5, None, 9)], "doc_id long, toxic int, text int")
    out = toxicity.toxicity(d, lab).collect()
    assert len(out) == len(docs) + len(extra)
    truth = dict(labels)
    for r in out:
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    scores = {r.doc_id: r.score for r in out}
    assert scores[9000] == scores[9001] < 0.5 < scores[9002]


def test_toxicity_needs_no_labels_and_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    d = spark.createDataFrame([(1, "what an idiot"), (2, "a fine day"), (3, "you st.upid m0ron")], "doc_id long, text string")
    assert {r.doc_id: r.predicted for r in toxicity.toxicity(d, none).collect()} == {1: 1, 2: 0, 3: 1}
    model = toxicity.fit(d, none)
    assert [r.doc_id for r in toxicity.drop_toxic(d, model).collect()] == [2]
    assert toxicity.toxicity(d.limit(0), none).count() == 0


def test_label_model_finds_reliable_voters_and_discounts_copies():
    rnd = np.random.default_rng(0)
    y = rnd.random(4000) < 0.2
    good = [(rnd.random(4000) < np.where(y, 0.6, 0.01)).astype(float) for _ in range(3)]
    bad = (rnd.random(4000) < 0.1).astype(float)
    votes = np.stack([*good, good[0], bad], axis=1)
    given = np.where(rnd.random(4000) < 0.1, ~y, y).astype(int)
    p, rates, strength = toxicity.label_model(votes, given, 0.2, 40)
    assert ((p > 0.5) == y).mean() > (given == y).mean()
    assert rates[0, 0] > 5 * rates[0, 1] and rates[4, 0] < 3 * rates[4, 1]
    assert strength[0] < 0.7 < strength[1]


LICENSED = {
    1: ("Some prose here.\nReleased under the MIT License.\nMore prose.", "MIT"),
    2: ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"),
    3: ("words before Licensed under CC BY-NC 4.0. and after, all in a line", "CC-BY-NC"),
    4: ("This work is licensed under the GNU General Public License, version 3.", "GPL"),
    5: ("the license plate of the car was lost on the way to the library", "none"),
    6: ("plain prose\n\nof no licence at all " * 50, "none"),
    7: (None, "none"),
    8: ("", "none"),
    9: ("x" * 50_000 + "\nAll rights reserved.\n", "Proprietary"),
}


def test_licences_are_told_apart_and_plain_text_is_none(spark):
    rows = [(i, t, "clash", 1) for i, (t, _) in LICENSED.items()] + [(1, "a second row with the same id", "clash", 1), (None, "Use of this source code is governed by a BSD-style license.", "clash", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, family string, para int")
    out = {r.doc_id: r for r in licenses.scan(d).collect()}
    assert len(out) == len(LICENSED) + 1
    assert {i: out[i].family for i in LICENSED} == {i: f for i, (_, f) in LICENSED.items()}
    assert out[None].family == "BSD" and out[1].n_paragraphs == 1 and out[1].shared == 1.0 and out[1].probability > 0.9
    assert licenses.scan(d.limit(0)).count() == 0


def test_wrapped_notices_are_confirmed(spark):
    import textwrap

    pick = {"BSD": (2, 3), "LGPL": (1,), "GPL": (1,), "Apache-2.0": (3,)}
    want, rows = {}, []
    for f, at in pick.items():
        for k in at:
            for width in (45, 70):
                for mark in ("", "# ", " * ", "// "):
                    body = "\n".join(mark + x for x in textwrap.wrap(licenses.TEMPLATES[f][k] + " and so on.", width))
                    want[len(rows)] = f
                    rows.append((len(rows), f"import os\n{mark}\n{body}\n{mark}\n\nprint()"))
    out = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.family for i, r in out.items()} == want and all(r.n_paragraphs == 1 for r in out.values())


def test_lines_that_are_skipped_could_not_be_confirmed():
    telling = set(licenses.telling_words())
    for ts in licenses.TEMPLATES.values():
        for t in ts:
            w = licenses.words_of(t)
            triples = {tuple(w[j : j + 3]) for j in range(max(1, len(w) - 2))}
            assert sum(not telling & set(x) for x in triples) / len(triples) < licenses.Limits().shared


def plain_signatures(text, chain=3):
    import regex

    words = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    out = set()
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            follow = [x for x in words[i + 1 :] if x not in spotsigs.ANCHORS][:chain]
            if follow:
                out.add((w, *follow))
    return out or {tuple(words[i : i + chain + 1]) for i in range(len(words))}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def prose(n=80, seed=8):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("klmnopqrst") for _ in range(rnd.randint(3, 7))) for _ in range(300)] + ["the", "of", "und", "la"] * 30
    rows = [(i * 3, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 90)))) for i in range(n)]
    rows += [(1000, None), (1001, ""), (1002, "?!"), (1003, "the of"), (1004, "one"), (1005, rows[0][1]), (1006, "das größte Maß é" * 3000), (None, "the null id came first"), (7, "twice the same"), (7, "twice the same")]
    return rows


def test_likeness_equals_brute_force_over_neighbours(spark):
    rows = prose()
    d = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, signatures string")
    out = spotsigs.edited_likeness(d.repartition(7)).withColumn("fp", spotsigs.fingerprint("signatures")).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = Counter()
    for k, (i, t) in enumerate(order):
        t, follow = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + follow[:half]
        s = plain_signatures(t)
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), round(jaccard(s, plain_signatures(edited)), 9), round(jaccard(s, plain_signatures(follow)), 9)] += 1
    got = Counter((r.doc_id, r.n_chars, hashlib.sha256(r.edited_text.encode()).hexdigest(), round(r.near_edited, 9), round(r.near_next, 9)) for r in out)
    assert got == want
    prints = {r.doc_id: r.fp for r in out}
    assert prints[0] == prints[1005] != prints[3] and prints[1000] == prints[1001] == prints[1002] == ""
    assert spotsigs.edited_likeness(d.limit(0)).count() == 0


def test_neighbours_across_buckets(spark):
    rows = [(i, f"text {i}") for i in range(0, 4000, 4)]
    out = spotsigs.with_next(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", rows=50)
    assert out.select("g_bucket").distinct().count() > 5
    assert {(r.doc_id, r.next_text) for r in out.collect()} == {(i, f"text {(i + 4) % 4000}") for i, _ in rows}


@pytest.mark.parametrize("threshold, most", [(0.8, 2_000), (0.5, 2_000), (0.5, 3)])
def test_near_duplicates_lose_no_pair(spark, threshold, most):
    rnd = random.Random(1)
    base = [t for _, t in prose(40) if t and len(t) > 60]
    rows = []
    for k, t in enumerate(base):
        rows.append((k * 10, t))
        for j in range(rnd.randint(0, 3)):
            w = t.split()
            w[rnd.randrange(len(w))] = "edited"
            rows.append((k * 10 + j + 1, " ".join(w)))
    rows += [(5000 + j, base[0]) for j in range(30)]
    members, pairs = spotsigs.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), threshold, most=most)
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(plain_signatures(t)), []).append(i)
    assert {(r.doc_id, r.class_id) for r in members.collect()} == {(i, min(g)) for g in sets.values() for i in g}
    classes = [(min(g), s) for s, g in sets.items()]
    want = {(a, b) for a, s in classes for b, t in classes if a < b and jaccard(s, t) >= threshold - 1e-12}
    got = [(r.a, r.b) for r in pairs.collect()]
    assert set(got) == want and len(got) == len(want)


def test_each_row_has_its_class_and_number_of_links(spark):
    rnd, rows = random.Random(5), [(i, t) for i, t in prose(60)]
    for i, t in list(rows):
        w = (t or "one word").split()
        w[rnd.randrange(len(w))] = "edited"
        rows += [(20_000 + (i or 0), " ".join(w)), (30_000 + (i or 0), t), (None, t)]
    sets = {}
    for i, t in rows:
        sets.setdefault(frozenset(plain_signatures(t or "")), []).append(i)
    names = {s: min((i for i in g if i is not None), default=None) for s, g in sets.items()}
    links = {s: sum(jaccard(s, o) >= 0.8 - 1e-12 for o in sets if o != s and o and s) for s in sets}
    want = Counter((i, names[s], links[s]) for i, t in rows for s in [frozenset(plain_signatures(t or ""))])
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, class_id int, n_links int")
    out = spotsigs.edited_likeness(d.repartition(5), threshold=0.8)
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in out.select("doc_id", "class_id", "n_links").collect()) == want
    assert sum(links.values()) > 20
    plain = spotsigs.edited_likeness(d).collect()
    same = ("doc_id", "edited_text", "near_edited", "near_next")
    assert Counter(tuple(r[c] for c in same) for r in out.collect()) == Counter(tuple(r[c] for c in same) for r in plain)
    assert spotsigs.edited_likeness(d.limit(0), threshold=0.8).count() == 0
    members, pairs = spotsigs.near_duplicates(d.limit(0))
    assert members.count() == pairs.count() == 0


def test_rows_with_one_id_are_scanned_apart_and_equal_ones_once(spark):
    def scanned(texts):
        r = licenses.scan(spark.createDataFrame([(1, t) for t in texts], "doc_id long, text string").repartition(3)).first()
        return r.family, round(r.probability, 9), r.n_paragraphs

    mit, apache = "Licensed under the MIT license.", "Licensed under the Apache License, Version 2.0 (the \"License\");"
    assert scanned([mit]) == scanned([mit, mit, mit]) and scanned([mit])[0] == "MIT"
    both, one, other = scanned([mit, apache]), scanned([mit]), scanned([apache])
    assert both[2] == one[2] + other[2] == 2 and both[:2] == max((one[:2], other[:2]), key=lambda x: x[1])


def test_a_labelled_id_on_many_rows_is_one_row_of_the_sample(spark):
    docs = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text")).unionByName(spark.createDataFrame([(8, "other"), (9, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(k, 1) for k in range(7, 10)], "doc_id long, toxic int")
    out = toxicity.sample_labelled(docs, labels, toxicity.Limits(), "doc_id", "text", "toxic").collect()
    assert len(out) == len([k for k in (7, 8, 9) if zlib.crc32(str(k).encode()) % 5]) and sum(r.text.startswith("text ") for r in out) == 1


def test_licence_scan_reads_texts_once(spark, tmp_path):
    """Only lines that n-grams of a licence lift are kept for the comparison with templates, a row each however often they are there."""
    rows = [(i, t) for i, (t, _) in LICENSED.items() if i is not None] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/d")
    out = licenses.scan(spark.read.parquet(f"{tmp_path}/d"))
    reads = [x for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x]
    assert reads and not any("text:string" in x for x in reads)
    assert {r.doc_id: (r.family, r.n_paragraphs) for r in out.collect()} == {i: (f, int(f != "none")) for i, (_, f) in LICENSED.items()}
