"""SimHash components and compression rules against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from genoweave.llm import compression, simhash

from . import data


def plain_print(text):
    """The contract's words, one by one."""
    import re

    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    rows = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_roots(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {n: find(n) for n in nodes}


def test_components_equal_brute_force(spark):
    rows = data.rows()
    out = simhash.simhash_components(data.frame(spark)).withColumn("hex", simhash.fingerprint_hex("fp")).collect()
    prints = {t: plain_print(t) for _, t, *_ in rows}
    roots = plain_roots(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            r = roots[prints[t]]
            least[r] = min(i, least.get(r, i))
    want = Counter((i, f"{prints[t]:016x}", least.get(roots[prints[t]])) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.hex, r.component_id) for r in out) == want


@pytest.mark.parametrize("bucket_rows", [2048, 3])
def test_no_link_is_lost_in_dense_groups(spark, bucket_rows):
    rnd = random.Random(2)
    prints = {rnd.getrandbits(64) for _ in range(300)}
    for base in list(prints)[:6]:
        for _ in range(60):
            prints.add(base ^ sum(1 << b for b in set(rnd.choices(range(64), k=rnd.randint(1, 5)))))
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    found = simhash.components(simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long"), 3, bucket_rows)).collect()
    roots = plain_roots(sorted(signed), lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 3)
    sizes = Counter(roots.values())
    assert {r.node: r.root for r in found} == {n: r for n, r in roots.items() if sizes[r] > 1}


def test_the_last_row_of_a_large_bucket_in_a_new_batch_is_dealt_on():
    import pyarrow as pa

    rows = [(1, f) for f in range(5)] + [(2, 9), (3, 8)]
    for size in range(1, len(rows) + 1):
        parts = [pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows[k : k + size])], ["bucket", "fp"]) for k in range(0, len(rows), size)]
        out = [r for b in simhash._bucket_links(3, 3)(parts) for r in b.to_pylist()]
        assert out == [{"kind": 1, "a": 1, "b": f} for f in range(5)], size


def test_masks_cover_every_difference_and_buckets_of_the_second_level_are_small():
    first, second = simhash.masks_of(3, 0), simhash.masks_of(3, 1)
    for masks in (first, second):
        assert all(any(not m & d for m in masks) for d in (1 << a | 1 << b | 1 << c for a in range(64) for b in range(a + 1) for c in range(b + 1)))
        assert max((m & (1 << 64) - 1).bit_count() for m in masks) <= 40 and min((m & (1 << 64) - 1).bit_count() for m in masks) >= 30
    assert max(64 - ((a | b) & (1 << 64) - 1).bit_count() for a in first for b in second) <= 18


def test_near_duplicates_go_but_for_the_smallest_id(spark):
    kept = simhash.drop_near_duplicates(data.frame(spark))
    assert kept.columns == data.frame(spark).columns
    ids = {r.doc_id for r in kept.collect()}
    assert 3 in ids and not ids & set(range(121, 160)) and None in ids
    empty = data.frame(spark, [])
    assert simhash.simhash_components(empty).count() == 0 and simhash.drop_near_duplicates(empty).count() == 0


def plain_base(text):
    import re

    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    held = {i + k for i, w in enumerate(windows) if n[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(held)


def test_base_counts_equal_brute_force_and_bands_judge(spark):
    extra = [(900, "a b a b a b c\na b\na b\n\n #x# | <y>"), (901, "the same words again and again " * 40), (902, " ".join(f"{np.random.default_rng(i).bytes(9).hex()}" for i in range(300)))]
    rows = data.rows() + [r + data.rows()[0][2:] for r in extra]
    out = compression.compression_rules(data.frame(spark, rows)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in out) == Counter((i, *plain_base(t)) for i, t, *_ in rows)
    for r in out:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert [r.kept for r in out if r.doc_id == 901] == [False]


def test_verdicts_equal_brute_force(spark):
    import zstandard

    bands = compression.Bands()
    rnd = np.random.default_rng(4)
    extra = [(910 + k, (rnd.bytes(3 * k + 300).hex() + " ") * 2 + "some plain words here " * k) for k in range(40)] + [(960 + k, " ".join(str(x) for x in rnd.integers(0, 10 ** (k % 5 + 1), 900))) for k in range(20)] + [(980, " ".join("".join(map(chr, rnd.integers(33, 126, 12))) for _ in range(200)))]
    rows = data.rows() + [r + data.rows()[0][2:] for r in extra]

    def outside(raw):
        low, high = [(a, b) for most, a, b in bands.bands if len(raw) <= most][0]
        packed = zstandard.ZstdCompressor(level=3, write_content_size=False).compress(raw)
        return not low <= len(packed) / len(raw) <= high

    def verdict(text):
        raw, counts = (text or "").encode(), plain_base(text)
        if counts[0] < 50 or counts[4] > counts[0] / 2:
            return False
        pieces = [raw[k : k + 4096] for k in range(0, len(raw), 4096)] if len(raw) > 4096 else []
        bad = sum(len(p) for p in pieces if len(p) >= 200 and outside(p))
        return len(raw) < 200 or not outside(raw) and bad <= len(raw) / 2

    out = compression.compression_rules(data.frame(spark, rows)).collect()
    assert Counter((r.doc_id, r.kept) for r in out) == Counter((i, verdict(t)) for i, t, *_ in rows)
    assert {r.kept for r in out if not r.base_failed} == {True, False}
    assert Counter(r.doc_id for r in compression.keep_good(data.frame(spark, rows)).collect()) == Counter(i for i, t, *_ in rows if verdict(t))
    limits = [low for _, low, _ in bands.bands]
    assert limits == sorted(limits, reverse=True)


def test_bands_reject_both_ends():
    import zstandard

    compress = zstandard.ZstdCompressor(level=3).compress
    bands = compression.Bands()
    prose = " ".join(f"{a}{b}" for a in ("walk", "green", "stone", "river", "cloud") for b in ("ing", "er", "", "s", "ed")).encode() * 1
    low, high = bands.of(len(prose))
    assert compression.ratios(b"abc " * 500, compress, bands)[0] < bands.of(2000)[0]
    assert compression.ratios(np.random.default_rng(0).bytes(2000), compress, bands)[0] > bands.of(2000)[1]
    assert compression.ratios(b"", compress, bands) == (0.0, 0.0)
    assert compression.compression_rules.__defaults__[0] == bands and low < high


def test_empty_table(spark):
    assert compression.compression_rules(data.frame(spark, [])).count() == 0


def test_unlike_texts_that_share_a_head_and_alike_ones_among_them(spark):
    """Large buckets, dealt again and cut into pieces: the groups are those of all pairs compared."""
    import random

    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(6))
    head = [word() for _ in range(130)]
    texts = [[*head, *(word() for _ in range(70))] for _ in range(400)]
    for k in range(0, 60, 3):  # near copies: one word of the tail is another
        near = list(texts[k])
        near[-5] = word()
        texts.append(near)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    sets = [{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts]
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    want = {i: min(j for j in range(len(sets)) if alike(sets[i], sets[j])) for i in range(len(sets))}
    assert sum(i != w for i, w in want.items()) == 20
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for how in (simhash.Likeness(), simhash.Likeness(bucket_rows=40), simhash.Likeness(bucket_hashes=5000)):
        assert {r.id: r.least for r in simhash.similar_classes(docs, how=how).collect()} == want
