"""BPE, packing and sharding against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from genoweave.llm import bpe, packing, sharding
from genoweave.llm.queries import bpe_pattern, tokenizer_path

from . import data


def test_bpe_equals_the_library_on_whole_texts_and_decodes_to_the_same_bytes(spark):
    ranks, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), bpe_pattern()
    out = bpe.decode(bpe.encode(data.frame(spark), ranks, pattern), ranks, pattern).collect()
    enc = bpe.encoding(ranks, pattern)
    want = Counter((i, np.array(enc.encode_ordinary(t or ""), dtype="<u4").tobytes(), (t or "").encode()) for i, t, *_ in data.rows())
    assert Counter((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in out) == want
    assert all(r.n_tokens == len(r.ids) // 4 for r in out)


def test_parts_join_to_the_text_and_matches_stay_whole():
    import regex

    text = "It's 12ab34 don't  stop\n\n now " * 40
    parts = list(bpe.safe_parts(text, 17))
    assert "".join(parts) == text and len(parts) > 40
    assert [m for p in parts for m in regex.findall(bpe_pattern(), p)] == regex.findall(bpe_pattern(), text)


def test_runs_that_the_regex_engine_refuses_are_encoded_all_the_same():
    enc, text = bpe.encoding(tokenizer_path("byte_bpe_multi_50k.tiktoken"), bpe_pattern()), "a" + " " * 300_000 + "b"
    assert enc.decode_bytes(np.frombuffer(bpe.encode_text(enc, bpe_pattern(), text), "<u4").tolist()) == text.encode()


def test_packing_keeps_every_token_and_is_near_the_bound(spark):
    from tokenizers import Tokenizer

    file, cap = tokenizer_path("word_bpe_49k.json"), 256
    out = packing.pack_documents(data.frame(spark), file, cap).collect()
    tokenizer = Tokenizer.from_file(file)
    want = Counter()
    for i, t, *_ in data.rows():
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want.update((i, k, s, ids[s : s + cap].tobytes()) for k, s in enumerate(range(0, len(ids), cap)))
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in out) == want
    held = defaultdict(list)
    for r in out:
        assert r.length == len(r.ids) // 4
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= cap
    assert len(held) <= 1.02 * sum(r.length for r in out) / cap + 1


def test_words_get_the_ids_that_whole_texts_get():
    from tokenizers import Tokenizer

    file = tokenizer_path("word_bpe_49k.json")
    texts = ["see <|endoftext|> here", "a<|endoftext|>b <|startoftext|>", "<|EndOfText|> x", "It's word### (so) 'tis don't. end' Größe$$$ ÀÉ!! schö,***", "", " \u3000\u00a0x\u2026. é\u0301, a&&b a'.'s"]
    encode, plain = packing.words_encoder(file), Tokenizer.from_file(file)
    assert encode([t.encode() for t in texts * 2]) == [np.array(plain.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts * 2]
    assert len(encode([b"<|endoftext|>"])[0]) == 4


def test_a_full_cache_keeps_words_in_use(monkeypatch):
    import tokenizers

    plain, merged = tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json")), []

    class Counted:
        from_file = staticmethod(lambda file: Counted())
        model = property(lambda self: self)
        tokenize = lambda self, w: merged.append(w) or plain.model.tokenize(w)

        def __getattr__(self, name):
            return getattr(plain, name)

    monkeypatch.setattr(tokenizers, "Tokenizer", Counted)
    monkeypatch.setattr(packing, "CACHED_WORDS", 4)
    encode = packing.words_encoder.__wrapped__("")
    for k in range(5):
        text = " ".join(["river", *(f"{a}{b}{chr(97 + k)}" for a in "xyz" for b in "pq"), "river"])
        assert encode([text.encode()]) == [np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()]
    assert merged.count("river") == 1


def test_best_two_fit_replaces_the_smallest_by_two_that_fit_better():
    assert best({6: 1, 3: 1, 2: 2}, 10) == [[6, 2, 2], [3]]  # 6 + 3 leaves 1; 2 + 2 in place of 3 fills it
    assert best({}, 10) == [] and best({10: 3}, 10) == [[10]] * 3
    with pytest.raises(ValueError):
        packing.best_two_fit({11: 1}, 10)
    rnd = np.random.default_rng(1)
    lengths = rnd.integers(1, 101, 5000)
    bins = best(Counter(lengths.tolist()), 100)
    assert Counter(x for b in bins for x in b) == Counter(lengths.tolist()) and max(map(sum, bins)) <= 100
    assert len(bins) <= lengths.sum() / 100 * 1.02 + 1


def best(counts, cap):
    return [b for b, n in packing.best_two_fit(counts, cap) for _ in range(n)]


def test_shards_are_near_equal_gapless_and_whole(spark):
    shards = 5
    out = sharding.shard_records(data.frame(spark), shards).collect()
    assert Counter((r.doc_id, r.text) for r in out) == Counter(r[:2] for r in data.rows())
    by = defaultdict(list)
    for r in out:
        assert r.size == len((r.text or "").encode()) + 8
        by[r.shard].append(r)
    sizes = [sum(r.size for r in by[s]) for s in range(shards)]
    largest = max(r.size for r in out)
    assert max(abs(s - sum(sizes) / shards) for s in sizes) <= largest
    for rows in by.values():
        assert sorted(r.slot for r in rows) == list(range(len(rows)))
    small = sharding.shard_records(data.frame(spark).where("length(text) < 2000"), 8).groupBy("shard").sum("size").collect()
    assert max(r[1] for r in small) < 1.1 * sum(r[1] for r in small) / 8


def test_splitters_and_ranges_equal_brute_force(spark):
    rnd = np.random.default_rng(3)
    keys = np.unique(rnd.integers(-5, 5, (400, 2)), axis=0)
    keys, w = rnd.permutation(keys), rnd.pareto(1.2, len(keys)) + 0.1
    found, want, done = sharding.quantile_keys(keys, w, 12), [], 0.0
    for k, x in sorted(zip(map(tuple, keys.tolist()), w.tolist())):
        if any(done >= w.sum() * j / 12 > last for j in range(1, 12) for last in [done - prior if want or done else -1.0]):
            want.append(k)
        done, prior = done + x, x
    assert found.tolist() == [list(k) for k in want] and 3 < len(want) < 12
    rows = spark.createDataFrame([(int(a), int(b)) for a, b in rnd.integers(-7, 7, (500, 2))], "k1 long, k2 long")
    assert all(r.n == sum((r.k1, r.k2) >= k for k in want) for r in rows.withColumn("n", sharding.range_of(found)).collect())
    assert {r.n for r in rows.withColumn("n", sharding.range_of(found[:0])).collect()} == {0}


@pytest.mark.parametrize("texts", [["x" * min(int(20 * (1 - k / 3000) ** -1.1), 60_000) + str(k) for k in range(3000)], [f"short {k * k}" for k in range(3000)] + ["y" * 9000 + str(k) for k in range(40)]])
def test_law_holds_on_heavy_tails_and_few_giants(spark, texts):
    out = sharding.shard_records(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), 24)
    sizes, counts = defaultdict(int), defaultdict(set)
    for r in out.collect():
        sizes[r.shard] += r.size
        counts[r.shard].add(r.slot)
    assert max(abs(sizes[s] - sum(sizes.values()) / 24) for s in range(24)) <= max(map(len, texts)) + 8
    assert sum(map(len, counts.values())) == len(texts) and all(v == set(range(len(v))) for v in counts.values())


def test_a_group_of_copies_is_cut_between_shards(spark):
    rows = [(i, "same text" if i % 3 else f"text {i}") + data.rows()[0][2:] for i in range(3000)]
    sizes = [r[1] for r in sharding.shard_records(data.frame(spark, rows), 24).groupBy("shard").sum("size").collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 2 * 20


def test_empty_tables(spark):
    empty = data.frame(spark, [])
    ranks, pattern = tokenizer_path("byte_bpe_multi_50k.tiktoken"), bpe_pattern()
    assert bpe.decode(bpe.encode(empty, ranks, pattern), ranks, pattern).count() == 0
    assert packing.pack_documents(empty, tokenizer_path("word_bpe_49k.json")).count() == 0
    assert sharding.shard_records(empty).count() == 0
    assert hashlib.sha256(b"").hexdigest() and zlib.crc32(b"") == 0
