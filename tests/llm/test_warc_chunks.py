"""Archives by round trip, chunks and the pipeline against brute force."""

import base64
import gzip
import hashlib
import random
import zlib
from collections import Counter

import pytest

from genoweave.llm import chunks, compression, packing, simhash, toxicity, warc
from genoweave.llm.common import shared_dir

from . import data

PAGES = [(i, f"http://h/{i}?a: b", f"<p>page {i} é</p>" * (i % 9 + 1)) for i in range(60)] + [(100 + i, "http://h/same", "<p>page 3 é</p>" * 4) for i in range(40)]
PAGES += [(200, None, None), (201, "http://h/\r\nX: y", ""), (202, "u", "z" * 300_000), (203, "u", "\r\n\r\nWARC/1.1\r\n\r\n"), (None, "u", "only a null id"), (None, "u", "<p>page 3 é</p>" * 4), (7, "again", "<p>page 7 é</p>" * 8)]


@pytest.mark.parametrize("broadcast_rows", [warc.BROADCAST_ROWS, 0])
def test_archives_round_trip(spark, monkeypatch, broadcast_rows):
    monkeypatch.setattr(warc, "BROADCAST_ROWS", broadcast_rows)
    d = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, digest string")
    out = warc.archive_round_trip(d).collect()
    first = {}
    for i, _, h in PAGES:
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        owner = first.get(h or "")
        refers = None if owner is None or owner == i else owner
        want[i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if refers is None else "revisit", refers] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == want
    payloads = {r.page_id: bytes(r.payload) for r in out if r.record_type == "response"}
    assert payloads[202] == b"z" * 300_000 and payloads[203] == b"\r\n\r\nWARC/1.1\r\n\r\n"
    assert warc.archive_round_trip(d.limit(0)).count() == 0


def test_every_record_is_a_member_of_its_own_and_the_index_finds_it(spark, tmp_path):
    d = spark.createDataFrame(PAGES[:30], "page_id long, url string, html string")
    place = f"{shared_dir(spark)}/t-{tmp_path.name}"
    warc.write_archives(d, f"{place}/whole")
    warc.normalise(spark, f"{place}/whole", f"{place}/members")
    fs, root = warc.file_system(f"{place}/members")
    n = 0
    for info in fs.get_file_info(__import__("pyarrow").fs.FileSelector(root)):
        if info.path.endswith(".idx"):
            raw = fs.open_input_file(info.path.removesuffix(".idx")).read()
            at = 0
            for line in fs.open_input_file(info.path).read().decode().splitlines():
                offset, length = map(int, line.split("\t")[:2])
                assert offset == at
                z = zlib.decompressobj(31)
                member = z.decompress(raw[offset : offset + length])
                assert z.eof and not z.unused_data and member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
                at, n = offset + length, n + 1
            assert at == len(raw)
    assert n == 30


def test_streams_of_several_members_are_inflated_and_cut_ones_refused():
    import io

    whole = gzip.compress(b"a" * 5000) + gzip.compress(b"b" * 10)
    assert b"".join(warc.inflated(io.BytesIO(whole), 7)) == b"a" * 5000 + b"b" * 10
    with pytest.raises(EOFError):
        list(warc.inflated(io.BytesIO(whole[:-9])))


def plain_windows(raw, how):
    """(start, end) of the windows, by going from every edge."""
    edges = [0, *chunks.chunk_ends(raw, how)]
    right = {(s, next((e for e in edges if e - s >= how.least_run), None)) for s in edges}
    left = {(next((s for s in reversed(edges) if e - s >= how.least_run), None), e) for e in edges}
    return sorted(w for w in right | left if None not in w)


def plain_dedup(rows, how):
    """Bytes of whole windows are compared, with no digest."""
    least, out = {}, Counter()
    for i, t in rows:
        if i is not None:
            for s, e in plain_windows((t or "").encode(), how):
                w = (t or "").encode()[s:e]
                least[w] = min(least.get(w, i), i)
    for i, t in rows:
        raw, seen, gone = (t or "").encode(), {}, set()
        for s, e in plain_windows(raw, how):
            w = raw[s:e]
            if (i is not None and least[w] < i) or seen.get(w, e) <= s:
                gone.update(range(s, e))
            seen.setdefault(w, e)
        out[i, None if t is None else bytes(c for k, c in enumerate(raw) if k not in gone).decode()] += 1
    return out


def test_no_byte_goes_that_does_not_stand_in_a_long_stretch_before(spark):
    """On plain substrings: common phrases in any order make chunks that were seen, but no stretch of 120 bytes that was."""
    rnd = random.Random(8)
    phrases = [" ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(3, 8))) for _ in range(60)]
    passage = " ".join(rnd.choice(phrases) for _ in range(12))
    rows = [(i, " ".join(rnd.choice(phrases) for _ in range(40)) + (f" {passage} " + " ".join(rnd.choice(phrases) for _ in range(5)) if i % 10 == 0 else "")) for i in range(150)]
    out = {r.doc_id: r for r in chunks.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)).collect()}
    before = ""
    for i, t in rows:
        for s, e in out[i].removed_spans:
            for part in (t[s : s + 120], t[e - 120 : e]):
                assert part in before or part in t[:s], (i, s, e)
        before += t + "\0"
    cut = sum(r.removed_bytes for r in out.values())
    assert sum(out[i].removed_bytes for i in range(10, 150, 10)) > 0.8 * 14 * len(passage) and cut < 16 * len(passage)


def test_substring_dedup_equals_brute_force(spark):
    rnd = random.Random(4)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(2000)] + ["größer", "漢字漢字"]
    passage = [" ".join(rnd.choice(words) for _ in range(60)) for _ in range(3)]
    rows = []
    for i in range(80):
        own = [rnd.choice(words) for _ in range(rnd.randint(10, 150))]
        if i % 3 == 0:
            own.insert(rnd.randrange(len(own)), passage[i % 2])
        rows.append((i, " ".join(own)))
    rows += [(90 + k, rows[1][1]) for k in range(30)] + [(None, passage[0]), (None, None), (130, None), (131, ""), (132, "x" * 200_000), (133, "x" * 200_000), (134, passage[2] + "\n" + passage[2]), (1, rows[1][1])]
    d = spark.createDataFrame([(i, t, "k", "c") for i, t in rows], "doc_id long, text string, g_out string, n_chunks string")
    how = chunks.Chunking()
    out = chunks.dedup_substrings(d, how).collect()
    assert Counter((r.doc_id, r.text) for r in out) == plain_dedup(rows, how)
    texts = [r.text for r in out if r.doc_id is not None and r.text]
    inner = " ".join(passage[1].split()[20:40])
    assert sum(inner in t for t in texts) == 1 and chunks.dedup_substrings(d.limit(0)).count() == 0


def test_an_insertion_moves_only_the_ends_near_it():
    rnd = random.Random(9)
    raw = " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))) for _ in range(3000)).encode()
    new = raw[:5000] + b"inserted words " + raw[5000:]
    a, b = set(chunks.chunk_ends(raw)), set(chunks.chunk_ends(new))
    assert len({e for e in a if e < 4980} - b) == 0 and len({e + 15 for e in a if e > 5040} - b) == 0
    assert chunks.chunk_ends(b"") == [] and chunks.chunk_ends("é".encode() * 100_000)[-1] == 200_000


def test_a_passage_without_blanks_is_found_once(spark):
    rnd = random.Random(12)

    def some(n, first=0x4E00):
        return "".join(chr(first + rnd.randrange(3000)) for _ in range(n))

    for parted in ("", "\u3000"):
        passage = parted.join(some(5) for _ in range(40))
        texts = [(i, parted.join([some(300), passage, some(300)])) for i in range(6)]
        out = chunks.dedup_substrings(spark.createDataFrame(texts, "doc_id long, text string")).collect()
        assert sum(passage[60:-60] in r.text for r in out) == 1
        assert all(r.removed_bytes >= 240 for r in out if r.doc_id)


def test_pipeline_stages_equal_their_plain_versions(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    rnd = random.Random(6)
    words = ["".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rnd.choice(words) for _ in range(rnd.randint(60, 300))) for _ in range(60)]
    passage = " ".join(rnd.choice(words) for _ in range(80))
    rows = [(i, t) for i, t in enumerate(texts)] + [(100 + i, texts[0]) for i in range(20)] + [(200, texts[1] + " idiot"), (201, "short one"), (202, "same " * 300), (203, None), (204, "")]
    rows += [(300 + i, f"{t} {passage}") for i, t in enumerate(" ".join(rnd.choice(words) for _ in range(100)) for _ in range(4))]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    sf = str(tmp_path)

    now, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, sf).write.parquet(f"{tmp_path}/out/{name}")
        now = tables[name] = spark.read.parquet(f"{tmp_path}/out/{name}")
        assert name == "best_fit_packing" or now.columns == docs.columns
    ids = {n: {r.doc_id for r in t.select("doc_id").collect()} for n, t in tables.items()}
    logit = toxicity.scorer(toxicity.Model(-3.0, {f"={w}": 6.0 for w in toxicity.LEXICON}))
    assert ids["toxicity"] == {i for i, t in rows if logit(t or "") < 0} == {i for i, _ in rows} - {200}
    good = [(i, t) for i, t in rows if i != 200 and compression.judged((t or "").encode(), compression.compressor(compression.Bands()), compression.Bands())[-1]]
    assert ids["quality_rules"] == {i for i, _ in good} and not ids["quality_rules"] & {201, 202, 203, 204} and set(range(60)) <= ids["quality_rules"]
    prints = {i: int.from_bytes(simhash.simhash(t.encode())) for i, t in good}
    groups = {i: min(j for j in prints if (prints[i] ^ prints[j]).bit_count() <= 3) for i in prints}
    assert ids["simhash_near_dedup"] == {i for i, g in groups.items() if g == i} and not ids["simhash_near_dedup"] & set(range(100, 120))
    left = [(i, t) for i, t in good if i in ids["simhash_near_dedup"]]
    assert Counter((r.doc_id, r.text) for r in tables["substring_dedup"].collect()) == plain_dedup(left, chunks.Chunking())
    inner = " ".join(passage.split()[25:55])
    assert sum(inner in r.text for r in tables["substring_dedup"].collect()) == 1
    packed = tables["best_fit_packing"].collect()
    encode = packing.words_encoder(corpus_pipeline.tokenizer_path("word_bpe_49k.json"))
    for r in tables["substring_dedup"].collect():
        assert b"".join(bytes(p.ids) for p in sorted((p for p in packed if p.doc_id == r.doc_id), key=lambda p: p.piece)) == encode([r.text.encode()])[0] + bytes(4)
    assert Counter(r.doc_id for r in corpus_pipeline.run(spark, sf).collect()) == Counter(r.doc_id for r in packed)


def test_tables_may_be_empty(spark, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    data.frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
