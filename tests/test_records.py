"""FASTA by lines, indexes, slices by index, and texts out of packed and broken files."""

import gzip
import io
import random
import tarfile
import zipfile

import pytest

from genoweave.operators import genome
from genoweave.sources import files, indexed, packed, records


def fasta_text(name, end, seed=1):
    """(text, {id: sequence}): records of all lengths, with a text before the first and blank lines."""
    rnd, out, seqs = random.Random(seed), ["before", ""], {}
    for k in range(30):
        seq = "".join(rnd.choice("ACGTNacgt") for _ in range(rnd.choice([0, 0, 1, 59, 60, 61, 400, 3000])))
        out += [f">{name}{k} some text", *[seq[i : i + 60] for i in range(0, len(seq), 60)], *[""] * (k % 9 == 0)]
        seqs[f"{name}{k}"] = seq
    return end.join(out) + ("" if name == "b" else end), seqs


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "701")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def chunks(seqs, size):
    return sorted((i, k, s[k * size : (k + 1) * size]) for i, s in seqs.items() for k in range(max(1, -(-len(s) // size))))


@pytest.mark.parametrize("size", [7, 100, 5000])
def test_chunks_by_lines_over_splits(spark, tmp_path, small_splits, size):
    seqs = {}
    for name, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        text, own = fasta_text(name, end)
        data = text.encode()
        (tmp_path / f"{name}.fa{'.gz' * (name == 'c')}").write_bytes(gzip.compress(data) if name == "c" else data)
        seqs |= own
    read = records.lines(spark, str(tmp_path))
    assert read.select("block").distinct().count() > 15
    got = records.chunks_of(read, size)
    assert sorted((r.id, r.chunk_no, r.seq) for r in got.collect()) == chunks(seqs, size)
    whole = files.whole_records(got).orderBy("row_ord").collect()
    assert [(r.id, r.seq) for r in whole] == [(i, s) for i, s in seqs.items()] and whole[0].header == "a0 some text"


def test_one_long_line_is_many_chunks_and_an_empty_file_none(spark, tmp_path):
    (tmp_path / "l.fa").write_text(">x\n" + "ACGT" * 50_000)
    (tmp_path / "e.fa").write_text("")
    (tmp_path / "n.fa").write_text("no header\nACGT\n")
    got = records.fasta_chunks(spark, str(tmp_path), "a", 1000).collect()
    assert len(got) == 200 and {r.seqid for r in got} == {"x"} and all(len(r.seq) == 1000 for r in got)


def test_index_and_slices_by_it(spark, tmp_path, small_splits):
    seqs = {}
    for name, end in (("a", "\n"), ("b", "\r\n")):
        text, own = fasta_text(name, end, 2)
        (tmp_path / f"{name}.fa").write_bytes(text.encode())
        seqs |= own
    index = records.fasta_index(spark, str(tmp_path), "x").cache()
    rows = {r.seqid: r for r in index.collect()}
    assert {i: r.length for i, r in rows.items()} == {i: len(s) for i, s in seqs.items()}
    for i, r in rows.items():
        raw = (tmp_path / f"{i[0]}.fa").read_bytes()
        assert raw[: r.offset].splitlines()[-1].split()[0] == f">{i}".encode()
    rnd = random.Random(4)
    regions = [(k, "x", i, a, a + rnd.choice([0, 1, 60, 500])) for k, i in enumerate(rnd.choice([*seqs, "none"]) for _ in range(300)) for a in [rnd.randint(-5, 3000)]]
    df = spark.createDataFrame(regions, "k int, assembly string, seqid string, ext_start long, ext_end long")
    regular = index.where("regular")
    got = {r.k: r.seq for r in indexed.indexed_slices(df, regular, "k").collect()}
    usable = {i for i, r in rows.items() if r.regular}
    assert len(usable) > 40
    assert got == {k: (seqs[i][max(a, 0) : max(b, 0)].upper() or None) if i in usable else None for k, _, i, a, b in regions}


def test_slices_by_index_read_what_they_touch(spark, tmp_path):
    big = "".join(random.Random(1).choices("ACGT", k=2_000_000))
    (tmp_path / "g.fa").write_text(">c1 x\n" + "\n".join(big[i : i + 80] for i in range(0, len(big), 80)) + "\n")
    index = records.fasta_index(spark, str(tmp_path), "x")
    regions = spark.createDataFrame([(1, "x", "c1", 100, 300), (2, "x", "c1", 250, 600), (3, "x", "c1", 1_500_000, 1_501_000), (4, "y", "c1", 1, 2)], "k int, assembly string, seqid string, ext_start long, ext_end long")
    out = {r.k: r for r in indexed.indexed_slices(regions, index, "k").collect()}
    assert [out[1].seq, out[2].seq, out[3].seq, out[4].seq] == [big[100:300], big[250:600], big[1_500_000:1_501_000], None]
    assert sum(r.bytes_read for r in out.values()) < 2000
    genes = spark.createDataFrame([("t1", "x", "c1", 500, 200, "-"), ("t2", "x", "c9", 1, 2, "+"), ("t3", "x", "c1", None, 2, "+")], "transcript_id string, assembly string, chrom string, start long, end long, strand string")
    chunked = records.fasta_chunks(spark, str(tmp_path), "x", 1000)
    no_alias = spark.createDataFrame([], "assembly string, alias string, cand_ord int, seqid string")
    both = [genome.extract(genes, how, no_alias, index.select("assembly", "seqid", "length"), 10, 20, size=1000) for how in (chunked, lambda r: indexed.indexed_slices(r, index, "transcript_id"))]
    a, b = (sorted((r.transcript_id, r.reason, r.seq) for r in x.collect()) for x in both)
    assert a == b and a[0][2] and [r[1] for r in a] == [None, "chrom_not_found", "missing_coordinates"]


def test_a_file_that_is_gone_gives_no_sequence(spark, tmp_path):
    index = spark.createDataFrame([("x", str(tmp_path / "absent.fa"), "c", 10, 3, 5, 6)], "assembly string, path string, seqid string, length long, offset long, line_bases long, line_width long")
    regions = spark.createDataFrame([(1, "x", "c", 0, 4)], "k int, assembly string, seqid string, ext_start long, ext_end long")
    assert indexed.indexed_slices(regions, index, "k").first().seq is None


def archive(kind, members):
    out = io.BytesIO()
    if kind == "zip":
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for n, data in members:
                z.writestr(n, data)
    else:
        with tarfile.open(fileobj=out, mode="w:gz" if kind == "tgz" else "w") as t:
            for n, data in members:
                info = tarfile.TarInfo(n)
                info.size = len(data)
                t.addfile(info, io.BytesIO(data))
    return out.getvalue()


@pytest.mark.parametrize("size", [64, 1 << 20])
def test_packed_texts_in_pieces_and_failures_apart(spark, tmp_path, size):
    texts, seqs = {}, {}
    for n in "abcde":
        texts[n], own = fasta_text(n, "\n", ord(n))
        seqs |= own if n != "e" else {}
    put = lambda name, data: (tmp_path / name).write_bytes(data)
    put("p.fa", texts["a"].encode())
    put("q.fa.gz", gzip.compress(texts["b"].encode()))
    put("r.zip", archive("zip", [("x/c.fa", texts["c"].encode()), ("readme.txt", b">no\nA\n")]))
    put("s.tgz", archive("tgz", [("d.fa.gz", gzip.compress(texts["d"].encode()))]))
    put("t.tar", archive("tar", [("d2.fa", b">z1 t\nAC\nGT\n")]))
    cut = gzip.compress(texts["e"].encode())
    put("u.fa.gz", cut[: len(cut) // 2])
    put("v.zip", b"not an archive")
    put("w.tar", archive("tar", [("d3.fa", b">z2\n" + b"A" * 4000)])[:2000])
    found, failed = files.fasta_and_failures(spark, str(tmp_path), piece=size)
    got = {r.id: r.seq for r in found.collect()}
    assert {i: s for i, s in got.items() if i[0] != "e" and i != "z2"} == seqs | {"z1": "ACGT"}
    own = fasta_text("e", "\n", ord("e"))[1]
    assert any(i[0] == "e" for i in got) and all(own[i].startswith(s) for i, s in got.items() if i[0] == "e")  # what was read before the break
    assert sorted({r.file.rsplit("/", 1)[-1] for r in failed.collect()}) == ["u.fa.gz", "v.zip", "w.tar"]


@pytest.mark.parametrize("split", [50, 97, 1000])
def test_splits_of_plain_files_have_each_line_once(spark, tmp_path, split):
    text = "\n".join("x" * n for n in [0, 5, 49, 50, 1, 200, 0, 0, 96, 3]) + "\n" + "last"
    (tmp_path / "a.txt").write_text(text)
    (tmp_path / "b.txt").write_text("")
    with packed.opened(str(tmp_path / "a.txt")) as f:
        got = [p for start in range(0, len(text), split) for p in packed._pieces(packed._Split(f, start, min(split, len(text) - start)), 30)]
    assert b"\n".join(got).decode() == text
    rows = packed.text_pieces(spark, str(tmp_path), piece=30, split=split).orderBy("block", "part").collect()
    assert "\n".join(r.text for r in rows) == text and all(r.error is None for r in rows)


def test_whole_records_are_put_together_in_one_grouping(spark, tmp_path):
    long = "ACGTN" * 5000
    (tmp_path / "a.fa").write_text(f">a x\n{long[:7000]}\n{long[7000:]}\n>b\n>c\nAC\nGT\n")
    (tmp_path / "broken.zip").write_bytes(b"PK")
    found, failed = files.fasta_and_failures(spark, [str(tmp_path / n) for n in ("a.fa", "broken.zip")], piece=2000, split=9000)
    assert sorted((r.id, r.description, r.seq) for r in found.collect()) == [("a", "a x", long), ("b", "b", ""), ("c", "c", "ACGT")]
    assert failed.count() == 1
    assert found._jdf.queryExecution().analyzed().toString().count("collect_list") == 1
