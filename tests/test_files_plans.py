"""Sources, sinks, plans and the stream on small files and tables."""

import gzip
import io
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from genoweave import queries as core
from genoweave import schemas
from genoweave.functions import ids
from genoweave.operators import rows
from genoweave.plans import merge, parse, resolve
from genoweave.sources import files, sinks
from genoweave.streaming.resolve import classified_stream, resolve_stream

FASTA = ">NM_1.2 Homo sapiens\nACGT\nacgu\n>x_GANC_010_y second\nTT TT\n>ZZ9\n\n>NM_1.2 again\nGG\n"
GFF = """##gff-version 3
# comment
chrX\tSGD\tgene\t181275\t181400\t.\t-\t.\tID=YJL127C-B;Name=YJL127C-B;Alias=S000028522,MCO6;dbxref=SGD:S000028522
chrX\tSGD\tmRNA\t5\t9\t.\t?\t.\tID=t1;Parent=g1
short\tline
>chrX
chr1\tx\tgene\t1\t2\t.\t+\t.\tgene_id "g2"; transcript_id "t2"; gene_name "N2";
"""


def put(folder, name, text):
    path = folder / name
    data = text.encode() if isinstance(text, str) else text
    path.write_bytes(gzip.compress(data) if name.endswith(".gz") else data)
    return str(path)


def test_fasta_plain_gz_and_in_archives(spark, tmp_path):
    for name in ("a.fa", "b.fa.gz"):
        out = files.fasta(spark, put(tmp_path, name, FASTA)).orderBy("row_ord").collect()
        assert [(r.id, r.seq) for r in out] == [("NM_1.2", "ACGTacgu"), ("x_GANC_010_y", "TTTT"), ("ZZ9", ""), ("NM_1.2", "GG")]
        assert out[0].description == "NM_1.2 Homo sapiens"
    assert [r.id for r in files.fasta_ids(spark, str(tmp_path / "a.fa")).collect()] == ["NM_1.2", "x_GANC_010_y", "ZZ9", "NM_1.2"]
    assert files.record_counts(spark, str(tmp_path / "a.fa")).first().n == 4
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("in/x.fasta", FASTA)
        z.writestr("in/readme.txt", ">no")
    put(tmp_path, "c.zip", buf.getvalue())
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as t:
        data = gzip.compress(FASTA.encode())
        info = tarfile.TarInfo("y.fa.gz")
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    put(tmp_path, "d.tgz", buf.getvalue())
    put(tmp_path, "e.zip", b"not an archive")
    paths = [str(tmp_path / n) for n in ("c.zip", "d.tgz", "e.zip")]
    assert files.fasta_archives(spark, paths).groupBy("id").count().where("id = 'NM_1.2'").first()[1] == 4
    assert files.archive_members(spark, paths).where("error is not null").count() == 1


def test_tables_read_null_tokens_and_missing_files(spark, tmp_path):
    schema = schemas.table("transcript_id chrom start:long")
    path = put(tmp_path, "t.tsv", "transcript_id\tchrom\tstart\nNA\t1\t5\nb\tX\tnan\nc\t<NA>\tx\nd\tnull\t\n")
    assert [tuple(r) for r in files.tsv(spark, path, schema).collect()] == [(None, "1", 5), ("b", "X", None), ("c", None, None), ("d", None, None)]
    assert files.tsv(spark, str(tmp_path / "none.tsv"), schema).columns == schema.names
    with pytest.raises(Exception):
        files.tsv(spark, str(tmp_path / "none.tsv"), schema, optional=False)
    put(tmp_path, "mmusculus.tsv.gz", "transcript_id\tchrom\tstart\na\t1\t2\n")
    dim = spark.createDataFrame([("mmusculus", "Mus musculus")], "species string, organism string")
    out = files.tsv_with_dimension(spark, str(tmp_path / "mmusculus.tsv.gz"), schema, r"^([a-z]+)\.", "species", dim).first()
    assert (out.organism, out.start) == ("Mus musculus", 2)


def test_annotations_and_their_index(spark, tmp_path):
    gff = files.annotation(spark, put(tmp_path, "a.gff3", GFF))
    assert gff.count() == 3 and files.annotation(spark, str(tmp_path / "a.gff3"), ["gene"]).count() == 2
    index = {r.key: r for r in files.annotation_index(gff, ["transcript_id"], ["ID", "gene_id"], ["Name", "gene_name"], ["Alias", "dbxref"]).collect()}
    assert (index["S000028522"].chrom, index["SGD:S000028522"].start, index["MCO6"].gene_symbol) == ("chrX", 181275, "YJL127C-B")
    assert index["t2"].gene_symbol == "N2" and index["t1"].strand == "."
    yeast = spark.createDataFrame([("Source:SGD;Acc:S000028522", "sgd"), ("YXX", "sgd"), ("o", "plant")], "transcript_id string, db_source string")
    table = files.annotation_index(gff, [], ["ID"], ["Name"], ["Alias", "dbxref"])
    out = resolve.by_annotation(yeast, table, "sgd", "saccharomyces_cerevisiae", {"assembly_name": "R64"}, ids.candidates_yeast, "yeast_not_found")
    assert {(r.transcript_id, r.status, r.reason, r.gene_symbol) for r in out.collect()} == {("Source:SGD;Acc:S000028522", "resolved", None, "YJL127C-B"), ("YXX", "unresolved", "yeast_not_found", None)}
    assert {"t2", "N2", "SGD:S000028522", "S000028522"} <= {r.value for r in files.annotation_values(gff).collect()}


def test_other_listings(spark, tmp_path):
    bed = "chr1\t9\t20\tA.1\t0\t+\nchr1\t1\t2\ttoo few\n#c\n"
    assert [tuple(r)[:5] for r in files.bed(spark, put(tmp_path, "a.bed", bed)).collect()] == [("A.1", "chr1", 10, 20, "+")]
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("v4.bed", bed)
    assert files.bed_archive(spark, put(tmp_path, "b.zip", buf.getvalue())).first().start == 10
    assert {tuple(r) for r in files.pairs(spark, put(tmp_path, "m.txt", "a  1\nb 2\na 3\nlone\n")).collect()} == {("a", "3"), ("b", "2")}
    assert tuple(files.fai(spark, put(tmp_path, "g.fai", "s1\t50\t0\t60\t61\n"), "a").first()) == ("a", "s1", 50)
    report = files.assembly_report(spark, put(tmp_path, "r.txt", "# x\n1\tassembled-molecule\t1\tC\tCM_1\t=\tNC_1\tP\t9\tchr1\r\nshort\n"), "a").first()
    assert (report.sequence_name, report.refseq, report.genbank, report.ucsc_name) == ("1", "NC_1", "CM_1", "chr1")
    assert files.json_list(spark, put(tmp_path, "j.json", json.dumps([{"a": 1}, {"a": 2}])), "a int").count() == 2
    assert {(r.name, r.url) for r in files.nested_rows(spark, {"x": {"url": "u"}, "y": {}}, ["url"]).collect()} == {("x", "u"), ("y", None)}
    put(tmp_path, "k1.status", "ok\n")
    put(tmp_path, "k2.status", "ok: file\n")
    assert {(r.key, r.ok) for r in files.sentinels(spark, str(tmp_path / "*.status")).collect()} == {("k1", True), ("k2", False)}
    assert files.benchmarks(spark, put(tmp_path, "parse.tsv", "s\n1.5\n2.5\n")).first() == ("parse", 1.5)


def test_records_of_genes_and_nucleotides(spark, tmp_path):
    flat = """LOCUS       NM_1
DEFINITION  Some gene,
            long.
ACCESSION   NM_1
VERSION     NM_1.2
DBLINK      Assembly: GCF_000001.1
SOURCE      x
  ORGANISM  Zea mays
COMMENT     derived from NC_005.1 and AB012345.1.
FEATURES             Location/Qualifiers
     source          1..9
                     /db_xref="GeneID:1"
     gene            1..9
                     /gene="abc"
                     /db_xref="GeneID:77"
     CDS             1..3
                     /gene="def"
ORIGIN
        1 acgt acgta
//
"""
    r = files.genbank(spark, put(tmp_path, "a.gb", flat + flat.replace("NM_1", "NM_2"))).orderBy("accession").collect()
    assert len(r) == 2 and (r[0].accession, r[0].organism, r[0].gene_id, r[0].gene_symbol, r[0].genomic, r[0].assembly, r[0].sequence) == ("NM_1.2", "Zea mays", "77", "abc", "NC_005.1", "GCF_000001.1", "ACGTACGTA")
    assert r[0].description == "Some gene, long." and r[0].comment_accessions == ["AB012345.1"]
    features = ">Feature ref|NM_1.2|\n1\t9\tgene\n\t\t\tdb_xref\tGeneID:5\n>Feature ref|NM_2.1|\n1\t2\tgene\n"
    assert {tuple(x) for x in files.feature_table(spark, put(tmp_path, "f.txt", features)).collect()} == {("NM_1.2", "5"), ("NM_2.1", None)}
    xml = "<Entrezgene-Set><Entrezgene><Entrezgene_track-info><Gene-track><Gene-track_geneid>7</Gene-track_geneid></Gene-track></Entrezgene_track-info><Entrezgene_gene><Gene-ref><Gene-ref_locus>abc</Gene-ref_locus></Gene-ref></Entrezgene_gene><Entrezgene_locus><Gene-commentary><Gene-commentary_accession>NC_1</Gene-commentary_accession><Gene-commentary_version>2</Gene-commentary_version></Gene-commentary></Entrezgene_locus></Entrezgene></Entrezgene-Set>"
    g = files.entrez_genes(spark, put(tmp_path, "e.xml", xml)).first()
    assert (g.gene_id, g.symbol, g.genomic) == ("7", "abc", ["NC_1.2"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, v int")
    sinks.tsv(df, f"{tmp_path}/t", "gzip")
    assert spark.read.options(sep="\t", header=True).csv(f"{tmp_path}/t").count() == 2
    sinks.tsv(df.limit(0), f"{tmp_path}/e")
    assert [r.value for r in spark.read.text(f"{tmp_path}/e").collect()] == ["k\tv"]
    for mode in ("append", "ignore"):  # what is there stays, whether rows are written or not
        sinks.tsv(df.limit(0), f"{tmp_path}/t", "gzip", mode)
        sinks.tsv(spark.createDataFrame([], df.schema), f"{tmp_path}/t", "gzip", mode)
        assert spark.read.options(sep="\t", header=True).csv(f"{tmp_path}/t").count() == 2
    sinks.tsv(df, f"{tmp_path}/t", "gzip", "ignore")
    assert spark.read.options(sep="\t", header=True).csv(f"{tmp_path}/t").count() == 2
    assert {tuple(r) for r in sinks.in_batches(spark.range(25).withColumnRenamed("id", "k"), f"{tmp_path}/b", ["k"], 10).collect()} == {(0, 10), (1, 10), (2, 5)}
    failed = spark.createDataFrame([(" GCF_1 ", "assembly_x"), ("GCF_1", "assembly_y"), ("GCF_2", "other"), (None, "assembly_z")], "assembly_accession string, reason string")
    assert [r.value for r in sinks.failed_targets(failed, "assembly_").collect()] == ["GCF_1"]
    page = sinks.html_table(spark.range(40), 25)
    assert page.count("<tr>") == 26 and "25 of 40" in page
    sinks.html_report("r <1>", [("t", df)], f"{tmp_path}/r.html")
    assert "r &lt;1&gt;" in open(f"{tmp_path}/r.html").read()
    sinks.fasta_by(spark.createDataFrame([("zea", ">a\nAC"), ("os", ">b\nGG")], "species string, value string"), f"{tmp_path}/f", "species")
    assert files.fasta(spark, f"{tmp_path}/f/species=zea").first().id == "a"
    sinks.status(f"{tmp_path}/s", ok=3)
    assert open(f"{tmp_path}/s").read() == "ok=3\n"


def test_parsing_keeps_unknown_rows_and_first_classified_ones(spark):
    rec = [("f1", 0, 1, "NM_1.2 a"), ("f1", 0, 2, "ZZ1"), ("f2", 1, 1, "NM_1.2 b"), ("f2", 1, 2, "ZZ1"), ("f2", 1, 3, "q GRMZM2G01_T01 x")]
    known, unknown = parse.parse_ids(spark.createDataFrame(rec, "file string, file_ord int, row_ord int, header string"))
    assert {(r.transcript_id, r.source_file, r.db_source) for r in known.collect()} == {("NM_1.2", "f1", "ncbi"), ("GRMZM2G01_T01", "f2", "plant")}
    assert unknown.count() == 2 and known.columns == schemas.CLASSIFIED.names and unknown.columns == schemas.UNKNOWN.names


def test_records_find_their_tools(spark):
    seq = "ACGUACGU"
    tool = [("A", "NM_1.2 same", "GG"), ("B", "NM_1.2   same", "TT"), ("C", "gi|5|ref|NM_7.1| x", "CC"), ("D", "NM_9.3", "AA"), ("E", "zz", seq), ("F", "yy", seq.replace("U", "T"))]
    rec = [(1, "NM_1.2 same", "x"), (2, "gi_6_ref_NM_7.1_ other", "y"), (3, "NM_9.1", "z"), (4, "none", seq), (5, "nothing", "q")]
    tools = spark.createDataFrame([(t,) for t in "ABCDEFG"], "tool string")
    out, stats = parse.map_to_tools(spark.createDataFrame(rec, "record_id int, header string, seq string"), spark.createDataFrame(tool, "tool string, header string, seq string"), tools)
    by = {r.record_id: r for r in out.collect()}
    assert (by[1].tools, by[1].match_strategy) == ("A,B", "exact_id,exact_header_ws") and by[1].matching_tokens == "A:NM_1.2 same|B:NM_1.2 same"
    assert by[2].match_strategy == "gi_canonical" and (by[3].match_strategy, by[3].matching_tokens) == ("version_aware", "D:NM_9")
    assert (by[4].tools, by[4].match_strategy) == ("E,F", "seq_hash,seq_hash_ut") and (by[5].n_tools, by[5].tools) == (0, "")
    assert {r.tool: r.total for r in stats.collect()} == {"A": 1, "B": 1, "C": 1, "D": 1, "E": 1, "F": 1, "G": 0}


def test_noncode_goes_through_the_releases(spark):
    cls = spark.createDataFrame([(t, "noncode") for t in ("NONDMET000001.2", "NONDMET000002.9", "NONDMET000003.1", "NONDMET000004.1", "NONMDOT000005.1", "NONDMET000006.1", "NONXXXT000007.1", "odd")], "transcript_id string, db_source string")
    genes = spark.createDataFrame([("NONDMET000001", "NONDMEG01")], "key string, value string")
    place = "name string, chrom string, start long, end long, strand string, row_ord long"
    bed5 = spark.createDataFrame([("NONDMET000001.2", "c1", 1, 9, "+", 1), ("NONDMET000002.1", "c2", 1, 9, "+", 2)], place)
    bed4 = spark.createDataFrame([("NONDMET000004.1", "c4", 1, 9, "-", 1)], place)
    known = lambda *v: spark.createDataFrame([(x,) for x in v], "id string")
    out = resolve.noncode(cls, {"v5": (genes, bed5, known("NONDMET000003.1")), "v4": (genes, bed4, known()), "2016": (genes, bed4, known("NONMDOT000005.1"))})
    got = {r.transcript_id: (r.status, r.reason, r.chrom, r.gene_id) for r in out.collect()}
    assert got["NONDMET000001.2"] == ("resolved", None, "c1", "NONDMEG01") and got["NONDMET000002.9"][2:] == ("c2", "NONDMET000002")
    assert got["NONDMET000003.1"][:3] == ("resolved", None, None) and got["NONDMET000004.1"][2] == "c4"
    assert got["NONMDOT000005.1"][1] == "matched_noncode2016_no_coordinates" and got["NONDMET000006.1"][1] == "not_found_in_any_noncode"
    assert got["NONXXXT000007.1"][1] == "unknown_noncode_prefix:NONXXXT" and got["odd"][1] == "invalid_noncode_format" and len(got) == 8


def test_assemblies_are_mapped_or_rejected(spark):
    df = spark.createDataFrame([("t1", "GRCh38", "homo sapiens"), ("t2", "GRCh99", "x"), ("t3", "ARS-UCD2.0", "bos taurus"), ("t4", None, "x")], "transcript_id string, assembly_accession string, organism string")
    out = {r.transcript_id: r for r in resolve.ensembl_assemblies(df, F.lit("110")).collect()}
    assert out["t1"].assembly_accession == "GCF_000001405.40" and out["t1"].fasta_url.endswith("/homo_sapiens/dna/Homo_Sapiens.GRCh38.dna.toplevel.fa.gz")
    assert out["t2"].reason == "grc_mapping_failed:GRCh99" and out["t3"].assembly_accession == "ARS-UCD2.0" and out["t4"].status == "resolved"
    assert {r.transcript_id: r.assembly_accession for r in resolve.ensembl_assemblies(df, F.lit("110"), all_mapped=True).collect()}["t3"] == "GCF_002263795.2"
    chrom = spark.createDataFrame([(a,) for a in ("NC_000001.11", "NT_033779.5", "GCF_000001405.40", "", None, "NC_008394.4")], "assembly_accession string")
    snap = spark.createDataFrame([("NC_000001.11", "GCF_000001405.40")], "accession string, assembly string")
    got = [(r.assembly_accession, r.reason) for r in resolve.chromosome_assemblies(chrom, snap).collect()]
    assert set(got) == {("GCF_000001405.40", None), ("NT_033779.5", "chromosomal_mapping_failed:NT_033779.5"), ("", None), (None, None), ("GCF_000005425.2", None)}


def canonical(spark, data):
    return merge.to_canonical(spark.createDataFrame(data, "transcript_id string, db_source string, chrom string, start long, end long, assembly_name string, organism string, fasta_url string"))


def test_merging_prefers_early_streams_and_fills_addresses(spark):
    a = canonical(spark, [("t1", "ncbi", "1", 1, 2, None, None, None), ("t2", "ncbi", " ", 1, 2, None, None, None), ("t3", "ncbi", "1", 1, None, " tair10 ", None, None)])
    b = canonical(spark, [("t1", "plant", "9", 8, 9, None, None, None), ("t4", "plant", "2", 3, 4, None, "oryza", None), ("t5", "plant", "2", None, None, None, None, "https://h/x.fa")])
    urls = spark.createDataFrame([("TAIR10", "at", "GCF_1", "u1", None, None), ("IRGSP", "oryza", None, "https://h/o.fa.gz", None, None)], "assembly_name string, organism string, assembly_accession string, fasta_url string, gtf_url string, gtf_format string")
    unknown = spark.createDataFrame([("z", "h", "f", "pattern_unmatched")], schemas.UNKNOWN)
    rejected = spark.createDataFrame([("r", "gramene_not_found")], "transcript_id string, reason string")
    out = merge.merge([a, b], [(urls, True)], [rejected], unknown)
    got = {r.transcript_id: r for r in out["resolved"].collect()}
    assert set(got) == {"t1", "t3", "t4"} and got["t1"].chrom == "1" and (got["t3"].assembly_accession, got["t3"].fasta_url) == ("GCF_1", "u1")
    assert got["t4"].assembly_accession.startswith("url_o_")
    assert {(r.transcript_id, r.db_source, r.reason) for r in out["unresolved"].collect()} == {("t2", "ncbi", "missing_coordinates"), ("t5", "plant", "missing_coordinates"), ("r", "plant", "gramene_not_found"), ("z", "unknown", "pattern_unmatched")}
    manifest = merge.download_manifest(out["resolved"])
    assert {r.cache_key for r in manifest.collect()} == {"GCF_1", got["t4"].assembly_accession}
    statuses = spark.createDataFrame([("GCF_1", True)], "key string, ok boolean")
    logs = spark.createDataFrame([(got["t4"].assembly_accession, "HTTP 404")], "key string, text string")
    good, bad = merge.downloads(out["resolved"], statuses, logs)
    assert [r.transcript_id for r in good.collect()] == ["t3"] and {(r.transcript_id, r.fail_detail) for r in bad.collect()} == {("t1", "unknown error"), ("t4", "HTTP 404 error")}
    classified = spark.createDataFrame([(t, "x") for t in ("t1", "t2", "t3", "t4", "t5", "r")], "transcript_id string, db_source string")
    report = merge.resolution_report(classified, unknown, out["resolved"], out["unresolved"])
    assert report["equations"].first().holds and report["funnel"].first().input == 7


def test_first_rows_count_by_their_order(spark, tmp_path):
    cols = "transcript_id string, db_source string, chrom string, start long, end long, gene_id string, row_ord long"
    a = merge.to_canonical(spark.createDataFrame([("t", "ncbi", "1", 1, 2, "late", 9), ("t", "ncbi", "7", 5, 6, "early", 3)], cols))
    b = merge.to_canonical(spark.createDataFrame([("t", "plant", "0", 0, 1, "other", 0), ("u", "plant", "2", 1, 2, "only", 0)], cols))
    unknown = spark.createDataFrame([], schemas.UNKNOWN)
    out = merge.merge([a, b], [], [], unknown)["resolved"]
    assert out.columns == [f.name for f in schemas.RESOLVED] and {(r.transcript_id, r.gene_id) for r in out.collect()} == {("t", "early"), ("u", "only")}

    left = spark.createDataFrame([("x", "r", "unresolved")], "transcript_id string, reason string, status string")
    records = spark.createDataFrame([("x", "NC", ["none", "zz", "aa"])], "accession string, genomic string, gene_ids array<string>")
    coords = "gene_id string, gene_symbol string, chrom string, start long, end long, strand string"
    genes = spark.createDataFrame([("A", g, g, "s", "1", 1, 2, "+") for g in ("aa", "zz")], f"assembly string, gene string, {coords}")
    none = spark.createDataFrame([], f"assembly string, transcript_id string, {coords}")
    assert [r.gene_id for r in resolve.abandoned_third_pass(left, records, spark.createDataFrame([("NC", "A")], "genomic string, assembly string"), none, genes).collect()] == ["zz"]

    species = spark.createDataFrame([("ENSMUST1.2", "ENSMUST", "mouse", "m39")], "transcript_id string, prefix string, species string, build string")
    mart = spark.createDataFrame([("rat", "ENSMUST1.2", "g1", "a", "1", 1, 2, 1, 1), ("mouse", "ENSMUST1.9", "g2", "b", "1", 3, 4, -1, 2)], "species string, transcript string, gene_id string, gene_symbol string, chrom string, start long, end long, strand int, row_ord long")
    assert [(r.gene_id, r.reason) for r in resolve.ensembl(species, mart).collect()] == [("g1", None)]  # any species' mart

    for k in range(30):
        (tmp_path / f"f{k:02}.txt").write_text("key v%d\n" % k + "x y\n" * (300 if k % 7 == 0 else 1))
    assert {r.key: r.value for r in files.pairs(spark, str(tmp_path)).collect()} == {"key": "v29", "x": "y"}


def test_species_resolvers(spark):
    cols = "species string, key string, gene_id string, gene_symbol string, chrom string, start long, end long, strand string"
    index = spark.createDataFrame([("zea_mays", f"Zm{i}", f"g{i}", "s", "1", 1, 2, "+") for i in range(3)], cols)
    cls = spark.createDataFrame([("Zm0_T1", "plant", "h"), ("Zm1", "plant", "h"), ("Zm9", "plant", "h"), ("Solyc1", "plant", "h"), ("qq", "plant", "h"), ("n", "ncbi", "h")], "transcript_id string, db_source string, species_hint string")
    out = resolve.plants(cls, index)
    assert {r.transcript_id: r.reason for r in out.collect()} == {"Zm0_T1": None, "Zm1": None, "Zm9": "plant_gtf_not_found", "Solyc1": "no_gtf_source:solanum_lycopersicum", "qq": "species_unknown"}
    bad = spark.createDataFrame([(f"Zmx{i}", "plant", "h") for i in range(9)], "transcript_id string, db_source string, species_hint string")
    with pytest.raises(RuntimeError, match="zea_mays 0/9"):
        resolve.plants(bad, index)
    assert resolve.plants(bad, index, strict=False).count() == 9
    prefixes = spark.createDataFrame([("ENSMUST", "mus_musculus", "GRCm39")], "prefix string, species string, build string")
    ens = spark.createDataFrame([("ENSMUST00000000001.2", "ensembl"), ("ENSMUST00000000002.1", "ensembl"), ("ENSXT00000000001", "ensembl")], "transcript_id string, db_source string")
    species, unknown = resolve.ensembl_species(ens, prefixes)
    assert [tuple(r)[:3] for r in unknown.collect()] == [("ENSXT", "ENSXT00000000001", 1)]
    mart = spark.createDataFrame([("mus_musculus", "ENSMUST00000000001.9", "g1", "a", "1", 1, 2, 1, 1), ("mus_musculus", "ENSMUST00000000001.9", "g2", "b", "1", 3, 4, -1, 2)], "species string, transcript string, gene_id string, gene_symbol string, chrom string, start long, end long, strand int, row_ord long")
    got = {(r.transcript_id, r.role, r.strand, r.reason) for r in resolve.ensembl(species, mart).collect()}
    assert got == {("ENSMUST00000000001.2", "primary", "+", None), ("ENSMUST00000000001.2", "alternative", "-", None), ("ENSMUST00000000002.1", "primary", None, "ensembl_not_found")}


def test_headers_are_classified_in_a_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("NM_1.2 x\nZZ1\nsee ENST00000000001.1\n")
    stream = spark.readStream.schema("value string").text(str(tmp_path / "in")).withColumnRenamed("value", "header")
    assert classified_stream(stream).isStreaming
    got = []
    q = resolve_stream(stream, lambda df, n: got.extend((r.transcript_id, r.db_source) for r in df.collect()), str(tmp_path / "ck"))
    q.awaitTermination(120)
    assert sorted(got) == [("ENST00000000001.1", "ensembl"), ("NM_1.2", "ncbi"), ("ZZ1", "unknown")]
    assert rows.RESOLVED == "resolved"


def test_small_sinks_and_audits_at_their_edges(spark, tmp_path):
    sinks.failures([], str(tmp_path / "none"))
    assert [r.value for r in spark.read.text(str(tmp_path / "none")).collect()] == ["\t".join(sinks.FAILED)]
    rows_ = spark.createDataFrame([("t1", "unresolved", "why", "x"), ("t2", "resolved", None, "x")], "transcript_id string, status string, reason string, extra string")
    sinks.failures([rows_], str(tmp_path / "some"))
    assert sorted({r.value for r in spark.read.text(str(tmp_path / "some")).collect()}) == ["t1\t\t\t\twhy", "\t".join(sinks.FAILED)]
    assert files.config_urls(spark, None).count() == 0
    out = files.config_urls(spark, {"a": {"url": "u", "assembly_accession": None, "assembly_name": "n"}, "b": "no mapping"}, "db").collect()
    assert [tuple(r) for r in out] == [("db", "n", None, None, "u", None, "a")]
    for name in ("kept.tsv", "biomart/x.tsv.gz", "sub/left.tsv"):
        (tmp_path / "results" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "results" / name).write_text("x")
    found = lambda rule: sorted(r.value for r in files.orphans(spark, str(tmp_path / "results"), put(tmp_path, "rule.smk", rule)).collect())
    assert found('a = "results/kept.tsv"\n') == ["biomart/x.tsv.gz", "sub/left.tsv"]
    assert found('a = f"{RESULTS}/kept.tsv"\nb = "results/biomart/{species}.tsv.gz"\n') == ["sub/left.tsv"]


def test_releases_that_fail_or_are_empty_are_passed_over(spark):
    asked = spark.createDataFrame([("t1", "a"), ("t2", "a"), ("t1", "b"), ("t9", "c"), ("t9", None)], "transcript_id string, species string")
    calls = spark.createDataFrame([("a", "new", 1, "failed"), ("a", "old", 2, "ok"), ("b", "new", 1, "ok"), ("b", "old", 2, "failed")], "species string, release string, release_ord int, state string")
    cells = "species string, release string, transcript_id string, gene_id string, gene_symbol string, chrom string, start long, end long, strand string"
    answers = spark.createDataFrame([("a", "new", "t1", "g0", "s", "1", 1, 2, "+"), ("a", "old", "t1", "g2", "s", "1", 1, 2, "+"), ("a", "old", "t1", "g1", "s", "1", 1, 2, "+"), ("b", "old", "t1", "g3", "s", "1", 1, 2, "+")], cells)
    got = {(r.transcript_id, r.species): (r.gene_id, r.reason) for r in resolve.plants_by_release(asked, calls, answers).collect()}
    assert got == {
        ("t1", "a"): ("g1", None), ("t2", "a"): (None, "biomart_no_match_a"), ("t1", "b"): (None, "biomart_no_match_b_all_releases_exhausted"),
        ("t9", "c"): (None, "no_biomart_dataset_c"), ("t9", None): (None, "not_plant_id"),
    }
    assert resolve.plants_by_release(asked, calls, answers.limit(0)).where("status = 'resolved'").count() == 0


@pytest.mark.parametrize("name", ["q_file_annotation_index", "q_file_annotation_index_last"])
def test_annotation_lines_with_the_same_key_stand_in_the_tables_order(spark, tmp_path, name):
    """Of two files Spark reads the second, larger one first; the table's first row counts, as in SQL over one file."""
    pa, pq = pytest.importorskip("pyarrow"), pytest.importorskip("pyarrow.parquet")
    place = tmp_path / "lineitem.parquet"
    place.mkdir()
    table = []
    for file, n, step in (("a", 20, 1), ("b", 90000, 7)):
        part = [(i * step % 5, i * step * step % 3, "ARN"[i % 3]) for i in range(n)]
        table += part
        columns = dict(zip(("l_partkey", "l_suppkey", "l_returnflag"), map(list, zip(*part))))
        pq.write_table(pa.table({"l_orderkey": [7] * n, "l_linenumber": pa.array([1] * n, pa.int32()), **columns}), place / f"{file}.parquet")
    want = {}
    for p, s, flag in table:
        for key in (f"t{p}", f"g{p}", f"n{s}"):
            want.setdefault(key, (key, f"g{p}", f"n{s}", p, {"A": "+", "R": "-", "N": "."}[flag]))
    got = core.queries()[name](spark, str(tmp_path)).select("key", "gene_id", "gene_symbol", "start_pos", "strand").collect()
    assert sorted(map(tuple, got)) == sorted(want.values())


def test_lines_places_are_numbers_that_order_files_splits_and_lines(spark, tmp_path):
    """A path in every row would be most of what a sort by places holds."""
    want = []
    for name, n in (("a b.gff", 50), ("a%20c.gff", 9000), ("sub/a b.gff", 700), ("sub/d.gff", 20000), ("z.gff", 0)):
        lines = [f"{name}\t{k}" for k in range(n)]
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("".join(f"{x}\n" for x in lines))
        want += lines
    sizes = {"spark.sql.files.maxPartitionBytes": "50k", "spark.sql.files.openCostInBytes": "1k"}
    before = {c: spark.conf.get(c) for c in sizes}
    try:
        for c, v in sizes.items():
            spark.conf.set(c, v)
        lines = files.placed_lines(spark, [str(tmp_path / "*.gff"), str(tmp_path / "sub")])
        assert {f.dataType.typeName() for f in lines.schema["row_ord"].dataType} == {"long"}
        assert lines.rdd.getNumPartitions() > 5
        assert [r.value for r in lines.orderBy("row_ord").collect()] == want
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_noncode_plan_of_parts_with_more_than_six_digits(spark, tmp_path):
    con = pytest.importorskip("duckdb").connect()
    con.execute(f"COPY (SELECT unnest(range(100000, 100010) || range(1000000, 1000060)) AS p_partkey) TO '{tmp_path}/part.parquet'")
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tmp_path}/part.parquet'")
    rel = con.execute(core.oracle_sql()["q_plan_noncode"])
    names = [c[0] for c in rel.description]
    want = sorted(rel.fetchall(), key=repr)
    assert sorted(map(tuple, core.queries()["q_plan_noncode"](spark, str(tmp_path)).select(*names).collect()), key=repr) == want
