"""Column functions on the contracts' cases."""

import pytest
from pyspark.sql import functions as F

from genoweave.functions import attrs, ids, rules, sequence, text


def each(spark, f, values, kind="string"):
    """f of each value, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"n int, v {kind}")
    return [r.x for r in df.select("n", f(F.col("v")).alias("x")).orderBy("n").collect()]


def test_identifiers_are_classified_by_the_first_rule(spark):
    cases = {
        "NM_001234.3": "ncbi", "ENSMUST00000012345.2": "ensembl", "uc001aaa.3": "ucsc", "Zm00001d014535_T001": "plant", "GRMZM2G059865_T01": "plant",
        "NONDMET000001.2": "noncode", "nondmet000001.2": None, "ZZ1": None, "fbtr0005": "flybase", "YDL184C": "sgd", "2L52.1a": "wormbase",
        "AC123.4_FGT001": "plant", "Source:SGD;Acc:S000028522": "sgd", "x_wormbase:known_chromosome:WBcel235:": "wormbase",
    }
    out = each(spark, ids.classify, cases)
    assert [r and r.db_source for r in out] == list(cases.values())
    by = dict(zip(cases, out))
    assert by["Zm00001d014535_T001"].assembly_hint == "B73_RefGen_v4" and by["GRMZM2G059865_T01"].assembly_hint == "B73_v2_v3"
    assert len(rules.ID_RULES) == 52 and len(rules.EMBEDDED_RULES) == 15 and len(rules.ACCESSIONS) == 15


def test_embedded_accessions_may_be_parts_of_names_or_not(spark):
    heads = ["x_GANC_010_y", "see ENST00000012345.2 here", "nothing"]
    assert [r and r.transcript_id for r in each(spark, ids.embedded, heads)] == ["NC_010", "ENST00000012345.2", None]
    assert [r and r.transcript_id for r in each(spark, lambda c: ids.embedded(c, whole_words=True), heads)] == [None, "ENST00000012345.2", None]


def test_headers(spark):
    assert each(spark, ids.primary_token, [">NM_1.2 Homo", "ENST1|gene=A|b", " a\tb"]) == ["NM_1.2", "ENST1", "a"]
    assert each(spark, ids.normalise_id, [">gi|12|ref|NM_5.1| x", "gi_12_ref_XR_7_", "P|q r"]) == ["NM_5.1", "XR_7", "P"]
    assert each(spark, ids.header_tokens, ["ab1 abc1 loc:12345 word x12345|y9999"]) == [["abc1", "x12345", "y9999"]]
    assert set(each(spark, ids.header_ids, ["ENST00000012345.2 foo"])[0]) == {"ENST00000012345.2", "ENST00000012345"}
    assert each(spark, ids.gi_accessions, ["gi|1|ref|NM_1.1| gi|2|ref|NM_2| gi|3|ref|NM_1.1|"]) == [["NM_1.1", "NM_2"]]


def test_three_ways_to_drop_a_version(spark):
    values = ["a.1", "a.b.2", "a.b", "a"]
    assert each(spark, ids.drop_numeric_version, values) == ["a", "a.b", "a.b", "a"]
    assert each(spark, ids.drop_last_part, values) == ["a", "a.b", "a", "a"]
    assert each(spark, ids.first_part, values) == ["a"] * 4


def test_candidates(spark):
    assert each(spark, ids.candidates_generic, ["a|T1.2.3", "Os01t01_02_cdna", "x"]) == [["a|T1.2.3", "a|T1.2", "a|T1", "T1.2.3", "T1.2", "T1"], ["Os01t01_02_cdna", "Os01t01_02", "Os01t01"], ["x"]]
    assert each(spark, ids.candidates_yeast, ["Source:SGD;Acc:S000028522", "YDL184C", "YAL1C_A"]) == [["Source:SGD;Acc:S000028522", "S000028522", "SGD:S000028522"], ["YDL184C"], ["YAL1C_A", "YAL1C", "YAL1C-A"]]
    assert each(spark, ids.candidates_wormbase, ["2L52.1a.1"])[0][:3] == ["2L52.1a.1", "2L52.1a", "2L52"]
    assert each(spark, ids.candidates_gramene, ["GRMZM5G842623_T01", "Os03t0779300_01", "Solyc01g005000.2.1"]) == [["GRMZM5G842623_T01", "GRMZM5G842623"], ["Os03t0779300_01", "Os03t0779300"], ["Solyc01g005000.2.1", "Solyc01g005000.2", "Solyc01g005000"]]
    assert each(spark, ids.candidates_phytozome, ["Potri.001G1.2"])[0] == ["Potri.001G1.2", "Potri.001G1", "Potri"]
    assert "GLYMA_10G011600" in each(spark, ids.candidates_plant, ["Glyma.10G011600.1"])[0]
    assert each(spark, ids.candidates_plant, ["OS01T0100_01"])[0][-4:] == ["Os01T0100_01", "LOC_Os01g0100", "Os01t0100-01", "Os01t0100"]

    def of(species):
        return lambda c: ids.candidates_species(c, F.lit(species))

    assert each(spark, of("oryza_sativa"), ["OS01T01_2", "Os01t01"]) == [["OS01T01_2", "OS01T01", "Os01T01_2"], ["Os01t01", "Os01g01"]]
    assert each(spark, of("solanum_tuberosum"), ["PGSC3DMT4.1"]) == [["PGSC3DMT4.1", "PGSC3DMT4", "PGSC3DMG4.1"]]
    assert each(spark, of("glycine_max"), ["Glyma.1.2.3"]) == [["Glyma.1.2.3", "Glyma.1.2", "Glyma.1"]]
    assert each(spark, of("none"), ["a.1", None]) == [["a.1"], []]


def test_prefixes_go_by_order_and_case(spark):
    assert each(spark, ids.prefix_species, ["ATx", "LOC_Os1", "atx", "Zm1"]) == ["arabidopsis_thaliana", "oryza_sativa", None, "zea_mays"]
    assert each(spark, ids.ensembl_prefix, ["ENSMUST0001", "ensT1", "NM_1"]) == ["ENSMUST", "ENST", ""]


def test_cells(spark):
    assert each(spark, text.clean_null, [" NaN ", "none", "", "x", None]) == [None, None, None, "x", None]
    assert each(spark, text.strand, ["+", "-1", "1", "", None, "?"]) == ["+", "-", "+", ".", ".", "."]
    assert each(spark, lambda c: text.whole(c, 0), ["7", "x", None]) == [7, 0, 0]
    assert each(spark, lambda c: text.map_values(c, rules.UCSC_ASSEMBLIES), ["ce10", " dm6", "hg99"]) == ["GCF_000002985.6", "GCF_000001215.4", "hg99"]
    assert each(spark, text.toggle_chr, ["chrV", "V"]) == ["V", "chrV"]
    assert each(spark, text.organism, ["Zea mays subsp. x", "homo_sapiens"]) == ["zea mays", "homo sapiens"]
    assert each(spark, text.version_stem, ["Cs_154_v1.1.gene.gff3.gz", "Cs.gene_exons.gff3.gz", "Cs.fa"]) == ["Cs_154_v1.1", "Cs", "Cs.fa"]
    assert each(spark, lambda c: text.percent(c, F.lit(8)), [1, 5, 8], "int") == ["12%", "62%", "100%"]
    assert each(spark, lambda c: text.percent(c, F.lit(0)), [1], "int") == ["—"]


def test_addresses(spark):
    import hashlib

    url = "https://h.org/p/Genome v1.FA.gz.ZIP?x=1#y"
    key = "url_Genome_v1_" + hashlib.sha1(url.encode()).hexdigest()[:10]
    none = "url_assembly_" + hashlib.sha1(b"https://h.org").hexdigest()[:10]
    assert each(spark, text.cache_key, [url, "https://h.org", " ", None]) == [key, none, None, None]
    assert each(spark, text.ftp_dir, ["GCF_000001735.4", "GCA_000001735"]) == [f"https://ftp.ncbi.nlm.nih.gov/genomes/all/{p}/000/001/735/" for p in ("GCF", "GCA")]
    got = each(spark, lambda c: text.ensembl_urls(c, F.lit("GRCm39"), F.lit("110")), ["mus musculus", ""])
    assert got[0].fasta_url == "https://ftp.ensembl.org/pub/release-110/fasta/mus_musculus/dna/Mus_Musculus.GRCm39.dna.toplevel.fa.gz" and got[1] is None


def test_logs(spark):
    logs = ["a\nPermanent failure (HTTP 404) here, not retrying\nz", "HTTP 503", "FAILED (exit 2): no index", "t | ERROR    | n | first\nt | ERROR    | n | the message \nok", "fine", ""]
    assert each(spark, text.log_failure, logs) == ["HTTP 404 — not retrying", "HTTP 503 error", "samtools exit 2: no index", "the message", "unknown error", "unknown error"]


def test_regions(spark):
    df = spark.createDataFrame([("", None, None, None, "1:5-9:-1"), ("2", 7, 8, "1", "x:1-2"), (None, None, 4, "", "bad"), (None, None, None, None, None)], "c string, s long, e long, t string, r string")
    out = [tuple(r.x) for r in df.select(text.region(*[F.col(c) for c in "cster"[:1] + "setr"]).alias("x")).collect()]
    assert out == [("1", 5, 9, "-"), ("2", 7, 8, "+"), ("", None, 4, ""), ("", None, None, "")]


def test_attributes(spark):
    cells = ["ID=a;Name=x; Name=y;Alias=p, q,", 'gene_id "g1"; note "a=b"; gene_id "g2";', "nothing", ""]
    assert each(spark, attrs.attr_map, cells) == [{"ID": "a", "Name": "y", "Alias": "p, q,"}, {"gene_id": "g2", "note": "a=b"}, {}, {}]
    assert each(spark, lambda c: attrs.alias_values(attrs.attr_map(c), ["Alias"]), cells)[0] == ["p", "q"]
    assert each(spark, lambda c: attrs.first_attr(attrs.attr_map(c), ["no", "Name"], F.lit("-")), cells) == ["y", "-", "-", "-"]
    assert set(each(spark, attrs.value_forms, ["ID=transcript:ABC;x=y"])[0]) == {"transcript:ABC", "ABC", "y"}


@pytest.mark.parametrize("strand,want", [("+", (5, 23)), ("-", (7, 25)), (".", (7, 25))])
def test_flanks_follow_the_strand(spark, strand, want):
    low, high = sequence.flanked(F.lit(10), F.lit(20), F.lit(strand), F.lit(50), 5, 3)
    assert tuple(spark.range(1).select(low, high).first()) == want
    low, high = sequence.flanked(F.lit(2), F.lit(49), F.lit(strand), F.lit(50), 5, 5)
    assert tuple(spark.range(1).select(low, high).first()) == (0, 50)


def test_sequences(spark):
    assert each(spark, sequence.reverse_complement, ["ACGTN", "RYKMBVDH", "acgu", "SW"]) == ["NACGT", "DHBVKMRY", "acgt", "WS"]
    assert each(spark, lambda c: sequence.slice_of(c, F.lit(1), F.lit(3)), ["acgt", "a"]) == ["CG", None]
    assert len(set(each(spark, sequence.digest_rna, ["ACGU", "acgt"]))) == 1 and len(set(each(spark, sequence.digest, ["ACGU", "acgt"]))) == 2
    exons = spark.createDataFrame([([(9, "GG"), (1, "AC")],)], "e array<struct<start:int,seq:string>>")
    assert [r[0] for r in exons.select(sequence.exon_concat(F.col("e"), F.lit("-"))).collect()] == ["CCGT"]


def test_letters_that_rules_need_change_no_classification(spark):
    """The ladder with every pattern tried, in Python, over identifiers cut from the patterns and changed at random."""
    import random
    import re

    rnd, cases = random.Random(3), set()
    seeds = ["NM_12.3", "ENSMUST00000012345.2", "uc001aaa.3", "x_wormbase:known_chromosome:WBcel235:", "Solyc01g1.2.1", "OS01T01_02_cdna", "Glyma.01G123456.1", "AT1G1.1", "Zm00001d1_T001", "Zm1g2", "GRMZM2G", "LOC_Os1g1", "Os1g1",
        "TraesCS1A.1", "Bradi1g2.3", "Bra12", "BnaA1g1", "BnaC1g1", "Bo1g1", "AETx", "Amtr_1", "evm_27.model.A_b", "evm.model.x.1", "Cre1.g1", "Pp3c1_1V3.1", "Pp1s1_1", "Medtr1g1", "GSMUA_x", "OB1g1", "Si1g1", "Thecc1EG1", "orange1.1g1", "12345.m123456",
        "SM12", "Manes.1A.2", "cassava1.2", "AC1.2", "Potri.1G1", "Sobic.1G.2", "GSVIVT1", "GTVIVG1", "VIT_1s1", "PGSC1DMx", "2L52.1a.1", "FBtr1", "FBgn1", "WBGene1", "YAL1C_A", "Q1234", "Source:SGD;Acc:S1", "NONHSAT1.2", "NONHSAG1.2", "Stub1g2.3", "ref|XM_1.1", "\u017fM12", "\u0131"]
    for s in seeds:
        cases |= {s, s.lower(), s.upper()}
        for _ in range(12):
            k = rnd.randrange(len(s) + 1)
            cases.add(s[:k] + rnd.choice(["", "x", ".", "1", " ", "_"]) + s[k + rnd.randint(0, 1) :])
    cases = sorted(cases)

    def plain(table, text, whole):
        for r in table:
            if re.search(r.pattern, text, re.A | (0 if whole and r.db_source == "noncode" else re.I)):
                return r.db_source, r.species_hint, r.source_hint, r.assembly_hint

    assert [r and tuple(r) for r in each(spark, ids.classify, cases)] == [plain(rules.ID_RULES, c, True) for c in cases]
    heads = [f"say {c} and more" for c in cases] + cases
    assert [r and tuple(r)[1:] for r in each(spark, ids.embedded, heads)] == [plain(rules.EMBEDDED_RULES, h, False) for h in heads]
    assert ids.needle(r"^(A|B)_x+(?:cde)?f") == ("_X", False) and ids.needle(r"(?:ab)?c\d{2}def*g") == ("DE", False) and ids.needle(r"^(ab\.c)\d") == ("AB.C", True)


def test_attributes_are_worked_out_once_a_cell(spark):
    cells = spark.createDataFrame([("a=1;b=x:2;a=3;c",), ('k "v"; k "w:z:1"; z "y"',), ("",), ("=v;x=",)], "cell string")
    forms = cells.select(attrs.value_forms(F.col("cell")).alias("forms"))
    assert [sorted(r.forms) for r in forms.collect()] == [["2", "3", "x:2"], ["w:z:1", "y", "z:1"], [], ["", "v"]]
    assert forms._jdf.queryExecution().analyzed().toString().count("regexp_extract_all") == 2  # names and values
