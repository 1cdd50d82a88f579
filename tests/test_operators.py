"""Row, join, summary and genome operators on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from genoweave.functions import rules, text
from genoweave.operators import genome, joins, rows, summaries


def test_routes_keep_every_row(spark):
    df = spark.createDataFrame([(1, "GRCh38"), (2, "GRCh99"), (3, "x"), (4, None)], "k int, a string")
    out = rows.map_or_reject(df, "a", text.map_values(F.col("a"), rules.GRC_ASSEMBLIES, keep=False), F.upper("a").startswith("GRC"), "grc_mapping_failed:")
    assert {(r.k, r.status, r.reason, r.a) for r in out.collect()} == {(1, "resolved", None, "GCF_000001405.40"), (2, "unresolved", "grc_mapping_failed:GRCh99", "GRCh99"), (3, "resolved", None, "x"), (4, "resolved", None, None)}
    assert rows.taken(out).columns == ["k", "a"] and rows.taken(out, "unresolved").count() == 1


def test_coordinates_are_asked_for(spark):
    df = spark.createDataFrame([("1", 1, 2), (" ", 1, 2), (None, 1, 2), ("1", None, 2), ("1", None, None)], "chrom string, start long, end long")
    assert [r.status for r in rows.coordinates_given(df).collect()] == ["resolved", "unresolved", "unresolved", "resolved", "unresolved"]


def test_first_last_and_filled(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("a", "y", 3), (None, "z", 4), (None, "w", 5)], "k string, v string, o int")
    assert {(r.k, r.o) for r in rows.keep_first(df, ["k"], ["o"]).collect()} == {("a", 1), (None, 4)}
    assert {(r.k, r.o) for r in rows.keep_last(df, ["k"], ["o"]).collect()} == {("a", 3), (None, 5)}
    assert {(r.k, r.v) for r in rows.prefer_filled(df, ["k"], "v", ["o"]).collect()} == {("a", "x"), (None, "z")}
    assert {(r.k, r.v) for r in summaries.first_filled_of(df, ["k"], "v", "o").collect()} == {("a", "x"), (None, "z")}


def test_batches_are_full_and_in_order(spark):
    out = rows.batches(spark.range(0, 1050, 1, 7).withColumnRenamed("id", "k").orderBy(F.rand(3)), ["k"], 100).collect()
    assert all(r.batch == r.k // 100 for r in out) and len(out) == 1050


def test_shape(spark):
    df = spark.createDataFrame([("EnsemblPlants", "o", None)], "assembly_accession string, species string, organism string")
    out = rows.nulled(rows.alias_filled(df, {"species": "organism", "nothing": "x"}), "assembly_accession", "EnsemblPlants")
    assert [tuple(r) for r in out.collect()] == [(None, "o")]
    with pytest.raises(ValueError, match="a, b"):
        rows.renamed(df, {"a": "x", "b": "y"})
    twice = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int").toDF("a", "b", "a")
    assert rows.without_repeated_columns(twice).columns == ["a", "b"]
    assert rows.with_defaults(df, {"species": "q", "new": 1}).select("species", "new").first() == ("o", 1)
    from genoweave.schemas import RESOLVED

    canonical = rows.conform(spark.createDataFrame([("t", "x1", "7")], "transcript_id string, start string, end string"), RESOLVED, ["is_ambiguous"]).first()
    assert (canonical.transcript_id, canonical.start, canonical.end, canonical.is_ambiguous, canonical.chrom) == ("t", None, 7, False, None)


def test_fallback_looks_at_the_whole_filter_only(spark):
    df = spark.createDataFrame([(1, "a", "s"), (2, "b", None)], "k int, r string, i string")
    assert [r.k for r in rows.prefixed_or_inferred(df, F.col("r") == "b", F.col("i")).collect()] == [2]
    assert [r.k for r in rows.prefixed_or_inferred(df, F.col("r") == "z", F.col("i")).collect()] == [1]


def test_cascade_takes_the_first_candidate_that_hits(spark):
    rnd = random.Random(1)
    data = [(i, [f"k{rnd.randrange(40)}" for _ in range(rnd.randrange(5))]) for i in range(200)] + [(500, None)]
    index = {f"k{k}": k for k in range(0, 40, 3)}
    df = spark.createDataFrame(data, "id int, c array<string>")
    out = joins.first_match_join(df, spark.createDataFrame(list(index.items()), "key string, v int"), F.col("c"), ["id"]).collect()
    want = {i: next((index[k] for k in c or [] if k in index), None) for i, c in data}
    assert {r.id: r.v for r in out} == want and len(out) == len(data)


def test_versions_fills_and_memberships(spark):
    ids = spark.createDataFrame([("T1.1",), ("T2.9",), ("T3.1",), (None,)], "transcript_id string")
    table = spark.createDataFrame([("T1.1", "a"), ("T1.2", "b"), ("T2.1", "c"), ("T2.2", "d")], "t string, g string")
    out = {(r.transcript_id, r.g, r.match_type) for r in joins.versioned_then_base(ids, table, "transcript_id", "t").collect()}
    assert out == {("T1.1", "a", "versioned"), ("T2.9", "c", "base"), ("T2.9", "d", "base")}
    assert {(r.transcript_id, r.match_type) for r in joins.membership(ids, "transcript_id", table, "t").collect()} == {("T1.1", "exact"), ("T2.9", "unversioned"), ("T3.1", None), (None, None)}
    left = spark.createDataFrame([(" tair10 ", "at", None), (None, "os", None), ("x", "y", "own"), ("TAIR10", "at", "own")], "name string, organism string, url string")
    dim = spark.createDataFrame([("TAIR10", "at", "u1", 2), ("tair10", "zz", "u0", 1), ("IRGSP", "os", "u2", 3), ("x", "y", "u3", 4)], "name string, organism string, url string, o int")
    assert sorted((r.url or "") for r in joins.fill_from(left, dim, ["name"], ["url"], ["o"]).collect()) == ["", "own", "own", "u0"]
    assert sorted(r.url for r in joins.fill_from(left, dim, ["name", "organism"], ["url"], ["o"]).collect()) == ["own", "own", "u0", "u2"]
    keys = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, v int")
    with pytest.raises(ValueError, match="a"):
        joins.validated_join(spark.createDataFrame([("a",)], "k string"), keys, ["k"])
    assert joins.validated_join(spark.createDataFrame([("a",), ("c",)], "k string"), keys, ["k"], strict=False).count() == 2


def test_overlaps_by_the_first_strategy(spark):
    records = spark.createDataFrame([(1, 0, "x"), (1, 1, "y"), (1, 1, "z"), (2, 2, "q"), (3, 0, "n")], "record_id int, prio int, token string")
    tools = spark.createDataFrame([("A", 1, "z"), ("A", 1, "y"), ("A", 2, "q"), ("B", 0, "x"), ("B", 1, "y"), ("C", 0, "q")], "tool string, prio int, token string")
    out = {(r.record_id, r.tool, r.prio, tuple(r.tokens)) for r in joins.overlap_join(records, tools).collect()}
    assert out == {(1, "A", 1, ("y", "z")), (1, "B", 0, ("x",)), (2, "A", 2, ("q",))}


def test_sources_and_expansions(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    src = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early")], "k string, prio int, v string")
    assert {(r.k, r.v) for r in joins.first_source_join(df, src, "k", "prio").collect()} == {("a", "early"), ("b", None)}
    listed = spark.createDataFrame([(1, ["g2", "g1"]), (2, ["g9"])], "id int, genes array<string>")
    genes = spark.createDataFrame([("g1", 10), ("g2", 20)], "gene string, at int")
    assert [(r.id, r.at) for r in joins.expanded(listed, "genes", genes, "gene", ["id"], first_only=True).collect()] == [(1, 20)]
    assert joins.expanded(listed, "genes", genes, "gene", ["id"]).count() == 2
    chain = joins.lookup_chain(spark.createDataFrame([("a", "b")], "x string, y string"), spark.createDataFrame([("a", ""), ("b", "v")], "key string, value string"), [F.col("x"), F.col("y")], "key", "value")
    assert chain.first().value == "v"


def test_guard_flags_groups_without_matches(spark):
    a = spark.createDataFrame([("p", 142), ("q", 1073), ("r", 3)], "s string, n long")
    m = spark.createDataFrame([("q", 561)], "s string, n long")
    out = summaries.match_rates(a, m, "s")
    assert {(r.s, r.flagged) for r in out.collect()} == {("p", True), ("q", False), ("r", False)}
    with pytest.raises(RuntimeError, match="p 0/142"):
        summaries.guard(out, "s")
    summaries.guard(out.where("s <> 'p'"), "s")


def test_ambiguity_splits_primary_from_other_genes(spark):
    df = spark.createDataFrame([("t", "g1", 1), ("t", "g1", 2), ("t", "g2", 3), ("u", "g3", 1)], "t string, g string, o int")
    out = {(r.t, r.o): (r.role, r.is_ambiguous) for r in summaries.ambiguity(df, "t", "g", ["o"]).collect()}
    assert out == {("t", 1): ("primary", True), ("t", 2): ("repeat", True), ("t", 3): ("alternative", True), ("u", 1): ("primary", False)}


def test_counts(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "k string, f int")
    assert [tuple(r) for r in summaries.value_counts(df, "k", top=1).collect()] == [("a", 2)]
    f = summaries.funnel(df, one=F.col("f") == 1, zero=F.col("f") == 0)
    assert [tuple(r)[1:] for r in summaries.balanced(f, {"all": ("total", ["one", "zero"])}).collect()] == [(3, 3, True)]
    tools = spark.createDataFrame([("A",), ("B",)], "tool string")
    matches = spark.createDataFrame([("A", "exact_id"), ("A", "seq_hash")], "tool string, strategy string")
    assert {tuple(r) for r in summaries.strategy_counts(matches, tools, ["exact_id", "seq_hash", "regex_scan"]).collect()} == {("A", 1, 1, 0, 2), ("B", 0, 0, 0, 0)}
    assert {(r.metric, r.value) for r in summaries.long_summary(f, ["total", "one"]).collect()} == {("total", 3.0), ("one", 2.0)}


REPORT = [("a", 1, "1", "assembled-molecule", "1", "CM_1", "NC_1", "na"), ("a", 2, "V", "assembled-molecule", "V", "na", "NC_5", "chrV"), ("a", 3, "scaf", "unplaced-scaffold", "1", "GL_3", "NW_3", "na"), ("a", 4, "lost", "unplaced-scaffold", "na", "GL_4", "na", "na"), ("b", 5, "1", "assembled-molecule", "1", "CM_9", "NC_9", "na")]


def test_chromosome_names(spark):
    report = spark.createDataFrame(REPORT, "assembly string, row_ord long, sequence_name string, role string, molecule string, genbank string, refseq string, ucsc_name string")
    aliases = genome.chrom_aliases(report)
    found = {(r.assembly, r.alias): r.seqid for r in aliases.where("cand_ord = 0").collect()}
    assert found["a", "1"] == "NC_1" and found["a", "v"] == "NC_5" and found["a", "scaf"] == "NW_3" and ("a", "lost") not in found
    index = spark.createDataFrame([("a", "NC_1", 10), ("a", "NC_5", 10), ("a", "5", 10), ("b", "CM_9", 10)], "assembly string, seqid string, length long")
    asked = {("a", "chr1"): "NC_1", ("a", "chrV"): "NC_5", ("a", "v"): "NC_5", ("a", "chr5"): "5", ("b", "1"): "CM_9", ("a", "chrZ"): None, ("a", None): None}
    df = spark.createDataFrame([(k, a, c) for k, (a, c) in enumerate(asked)], "k int, assembly string, chrom string")
    out = {(r.assembly, r.chrom): r.seqid for r in genome.resolve_chroms(df, aliases, index, "k").collect()}
    assert out == asked


def test_slices_equal_plain_ones(spark):
    rnd = random.Random(2)
    seqs = {f"s{k}": "".join(rnd.choice("ACGTNacgt") for _ in range(rnd.randrange(0, 400))) for k in range(6)}
    chunks = genome.chunked(spark.createDataFrame([("a", k, s) for k, s in seqs.items()], "assembly string, seqid string, seq string"), 16)
    index = genome.genome_index(chunks)
    assert {r.seqid: r.length for r in index.collect()} == {k: len(s) for k, s in seqs.items()}
    genes = [(f"t{i}", rnd.choice(["a", "a", "a", "b"]), rnd.choice([*seqs, "chrs1", "zz"]), rnd.choice([None, rnd.randrange(450)]), rnd.randrange(450), rnd.choice("+-."), False) for i in range(150)]
    df = spark.createDataFrame(genes, "transcript_id string, assembly string, chrom string, start long, end long, strand string, is_ambiguous boolean")
    none = spark.createDataFrame([], "assembly string, alias string, cand_ord int, seqid string")
    out = genome.extract(df, chunks, none, index, 7, 4, size=16)
    turn = str.maketrans("ACGTN", "TGCAN")
    for r in out.collect():
        g = next(x for x in genes if x[0] == r.transcript_id)
        name = {"chrs1": "s1"}.get(g[2], g[2])
        if g[3] is None:
            want = "missing_coordinates"
        elif g[1] == "b":
            want = "assembly_not_cached"
        elif name not in seqs:
            want = "chrom_not_found"
        else:
            s, e = sorted(g[3:5])
            up, down = (7, 4) if g[5] == "+" else (4, 7)
            a, b = max(0, s - up), min(len(seqs[name]), e + down)
            cut = seqs[name][a:b].upper() if b > a else ""
            want = "sequence_error" if not cut else None
            if cut:
                assert r.seq == (cut.translate(turn)[::-1] if g[5] == "-" else cut) and (r.ext_start, r.ext_end) == (a, b)
        assert r.reason == want
    good = rows.taken(out).withColumns({c: F.lit(None).cast("string") for c in ("gene_id", "gene_symbol", "organism")})
    assert len(genome.bed(good, 7, 4).columns) == 15
    record = genome.fasta_text(good, 7, 4, width=10).first().value.split("\n")
    assert " gene=nan symbol=nan " in record[0] and record[0].endswith("upstream=7 downstream=4") and all(len(x) == 10 for x in record[1:-1])


def test_two_passes_over_an_annotation(spark):
    gff = spark.createDataFrame([("exon", "t1", "g1", "c", 1, 2, "+", 1), ("gene", None, "g1", "c", 1, 9, "+", 2), ("gene", None, "g1", "d", 5, 6, "-", 3), ("exon", "t2", "g7", "c", 1, 2, "+", 4)], "feature string, transcript_id string, gene_id string, chrom string, start long, end long, strand string, row_ord long")
    out = genome.annotations_by_gene(gff, spark.createDataFrame([("t1",), ("t2",), ("t3",)], "transcript_id string")).collect()
    assert [tuple(r) for r in out] == [("t1", "g1", "c", 1, 9, "+")]


def test_numbered_is_row_number_for_hot_keys_nulls_and_text(spark):
    df = spark.range(6000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise((F.col("id") % 50).cast("string")).alias("k"), F.format_string("t%05d", F.col("id") * 79 % 6007).alias("o"), "id")
    got = {r["id"]: r["number"] for r in rows.numbered(df, ["k"], ["o"]).collect()}
    groups: dict = {}
    for r in df.collect():
        groups.setdefault(r["k"], []).append((r["o"], r["id"]))
    assert got == {i: n for g in groups.values() for n, (_, i) in enumerate(sorted(g))}
    assert rows.numbered(df.limit(0), ["k"], ["o"]).count() == 0


def test_batches_by_text_and_descending_with_ties(spark):
    df = spark.range(2500).select((F.col("id") % 9).cast("string").alias("o"), "id")
    got = sorted(((r["o"], r["id"]), r["batch"]) for r in rows.batches(df, ["o", "id"], 100).collect())
    assert [b for _, b in got] == [n // 100 for n in range(2500)]
    down = {r["id"]: r["batch"] for r in rows.batches(df, [F.desc("o"), F.desc("id")], 100).collect()}
    want = sorted(range(2500), key=lambda i: (str(i % 9), i), reverse=True)
    assert down == {i: n // 100 for n, i in enumerate(want)}


def test_a_filter_of_keys_changes_no_membership(spark):
    ids = spark.createDataFrame([(f"NM_{k}.{k % 3}",) for k in range(200)] + [(None,)], "transcript_id string")
    known = spark.range(20_000).select(F.concat(F.lit("NM_"), F.col("id") % 7000, F.lit("."), F.col("id") % 2).alias("external_id")).unionByName(spark.createDataFrame([(None,)], "external_id string"))
    plain, filtered = (sorted(map(tuple, joins.membership(ids, "transcript_id", known, "external_id", bits).collect()), key=repr) for bits in (0, 14))
    assert plain == filtered and {m for _, m in plain} == {"exact", "unversioned", None}
    left = joins.maybe_in(known, "external_id", joins.key_bits(ids, "transcript_id", 20), 20)
    assert left.join(ids, left.external_id == ids.transcript_id).count() == known.join(ids, known.external_id == ids.transcript_id).count() and left.count() < 1500


def test_routes_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(x):
        seen.add(1)
        return x

    parts = rows.routes(rows.route(spark.range(10).select(counted("id").alias("k")), [(F.col("k") % 3 == 0, "third")]))
    assert sorted(r.k for r in parts["resolved"].collect()) == [1, 2, 4, 5, 7, 8] and {(r.k, r.reason) for r in parts["unresolved"].collect()} == {(0, "third"), (3, "third"), (6, "third"), (9, "third")}
    assert seen.value == 10
