"""Queries of assembly names, lists of genes, exons, reruns and reports, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import rules, sequence, text
from .operators import genome, joins, rows, summaries
from .plans import merge, parse, resolve
from .queries import GENOME, HEADERS, ladder, query, view
from .sources import files, results, sinks

_HINTS = ("db_source", "species_hint", "source_hint", "assembly_hint")


def _embedded(of: str) -> str:
    arms = " ".join("WHEN regexp_matches(header, '(?i){0}') THEN {1}".format(r.pattern, f"regexp_extract(header, '(?i){r.pattern}', 1)" if of == "transcript_id" else f"'{getattr(r, of)}'") for r in rules.EMBEDDED_RULES)
    return f"CASE {arms} END"


#: Headers of two files; every identifier comes twice or more.
_FILES = f"SELECT header, 'f' || cast(record_id % 2 AS string) AS file, record_id % 2 AS file_ord, record_id AS row_ord FROM ({HEADERS})"


@query(f"""WITH h AS ({_FILES}), c AS (SELECT *, split_part(regexp_extract(header, '^\\S+'), '|', 1) AS t FROM h), k AS (SELECT *, {", ".join(f"{ladder('t', n)} AS {n}" for n in _HINTS)} FROM c),
e AS (SELECT header, file, file_ord, row_ord, CASE WHEN db_source IS NOT NULL THEN t ELSE coalesce({_embedded("transcript_id")}, t) END AS transcript_id, {", ".join(f"CASE WHEN db_source IS NOT NULL THEN {n} ELSE {_embedded(n)} END AS {n}" for n in reversed(_HINTS))} FROM k),
r AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY file_ord, row_ord) AS n FROM e)
SELECT transcript_id, {", ".join(_HINTS)}, header AS raw_header, file AS source_file, NULL AS reason FROM r WHERE db_source IS NOT NULL AND n = 1
UNION ALL SELECT transcript_id, NULL, NULL, NULL, NULL, header, file, 'pattern_unmatched' FROM r WHERE db_source IS NULL""")
def q_parse_rows(spark, d):
    """Whole rows of parse_ids: of the classified the first file's first, all of the unknown."""
    known, unknown = parse.parse_ids(view(spark, d, _FILES))
    return known.withColumn("reason", F.lit(None).cast("string")).unionByName(unknown, allowMissingColumns=True)


# ---- assembly names ----

_NAMES = """SELECT k, CASE k % 8 WHEN 0 THEN 'GRCh38' WHEN 1 THEN ' grcz11 ' WHEN 2 THEN 'GRCX99' WHEN 3 THEN 'GCF_1.1' WHEN 4 THEN 'GRC m39' WHEN 5 THEN 'BDGP6' WHEN 6 THEN 'GRCRH1' END AS assembly_accession,
  CASE k % 3 WHEN 0 THEN 'homo_sapiens' WHEN 1 THEN 'Danio rerio' END AS organism FROM (SELECT o_orderkey AS k FROM orders)"""


@query(f"""WITH n AS ({_NAMES}), m AS (SELECT *, CASE k % 8 WHEN 0 THEN 'GCF_000001405.40' WHEN 1 THEN 'GCF_000002035.6' WHEN 4 THEN 'GCF_000001635.27' WHEN 6 THEN 'GCF_000008735.2' END AS accession, CASE k % 8 WHEN 0 THEN 'GRCh38' WHEN 1 THEN 'GRCz11' WHEN 4 THEN 'GRCm39' END AS title,
  CASE k % 3 WHEN 0 THEN 'homo_sapiens' WHEN 1 THEN 'danio_rerio' END AS folder, CASE k % 3 WHEN 0 THEN 'Homo_Sapiens' WHEN 1 THEN 'Danio_Rerio' END AS file FROM n)
SELECT k, CASE WHEN k % 8 = 2 THEN 'grc_mapping_failed:GRCX99' END AS reason, coalesce(accession, assembly_accession) AS assembly_accession, CASE WHEN k % 8 IN (0, 1, 2, 4, 6) THEN coalesce(title, assembly_accession) END AS assembly_name,
  'https://ftp.ensembl.org/pub/release-115/fasta/' || folder || '/dna/' || file || '.' || title || '.dna.toplevel.fa.gz' AS fasta_url, 'https://ftp.ensembl.org/pub/release-115/gtf/' || folder || '/' || file || '.' || title || '.115.gtf.gz' AS gtf_url FROM m""")
def q_plan_ensembl_assemblies(spark, d):
    return resolve.ensembl_assemblies(view(spark, d, _NAMES), F.lit("115")).select("k", "reason", "assembly_accession", "assembly_name", "fasta_url", "gtf_url")


_BUILDS = "SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN 'ce10' WHEN 1 THEN ' dm6 ' WHEN 2 THEN 'hg99' WHEN 3 THEN 'gcf_9.1' WHEN 4 THEN ' ' END AS assembly_accession FROM orders"


@query(f"""SELECT k, CASE k % 6 WHEN 0 THEN 'GCF_000002985.6' WHEN 1 THEN 'GCF_000001215.4' ELSE assembly_accession END AS assembly_accession, CASE WHEN k % 6 = 2 THEN 'ucsc_mapping_failed:hg99' END AS reason,
  CASE k % 6 WHEN 0 THEN 'GCF_000002985.6' WHEN 1 THEN 'GCF_000001215.4' ELSE assembly_accession END AS kept FROM ({_BUILDS})""")
def q_plan_ucsc_assemblies(spark, d):
    builds = view(spark, d, _BUILDS)
    kept = resolve.ucsc_assemblies(builds, reject=False).withColumnRenamed("assembly_accession", "kept")
    return resolve.ucsc_assemblies(builds).join(kept, "k").select("k", "assembly_accession", "reason", "kept")


@query("""SELECT o_orderkey AS k, CASE WHEN o_custkey % 3 = 0 THEN 'A' || o_custkey WHEN o_custkey % 5 = 0 THEN 'B' || o_custkey WHEN o_custkey % 7 = 0 THEN 'C' || o_custkey END AS assembly,
  CASE WHEN o_custkey % 3 = 0 THEN 0 WHEN o_custkey % 5 = 0 THEN 1 WHEN o_custkey % 7 = 0 THEN 2 END AS service FROM orders""")
def q_three_services(spark, d):
    """Accessions through three lookups, of which the first that answers counts."""
    services = [view(spark, d, f"SELECT c_custkey AS accession, CASE WHEN c_custkey % {n} = 0 THEN concat('{x}', c_custkey) WHEN c_custkey % 2 = 0 THEN '' END AS assembly FROM customer") for x, n in (("A", 3), ("B", 5), ("C", 7))]
    return resolve.genomic_assemblies(view(spark, d, "SELECT o_orderkey AS k, o_custkey AS accession FROM orders"), services).select("k", "assembly", "service")


# ---- lists of genes ----

_LISTS = "SELECT o_orderkey AS k, o_custkey AS a, o_custkey + 2 AS b, o_custkey + 4 AS c FROM orders"
_HITS = "SELECT c_custkey AS gene, c_nationkey AS nation FROM customer WHERE c_custkey % 3 > 0"


@query(f"WITH l AS (SELECT k, unnest([a, b, c]) AS gene FROM ({_LISTS})) SELECT k, l.gene, nation FROM l JOIN ({_HITS}) h ON h.gene = l.gene")
def q_expanded(spark, d):
    """Every gene of a list that a table has."""
    lists = view(spark, d, _LISTS).select("k", F.array("a", "b", "c").alias("genes"))
    return joins.expanded(lists, "genes", view(spark, d, _HITS), "gene", ["k"]).select("k", "gene", "nation")


@query(f"WITH l AS (SELECT k, unnest([a, b, c]) AS gene, generate_subscripts([a, b, c], 1) AS pos FROM ({_LISTS})) SELECT k, min_by(l.gene, pos) AS gene, min_by(nation, pos) AS nation FROM l JOIN ({_HITS}) h ON h.gene = l.gene GROUP BY k")
def q_expanded_first(spark, d):
    """The first gene of a list that a table has."""
    lists = view(spark, d, _LISTS).select("k", F.array("a", "b", "c").alias("genes"))
    return joins.expanded(lists, "genes", view(spark, d, _HITS), "gene", ["k"], first_only=True).select("k", "gene", "nation")


@query("SELECT s_suppkey AS k, n_name AS nation, r_name AS region FROM supplier JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 4 > 0 JOIN region ON r_regionkey = n_regionkey")
def q_hops(spark, d):
    """Two hops of an identifier through lists of one, by the operator that spreads lists."""
    s, n, r = (view(spark, d, q) for q in ("SELECT s_suppkey AS k, array(s_nationkey) AS nations FROM supplier", "SELECT n_nationkey AS nationkey, n_name AS nation, array(n_regionkey) AS regions FROM nation WHERE n_nationkey % 4 > 0", "SELECT r_regionkey AS regionkey, r_name AS region FROM region"))
    first = joins.expanded(s, "nations", n, "nationkey", ["k"])
    return joins.expanded(first, "regions", r, "regionkey", ["k"]).select("k", "nation", "region")


# ---- exons and sequences ----

_EXONS = "SELECT doc_id AS k, cast(doc_id % 3 AS string) AS assembly, 's' || cast(doc_id AS string) AS seqid, no AS exon_no, cast(7 + no * 90 AS bigint) AS ext_start, cast(40 + no * 95 AS bigint) AS ext_end, CASE WHEN doc_id % 2 = 0 THEN '+' ELSE '-' END AS strand FROM documents, (SELECT {0} AS no) n"


@query(f"""WITH g AS ({GENOME}), e AS (SELECT k, seqid, strand, exon_no, substr(seq, ext_start::int + 1, (ext_end - ext_start)::int) AS s FROM ({_EXONS.format("unnest([0, 1, 2])")}) JOIN g USING (assembly, seqid)),
j AS (SELECT k, strand, string_agg(s, '' ORDER BY exon_no) AS s FROM e GROUP BY 1, 2) SELECT k, md5(CASE WHEN strand = '-' THEN reverse(translate(s, 'ACGT', 'TGCA')) ELSE s END) AS seq_md5 FROM j WHERE s <> ''""")
def q_exon_spans(spark, d):
    """Exons cut out of chunks, joined, and turned on the other strand."""
    exons = view(spark, d, _EXONS.format("explode(array(0, 1, 2))"))
    cut = genome.spans(exons, "k", genome.chunked(view(spark, d, GENOME), 64), 64).where("seq <> ''")
    strands = exons.select("k", "strand").distinct()
    return cut.join(strands, "k").select("k", F.md5(sequence.stranded(F.col("seq"), F.col("strand")).cast("binary")).alias("seq_md5"))


@query(f"""WITH e AS ({_EXONS.format("unnest([0, 1, 2])")}), w AS (SELECT *, min(ext_start) OVER (PARTITION BY k) AS a, max(ext_end) OVER (PARTITION BY k) AS b FROM e)
SELECT k, exon_no, CASE WHEN strand = '-' THEN b - ext_end ELSE ext_start - a END AS rel_start, CASE WHEN strand = '-' THEN b - ext_start ELSE ext_end - a END AS rel_end FROM w""")
def q_exon_windows(spark, d):
    return genome.in_window(view(spark, d, _EXONS.format("explode(array(0, 1, 2))")), "k").select("k", "exon_no", "rel_start", "rel_end")


_CUT = "SELECT concat('t', p_partkey) AS transcript_id, concat('c', p_size) AS seqid, p_partkey AS ext_start, p_partkey + 50 AS ext_end, '+' AS strand, concat('g', p_size) AS gene_id, 's' AS gene_symbol, 'o' AS organism, 'a' AS assembly, p_partkey + 10 AS start, p_partkey + 40 AS end, CASE WHEN p_partkey % 2 = 0 THEN true END AS is_ambiguous FROM part"


@query("SELECT 'c' || p_size AS chrom, p_partkey AS start_pos, p_partkey + 50 AS end_pos, 't' || p_partkey AS name, 0 AS score, '+' AS strand, 10 AS upstream_bp, 5 AS downstream_bp, p_partkey % 2 = 0 AS is_ambiguous FROM part")
def q_bed_rows(spark, d):
    """The BED table of extracted rows, written without a header and read back by its columns."""
    path = sinks.scratch(spark)
    table = genome.bed(view(spark, d, _CUT), 10, 5)
    table.write.options(sep="\t", header=False).csv(path)
    back = files.tsv(spark, path, T.StructType([T.StructField(f.name, f.dataType) for f in table.schema]), header=False)
    return back.select("chrom", F.col("chromStart").cast("int").alias("start_pos"), F.col("chromEnd").cast("int").alias("end_pos"), "name", "score", "strand", "upstream_bp", "downstream_bp", "is_ambiguous")


@query("SELECT p_partkey AS k, p_size - 1 AS zero, p_size AS same FROM part")
def q_zero_based(spark, d):
    p = view(spark, d, "SELECT p_partkey AS k, p_size FROM part")
    return p.select("k", sequence.to_zero_based(F.col("p_size"), F.lit(1)).alias("zero"), sequence.to_zero_based(F.col("p_size"), F.lit(0)).alias("same"))


# ---- tools, marts and counts ----


@query("""SELECT 't' || c_custkey AS transcript_id, 'r' AS reason, CASE WHEN c_custkey % 2 = 0 THEN 'a,b' END AS tools, CASE WHEN c_custkey % 2 = 0 THEN 'a' END AS primary_tool FROM customer""")
def q_annotate_unresolved(spark, d):
    unresolved, tool_map = view(spark, d, "SELECT concat('t', c_custkey) AS transcript_id, 'r' AS reason FROM customer"), view(spark, d, "SELECT concat('t', c_custkey) AS transcript_id, 'a,b' AS tools, 'a' AS primary_tool, 'x' AS raw_header FROM customer WHERE c_custkey % 2 = 0")
    return parse.annotate_unresolved(unresolved, tool_map)


@query("SELECT 't' || o_orderkey AS transcript_id, CASE WHEN o_custkey % 2 = 0 THEN o_custkey END AS start_pos, o_custkey + 5 AS end_pos, CASE WHEN o_orderkey % 2 = 0 THEN '+' ELSE '-' END AS strand FROM orders WHERE o_orderkey % 7 > 0")
def q_gene_metadata(spark, d):
    raw = view(spark, d, "SELECT CASE WHEN o_orderkey % 7 > 0 THEN concat('t', o_orderkey) END AS `Transcript stable ID`, CASE WHEN o_custkey % 2 = 0 THEN cast(o_custkey AS string) ELSE 'x' END AS `Gene start`, cast(o_custkey + 5 AS string) AS `Gene end`, CASE WHEN o_orderkey % 2 = 0 THEN 1 ELSE -1 END AS `Strand` FROM orders")
    out = resolve.gene_metadata(raw, {"Transcript stable ID": "transcript_id", "Gene start": "start", "Gene end": "end", "Strand": "strand"})
    return out.select("transcript_id", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "strand")


@query("SELECT c_mktsegment AS db_source, c_nationkey::varchar AS species_hint, count(DISTINCT c_custkey) AS n_transcript_id FROM customer GROUP BY 1, 2")
def q_input_by_species(spark, d):
    return parse.input_by_species(view(spark, d, "SELECT c_mktsegment AS db_source, cast(c_nationkey AS string) AS species_hint, c_custkey AS transcript_id FROM customer"))


@query("""WITH s AS (SELECT c_nationkey AS species, count(*) AS n, count(*) FILTER (c_acctbal > 0) AS r FROM customer GROUP BY 1) SELECT species, n AS total, r AS resolved FROM s WHERE n >= 5""")
def q_status_rates(spark, d):
    c = view(spark, d, "SELECT c_nationkey AS species, c_mktsegment AS kind, c_acctbal > 0 AS ok FROM customer")
    _, shares = merge.status_rates(c, "species", "kind", ["BUILDING"], "ok")
    return shares.select("species", F.col("n").alias("total"), F.col("hits").alias("resolved"))


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'a_b-c.1' WHEN c_custkey % 3 = 1 THEN 'x' END AS name, CASE WHEN c_custkey % 4 > 0 THEN (2000 + c_custkey % 20) || '/' || CASE WHEN c_custkey % 2 = 0 THEN '07' ELSE '01' END || '/' || lpad(((c_custkey % 28) + 1)::varchar, 2, '0') END AS day FROM customer")
def q_names_and_dates(spark, d):
    c = view(spark, d, "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN '_a b-c.1__' WHEN c_custkey % 3 = 1 THEN '..x..' END AS name, CASE WHEN c_custkey % 4 > 0 THEN 2000 + c_custkey % 20 END AS y, CASE WHEN c_custkey % 2 = 0 THEN 7 END AS m, c_custkey % 28 + 1 AS dd FROM customer")
    return c.select("k", text.safe_name(F.col("name")).alias("name"), text.xml_date(F.col("y"), F.col("m"), F.col("dd")).alias("day"))


@query("SELECT 'o' || o_orderkey AS k, ((row_number() OVER (ORDER BY 'o' || o_orderkey) - 1) // 700)::bigint AS batch FROM orders")
def q_batches_by_text(spark, d):
    return rows.batches(view(spark, d, "SELECT concat('o', o_orderkey) AS k FROM orders"), ["k"], 700)


@query("SELECT o_orderkey AS k, (row_number() OVER (PARTITION BY o_custkey % 3 = 0 ORDER BY o_orderdate DESC, o_orderkey) - 1)::bigint AS n FROM orders")
def q_numbered(spark, d):
    """Places in groups of which one holds a third of the rows."""
    o = view(spark, d, "SELECT o_orderkey AS k, o_custkey % 3 = 0 AS g, o_orderdate AS day FROM orders")
    return rows.numbered(o, ["g"], [F.desc("day"), F.asc("k")], "n").select("k", "n")


@query("SELECT 't' || c_custkey AS transcript_id, CASE WHEN c_custkey % 5 > 0 THEN c_nationkey END AS gene, CASE WHEN c_custkey % 5 > 0 THEN 'resolved' ELSE 'unresolved' END AS status FROM customer")
def q_rerun_unresolved(spark, d):
    """A first run that finds half, and a second one, of what is left only, with a larger index: the table is that of one whole run."""
    wanted, path = view(spark, d, "SELECT concat('t', c_custkey) AS transcript_id FROM customer"), sinks.scratch(spark)
    index = view(spark, d, "SELECT concat('t', c_custkey) AS transcript_id, c_nationkey AS gene, c_custkey AS k FROM customer WHERE c_custkey % 5 > 0")

    def resolver(genes):
        return lambda left: rows.route(left.join(genes.drop("k"), "transcript_id", "left"), [(F.col("gene").isNull(), "not_found")])

    results.rerun(wanted, path, resolver(index.where("k % 2 = 0")))
    results.rerun(wanted, path, resolver(index))
    return results.read(spark, path).select("transcript_id", "gene", "status")


@query("""SELECT CASE WHEN o_custkey % 4 = 0 THEN 'exact' WHEN o_custkey % 4 = 1 THEN 'unversioned' END AS match_type, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders) GROUP BY 1""")
def q_filtered_membership(spark, d):
    """Identifiers in a mapping many times as large, of which a filter lets the scan pass on few rows."""
    ids = view(spark, d, "SELECT DISTINCT concat('NM_', o_custkey, '.1') AS transcript_id, o_custkey AS c FROM orders")
    mapping = view(spark, d, "SELECT concat('NM_', c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '.1' ELSE '.2' END) AS external_id FROM customer WHERE c_custkey % 4 < 2 UNION ALL SELECT concat('XR_', l_orderkey, '.', l_linenumber) FROM lineitem")
    return merge.external_check(ids, mapping)


@query("SELECT 'f' || o_custkey AS file, dense_rank() OVER (ORDER BY 'f' || o_custkey)::int - 1 AS file_ord, count(*) AS n FROM orders GROUP BY 1")
def q_source_order(spark, d):
    o = parse.source_order(view(spark, d, "SELECT concat('f', o_custkey) AS file, o_orderkey AS k FROM orders"))
    return o.groupBy("file", "file_ord").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n, count(DISTINCT k) AS n_keys, true AS same FROM (SELECT o_orderkey AS k FROM orders ORDER BY 1 LIMIT 500)")
def q_sampled(spark, d):
    """A sample by a hash of the keys is the same in any order of the rows."""
    o = view(spark, d, "SELECT o_orderkey AS k FROM orders")
    a, b = rows.sampled(o, "k", 500, 3), rows.sampled(o.repartition(5), "k", 500, 3).select(F.col("k").alias("j"))
    both = a.join(b, F.col("k") == F.col("j"), "full")
    return both.agg(F.count("k").alias("n"), F.count_distinct("k").alias("n_keys"), F.every(F.col("k").isNotNull() & F.col("j").isNotNull()).alias("same"))


@query("SELECT count(*) // 400 + CASE WHEN count(*) % 400 > 0 THEN 1 ELSE 0 END AS n FROM orders")
def q_batch_count(spark, d):
    return view(spark, d, "SELECT o_orderkey AS k FROM orders").agg(rows.batch_count(F.count("*"), 400).cast("bigint").alias("n"))


@query("SELECT coalesce(CASE WHEN c_custkey % 2 = 0 THEN 'o' || c_nationkey END, 'unknown') AS label, count(*) AS n FROM customer GROUP BY 1")
def q_species_label(spark, d):
    c = view(spark, d, "SELECT CASE WHEN c_custkey % 2 = 0 THEN concat('o', c_nationkey) END AS species_hint, 'x' AS species FROM customer")
    return summaries.value_counts(c.select(resolve.species_label(c).alias("label")), "label")
