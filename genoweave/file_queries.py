"""Queries of the sources and sinks: rows of the driver's tables are written to the shared folder as files, and read back.

Their SQL makes the same rows from the tables.
"""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators import genome, rows
from .queries import _EXTRACT_ORACLE, GENOME, extracted, query, view
from .shared import written
from .sources import files, indexed, records, sinks

_SEQ = "translate(hex(text), '0123456789ABCDEF', 'ACGTACGTACGTACGN')"
_DOCS = f"SELECT doc_id, {_SEQ} AS seq FROM documents"


def put(df, order=(), mode=sinks.text):
    """df's texts as files in order, part by part, or, where what is read has no order, as they come; their folder."""
    path = sinks.scratch(df.sparkSession)
    mode((df.orderBy(*order) if order else df).select("value"), path)
    return path


# ---- sequences ----


@query(f"SELECT 'd' || doc_id AS id, 'd' || doc_id || ' gene=g symbol=s organism=o assembly=nan loc=q:0-9(+) upstream=5 downstream=7' AS description, md5(seq) AS seq_md5 FROM ({_DOCS})")
def q_file_fasta(spark, d):
    docs = view(spark, d, f"SELECT concat('d', doc_id) AS transcript_id, 'g' AS gene_id, 's' AS gene_symbol, 'o' AS organism, cast(NULL AS string) AS assembly, 'q' AS seqid, 0 AS ext_start, 9 AS ext_end, '+' AS strand, {_SEQ} AS seq FROM documents")
    path = sinks.scratch(spark)
    sinks.text(genome.fasta_text(docs, 5, 7), path)
    return files.fasta(spark, path).select("id", "description", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query("SELECT source AS folder, count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM documents GROUP BY 1")
def q_file_fasta_by(spark, d):
    docs = view(spark, d, f"SELECT source AS folder, concat('>d', doc_id, ' x', chr(10), substring({_SEQ}, 1, 50)) AS value FROM documents")
    path = sinks.scratch(spark)
    sinks.fasta_by(docs, path, "folder")
    ids = files.fasta_ids(spark, f"{path}/*").select(F.regexp_extract("file", "/folder=([^/]*)/", 1).alias("folder"), "id")
    return ids.groupBy("folder").agg(F.count("*").alias("n"), F.count_distinct("id").alias("n_ids"))


@query("SELECT count(*) AS n FROM part")
def q_file_record_counts(spark, d):
    path = put(view(spark, d, "SELECT p_partkey AS k, concat('>p', p_partkey, chr(10), 'ACGT') AS value FROM part"), ["k"])
    return files.record_counts(spark, path).agg(F.sum("n").alias("n"))


def _tar(members):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


def _zip(members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in members:
            z.writestr(name, data)
    return out.getvalue()


@query("SELECT n_nationkey AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'tgz' ELSE 'zip' END AS kind, replace(upper(n_name), ' ', '_') AS id, 'ACGTTT' AS seq FROM nation UNION ALL SELECT NULL, 'broken', NULL, NULL")
def q_file_fasta_archives(spark, d):
    nations = view(spark, d, "SELECT n_nationkey AS k, replace(upper(n_name), ' ', '_') AS name FROM nation").collect()  # 25 rows
    path = sinks.scratch(spark)
    members = [(r.k, f"m/{r.k}.fa", f">{r.name} d\nACG\nTTT\n".encode()) for r in nations]
    sinks.small_bytes(_tar([(f"{n}.gz", gzip.compress(b)) for k, n, b in members if k % 2 == 0] + [("m/readme.txt", b">no\nA\n")]), f"{path}/a.tgz")
    sinks.small_bytes(_zip([(n, b) for k, n, b in members if k % 2]), f"{path}/b.zip")
    sinks.small_bytes(b"not an archive", f"{path}/c.tar")
    read = files.fasta_archives(spark, path)
    k = F.regexp_extract("file", r"m/(\d+)\.fa", 1).try_cast("int")
    out = read.select(k.alias("k"), F.when(F.col("file").contains(".tgz"), "tgz").otherwise("zip").alias("kind"), "id", "seq")
    failed = files.archive_members(spark, path).where("error is not null").select(F.lit(None).cast("int").alias("k"), F.lit("broken").alias("kind"), F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("seq"))
    return out.unionByName(failed)


_CHUNK = 500
_LETTERS = "." * 70


@query(f"""WITH s AS (SELECT doc_id, {_SEQ} AS seq FROM documents), c AS (SELECT doc_id, seq, unnest(range(0, greatest(1, (length(seq) + {_CHUNK - 1}) // {_CHUNK}))) AS chunk_no FROM s)
SELECT 'd' || doc_id AS id, chunk_no::int AS chunk_no, md5(substr(seq, chunk_no * {_CHUNK} + 1, {_CHUNK})) AS seq_md5 FROM c""")
def q_file_fasta_chunks(spark, d):
    """Sequences over several lines, read by lines as chunks that lines and splits of files cross."""
    records_of = view(spark, d, f"SELECT doc_id AS k, concat('>d', doc_id, ' x', chr(10), regexp_replace(seq, '({_LETTERS})', concat('$1', chr(10)))) AS value FROM ({_DOCS})")
    return records.fasta_chunks(spark, put(records_of, ["k"]), "a", _CHUNK).select(F.col("seqid").alias("id"), "chunk_no", F.md5(F.col("seq").cast("binary")).alias("seq_md5"))


@query(f"""SELECT 'd' || doc_id AS seqid, length(seq) AS length, least(length(seq), 70) AS line_bases, CASE WHEN seq = '' THEN 0 ELSE least(length(seq), 70) + 1 END AS line_width, true AS regular FROM (SELECT doc_id, {_SEQ} AS seq FROM documents)""")
def q_file_fasta_index(spark, d):
    """The index of FASTA files, worked out by split."""
    records_of = view(spark, d, f"SELECT doc_id AS k, concat('>d', doc_id, ' x', CASE WHEN seq = '' THEN '' ELSE chr(10) END, regexp_replace(regexp_replace(seq, '({_LETTERS})', concat('$1', chr(10))), '\\n$', '')) AS value FROM ({_DOCS})")
    return records.fasta_index(spark, put(records_of, ["k"]), "a").select("seqid", "length", "line_bases", "line_width", "regular")


@query(_EXTRACT_ORACLE)
def q_extract_indexed(spark, d):
    """As q_extract, but regions are read out of FASTA files by their index, and the files as wholes never."""
    path = sinks.scratch(spark)
    genome_rows = view(spark, d, GENOME).select("assembly", F.concat(F.lit(">"), "seqid", F.lit("\n"), F.regexp_replace("seq", "(.{61})", "$1\n")).alias("value"))
    sinks.fasta_by(genome_rows, path, "assembly")
    index = written(records.fasta_index(spark, f"{path}/*", "").withColumn("assembly", F.regexp_extract("path", "/assembly=([^/]*)/", 1)))
    return extracted(spark, d, lambda regions: indexed.indexed_slices(regions, index, "transcript_id"), index.select("assembly", "seqid", "length"))


@query(f"SELECT 'd' || doc_id AS id, md5(seq) AS seq_md5, CAST(NULL AS varchar) AS failed FROM ({_DOCS}) UNION ALL SELECT NULL, NULL, 'broken.fa.gz' UNION ALL SELECT NULL, NULL, 'broken.zip'")
def q_file_failures_by_file(spark, d):
    """FASTA files of which some are broken: the others' records, and a row for each that failed."""
    path = put(view(spark, d, f"SELECT concat('>d', doc_id, chr(10), seq) AS value FROM ({_DOCS})"))
    sinks.small_bytes(gzip.compress(b"no record")[:-9], f"{path}/broken.fa.gz")
    sinks.small_bytes(b"PK not a directory", f"{path}/broken.zip")
    found, failed = files.fasta_and_failures(spark, path)
    good = found.select("id", F.md5(F.col("seq").cast("binary")).alias("seq_md5"), F.lit(None).cast("string").alias("failed"))
    return good.unionByName(failed.select(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("seq_md5"), files.file_name(F.col("file")).alias("failed")))


# ---- annotations ----

_LINES = "SELECT l_orderkey * 10 + l_linenumber AS k, l_partkey AS part, l_suppkey AS supp, l_linenumber AS line, CASE l_linenumber % 3 WHEN 0 THEN 'gene' WHEN 1 THEN 'mRNA' ELSE 'exon' END AS feature, CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE '?' END AS sign FROM lineitem"
_GFF_LINES = """SELECT {0}, concat('chr', supp % 7, chr(9), 's', chr(9), feature, chr(9), part, chr(9), part + 9, chr(9), '.', chr(9), sign, chr(9), '.', chr(9),
CASE WHEN k % 2 = 0 THEN concat('ID=transcript:t', part, ';Name=n', supp, ';Alias=a', line, ',b', part % 5) ELSE concat('gene_id "g', part, '"; transcript_id "t', part, '"; gene_name "n', supp, '";') END) AS value FROM ({1})"""
_GFF = f"""{_GFF_LINES.format("k", _LINES)}
UNION ALL SELECT -1, '# comment' UNION ALL SELECT -2, 'short line' UNION ALL SELECT -3, '>chr1'"""


@query(f"""SELECT 'chr' || (supp % 7) AS seqid, feature, part AS start_pos, part + 9 AS end_pos, sign AS strand, CASE WHEN k % 2 = 0 THEN 'transcript:t' || part END AS own_id, CASE WHEN k % 2 = 1 THEN 'g' || part END AS gene_id, count(*) AS n
FROM ({_LINES}) WHERE feature <> 'exon' GROUP BY ALL""")
def q_file_annotation(spark, d):
    gff = files.annotation(spark, put(view(spark, d, _GFF)), ["gene", "mRNA"])
    out = gff.select("seqid", "feature", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "strand", F.col("attrs")["ID"].alias("own_id"), F.col("attrs")["gene_id"].alias("gene_id"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query(f"SELECT feature, count(*) AS n FROM ({_LINES}) WHERE k % 2 = 1 AND part % 10 = 7 GROUP BY 1")
def q_file_annotation_pattern(spark, d):
    """Lines of an annotation that a pattern finds, whatever their fields."""
    gff = files.annotation(spark, put(view(spark, d, _GFF)), pattern=r'gene_id "g\d*7";')
    return gff.groupBy("feature").agg(F.count("*").alias("n"))


_INDEX = f"""WITH l AS (SELECT * FROM ({_LINES}) WHERE k % 2 = 1), names AS (SELECT k, part, supp, sign, unnest(['t' || part, 'g' || part, 'n' || supp]) AS key FROM l)
SELECT key, {{0}}('g' || part, k) AS gene_id, {{0}}('n' || supp, k) AS gene_symbol, {{0}}(part, k) AS start_pos, {{0}}(CASE WHEN sign = '?' THEN '.' ELSE sign END, k) AS strand FROM names GROUP BY key"""


#: The lines with their rows' places in the table, which order those with the same k.
_PLACED = _GFF_LINES.format("k, g_file, g_place", _LINES.replace(" FROM lineitem", ", g_file, g_place FROM lineitem"))


def _index(spark, d, on_dup):
    """Of rows with the smallest or largest k, SQL takes the table's first: its line comes first of theirs, or last."""
    toward = F.asc if on_dup == "first" else F.desc
    ties = [toward("g_file"), toward("g_place")]
    gff = files.annotation(spark, put(view(spark, d, _PLACED, placed=True).where("k % 2 = 1"), ["k", *ties]))
    out = files.annotation_index(gff, ["transcript_id"], ["gene_id"], ["gene_name"], on_dup=on_dup)
    return out.select("key", "gene_id", "gene_symbol", F.col("start").alias("start_pos"), "strand")


@query(_INDEX.format("min_by"))
def q_file_annotation_index(spark, d):
    return _index(spark, d, "first")


@query(_INDEX.format("max_by"))
def q_file_annotation_index_last(spark, d):
    return _index(spark, d, "last")


@query(f"""WITH l AS ({_LINES}) SELECT DISTINCT unnest(CASE WHEN k % 2 = 0 THEN ['transcript:t' || part, 't' || part, 'n' || supp, 'a' || line || ',b' || (part % 5)] ELSE ['g' || part, 't' || part, 'n' || supp] END) AS value FROM l""")
def q_file_annotation_values(spark, d):
    return files.annotation_values(files.annotation(spark, put(view(spark, d, _GFF))))


@query("SELECT 'n' || p_partkey AS name, 'c' || (p_partkey % 9) AS chrom, p_partkey + 1 AS start_pos, p_partkey + 20 AS end_pos, '+' AS strand FROM part")
def q_file_bed(spark, d):
    lines = view(spark, d, "SELECT p_partkey AS k, concat_ws(chr(9), concat('c', p_partkey % 9), p_partkey, p_partkey + 20, concat('n', p_partkey), 0, '+') AS value FROM part UNION ALL SELECT -1, 'track name=x' UNION ALL SELECT 0, concat('c', chr(9), 1)")
    return files.bed(spark, put(lines, ["k"])).select("name", "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"), "strand")


@query("SELECT 'n' || n_nationkey AS name, 'c' || n_regionkey AS chrom, n_nationkey + 1 AS start_pos, n_nationkey + 5 AS end_pos FROM nation")
def q_file_bed_archive(spark, d):
    nations = view(spark, d, "SELECT n_nationkey AS k, n_regionkey AS r FROM nation").collect()  # 25 rows
    path = f"{sinks.scratch(spark)}/a.zip"
    sinks.small_bytes(_zip([(f"{r.k}.bed", f"c{r.r}\t{r.k}\t{r.k + 5}\tn{r.k}\t0\t+\r\n".encode()) for r in nations]), path)
    return files.bed_archive(spark, path).select("name", "chrom", F.col("start").alias("start_pos"), F.col("end").alias("end_pos"))


# ---- tables and listings ----


@query("SELECT 'p' || ps AS key, max_by('o' || o, o) AS value FROM (SELECT o_custkey AS ps, o_orderkey AS o FROM orders) GROUP BY 1")
def q_file_pairs(spark, d):
    lines = view(spark, d, "SELECT o_orderkey AS k, concat('p', o_custkey, '   o', o_orderkey, ' more') AS value FROM orders UNION ALL SELECT -1, 'alone'")
    return files.pairs(spark, put(lines, ["k"]))


@query("SELECT 'a' AS assembly, 's' || s_suppkey AS seqid, s_suppkey * 100 AS length FROM supplier")
def q_file_fai(spark, d):
    lines = view(spark, d, "SELECT s_suppkey AS k, concat_ws(chr(9), concat('s', s_suppkey), s_suppkey * 100, 7, 60, 61) AS value FROM supplier")
    return files.fai(spark, put(lines, ["k"]), "a")


@query("SELECT 'a' AS assembly, 's' || s_suppkey AS sequence_name, 'assembled' AS role, 'm' AS molecule, 'CM' || s_suppkey AS genbank, 'NC' || s_suppkey AS refseq, CASE WHEN s_suppkey % 2 = 0 THEN 'chr' || s_suppkey END AS ucsc_name FROM supplier")
def q_file_assembly_report(spark, d):
    lines = view(spark, d, """SELECT s_suppkey AS k, concat(concat_ws(chr(9), concat('s', s_suppkey), 'assembled', 'm', 'x', concat('CM', s_suppkey), '=', concat('NC', s_suppkey), 'unit', '9'),
      CASE WHEN s_suppkey % 2 = 0 THEN concat(chr(9), 'chr', s_suppkey) ELSE '' END) AS value FROM supplier UNION ALL SELECT -1, '# Assembly name'""")
    return files.assembly_report(spark, put(lines, ["k"]), "a").drop("row_ord")


_CELLS = "SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'NA' WHEN 1 THEN 'nan' ELSE 'v' || cast(o_custkey AS string) END AS v, CASE WHEN o_orderkey % 3 = 0 THEN 'x' ELSE cast(o_custkey AS string) END AS w FROM orders"


@query(f"SELECT k, CASE WHEN v NOT IN ('NA', 'nan') THEN v END AS v, TRY_CAST(w AS bigint) AS w FROM ({_CELLS})")
def q_file_tsv(spark, d):
    path = sinks.scratch(spark)
    sinks.tsv(view(spark, d, _CELLS), path, compression="gzip")
    schema = T.StructType().add("k", "long").add("v", "string").add("w", "long")
    missing = files.tsv(spark, f"{path}-absent", schema)
    return files.tsv(spark, path, schema).unionByName(missing)


@query("SELECT 'k,v' AS header, CAST(0 AS bigint) AS n")
def q_file_header_only(spark, d):
    path = sinks.scratch(spark)
    sinks.tsv(view(spark, d, "SELECT o_orderkey AS k, o_custkey AS v FROM orders").where("k < 0"), path)
    lines = spark.read.text(path)
    return lines.agg(F.max(F.replace("value", F.lit("\t"), F.lit(","))).alias("header"), (F.count("*") - 1).alias("n"))


@query("SELECT n_nationkey AS k, 'r' || n_regionkey AS region, r_name AS name FROM nation LEFT JOIN region ON r_regionkey = n_regionkey")
def q_file_tsv_with_dimension(spark, d):
    path = sinks.scratch(spark)
    nations = view(spark, d, "SELECT n_nationkey AS k, n_regionkey AS r FROM nation").collect()  # 25 rows
    for region in {r.r for r in nations}:
        cells = "".join(f"{r.k}\n" for r in nations if r.r == region)
        sinks.small_bytes(gzip.compress(f"k\n{cells}".encode()), f"{path}/r{region}.tsv.gz")
    dim = view(spark, d, "SELECT concat('r', r_regionkey) AS region, r_name AS name FROM region")
    return files.tsv_with_dimension(spark, path, T.StructType().add("k", "long"), r"^([^.]*)\.", "region", dim)


@query("SELECT 'k' || c_custkey AS id, c_nationkey AS n FROM customer")
def q_file_manifest(spark, d):
    path = sinks.scratch(spark)
    sinks.manifest(view(spark, d, "SELECT concat('k', c_custkey) AS id, c_nationkey AS n FROM customer"), path)
    return spark.read.schema("id string, n int").json(path)


@query("SELECT 'k' || n_nationkey AS id, n_regionkey AS n FROM nation")
def q_file_json_list(spark, d):
    path = f"{sinks.scratch(spark)}/list.json"
    sinks.small_text(sinks.report_json(view(spark, d, "SELECT concat('k', n_nationkey) AS id, n_regionkey AS n FROM nation")), path)
    return files.json_list(spark, path, "id string, n int")


@query("SELECT n_nationkey AS k, n_nationkey % 3 = 0 AS ok, CASE WHEN n_nationkey % 3 = 0 THEN 'ok' ELSE 'no ' || n_nationkey END AS text FROM nation")
def q_file_sentinels(spark, d):
    path = sinks.scratch(spark)
    for r in view(spark, d, "SELECT n_nationkey AS k FROM nation").collect():  # 25 rows
        sinks.small_text("ok\n" if r.k % 3 == 0 else f" no {r.k}\n", f"{path}/{r.k}.status")
    return files.sentinels(spark, path).select(F.col("key").cast("int").alias("k"), "ok", "text")


@query("SELECT 'rule' || n_nationkey AS rule, n_nationkey + 0.5 AS seconds FROM nation")
def q_file_benchmarks(spark, d):
    path = sinks.scratch(spark)
    for r in view(spark, d, "SELECT n_nationkey AS k FROM nation").collect():  # 25 rows
        sinks.small_text(f"s\th:m:s\n{r.k + 0.5}\t0:00:01\n", f"{path}/rule{r.k}.tsv")
    return files.benchmarks(spark, path)


@query("SELECT batch, count(*) AS n FROM (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS batch FROM orders) GROUP BY 1")
def q_file_batches(spark, d):
    return sinks.in_batches(view(spark, d, "SELECT o_orderkey AS k FROM orders"), sinks.scratch(spark), ["k"], 1000)


_FAILED = "SELECT concat('t', s_suppkey) AS transcript_id, concat('a', s_nationkey) AS assembly_accession, CASE WHEN s_suppkey % 2 = 0 THEN 'download_failed' WHEN s_suppkey % 3 = 0 THEN 'other' END AS reason FROM supplier"


@query(f"SELECT transcript_id, assembly_accession, CAST(NULL AS varchar) AS chrom, CAST(NULL AS varchar) AS db_source, reason AS fail_reason FROM ({_FAILED}) WHERE reason IS NOT NULL")
def q_file_failures(spark, d):
    routed = rows.route(view(spark, d, _FAILED), [(F.col("reason").isNotNull(), F.col("reason"))])
    path = sinks.scratch(spark)
    sinks.failures([routed.where("reason = 'other' or reason is null"), routed.where("reason = 'download_failed'")], path)
    return files.tsv(spark, path, T.StructType([T.StructField(c, T.StringType()) for c in sinks.FAILED]))


@query(f"SELECT DISTINCT assembly_accession AS value FROM ({_FAILED}) WHERE reason = 'download_failed'")
def q_file_failed_targets(spark, d):
    path = sinks.scratch(spark)
    sinks.text(sinks.failed_targets(view(spark, d, _FAILED), "download"), path)
    return spark.read.text(path)


@query("SELECT 'n' || n_nationkey AS db_source, 'n' || n_nationkey AS assembly_name, CASE WHEN n_nationkey % 2 = 0 THEN 'GCA_' || n_nationkey END AS assembly_accession, 'u' || n_nationkey AS gtf_url FROM nation")
def q_file_config_urls(spark, d):
    config = {f"n{r.k}": {"url": f"u{r.k}", "assembly_accession": f"GCA_{r.k}" if r.k % 2 == 0 else "null"} for r in view(spark, d, "SELECT n_nationkey AS k FROM nation").collect()}  # 25 rows
    return files.config_urls(spark, config | {"note": "text"}).select("db_source", "assembly_name", "assembly_accession", "gtf_url")


@query("SELECT 'n' || n_nationkey || '.tsv' AS value FROM nation WHERE n_nationkey % 3 > 0")
def q_file_orphans(spark, d):
    path = sinks.scratch(spark)
    nations = [r.k for r in view(spark, d, "SELECT n_nationkey AS k FROM nation").collect()]  # 25 rows
    for k in nations:
        sinks.small_text("x", f"{path}/results/n{k}.tsv")
    sinks.small_text("x", f"{path}/results/biomart/zea.tsv.gz")
    declared = "\n".join(f'o = f"{{RESULTS}}/n{k}.tsv"' for k in nations if k % 3 == 0)
    sinks.small_text(declared + '\nm = "results/biomart/{species}.tsv.gz"\n', f"{path}/rules/a.smk")
    return files.orphans(spark, f"{path}/results", f"{path}/rules")


# ---- records of genes and nucleotides ----


_GENE = (
    "<Entrezgene><Entrezgene_track-info><Gene-track><Gene-track_geneid>{0}</Gene-track_geneid></Gene-track></Entrezgene_track-info>"
    "<Entrezgene_source><BioSource><BioSource_org><Org-ref><Org-ref_taxname>Zea mays</Org-ref_taxname></Org-ref></BioSource_org></BioSource></Entrezgene_source>"
    "<Entrezgene_gene><Gene-ref><Gene-ref_locus>S{0}</Gene-ref_locus></Gene-ref></Entrezgene_gene>"
    "<Entrezgene_locus><Gene-commentary><Gene-commentary_accession>NC_{0}</Gene-commentary_accession><Gene-commentary_version>2</Gene-commentary_version></Gene-commentary></Entrezgene_locus></Entrezgene>"
)


@query("SELECT cast(n_nationkey AS varchar) AS gene_id, 'S' || n_nationkey AS symbol, 'Zea mays' AS organism, 'NC_' || n_nationkey || '.2' AS genomic FROM nation")
def q_file_entrez_genes(spark, d):
    nations = [r.k for r in view(spark, d, "SELECT n_nationkey AS k FROM nation").collect()]  # 25 rows
    path = sinks.scratch(spark)
    sinks.small_text(f"<Entrezgene-Set>{''.join(map(_GENE.format, nations[1:]))}</Entrezgene-Set>", f"{path}/set.xml")
    sinks.small_text(_GENE.format(nations[0]), f"{path}/one.xml")
    return files.entrez_genes(spark, path).withColumn("genomic", F.array_join("genomic", ","))


@query("SELECT 'NM_' || p_partkey || '.1' AS accession, 'Mus musculus' AS organism, 'Mus gene ' || p_partkey || ', mRNA.' AS description, cast(p_partkey AS varchar) AS gene_id, 'S' || p_partkey AS gene_symbol, CASE WHEN p_partkey % 2 = 0 THEN 'NC_' || p_partkey || '.3' END AS genomic, 'ACGTAC' AS sequence FROM part")
def q_file_genbank(spark, d):
    record = view(spark, d, """SELECT p_partkey AS k, concat_ws(chr(10), concat('LOCUS       NM_', p_partkey), concat('DEFINITION  Mus gene'), concat('            ', p_partkey, ', mRNA.'), concat('ACCESSION   NM_', p_partkey), concat('VERSION     NM_', p_partkey, '.1'), 'SOURCE      Mus', '  ORGANISM  Mus musculus',
      CASE WHEN p_partkey % 2 = 0 THEN concat('COMMENT     derived from NC_', p_partkey, '.3.') END, 'FEATURES             Location/Qualifiers', '     source          1..6', '                     /db_xref="taxon:10090"', '     gene            1..6', concat('                     /gene="S', p_partkey, '"'), concat('                     /db_xref="GeneID:', p_partkey, '"'),
      'ORIGIN      ', '        1 acg tac', '//') AS value FROM part""")
    return files.genbank(spark, put(record, ["k"])).select("accession", "organism", "description", "gene_id", "gene_symbol", "genomic", "sequence")


@query("SELECT 'NM_' || p_partkey || '.1' AS transcript_id, CASE WHEN p_partkey % 3 > 0 THEN cast(p_partkey AS varchar) END AS gene_id FROM part")
def q_file_feature_table(spark, d):
    lines = view(spark, d, """SELECT p_partkey AS k, concat('>Feature ref|NM_', p_partkey, '.1|', chr(10), '1', chr(9), '9', chr(9), 'gene', chr(10), CASE WHEN p_partkey % 3 > 0 THEN concat(chr(9), chr(9), chr(9), 'db_xref', chr(9), 'GeneID:', p_partkey, chr(10)) ELSE '' END) AS value FROM part""")
    return files.feature_table(spark, put(lines, ["k"]))
