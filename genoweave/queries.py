"""A query for each operator over the driver's tables, and the DuckDB SQL of the same rows.

The tables hold no biology. Identifiers, genes and genomes are made from their keys and texts by SQL that both engines
read alike; the operators then work on those.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import attrs, ids, rules, sequence, text
from .operators import genome, joins, rows, summaries
from .plans import merge, parse
from .shared import with_file_start

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
Query = Callable[[SparkSession, str], DataFrame]

#: Transcripts: an identifier of four kinds for each line, a place on one of seven chromosomes, a gene and a total order.
TX = """
SELECT l_orderkey * 10 + l_linenumber AS pos, l_partkey AS partkey, l_suppkey AS suppkey, l_extendedprice AS price,
  CASE l_linenumber % 4
    WHEN 0 THEN 'NM_' || lpad(cast(l_orderkey AS string), 6, '0') || '.' || cast(l_linenumber AS string)
    WHEN 1 THEN 'ENST' || lpad(cast(l_orderkey AS string), 11, '0')
    WHEN 2 THEN 'NONDMET' || lpad(cast(l_partkey AS string), 6, '0') || '.1'
    ELSE 'ZZ' || cast(l_orderkey AS string) END AS transcript_id,
  'chr' || cast(l_suppkey % 7 AS string) AS chrom,
  CASE WHEN l_quantity < 3 THEN NULL ELSE l_partkey * 11 END AS start_pos,
  CASE WHEN l_quantity < 2 THEN NULL ELSE l_partkey * 11 + (l_orderkey % 900) - 100 END AS end_pos,
  CASE l_returnflag WHEN 'A' THEN '+' WHEN 'R' THEN '-' ELSE '.' END AS strand,
  'G' || cast(l_partkey % 50 AS string) AS gene_id
FROM lineitem
"""
#: Headers in which an accession may stand anywhere.
HEADERS = """
SELECT o_orderkey AS record_id,
  CASE o_orderkey % 6
    WHEN 0 THEN 'x_GANC_' || cast(o_orderkey AS string) || '_y'
    WHEN 1 THEN 'gi|' || cast(o_custkey AS string) || '|ref|NM_' || cast(o_orderkey AS string) || '.2| some  gene'
    WHEN 2 THEN 'query orange1.1g' || lpad(cast(o_custkey AS string), 6, '0') || ' | Sobic.1G.' || cast(o_orderkey % 9 AS string)
    WHEN 3 THEN 'ENST' || lpad(cast(o_orderkey AS string), 11, '0') || '.4|GRMZM2G' || lpad(cast(o_custkey AS string), 6, '0') || '_T01'
    WHEN 4 THEN 'plain words loc:' || cast(o_orderkey AS string) || ' ab1'
    ELSE 'AT' || cast(o_orderkey % 5 + 1 AS string) || 'G' || lpad(cast(o_custkey AS string), 5, '0') || '.1 Glyma.10G011600.' || cast(o_orderkey % 3 AS string) END AS header
FROM orders
"""
#: Genomes: the bytes of a document as bases.
GENOME = "SELECT cast(doc_id % 3 AS string) AS assembly, 's' || cast(doc_id AS string) AS seqid, translate(hex(text), '0123456789ABCDEF', 'ACGTACGTACGTACGN') AS seq FROM documents"

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Registers a function as a query under its name, with its SQL."""

    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if oracle:
            _oracles[f.__name__] = oracle
        return f

    return add


def view(spark: SparkSession, sf_dir: str, sql: str, placed: bool = False) -> DataFrame:
    """sql over the tables of sf_dir that it names; placed gives their rows g_file and g_place, by which they stand in the tables' order."""
    named = [t for t in TABLES if re.search(rf"\b(FROM|JOIN)\s+{t}\b", sql)]

    def table(path):
        read = spark.read.parquet(path)
        return with_file_start(read.select("*", F.col("_metadata.file_path").alias("g_path"), F.col("_metadata.row_index").alias("g_place")), "g_path", path, "g_file") if placed else read

    return spark.sql(_with_tables(sql, named), **{t: table(f"{sf_dir}/{t}.parquet") for t in named})


def _with_tables(sql: str, names: list[str]) -> str:
    for t in names:
        sql = re.sub(rf"\b(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", sql)
    return sql


def ladder(column: str, of: str, table=rules.ID_RULES) -> str:
    """The ordered rules as a CASE expression."""
    arms = " ".join("WHEN regexp_matches({}, '{}') THEN '{}'".format(column, ("" if r.db_source == "noncode" else "(?i)") + r.pattern, getattr(r, of)) for r in table)
    return f"CASE {arms} END"


# ---- identifiers ----


@query(f"""
WITH tx AS ({TX}), c AS (SELECT transcript_id, {ladder('transcript_id', 'db_source')} AS db_source, {ladder('transcript_id', 'species_hint')} AS species_hint FROM tx)
SELECT coalesce(db_source, 'unknown') AS db_source, coalesce(species_hint, '') AS species_hint, count(DISTINCT transcript_id) AS n FROM c GROUP BY 1, 2
""")
def q_classify_ladder(spark, d):
    tx = rows.keep_first(view(spark, d, TX), ["transcript_id"], ["pos", "partkey", "suppkey", "price"])
    c = tx.withColumn("c", ids.classify(F.col("transcript_id")))
    return c.groupBy(F.coalesce("c.db_source", F.lit("unknown")).alias("db_source"), F.coalesce("c.species_hint", F.lit("")).alias("species_hint")).agg(F.count("*").alias("n"))


@query(f"""
WITH h AS ({HEADERS})
SELECT record_id, {"coalesce(" + ", ".join(f"CASE WHEN regexp_matches(header, '(?i){r.pattern}') THEN '{r.db_source}:{r.source_hint}:' || regexp_extract(header, '(?i){r.pattern}', 1) END" for r in rules.EMBEDDED_RULES) + ", 'unknown')"} AS found FROM h
""")
def q_embedded_accession(spark, d):
    e = view(spark, d, HEADERS).withColumn("e", ids.embedded(F.col("header")))
    return e.select("record_id", F.coalesce(F.concat_ws(":", "e.db_source", "e.source_hint", "e.transcript_id"), F.lit("")).alias("found")).withColumn("found", F.when(F.col("found") == "", "unknown").otherwise(F.col("found")))


@query(f"WITH h AS ({HEADERS}) SELECT record_id, split_part(regexp_extract(header, '^\\S+'), '|', 1) AS token, coalesce(nullif(regexp_extract(header, '{rules.GI}', 2), ''), split_part(regexp_extract(header, '^\\S+'), '|', 1)) AS accession FROM h")
def q_primary_token(spark, d):
    return view(spark, d, HEADERS).select("record_id", ids.primary_token(F.concat(F.lit(">"), "header")).alias("token"), ids.normalise_id(F.col("header")).alias("accession"))


@query(f"""WITH h AS ({HEADERS}), t AS (SELECT record_id, unnest(string_split_regex(header, '[|\\s]+')) AS t FROM h)
SELECT h.record_id, coalesce(x.tokens, '') AS tokens FROM h LEFT JOIN (SELECT record_id, array_to_string(list_sort(list(DISTINCT t)), ' ') AS tokens FROM t WHERE length(t) >= 4 AND regexp_matches(t, '[0-9]') AND NOT contains(t, ':') GROUP BY record_id) x ON h.record_id = x.record_id""")
def q_header_tokens(spark, d):
    return view(spark, d, HEADERS).select("record_id", F.array_join(F.array_sort(F.array_distinct(ids.header_tokens(F.col("header")))), " ").alias("tokens"))


@query(f"""WITH h AS ({HEADERS}), a AS (SELECT record_id, unnest({" || ".join(f"regexp_extract_all(header, '{'' if 'NON' in p else '(?i)'}{p}', 1)" for p in rules.ACCESSIONS)}) AS a FROM h)
SELECT h.record_id, coalesce(x.accessions, '') AS accessions FROM h LEFT JOIN (SELECT record_id, array_to_string(list_sort(list(DISTINCT a)), ' ') AS accessions FROM a GROUP BY record_id) x ON h.record_id = x.record_id""")
def q_accession_extract_all(spark, d):
    return view(spark, d, HEADERS).select("record_id", F.array_join(F.array_sort(ids.accessions(F.col("header"))), " ").alias("accessions"))


@query(f"""WITH tx AS ({TX}) SELECT DISTINCT transcript_id, regexp_replace(transcript_id, '\\.[0-9]+$', '') AS no_number,
regexp_replace(transcript_id, '\\.[^.]*$', '') AS no_last, split_part(transcript_id, '.', 1) AS first, regexp_extract(transcript_id, '^([A-Za-z_]+)', 1) AS prefix, upper(regexp_extract(transcript_id, '(?i)^(ENS[A-Z]*T)\\d', 1)) AS ensembl FROM tx""")
def q_version_strip(spark, d):
    t = F.col("transcript_id")
    return view(spark, d, TX).select(t, ids.drop_numeric_version(t).alias("no_number"), ids.drop_last_part(t).alias("no_last"), ids.first_part(t).alias("first"), ids.alphabetic_prefix(t).alias("prefix"), ids.ensembl_prefix(t).alias("ensembl")).distinct()


@query("SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS canonical_md5 FROM documents")
def q_ws_canonical(spark, d):
    return view(spark, d, "SELECT doc_id, text FROM documents").select("doc_id", F.md5(ids.canonical_blanks(F.col("text")).cast("binary")).alias("canonical_md5"))


_PLANT_IDS = "SELECT p_partkey AS partkey, CASE p_partkey % 7 WHEN 0 THEN 'AT1G' WHEN 1 THEN 'Os03t' WHEN 2 THEN 'LOC_Os' WHEN 3 THEN 'GRMZM2G' WHEN 4 THEN 'PGSC0003DMT' WHEN 5 THEN 'VIT_' ELSE 'zm' END || lpad(cast(p_partkey AS string), 6, '0') AS transcript_id FROM part"


@query(f"SELECT partkey, {'CASE ' + ' '.join(f'''WHEN starts_with(transcript_id, '{p}') THEN '{s}' ''' for p, s in rules.PLANT_PREFIXES.items()) + ' END'} AS species FROM ({_PLANT_IDS})")
def q_prefix_species(spark, d):
    return view(spark, d, _PLANT_IDS).select("partkey", ids.prefix_species(F.col("transcript_id")).alias("species"))


@query(f"""SELECT partkey, CASE WHEN starts_with(transcript_id, 'PGSC') THEN array_to_string([transcript_id || '.2', replace(transcript_id, 'DMT', 'DMG') || '.2'], ' ') ELSE transcript_id || '.2' END AS by_species,
array_to_string(list_filter([transcript_id || '.2', CASE WHEN contains(transcript_id, '_') THEN split_part(transcript_id, '_', 1) END, transcript_id], lambda x: x IS NOT NULL), ' ') AS generic FROM ({_PLANT_IDS}) WHERE NOT starts_with(transcript_id, 'PGSC')
UNION ALL SELECT partkey, array_to_string([transcript_id || '.2', transcript_id, replace(transcript_id, 'DMT', 'DMG') || '.2'], ' '), array_to_string([transcript_id || '.2', transcript_id], ' ') FROM ({_PLANT_IDS}) WHERE starts_with(transcript_id, 'PGSC')""")
def q_candidates(spark, d):
    t = F.concat("transcript_id", F.lit(".2"))
    p = view(spark, d, _PLANT_IDS)
    species = F.when(p["transcript_id"].startswith("PGSC"), "solanum_tuberosum").otherwise("citrus_sinensis")
    return p.select("partkey", F.array_join(ids.candidates_species(t, species), " ").alias("by_species"), F.array_join(ids.candidates_generic(t), " ").alias("generic"))


# ---- cells ----

_CELLS = "SELECT s_suppkey AS k, CASE s_suppkey % 6 WHEN 0 THEN 'NA' WHEN 1 THEN ' nan ' WHEN 2 THEN 'None' WHEN 3 THEN '' WHEN 4 THEN '1' ELSE '-' END AS cell, s_name AS name, s_nationkey AS nationkey FROM supplier"


@query(f"SELECT k, CASE WHEN lower(trim(cell)) NOT IN ('', 'nan', 'none') THEN cell END AS cleaned, CASE WHEN trim(cell) IN ('+', '1', '+1') THEN '+' WHEN trim(cell) IN ('-', '-1') THEN '-' ELSE '.' END AS strand, try_cast(cell AS bigint) AS number, coalesce(try_cast(cell AS bigint), 0) AS or_zero, coalesce(nullif(trim(cell), ''), nullif(trim(name), '')) AS filled FROM ({_CELLS})")
def q_clean_cells(spark, d):
    c = F.col("cell")
    return view(spark, d, _CELLS).select("k", text.clean_null(c).alias("cleaned"), text.strand(c).alias("strand"), text.whole(c).alias("number"), text.whole(c, 0).alias("or_zero"), text.first_filled(c, F.col("name")).alias("filled"))


_BUILDS = "SELECT p_partkey AS k, CASE p_partkey % 5 WHEN 0 THEN ' grch38 ' WHEN 1 THEN 'GRCh99' WHEN 2 THEN 'GCF_000001405.40' WHEN 3 THEN 'GRCz11' ELSE 'dm6' END AS assembly_accession FROM part"


@query(f"""WITH m AS (SELECT k, assembly_accession AS old, CASE upper(trim(assembly_accession)) {" ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.GRC_ASSEMBLIES.items())} END AS new FROM ({_BUILDS}))
SELECT k, CASE WHEN starts_with(upper(trim(old)), 'GRC') AND new IS NULL THEN 'unresolved' ELSE 'resolved' END AS status, CASE WHEN starts_with(upper(trim(old)), 'GRC') AND new IS NULL THEN 'grc_mapping_failed:' || old END AS reason, CASE WHEN starts_with(upper(trim(old)), 'GRC') AND new IS NOT NULL THEN new ELSE old END AS assembly_accession FROM m""")
def q_route_reason(spark, d):
    old = F.col("assembly_accession")
    out = rows.map_or_reject(view(spark, d, _BUILDS), "assembly_accession", text.map_values(old, rules.GRC_ASSEMBLIES, keep=False, blanks=True), F.upper(F.trim(old)).startswith("GRC"), "grc_mapping_failed:")
    return out.select("k", "status", "reason", "assembly_accession")


@query(f"SELECT k, coalesce(CASE upper(trim(assembly_accession)) {' '.join(f'''WHEN '{a}' THEN '{b}' ''' for a, b in rules.UCSC_ASSEMBLIES.items())} END, assembly_accession) AS mapped FROM ({_BUILDS})")
def q_dictionary_map(spark, d):
    return view(spark, d, _BUILDS).select("k", text.map_values(F.col("assembly_accession"), rules.UCSC_ASSEMBLIES).alias("mapped"))


@query(r"""WITH u AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://h.org/a/b c' || page_id || '.FA.gz.zip?x=1' ELSE 'https://h.org/' || page_id || '.fna' END AS url FROM pages),
n AS (SELECT page_id, url, coalesce(nullif(regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#;]*)', 1), '[^/]*$'), ''), 'assembly') AS f FROM u),
s AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(f, '(?i)(\.(gz|bgz|bz2|xz|zip))+$', ''), '(?i)\.(fa|fna|fasta|fas)$', ''), '[^A-Za-z0-9._-]+', '_', 'g'), '^[._-]+|[._-]+$', '', 'g') AS s FROM n)
SELECT page_id, 'url_' || substr(coalesce(nullif(s, ''), 'assembly'), 1, 80) || '_' || substr(sha1(url), 1, 10) AS cache_key FROM s""")
def q_cache_key(spark, d):
    url = "SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://h.org/a/b c' || cast(page_id AS string) || '.FA.gz.zip?x=1' ELSE 'https://h.org/' || cast(page_id AS string) || '.fna' END AS url FROM pages"
    return view(spark, d, url).select("page_id", text.cache_key(F.col("url")).alias("cache_key"))


@query("SELECT p_partkey AS k, 'https://ftp.ncbi.nlm.nih.gov/genomes/all/GCF/' || substr(lpad(cast(p_partkey AS string), 9, '0'), 1, 3) || '/' || substr(lpad(cast(p_partkey AS string), 9, '0'), 4, 3) || '/' || substr(lpad(cast(p_partkey AS string), 9, '0'), 7, 3) || '/' AS dir, 'https://ftp.ensembl.org/pub/release-110/fasta/mus_musculus/dna/Mus_Musculus.G' || p_partkey || '.dna.toplevel.fa.gz' AS fasta_url FROM part")
def q_ftp_path(spark, d):
    p = view(spark, d, "SELECT p_partkey AS k, 'GCF_' || lpad(cast(p_partkey AS string), 9, '0') || '.4' AS acc, 'G' || cast(p_partkey AS string) AS name FROM part")
    return p.select("k", text.ftp_dir(F.col("acc")).alias("dir"), text.ensembl_urls(F.lit("mus musculus"), F.col("name"), F.lit("110")).fasta_url.alias("fasta_url"))


@query("""SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'HTTP 404 — not retrying' WHEN 1 THEN 'samtools exit 3: bad ' || o_custkey WHEN 2 THEN 'message ' || o_custkey ELSE 'unknown error' END AS failure,
CASE WHEN o_orderkey % 4 = 0 THEN 'c' || o_custkey ELSE 'given' END AS chrom, CASE WHEN o_orderkey % 3 > 0 THEN o_custkey ELSE 7 END AS start_pos FROM orders""")
def q_log_and_region(spark, d):
    sql = """SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN concat('x\\nPermanent failure (HTTP 404) gone, not retrying it\\nend') WHEN 1 THEN concat('FAILED (exit 3): bad ', o_custkey)
    WHEN 2 THEN concat('a | ERROR    | m | first\\n2 | ERROR    | m | message ', o_custkey, '\\nrest') ELSE 'fine' END AS log, CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE 'given' END AS chrom,
    CASE WHEN o_orderkey % 3 > 0 THEN NULL ELSE 7L END AS s, 9L AS e, concat('c', o_custkey, ':', o_custkey, '-', o_custkey + 5) AS region FROM orders"""
    r = view(spark, d, sql)
    place = text.region(F.col("chrom"), F.col("s"), F.col("e"), F.lit("1"), F.col("region"))
    return r.select("k", text.log_failure(F.col("log")).alias("failure"), place.chrom.alias("chrom"), place.start.alias("start_pos"))


@query("SELECT event_id, 'g' || event_id AS gene_id, 'late' AS name, cast(json_extract_string(props, '$.k') AS bigint) AS k, 't' || user_id AS transcript_id, 'a' || event_id || ' b' || user_id AS aliases FROM events")
def q_attributes(spark, d):
    sql = """SELECT event_id, props, concat('ID=g', event_id, ';Name=early;Name=late;Alias=a', event_id, ', b', user_id, ';') AS gff, concat('gene_id "g', event_id, '"; transcript_id "t', user_id, '";') AS gtf FROM events"""
    e = view(spark, d, sql).withColumns({"a": attrs.attr_map(F.col("gff")), "b": attrs.attr_map(F.col("gtf"))})
    return e.select("event_id", attrs.first_attr(F.col("a"), ["missing", "ID"]).alias("gene_id"), F.col("a")["Name"].alias("name"), F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("b")["transcript_id"].alias("transcript_id"), F.array_join(attrs.alias_values(F.col("a"), ["Alias"]), " ").alias("aliases"))


# ---- rows ----


@query(f"WITH tx AS ({TX}), r AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY pos, partkey, suppkey, price) AS n FROM tx) SELECT transcript_id, pos, partkey, chrom FROM r WHERE n = 1")
def q_keep_first(spark, d):
    return rows.keep_first(view(spark, d, TX), ["transcript_id"], ["pos", "partkey", "suppkey", "price"]).select("transcript_id", "pos", "partkey", "chrom")


@query(f"WITH tx AS ({TX}), r AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY start_pos IS NOT NULL DESC, pos, partkey, suppkey, price) AS n FROM tx) SELECT transcript_id, start_pos FROM r WHERE n = 1")
def q_prefer_filled(spark, d):
    return rows.prefer_filled(view(spark, d, TX), ["transcript_id"], "start_pos", ["pos", "partkey", "suppkey", "price"]).select("transcript_id", "start_pos")


@query(f"WITH tx AS ({TX}) SELECT pos, partkey, suppkey, CASE WHEN nullif(trim(chrom), '') IS NULL OR (start_pos IS NULL AND end_pos IS NULL) THEN 'missing_coordinates' END AS reason FROM tx")
def q_coordinate_guard(spark, d):
    tx = view(spark, d, TX).withColumnsRenamed({"start_pos": "start", "end_pos": "end"})
    return rows.coordinates_given(tx).select("pos", "partkey", "suppkey", "reason")


@query("SELECT o_orderkey AS k, cast(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 1000) AS bigint) AS batch FROM orders")
def q_batch_number(spark, d):
    return rows.batches(view(spark, d, "SELECT o_orderkey AS k FROM orders"), ["k"], 1000)


@query("SELECT s_suppkey AS k, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey = 11 DESC, s_suppkey % 3 = 0 DESC, s_suppkey) AS rank FROM supplier")
def q_rank_files(spark, d):
    s = view(spark, d, "SELECT s_suppkey AS k, s_nationkey AS nationkey FROM supplier")
    return rows.rank_rows(s, ["nationkey"], [F.desc(F.col("k") == 11), F.desc(F.col("k") % 3 == 0), F.asc("k")]).select("k", "rank").withColumn("rank", F.col("rank").cast("bigint"))


_STREAMS = ("SELECT c_custkey AS k, 'a' || cast(c_custkey AS string) AS v FROM customer WHERE c_custkey % 3 = 0", "SELECT c_custkey AS k, c_mktsegment AS extra FROM customer WHERE c_custkey % 2 = 0")


@query(f"WITH u AS (SELECT k, v, NULL AS extra, 0 AS p FROM ({_STREAMS[0]}) UNION ALL SELECT k, NULL, extra, 1 FROM ({_STREAMS[1]})), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY p) AS n FROM u) SELECT k, v, extra, p AS stream_prio FROM r WHERE n = 1")
def q_union_priority_merge(spark, d):
    return rows.keep_first(rows.in_priority_order([view(spark, d, s) for s in _STREAMS]), ["k"], ["stream_prio"])


@query("""SELECT 'difference' AS what, count(*) AS n FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)
UNION ALL SELECT 'intersection', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'union', count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)""")
def q_set_ops(spark, d):
    c, o = view(spark, d, "SELECT c_custkey AS k FROM customer"), view(spark, d, "SELECT o_custkey AS k FROM orders")
    parts = {"difference": rows.difference(c, o, ["k"]), "intersection": rows.intersection(c, o, ["k"]), "union": rows.union_distinct([c, o], "k").select("k")}
    out = [p.agg(F.count("*").alias("n")).select(F.lit(n).alias("what"), "n") for n, p in parts.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("SELECT o_orderkey AS k, o_orderstatus AS status, o_orderpriority AS prio, o_orderpriority AS label FROM orders")
def q_shape(spark, d):
    o = view(spark, d, "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders")
    df = rows.alias_filled(rows.renamed(o, {"o_orderkey": "k", "o_orderstatus": "status"}), {"o_orderpriority": "prio"})
    return rows.reordered(df.withColumn("label", rows.first_present(df, ("nothing", "prio"))), ["k", "status"])


# ---- joins ----

_CASCADE = ("SELECT o_orderkey AS row_id, 'T' || cast(o_custkey AS string) || '.' || cast(o_orderkey % 3 AS string) AS transcript_id FROM orders", "SELECT CASE WHEN c_custkey % 2 = 0 THEN 'T' || cast(c_custkey AS string) ELSE 'T' || cast(c_custkey AS string) || '.1' END AS key, c_nationkey AS nation FROM customer")


@query(f"SELECT o.row_id, coalesce(a.key, b.key) AS matched_key, CASE WHEN a.key IS NOT NULL THEN 0 WHEN b.key IS NOT NULL THEN 1 END AS matched_pos, coalesce(a.nation, b.nation) AS nation FROM ({_CASCADE[0]}) o LEFT JOIN ({_CASCADE[1]}) a ON a.key = o.transcript_id LEFT JOIN ({_CASCADE[1]}) b ON b.key = split_part(o.transcript_id, '.', 1)")
def q_first_match_join(spark, d):
    o, index = (view(spark, d, s) for s in _CASCADE)
    return joins.first_match_join(o, index, ids.candidates_generic(F.col("transcript_id")), ["row_id"]).select("row_id", "matched_key", "matched_pos", "nation")


@query(f"WITH o AS ({_CASCADE[0]}), t AS ({_CASCADE[1]}) SELECT row_id, key AS matched_key, 'versioned' AS match_type FROM o JOIN t ON key = transcript_id UNION ALL SELECT row_id, key, 'base' FROM o JOIN t ON split_part(key, '.', 1) = split_part(transcript_id, '.', 1) WHERE NOT EXISTS (SELECT 1 FROM t u WHERE u.key = o.transcript_id)")
def q_versioned_then_base(spark, d):
    o, t = (view(spark, d, s) for s in _CASCADE)
    return joins.versioned_then_base(o, t, "transcript_id", "key").select("row_id", "matched_key", "match_type")


_SOURCES = "SELECT o_custkey AS custkey, o_orderkey % 5 AS prio, min(o_orderkey) AS orderkey FROM orders GROUP BY o_custkey, o_orderkey % 5"


@query(f"WITH s AS ({_SOURCES}), r AS (SELECT *, row_number() OVER (PARTITION BY custkey ORDER BY prio, orderkey) AS n FROM s) SELECT c_custkey AS custkey, prio, orderkey FROM customer LEFT JOIN r ON custkey = c_custkey AND n = 1")
def q_ordered_source(spark, d):
    return joins.first_source_join(view(spark, d, "SELECT c_custkey AS custkey FROM customer"), view(spark, d, _SOURCES), "custkey", "prio")


_FILL = ("SELECT s_suppkey AS k, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE upper(n_name) || ' ' END AS name, CASE WHEN s_suppkey % 2 = 0 THEN ' ' || r_name ELSE NULL END AS organism, CASE WHEN s_suppkey % 5 = 0 THEN 'own' END AS url FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey", "SELECT n_name AS name, r_name AS organism, 'u' || cast(n_nationkey AS string) AS url, n_nationkey AS ord FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 3 > 0")


@query(f"""WITH l AS ({_FILL[0]}), d AS ({_FILL[1]}), n AS (SELECT lower(trim(name)) AS k, min_by(url, ord) AS url FROM d GROUP BY 1), o AS (SELECT lower(trim(organism)) AS k, min_by(url, ord) AS url FROM d GROUP BY 1)
SELECT l.k, coalesce(l.url, n.url) AS once, coalesce(l.url, n.url, o.url) AS twice FROM l LEFT JOIN n ON n.k = lower(trim(l.name)) LEFT JOIN o ON o.k = lower(trim(l.organism))""")
def q_fill_from(spark, d):
    left, dim = (view(spark, d, s) for s in _FILL)
    once = joins.fill_from(left, dim, ["name"], ["url"], ["ord"]).select("k", F.col("url").alias("once"))
    return once.join(joins.fill_from(left, dim, ["name", "organism"], ["url"], ["ord"]).select("k", F.col("url").alias("twice")), "k")


_NULLKEYS = "SELECT o_orderkey AS orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_custkey END AS k FROM orders"


@query(f"SELECT orderkey, CASE WHEN EXISTS (SELECT 1 FROM customer WHERE c_custkey = k AND c_nationkey < 12) THEN 'semi' ELSE 'anti' END AS side FROM ({_NULLKEYS})")
def q_semi_anti(spark, d):
    o, c = view(spark, d, _NULLKEYS), view(spark, d, "SELECT c_custkey AS k FROM customer WHERE c_nationkey < 12")
    return joins.semi(o, c, "k").select("orderkey", F.lit("semi").alias("side")).unionByName(joins.anti(o, c, "k").select("orderkey", F.lit("anti").alias("side")))


@query("SELECT o_orderkey AS orderkey, c_mktsegment AS segment FROM orders LEFT JOIN customer ON c_custkey = o_custkey")
def q_validated_join(spark, d):
    o, c = view(spark, d, "SELECT o_orderkey AS orderkey, o_custkey AS k FROM orders"), view(spark, d, "SELECT c_custkey AS k, c_mktsegment AS segment FROM customer")
    return joins.validated_join(o, c, ["k"]).select("orderkey", "segment")


_OVERLAP = ("SELECT o_orderkey AS record_id, o_orderkey % 3 AS prio, cast(o_custkey % 97 AS string) AS token FROM orders UNION ALL SELECT o_orderkey, 2, cast(o_orderkey % 89 AS string) FROM orders", "SELECT s_nationkey AS tool, s_suppkey % 3 AS prio, cast(s_suppkey AS string) AS token FROM supplier")


@query(f"WITH r AS ({_OVERLAP[0]}), t AS ({_OVERLAP[1]}), h AS (SELECT record_id, tool, r.prio, array_to_string(list_sort(list(DISTINCT r.token)), ';') AS tokens FROM r JOIN t ON r.prio = t.prio AND r.token = t.token GROUP BY record_id, tool, r.prio), b AS (SELECT *, row_number() OVER (PARTITION BY record_id, tool ORDER BY prio) AS n FROM h) SELECT record_id, tool, prio, tokens FROM b WHERE n = 1")
def q_overlap_join(spark, d):
    r, t = (view(spark, d, s) for s in _OVERLAP)
    return joins.overlap_join(r, t).withColumn("tokens", F.array_join("tokens", ";"))


@query("SELECT CASE WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) THEN 'exact' WHEN EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id + 1) THEN 'unversioned' END AS match_type, count(*) AS n FROM documents d GROUP BY 1")
def q_membership(spark, d):
    docs = view(spark, d, "SELECT cast(doc_id AS string) || '.' || cast(doc_id AS string) AS id, doc_id FROM documents")
    known = view(spark, d, "SELECT cast(doc_id AS string) || '.' || cast(doc_id AS string) AS known, doc_id FROM labels").select("known").unionByName(view(spark, d, "SELECT cast(doc_id - 1 AS string) || '.x' AS known FROM labels"))
    return joins.membership(docs, "id", known, "known").groupBy("match_type").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS total, count(*) FILTER (WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS present, count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)) AS absent FROM documents d")
def q_presence_count(spark, d):
    return joins.presence_counts(view(spark, d, "SELECT doc_id FROM documents"), view(spark, d, "SELECT doc_id AS key FROM labels"), "doc_id", "key")


@query("SELECT s_suppkey AS k, n_name AS nation, r_name AS region FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey AND n_nationkey % 4 > 0 LEFT JOIN region ON r_regionkey = n_regionkey")
def q_multi_hop(spark, d):
    s, n, r = view(spark, d, "SELECT s_suppkey AS k, s_nationkey AS nationkey FROM supplier"), view(spark, d, "SELECT n_nationkey AS nationkey, n_name AS nation, n_regionkey AS regionkey FROM nation WHERE n_nationkey % 4 > 0"), view(spark, d, "SELECT r_regionkey AS regionkey, r_name AS region FROM region")
    return s.join(n, "nationkey", "left").join(r, "regionkey", "left").select("k", "nation", "region")


@query("SELECT l.k, r.k AS other FROM (SELECT s_suppkey AS k, 'f' || s_suppkey AS stem FROM supplier) l LEFT JOIN (SELECT n_nationkey AS k, 'f' || n_nationkey || '.fa' AS name FROM nation) r ON starts_with(r.name, l.stem || '.')")
def q_stem_join(spark, d):
    a, b = view(spark, d, "SELECT s_suppkey AS k, 'f' || cast(s_suppkey AS string) AS stem FROM supplier"), view(spark, d, "SELECT n_nationkey AS other, 'f' || cast(n_nationkey AS string) || '.fa' AS name FROM nation")
    return joins.stem_join(a, b, "stem", "name", [F.asc("other")]).select("k", "other")


@query("SELECT o_orderkey AS k, coalesce(CASE WHEN o_custkey < 50 THEN 'fixed' END, c_mktsegment) AS v FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_custkey % 2 = 0")
def q_with_exceptions(spark, d):
    o = view(spark, d, "SELECT o_orderkey AS k, o_custkey AS acc FROM orders")
    fixed, snap = view(spark, d, "SELECT c_custkey AS acc, 'fixed' AS v FROM customer WHERE c_custkey < 50"), view(spark, d, "SELECT c_custkey AS acc, c_mktsegment AS v FROM customer WHERE c_custkey % 2 = 0")
    return joins.with_exceptions(o, "acc", fixed, snap, "v").select("k", "v")


# ---- summaries ----


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def q_value_counts_topk(spark, d):
    return summaries.value_counts(view(spark, d, "SELECT event_type FROM events"), "event_type", top=3)


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2 ORDER BY n DESC, 1, 2")
def q_group_two(spark, d):
    return summaries.value_counts(view(spark, d, "SELECT o_orderstatus, o_orderpriority FROM orders"), "o_orderstatus", "o_orderpriority")


@query(f"WITH tx AS ({TX}) SELECT count(*) AS total, count(*) FILTER (WHERE starts_with(transcript_id, 'NM_')) AS ncbi, count(*) FILTER (WHERE start_pos IS NULL) AS lost, count(DISTINCT transcript_id) AS n_transcript_id, count(DISTINCT gene_id) AS n_gene_id FROM tx")
def q_funnel(spark, d):
    tx = view(spark, d, TX)
    return summaries.funnel(tx, ncbi=F.col("transcript_id").startswith("NM_"), lost=F.col("start_pos").isNull()).crossJoin(summaries.distinct_counts(tx, "transcript_id", "gene_id"))  # one row each


@query("WITH a AS (SELECT s_nationkey AS g, count(*) AS n FROM supplier GROUP BY 1), m AS (SELECT s_nationkey AS g, count(*) AS n FROM supplier WHERE s_nationkey % 3 = 0 GROUP BY 1) SELECT a.g, coalesce(m.n, 0) AS n_matched, a.n AS n_attempted, a.n >= 5 AND coalesce(m.n, 0) < 0.02 * a.n AS flagged FROM a LEFT JOIN m ON a.g = m.g")
def q_match_rate_guard(spark, d):
    a, m = (view(spark, d, f"SELECT s_nationkey AS g, count(*) AS n FROM supplier {w} GROUP BY s_nationkey") for w in ("", "WHERE s_nationkey % 3 = 0"))
    return summaries.match_rates(a, m, "g").drop("rate")


@query("SELECT o_orderpriority AS prio, round_even(100.0 * sum(CASE WHEN o_orderstatus = 'F' AND o_orderkey % 3 = 0 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END), 0), 1)::double AS f, round_even(100.0 * sum(CASE WHEN o_orderstatus = 'O' AND o_orderkey % 3 = 0 THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END), 0), 1)::double AS o FROM orders GROUP BY 1")
def q_pivot_rate(spark, d):
    o = view(spark, d, "SELECT o_orderpriority AS prio, lower(o_orderstatus) AS status, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS hit FROM orders")
    out = summaries.pivot_rate(o, "prio", "status", ["f", "o"], F.col("hit"), F.lit(1))
    return out.select("prio", F.col("f").cast("double").alias("f"), F.col("o").cast("double").alias("o"))


@query("SELECT s_nationkey % 5 AS g, coalesce(avg(CASE WHEN s_nationkey % 2 = 0 THEN s_suppkey % 2 END), 0)::double AS even, coalesce(avg(CASE WHEN s_nationkey % 2 = 1 THEN s_suppkey % 2 END), 0)::double AS odd FROM supplier GROUP BY 1")
def q_pivot_mean(spark, d):
    s = view(spark, d, "SELECT s_nationkey % 5 AS g, CASE WHEN s_nationkey % 2 = 0 THEN 'even' ELSE 'odd' END AS kind, s_suppkey % 2 AS v FROM supplier")
    return summaries.pivot_mean(s, "g", "kind", ["even", "odd"], "v")


@query("SELECT p_brand AS brand, count(*) AS n, sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END)::bigint AS hits FROM part GROUP BY 1 HAVING count(*) >= 5")
def q_named_agg(spark, d):
    return summaries.counted_share(view(spark, d, "SELECT p_brand AS brand, p_size FROM part"), ["brand"], F.col("p_size") > 25, 5).drop("pct")


@query("SELECT c_mktsegment AS segment, min_by(c_name, c_custkey) AS example_c_name, count(*) AS n FROM customer GROUP BY 1")
def q_first_example(spark, d):
    return summaries.first_example(view(spark, d, "SELECT c_mktsegment AS segment, c_name, c_custkey FROM customer"), ["segment"], "c_name", "c_custkey")


@query("SELECT p_type AS type, count(DISTINCT p_brand) AS n, array_to_string(list_sort(list(DISTINCT p_brand)), ';') AS which FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1")
def q_collisions(spark, d):
    return summaries.collisions(view(spark, d, "SELECT p_type AS type, p_brand FROM part"), "type", "p_brand")


@query(f"""WITH tx AS ({TX}), r AS (SELECT *, row_number() OVER (PARTITION BY transcript_id ORDER BY pos, partkey, suppkey, price) AS n, row_number() OVER (PARTITION BY transcript_id, gene_id ORDER BY pos, partkey, suppkey, price) AS k, first_value(gene_id) OVER (PARTITION BY transcript_id ORDER BY pos, partkey, suppkey, price) AS p FROM tx),
c AS (SELECT transcript_id, count(DISTINCT gene_id) > 1 AS is_ambiguous FROM tx GROUP BY 1) SELECT CASE WHEN n = 1 THEN 'primary' WHEN gene_id <> p AND k = 1 THEN 'alternative' ELSE 'repeat' END AS role, is_ambiguous, count(*) AS n FROM r JOIN c USING (transcript_id) GROUP BY 1, 2""")
def q_ambiguity_split(spark, d):
    return summaries.ambiguity(view(spark, d, TX), "transcript_id", "gene_id", ["pos", "partkey", "suppkey", "price"]).groupBy("role", "is_ambiguous").agg(F.count("*").alias("n"))


@query("SELECT s_nationkey AS g, string_agg(DISTINCT s_name, ',' ORDER BY s_name) AS names FROM supplier GROUP BY 1")
def q_joined_text(spark, d):
    return summaries.joined_text(view(spark, d, "SELECT s_nationkey AS g, s_name FROM supplier"), ["g"], "s_name", F.col("s_name"), ",", "names")


@query("WITH c AS (SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus <> 'F') AS rest FROM orders) SELECT 'all' AS name, total AS expected, f + rest AS got, total = f + rest AS holds FROM c")
def q_consistency(spark, d):
    c = summaries.funnel(view(spark, d, "SELECT o_orderstatus FROM orders"), f=F.col("o_orderstatus") == "F", rest=F.col("o_orderstatus") != "F")
    return summaries.balanced(c, {"all": ("total", ["f", "rest"])})


# ---- sequences ----


@query(f"WITH g AS ({GENOME}) SELECT seqid, md5(seq) AS md5, md5(replace(lower(seq), 't', 'u')) = md5(lower(replace(seq, 'T', 'U'))) AS same, md5(seq) AS md5_rna FROM g")
def q_seq_hash(spark, d):
    rna = F.lower(F.replace(F.col("seq"), F.lit("T"), F.lit("U")))
    g = view(spark, d, GENOME)
    return g.select("seqid", sequence.digest(F.lower("seq")).alias("md5"), (sequence.digest_rna(rna) == sequence.digest_rna(F.col("seq"))).alias("same"), sequence.digest_rna(rna).alias("md5_rna"))


@query(f"""WITH tx AS ({TX}), o AS (SELECT pos, partkey, suppkey, strand, least(start_pos, end_pos) AS s, greatest(start_pos, end_pos) AS e FROM tx WHERE start_pos IS NOT NULL)
SELECT pos, partkey, suppkey, s, e, greatest(0, s - CASE WHEN strand = '+' THEN 50 ELSE 30 END) AS low, least(20000, e + CASE WHEN strand = '+' THEN 30 ELSE 50 END) AS high FROM o""")
def q_flank_clamp(spark, d):
    tx = view(spark, d, TX).where("start_pos is not null")
    s, e = sequence.ordered(F.col("start_pos"), F.col("end_pos"))
    low, high = sequence.flanked(F.col("s"), F.col("e"), F.col("strand"), F.lit(20000).cast("bigint"), 50, 30)
    return tx.withColumns({"s": s, "e": e}).select("pos", "partkey", "suppkey", "s", "e", low.alias("low"), high.alias("high"))


#: Genes on the documents' letters; every seventh has no place, every fifth a wrong chromosome, every ninth an unknown assembly.
GENES = """SELECT 'R' || cast(doc_id AS string) AS transcript_id, CASE WHEN doc_id % 9 = 8 THEN 'none' ELSE cast(doc_id % 3 AS string) END AS assembly,
  CASE WHEN doc_id % 5 = 4 THEN 'nowhere' WHEN doc_id % 5 = 3 THEN 'chrs' || cast(doc_id AS string) ELSE 's' || cast(doc_id AS string) END AS chrom,
  CASE WHEN doc_id % 7 = 6 THEN NULL ELSE doc_id % 400 END AS start, doc_id % 350 + 60 AS end, CASE doc_id % 3 WHEN 0 THEN '+' WHEN 1 THEN '-' ELSE '.' END AS strand FROM documents"""
_DUCK_GENES = GENES.replace("AS end,", 'AS "end",')
_EXTRACT_ORACLE = f"""WITH g AS ({GENOME}), x AS ({_DUCK_GENES}), l AS (SELECT x.*, CASE WHEN start IS NOT NULL THEN least(start, "end") END AS s, CASE WHEN start IS NOT NULL THEN greatest(start, "end") END AS e, g.seqid, g.seq, length(g.seq) AS len
  FROM x LEFT JOIN g ON g.assembly = x.assembly AND g.seqid IN (x.chrom, CASE WHEN starts_with(x.chrom, 'chr') THEN substr(x.chrom, 4) ELSE 'chr' || x.chrom END)),
w AS (SELECT *, greatest(0, s - CASE WHEN strand = '+' THEN 20 ELSE 10 END) AS a, least(len, e + CASE WHEN strand = '+' THEN 10 ELSE 20 END) AS b FROM l),
c AS (SELECT *, CASE WHEN b > a THEN nullif(upper(substr(seq, a + 1, b - a)), '') END AS cut FROM w),
r AS (SELECT *, CASE WHEN start IS NULL THEN 'missing_coordinates' WHEN assembly = 'none' THEN 'assembly_not_cached' WHEN seqid IS NULL THEN 'chrom_not_found' WHEN cut IS NULL THEN 'sequence_error' END AS reason FROM c)
SELECT transcript_id, coalesce(reason, 'ok') AS reason, CASE WHEN reason IS NULL THEN a END AS ext_start, CASE WHEN reason IS NULL THEN b END AS ext_end,
  md5(CASE WHEN reason IS NULL THEN CASE WHEN strand = '-' THEN reverse(translate(cut, 'ACGTURYKMBVDHacgturykmbvdh', 'TGCAAYRMKVBHDtgcaayrmkvbhd')) ELSE cut END END) AS seq_md5 FROM r"""


def extracted(spark, d, chunks, index):
    no_alias = spark.createDataFrame([], "assembly string, alias string, cand_ord int, seqid string")
    out = genome.extract(view(spark, d, GENES), chunks, no_alias, index, 20, 10, size=64)
    ok = F.col("status") == "resolved"
    return out.select("transcript_id", F.coalesce("reason", F.lit("ok")).alias("reason"), F.when(ok, F.col("ext_start")).alias("ext_start"), F.when(ok, F.col("ext_end")).alias("ext_end"), F.md5(F.when(ok, F.col("seq")).cast("binary")).alias("seq_md5"))


@query(_EXTRACT_ORACLE)
def q_extract(spark, d):
    chunks = genome.chunked(view(spark, d, GENOME), 64)
    return extracted(spark, d, chunks, genome.genome_index(chunks))


@query(f"WITH g AS ({GENOME}) SELECT seqid, md5(reverse(translate(seq, 'ACGT', 'TGCA'))) AS turned FROM g")
def q_reverse_complement(spark, d):
    return view(spark, d, GENOME).select("seqid", F.md5(sequence.reverse_complement(F.col("seq")).cast("binary")).alias("turned"))


_REPORT = "SELECT 'a' AS assembly, s_suppkey AS row_ord, 'Seq' || cast(s_suppkey AS string) AS sequence_name, CASE WHEN s_suppkey % 2 = 0 THEN 'assembled-molecule' ELSE 'unplaced-scaffold' END AS role, cast(s_suppkey % 40 AS string) AS molecule, 'CM' || cast(s_suppkey AS string) AS genbank, CASE WHEN s_suppkey % 5 = 0 THEN 'na' ELSE 'NC' || cast(s_suppkey AS string) END AS refseq, 'na' AS ucsc_name FROM supplier"


@query(f"""WITH rep AS (SELECT * FROM ({_REPORT}) WHERE refseq <> 'na'), al AS (SELECT row_ord, 0 AS o, sequence_name AS alias, refseq, genbank FROM rep UNION ALL SELECT row_ord, 1, genbank, refseq, genbank FROM rep UNION ALL SELECT row_ord, 2, refseq, refseq, genbank FROM rep UNION ALL SELECT row_ord, 4, molecule, refseq, genbank FROM rep WHERE role = 'assembled-molecule'),
al2 AS (SELECT lower(alias) AS alias, max_by(refseq, row_ord * 10 + o) AS refseq, max_by(genbank, row_ord * 10 + o) AS genbank FROM al GROUP BY 1), idx AS (SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'CM' || s_suppkey ELSE 'NC' || s_suppkey END AS seqid FROM supplier),
q AS (SELECT s_suppkey AS k, CASE s_suppkey % 4 WHEN 0 THEN 'chr' || (s_suppkey % 50) WHEN 1 THEN 'SEQ' || s_suppkey WHEN 2 THEN 'NC' || s_suppkey ELSE 'chrZ' END AS chrom FROM supplier), q2 AS (SELECT k, chrom, CASE WHEN starts_with(chrom, 'chr') THEN substr(chrom, 4) ELSE 'chr' || chrom END AS other FROM q)
SELECT k, coalesce(i1.seqid, i2.seqid, i3.seqid, i4.seqid, i5.seqid, i6.seqid) AS seqid FROM q2 LEFT JOIN al2 x ON x.alias = lower(chrom) LEFT JOIN al2 y ON y.alias = lower(other)
LEFT JOIN idx i1 ON i1.seqid = x.refseq LEFT JOIN idx i2 ON i2.seqid = x.genbank LEFT JOIN idx i3 ON i3.seqid = chrom LEFT JOIN idx i4 ON i4.seqid = y.refseq LEFT JOIN idx i5 ON i5.seqid = y.genbank LEFT JOIN idx i6 ON i6.seqid = other""")
def q_chrom_alias_resolve(spark, d):
    aliases = genome.chrom_aliases(view(spark, d, _REPORT))
    index = view(spark, d, "SELECT 'a' AS assembly, CASE WHEN s_suppkey % 3 = 0 THEN concat('CM', s_suppkey) ELSE concat('NC', s_suppkey) END AS seqid, 10L AS length FROM supplier")
    q = view(spark, d, "SELECT s_suppkey AS k, 'a' AS assembly, CASE s_suppkey % 4 WHEN 0 THEN concat('chr', s_suppkey % 50) WHEN 1 THEN concat('SEQ', s_suppkey) WHEN 2 THEN concat('NC', s_suppkey) ELSE 'chrZ' END AS chrom FROM supplier")
    return genome.resolve_chroms(q, aliases, index, "k").select("k", "seqid")


_GFF = "SELECT CASE WHEN l_linenumber % 3 = 0 THEN 'gene' ELSE 'exon' END AS feature, CASE WHEN l_linenumber % 3 > 0 THEN 't' || cast(l_partkey AS string) END AS transcript_id, 'g' || cast(l_partkey % 500 AS string) AS gene_id, 'chr' || cast(l_suppkey % 9 AS string) AS chrom, l_orderkey AS start, l_orderkey + 9 AS end, '+' AS strand, l_orderkey * 100000000 + l_partkey * 1000 + l_suppkey * 10 + l_linenumber AS row_ord FROM lineitem"


@query(f"""WITH gff AS ({_GFF.replace("AS end,", 'AS "end",')}), tx AS (SELECT transcript_id, min_by(gene_id, row_ord) AS gene_id FROM gff WHERE transcript_id IS NOT NULL GROUP BY 1), ge AS (SELECT gene_id, min_by(chrom, row_ord) AS chrom, min_by(start, row_ord) AS s FROM gff WHERE feature = 'gene' GROUP BY 1)
SELECT transcript_id, gene_id, chrom, s FROM tx JOIN ge USING (gene_id)""")
def q_two_pass_annotation(spark, d):
    gff = view(spark, d, _GFF)
    wanted = gff.where("transcript_id is not null").select("transcript_id").distinct()
    return genome.annotations_by_gene(gff, wanted).select("transcript_id", "gene_id", "chrom", F.col("start").alias("s"))


# ---- plans ----


@query(f"""WITH h AS ({HEADERS}), c AS (SELECT record_id, header, split_part(regexp_extract(header, '^\\S+'), '|', 1) AS t FROM h), k AS (SELECT record_id, header, t, {ladder('t', 'db_source')} AS db FROM c),
e AS (SELECT record_id, header, CASE WHEN db IS NOT NULL THEN db || ' ' || t ELSE {"coalesce(" + ", ".join(f"CASE WHEN regexp_matches(header, '(?i){r.pattern}') THEN '{r.db_source} ' || regexp_extract(header, '(?i){r.pattern}', 1) END" for r in rules.EMBEDDED_RULES) + ")"} END AS found FROM k),
s AS (SELECT split_part(found, ' ', 1) AS db_source, count(DISTINCT split_part(found, ' ', 2)) AS n FROM e WHERE found IS NOT NULL GROUP BY 1) SELECT db_source, n FROM s UNION ALL SELECT 'unknown', count(*) FROM e WHERE found IS NULL""")
def q_parse_ids(spark, d):
    records = view(spark, d, HEADERS).select("header", F.lit("f").alias("file"), F.lit(0).alias("file_ord"), F.col("record_id").alias("row_ord"))
    known, unknown = parse.parse_ids(records)
    return known.groupBy("db_source").agg(F.count("*").alias("n")).unionByName(unknown.agg(F.lit("unknown").alias("db_source"), F.count("*").alias("n")))


#: Identifiers of many kinds, with the source and species that each is known to have: written by hand, and not by the rules.
KINDS = [
    ("'XR_' || {k} || '.3'", "ncbi", "unknown_refseq", "refseq", ""), ("'ENSMUST' || lpad({k}, 11, '0')", "ensembl", "vertebrate", "ensembl", ""), ("'FBtr' || lpad({k}, 7, '0')", "flybase", "drosophila_melanogaster", "flybase", "dm6"),
    ("'WBGene' || lpad({k}, 8, '0')", "wormbase", "caenorhabditis_elegans", "wormbase", "WBcel235"), ("'Q' || lpad({m}, 4, '0')", "sgd", "saccharomyces_cerevisiae", "sgd", "R64-1-1"), ("'NONHSAT' || {k} || '.2'", "noncode", "unknown_noncode", "noncode", ""),
    ("'nonhsat' || {k} || '.2'", "unknown", "", "", ""), ("'Solyc01g' || {k} || '.2.1'", "plant", "solanum_lycopersicum", "sgn", "SL4.0"), ("'Glyma.01G' || lpad({k}, 6, '0') || '.1'", "plant", "glycine_max", "phytozome", "Wm82"), ("'at1g' || {k}", "plant", "arabidopsis_thaliana", "tair", "TAIR10"),
    ("'Zm00001d' || {k} || '_T001'", "plant", "zea_mays", "ensembl_plants", "B73_RefGen_v4"), ("'Zm00002g' || {k}", "plant", "zea_mays", "maizegdb_or_ensembl", "B73"), ("'LOC_Os01g' || {k}", "plant", "oryza_sativa", "msu_tigr", "MSU7"), ("'Os01g' || {k}", "plant", "oryza_sativa", "rapdb", "IRGSP-1.0"),
    ("'Potri.001G' || {k}", "plant", "populus_trichocarpa", "phytozome", ""), ("'VIT_01s' || {k}", "plant", "vitis_vinifera", "ensembl_plants", ""), ("'PGSC0003DMT' || {k}", "plant", "solanum_tuberosum", "pgsc", "PGSC_DM_v3.4"), ("'Sobic.1G.' || {m}", "plant", "sorghum_bicolor", "phytozome", ""),
    ("'word' || {k}", "unknown", "", "", ""), ("'Medtr1g' || {k}", "plant", "medicago_truncatula", "phytozome", ""),
]
_KIND_IDS = "SELECT k, CASE k % 20 " + " ".join(f"WHEN {i} THEN {t.format(k='cast(k AS string)', m='cast(k % 10 AS string)')}" for i, (t, *_) in enumerate(KINDS)) + " END AS transcript_id FROM (SELECT o_orderkey AS k FROM orders)"


@query("SELECT k, (['" + "', '".join("|".join(v) for _, *v in KINDS) + "'])[k % 20 + 1] AS kind FROM (SELECT o_orderkey AS k FROM orders)")
def q_classify_kinds(spark, d):
    c = view(spark, d, _KIND_IDS).withColumn("c", ids.classify(F.col("transcript_id")))
    known = F.concat_ws("|", "c.db_source", "c.species_hint", "c.source_hint", "c.assembly_hint")
    return c.select("k", F.when(F.col("c").isNull(), "unknown|||").otherwise(known).alias("kind"))


#: Records, and tools' records of which some have other headers or only the same sequence.
RECORDS = f"SELECT record_id, header, translate(md5(header), '0123456789abcdef', 'ACGUACGUACGUACGU') AS seq FROM ({HEADERS})"
TOOL_RECORDS = f"""SELECT 'tool' || cast(record_id % 3 AS string) AS tool, CASE WHEN record_id % 7 = 0 THEN 'other' || cast(record_id AS string) WHEN record_id % 2 = 0 THEN header || '  x' ELSE header END AS header,
CASE WHEN record_id % 14 = 0 THEN replace(seq, 'U', 'T') ELSE seq END AS seq FROM ({RECORDS}) WHERE record_id % 4 > 0"""
_STRIPPED = "regexp_replace(t, '\\.[0-9]+$', '')"
_FIRST_WORD = f"coalesce(nullif(regexp_extract(header, '{rules.GI}', 2), ''), split_part(regexp_extract(header, '^\\S+'), '|', 1))"
_ALL_ACCESSIONS = " || ".join(f"regexp_extract_all(header, '{'' if 'NON' in p else '(?i)'}{p}', 1)" for p in rules.ACCESSIONS)


def _token_sql(table: str, key: str) -> str:
    """(key, prio, token) of a table (key, header, seq): a branch for each strategy."""
    sets = [
        "[header]", "[trim(regexp_replace(header, '\\s+', ' ', 'g'))]", "gi", f"list_transform(acc || [word], lambda t: 'v:' || t) || list_transform(acc || [word], lambda t: 'b:' || {_STRIPPED})",
        f"every || list_transform(every, lambda t: {_STRIPPED})", "[md5(upper(seq))]", "[md5(replace(upper(seq), 'U', 'T'))]",
    ]
    words = "list_filter(string_split_regex(header, '[|\\s]+'), lambda t: length(t) >= 4 AND regexp_matches(t, '[0-9]') AND NOT contains(t, ':'))"
    parts = f"(SELECT *, [word] || gi || acc || words AS every FROM (SELECT {key}, header, seq, {_FIRST_WORD} AS word, regexp_extract_all(header, '{rules.GI}', 2) AS gi, {_ALL_ACCESSIONS} AS acc, {words} AS words FROM {table}))"
    spread = " UNION ALL ".join(f"SELECT {key}, {k} AS prio, unnest({s}) AS token FROM {parts}" for k, s in enumerate(sets))
    return f"SELECT DISTINCT * FROM ({spread}) WHERE token <> ''"


_HITS = f"""records AS ({RECORDS}), tool_records AS ({TOOL_RECORDS}), a AS ({_token_sql("records", "record_id")}), b AS ({_token_sql("tool_records", "tool")}),
shared AS (SELECT record_id, tool, prio, list(DISTINCT CASE WHEN prio = 3 THEN regexp_replace(token, '^[vb]:', '') ELSE token END) AS tokens FROM a JOIN b USING (prio, token) GROUP BY ALL),
best AS (SELECT record_id, tool, min(prio) AS prio FROM shared GROUP BY ALL),
hits AS (SELECT record_id, tool, (['{"', '".join(parse.STRATEGIES)}'])[prio + 1] AS strategy, array_to_string(list_sort(tokens), ';') AS text FROM best JOIN shared USING (record_id, tool, prio))"""


def _tools(spark, d):
    tools = spark.range(4).select(F.concat(F.lit("tool"), "id").alias("tool"))
    return parse.map_to_tools(view(spark, d, RECORDS), view(spark, d, TOOL_RECORDS), tools)


@query(f"""WITH {_HITS}, named AS (SELECT record_id, string_agg(strategy, ',' ORDER BY first_tool) AS match_strategy FROM (SELECT record_id, strategy, min(tool) AS first_tool FROM hits GROUP BY ALL) GROUP BY 1),
joined AS (SELECT record_id, string_agg(tool, ',' ORDER BY tool) AS tools, count(*) AS n_tools, min(tool) AS primary_tool, string_agg(tool || ':' || text, '|' ORDER BY tool) AS matching_tokens FROM hits GROUP BY 1)
SELECT r.record_id, {_FIRST_WORD} AS transcript_id, header AS raw_header, coalesce(tools, '') AS tools, coalesce(n_tools, 0) AS n_tools, coalesce(primary_tool, '') AS primary_tool, coalesce(match_strategy, '') AS match_strategy, coalesce(matching_tokens, '') AS matching_tokens
FROM records r LEFT JOIN joined USING (record_id) LEFT JOIN named USING (record_id)""")
def q_map_to_tools(spark, d):
    return _tools(spark, d)[0]


@query(f"""WITH {_HITS} SELECT t.tool, {", ".join(f"count(*) FILTER (strategy = '{s}') AS {s}" for s in parse.STRATEGIES)}, count(strategy) AS total
FROM (SELECT 'tool' || range AS tool FROM range(4)) t LEFT JOIN hits h ON h.tool = t.tool GROUP BY 1""")
def q_tool_strategies(spark, d):
    return _tools(spark, d)[1]


@query("SELECT CASE WHEN k % 4 = 0 THEN 'GCF_' || k ELSE NULL END AS cache_key, CASE WHEN bool_or(has) THEN max(url) END AS fasta_url FROM (SELECT p_partkey % 40 AS k, p_partkey % 3 = 0 AS has, CASE WHEN p_partkey % 3 = 0 THEN 'https://h/' || (p_partkey % 40) END AS url FROM part) WHERE k % 4 = 0 GROUP BY 1")
def q_manifest(spark, d):
    p = view(spark, d, "SELECT CASE WHEN p_partkey % 40 % 4 = 0 THEN concat('GCF_', p_partkey % 40) ELSE 'EnsemblPlants' END AS assembly_accession, CASE WHEN p_partkey % 3 = 0 AND p_partkey % 40 % 4 = 0 THEN concat('https://h/', p_partkey % 40) END AS fasta_url FROM part")
    return merge.download_manifest(p)


def queries() -> dict[str, Query]:
    from . import file_queries, lookup_queries, plan_queries  # noqa: F401  they register their own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from . import file_queries, lookup_queries, plan_queries  # noqa: F401

    return dict(_oracles)
