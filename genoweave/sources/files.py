"""Readers of sequence, annotation and listing files into DataFrames. Paths are Spark's: any file system, globs, folders."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.attrs import alias_values, attr_map, first_attr, value_forms
from ..functions.rules import CSV_NULLS
from ..functions.text import strand
from ..operators.rows import keep_first, keep_last, nulls_cleaned
from ..shared import with_file_start
from . import packed

FASTA_SUFFIXES = (".fa", ".fasta", ".faa", ".fna", ".fa.gz", ".fasta.gz", ".faa.gz", ".fna.gz")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _record(value: Column, path: Column) -> list[Column]:
    """file, header, id, description and seq of the text of a FASTA record without its first `>`."""
    header = F.trim(F.regexp_replace(F.split_part(value, F.lit("\n"), F.lit(1)), "\r", ""))
    body = F.regexp_replace(value, r"^[^\n]*\n?", "")
    return [path.alias("file"), header.alias("header"), F.split(header, r"\s+")[0].alias("id"), header.alias("description"), F.regexp_replace(body, r"\s", "").alias("seq")]


def fasta(spark: SparkSession, path: str | Sequence[str], row_ord: bool = True) -> DataFrame:
    """(file, header, id, description, seq, row_ord) of FASTA files, plain or gz. row_ord orders records within a file by where they are read.

    A record is one row, for sequences that fit one: the files are split at `>` after a line break. records.fasta_chunks reads any length, and
    leaves out a text before a file's first `>`, which is taken for a record here.
    """
    raw = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))
    raw = raw.withColumn("row_ord", F.monotonically_increasing_id()).where(F.col("value").rlike(r"\S"))
    return raw.select(*_record(F.col("value"), F.col("path")), "row_ord") if row_ord else raw.select(*_record(F.col("value"), F.col("path")))


def placed_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(value, row_ord) of the lines of text files; row_ord orders them by file name and, in a file, by place, however Spark deals files out.

    It is a struct of the place of the line's split in all files, one after another, and a number of the line that grows within a split.
    """
    read = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("g_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = with_file_start(read, "g_path", path, "start")
    return lines.select("value", F.struct((F.col("start") + F.col("block")).alias("split"), "line").alias("row_ord"))


def _apart(rows: DataFrame) -> dict[str, Column]:
    """row_ord as columns to order by: a struct's fields one by one, which take half the struct's room in a sort."""
    kind = rows.schema["row_ord"].dataType
    return {f"g_{f}": F.col("row_ord")[f] for f in kind.names} if isinstance(kind, T.StructType) else {"g_row_ord": F.col("row_ord")}


def fasta_ids(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, id) of the header lines alone."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file")).where(F.col("value").startswith(">"))
    return lines.select("file", F.split(F.substring("value", 2, 1 << 20), r"\s+")[0].alias("id"))


def archive_members(spark: SparkSession, path: str | Sequence[str], suffixes: tuple[str, ...] = FASTA_SUFFIXES) -> DataFrame:
    """(file, member, text, error) of tar, tgz and zip files' members with the suffixes, gz ones inflated: a row each, for members that fit one.

    A file or member that can't be read, or not to its end, gives what was read and a row with the error. packed.text_pieces has the
    same in pieces, whatever a member's size.
    """
    pieces = packed.text_pieces(spark, path, suffixes)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p.text), "\n")
    whole = pieces.where("error is null").groupBy("file", "member").agg(text.alias("text"), F.lit(None).cast("string").alias("error"))
    return whole.unionByName(packed.failures(pieces).withColumn("text", F.lit(None).cast("string")))


def fasta_archives(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """fasta's columns, without the order, of the FASTA members of archives: records put together of their chunks."""
    return _described(packed.whole_fasta(packed.text_pieces(spark, path, FASTA_SUFFIXES))).drop("row_ord")


def fasta_and_failures(spark: SparkSession, path: str | Sequence[str], **sizes: int) -> tuple[DataFrame, DataFrame]:
    """(records with fasta's columns, failures (file, member, error)) of FASTA files, plain, gz or in archives, read once.

    A file that can't be read, or not to its end, doesn't stop the others: what could be read of it is there, and a row says what failed.
    """
    pieces = packed.text_pieces(spark, path, FASTA_SUFFIXES, **sizes)
    return _described(packed.whole_fasta(pieces)), packed.failures(pieces)


def whole_records(chunks: DataFrame) -> DataFrame:
    """fasta's columns of chunks (file, header, id, row_ord, chunk_no, seq): a record is one row again."""
    seq = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", "seq"))), lambda c: c.seq), "")
    return chunks.groupBy("row_ord").agg(*[F.first(c).alias(c) for c in ("file", "header", "id")], F.first("header").alias("description"), seq.alias("seq")).select("file", "header", "id", "description", "seq", "row_ord")


def _described(found: DataFrame) -> DataFrame:
    """fasta's columns of packed.whole_fasta's."""
    return found.select("file", "header", "id", F.col("header").alias("description"), "seq", "row_ord")


def tsv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, optional: bool = True, header: bool = True, nulls: Sequence[str] = CSV_NULLS) -> DataFrame:
    """A tab-separated file with a schema; cells that stand for missing values are null. A file that isn't there is empty (optional)."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    try:
        df = spark.read.schema(text).options(sep="\t", header=header, mode="PERMISSIVE", enforceSchema=False).csv(path)
    except AnalysisException:
        if not optional:
            raise
        return spark.createDataFrame([], schema)
    df = nulls_cleaned(df, nulls)
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema])


def tsv_with_dimension(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, pattern: str, name: str, dim: DataFrame) -> DataFrame:
    """Files (gz too) with a column more, taken from their names by a pattern's first group, and dim joined on it."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    df = spark.read.schema(text).options(sep="\t", header=True).csv(path).withColumn(name, F.regexp_extract(file_name(F.col("_metadata.file_path")), pattern, 1))
    typed = df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], name)
    return typed.join(dim, name, "left")


def annotation(spark: SparkSession, path: str | Sequence[str], features: Sequence[str] = (), pattern: str | None = None) -> DataFrame:
    """(seqid, source, feature, start, end, score, strand, phase, attrs, cell, row_ord) of GFF3 and GTF files; start counts from 1.

    Comments, sequences and lines with fewer than nine fields are left out, and, given a pattern, lines that it isn't found in.
    """
    lines = placed_lines(spark, path).where(~F.col("value").rlike("^[#>]") & (F.trim("value") != ""))
    if pattern is not None:
        lines = lines.where(F.col("value").rlike(pattern))
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = lines.select(f.alias("f"), "row_ord").where(F.size("f") >= 9)
    if features:
        rows = rows.where(F.col("f")[2].isin(*features))
    names = ["seqid", "source", "feature", "start", "end", "score", "strand", "phase"]
    cols = [F.col("f")[k].try_cast("bigint").alias(n) if n in ("start", "end") else F.col("f")[k].alias(n) for k, n in enumerate(names)]
    return rows.select(*cols, attr_map(F.col("f")[8]).alias("attrs"), F.col("f")[8].alias("cell"), "row_ord")


def annotation_index(gff: DataFrame, transcript_fields: Sequence[str], gene_id_fields: Sequence[str], gene_symbol_fields: Sequence[str] = (), alias_fields: Sequence[str] = (), on_dup: str = "first") -> DataFrame:
    """(key, gene_id, gene_symbol, chrom, start, end, strand): each name a feature goes by, once, of its first or last feature."""
    gene = first_attr(F.col("attrs"), gene_id_fields, F.lit(""))
    rows = gff.withColumns({"gene_id": gene, "gene_symbol": first_attr(F.col("attrs"), gene_symbol_fields, gene)})
    names = [F.trim(F.coalesce(F.col("attrs")[f], F.lit(""))) for f in (*transcript_fields, *gene_id_fields, *gene_symbol_fields)]
    keys = F.filter(F.array_distinct(F.concat(F.array(*names), alias_values(F.col("attrs"), alias_fields))), lambda k: k != "")
    order = _apart(rows)
    spread = rows.select(F.explode(keys).alias("key"), "gene_id", "gene_symbol", F.col("seqid").alias("chrom"), "start", "end", strand(F.col("strand")).alias("strand"), *[c.alias(n) for n, c in order.items()])
    pick = keep_first if on_dup == "first" else keep_last
    return pick(spread, ["key"], list(order)).drop(*order)


def annotation_values(gff: DataFrame) -> DataFrame:
    """(value): every attribute value, and without what stands before its first colon; each once."""
    return gff.select(F.explode(value_forms(F.col("cell"))).alias("value")).distinct()


def bed(spark: SparkSession, path: str | Sequence[str], one_based: bool = True) -> DataFrame:
    """(name, chrom, start, end, strand, row_ord) of BED lines with six fields or more, start counted from 1 (or as it stands)."""
    return bed_lines(placed_lines(spark, path), one_based)


def bed_lines(lines: DataFrame, one_based: bool = True) -> DataFrame:
    f = F.split("value", "\t")
    rows = lines.where(~F.col("value").rlike("^(#|track|browser)")).select(f.alias("f"), "row_ord").where(F.size("f") >= 6)
    start = F.col("f")[1].try_cast("bigint") + (1 if one_based else 0)
    return rows.select(F.col("f")[3].alias("name"), F.col("f")[0].alias("chrom"), start.alias("start"), F.col("f")[2].try_cast("bigint").alias("end"), F.col("f")[5].alias("strand"), "row_ord")


def bed_archive(spark: SparkSession, path: str) -> DataFrame:
    """bed of the members of a zip file."""
    lines = archive_members(spark, path, (".bed",)).where("error is null").select(F.posexplode(F.split("text", r"\r?\n")).alias("row_ord", "value"))
    return bed_lines(lines)


def pairs(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(key, value) of a file of two words a line; the last line of a key counts."""
    f = F.split(F.trim("value"), r"\s+")
    rows = placed_lines(spark, path).select(f.alias("f"), "row_ord").where(F.size("f") >= 2)
    order = _apart(rows)
    return keep_last(rows.select(F.col("f")[0].alias("key"), F.col("f")[1].alias("value"), *[c.alias(n) for n, c in order.items()]), ["key"], list(order)).drop(*order)


def fai_index(spark: SparkSession, path: str | Sequence[str], assembly: str, fasta: str) -> DataFrame:
    """(assembly, path, seqid, length, offset, line_bases, line_width) of a sequence index of the file `fasta`; see indexed.indexed_slices."""
    rows = spark.read.schema("seqid string, length long, offset long, line_bases int, line_width int").option("sep", "\t").csv(path)
    return rows.select(F.lit(assembly).alias("assembly"), F.lit(fasta).alias("path"), "seqid", "length", "offset", "line_bases", "line_width")


def fai(spark: SparkSession, path: str | Sequence[str], assembly: str) -> DataFrame:
    """(assembly, seqid, length) of a sequence index."""
    return spark.read.schema("seqid string, length long, offset long, line_bases int, line_width int").option("sep", "\t").csv(path).select(F.lit(assembly).alias("assembly"), "seqid", "length")


def assembly_report(spark: SparkSession, path: str | Sequence[str], assembly: str) -> DataFrame:
    """(assembly, row_ord, sequence_name, role, molecule, genbank, refseq, ucsc_name) of an assembly report; short lines are left out."""
    f = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    rows = placed_lines(spark, path).where(~F.col("value").startswith("#") & (F.trim("value") != "")).select(f.alias("f"), "row_ord").where(F.size("f") > 6)
    cell = lambda k: F.get("f", F.lit(k))
    return rows.select(F.lit(assembly).alias("assembly"), "row_ord", *[cell(k).alias(n) for k, n in ((0, "sequence_name"), (1, "role"), (2, "molecule"), (4, "genbank"), (6, "refseq"), (9, "ucsc_name"))])


def json_list(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str) -> DataFrame:
    """A JSON array of objects, a row each."""
    return spark.read.schema(schema).json(path, multiLine=True)


def nested_rows(spark: SparkSession, config: dict, columns: Sequence[str]) -> DataFrame:
    """A small nested mapping, name by name, as rows: the name and the columns' values."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("name", *columns)])
    return spark.createDataFrame([(n, *[None if v.get(c) is None else str(v[c]) for c in columns]) for n, v in config.items()], schema)


def config_urls(spark: SparkSession, config: dict | None, db_source: str = "") -> DataFrame:
    """A section of a configuration (YAML or JSON, read by the caller: a mapping from names to mappings) as a row of addresses each.

    Names stand in for a missing source, assembly name and organism; accessions that say null or none are null; entries that are no mapping are
    left out. No section gives no rows.
    """
    columns = ("db_source", "assembly_name", "assembly_accession", "fasta_url", "gtf_url", "gtf_format", "organism")
    rows = {}
    for name, entry in (config or {}).items():
        if not isinstance(entry, dict):
            continue
        accession = entry.get("assembly_accession")
        own = {"db_source": db_source or name, "assembly_name": entry.get("assembly_name", name), "organism": entry.get("organism", name), "gtf_url": entry.get("url") or entry.get("gtf_url")}
        rows[name] = entry | own | {"assembly_accession": None if str(accession).lower() in ("null", "none", "") else accession}
    return nested_rows(spark, rows, columns).drop("name")


def orphans(spark: SparkSession, path: str, rules: str | Sequence[str]) -> DataFrame:
    """(value): files below a folder that no rule file declares.

    Rules name outputs as `f"{RESULTS}/..."` or `"results/..."`; a `{species}` in one of them declares all tables of marts.
    """
    inside = F.regexp_extract_all("value", F.lit(r'f"\{RESULTS\}/([^"]+)"'), 1)
    literal = F.regexp_extract_all("value", F.lit(r'"results/([^"]+)"'), 1)
    declared = spark.read.text(rules).select(F.explode(F.concat(inside, literal)).alias("value")).distinct()
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path")
    names = found.select(F.regexp_replace("path", r"^.*?/" + re.escape(path.rstrip("/").rsplit("/", 1)[-1]) + "/", "").alias("value"))
    left = names.join(declared, "value", "left_anti").where("value <> 'ensembl_unknown_prefixes_ACTION_REQUIRED.txt'")
    mart = F.when(F.col("value").startswith("biomart/") & F.col("value").endswith(".tsv.gz"), "{species}")
    wild = declared.where(F.col("value").contains("{species}")).select(F.lit("{species}").alias("g_wild")).distinct()
    return left.withColumn("g_wild", mart).join(wild, "g_wild", "left_anti").select("value")


def whole_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, text) of small files."""
    return spark.read.text(path, wholetext=True).select(file_name(F.col("_metadata.file_path")).alias("file"), F.col("value").alias("text"))


def sentinels(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(key, ok, text) of status files `<key>.status` that say `ok` or what failed."""
    bare = F.regexp_replace("text", r"^\s+|\s+$", "")
    return whole_texts(spark, path).select(F.regexp_replace("file", r"\.[^.]*$", "").alias("key"), (bare == "ok").alias("ok"), bare.alias("text"))


ENTREZGENE = "`Entrezgene_track-info` struct<`Gene-track`:struct<`Gene-track_geneid`:string>>, Entrezgene_gene struct<`Gene-ref`:struct<`Gene-ref_locus`:string>>, Entrezgene_source struct<BioSource:struct<BioSource_org:struct<`Org-ref`:struct<`Org-ref_taxname`:string>>>>, Entrezgene_locus struct<`Gene-commentary`:array<struct<`Gene-commentary_accession`:string,`Gene-commentary_version`:string,`Gene-commentary_label`:string>>>"


def entrez_genes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(gene_id, symbol, organism, genomic) of Entrezgene XML, alone or in a set; genomic lists accessions with versions."""
    rows = spark.read.schema(ENTREZGENE).format("xml").option("rowTag", "Entrezgene").load(path)
    versioned = lambda c: F.concat_ws(".", c["Gene-commentary_accession"], c["Gene-commentary_version"])
    return rows.select(
        F.col("`Entrezgene_track-info`.`Gene-track`.`Gene-track_geneid`").alias("gene_id"),
        F.col("Entrezgene_gene.`Gene-ref`.`Gene-ref_locus`").alias("symbol"),
        F.col("Entrezgene_source.BioSource.BioSource_org.`Org-ref`.`Org-ref_taxname`").alias("organism"),
        F.transform(F.coalesce(F.col("Entrezgene_locus.`Gene-commentary`"), F.array()), versioned).alias("genomic"),
    )


def genbank(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(accession, organism, description, gene_id, gene_symbol, genomic, assembly, gene_ids, comment_accessions, sequence) of GenBank flat files.

    gene_id and symbol are the first of the gene, mRNA and CDS features; genomic and assembly come from the links and comments.
    """
    raw = spark.read.option("lineSep", "\n//").text(path).where(F.col("value").rlike(r"\S"))
    v = F.col("value")
    head = F.substring_index(v, "\nFEATURES ", 1)
    features = F.concat_ws("\n", F.regexp_extract_all(v, F.lit(r"(?s)(\n {5}(?:gene|mRNA|CDS) .*?)(?=\n {5}\S|\nORIGIN|\nCONTIG|\z)"), 1))
    empty = lambda c: F.nullif(c, F.lit(""))
    ids = F.array_distinct(F.regexp_extract_all(v, F.lit(r'/db_xref="GeneID:(\d+)"'), 1))
    comment = F.regexp_extract(head, r"(?s)\nCOMMENT(.*?)(?=\n[A-Z]|\z)", 1)
    origin = F.regexp_extract(v, r"(?s)\nORIGIN[^\n]*\n(.*)", 1)
    return raw.select(
        empty(F.regexp_extract(head, r"(?m)^VERSION\s+(\S+)", 1)).alias("accession"),
        empty(F.trim(F.regexp_extract(head, r"(?m)^ {2}ORGANISM\s+(.*)$", 1))).alias("organism"),
        empty(F.trim(F.regexp_replace(F.regexp_extract(head, r"(?s)DEFINITION\s+(.*?)(?=\n[A-Z])", 1), r"\s+", " "))).alias("description"),
        empty(F.regexp_extract(features, r'/db_xref="GeneID:(\d+)"', 1)).alias("gene_id"),
        empty(F.regexp_extract(features, r'/gene="([^"]*)"', 1)).alias("gene_symbol"),
        empty(F.regexp_extract(comment, r"((?:NC|NT|NW|AC)_\d+(?:\.\d+)?)", 1)).alias("genomic"),
        empty(F.regexp_extract(head, r"(?m)Assembly:\s*(GC[AF]_\d+\.\d+)", 1)).alias("assembly"),
        ids.alias("gene_ids"),
        F.array_distinct(F.regexp_extract_all(comment, F.lit(r"\b([A-Z]{1,6}_?\d{5,}(?:\.\d+)?)\b"), 1)).alias("comment_accessions"),
        F.upper(F.regexp_replace(origin, r"[\s\d/]", "")).alias("sequence"),
    )


def feature_table(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(transcript_id, gene_id) of feature-table texts: each record's first link to a gene."""
    raw = spark.read.option("lineSep", ">Feature ").text(path).where(F.col("value").rlike(r"\S"))
    name = F.regexp_extract("value", r"^(?:ref\|)?([^|\s]+)", 1)
    return raw.select(name.alias("transcript_id"), F.nullif(F.regexp_extract("value", r"db_xref\s+GeneID:(\d+)", 1), F.lit("")).alias("gene_id"))


def benchmarks(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(rule, seconds) of benchmark files' first line."""
    rows = spark.read.options(sep="\t", header=True).schema("s double").csv(path).select(F.regexp_replace(file_name(F.col("_metadata.file_path")), r"\.[^.]*$", "").alias("rule"), F.col("s").alias("seconds"))
    return rows.groupBy("rule").agg(F.first("seconds").alias("seconds"))


def record_counts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, n): FASTA records of each file by their header lines."""
    lines = spark.read.text(path).select("value", file_name(F.col("_metadata.file_path")).alias("file"))
    return lines.groupBy("file").agg(F.count_if(F.col("value").startswith(">")).alias("n"))
