"""Genomes as tables of chunks: chromosome names, and slices of sequences by equality joins on chunk numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import flanked, ordered, stranded
from ..functions.text import toggle_chr
from .rows import route

CHUNK = 1 << 16


def chunked(genome: DataFrame, size: int = CHUNK) -> DataFrame:
    """(assembly, seqid, chunk_no, seq) of a genome (assembly, seqid, seq), in pieces of `size` letters."""
    pieces = F.when(F.length("seq") > 0, F.regexp_extract_all("seq", F.lit(f"(?s).{{1,{size}}}"), 0)).otherwise(F.array("seq"))  # one pass over a sequence
    return genome.select("assembly", "seqid", F.posexplode(pieces).alias("chunk_no", "seq"))


def genome_index(chunks: DataFrame) -> DataFrame:
    """(assembly, seqid, length) of a table of chunks."""
    return chunks.groupBy("assembly", "seqid").agg(F.sum(F.length("seq")).cast("bigint").alias("length"))


def chrom_aliases(report: DataFrame) -> DataFrame:
    """(assembly, alias, cand_ord, seqid) of an assembly report.

    An alias, as it is and in lower case, stands for the RefSeq and then the GenBank name; of rows that give the same
    alias the last counts. Rows without a RefSeq name don't; a molecule's name counts on assembled molecules only.
    """
    rows = report.where((F.trim("refseq") != "") & (F.trim("refseq") != "na"))
    molecule = F.when(F.trim("role") == "assembled-molecule", F.col("molecule"))
    names = F.array("sequence_name", "genbank", "refseq", "ucsc_name", molecule)
    spread = rows.select("assembly", "row_ord", F.trim("refseq").alias("r"), F.trim("genbank").alias("g"), F.posexplode(names).alias("name_ord", "alias"))
    named = spread.withColumn("alias", F.trim("alias")).where("alias <> '' and alias <> 'na'")
    both = named.select("*", F.posexplode(F.array("alias", F.lower("alias"))).alias("form_ord", "form"))
    last = both.groupBy("assembly", "form").agg(F.max_by(F.struct("r", "g"), F.struct("row_ord", "name_ord", "form_ord")).alias("x"))
    seqids = F.filter(F.array("x.r", "x.g"), lambda s: (s != "") & (s != "na"))
    return last.select("assembly", F.col("form").alias("alias"), F.posexplode(seqids).alias("cand_ord", "seqid"))


def resolve_chroms(df: DataFrame, aliases: DataFrame, index: DataFrame, row_id: str) -> DataFrame:
    """df with seqid and length: the first sequence of its assembly that chrom may mean, else null.

    Tried in turn: what the report says of the name, the name itself, and both again with `chr` in front or without it.
    """
    chrom = F.col("chrom")
    names = F.array(chrom, toggle_chr(chrom))
    tried = df.select(row_id, "assembly", F.posexplode(names).alias("name_ord", "name"))
    a = aliases.select("assembly", "alias", "cand_ord", F.col("seqid").alias("g_seqid"))
    exact = tried.join(a, (tried["assembly"] == a["assembly"]) & (tried["name"] == a["alias"])).select(row_id, tried["assembly"], (F.col("name_ord") * 10 + F.col("cand_ord")).alias("g_ord"), F.col("g_seqid").alias("seqid"))
    # the lower-case form counts where the name itself is no alias
    missing = tried.join(a.select("assembly", F.col("alias").alias("name")).distinct(), ["assembly", "name"], "left_anti")
    low = missing.withColumn("g_low", F.lower("name"))
    loose = low.join(a, (low["assembly"] == a["assembly"]) & (low["g_low"] == a["alias"])).select(row_id, low["assembly"], (F.col("name_ord") * 10 + F.col("cand_ord")).alias("g_ord"), F.col("g_seqid").alias("seqid"))
    bare = tried.select(row_id, "assembly", (F.col("name_ord") * 10 + 9).alias("g_ord"), F.col("name").alias("seqid"))
    found = exact.unionByName(loose).unionByName(bare).join(index, ["assembly", "seqid"])
    best = found.groupBy(row_id).agg(F.min_by(F.struct("seqid", "length"), "g_ord").alias("g_hit"))
    return df.join(best, row_id, "left").select(*df.columns, "g_hit.seqid", "g_hit.length")


def slices(regions: DataFrame, chunks: DataFrame, row_id: str, size: int = CHUNK) -> DataFrame:
    """regions (assembly, seqid, ext_start, ext_end) with seq: that stretch in upper case, null if nothing is there.

    A region is spread over the chunks it touches and joined on their numbers, an equality, so that a long chromosome is
    many keys. Pieces are cut before they are put together.
    """
    last = F.greatest(F.floor((F.col("ext_end") - 1) / size), F.floor(F.col("ext_start") / size)).cast("int")
    touched = regions.select(row_id, "assembly", "seqid", "ext_start", "ext_end", F.explode(F.sequence(F.floor(F.col("ext_start") / size).cast("int"), last)).alias("chunk_no"))
    joined = touched.join(chunks, ["assembly", "seqid", "chunk_no"])
    at = F.col("chunk_no") * size
    low = F.greatest(F.col("ext_start") - at, F.lit(0)).cast("int")
    high = F.least(F.col("ext_end") - at, F.lit(size)).cast("int")
    part = F.substring(F.col("seq"), low + 1, F.greatest(high - low, F.lit(0)))
    pieces = joined.groupBy(row_id).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk_no", part.alias("s")))), lambda x: x.s), "").alias("g_seq"))
    return regions.join(pieces, row_id, "left").withColumn("seq", F.nullif(F.upper("g_seq"), F.lit(""))).drop("g_seq")


def extract(genes: DataFrame, chunks: DataFrame | Callable[[DataFrame], DataFrame], aliases: DataFrame, index: DataFrame, up: int = 1000, down: int = 1000, row_id: str = "transcript_id", size: int = CHUNK) -> DataFrame:
    """genes (row_id, assembly, chrom, start, end, strand, ...) routed, with seqid, ext_start, ext_end and the stranded seq.

    Rejects, in this order: missing_coordinates (either end), assembly_not_cached, chrom_not_found, sequence_error. Inverted coordinates are
    put in order first. Instead of chunks, a function of regions (row_id, assembly, seqid, ext_start, ext_end) may give their seq, such as
    sources.indexed.indexed_slices.
    """
    low, high = ordered(F.col("start"), F.col("end"))
    given = F.col("start").isNotNull() & F.col("end").isNotNull()
    rows = genes.withColumns({"start": F.when(given, low).otherwise(F.col("start")), "end": F.when(given, high).otherwise(F.col("end"))})
    cached = index.select("assembly").distinct().withColumn("g_cached", F.lit(True))
    rows = resolve_chroms(rows.join(cached, "assembly", "left"), aliases, index, row_id)
    a, b = flanked(F.col("start"), F.col("end"), F.col("strand"), F.col("length"), up, down)
    rows = rows.withColumns({"ext_start": a, "ext_end": b})
    usable = rows.where("seqid is not null and ext_start is not null and ext_end > ext_start").select(row_id, "assembly", "seqid", "ext_start", "ext_end")
    cut = (chunks(usable) if callable(chunks) else slices(usable, chunks, row_id, size)).select(row_id, "seq")
    joined = rows.join(cut, row_id, "left").withColumn("seq", stranded(F.col("seq"), F.col("strand")))
    checks = [
        (F.col("start").isNull() | F.col("end").isNull(), "missing_coordinates"),
        (F.col("g_cached").isNull(), "assembly_not_cached"),
        (F.col("seqid").isNull(), "chrom_not_found"),
        (F.col("seq").isNull(), "sequence_error"),
    ]
    return route(joined, checks).drop("g_cached", "length")


def bed(extracted: DataFrame, up: int, down: int, row_id: str = "transcript_id") -> DataFrame:
    """The 15 columns of the BED table of extracted rows."""
    names = [("seqid", "chrom"), ("ext_start", "chromStart"), ("ext_end", "chromEnd"), (row_id, "name")]
    rest = [("gene_id", "gene_id"), ("gene_symbol", "gene_symbol"), ("organism", "organism"), ("assembly", "assembly"), ("start", "gene_start"), ("end", "gene_end")]
    return extracted.select(
        *[F.col(a).alias(b) for a, b in names], F.lit(0).alias("score"), "strand", *[F.col(a).alias(b) for a, b in rest],
        F.lit(up).alias("upstream_bp"), F.lit(down).alias("downstream_bp"), F.coalesce("is_ambiguous", F.lit(False)).alias("is_ambiguous"),
    )


def fasta_text(extracted: DataFrame, up: int, down: int, row_id: str = "transcript_id", null_text: str = "nan", width: int = 60) -> DataFrame:
    """(value): each extracted sequence as a FASTA record, its header saying gene, place and flanks. Nulls read null_text."""

    def text(c: str):
        return F.coalesce(F.col(c).cast("string"), F.lit(null_text))

    header = F.concat(
        F.lit(">"), text(row_id), F.lit(" gene="), text("gene_id"), F.lit(" symbol="), text("gene_symbol"), F.lit(" organism="), text("organism"),
        F.lit(" assembly="), text("assembly"), F.lit(" loc="), text("seqid"), F.lit(":"), text("ext_start"), F.lit("-"), text("ext_end"),
        F.lit("("), text("strand"), F.lit(f") upstream={up} downstream={down}\n"),
    )
    lines = F.regexp_replace(F.regexp_replace(F.col("seq"), f"(.{{{width}}})", "$1\n"), "\n$", "")
    return extracted.select(F.concat(header, lines).alias("value"))


def annotations_by_gene(gff: DataFrame, ids: DataFrame) -> DataFrame:
    """ids (transcript_id) with the gene feature their transcript belongs to: two passes over a parsed annotation
    (feature, transcript_id, gene_id, chrom, start, end, strand), joined on the gene."""
    tx = gff.where(F.col("transcript_id").isNotNull() & F.col("gene_id").isNotNull()).groupBy("transcript_id").agg(F.min_by("gene_id", "row_ord").alias("gene_id"))
    genes = gff.where("feature = 'gene'").groupBy("gene_id").agg(F.min_by(F.struct("chrom", "start", "end", "strand"), "row_ord").alias("g"))
    return ids.join(tx, "transcript_id").join(genes, "gene_id").select("transcript_id", "gene_id", "g.chrom", "g.start", "g.end", "g.strand")


def spans(df: DataFrame, row_id: str, chunks: DataFrame, size: int = CHUNK) -> DataFrame:
    """slices of exons (row_id, exon_no, assembly, seqid, ext_start, ext_end), joined by start for each row_id: (row_id, seq)."""
    keyed = df.withColumn("g_key", F.concat_ws("\u0001", F.col(row_id).cast("string"), F.col("exon_no").cast("string")))
    cut = slices(keyed, chunks, "g_key", size)
    return cut.groupBy(row_id).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ext_start", "seq"))), lambda x: x.seq), "").alias("seq"))


def in_window(exons: DataFrame, row_id: str, strand: str = "strand") -> DataFrame:
    """exons (row_id, exon_no, ext_start, ext_end, strand) with window_start, window_end, and rel_start and rel_end: their places in the window
    of their row, which begins at its first exon's start, counted from the row's own beginning: from the right on `-`."""
    span = exons.groupBy(row_id).agg(F.min("ext_start").alias("window_start"), F.max("ext_end").alias("window_end"))
    turned = F.col(strand) == "-"
    rows = exons.join(span, row_id)
    low = F.when(turned, F.col("window_end") - F.col("ext_end")).otherwise(F.col("ext_start") - F.col("window_start"))
    return rows.withColumns({"rel_start": low, "rel_end": low + F.col("ext_end") - F.col("ext_start")})
