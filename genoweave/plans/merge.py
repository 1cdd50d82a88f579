"""One table of resolved rows from all resolvers, the downloads it asks for, extraction and reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.rules import NULL_TOKENS
from ..functions.text import cache_key, clean_null, log_failure
from ..operators.joins import fill_from, membership
from ..operators.rows import RESOLVED as ROUTED
from ..operators.rows import UNRESOLVED, alias_filled, conform, coordinates_given, in_priority_order, keep_first, nulled, prefer_filled, rejects_of, route, routes, with_defaults
from ..operators.summaries import balanced, counted_share, funnel, pivot_rate, value_counts
from ..schemas import RESOLVED

ALIASES = {"species": "organism", "assembly": "assembly_accession"}
URL_COLUMNS = ("assembly_accession", "fasta_url", "gtf_url", "gtf_format")


def to_canonical(df: DataFrame, aliases: Mapping[str, str] = ALIASES, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """A resolver's rows in the columns of all: other names taken up, defaults set, what's missing null. A row_ord, their order, stays."""
    out = with_defaults(alias_filled(df, aliases), defaults or {})
    out = conform(out, StructType([*RESOLVED, StructField("row_ord", LongType())]) if "row_ord" in df.columns else RESOLVED, false=["is_ambiguous"])
    return nulled(out, "assembly_accession", "EnsemblPlants")


def merge(streams: Sequence[DataFrame], url_tables: Sequence[tuple[DataFrame, bool]], rejected: Sequence[DataFrame], unknown: DataFrame) -> dict[str, DataFrame]:
    """resolved, not_found, unmatched and unresolved of all resolvers' canonical rows, in order of priority.

    Rows without coordinates go to not_found. Addresses are filled from the tables by assembly name and, where a table allows
    it, by organism. Of rows with the same identifier that of the first stream counts, and of a stream's the first by row_ord, or, where
    it has none, the smallest by its place and gene. Without an accession the address's key is one.
    """
    parts = routes(coordinates_given(in_priority_order(streams)))  # the streams are worked out once
    good = parts[ROUTED].drop("reason")
    lost = parts[UNRESOLVED].select("transcript_id", "db_source", "reason")
    for dim, by_organism in url_tables:
        good = fill_from(good, dim, ["assembly_name", "organism"] if by_organism else ["assembly_name"], URL_COLUMNS, ["assembly_name", "organism", "fasta_url"])
    accession = clean_null(F.col("assembly_accession"), NULL_TOKENS)
    good = good.withColumn("assembly_accession", F.coalesce(accession, cache_key(clean_null(F.col("fasta_url"), NULL_TOKENS))))
    order = ["row_ord"] if "row_ord" in good.columns else []
    resolved = keep_first(good, ["transcript_id"], ["stream_prio", *order, "chrom", "start", "end", "gene_id"]).drop("stream_prio", "row_ord")
    not_found = lost
    for r in rejected:
        not_found = not_found.unionByName(rejects_of(r))
    unmatched = unknown.select("transcript_id", F.lit("unknown").alias("db_source"), "reason")
    return {"resolved": resolved, "not_found": not_found, "unmatched": unmatched, "unresolved": unmatched.unionByName(not_found)}


def download_manifest(resolved: DataFrame) -> DataFrame:
    """(cache_key, fasta_url): a genome for each accession of the public archive, or each address of another; one with an address is preferred."""
    url, acc = clean_null(F.col("fasta_url")), clean_null(F.col("assembly_accession"))
    key = F.when(acc.rlike("^GC[AF]_"), acc).otherwise(cache_key(url))
    rows = resolved.select(key.alias("cache_key"), url.alias("fasta_url")).where("cache_key is not null").distinct()
    return prefer_filled(rows, ["cache_key"], "fasta_url", ["fasta_url"])


def downloads(resolved: DataFrame, statuses: DataFrame, logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, unresolved): rows whose genome (assembly_accession) was fetched (statuses: key, ok), and the others with what their log (key, text) says."""
    ok = statuses.where("ok").select(F.col("key").alias("assembly_accession")).distinct().withColumn("g_ok", F.lit(True))
    told = logs.select(F.col("key").alias("assembly_accession"), log_failure(F.col("text")).alias("fail_detail"))
    known = resolved.join(ok, "assembly_accession", "left").join(told, "assembly_accession", "left").withColumn("fail_detail", F.coalesce("fail_detail", F.lit("unknown error")))
    parts = routes(route(known, [(F.col("g_ok").isNull(), "assembly_download_failed")]))
    return parts[ROUTED].select(*resolved.columns), parts[UNRESOLVED].select(*resolved.columns, "reason", "fail_detail")


def resolution_report(classified: DataFrame, unknown: DataFrame, resolved: DataFrame, unresolved: DataFrame) -> dict[str, DataFrame]:
    """The tables of the report: a funnel with its equations, and counts by source and reason."""
    parts = [d.select("transcript_id", F.lit(n).alias("part")) for n, d in (("classified", classified), ("unknown", unknown), ("resolved", resolved), ("unresolved", unresolved))]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
    counts = funnel(rows, **{n: F.col("part") == n for n in ("classified", "unknown", "resolved", "unresolved")}).withColumn("input", F.col("classified") + F.col("unknown"))
    return {
        "funnel": counts,
        "equations": balanced(counts, {"input": ("input", ["resolved", "unresolved"])}),
        "by_source": value_counts(classified, "db_source"),
        "by_assembly": value_counts(resolved, "assembly_accession", top=20),
        "by_reason": value_counts(unresolved, "reason", top=15),
    }


def status_rates(rows: DataFrame, species: str, kind: str, kinds: Sequence[str], resolved: str, least: int = 5) -> tuple[DataFrame, DataFrame]:
    """(rates by species and kind, shares by species): of rows with a resolved flag."""
    flag = F.col(resolved).cast("bigint")
    return pivot_rate(rows, species, kind, kinds, flag, F.lit(1)), counted_share(rows, [species], F.col(resolved), least).orderBy(F.desc("pct"), species)


def external_check(ids: DataFrame, mapping: DataFrame) -> DataFrame:
    """By match_type the number of ids that another database's mapping (external_id) knows."""
    return membership(ids, "transcript_id", mapping, "external_id", filter_bits=24).groupBy("match_type").agg(F.count("*").alias("n"))
