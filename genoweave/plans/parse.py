"""From sequence headers to classified identifiers, and from tools' sequence sets to the provenance of each record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ids import accessions, canonical_blanks, classify, drop_numeric_version, embedded, gi_accessions, header_tokens, normalise_id, primary_token
from ..functions.rules import EMBEDDED_RULES, ID_RULES
from ..functions.sequence import digest, digest_rna
from ..operators.joins import overlap_join, validated_join
from ..operators.rows import RESOLVED, UNRESOLVED, keep_first, route, routes
from ..operators.summaries import strategy_counts

#: The ways a record and a tool's record may be the same, the surest first.
STRATEGIES = ("exact_id", "exact_header_ws", "gi_canonical", "version_aware", "multi_token", "seq_hash", "seq_hash_ut")


def parse_ids(records: DataFrame, rules=ID_RULES, embedded_rules=EMBEDDED_RULES, whole_words: bool = False) -> tuple[DataFrame, DataFrame]:
    """(classified, unknown) of records (file, file_ord, row_ord, header).

    An identifier is classified by its own form, else by an accession anywhere in its header. Of classified rows with
    the same identifier the first file's first counts; unknown ones all stay. The rules run once a row: the rows are written by their
    route, and each table reads its own.
    """
    token = records.withColumn("g_token", primary_token(F.col("header"))).withColumn("g_upper", F.upper("g_token"))
    found = token.withColumn("g_class", classify(F.col("g_token"), rules, F.col("g_upper")))
    found = found.withColumn("g_big", F.when(F.col("g_class").isNull(), F.upper("header")))  # of the few that are left
    found = found.withColumn("g_embedded", F.when(F.col("g_class").isNull(), embedded(F.col("header"), embedded_rules, whole_words, F.col("g_big"))))
    names = ("db_source", "species_hint", "source_hint", "assembly_hint")
    rows = found.select(
        F.coalesce("g_embedded.transcript_id", "g_token").alias("transcript_id"), *[F.coalesce(F.col(f"g_class.{n}"), F.col(f"g_embedded.{n}")).alias(n) for n in names],
        F.col("header").alias("raw_header"), F.col("file").alias("source_file"), "file_ord", "row_ord",
    )
    parts = routes(route(rows, [(F.col("db_source").isNull(), "pattern_unmatched")]))
    order = ["file_ord", "row_ord"]
    known = keep_first(parts[RESOLVED], ["transcript_id"], order).select("transcript_id", *names, "raw_header", "source_file")
    return known, parts[UNRESOLVED].select("transcript_id", "raw_header", "source_file", "reason")


def tokens(records: DataFrame, *keys: str) -> DataFrame:
    """(keys, prio, token): what each record (header, seq) may be recognised by, by strategy."""
    h = F.col("header")
    # step by step, as columns: each is worked out once
    rows = records.select(*keys, "seq", h, accessions(h).alias("g_acc"), gi_accessions(h).alias("g_gi"), header_tokens(h).alias("g_words"), F.array(normalise_id(h)).alias("g_id"))
    rows = rows.withColumns({"g_exact": F.array_union("g_acc", "g_id"), "g_all": F.flatten(F.array("g_id", "g_gi", "g_acc", "g_words"))})
    sets = [
        F.array(h),
        F.array(canonical_blanks(h)),
        F.col("g_gi"),
        # with and without versions are different tokens: marks keep them apart
        F.concat(F.transform("g_exact", lambda t: F.concat(F.lit("v:"), t)), F.transform("g_exact", lambda t: F.concat(F.lit("b:"), drop_numeric_version(t)))),
        F.concat("g_all", F.transform("g_all", drop_numeric_version)),
        F.array(digest(F.col("seq"))),
        F.array(digest_rna(F.col("seq"))),
    ]
    groups = F.array(*[F.struct(F.lit(k).alias("prio"), s.alias("tokens")) for k, s in enumerate(sets)])
    spread = rows.select(*keys, F.explode(groups).alias("g")).select(*keys, "g.prio", F.explode(F.array_distinct("g.tokens")).alias("token"))
    return spread.where("token is not null and token <> ''")


def map_to_tools(records: DataFrame, tool_records: DataFrame, tools: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(map, stats): for each record (record_id, header, seq) the tools with a like record, by the first strategy that finds one.

    tool_records has (tool, header, seq), tools every tool. A record's tools are in order of name.
    """
    hits = overlap_join(tokens(records, "record_id"), tokens(tool_records, "tool"))
    strategy = F.array(*map(F.lit, STRATEGIES))[F.col("prio")]
    hits = hits.withColumn("strategy", strategy).withColumn("text", F.array_join(F.array_sort(F.array_distinct(F.transform("tokens", lambda t: F.when(F.col("prio") == 3, F.regexp_replace(t, "^[vb]:", "")).otherwise(t)))), ";"))
    rows = F.array_sort(F.collect_list(F.struct("tool", "strategy", "text")))
    by_record = hits.groupBy("record_id").agg(rows.alias("r"))
    joined = by_record.select(
        "record_id", F.array_join(F.transform("r", lambda x: x.tool), ",").alias("tools"), F.size("r").alias("n_tools"), F.col("r")[0].tool.alias("primary_tool"),
        F.array_join(F.array_distinct(F.transform("r", lambda x: x.strategy)), ",").alias("match_strategy"),
        F.array_join(F.transform("r", lambda x: F.concat(x.tool, F.lit(":"), x.text)), "|").alias("matching_tokens"),
    )
    out = records.withColumn("transcript_id", normalise_id(F.col("header"))).join(joined, "record_id", "left")
    texts = [F.coalesce(c, F.lit("")).alias(c) for c in ("primary_tool", "match_strategy", "matching_tokens")]
    mapped = out.select("record_id", "transcript_id", F.col("header").alias("raw_header"), F.coalesce("tools", F.lit("")).alias("tools"), F.coalesce("n_tools", F.lit(0)).alias("n_tools"), *texts)
    return mapped, strategy_counts(hits, tools, STRATEGIES)


def annotate_unresolved(unresolved: DataFrame, tool_map: DataFrame, strict: bool = True) -> DataFrame:
    """Unresolved rows with the tools their identifier comes from."""
    return validated_join(unresolved, tool_map.select("transcript_id", "tools", "primary_tool"), ["transcript_id"], strict, ["tools"])


def input_by_species(classified: DataFrame, columns: Sequence[str] = ("transcript_id",)) -> DataFrame:
    """Counts of classified rows by source and species."""
    return classified.groupBy("db_source", "species_hint").agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def source_order(df: DataFrame, path: str = "file") -> DataFrame:
    """df with file_ord, the place of its file by name."""
    files = df.select(path).distinct().withColumn("file_ord", F.row_number().over(Window.orderBy(path)) - 1)
    return df.join(F.broadcast(files), path)  # a row a file
