"""From classified identifiers to genes and coordinates, a resolver for each kind of source.

Remote services are tables here: a snapshot of what they answer takes part in a join like any other.
Each resolver gives one table with status and reason, so rows are never lost between its outputs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ids, rules
from ..functions.text import ensembl_urls, map_values, non_empty, region, species_of_reason, strand, strand_of_number, whole
from ..operators.joins import first_match_join, first_source_join, lookup_chain, two_probes, versioned_then_base
from ..operators.rows import first_present, keep_first, map_or_reject, matching, prefixed_or_inferred, route
from ..operators.summaries import ambiguity, ambiguous_by_count, guard, match_rates
from ..shared import written

COORDS = ("gene_id", "gene_symbol", "chrom", "start", "end", "strand")


def by_annotation(classified: DataFrame, index: DataFrame, db_source: str, organism: str, assembly: Mapping[str, str], candidates: Callable[[Column], Column], reason: str, pre_resolved: DataFrame | None = None) -> DataFrame:
    """The rows of a source, resolved by the first candidate that the annotation's index has.

    assembly gives assembly_name, assembly_accession, fasta_url, gtf_url and gtf_format as far as known. pre_resolved has
    (transcript_id, COORDS) of rows that need no lookup, once each; where it has organism, assembly_accession or db_source too,
    those count, and the assembly's other values are null there.
    """
    rows = classified.where(F.col("db_source") == db_source)
    hit = first_match_join(rows, index, candidates(F.col("transcript_id")), ["transcript_id"])
    fixed = ("assembly_name", "assembly_accession", "fasta_url", "gtf_url", "gtf_format")
    values = {k: F.lit(assembly.get(k)).cast("string") for k in fixed} | {"organism": F.lit(organism), "is_ambiguous": F.lit(False)}
    hit = hit.withColumns(values)
    if pre_resolved is not None:
        own = [c for c in ("organism", "assembly_accession", "db_source") if c in pre_resolved.columns]
        early = pre_resolved.select("transcript_id", F.struct(*COORDS, *own).alias("g_early"))
        there = F.col("g_early").isNotNull()
        hit = hit.join(early, "transcript_id", "left").withColumns({c: F.when(there, F.col(f"g_early.{c}")).otherwise(F.col(c)) for c in (*COORDS, *own)})
        if own:
            hit = hit.withColumns({c: F.when(~there, F.col(c)) for c in fixed if c not in own})
        hit = hit.drop("g_early")
    return route(hit, [(F.col("chrom").isNull(), reason)])


def coordinates_in_id(classified: DataFrame, pattern: str, groups: Sequence[str], column: str = "raw_header", **values: Column) -> DataFrame:
    """(transcript_id, COORDS, and assembly_accession if the pattern has it) of rows whose header or identifier spells out its place.

    groups names the pattern's groups: chrom, start, end, gene_id, and strand, gene_symbol and assembly_accession where it has them. values are
    columns more. Without a strand it is `.`, without a symbol that is the gene's identifier.
    """
    part = {n: F.regexp_extract(column, pattern, k) for k, n in enumerate(groups, 1)}
    out = {"gene_id": part["gene_id"], "gene_symbol": part.get("gene_symbol", part["gene_id"]), "chrom": part["chrom"], "start": part["start"].try_cast("bigint"), "end": part["end"].try_cast("bigint")}
    out["strand"] = strand(part["strand"]) if "strand" in part else F.lit(".")
    if "assembly_accession" in part:
        out["assembly_accession"] = part["assembly_accession"]
    return classified.where(F.col(column).rlike(pattern)).select("transcript_id", *[c.alias(n) for n, c in (out | values).items()])


def worm(classified: DataFrame, index: DataFrame, assembly: Mapping[str, str], organism: str = "caenorhabditis_elegans") -> DataFrame:
    """Worm identifiers: those that spell out their place, plants' headers among them, then the annotation's index."""
    rows = classified.where("db_source = 'wormbase'")
    plant = F.col("transcript_id").startswith("AT") & F.col("raw_header").rlike(rules.TAIR_PLACE[0])
    early = coordinates_in_id(rows.where(plant), *rules.TAIR_PLACE, organism=F.lit("arabidopsis_thaliana"), db_source=F.lit("plant"))
    # a null header is no plant's
    others = coordinates_in_id(rows.where(~F.coalesce(plant, F.lit(False))), *rules.WORMBASE_PLACE, column="transcript_id", organism=F.lit(organism), db_source=F.lit("wormbase"))
    return by_annotation(classified, index, "wormbase", organism, assembly, ids.candidates_wormbase, "worm_gtf_not_resolved", early.unionByName(others))


def fly(classified: DataFrame, index: DataFrame, assembly: Mapping[str, str], organism: str = "drosophila_melanogaster") -> DataFrame:
    """Fly identifiers: those whose header spells out their place, then the annotation's index."""
    early = coordinates_in_id(classified.where("db_source = 'flybase'"), *rules.FLYBASE_PLACE, organism=F.lit(organism))
    return by_annotation(classified, index, "flybase", organism, assembly, ids.candidates_generic, "fly_gtf_not_resolved", early)


def yeast(classified: DataFrame, index: DataFrame, assembly: Mapping[str, str], organism: str = "saccharomyces_cerevisiae") -> DataFrame:
    """Yeast identifiers by the annotation's index (see rules.YEAST_FEATURES for the features it is made of)."""
    return by_annotation(classified, index, "sgd", organism, assembly, ids.candidates_yeast, "sgd_gtf_not_resolved")


def plants(classified: DataFrame, index: DataFrame, strict: bool = True) -> DataFrame:
    """Plants by GTF: an index (species, key, COORDS), candidates by species, and a guard on each species' rate of matches."""
    rows = classified.where("db_source = 'plant'").withColumn("species", ids.prefix_species(F.col("transcript_id")))
    return _by_species(rows, index, lambda t: ids.candidates_species(t, F.col("species")), "plant_gtf_not_found", strict)


def phytozome(unresolved: DataFrame, index: DataFrame, sources: Sequence[str], strict: bool = True) -> DataFrame:
    """What other plant resolvers left, by GFF3. Rows that failed for lack of a source count; only if there are none, all whose prefix tells a species."""
    hint = F.when(F.col("species_hint").isin(*sources), F.col("species_hint"))
    species = F.coalesce(hint, ids.prefix_species(F.col("transcript_id"), rules.PHYTOZOME_PREFIXES))
    rows = prefixed_or_inferred(unresolved.withColumn("species", species), F.col("reason").startswith("no_gtf_source"), F.col("species"))
    return _by_species(rows.drop("reason", "status"), index, ids.candidates_phytozome, "phytozome_not_found", strict)


def _by_species(rows: DataFrame, index: DataFrame, candidates: Callable[[Column], Column], reason: str, strict: bool) -> DataFrame:
    keyed = index.select(F.concat_ws("\u0001", "species", "key").alias("key"), *COORDS)
    names = F.transform(candidates(F.col("transcript_id")), lambda c: F.concat_ws("\u0001", F.col("species"), c))
    hit = first_match_join(rows, keyed, names, ["transcript_id"])
    known = index.select("species").distinct().withColumn("g_known", F.lit(True))
    out = route(hit.join(known, "species", "left"), [(F.col("species").isNull(), "species_unknown"), (F.col("g_known").isNull(), F.concat(F.lit("no_gtf_source:"), F.col("species"))), (F.col("chrom").isNull(), reason)]).drop("g_known")
    if strict:
        out = written(out)  # the guard counts what the plan gives, and nothing is worked out twice
        n = lambda df: df.where("species is not null").groupBy("species").agg(F.count("*").alias("n"))
        guard(match_rates(n(out.where("status = 'resolved' or reason = '" + reason + "'")), n(out.where("status = 'resolved'")), "species"), "species")
    return out


def plant_metadata(classified: DataFrame, metadata: DataFrame, service: DataFrame | None = None) -> DataFrame:
    """Plants by the marts' table (transcript_id, COORDS, assembly_accession): its transcripts and genes are keys, transcripts first.

    Where a snapshot of the lookup service is given (key, COORDS, assembly_accession, a key once), its hit overrides the table's.
    """
    keyed = metadata.select(F.posexplode(F.array_distinct(F.array("transcript_id", F.split_part("transcript_id", F.lit("."), F.lit(1)), "gene_id"))).alias("key_ord", "key"), *COORDS, "assembly_accession")
    index = keep_first(keyed.where("key <> ''"), ["key"], ["key_ord", "chrom", "start", "end"]).drop("key_ord")
    names = ids.candidates_plant(F.col("transcript_id"))
    hit = first_match_join(classified.where("db_source = 'plant'"), index, names, ["transcript_id"])
    if service is not None:
        found = ("matched_key", "matched_pos", *COORDS, "assembly_accession")
        late = first_match_join(hit.select("transcript_id").distinct(), service, ids.candidates_plant(F.col("transcript_id")), ["transcript_id"], how="inner")
        hit = hit.join(late.select("transcript_id", F.struct(*found).alias("g_late")), "transcript_id", "left")
        hit = hit.withColumns({c: F.when(F.col("g_late").isNotNull(), F.col(f"g_late.{c}")).otherwise(F.col(c)) for c in found}).drop("g_late")
    return route(hit, [(F.col("matched_key").isNull(), "external_not_found")])


def plants_by_release(rows: DataFrame, calls: DataFrame, answers: DataFrame) -> DataFrame:
    """Plants (transcript_id, species) by the first release that answers for their species at all.

    calls (species, release, release_ord, state) says how each release took a species' request: `ok`, or anything else where it failed and the
    next is tried. answers (species, release, transcript_id, COORDS) are its rows; none is an empty answer, and the next release is tried too.
    Identifiers that the chosen release lacks stay unresolved: older ones aren't asked for them.
    """
    asked = answers.join(rows.select("species", "transcript_id").distinct(), ["species", "transcript_id"], "left_semi")
    filled = calls.where("state = 'ok'").join(asked.select("species", "release").distinct(), ["species", "release"], "left_semi")
    chosen = filled.groupBy("species").agg(F.min_by("release", "release_ord").alias("release"))
    found = keep_first(asked.join(chosen, ["species", "release"], "left_semi"), ["species", "transcript_id"], list(COORDS))
    known = calls.select("species").distinct().withColumn("g_known", F.lit(True))
    out = rows.join(known, "species", "left").join(chosen.select("species", F.col("release").alias("g_release")), "species", "left")
    out = out.join(found.withColumn("g_hit", F.lit(True)), ["species", "transcript_id"], "left")
    missed = F.concat(F.lit("biomart_no_match_"), F.col("species"))
    return route(out, [
        (F.col("species").isNull(), "not_plant_id"), (F.col("g_known").isNull(), F.concat(F.lit("no_biomart_dataset_"), F.col("species"))),
        (F.col("g_release").isNull(), F.concat(missed, F.lit("_all_releases_exhausted"))), (F.col("g_hit").isNull(), missed),
    ]).drop("g_known", "g_release", "g_hit")


def gramene(unresolved: DataFrame, snapshot: DataFrame) -> DataFrame:
    """What the marts left, by the search service's documents (id, chrom, start, end, strand, region, gene_id, gene_symbol, taxon)."""
    place = region(F.col("chrom"), F.col("start"), F.col("end"), F.col("strand"), F.col("region"))
    index = snapshot.withColumn("p", place).select(F.col("id").alias("key"), "gene_id", "gene_symbol", "p.chrom", "p.start", "p.end", "p.strand")
    inferred = F.col("inferred_species") if "inferred_species" in unresolved.columns else F.lit(None).cast("string")
    rows = unresolved.withColumn("organism", species_of_reason(inferred, F.col("reason"))).drop("reason", "status")
    hit = first_match_join(rows, index, ids.candidates_gramene(F.col("transcript_id")), ["transcript_id"])
    return route(hit, [(F.col("matched_key").isNull(), "gramene_not_found")])


def ensembl_prefixes(spark: SparkSession, overrides: Mapping[str, tuple[str, str]] | None = None) -> DataFrame:
    """(prefix, species, build) of the known prefixes of Ensembl transcripts; overrides replace or add some."""
    table = {prefix: rest for prefix, *rest in rules.ENSEMBL_PREFIXES} | {k.upper(): v for k, v in (overrides or {}).items()}
    return spark.createDataFrame([(k, *v) for k, v in table.items()], "prefix string, species string, build string")


def ensembl_species(classified: DataFrame, prefixes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(species_map, unknown_prefixes): the species and build of Ensembl identifiers by prefix (see ensembl_prefixes)."""
    rows = classified.where("db_source = 'ensembl'").select("transcript_id", ids.ensembl_prefix(F.col("transcript_id")).alias("prefix"))
    joined = rows.join(prefixes, "prefix", "left")
    unknown = joined.where("species is null").groupBy("prefix").agg(F.min("transcript_id").alias("example_id"), F.count("*").alias("n_transcripts"))
    return joined.where("species is not null").select("transcript_id", "prefix", "species", "build"), unknown.withColumn("action_required", F.lit("add the prefix to the table"))


def ensembl(species_map: DataFrame, mart: DataFrame) -> DataFrame:
    """Ensembl identifiers by the marts' rows (species, transcript, COORDS with strand as 1 or -1, row_ord).

    Looked up in the marts of all species: with versions, or, only where that finds nothing, without. Several genes make a row ambiguous: see role.
    """
    signed = mart.withColumn("strand", strand_of_number(F.col("strand").cast("string")))
    hits = versioned_then_base(species_map, signed.withColumnRenamed("species", "mart_species"), "transcript_id", "transcript")
    ranked = ambiguity(hits, "transcript_id", "gene_id", ["match_type", "row_ord"])
    lost = species_map.join(ranked.select("transcript_id").distinct(), "transcript_id", "left_anti")
    out = ranked.unionByName(lost, allowMissingColumns=True)
    return route(out.withColumn("role", F.coalesce("role", F.lit("primary"))), [(F.col("matched_transcript").isNull(), "ensembl_not_found")])


def ensembl_assemblies(resolved: DataFrame, release: Column, all_mapped: bool = False, mapping: Mapping[str, str] = rules.GRC_ASSEMBLIES) -> DataFrame:
    """Assembly names of the Genome Reference Consortium as accessions, with the addresses of the release; unmapped ones are rejected.

    all_mapped looks at every name of the mapping, and not only at those that start with GRC.
    """
    old = F.col("assembly_accession")
    name = F.upper(F.regexp_replace(old, r"\s+", ""))
    gate = name.startswith("GRC") | (name.isin(*mapping) if all_mapped else F.lit(False))
    title = map_values(old, rules.GRC_NAMES, keep=False, blanks=True)
    urls = ensembl_urls(F.col("organism"), title, release)
    rows = resolved.withColumns({"g_title": F.when(gate, F.coalesce(title, old)), "g_urls": F.when(gate, urls)})
    out = map_or_reject(rows, "assembly_accession", map_values(old, mapping, keep=False, blanks=True), gate, "grc_mapping_failed:")
    for column, value in (("assembly_name", F.col("g_title")), ("fasta_url", F.col("g_urls.fasta_url")), ("gtf_url", F.col("g_urls.gtf_url"))):
        out = out.withColumn(column, F.coalesce(value, F.col(column)) if column in out.columns else value)
    return out.drop("g_title", "g_urls")


def ucsc_assemblies(resolved: DataFrame, mapping: Mapping[str, str] = rules.UCSC_ASSEMBLIES, reject: bool = True) -> DataFrame:
    """Build names as accessions. Unknown builds are rejected, or stay as they are."""
    old = F.col("assembly_accession")
    if not reject:
        return resolved.withColumn("assembly_accession", map_values(old, mapping))
    gate = ~F.coalesce(F.upper(old).rlike("^GC[AF]_"), F.lit(False)) & non_empty(old).isNotNull()
    return map_or_reject(resolved, "assembly_accession", map_values(old, mapping, keep=False), gate, "ucsc_mapping_failed:")


def chromosome_assemblies(resolved: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Rows whose assembly is a chromosome's accession, by a snapshot (accession, assembly); without one they are rejected."""
    s = snapshot.select(F.col("accession").alias("assembly_accession"), F.col("assembly").alias("g_snapshot"))
    rows = resolved.join(s, "assembly_accession", "left")
    fixed = map_values(F.col("assembly_accession"), rules.CHROMOSOME_ASSEMBLIES, keep=False)
    gate = F.substring("assembly_accession", 1, 3).isin(*rules.CHROMOSOME_PREFIXES)
    return map_or_reject(rows, "assembly_accession", F.coalesce(fixed, F.col("g_snapshot")), gate, "chromosomal_mapping_failed:").drop("g_snapshot")


def noncode(classified: DataFrame, tiers: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """noncode identifiers through the releases v5, v4 and 2016, each trying what the one before left.

    tiers gives for v5 and v4 (genes: key, value; bed: name, chrom, start, end, strand, assembly; known: id, species), and for
    2016 the same, of which only known counts: that release has no coordinates.
    """
    prefix = F.regexp_extract("transcript_id", r"^(NON[A-Z]{3}[TG])\d+\.\d+$", 1)
    rows = classified.where("db_source = 'noncode'").withColumn("prefix", prefix)
    v5 = _noncode_tier(rows, *tiers["v5"], {k: v[:2] for k, v in rules.NONCODE_V5.items()}, "not_found_in_noncode_v5", "unknown_noncode_prefix:")
    first = v5.where("status = 'resolved'")
    left = v5.where("status = 'unresolved'").select(*rows.columns)
    v4 = _noncode_tier(left, *tiers["v4"], rules.NONCODE_V4, "not_found_in_noncode_v4", None)
    second = v4.where("status = 'resolved'")
    left = v4.where("status = 'unresolved'").select(*rows.columns)
    known = tiers["2016"][2].select(F.col("id").alias("transcript_id")).distinct().withColumn("g_known", F.lit(True))
    last = left.join(known, "transcript_id", "left")
    unknown = ~_noncode_known(rules.NONCODE_V5)
    third = route(last, [
        (F.col("prefix") == "", "invalid_noncode_format"), (unknown, F.concat(F.lit("unknown_noncode_prefix:"), F.col("prefix"))),
        (F.col("g_known").isNotNull(), "matched_noncode2016_no_coordinates"), (F.lit(True), "not_found_in_any_noncode"),
    ]).drop("g_known")
    return first.unionByName(second, allowMissingColumns=True).unionByName(third, allowMissingColumns=True)


def _noncode_known(meta: Mapping[str, tuple]) -> Column:
    return F.substring("prefix", 1, 6).isin(*meta) & ~F.col("prefix").isin(*rules.NONCODE_ABSENT)


def _noncode_tier(rows: DataFrame, genes: DataFrame, bed: DataFrame, known: DataFrame, meta: Mapping[str, tuple[str, str]], not_found: str, unknown_prefix: str | None) -> DataFrame:
    species = F.substring("prefix", 1, 6)
    of = lambda k: F.create_map(*[F.lit(x) for p, v in meta.items() for x in (p, v[k])])[species]
    rows = rows.withColumns({"organism": of(0), "assembly_accession": of(1), "base_id": ids.drop_last_part(F.col("transcript_id"))})
    named = lookup_chain(rows, genes, [F.col("transcript_id"), F.col("base_id")], "key", "value")
    gene = F.when(F.col("prefix").endswith("T"), F.nullif("value", F.lit(""))).otherwise(F.col("transcript_id"))
    named = named.withColumn("gene_id", F.coalesce(gene, "base_id")).withColumn("gene_symbol", F.col("gene_id")).drop("value")
    # a place under the full name comes before one under the same name without version
    places = bed.select(F.posexplode(F.array("name", F.concat(F.lit("~"), ids.drop_last_part(F.col("name"))))).alias("form", "key"), "chrom", "start", "end", "strand", "row_ord")
    hit = two_probes_marked(named, keep_first(places, ["key"], ["row_ord"]).drop("form", "row_ord"))
    listed = known.select(F.col("id").alias("transcript_id")).distinct().withColumn("g_listed", F.lit(True))
    hit = hit.join(listed, "transcript_id", "left")
    missing_prefix = F.concat(F.lit(unknown_prefix), F.col("prefix")) if unknown_prefix else F.lit("not_in_noncode_v4_species")
    return route(hit, [(F.col("prefix") == "", "invalid_noncode_format"), (~_noncode_known(meta), missing_prefix), (F.col("chrom").isNull() & F.col("g_listed").isNull(), not_found)]).drop("g_listed", "base_id")


def two_probes_marked(df: DataFrame, index: DataFrame) -> DataFrame:
    """The place of the full name, else of the name without version, which the index marks with `~`."""
    names = F.array(F.col("transcript_id"), F.concat(F.lit("~"), F.col("base_id")))
    return first_match_join(df, index, names, ["transcript_id"])


def ncbi(classified: DataFrame, nucleotides: DataFrame, links: DataFrame, genes: DataFrame) -> DataFrame:
    """RefSeq identifiers by snapshots: nucleotides (accession, uid), links (uid, gene_id), genes (gene_id, symbol, organism, COORDS' places,
    assembly_accession). Several genes make a row ambiguous: see role."""
    hit = two_probes(classified.where("db_source = 'ncbi'"), nucleotides.withColumnRenamed("accession", "key"), "transcript_id", ["transcript_id"])
    linked = hit.join(links, "uid", "left").join(genes, "gene_id", "left")
    rows = ambiguity(linked, "transcript_id", "gene_id", ["gene_id"])
    return route(rows, [(F.col("uid").isNull(), "ncbi_not_found"), (F.col("gene_id").isNull(), "no_gene_link"), (F.col("chrom").isNull(), "no_coordinates")])


def ucsc(classified: DataFrame, tracks: DataFrame) -> DataFrame:
    """UCSC identifiers by tracks (transcript_id, assembly_prio, COORDS): the first assembly that has one counts."""
    hit = first_source_join(classified.where("db_source = 'ucsc'"), tracks, "transcript_id", "assembly_prio")
    return route(ambiguous_by_count(hit, "transcript_id"), [(F.col("chrom").isNull(), "ucsc_not_found")])


def genbank_second_pass(unresolved: DataFrame, records: DataFrame, genes: DataFrame) -> DataFrame:
    """What ncbi left, by GenBank records (accession, gene_id, ...) and genes; identifiers of other shapes are set aside first."""
    shaped = matching(unresolved.drop("reason", "status"), "transcript_id", r"^[A-Z]{1,2}_?\d+(\.\d+)?$", "not_an_accession")
    ok = shaped.where("status = 'resolved'").drop("status", "reason")
    joined = ok.join(records.select(F.col("accession").alias("transcript_id"), "gene_id", F.lit(True).alias("g_there")), "transcript_id", "left").join(genes, "gene_id", "left")
    out = route(joined, [(F.col("g_there").isNull(), "WITHDRAWN"), (F.col("gene_id").isNull(), "no_gene_id"), (F.col("chrom").isNull(), "no_coordinates")]).drop("g_there")
    return out.unionByName(shaped.where("status = 'unresolved'"), allowMissingColumns=True)


def abandoned_third_pass(unresolved: DataFrame, records: DataFrame, assemblies: DataFrame, by_transcript: DataFrame, by_gene: DataFrame) -> DataFrame:
    """What the second pass left: by its record's genome (records: accession, genomic, gene_ids; assemblies: genomic, assembly), then the
    assembly's annotation by transcript (assembly, transcript_id, COORDS), else by gene (assembly, gene, COORDS), which is ambiguous."""
    rows = unresolved.drop("reason", "status").join(records.withColumnRenamed("accession", "transcript_id"), "transcript_id", "left").join(assemblies, "genomic", "left")
    a = by_transcript.select("assembly", "transcript_id", F.struct(*COORDS).alias("g_a"))
    rows = rows.join(a, ["assembly", "transcript_id"], "left")
    spread = rows.select("transcript_id", "assembly", F.posexplode("gene_ids").alias("g_pos", "gene")).join(by_gene.select("gene", "assembly", F.struct(*COORDS).alias("g_b")), ["gene", "assembly"])
    b = spread.groupBy("transcript_id").agg(F.min_by("g_b", F.struct("g_pos", "g_b")).alias("g_b"))  # the first gene of the record's list
    rows = rows.join(b, "transcript_id", "left").withColumn("g_hit", F.coalesce("g_a", "g_b"))
    out = rows.select(*[c for c in rows.columns if not c.startswith("g_")], *[F.col(f"g_hit.{c}").alias(c) for c in COORDS], (F.col("g_a").isNull() & F.col("g_b").isNotNull()).alias("is_ambiguous"))
    return route(out, [(F.col("genomic").isNull(), "no_genomic_accession"), (F.col("assembly").isNull(), "no_assembly"), (F.col("chrom").isNull(), "not_in_annotation")])


def gene_assemblies(genes: DataFrame, direct: DataFrame, nucleotide: DataFrame, metadata: DataFrame) -> DataFrame:
    """genes (gene_id, genomic) with their assembly: the gene's own (gene_id, assembly), else its nucleotide's (genomic, assembly), and metadata."""
    d = direct.select("gene_id", F.col("assembly").alias("g_direct"))
    n = nucleotide.select("genomic", F.col("assembly").alias("g_nucleotide"))
    rows = genes.join(d, "gene_id", "left").join(n, "genomic", "left").withColumn("assembly", F.coalesce("g_direct", "g_nucleotide"))
    rows = rows.withColumn("assembly_status", F.when(F.col("g_direct").isNotNull(), "gene").when(F.col("g_nucleotide").isNotNull(), "nucleotide").otherwise("not_found"))
    return rows.drop("g_direct", "g_nucleotide").join(metadata, "assembly", "left")


def genomic_assemblies(genomic: DataFrame, services: Sequence[DataFrame]) -> DataFrame:
    """genomic (accession) with assembly and service: what the first service in order answers, and its number, from 0. A service is a snapshot
    (accession, assembly) of one batched lookup; null and empty answers are none, and of several for an accession the smallest counts."""
    answers = None
    for k, s in enumerate(services):
        one = s.select("accession", F.lit(k).alias("service"), non_empty(F.col("assembly")).alias("assembly")).where("assembly is not null")
        answers = one if answers is None else answers.unionByName(one)
    best = answers.groupBy("accession").agg(F.min(F.struct("service", "assembly")).alias("g_hit"))
    return genomic.join(best, "accession", "left").select(*genomic.columns, "g_hit.assembly", "g_hit.service")


def abandoned_debug(resolved: DataFrame, accessions: DataFrame, by_transcript: DataFrame, by_gene: DataFrame) -> DataFrame:
    """For each accession (transcript_id), what abandoned_third_pass made of it and how: its genome, assembly and genes, status, reason, and the
    strategy that had an answer, `transcript_id` before `gene_id`, else none. by_transcript and by_gene are that pass's tables."""
    first = by_transcript.select("assembly", "transcript_id").distinct().withColumn("g_a", F.lit(True))
    spread = resolved.select("transcript_id", "assembly", F.explode("gene_ids").alias("gene")).join(by_gene.select("assembly", "gene").distinct(), ["assembly", "gene"], "left_semi")
    second = spread.select("transcript_id").distinct().withColumn("g_b", F.lit(True))
    rows = resolved.join(first, ["assembly", "transcript_id"], "left").join(second, "transcript_id", "left")
    told = rows.select(
        "transcript_id", F.col("genomic").alias("genomic_accession"), F.col("assembly").alias("assembly_accession_found"), F.array_join("gene_ids", ";").alias("gene_ids"),
        F.col("status").alias("resolution_status"), F.col("reason").alias("unresolved_reason"), F.when(F.col("g_a"), "transcript_id").when(F.col("g_b"), "gene_id").alias("resolution_strategy"),
    )
    out = accessions.select("transcript_id").join(told, "transcript_id", "left").withColumn("resolution_status", F.coalesce("resolution_status", F.lit("unresolved")))
    return out.na.fill("", ["assembly_accession_found", "gene_ids", "unresolved_reason", "resolution_strategy"])


def gene_metadata(raw: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """A mart's table under our names, with whole-number coordinates and signs; rows without a transcript go."""
    df = raw.withColumnsRenamed(dict(names)).dropna(subset=["transcript_id"])
    return df.withColumns({"start": whole(F.col("start")), "end": whole(F.col("end")), "strand": strand_of_number(F.col("strand").cast("string"))})


def species_label(df: DataFrame) -> Column:
    return first_present(df, ("organism", "species_hint", "species"))
