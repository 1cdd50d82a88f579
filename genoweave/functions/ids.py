"""Identifiers as Column expressions: tokens of headers, classification, versions and the candidates tried in turn."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import ACCESSIONS, EMBEDDED_RULES, GI, ID_RULES, PLANT_PREFIXES, Rule


def primary_token(header: Column) -> Column:
    """The first word of a FASTA header, up to its first pipe."""
    bare = F.regexp_replace(header, r"^>*\s*", "")
    return F.split_part(F.split(bare, r"\s+")[0], F.lit("|"), F.lit(1))


def normalise_id(header: Column) -> Column:
    """The RefSeq accession of a header in GI style, else its primary token."""
    return F.coalesce(F.nullif(F.regexp_extract(header, GI, 2), F.lit("")), primary_token(header))


def _flagged(rule: Rule) -> str:
    return rule.pattern if rule.db_source == "noncode" else f"(?i){rule.pattern}"


def _outcome(rule: Rule) -> Column:
    return F.struct(*[F.lit(getattr(rule, n)).alias(n) for n in ("db_source", "species_hint", "source_hint", "assembly_hint")])


def first_of(branches: Sequence[tuple[Column, Column]]) -> Column:
    """The value of the first condition that holds, else null."""
    head, *rest = branches
    return reduce(lambda out, b: out.when(*b), rest, F.when(*head))


def needle(pattern: str) -> tuple[str, bool]:
    """(letters, at the start): the longest run of plain letters that every match of a rule's pattern has, upper-cased, and whether matches
    of an anchored pattern begin with it. Classes, choices, and what may be left out have no such letters.
    """
    runs: list[list] = [[0, ""]]
    at = 1 if pattern.startswith("^") else 0
    begin = at

    def part(run: str) -> None:
        if run:
            runs[-1][1] += run
        elif runs[-1][1]:
            runs.append([-1, ""])
        else:
            runs[-1][0] = -1

    while at < len(pattern):
        c, nxt = pattern[at], at + 1
        letter = ""
        if c == "\\":
            nxt, letter = at + 2, "" if pattern[at + 1].isalnum() else pattern[at + 1]
        elif c == "[":
            nxt = pattern.index("]", at + 1) + 1
        elif c == "(":
            depth, nxt, choice = 1, at + 1, False
            while depth:
                plain = pattern[nxt - 1] != "\\"
                depth += {"(": 1, ")": -1}.get(pattern[nxt], 0) if plain else 0
                choice |= plain and depth == 1 and pattern[nxt] == "|"
                nxt += 1
            if not choice and pattern[nxt : nxt + 1] not in ("?", "*", "{"):
                inner = pattern[at + 1 : nxt - 1].removeprefix("?:")
                pattern, nxt = f"{pattern[:at]}{inner}{pattern[nxt:]}", at  # as if it had no brackets
                begin = begin if at != begin else at
                continue
        elif c not in ".^$":
            letter = c
        more = pattern[nxt : nxt + 1]
        if more in ("?", "*", "{", "+"):
            if letter and more == "+":
                part(letter)
            letter, nxt = "", (pattern.index("}", nxt) if more == "{" else nxt) + 1
        part(letter)
        at = nxt
    first, best = runs[0], max(runs, key=lambda r: len(r[1]))
    return (first[1].upper(), True) if first[0] == 0 and len(first[1]) > 1 else (best[1].upper(), False)


def _may_match(upper: Column, rule: Rule) -> Column | None:
    """Whether a text, given in upper case, has the letters without which a rule can't hold; null where there are none."""
    letters, start = needle(rule.pattern)
    if not letters:
        return None
    return upper.startswith(letters) if start and rule.pattern.startswith("^") else upper.contains(letters)


def _holds(text: Column, upper: Column, rule: Rule, pattern: str) -> Column:
    """The pattern, tried only where the letters that it needs are there."""
    may = _may_match(upper, rule)
    return text.rlike(pattern) if may is None else may & text.rlike(pattern)


def classify(identifier: Column, rules: Sequence[Rule] = ID_RULES, upper: Column | None = None) -> Column:
    """struct(db_source, species_hint, source_hint, assembly_hint) of the first rule that holds, else null.

    A rule's pattern is tried only on identifiers that have its plain letters, which are few. upper is the identifier in upper case, where a column has it.
    """
    big = F.upper(identifier) if upper is None else upper
    return first_of([(_holds(identifier, big, r, _flagged(r)), _outcome(r)) for r in rules])


def embedded(header: Column, rules: Sequence[Rule] = EMBEDDED_RULES, whole_words: bool = False, upper: Column | None = None) -> Column:
    """struct(transcript_id, and what classify gives) of the first accession found anywhere in a header, else null.

    whole_words asks that no letter or digit stands right before it; without, as `GANC_010`, parts of other names count. Patterns are tried where
    their plain letters are; upper as for classify.
    """

    def pattern(r: Rule) -> str:
        return f"(?i)(?<![A-Za-z0-9]){r.pattern}" if whole_words else f"(?i){r.pattern}"

    big = F.upper(header) if upper is None else upper
    names = ("db_source", "species_hint", "source_hint", "assembly_hint")
    found = [(_holds(header, big, r, pattern(r)), F.struct(F.regexp_extract(header, pattern(r), 1).alias("transcript_id"), *[F.lit(getattr(r, n)).alias(n) for n in names])) for r in rules]
    return first_of(found)


def gi_accessions(header: Column) -> Column:
    """All RefSeq accessions in GI style, each once."""
    return F.array_distinct(F.regexp_extract_all(header, F.lit(GI), 2))


def accessions(header: Column) -> Column:
    """All accessions of the known families, each once, by family and then place."""
    found = [F.regexp_extract_all(header, F.lit(p if "NON" in p else f"(?i){p}"), 1) for p in ACCESSIONS]
    return F.array_distinct(F.flatten(F.array(*found)))


def header_tokens(header: Column) -> Column:
    """Words between blanks and pipes that may be identifiers: of 4 characters or more, with a digit and no colon."""
    return F.filter(F.split(F.regexp_replace(header, r"^>+", ""), r"[|\s]+"), lambda t: (F.length(t) >= 4) & t.rlike("[0-9]") & ~t.contains(":"))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value worked out once."""
    return F.transform(F.array(value), body)[0]


def header_ids(header: Column) -> Column:
    """Every identifier a header may be known by, each once."""
    tokens = F.flatten(F.array(F.array(normalise_id(header)), gi_accessions(header), accessions(header), header_tokens(header)))
    both = let(tokens, lambda found: F.concat(found, F.transform(found, drop_numeric_version)))
    return F.filter(F.array_distinct(both), lambda t: t != "")


def drop_numeric_version(identifier: Column) -> Column:
    """Without a dot and digits at the end."""
    return F.regexp_replace(identifier, r"\.[0-9]+$", "")


def drop_last_part(identifier: Column) -> Column:
    """Without the last dot and what follows it."""
    return F.regexp_replace(identifier, r"\.[^.]*$", "")


def first_part(identifier: Column) -> Column:
    """Up to the first dot."""
    return F.split_part(identifier, F.lit("."), F.lit(1))


def canonical_blanks(text: Column) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def alphabetic_prefix(identifier: Column) -> Column:
    return F.regexp_extract(identifier, "^([A-Za-z_]+)", 1)


def ensembl_prefix(identifier: Column) -> Column:
    """The letters up to the T of an Ensembl transcript, upper-cased; empty for others."""
    return F.upper(F.regexp_extract(identifier, r"(?i)^(ENS[A-Z]*T)\d", 1))


def prefix_species(identifier: Column, prefixes: Mapping[str, str] = PLANT_PREFIXES) -> Column:
    """The species of the first prefix in the mapping's order that the identifier starts with, case and all; else null."""
    return first_of([(identifier.startswith(p), F.lit(s)) for p, s in prefixes.items()])


# ---- candidates: arrays of the names to look up, the likeliest first ----


def unique(*parts: Column) -> Column:
    """The arrays one after another, each value once, without nulls and empty ones."""
    return F.array_distinct(F.filter(F.flatten(F.array(*parts)), lambda c: c.isNotNull() & (c != "")))


def one(value: Column, condition: Column | None = None) -> Column:
    """An array of the value, or of null where the condition fails."""
    return F.array(value if condition is None else F.when(condition, value))


def peeled(identifier: Column, least: int = 1, sep: str = ".") -> Column:
    """The identifier without its last part, its last two, ... down to `least` parts."""
    parts = F.split(identifier, f"\\{sep}")
    n = F.size(parts)
    return F.when(n > least, F.transform(F.sequence(n - 1, F.lit(least), F.lit(-1)), lambda k: F.array_join(F.slice(parts, 1, k), sep))).otherwise(F.array().cast("array<string>"))


def candidates_generic(identifier: Column) -> Column:
    def of(seed: Column) -> Column:
        dotted = seed.rlike(r"\.\d+(\.\d+)?$")
        return F.concat(
            F.array(seed),
            one(F.regexp_replace(seed, "_cdna$", ""), seed.endswith("_cdna")),
            F.array(F.regexp_replace(seed, r"_\d+_cdna$", ""), F.regexp_replace(seed, r"_\d+$", "")),
            one(F.split_part(seed, F.lit("_"), F.lit(1)), seed.contains("_")),
            F.when(dotted, peeled(seed)).otherwise(F.array().cast("array<string>")),
        )

    seeds = F.array(identifier, F.substring_index(identifier, "|", -1), F.substring_index(identifier, ":", -1))
    return unique(F.flatten(F.transform(F.array_distinct(seeds), of)))


def candidates_wormbase(identifier: Column) -> Column:
    return unique(candidates_generic(identifier), F.array(F.regexp_replace(identifier, r"\.[a-z]?\d+$", ""), F.regexp_replace(identifier, r"\.[a-z]\.\d+$", "")))


def candidates_yeast(identifier: Column) -> Column:
    sgd = F.regexp_extract(identifier, r"(?i)^Source:SGD;Acc:(S\d+)$", 1)
    dashed = F.replace(identifier, F.lit("_"), F.lit("-"))
    return unique(
        F.array(identifier),
        one(sgd, sgd != ""),
        one(F.concat(F.lit("SGD:"), sgd), sgd != ""),
        F.array(F.regexp_replace(identifier, "_[AB]$", "")),
        one(dashed, identifier.contains("_")),
        one(F.regexp_replace(dashed, "-[AB]$", ""), identifier.contains("_")),
        F.array(F.regexp_replace(identifier, r"_\d+$", "")),
        one(F.regexp_replace(identifier, "(?i)_(cdna|mrna)$", ""), identifier.rlike("(?i)_(cdna|mrna)$")),
    )


def candidates_species(identifier: Column, species: Column) -> Column:
    """Candidates by species, of rice, maize, tomato, potato and soybean; the identifier alone for others."""
    none = F.array().cast("array<string>")
    dots = F.size(F.split(identifier, r"\.")) - 1
    gene = F.split_part(identifier, F.lit("."), F.lit(1))
    before = one(F.split_part(identifier, F.lit("_"), F.lit(1)), identifier.contains("_"))
    rice = F.concat(before, one(F.concat(F.lit("Os"), F.substring(identifier, 3, 1 << 20)), identifier.startswith("OS")), one(F.replace(identifier, F.lit("t0"), F.lit("g0")), identifier.rlike(r"^[^t]*(t(?!0?\d)[^t]*)*t0\d+$")))
    maize = F.concat(before, peeled(identifier))
    nightshade = F.when(dots >= 2, F.array(F.regexp_replace(identifier, r"\.[^.]*$", ""), gene)).when(dots == 1, F.array(gene)).otherwise(none)
    potato = F.concat(nightshade, one(F.replace(identifier, F.lit("DMT"), F.lit("DMG")), identifier.contains("DMT")))
    more = F.when(species == "oryza_sativa", rice).when(species == "zea_mays", maize).when(species == "solanum_lycopersicum", nightshade).when(species == "solanum_tuberosum", potato).when(species == "glycine_max", peeled(identifier, 2)).otherwise(none)
    return unique(F.array(identifier), more)


def candidates_plant(identifier: Column) -> Column:
    """Candidates against the plants' metadata table."""
    dots = F.size(F.split(identifier, r"\.")) - 1
    os = [F.regexp_extract(identifier, r"(?i)^OS(\d+)T(\d+)", k) for k in (1, 2)]
    is_os = identifier.startswith("OS") & (os[0] != "")
    soy = F.upper(F.replace(identifier, F.lit("."), F.lit("_")))
    is_soy = identifier.rlike(r"^(Glyma|GLYMA)\.")
    tomato = identifier.startswith("Solyc")
    return unique(
        candidates_generic(identifier),
        one(F.split_part(identifier, F.lit("_"), F.lit(1)), identifier.startswith("GRMZM") | (identifier.startswith("Os") & identifier.contains("_"))),
        one(F.regexp_replace(identifier, r"\.[^.]*$", ""), tomato & (dots >= 2)),
        one(F.split_part(identifier, F.lit("."), F.lit(1)), tomato & (dots >= 1)),
        one(F.concat(F.lit("Os"), F.substring(identifier, 3, 1 << 20)), identifier.startswith("OS")),
        one(F.concat(F.lit("LOC_Os"), os[0], F.lit("g"), os[1]), is_os),
        one(F.concat(F.lit("Os"), os[0], F.lit("t"), os[1], F.lit("-01")), is_os),
        one(F.concat(F.lit("Os"), os[0], F.lit("t"), os[1]), is_os),
        one(soy, is_soy),
        one(F.substring_index(soy, "_", 2), is_soy & (F.size(F.split(soy, "_")) >= 3)),
    )


def candidates_phytozome(identifier: Column) -> Column:
    return unique(candidates_generic(identifier), peeled(identifier), one(F.regexp_replace(identifier, "_cdna$", ""), identifier.endswith("_cdna")))


def candidates_gramene(identifier: Column) -> Column:
    """The identifier, its gene before `_T` or a number, and that without its versions."""
    has_t, numbered = identifier.contains("_T"), identifier.rlike(r"_[0-9]+$")
    gene = F.when(has_t, F.split_part(identifier, F.lit("_T"), F.lit(1))).when(numbered, F.regexp_replace(identifier, r"_[0-9]+$", "")).otherwise(identifier)
    dots = F.size(F.split(gene, r"\.")) - 1
    return unique(F.array(identifier, gene), one(F.regexp_replace(gene, r"\.[^.]*$", ""), dots >= 2), one(F.split_part(gene, F.lit("."), F.lit(1)), dots >= 1))
