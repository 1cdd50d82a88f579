"""Cells, names, addresses and logs as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import first_of
from .rules import LOG_FAILURES, NULL_TOKENS


def clean_null(value: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """null where the trimmed, lower-cased value is one of the tokens."""
    return F.when(~F.lower(F.trim(value)).isin(*tokens), value)


def non_empty(value: Column) -> Column:
    """The trimmed value, null if nothing is left."""
    return F.nullif(F.trim(value), F.lit(""))


def key(value: Column) -> Column:
    """The value as a key to join on: trimmed and in lower case."""
    return F.lower(F.trim(value))


def strand(value: Column) -> Column:
    """`+`, `-` or `.`, from those or 1 and -1."""
    bare = F.trim(value)
    return F.when(bare.isin("+", "1", "+1"), "+").when(bare.isin("-", "-1"), "-").otherwise(".")


def strand_of_number(value: Column) -> Column:
    """`+` for 1, else `-`, as marts write it."""
    return F.when(value.try_cast("bigint") == 1, "+").otherwise("-")


def whole(value: Column, default: int | None = None) -> Column:
    """The value as a long; what isn't one is null, or the default."""
    number = value.try_cast("bigint")
    return number if default is None else F.coalesce(number, F.lit(default).cast("bigint"))


def map_values(value: Column, mapping: Mapping[str, str], keep: bool = True, blanks: bool = False) -> Column:
    """mapping's value for the upper-cased value without outer blanks (inner ones too with `blanks`); others stay, or are null."""
    name = F.upper(F.trim(F.regexp_replace(value, r"\s+", "") if blanks else value))
    found = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])[name]
    return F.coalesce(found, value) if keep else found


def organism(value: Column) -> Column:
    """The first two words, with underscores read as blanks, in lower case."""
    return F.lower(F.substring_index(F.trim(F.regexp_replace(value, r"[_\s]+", " ")), " ", 2))


def first_filled(*values: Column, default: Column | None = None) -> Column:
    """The first value that isn't empty once trimmed."""
    filled = [non_empty(v) for v in values]
    return F.coalesce(*filled, default) if default is not None else F.coalesce(*filled)


def url_file(url: Column) -> Column:
    """The last part of an address's path, without query and fragment."""
    path = F.regexp_extract(F.trim(url), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)
    return F.substring_index(path, "/", -1)


def cache_key(url: Column) -> Column:
    """A file name for a genome by its address: `url_`, its file's stem and ten digits of the address's SHA-1. Null for none."""
    address = non_empty(url)
    name = F.coalesce(F.nullif(url_file(address), F.lit("")), F.lit("assembly"))
    stem = F.regexp_replace(F.regexp_replace(name, r"(?i)(\.(gz|bgz|bz2|xz|zip))+$", ""), r"(?i)\.(fa|fna|fasta|fas)$", "")
    slug = F.regexp_replace(F.regexp_replace(stem, "[^A-Za-z0-9._-]+", "_"), "^[._-]+|[._-]+$", "")
    slug = F.substring(F.coalesce(F.nullif(slug, F.lit("")), F.lit("assembly")), 1, 80)
    return F.when(address.isNotNull(), F.concat(F.lit("url_"), slug, F.lit("_"), F.substring(F.sha1(address), 1, 10)))


def ftp_dir(accession: Column, base: str = "https://ftp.ncbi.nlm.nih.gov/genomes/all") -> Column:
    """The folder of an assembly's versions: GCF_000001735.4 is in GCF/000/001/735."""
    bare = F.split_part(accession, F.lit("."), F.lit(1))
    return F.concat(F.concat_ws("/", F.lit(base), F.substring(bare, 1, 3), *[F.substring(bare, k, 3) for k in (5, 8, 11)]), F.lit("/"))


def ensembl_urls(species: Column, assembly: Column, release: Column) -> Column:
    """struct(fasta_url, gtf_url) of a vertebrate's Ensembl release; null if a part is missing. Blanks in the species are underscores."""
    name = F.lower(F.regexp_replace(F.trim(species), r"\s+", "_"))
    title = F.array_join(F.transform(F.split(name, "_"), F.initcap), "_")
    base = F.concat(F.lit("https://ftp.ensembl.org/pub/release-"), release)
    fasta = F.concat(base, F.lit("/fasta/"), name, F.lit("/dna/"), title, F.lit("."), assembly, F.lit(".dna.toplevel.fa.gz"))
    gtf = F.concat(base, F.lit("/gtf/"), name, F.lit("/"), title, F.lit("."), assembly, F.lit("."), release, F.lit(".gtf.gz"))
    whole_set = non_empty(species).isNotNull() & non_empty(assembly).isNotNull() & non_empty(release).isNotNull()
    return F.when(whole_set, F.struct(fasta.alias("fasta_url"), gtf.alias("gtf_url")))


def log_failure(text: Column) -> Column:
    """What a log says went wrong: the most telling pattern, else its last error line's message, else `unknown error`."""

    def told(pattern: str, template: str | None) -> Column:
        if template is None:
            return F.trim(F.regexp_extract(text, f"({pattern})", 1))
        out = F.lit(template)
        for k in (1, 2):
            if f"{{{k}}}" in template:
                out = F.replace(out, F.lit(f"{{{k}}}"), F.regexp_extract(text, pattern, k))
        return out

    errors = F.filter(F.split(text, r"\r?\n"), lambda line: line.contains("| ERROR    |"))
    last = F.element_at(errors, -1)
    message = F.when(F.size(F.split(last, r" \| ", 4)) == 4, F.trim(F.element_at(F.split(last, r" \| ", 4), 4))).otherwise(F.trim(last))
    return F.coalesce(first_of([(text.rlike(p), told(p, t)) for p, t in LOG_FAILURES]), F.when(F.size(errors) > 0, message), F.lit("unknown error"))


def toggle_chr(chrom: Column) -> Column:
    """With `chr` in front, or without where it is."""
    return F.when(chrom.startswith("chr"), F.substring(chrom, 4, 1 << 20)).otherwise(F.concat(F.lit("chr"), chrom))


def region(chrom: Column, start: Column, end: Column, strand_in: Column, text: Column) -> Column:
    """struct(chrom, start, end, strand): the fields where given, else those of `chr:start-end[:strand]`."""
    parts = F.split(text, ":")
    span = F.split(F.get(parts, F.lit(1)), "-")
    usable = (F.size(parts) >= 2) & (F.size(span) == 2)
    low, high = [F.when(usable, F.get(span, F.lit(k)).try_cast("bigint")) for k in (0, 1)]
    both = low.isNotNull() & high.isNotNull() & (start.isNull() | end.isNull())
    sign = F.coalesce(F.when(F.trim(strand_in).isin("+", "1", "+1"), "+").when(F.trim(strand_in).isin("-", "-1"), "-"), F.when(F.get(parts, F.lit(2)).isin("+", "1"), "+").when(F.get(parts, F.lit(2)).isin("-", "-1"), "-"), F.lit(""))
    name = F.coalesce(non_empty(chrom), F.when(F.size(parts) >= 2, parts[0]), F.lit(""))
    return F.struct(name.alias("chrom"), F.when(both, low).otherwise(start).alias("start"), F.when(both, high).otherwise(end).alias("end"), sign.alias("strand"))


def species_of_reason(inferred: Column, reason: Column) -> Column:
    return F.coalesce(inferred, F.when(reason.startswith("biomart_no_match_"), F.regexp_replace(reason, "biomart_no_match_", "")), F.lit(""))


def version_stem(file_name: Column) -> Column:
    """What an annotation's name shares with its assembly's."""
    return F.regexp_replace(F.trim(file_name), r"(?i)(\.gene_exons|\.gene)?\.gff3\.gz$", "")


def safe_name(text: Column) -> Column:
    """A file name: other characters than letters, digits, dots, dashes and underscores are underscores."""
    return F.regexp_replace(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_"), "^[._]+|[._]+$", "")


def percent(part: Column, total: Column) -> Column:
    """`12%`, rounded half to even, or a dash for a total of zero."""
    return F.when(total > 0, F.concat(F.bround(100.0 * part / total, 0).cast("bigint").cast("string"), F.lit("%"))).otherwise("—")


def xml_date(year: Column, month: Column, day: Column) -> Column:
    return F.when(year.isNotNull(), F.concat_ws("/", year.cast("string"), *[F.lpad(F.coalesce(x.cast("string"), F.lit("1")), 2, "0") for x in (month, day)]))
