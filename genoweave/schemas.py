"""The tables that stages exchange."""

from __future__ import annotations

from pyspark.sql import types as T


def table(text: str) -> T.StructType:
    """A schema from `name` or `name:type` words; the type is string unless given."""
    kinds = {"long": T.LongType(), "boolean": T.BooleanType(), "int": T.IntegerType(), "double": T.DoubleType()}
    fields = [w.partition(":") for w in text.split()]
    return T.StructType([T.StructField(n, kinds[k] if k else T.StringType()) for n, _, k in fields])


CLASSIFIED = table("transcript_id db_source species_hint source_hint assembly_hint raw_header source_file")
UNKNOWN = table("transcript_id raw_header source_file reason")
RESOLVED_V1 = table("transcript_id db_source gene_id gene_symbol organism assembly_accession chrom start:long end:long strand is_ambiguous:boolean")
RESOLVED = table("transcript_id db_source gene_id gene_symbol organism assembly_name assembly_accession fasta_url gtf_url gtf_format chrom start:long end:long strand is_ambiguous:boolean")
AMBIGUOUS = table("transcript_id db_source chosen_gene_id alternative_gene_id alternative_gene_symbol organism assembly_accession chrom start:long end:long strand")
REJECTED = table("transcript_id db_source reason")
ASSEMBLY_URLS = table("db_source assembly_name assembly_accession fasta_url gtf_url gtf_format organism")
MANIFEST = table("cache_key fasta_url")
GENBANK = table("accession organism description sequence gene_id gene_symbol note")
GENE_METADATA = table("transcript_id gene_id gene_symbol assembly_accession chrom start:long end:long strand")
EXTRACTION_FAILED = table("transcript_id assembly_accession chrom db_source fail_reason")
SPECIES_MAP = table("transcript_id prefix species build")
