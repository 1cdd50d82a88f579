"""Sequences and coordinates as Column expressions. Coordinates are 0-based and half-open unless a name says otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: IUPAC letters and their complements. U pairs like T; S, W and N with themselves.
LETTERS, COMPLEMENTS = "ACGTURYKMBVDHacgturykmbvdh", "TGCAAYRMKVBHDtgcaayrmkvbhd"


def digest(seq: Column) -> Column:
    """MD5 of the upper-cased sequence."""
    return F.md5(F.upper(seq).cast("binary"))


def digest_rna(seq: Column) -> Column:
    """MD5 with U read as T."""
    return F.md5(F.replace(F.upper(seq), F.lit("U"), F.lit("T")).cast("binary"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, LETTERS, COMPLEMENTS))


def slice_of(seq: Column, start: Column, end: Column) -> Column:
    """seq[start, end) in upper case; null if nothing is there."""
    return F.nullif(F.upper(F.substring(seq, (start + 1).cast("int"), (end - start).cast("int"))), F.lit(""))


def stranded(seq: Column, strand: Column) -> Column:
    """The reverse complement on `-`, else as it is."""
    return F.when(strand == "-", reverse_complement(seq)).otherwise(seq)


def ordered(start: Column, end: Column) -> tuple[Column, Column]:
    """(smaller, larger)."""
    return F.least(start, end), F.greatest(start, end)


def flanked(start: Column, end: Column, strand: Column, length: Column, up: int, down: int) -> tuple[Column, Column]:
    """The interval widened by `up` before and `down` after the gene in its own direction, kept in [0, length).

    Only `+` counts as forward: `.` is widened like `-`.
    """
    forward = strand == "+"
    low = F.greatest(F.lit(0).cast("bigint"), start - F.when(forward, up).otherwise(down))
    high = F.least(length, end + F.when(forward, down).otherwise(up))
    return low, high


def to_zero_based(start: Column, base: Column) -> Column:
    """A start counted from `base` (0 or 1) counted from 0."""
    return start - base


def exon_concat(exons: Column, strand: Column) -> Column:
    """The sequences of array<struct<start, seq>> in order of start, joined, and turned on `-`."""
    joined = F.array_join(F.transform(F.array_sort(exons), lambda e: e.seq), "")
    return stranded(joined, strand)
