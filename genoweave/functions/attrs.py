"""Attribute cells of annotation files as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .ids import let
from .text import first_filled


def _last_wins(pairs: Column) -> Column:
    """A map from an array of struct(k, v) in which a later pair overrides an earlier one. The pairs are worked out once."""

    def of(found: Column) -> Column:
        keys = F.array_distinct(found.k)
        last = F.transform(keys, lambda k: F.struct(k.alias("k"), F.element_at(F.filter(found, lambda p: p.k == k), -1).v.alias("v")))
        return F.map_from_entries(F.when(F.size(keys) == F.size(found), found).otherwise(last))

    return let(pairs, of)


def attr_map(cell: Column) -> Column:
    """The attributes of a GFF3 cell (`k=v;`) or a GTF one (`k "v";`), map<string,string>; of repeated keys the last wins."""
    gff = F.transform(
        F.filter(F.split(cell, ";"), lambda p: p.contains("=")),
        lambda p: F.struct(F.trim(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), F.trim(F.regexp_replace(p, "^[^=]*=", "")).alias("v")),
    )
    names, values = [F.regexp_extract_all(cell, F.lit(r'(\w+)\s+"([^"]*)"'), k) for k in (1, 2)]
    gtf = F.zip_with(names, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    return F.when(cell.contains("=") & ~cell.contains('"'), _last_wins(gff)).otherwise(_last_wins(gtf))


def first_attr(attrs: Column, fields: Sequence[str], default: Column | None = None) -> Column:
    """The first of the fields that isn't empty."""
    values = [attrs[f] for f in fields]
    return first_filled(*values, default=default) if values else (default if default is not None else F.lit(None).cast("string"))


def alias_values(attrs: Column, fields: Sequence[str]) -> Column:
    """All values of the fields, taken apart at commas."""
    if not fields:
        return F.array().cast("array<string>")
    cells = F.array(*[F.coalesce(attrs[f], F.lit("")) for f in fields])
    return F.filter(F.flatten(F.transform(cells, lambda c: F.transform(F.split(c, ","), lambda v: F.trim(v)))), lambda v: v != "")


def value_forms(cell: Column) -> Column:
    """Every value of a cell, and what follows its first colon: `transcript:ABC` is also `ABC`."""

    def of(values: Column) -> Column:
        return F.array_distinct(F.concat(values, F.transform(F.filter(values, lambda v: v.contains(":")), lambda v: F.regexp_replace(v, "^[^:]*:", ""))))

    return let(F.map_values(attr_map(cell)), of)
