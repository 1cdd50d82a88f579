"""Resolve sequence identifiers to coordinates, slice genomes and report on it, as Spark DataFrame operators."""
