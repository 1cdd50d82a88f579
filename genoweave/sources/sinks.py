"""Writers of tables, sequences and reports."""

from __future__ import annotations

import html
import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import batches
from ..shared import scratch as scratch


#: The columns of a table of rows whose sequence couldn't be cut out, and why.
FAILED = ("transcript_id", "assembly_accession", "chrom", "db_source", "fail_reason")


def failures(parts: Sequence[DataFrame], path: str, columns: Sequence[str] = FAILED, mode: str = "overwrite") -> None:
    """The unresolved rows of all parts (see operators.rows.route) as one table, each of its files under the header; without any, or without parts, the header alone.

    A missing column is null, and fail_reason is the parts' reason.
    """
    frames = [p.where("status = 'unresolved'").withColumnRenamed("reason", "fail_reason") for p in parts]
    frames = [f.select(*[F.col(c).cast("string") if c in f.columns else F.lit(None).cast("string").alias(c) for c in columns]) for f in frames]
    frames = frames or [SparkSession.active().createDataFrame([], ", ".join(f"{c} string" for c in columns))]
    tsv(reduce(DataFrame.unionByName, frames), path, mode=mode)


def tsv(df: DataFrame, path: str, compression: str | None = None, mode: str = "overwrite") -> None:
    """Tab-separated files with a header. An empty table gives one file with the header alone, and takes nothing from files that mode keeps."""
    counted = Observation()
    df = df.observe(counted, F.count(F.lit(1)).alias("n"))
    options = {"sep": "\t", "header": True} | ({"compression": compression} if compression else {})
    df.write.mode(mode).options(**options).csv(path)
    if not counted.get.get("n"):  # Spark writes no file, and so no header, for a plan that it knows to be empty
        again = mode if mode in ("append", "ignore") else "overwrite"
        df.sparkSession.createDataFrame([], df.schema).repartition(1).write.mode(again).options(**options).csv(path)


def text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A column of text, a row a line or record: FASTA, lists of targets."""
    df.write.mode(mode).text(path)


def fasta_by(df: DataFrame, path: str, column: str, mode: str = "overwrite") -> None:
    """FASTA records (column, value) in a folder for each of the column's values, in as many files as its rows call for: a value that has most
    rows isn't one task's."""
    df.select(column, "value").hint("rebalance", column).write.mode(mode).partitionBy(column).text(path)


def in_batches(df: DataFrame, path: str, order: Sequence[str], size: int, mode: str = "overwrite") -> DataFrame:
    """Parquet in a folder for each batch of `size` rows in order; the counts of the batches are returned."""
    numbered = batches(df, order, size)
    numbered.write.mode(mode).partitionBy("batch").parquet(path)
    return df.sparkSession.read.parquet(path).groupBy("batch").agg(F.count("*").alias("n"))


def small_bytes(data: bytes, path: str) -> None:
    """Bytes of the driver's as one file, on whatever file system the path names."""
    spark = SparkSession.active()
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def small_text(text: str, path: str) -> None:
    """A text of the driver's as one file."""
    small_bytes(text.encode(), path)


def status(path: str, **values: object) -> None:
    """key=value lines, written by the driver."""
    small_text("".join(f"{k}={v}\n" for k, v in values.items()), path)


def manifest(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def failed_targets(df: DataFrame, prefix: str, key: str = "assembly_accession", reason: str = "reason") -> DataFrame:
    """(value): the keys of rows whose reason starts with prefix, each once."""
    return df.where(F.col(reason).startswith(prefix) & F.col(key).isNotNull()).select(F.trim(key).alias("value")).where("value <> ''").distinct()


def html_table(df: DataFrame, most: int = 25, more: str = "") -> str:
    """A table of the first rows as HTML, and a note on how many there are where that isn't all. For reports: most is their limit."""
    rows = df.limit(most + 1).collect()
    head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
    body = "".join("<tr>" + "".join(f"<td>{html.escape('' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in rows[:most])
    note = f"<p>{most} of {df.count()} rows. {html.escape(more)}</p>" if len(rows) > most else ""
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>{note}"


def html_report(title: str, sections: Sequence[tuple[str, DataFrame]], path: str) -> None:
    """A page of tables, each at most 25 rows."""
    parts = [f"<h2>{html.escape(name)}</h2>{html_table(df)}" for name, df in sections]
    small_text(f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title><h1>{html.escape(title)}</h1>{''.join(parts)}", path)


def report_json(df: DataFrame) -> str:
    """A small table as JSON, for reports."""
    return json.dumps([r.asDict() for r in df.limit(1000).collect()], default=str)
