"""The folder that driver and executors share, and tables written there."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder below the one that driver and executors share: spark.checkpoint.dir, or on one machine a temporary one where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='genoweave-')}"
    return f"{found}/files-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, written to the shared folder once and read from there: lost executors cost nothing, and every reader sees the same partitions."""
    place = scratch(df.sparkSession)
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def with_file_start(df: DataFrame, file: str, path: str | Sequence[str], name: str) -> DataFrame:
    """df, read of the files at path, with the column file, their `_metadata.file_path`, replaced by name: the bytes of all files before it, by their paths.

    The number orders rows as the path does and takes eight bytes of a row where they are sorted; files are listed for it, not read.
    """
    before = F.sum("length").over(Window.orderBy(file).rowsBetween(Window.unboundedPreceding, -1))
    listed = df.sparkSession.read.format("binaryFile").load(path).select(F.col("_metadata.file_path").alias(file), "length")
    return df.join(F.broadcast(listed.select(file, F.coalesce(before, F.lit(0)).alias(name))), file, "left").drop(file)
