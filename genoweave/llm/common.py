"""What the operators of this package share: places for intermediate tables and small column helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in an Arrow batch. A batch of texts has to fit a Python worker, very long texts included.
BATCH_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1000, "spark.sql.execution.arrow.maxBytesPerBatch": 8 << 20}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or on one machine (tests) a new one where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='genoweave-')}"
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder, so that lost executors cost nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """df, written as Parquet in the shared folder: as cut, but what reads it later reads only the columns it needs."""
    place = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.parquet(place)


def ship(spark: SparkSession) -> None:
    """Gives Python workers this package, where they wouldn't find it by their path or working folder."""
    package = Path(__file__).parent.parent
    root, sc = package.parent, spark.sparkContext
    found = {os.path.realpath(p) for p in [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)] if p}
    if str(root.resolve()) in found or getattr(sc, "_genoweave_shipped", False):
        return
    archive = f"{tempfile.mkdtemp()}/genoweave.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in package.rglob("*.py"):
            z.write(f, f.relative_to(root))
    sc.addPyFile(archive)
    sc._genoweave_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of sf_dir. From now on the session's Arrow batches keep to BATCH_LIMITS, where it doesn't set lower ones: a
    query runs after this has returned, so the settings stay."""
    ship(spark)
    for limit, most in BATCH_LIMITS.items():
        now = spark.conf.get(limit).lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(limit, str(most))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(text: str | Column) -> Column:
    """The bytes of a text; none for null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def without(df: DataFrame, *names: str) -> DataFrame:
    """df without the columns that an operator is about to add, in any case of letters."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])
