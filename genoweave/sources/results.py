"""Tables of results that later runs add to: rows by key, in buckets, of which a run rewrites only those that it has rows for.

A table is a folder with a folder for each version of a bucket, and a list for each run that says which version of every bucket counts. The
list is written last, so a run that is broken off changes nothing, and one that is repeated gives the same table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.rows import keep_first
from ..shared import written
from .sinks import small_text

BUCKET = "g_bucket"


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _current(spark: SparkSession, path: str) -> dict:
    """The last run's list: its number, the buckets' number, the columns, and of every bucket the folder that counts."""
    system, place = _folder(spark, f"{path}/lists")
    if not system.exists(place):
        return {"run": 0}
    last = max((f.getPath() for f in system.listStatus(place) if f.getPath().getName().endswith(".json")), key=lambda p: p.getName(), default=None)
    return {"run": 0} if last is None else json.loads(spark.read.text(last.toString(), wholetext=True).first()[0])


def read(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The table as the last whole run left it; without any run, no rows of the schema."""
    now = _current(spark, path)
    if not now.get("buckets"):
        return spark.createDataFrame([], T.StructType.fromJson(now["schema"]) if "schema" in now else schema or T.StructType())
    return spark.read.schema(T.StructType.fromJson(now["schema"])).parquet(*now["buckets"].values())


def upsert(df: DataFrame, path: str, keys: Sequence[str], buckets: int = 64) -> list[int]:
    """Puts df's rows, one for each key, in the place of those with the same keys, and adds the others; the buckets that were rewritten.

    A key's hash tells its bucket; null is a key like others. Buckets that df has no rows for keep their files. The first run sets the number of
    buckets, which bounds the list that goes through the driver, and the columns; later ones are fitted to those. Of rows of df with equal keys
    the smallest counts. Two runs at once aren't provided for: the one that ends last would hide the other's.
    """
    spark, now = df.sparkSession, _current(df.sparkSession, path)
    n = now.get("n_buckets", buckets)
    schema = T.StructType.fromJson(now["schema"]) if "schema" in now else df.schema
    fitted = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])
    bucket = F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")
    new = written(keep_first(fitted, keys, [c for c in fitted.columns if c not in keys] or list(keys)).withColumn(BUCKET, bucket))
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # n at most
    old = [now["buckets"][str(b)] for b in touched if str(b) in now.get("buckets", {})]
    whole = new
    if old:
        before = spark.read.schema(schema).parquet(*old).withColumn(BUCKET, bucket)
        named = new.select(*[F.col(k).alias(f"g_{k}") for k in keys])
        same = [before[k].eqNullSafe(named[f"g_{k}"]) for k in keys]
        kept = before.join(named, same, "left_anti")
        whole = new.unionByName(kept)
    version = f"{path}/run-{now['run'] + 1:06d}-{uuid.uuid4().hex}"
    if touched:
        whole.repartition(BUCKET).write.partitionBy(BUCKET).parquet(version)
    places = now.get("buckets", {}) | {str(b): f"{version}/{BUCKET}={b}" for b in touched}
    small_text(json.dumps({"run": now["run"] + 1, "n_buckets": n, "schema": schema.jsonValue(), "buckets": places}), f"{path}/lists/{now['run'] + 1:06d}.json")
    return touched


def rerun(wanted: DataFrame, path: str, resolver: Callable[[DataFrame], DataFrame], key: str = "transcript_id", buckets: int = 64) -> list[int]:
    """Runs a resolver on the rows of wanted that the table at path has no resolved row for, and puts its rows, resolved or not, there.

    resolver's rows have key and status. The first run takes all rows, a later one those that are still unresolved or new.
    """
    done = read(wanted.sparkSession, path)
    left = wanted
    if key in done.columns:
        left = wanted.join(done.where("status = 'resolved'").select(key), key, "left_anti")
    return upsert(resolver(left), path, [key], buckets)
