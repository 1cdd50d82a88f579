"""Tables of results that runs add to."""

from pyspark.sql import functions as F

from genoweave.operators import rows
from genoweave.sources import results, sinks


def table(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_upsert_replaces_adds_and_leaves_other_buckets(spark):
    path = sinks.scratch(spark)
    first = spark.range(500).select(F.when(F.col("id") > 0, F.format_string("t%d", "id")).alias("k"), F.lit("old").alias("v"))
    assert results.read(spark, path, first.schema).count() == 0
    assert results.upsert(first, path, ["k"], 16) == list(range(16))
    before = results._current(spark, path)["buckets"]
    some = spark.createDataFrame([("t1", "new"), ("t9999", "new"), (None, "new"), ("t1", "newer")], "k string, v string")
    touched = results.upsert(some, path, ["k"])
    assert 1 <= len(touched) <= 3
    after = results._current(spark, path)["buckets"]
    assert {b for b in after if after[b] != before[b]} == set(map(str, touched))
    got = {r.k: r.v for r in results.read(spark, path).collect()}
    assert len(got) == 501 and got["t1"] == "new" and got[None] == "new" and got["t9999"] == "new" and got["t2"] == "old"
    results.upsert(some, path, ["k"])
    assert {r.k: r.v for r in results.read(spark, path).collect()} == got and results.read(spark, path).count() == 501
    assert results.upsert(some.limit(0), path, ["k"]) == [] and results.read(spark, path).count() == 501


def test_a_run_that_breaks_off_changes_nothing(spark):
    path = sinks.scratch(spark)
    results.upsert(spark.range(50).select("id", F.lit(1).alias("v")), path, ["id"], 4)
    bad = spark.range(50).select("id", F.raise_error(F.lit("broken")).cast("int").alias("v"))
    try:
        results.upsert(bad, path, ["id"])
    except Exception as e:
        assert "broken" in str(e)
    assert results.read(spark, path).where("v = 1").count() == 50


def test_rerun_of_the_unresolved_equals_a_full_run(spark):
    ids = spark.range(300).select(F.format_string("t%d", "id").alias("transcript_id"), "id")

    def resolver(most):
        return lambda df: rows.route(df.withColumn("gene", F.when(F.col("id") < most, F.col("id") * 2)), [(F.col("gene").isNull(), "not_found")])

    path, asked = sinks.scratch(spark), []
    results.rerun(ids, path, resolver(200), buckets=8)

    def counting(df):
        asked.append(df.count())
        return resolver(250)(df)

    results.rerun(ids, path, counting)
    results.rerun(ids, path, counting)
    assert asked == [100, 50]
    assert table(results.read(spark, path).select("transcript_id", "gene", "status", "reason")) == table(resolver(250)(ids).select("transcript_id", "gene", "status", "reason"))
