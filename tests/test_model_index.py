import datetime as dt

from pyspark.sql import functions as F

from salescast.sources import latest_models, models_by_version, write_models
from salescast.sources.models import INDEX

MODEL = "version string, series_id string, created_at timestamp, status string, payload int"


def rows(spark, *entries):
    return spark.createDataFrame([(v, s, dt.datetime(2024, 1, day), status, p) for v, s, day, status, p in entries], MODEL)


def many(spark, versions, series=4):
    """``versions`` versions of every series; the last one of series 0 is version 3."""
    table = spark.range(versions * series).select(
        (F.col("id") / series).cast("int").alias("k"), (F.col("id") % series).cast("string").alias("series_id")
    )
    return table.where("series_id != '0' OR k <= 3").select(
        F.format_string("model_v%03d", "k").alias("version"),
        "series_id",
        F.expr("timestamp'2024-01-01' + make_interval(0, 0, 0, k)").alias("created_at"),
        F.lit("ok").alias("status"),
        F.col("k").alias("payload"),
    )


def scans(df):
    """Files read and partition filters of every scan of an executed plan."""
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if "Scan parquet" in leaf.nodeName():
            found.append((leaf.metrics().apply("numFiles").value(), leaf.simpleString(1000)))
    return found


def test_only_the_versions_in_use_are_read(spark, tmp_path):
    path = str(tmp_path / "models")
    write_models(many(spark, 50).repartition(1), path)
    newest = {r["series_id"]: r["payload"] for r in latest_models(spark, path).collect()}
    assert newest == {"0": 3, "1": 49, "2": 49, "3": 49}

    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        chosen = latest_models(spark, path)
        chosen.collect()
        wide = [(files, text) for files, text in scans(chosen) if "payload" in text]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [files for files, _ in wide] == [2]
    assert "model_v003" in wide[0][1] and "model_v010" not in wide[0][1]


def test_the_index_follows_every_write(spark, tmp_path):
    path = str(tmp_path / "models")
    write_models(rows(spark, ("v1", "a", 1, "ok", 1), ("v1", None, 1, "ok", 2)), path)
    write_models(rows(spark, ("v2", "a", 2, "error", 3), ("v2", "b", 2, "error", 4)), path, ["v2"])
    found = {r["series_id"]: r["payload"] for r in latest_models(spark, path).collect()}
    assert found == {"a": 1, None: 2, "b": 4}
    # the same version again, fitted this time
    write_models(rows(spark, ("v2", "a", 3, "ok", 5)), path, ["v2"])
    assert {r["series_id"]: r["payload"] for r in latest_models(spark, path).collect()} == {"a": 5, None: 2}
    assert models_by_version(spark, path, "v2").count() == 1
    # the index is no part of the table
    assert spark.read.parquet(path).count() == 3 and spark.read.parquet(f"{path}/{INDEX}").count() == 3


def test_versions_without_an_index_are_found(spark, tmp_path):
    path = str(tmp_path / "models")
    rows(spark, ("v1", "a", 1, "ok", 1)).write.partitionBy("version").parquet(path)
    assert latest_models(spark, path).first()["payload"] == 1
    write_models(rows(spark, ("v2", "a", 2, "ok", 2)), path, ["v2"])
    rows(spark, ("v3", "b", 1, "ok", 3)).write.mode("append").partitionBy("version").parquet(path)
    assert {r["series_id"]: r["payload"] for r in latest_models(spark, path).collect()} == {"a": 2, "b": 3}
