import datetime as dt

import pytest
from pyspark.sql import functions as F

from salescast.operators.profile import content_hash
from salescast.plans.stages import generate_predictions, series_hashes, train_and_save_model
from salescast.sources import models_by_version

START = dt.date(2024, 1, 1)


def features(spark, path, changed=(), series=("a", "b", "c", None)):
    rows = [
        (s, START + dt.timedelta(days=i), 50.0 + i % 7 + (5.0 if s in changed and i == 30 else 0.0) + len(s or ""))
        for s in series
        for i in range(60)
    ]
    table = spark.createDataFrame(rows, "series_id string, ds date, y double").withColumn("note", F.rand())
    table.repartition(5).write.mode("overwrite").parquet(path)
    return path


def train(spark, path, models, day, reuse, cfg=None):
    return train_and_save_model(spark, path, models, cfg, dt.date(2025, 1, day), reuse=reuse).first()


def fitted_in(spark, models, version):
    return {r["series_id"]: r["fitted_version"] for r in models_by_version(spark, models, version).collect()}


def forecast(spark, models, out, version):
    generate_predictions(spark, models, out, version=version, horizon_days=10)
    rows = spark.read.parquet(out).drop("model_version")
    return sorted(map(str, rows.collect()))


@pytest.fixture()
def models(tmp_path):
    return str(tmp_path / "models")


def test_only_the_changed_series_is_fitted(spark, tmp_path, models):
    first = train(spark, features(spark, str(tmp_path / "f1")), models, 1, reuse=True)
    assert first["series"] == 4 and first["reused_series"] == 0
    path = features(spark, str(tmp_path / "f2"), changed=("b",))
    second = train(spark, path, models, 2, reuse=True)
    assert second["series"] == 4 and second["reused_series"] == 3 and second["failed_series"] == 0
    old, new = first["version"], second["version"]
    assert fitted_in(spark, models, new) == {"a": old, "b": new, "c": old, None: old}

    full = train(spark, path, str(tmp_path / "full"), 2, reuse=False)
    assert full["version"] == new and full["reused_series"] == 0
    assert full["training_records"] == second["training_records"]
    assert forecast(spark, models, str(tmp_path / "p1"), new) == forecast(spark, str(tmp_path / "full"), str(tmp_path / "p2"), new)
    # the carried rows are the newest of their series
    row = generate_predictions(spark, models, str(tmp_path / "p3")).first()
    assert row["model_versions"] == [new]


def test_the_same_content_again_fits_nothing_and_keeps_its_rows(spark, tmp_path, models):
    path = features(spark, str(tmp_path / "f"))
    first = train(spark, path, models, 1, reuse=True)
    again = train(spark, path, models, 1, reuse=True)
    assert again["version"] == first["version"] and again["series"] == 4
    later = train(spark, path, models, 2, reuse=True)
    assert later["reused_series"] == 4
    assert set(fitted_in(spark, models, later["version"]).values()) == {first["version"]}


def test_other_settings_fit_all_and_series_come_and_go(spark, tmp_path, models):
    path = features(spark, str(tmp_path / "f1"))
    train(spark, path, models, 1, reuse=True)
    cfg = {"model": {"prophet": {"interval_width": 0.8}}}
    assert train(spark, path, models, 2, reuse=True, cfg=cfg)["reused_series"] == 0
    moved = features(spark, str(tmp_path / "f2"), series=("c", "d"))
    row = train(spark, moved, models, 3, reuse=True, cfg=cfg)
    assert row["series"] == 2 and row["reused_series"] == 1
    assert set(fitted_in(spark, models, row["version"])) == {"c", "d"}


def test_failed_series_are_tried_again(spark, tmp_path, models):
    rows = [("short", START, 1.0)] + [("long", START + dt.timedelta(days=i), float(i % 5)) for i in range(40)]
    path = str(tmp_path / "f")
    spark.createDataFrame(rows, "series_id string, ds date, y double").write.parquet(path)
    first = train(spark, path, models, 1, reuse=True)
    second = train(spark, path, models, 2, reuse=True)
    assert first["failed_series"] == second["failed_series"] == 1 and second["reused_series"] == 1


def test_a_fingerprint_of_each_series(spark, tmp_path):
    one = spark.read.parquet(features(spark, str(tmp_path / "f1")))
    two = spark.read.parquet(features(spark, str(tmp_path / "f2"), changed=("b",)))
    before = {r["series_id"]: r["series_hash"] for r in series_hashes(one).collect()}
    after = {r["series_id"]: r["series_hash"] for r in series_hashes(two.repartition(17)).collect()}
    assert [s for s in before if before[s] != after[s]] == ["b"]
    assert all(len(h) == 32 for h in before.values()) and len(before) == 4
    whole = series_hashes(one.where("series_id = 'a'").drop("series_id")).collect()
    assert [r["series_id"] for r in whole] == ["__all__"]
    assert content_hash(one.select("y")).columns == ["data_hash"]
