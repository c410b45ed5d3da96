import datetime as dt

import pytest

from salescast.plans.report import run_summary, text_report
from salescast.plans.run import run_all
from salescast.plans.stages import (
    engineer_features,
    extract_data,
    generate_predictions,
    train_and_save_model,
    validate_and_clean_data,
)

START = dt.date(2024, 1, 1)
RUN_DATE = dt.date(2025, 1, 1)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    """120 days of two products as CSV, with an outlier per product."""
    lines = ["date,product_id,sales_quantity,revenue"]
    for i in range(120):
        for k, product in enumerate(("001", "002")):
            quantity = 50 * (k + 1) + i % 7 + (900 if i == 60 else 0)
            lines.append(f"{START + dt.timedelta(days=i)},{product},{quantity},{quantity * 2.5}")
    path = tmp_path_factory.mktemp("raw") / "sales.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_whole_run(spark, raw, tmp_path):
    run = run_all(spark, raw, str(tmp_path), run_id="r1", run_date=RUN_DATE)
    summary = {(r["stage"], r["metric"]): r["value"] for r in run.summary.collect()}
    assert summary["extraction", "records_extracted"] == "240"
    assert summary["extraction", "products"] == "2"
    assert summary["validation", "checks_passed"] == "4"
    assert summary["validation", "rows_cleaned"] == "0"
    assert summary["feature_engineering", "features_added"] == "15"
    assert summary["feature_engineering", "records_processed"] == "120"
    assert summary["model_training", "training_records"] == "120"
    assert summary["model_training", "model_version"].startswith("model_v20250101_")
    assert summary["forecasting", "total_predictions"] == "150"
    lines = [line.split() for line in run.report.splitlines()]
    assert ["total_predictions", "150"] in lines and ["run", "r1"] in lines
    assert sorted(p.name for p in tmp_path.iterdir()) == ["cleaned", "features", "forecast", "models"]
    forecast = spark.read.parquet(run.forecast_path)
    assert forecast.columns[:4] == ["series_id", "model_version", "ds", "yhat"]
    assert forecast.where("ds > date'2024-04-29'").count() == 30
    cleaned = spark.read.parquet(run.cleaned_path)
    assert cleaned.where("sales_quantity > 900").count() == 0
    assert dict(cleaned.dtypes)["sales_quantity"] == "double"
    assert {r[0] for r in cleaned.select("product_id").distinct().collect()} == {"001", "002"}


def test_every_product_in_one_run(spark, raw, tmp_path):
    run = run_all(spark, raw, str(tmp_path), run_date=RUN_DATE, series_cols=["product_id"])
    counts = spark.read.parquet(run.forecast_path).groupBy("series_id").count().collect()
    assert {r["series_id"]: r["count"] for r in counts} == {"001": 150, "002": 150}


def test_extraction_metadata(spark, raw):
    sales, metadata = extract_data(spark, raw)
    row = metadata.first()
    assert sales.count() == 240 and row["num_products"] == 2
    assert (row["file_path"], row["num_days"]) == (raw, 120)
    assert len(row["data_hash"]) == 8


def test_cleaning_metadata(spark, raw, tmp_path):
    row = validate_and_clean_data(spark, raw, str(tmp_path / "clean")).first()
    assert row["checks_passed"] == row["checks_performed"] and len(row["checks_passed"]) == 4
    assert row["cleaning"]["original_rows"] == row["cleaning"]["final_rows"] == 240
    kinds = [(o["type"], o["columns"], o["count"]) for o in row["operations"]["log"]]
    assert kinds == [
        ("outlier_capping", "sales_quantity", 2), ("outlier_capping", "revenue", 2),
        ("sort", "date, product_id", None),
    ]


def test_failed_gate_writes_nothing(spark, raw, tmp_path):
    cfg = {"data_quality": {"min_records": 1000}}
    with pytest.raises(ValueError, match="Insufficient records: 240 < 1000"):
        validate_and_clean_data(spark, raw, str(tmp_path / "clean"), cfg)
    assert not (tmp_path / "clean").exists()


def test_one_product_without_aggregation(spark, raw, tmp_path):
    row = engineer_features(
        spark, raw, str(tmp_path / "f"), product_id="002", fmt="csv"
    ).first()
    assert (row["original_records"], row["engineered_records"]) == (240, 120)
    assert row["product_filter"] == "002"
    assert (row["start_date"], row["end_date"]) == ("2024-01-01", "2024-04-29")


def test_csv_outputs(spark, raw, tmp_path):
    features, models = str(tmp_path / "f.csv"), str(tmp_path / "m")
    row = engineer_features(spark, raw, features, fmt="csv", output_fmt="csv").first()
    assert row["engineered_records"] == 120
    train_and_save_model(spark, features, models, run_date=RUN_DATE)
    row = generate_predictions(spark, models, str(tmp_path / "p.csv"), output_fmt="csv").first()
    assert row["total_predictions"] == 150


def test_training_twice_a_day_replaces_and_versions_can_be_chosen(spark, raw, tmp_path):
    features, models = str(tmp_path / "f"), str(tmp_path / "m")
    engineer_features(spark, raw, features, fmt="csv")
    first = train_and_save_model(spark, features, models, run_date=RUN_DATE).first()
    again = train_and_save_model(spark, features, models, run_date=RUN_DATE).first()
    assert first["version"] == again["version"] and first["failed_series"] == 0
    assert spark.read.parquet(models).count() == 1
    later = train_and_save_model(
        spark, features, models, {"model": {"horizon_days": 7}}, dt.date(2025, 1, 2)
    ).first()
    out = str(tmp_path / "p")
    assert generate_predictions(spark, models, out).first()["model_version"] == later["version"]
    chosen = generate_predictions(spark, models, out, version=first["version"], horizon_days=5)
    row = chosen.first()
    assert (row["model_version"], row["horizon_days"]) == (first["version"], 5)
    assert (row["total_predictions"], row["end_date"]) == (125, "2024-05-04")
    assert row["forecast_statistics"]["forecast_days"] == 5
    assert (row["series"], row["unfitted_series"]) == (1, 0)
    configured = generate_predictions(spark, models, out, {"model": {"horizon_days": 7}}).first()
    assert configured["total_predictions"] == 127
    with pytest.raises(FileNotFoundError):
        generate_predictions(spark, models, out, version="model_v0")


def test_summary_of_missing_stages_is_null(spark):
    summary = run_summary(spark, {}, "r0")
    assert summary.where("value is not null").count() == 0
    text = text_report(summary, "2024-01-01", completed_at=dt.datetime(2024, 1, 1))
    assert "nothing reported" in text and "mean_forecast" not in text


def test_files_are_in_the_order_of_series_and_date(spark, raw, tmp_path):
    run = run_all(spark, raw, str(tmp_path), run_date=RUN_DATE, series_cols=["product_id"])
    for path, day in ((run.features_path, "date"), (run.forecast_path, "ds")):
        ends = []
        for file in sorted(p for p in (tmp_path / path.rsplit("/", 1)[1]).iterdir() if p.suffix == ".parquet"):
            keys = [tuple(r) for r in spark.read.parquet(str(file)).select("series_id", day).collect()]
            assert keys == sorted(keys)
            ends += [keys[0], keys[-1]] if keys else []
        assert ends == sorted(ends)


def test_only_the_date_column_is_needed_after_extraction(spark, tmp_path):
    rows = [(START + dt.timedelta(days=i), float(i % 9)) for i in range(120)]
    spark.createDataFrame(rows, "date date, sales_quantity double").write.parquet(str(tmp_path / "in"))
    row = validate_and_clean_data(spark, str(tmp_path / "in"), str(tmp_path / "out")).first()
    assert row["cleaning"]["final_rows"] == 120
    with pytest.raises(ValueError, match="lacks product_id, revenue"):
        extract_data(spark, str(tmp_path / "in"))


def test_extraction_reads_the_table_twice(spark, tmp_path):
    """Once for the profile, once for the fingerprint; no list of products."""
    rows = [(START, "p", i, 1.0) for i in range(50)]
    spark.createDataFrame(rows, "date date, product_id string, sales_quantity bigint, revenue double").write.parquet(str(tmp_path / "in"))
    sales, row = extract_data(spark, str(tmp_path / "in"))
    assert "products" not in row.columns and row.first()["num_products"] == 1
    assert isinstance(row.first()["data_hash"], str) and sales.count() == 50
