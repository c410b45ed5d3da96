import datetime as dt
import json

import pytest

from salescast.plans.metadata import load_metadata, save_metadata, stored_summary
from salescast.plans.report import STAGE_METRICS, text_report
from salescast.plans.run import run_all
from salescast.plans.stages import extract_data, generate_predictions

START = dt.date(2024, 1, 1)
SCHEMA = "date date, product_id string, sales_quantity bigint, revenue double"


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    rows = [(START + dt.timedelta(days=i), p, 40 + i % 7, 2.5 * i) for i in range(110) for p in ("a", "b")]
    path = str(tmp_path_factory.mktemp("raw") / "sales")
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    return path


def values(summary):
    return {(r["stage"], r["metric"]): r["value"] for r in summary.collect()}


def test_a_whole_run_is_summarised_from_storage(spark, raw, tmp_path):
    stored = str(tmp_path / "metadata")
    run = run_all(spark, raw, str(tmp_path / "out"), run_id="r1", run_date=dt.date(2025, 1, 1), metadata_path=stored)
    summary = stored_summary(spark, stored, "r1")
    assert summary.columns == run.summary.columns and summary.count() == sum(map(len, STAGE_METRICS.values()))
    assert values(summary) == values(run.summary) and None not in values(summary).values()
    assert "total_predictions" in text_report(summary, "2025-01-01")
    assert values(summary)["extraction", "records_extracted"] == "220"

    # one stage runs again on its own: its row changes, the others stay
    again = generate_predictions(spark, run.models_path, str(tmp_path / "week"), horizon_days=7)
    save_metadata(again, stored, "r1", "forecasting")
    after = values(stored_summary(spark, stored, "r1"))
    assert after["forecasting", "horizon_days"] == "7" and after["forecasting", "total_predictions"] == "117"
    assert {k: v for k, v in after.items() if k[0] != "forecasting"} == {
        k: v for k, v in values(run.summary).items() if k[0] != "forecasting"
    }
    assert load_metadata(spark, stored).count() == 5


def test_runs_are_kept_apart_and_missing_stages_are_null(spark, raw, tmp_path):
    stored = str(tmp_path / "metadata")
    with pytest.raises(FileNotFoundError):
        load_metadata(spark, stored)
    metadata = extract_data(spark, raw)[1]
    # a run named by a number stays text
    for run_id in ("007", "r/2 x"):
        save_metadata(metadata, stored, run_id, "extraction")
    save_metadata(metadata, stored, "007", "extraction")
    assert {r["run_id"] for r in load_metadata(spark, stored).collect()} == {"007", "r/2 x"}
    found = values(stored_summary(spark, stored, "007"))
    assert found["extraction", "products"] == "2" and found["forecasting", "horizon_days"] is None
    assert set(values(stored_summary(spark, stored, "none")).values()) == {None}
    details = json.loads(load_metadata(spark, stored, "r/2 x").first()["details"])
    assert details["num_records"] == 220 and details["data_hash"] == metadata.first()["data_hash"]


def test_wrong_names_are_refused(spark, raw, tmp_path):
    metadata = extract_data(spark, raw)[1]
    with pytest.raises(ValueError, match="unknown stage"):
        save_metadata(metadata, str(tmp_path / "m"), "r", "cleaning")
    with pytest.raises(ValueError, match="run_id"):
        save_metadata(metadata, str(tmp_path / "m"), "", "extraction")


def test_weeks_and_months_ahead(spark, raw, tmp_path):
    run = run_all(spark, raw, str(tmp_path / "out"), run_date=dt.date(2025, 1, 1))
    for freq, last in (("W", dt.date(2024, 5, 5)), ("M", dt.date(2024, 6, 30))):
        out = str(tmp_path / freq)
        row = generate_predictions(spark, run.models_path, out, horizon_days=3, freq=freq).first()
        assert row["total_predictions"] == 113 and row["freq"] == freq
        assert spark.read.parquet(out).agg({"ds": "max"}).first()[0] == last
    with pytest.raises(ValueError, match="unknown freq"):
        generate_predictions(spark, run.models_path, str(tmp_path / "x"), freq="Q")
