"""Text tables: line breaks in cells, records that do not fit, and the raw rows' order."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salescast.operators.ordered import ordered_features, positioned
from salescast.operators.quality import first_failed, quality_checks, quality_summary
from salescast.plans.features import feature_table
from salescast.plans.run import run_all
from salescast.plans.stages import engineer_features, validate_and_clean_data
from salescast.sources import read_sales, write_table
from salescast.sources.sales import split_records, typed_records
from salescast.sources.tables import read_table

HEADER = "date,product_id,sales_quantity,revenue,note\n"
START = dt.date(2024, 1, 1)


def write(path, text):
    path.write_text(text, newline="")
    return str(path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


ODD = HEADER + (
    '2024-01-01,"a ""b"", c",5,1.5,"one\ntwo"\n'
    "2024-01-02,p,7,2.5,x,surplus\n"
    "2024-01-03,q\n"
    "\n"
    "2024-01-04,r,NA,soon,\n"
    '2024-01-05,"r,s",8,4,"a,b","c,d"\n'
)


def test_line_breaks_and_rejects(spark, tmp_path):
    path = write(tmp_path / "a.csv", ODD)
    good = [(START, 'a "b", c', 5.0, 1.5, "one\ntwo"), (dt.date(2024, 1, 4), "r", None, None, None)]
    assert rows(read_sales(spark, path)) == rows(spark.createDataFrame(good, read_sales(spark, path).schema))
    accepted, rejected = split_records(typed_records(spark, path))
    assert accepted.count() == 2 and rejected.count() == 3
    reasons = {r["record"].strip(): r["reason"] for r in rejected.collect()}
    assert reasons == {
        "2024-01-02,p,7,2.5,x,surplus": "too many cells: 6 of 5",
        "2024-01-03,q": "too few cells: 2 of 5",
        '2024-01-05,"r,s",8,4,"a,b","c,d"': "too many cells: 6 of 5",
    }
    assert rows(read_sales(spark, path).select("date")) == [(START,), (dt.date(2024, 1, 4),)]
    assert read_sales(spark, path).count() == 2


@pytest.mark.parametrize("line, reason", [("2024-01-02,p,7,2.5,x,surplus", "too many cells: 6 of 5"), ("2024-01-03,q", "too few cells: 2 of 5")])
def test_strict_scans_raise_on_other_numbers_of_cells(spark, tmp_path, line, reason):
    path = write(tmp_path / "a.csv", HEADER + "2024-01-01,p,1,1,n\n" + line + "\n")
    for action in (lambda df: df.collect(), lambda df: df.select("date").collect(), lambda df: df.count()):
        with pytest.raises(PySparkException, match=reason):
            action(read_sales(spark, path, strict=True))


def test_text_without_line_breaks_can_be_split(spark, tmp_path):
    path = write(tmp_path / "a.csv", HEADER + "".join(f"2024-01-01,p,{i},1,n\n" for i in range(20)) + "2024-01-03,q\n")
    assert read_sales(spark, path, multiline=False).count() == 20
    assert split_records(typed_records(spark, path, multiline=False))[1].count() == 1


def test_text_sink_reads_back_whatever_the_cells_hold(spark, tmp_path):
    cells = ["a", 'b"', "c,d", "two\nlines", "cr\r\nlf", " space ", None, '"', "\\", '\\"', "é😀", "line\n", "'"]
    df = spark.createDataFrame([(c, i) for i, c in enumerate(cells)], "text string, number int")
    write_table(df, str(tmp_path / "t.csv"), "csv")
    assert rows(read_table(spark, str(tmp_path / "t.csv"), "csv", df.schema)) == rows(df)


def test_parquet_has_no_rejects(spark, tmp_path):
    df = spark.createDataFrame([(START, "p", 1, 1.0)], "date date, product_id string, sales_quantity bigint, revenue double")
    write_table(df, str(tmp_path / "t"))
    accepted, rejected = split_records(typed_records(spark, str(tmp_path / "t")))
    assert rows(accepted) == rows(df) and rejected.count() == 0 and rejected.columns == ["record", "reason"]


def series(n, more=""):
    return HEADER + "".join(f'{START + dt.timedelta(days=i)},p,{i % 9},1.5,"n\n{i}"\n' for i in range(n)) + more


def test_the_gate_counts_rejects(spark, tmp_path):
    few = write(tmp_path / "few.csv", series(120, "2024-01-03,q\n" * 3))
    row = validate_and_clean_data(spark, few, str(tmp_path / "out")).first()
    assert row["rejected_records"] == 3 and row["cleaning"]["final_rows"] == 120 and "rejected_records" in row["checks_passed"]
    assert spark.read.parquet(str(tmp_path / "out_rejected")).count() == 3
    assert not (tmp_path / "out_staged").exists()
    many = write(tmp_path / "many.csv", series(120, "2024-01-03,q\n" * 30))
    with pytest.raises(ValueError, match="Share 20.00% of malformed records is above 5.00%"):
        validate_and_clean_data(spark, many, str(tmp_path / "no"))
    assert spark.read.parquet(str(tmp_path / "no_rejected")).count() == 30
    assert not (tmp_path / "no").exists() and not (tmp_path / "no_staged").exists()


def test_the_share_of_rejects_is_a_fifth_check(spark):
    summary = quality_summary(spark.createDataFrame([(START, 1)], "date date, sales_quantity int"))
    assert quality_checks(summary, {"data_quality": {"min_records": 1}}).count() == 4
    for rejected, limit, passes in ((0, 0.0, True), (1, 0.5, True), (1, 0.49, False)):
        cfg = {"data_quality": {"min_records": 1, "max_rejected_rate": limit, "max_null_rate": 1.0}}
        failed = first_failed(quality_checks(summary, cfg, rejected)).first()["check_name"]
        assert failed == (None if passes else "rejected_records")


def test_nothing_staged_is_left_when_a_run_fails(spark, tmp_path):
    path = write(tmp_path / "short.csv", series(5))
    with pytest.raises(ValueError, match="Insufficient records"):
        run_all(spark, path, str(tmp_path / "run"))
    assert not (tmp_path / "run" / "parsed").exists()


def test_staged_rows_of_one_product_are_removed(spark, tmp_path):
    path = write(tmp_path / "a.csv", series(60))
    row = engineer_features(spark, path, str(tmp_path / "f"), product_id="p").first()
    assert row["engineered_records"] == 60
    assert {p.name for p in tmp_path.iterdir()} == {"a.csv", "f"}


def plain_features(frame, windows, lags):
    frame = frame.sort_values("key").copy()
    for n in windows:
        frame[f"y_rolling_{n}d"] = frame.y.rolling(n, min_periods=1).mean().round(2)
    for k in lags:
        frame[f"y_lag_{k}d"] = frame.y.shift(k)
    names = [c for c in frame.columns if "_rolling_" in c or "_lag_" in c]
    frame[names] = frame[names].ffill().bfill()
    return frame


@pytest.mark.parametrize("case", ["one hot date", "no dates", "one row copied"])
def test_hot_raw_rows(spark, case):
    """A third of the rows, or all, under one date; one row 100,000 times."""
    n = 3000
    date = {"one hot date": "if(id % 3 = 0, date'2024-01-05', date_add(date'2024-01-01', cast(id % 40 AS int)))"}.get(case, "date'2024-01-01'")
    date = "cast(null AS date)" if case == "no dates" else date
    df = spark.range(n).selectExpr("'g' AS g", f"{date} AS date", "if(id % 7 = 0, null, cast(id AS double)) AS y")
    if case == "one row copied":
        df = df.union(spark.range(100_000).selectExpr("'g'", "date'2024-01-01'", "3.0D"))
    features = ordered_features(df, "y", [3], [2], group="g", fill=True, block_rows=500)
    from salescast.functions import row_digest

    keyed = df.withColumn("digest", row_digest(df, df.columns)).toPandas()
    keyed["key"] = [(d is None or d != d, d if d is not None and d == d else START, h) for d, h in zip(keyed.date, keyed.digest)]
    expected = plain_features(keyed, [3], [2])
    columns = ["y", "y_rolling_3d", "y_lag_2d"]
    sort = lambda f: f[columns].fillna(-1).sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(sort(features.toPandas()), sort(expected), check_dtype=False)


def test_copies_are_spread_and_positions_are_whole(spark, tmp_path):
    df = spark.range(40_000).selectExpr("'g' AS g", "date'2024-01-01' AS date", "1.0D AS y")
    placed = positioned(df, "g", "date", str(tmp_path / "rows"))
    assert placed.agg(F.min("_position"), F.max("_position"), F.count_distinct("_position")).first() == (0, 39_999, 40_000)
    sizes = [r["count"] for r in spark.read.parquet(str(tmp_path / "rows")).groupBy(F.input_file_name()).count().collect()]
    assert max(sizes) < 15_000


def test_only_counts_of_partitions_stand_between_scan_and_blocks(spark, tmp_path):
    df = spark.range(20_000).selectExpr("'g' AS g", "date_add(date'2024-01-01', cast(id % 300 AS int)) AS date", "cast(id AS double) AS y")
    placed = positioned(df, "g", "date", str(tmp_path / "rows"))
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Aggregate [_group" in plan and "_part" in plan


def test_features_of_a_product_without_rows(spark):
    df = spark.createDataFrame([], "date date, product_id string, sales_quantity double")
    assert feature_table(df, product_id="p").count() == 0
