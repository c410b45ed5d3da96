import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from salescast.operators.daily import filter_product
from salescast.operators.profile import content_hash, product_list, profile
from salescast.schema import validate_schema
from salescast.sources import (
    latest_models,
    model_version,
    models_by_version,
    read_sales,
    read_training,
    shared_folder,
    stage,
    write_models,
    write_table,
)

GOOD = """date,product_id,sales_quantity,revenue
2024-01-01,001,5,10.5
2024-01-02,002,7,3
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_typed_scan_keeps_leading_zeros(spark, tmp_path):
    df = read_sales(spark, write(tmp_path / "a.csv", GOOD), strict=True)
    assert df.dtypes == [("date", "date"), ("product_id", "string"),
                         ("sales_quantity", "bigint"), ("revenue", "double")]
    assert rows(df) == [(dt.date(2024, 1, 1), "001", 5, 10.5), (dt.date(2024, 1, 2), "002", 7, 3.0)]


def test_columns_are_bound_by_name_and_extras_stay(spark, tmp_path):
    text = "note,revenue,date,sales_quantity,product_id\nx,1.5,2024-01-01,2,P\n"
    df = read_sales(spark, write(tmp_path / "a.csv", text), strict=True)
    row = df.first()
    assert (row["revenue"], row["sales_quantity"], row["note"]) == (1.5, 2, "x")


@pytest.mark.parametrize("token", ["", "NA", "NaN", "null", "n/a", "None", "#N/A"])
def test_missing_tokens(spark, tmp_path, token):
    text = f"date,product_id,sales_quantity,revenue\n2024-01-01,P,{token},{token}\n"
    path = write(tmp_path / "a.csv", text)
    assert rows(read_sales(spark, path)) == [(dt.date(2024, 1, 1), "P", None, None)]
    with pytest.raises(PySparkException, match="missing value in column sales_quantity"):
        read_sales(spark, path, strict=True).collect()


@pytest.mark.parametrize(
    "line, column",
    [("2024-13-01,P,1,1", "date"), ("2024-01-01,P,1.5,1", "sales_quantity"),
     ("2024-01-01,P,1,x", "revenue")],
)
def test_bad_values(spark, tmp_path, line, column):
    path = write(tmp_path / "a.csv", f"date,product_id,sales_quantity,revenue\n{line}\n")
    with pytest.raises(PySparkException, match=f"bad value in column {column}"):
        read_sales(spark, path, strict=True).collect()
    loose = read_sales(spark, path).first()
    assert loose[column] is None or (column == "sales_quantity" and loose[column] == 1.5)


def test_missing_path_and_columns(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_sales(spark, str(tmp_path / "absent.csv"))
    with pytest.raises(FileNotFoundError):
        read_training(spark, str(tmp_path / "absent"))
    path = write(tmp_path / "a.csv", "date,product_id\n2024-01-01,P\n")
    assert read_sales(spark, path).columns == ["date", "product_id"]
    with pytest.raises(ValueError, match="lacks sales_quantity, revenue"):
        read_sales(spark, path, strict=True)
    path = write(tmp_path / "b.csv", "product_id\nP\n")
    with pytest.raises(ValueError, match="lacks date"):
        read_sales(spark, path)
    with pytest.raises(ValueError):
        validate_schema(spark.range(1), ["id", "ds"])


def test_files_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    write(folder / "a.csv", GOOD)
    write(folder / "b.csv", "product_id,date,revenue,sales_quantity\nP,2024-01-01,1,2\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_sales(spark, str(folder)).collect()


def test_parquet_scan_turns_nan_into_null(spark, tmp_path):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "P", float("nan"), float("nan"))],
        "date date, product_id string, sales_quantity double, revenue double",
    )
    write_table(df, str(tmp_path / "t"))
    assert rows(read_sales(spark, str(tmp_path / "t"))) == [(dt.date(2024, 1, 1), "P", None, None)]


def test_parquet_scan_brings_types_in_line(spark, tmp_path):
    df = spark.createDataFrame(
        [("2024-01-01", 7, 1, 1.0), ("soon", 8, 2, 2.0)],
        "date string, product_id int, sales_quantity int, revenue double",
    )
    write_table(df, str(tmp_path / "t"))
    got = read_sales(spark, str(tmp_path / "t"))
    assert sorted(rows(got), key=str) == [
        (None, "8", 2, 2.0), (dt.date(2024, 1, 1), "7", 1, 1.0)]
    with pytest.raises(PySparkException, match="CAST_INVALID_INPUT"):
        read_sales(spark, str(tmp_path / "t"), strict=True).collect()


def test_product_filter_and_columns_reach_the_scan(spark, tmp_path):
    df = read_sales(spark, write(tmp_path / "a.csv", GOOD), strict=True)
    write_table(df, str(tmp_path / "t"))
    chosen = filter_product(read_sales(spark, str(tmp_path / "t")), "001").select("sales_quantity")
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(product_id,001)" in plan
    assert "ReadSchema: struct<product_id:string,sales_quantity:bigint>" in plan


def test_csv_sink_reads_back(spark, tmp_path):
    df = read_sales(spark, write(tmp_path / "a.csv", GOOD))
    write_table(df, str(tmp_path / "out.csv"), "csv", sort_by=["date"])
    assert sorted(rows(read_sales(spark, str(tmp_path / "out.csv")))) == sorted(rows(df))
    with pytest.raises(ValueError):
        write_table(df, str(tmp_path / "x"), "orc")


def test_staged_table_lives_in_the_shared_folder(spark, tmp_path):
    staged = stage(spark.range(5), f"{shared_folder(spark)}/numbers")
    assert staged.count() == 5
    assert all(spark.conf.get("spark.checkpoint.dir") in f for f in staged.inputFiles())


def test_profile(spark):
    df = spark.createDataFrame(
        [(dt.date(2024, 1, 3), "b", 1, 1.0), (dt.date(2024, 1, 1), "a", 2, 2.0),
         (dt.date(2024, 1, 3), None, 6, None)],
        "date date, product_id string, sales_quantity bigint, revenue double",
    )
    row = profile(df).first().asDict()
    assert row == {
        "num_records": 3, "num_products": 2,
        "start_date": "2024-01-01", "end_date": "2024-01-03", "num_days": 3,
        "total_sales": 9, "total_revenue": 3.0, "avg_daily_sales": 3.0, "avg_revenue": 1.5,
    }
    assert {r[0] for r in product_list(df).collect()} == {"a", "b"}
    empty = profile(df.limit(0)).first()
    assert (empty["num_records"], empty["num_products"], empty["avg_revenue"]) == (0, 0, None)


def test_every_product_is_listed_however_many(spark):
    df = spark.range(10_001).select(
        F.lit(dt.date(2024, 1, 1)).alias("date"), F.col("id").cast("string").alias("product_id"),
        F.lit(1).alias("sales_quantity"), F.lit(1.0).alias("revenue"),
    )
    assert profile(df).first()["num_products"] == product_list(df).count() == 10_001


def test_fingerprint_ignores_order_but_not_content(spark):
    data = [(i, f"p|{i % 3}", None if i % 5 == 0 else i / 2) for i in range(50)]
    schema = "n bigint, p string, v double"

    def fingerprint(rows_, parts=1):
        return content_hash(spark.createDataFrame(rows_, schema).repartition(parts)).first()[0]

    base = fingerprint(data)
    assert len(base) == 8
    assert fingerprint(data[::-1], 7) == base
    assert fingerprint(data[:-1]) != base
    assert fingerprint(data + data[:1]) != base
    assert fingerprint([(1, "a|b", None)]) != fingerprint([(1, "a\\|b", None)])
    assert fingerprint([(1, None, None)]) != fingerprint([(1, "\\N", None)])
    assert fingerprint([]) == fingerprint([])


MODEL = "version string, series_id string, created_at timestamp, payload int"


def models(spark, *entries):
    return spark.createDataFrame(
        [(v, s, dt.datetime(2024, 1, day), p) for v, s, day, p in entries], MODEL
    )


def test_model_table(spark, tmp_path):
    path = str(tmp_path / "models")
    assert latest_models(spark, path, missing="none") is None
    with pytest.raises(FileNotFoundError, match="No trained models"):
        latest_models(spark, path)
    with pytest.raises(ValueError):
        latest_models(spark, path, missing="maybe")

    write_models(models(spark, ("model_v1", "a", 1, 1), ("model_v1", "b", 1, 2),
                        ("model_v1", None, 1, 9)), path)
    write_models(models(spark, ("model_v2", "a", 2, 3)), path)
    newest = {r["series_id"]: r["payload"] for r in latest_models(spark, path).collect()}
    assert newest == {"a": 3, "b": 2, None: 9}

    # the same version replaces itself and leaves the others alone
    write_models(models(spark, ("model_v2", "a", 3, 4)), path)
    assert {r["payload"] for r in models_by_version(spark, path, "model_v2").collect()} == {4}
    assert models_by_version(spark, path, "model_v1").count() == 3
    with pytest.raises(FileNotFoundError, match="Model file not found"):
        models_by_version(spark, path, "model_v3")


def test_equal_times_fall_back_to_the_version(spark, tmp_path):
    path = str(tmp_path / "models")
    write_models(models(spark, ("model_v1", "a", 1, 1), ("model_v2", "a", 1, 2)), path)
    assert latest_models(spark, path).first()["payload"] == 2


def test_version_text():
    assert model_version("0123abcd", dt.date(2024, 3, 9)) == "model_v20240309_0123abcd"
