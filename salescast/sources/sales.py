"""Scans of sales and training tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salescast.functions import null_if_nan
from salescast.schema import SALES_COLUMNS, TRAINING_COLUMNS, validate_schema

# The texts that a CSV cell may use for "missing".
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]


def open_table(path: str, load: Callable[[], DataFrame]) -> DataFrame:
    """Run ``load`` and report a missing or unreadable path as Python does."""
    try:
        return load()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from problem
        if "Permission denied" in str(problem):
            raise PermissionError(f"no right to read {path}") from problem
        raise


def is_csv(path: str, fmt: str | None = None) -> bool:
    """Whether a table is text: by ``fmt`` when given, else by the path's ending."""
    return fmt == "csv" if fmt else path.lower().endswith((".csv", ".csv.gz"))


def _present(text: Column) -> Column:
    return F.when(~text.isin(MISSING_TOKENS), text)


def _parsed(text: Column, kind: str, name: str, strict: bool) -> Column:
    value = text.try_cast(kind)
    if not strict:
        return value
    problem = F.concat(F.lit(f"bad value in column {name}: "), text)
    return F.when(text.isNotNull() & value.isNull(), F.raise_error(problem)).otherwise(value)


def typed_sales(raw: DataFrame, strict: bool) -> DataFrame:
    """Sales columns with their types, bound by name; extra columns stay text."""
    columns = {c: _present(F.col(f"`{c}`")) for c in raw.columns}
    typed = {}
    for name, text in columns.items():
        if name == "date":
            typed[name] = _parsed(text, "date", name, strict)
        elif name == "sales_quantity":
            # whole numbers when strict; a column with gaps may hold fractions
            value = _parsed(text, "bigint" if strict else "double", name, strict)
            if strict:
                absent = F.raise_error(F.lit("missing value in column sales_quantity"))
                value = F.when(text.isNull(), absent).otherwise(value)
            typed[name] = value if strict else null_if_nan(value)
        elif name == "revenue":
            typed[name] = null_if_nan(_parsed(text, "double", name, strict))
        else:
            typed[name] = text
    return raw.select(*[c.alias(name) for name, c in typed.items()])


def _normalised(table: DataFrame, strict: bool) -> DataFrame:
    """Parquet columns brought to date, text and numbers without NaN.

    Columns of the right type are left alone, so filters on them still reach the
    scan. Texts that are no date raise when ``strict`` and are NULL otherwise.
    """
    changed = {}
    for field in table.schema:
        column = F.col(f"`{field.name}`")
        if field.name == "date" and not isinstance(field.dataType, T.DateType):
            changed["date"] = column.cast("date") if strict else column.try_cast("date")
        elif field.name == "product_id" and not isinstance(field.dataType, T.StringType):
            changed["product_id"] = column.cast("string")
        elif isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            changed[field.name] = null_if_nan(column)
    if strict and "sales_quantity" in table.columns:
        value = changed.get("sales_quantity", F.col("sales_quantity"))
        absent = F.raise_error(F.lit("missing value in column sales_quantity"))
        changed["sales_quantity"] = F.when(value.isNull(), absent).otherwise(value)
    return table.withColumns(changed) if changed else table


#: Where a record that does not fit its header keeps its text.
RECORD = "_record"


def csv_reader(spark: SparkSession, multiline: bool = True) -> DataFrameReader:
    """A reader of text tables: quotes are doubled inside cells, which may hold line breaks.

    Without ``multiline`` large files are split, and a line break ends a record.
    """
    return (
        spark.read.option("header", True)
        .option("escape", '"')
        .option("multiLine", multiline)
        # a cell of any length, and files with another header are refused
        .option("maxCharsPerColumn", -1)
        .option("enforceSchema", False)
    )


def csv_records(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The records of a text table: a text column for each cell, and :data:`RECORD`.

    That is NULL for a record with as many cells as the header; of any other it
    has the whole text, and the cells mean nothing. Blank lines are no records.
    """
    names = open_table(path, lambda: csv_reader(spark, multiline).csv(path)).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, RECORD)])
    # every cell is parsed, or short records would not be seen by scans of few columns
    options = {"columnNameOfCorruptRecord": RECORD, "columnPruning": False}
    return csv_reader(spark, multiline).options(**options).csv(path, schema=schema)


def reject_reason(record: Column, cells: int) -> Column:
    """Why a record was rejected; commas inside quotes separate nothing."""
    bare = F.regexp_replace(record, '"([^"]|"")*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    many, few = F.lit("too many cells: "), F.lit("too few cells: ")
    counted = F.concat(found.cast("string"), F.lit(f" of {cells}"))
    return F.when(found > cells, F.concat(many, counted)).when(found < cells, F.concat(few, counted)).otherwise("unreadable")


def _unfit(records: DataFrame) -> Column:
    """Whether a record does not fit its header."""
    first = F.col(f"`{records.columns[0]}`").cast("string")
    # a cell is named too: a scan cannot be asked for the text of rejects alone
    return F.col(RECORD).isNotNull() & (F.coalesce(F.length(first), F.lit(0)) >= 0)


def _split(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    unfit = _unfit(records)
    reason = reject_reason(F.col(RECORD), len(records.columns) - 1)
    rejected = records.where(unfit).select(F.col(RECORD).alias("record"), reason.alias("reason"))
    return records.where(~unfit).drop(RECORD), rejected


def split_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted rows, rejected records with their reason) of :func:`typed_records`.

    A table without rejected texts, as Parquet is, has none.
    """
    if RECORD not in records.columns:
        none = records.sparkSession.createDataFrame([], "record string, reason string")
        return records, none
    return _split(records)


def typed_records(spark: SparkSession, path: str, fmt: str | None = None, multiline: bool = True) -> DataFrame:
    """Sales rows typed leniently; from text also :data:`RECORD`, for :func:`split_records`."""
    if not is_csv(path, fmt):
        return read_sales(spark, path, fmt=fmt)
    records = validate_schema(csv_records(spark, path, multiline), ["date"])
    typed = typed_sales(records.withColumnRenamed(RECORD, "_text"), strict=False)
    # a rejected text is no cell: words for "missing" do not apply to it
    return typed.withColumn(RECORD, F.col("_text")).drop("_text")


def read_sales(
    spark: SparkSession, path: str, strict: bool = False, fmt: str | None = None, multiline: bool = True
) -> DataFrame:
    """Sales rows from CSV (with header) or Parquet; a directory is fine.

    CSV cells are read as text and cast. ``strict`` raises, when rows are read,
    on a record with more or fewer cells than the header, on a value that does not
    fit its type and on a missing quantity. Otherwise such records are left out
    (:func:`typed_records` has them) and such cells are NULL, for the quality gate
    to count. ``strict`` wants all four columns, otherwise only ``date``; operators
    pass over what is absent. ``fmt`` is told from the path's ending unless given.
    NaN becomes NULL. ``multiline`` is as in :func:`csv_reader`.
    """
    needed = SALES_COLUMNS if strict else ["date"]
    if is_csv(path, fmt):
        records = csv_records(spark, path, multiline)
        cells = validate_schema(records.drop(RECORD), needed).columns
        if strict:
            text = F.concat(reject_reason(F.col(RECORD), len(cells)), F.lit(" in record "), F.col(RECORD))
            records = records.where(F.when(_unfit(records), F.raise_error(text)).otherwise(F.lit(True)))
            return typed_sales(records.drop(RECORD), strict)
        return typed_sales(_split(records)[0], strict)
    table = validate_schema(open_table(path, lambda: spark.read.parquet(path)), needed)
    return _normalised(table, strict)


def read_training(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """Feature rows for training; the scan reads the columns that are used.

    From CSV, ``ds`` and ``y`` are cast, and a bad cell raises when it is read.
    """
    if is_csv(path, fmt):
        reader = csv_reader(spark).option("enforceSchema", True)
        raw = validate_schema(open_table(path, lambda: reader.csv(path)), TRAINING_COLUMNS)
        return raw.withColumns({"ds": F.col("ds").cast("date"), "y": F.col("y").cast("double")})
    table = open_table(path, lambda: spark.read.parquet(path))
    return validate_schema(table, TRAINING_COLUMNS)
