"""Table schemas and the required-column check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

SALES_COLUMNS = ["date", "product_id", "sales_quantity", "revenue"]

TRAINING_COLUMNS = ["ds", "y"]

#: series_id of the series that sums every product
ALL_PRODUCTS = "__all__"


def validate_schema(df: DataFrame, expected: Sequence[str] = SALES_COLUMNS) -> DataFrame:
    """Return ``df`` when it has every expected column, else raise ``ValueError``.

    Only the plan's schema is looked at, so no job runs. Extra columns are fine.
    """
    missing = [c for c in expected if c not in df.columns]
    if missing:
        raise ValueError(f"table lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df
