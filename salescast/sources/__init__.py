"""Reading sales tables, writing stage tables, keeping models."""

from salescast.sources.models import (
    latest_models,
    model_version,
    models_by_version,
    newest_models,
    write_models,
)
from salescast.sources.sales import read_sales, read_training
from salescast.sources.tables import discard, read_table, shared_folder, stage, write_table

__all__ = [
    "latest_models",
    "model_version",
    "models_by_version",
    "newest_models",
    "discard",
    "read_sales",
    "read_table",
    "read_training",
    "shared_folder",
    "stage",
    "write_models",
    "write_table",
]
