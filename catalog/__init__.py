"""Named queries over the driver's tables, each with its SQL twin where SQL can say it."""

from catalog.registry import oracles, queries

__all__ = ["oracles", "queries"]
