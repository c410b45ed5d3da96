"""Daily sales forecasting as Spark jobs."""

__version__ = "0.1.0"
