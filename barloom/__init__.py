"""Market time series on Spark: bars, upserts, universes and freshness reports."""

__version__ = "0.1.0"
