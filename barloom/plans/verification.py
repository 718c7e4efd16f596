"""Freshness of every series against the provider, per ticker and in total."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barloom.operators.freshness import freshness, high_water_marks, verify_tickers, verify_totals


def verify(ranges: DataFrame, bars: DataFrame, universe: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(per ticker, totals)."""
    per_ticker = verify_tickers(freshness(ranges, high_water_marks(bars)), universe)
    return per_ticker, verify_totals(per_ticker)
