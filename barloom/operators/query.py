"""Reading one series: range, columns, order, limit and header."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.classify import normal_ticker
from barloom.functions.intervals import interval_of
from barloom.schemas import in_bucket

# Fixed value: rows of a series answer.
ROW_LIMIT = 1000


def in_range(ts: Column, start: date | None = None, end: date | None = None) -> Column:
    """start <= ts <= end; the end is its midnight, so later bars of that day are out."""
    kept = F.lit(True)
    if start is not None:
        kept = kept & (ts >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        kept = kept & (ts <= F.lit(end).cast("timestamp_ntz"))
    return kept


def select_series(
    bars: DataFrame,
    ticker: str | None = None,
    label: str | None = None,
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """Bars of a ticker, an interval and a range; bucket and periods prune stored partitions."""
    out = bars
    if label is not None:
        out = out.where(F.col("interval") == interval_of(label).label)
    if ticker is not None:
        out = out.where(F.col("ticker") == ticker.upper())
        if "bucket" in bars.columns:
            out = out.where(in_bucket(F.col("bucket"), ticker))
    if "period" in bars.columns:
        out = out.where(_in_periods(start, end))
    return out.where(in_range(F.col("timestamp"), start, end))


def _in_periods(start: date | None, end: date | None) -> Column:
    """Periods, `yyyy`, `yyyy-MM` or `yyyy-MM-dd`, that may hold bars of the range; text order is time order."""
    period = F.col("period")
    kept = F.lit(True)
    if start is not None:
        kept = kept & ((period >= start.isoformat()) | period.isin(start.strftime("%Y-%m"), start.strftime("%Y")))
    if end is not None:
        kept = kept & (period <= end.isoformat())
    return kept


def from_day(bars: DataFrame, start: date) -> DataFrame:
    """Stored bars of the periods from a day on; later filters on the time do the rest."""
    return bars.where(_in_periods(start, None)) if "period" in bars.columns else bars


def first_rows(series: DataFrame, columns: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """Rows in time order, all of them unless a limit such as ROW_LIMIT is given; ties go by ticker and interval."""
    ordered = series.orderBy("timestamp", *[k for k in ("ticker", "interval") if k in series.columns])
    if limit is not None:
        ordered = ordered.limit(limit)
    return ordered.select(*columns) if columns is not None else ordered


def series_header(series: DataFrame) -> DataFrame:
    """Count, first and last time of the filtered rows, before any limit."""
    return series.agg(
        F.count(F.lit(1)).alias("records"),
        F.min("timestamp").alias("start_date"),
        F.max("timestamp").alias("end_date"),
    )


def with_normal_ticker(rows: DataFrame) -> DataFrame:
    return rows.withColumn("ticker", normal_ticker(F.col("ticker")))
