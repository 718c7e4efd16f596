"""Business-day spines and the coverage of days."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.spread import restrict_to


def is_weekday(day: Column) -> Column:
    return F.weekday(day) < 5


def day_spine(bounds: DataFrame, start: str = "start_date", end: str = "end_date", weekdays: bool = True) -> DataFrame:
    """Every day (or every weekday) of a range, bounds included."""
    days = bounds.select(F.explode(F.sequence(F.col(start), F.col(end), F.expr("INTERVAL '1' DAY"))).alias("date"))
    return days.where(is_weekday(F.col("date"))) if weekdays else days


def day_bounds(rows: DataFrame, ts: str = "timestamp") -> DataFrame:
    """First and last day of a table, one row; no row when the table is empty."""
    day = F.col(ts).cast("date")
    return rows.agg(F.min(day).alias("start_date"), F.max(day).alias("end_date")).where(F.col("start_date").isNotNull())


def available_dates(ticks: DataFrame, year: int | None = None) -> DataFrame:
    """Dates that hold data, optionally of one year; on a date-partitioned lake only folders are read."""
    dates = ticks.select("date")
    if year is not None:
        dates = dates.where(F.year("date") == year)
    return dates.distinct().orderBy("date")


def day_coverage(spine: DataFrame, counts: DataFrame, count: str = "rows") -> DataFrame:
    """One result per calendar day: success or no_data."""
    joined = spine.join(counts, "date", "left")
    status = F.when(F.col(count) > 0, "success").otherwise("no_data")
    return joined.select("date", F.coalesce(F.col(count), F.lit(0)).alias(count), status.alias("status"))


def missing_days(spine: DataFrame, dates: DataFrame) -> DataFrame:
    """Spine days without data; `dates` may repeat, one date per task goes on."""
    return spine.join(dates.select("date").distinct(), "date", "left_anti")


def rows_per_day(rows: DataFrame, ts: str = "timestamp", count: str = "rows") -> DataFrame:
    return rows.groupBy(F.col(ts).cast("date").alias("date")).agg(F.count(F.lit(1)).alias(count))


def extract_range(
    ticks: DataFrame,
    symbols: DataFrame | Sequence[str] | None,
    start: Column,
    end: Column,
) -> DataFrame:
    """Ticks of a symbol set on all days of a range, weekends included.

    A short list of symbols becomes a pushed-down IN; a table of symbols a
    semi-join in which AQE may split hot symbols.
    """
    ts = F.col("timestamp")
    out = ticks.where((ts >= start.cast("timestamp_ntz")) & (ts < F.date_add(end, 1).cast("timestamp_ntz")))
    if symbols is None:
        return out
    if isinstance(symbols, DataFrame):
        return restrict_to(out, symbols, ["ticker"])
    return out.where(F.col("ticker").isin(list(symbols)))
