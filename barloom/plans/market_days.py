"""Market-wide daily bars into the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.calendar import day_spine
from barloom.schemas import BAR_VALUES
from barloom.sources.landed import market_day_report, normalise_market_days
from barloom.sources.store import add_run, commit_run, run_bars


def merge_market_days(
    spark: SparkSession, raw: DataFrame, day: Column, path: str, seq: str | None = None, rows: int | None = None
) -> DataFrame:
    """Merge the market's days into the stored daily series, the rows given now winning; returns the report per weekday.

    Of several rows of a ticker and day the one with the highest `seq` stays, without it a hash of the values decides.
    The report covers the weekdays from the first to the last day of the rows. `rows` bounds the number of rows of `raw`, where
    that is known and a ticker and day has few of them; tasks are then dealt by it.
    """
    kept = [seq] if seq else []
    bars = normalise_market_days(raw, day, keep=kept)
    order = F.col(seq).cast("bigint") if seq else F.xxhash64(*BAR_VALUES)
    run = add_run(spark, bars.withColumn("ingest_seq", order), path, "ingest_seq", rows=rows)
    commit_run(spark, path, run)
    merged = run_bars(spark, path, run)
    bounds = merged.agg(F.min("timestamp").cast("date").alias("start_date"), F.max("timestamp").cast("date").alias("end_date"))
    return market_day_report(merged, day_spine(bounds.where("start_date IS NOT NULL")))
