"""Bring the bar store up to date from landed provider bars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.freshness import fetch_report, high_water_marks, resume_points, rows_to_fetch
from barloom.schemas import BAR_VALUES, SERIES_KEY
from barloom.session import ensure_checkpoint_dir
from barloom.sources.store import add_run, commit_run, read_series, run_bars


def rows_due(ranges: DataFrame, landed: DataFrame, stored: DataFrame, force_refresh: bool = False) -> DataFrame:
    """Landed bars that a backfill would add: those at or after the resume point of their series."""
    return rows_to_fetch(landed, resume_points(ranges, high_water_marks(stored), force_refresh))


def backfill(
    spark: SparkSession, ranges: DataFrame, landed: DataFrame, path: str, force_refresh: bool = False
) -> DataFrame:
    """One job for all tickers and intervals: resume filter, merge, write. Returns the per-series report.

    Marks and totals come from the states of the series, so no stored bar is read but those that a landed one may
    replace. The resume points are checkpointed, since the merge moves the marks they come from. Of several landed copies
    of a bar the one with the highest `ingest_seq` stays; without that column a hash of the values decides, so that the
    result does not hang on how the rows are partitioned.
    """
    ensure_checkpoint_dir(spark)
    if "ingest_seq" not in landed.columns:
        landed = landed.withColumn("ingest_seq", F.xxhash64(*[c for c in BAR_VALUES if c in landed.columns]))
    resume = resume_points(ranges, read_series(spark, path), force_refresh).checkpoint()
    run = add_run(spark, rows_to_fetch(landed, resume, resume.count()), path, "ingest_seq")
    fetched = run_bars(spark, path, run)
    commit_run(spark, path, run)
    return fetch_report(resume, fetched, read_series(spark, path).select(*SERIES_KEY, F.col("records").alias("total_records"))).checkpoint()
