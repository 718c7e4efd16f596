"""Summaries and profiles of stored series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.intervals import display_rank
from barloom.functions.sizes import kilobytes, megabytes
from barloom.functions.timing import whole_days
from barloom.schemas import SERIES_KEY


def file_sizes(rows: DataFrame) -> DataFrame:
    """Per series the bytes and number of the files it lives in.

    `rows` must come straight from a file scan, for the hidden file columns.
    """
    per_file = rows.groupBy(*SERIES_KEY, F.col("_metadata.file_path").alias("_path")).agg(
        F.max("_metadata.file_size").alias("_bytes")
    )
    return per_file.groupBy(*SERIES_KEY).agg(F.sum("_bytes").alias("file_bytes"), F.count(F.lit(1)).alias("n_files"))


def series_summary(bars: DataFrame, requested: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Records, first and last date per series; with `requested`, absent series are `no_data`.

    A series without any timestamp is `empty`.
    """
    counted = bars.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last")
    )
    return _summary(counted, requested, sizes)


def summary_of_states(states: DataFrame, requested: DataFrame | None = None) -> DataFrame:
    """`series_summary` from the states that the store keeps of its series; no bar is read."""
    named = states.select(*SERIES_KEY, "records", F.col("first_timestamp").alias("_first"), F.col("last_timestamp").alias("_last"))
    return _summary(named, requested, None)


def _summary(out: DataFrame, requested: DataFrame | None, sizes: DataFrame | None) -> DataFrame:
    if requested is not None:
        out = requested.select(*SERIES_KEY).distinct().join(out, list(SERIES_KEY), "left")
    if sizes is not None:
        out = out.join(sizes.select(*SERIES_KEY, "file_bytes"), list(SERIES_KEY), "left")
    status = F.when(F.col("records").isNull(), "no_data").when(F.col("_last").isNull(), "empty").otherwise("available")
    size = [megabytes(F.col("file_bytes")).alias("file_size_mb")] if sizes is not None else []
    return out.select(
        *SERIES_KEY,
        status.alias("status"),
        F.coalesce("records", F.lit(0)).alias("records"),
        F.col("_first").cast("date").alias("start_date"),
        F.col("_last").cast("date").alias("end_date"),
        *size,
    )


def series_profile(bars: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """Records, first and last bar and whole days between them, in display order per ticker."""
    columns = F.lit(",".join(c for c in bars.columns if c not in SERIES_KEY))
    out = bars.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("records"), F.min("timestamp").alias("first_date"), F.max("timestamp").alias("last_date")
    )
    if sizes is not None:
        out = out.join(sizes.select(*SERIES_KEY, "file_bytes"), list(SERIES_KEY), "left")
    size = [kilobytes(F.col("file_bytes")).alias("file_size_kb")] if sizes is not None else []
    status = F.when(F.col("first_date").isNull(), "no_timestamp").otherwise("ok")
    return out.select(
        *SERIES_KEY,
        status.alias("status"),
        "records",
        "first_date",
        "last_date",
        whole_days(F.col("last_date"), F.col("first_date")).alias("date_range_days"),
        columns.alias("columns"),
        display_rank(F.col("interval")).alias("display_order"),
        *size,
    )


def overall_statistics(profile: DataFrame) -> DataFrame:
    """Per ticker totals over its intervals."""
    ok = profile.where(F.col("status") == "ok")
    size = []
    if "file_size_kb" in profile.columns:
        size = [(F.sum("file_size_kb") / F.lit(1024.0)).alias("total_size_mb")]
    out = ok.groupBy("ticker").agg(
        F.sum("records").alias("total_records"),
        F.min("first_date").alias("earliest"),
        F.max("last_date").alias("latest"),
        *size,
    )
    return out.withColumn("total_days", whole_days(F.col("latest"), F.col("earliest")))


def store_statistics(bars: DataFrame) -> DataFrame:
    """Distinct tickers and series; reduced to series first, so one distinct is left."""
    series = bars.groupBy(*SERIES_KEY).agg(F.lit(1).alias("_one"))
    return series.agg(F.count_distinct("ticker").alias("tickers"), F.count(F.lit(1)).alias("series"))


def first_last_bars(bars: DataFrame) -> DataFrame:
    """First and last bar of every series in one aggregate, not a sort per series."""
    return bars.groupBy(*SERIES_KEY).agg(
        F.min("timestamp").alias("first_timestamp"),
        F.min_by("open", "timestamp").alias("first_open"),
        F.max("timestamp").alias("last_timestamp"),
        F.max_by("close", "timestamp").alias("last_close"),
    )
