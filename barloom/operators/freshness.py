"""Availability, high-water marks, freshness, resume plans and verification."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.intervals import DEFAULT_LABELS, VOCABULARY, by_label, display_rank, interval_of
from barloom.functions.sizes import progress_pct
from barloom.functions.timing import (
    age_hours,
    days_behind,
    days_between,
    is_past,
    lag_class,
    probe_estimate,
    range_estimate,
    resume_point,
    whole_days,
)
from barloom.operators.spread import lookup_join
from barloom.schemas import SERIES_KEY

# Fixed values of the range and pre-filter rules.
FIRST_DAY = "1970-01-01"
MIN_INTERVALS = 3
FRESH_HOURS = 24
RECENT_HOURS = 72
RECENT_DAYS = 2


def high_water_marks(bars: DataFrame) -> DataFrame:
    """Last stored timestamp per series; reads three columns."""
    return bars.groupBy(*SERIES_KEY).agg(F.max("timestamp").alias("last_timestamp"))


def available_ranges(bars: DataFrame, form: str = "probe", details: DataFrame | None = None) -> DataFrame:
    """First and last date, days and estimated bars per series.

    `form` chooses the estimate: `range` (five labels, trading hours) or `probe`
    (all labels). With `details` (ticker, list_date) bars before the listing are
    left out.
    """
    estimate = {"range": range_estimate, "probe": probe_estimate}[form]
    first, last = F.min("timestamp").alias("_first"), F.max("timestamp").alias("_last")
    if details is None:
        ranges = bars.groupBy(*SERIES_KEY).agg(first, last)
    else:
        # Listings count by day, so the bars are first reduced to one row per day.
        days = bars.groupBy(*SERIES_KEY, F.col("timestamp").cast("date").alias("_day")).agg(first, last)
        listed = details.select("ticker", F.col("list_date").cast("date").alias("_listed"))
        kept = F.coalesce(F.col("_day") >= F.greatest(F.col("_listed"), F.lit(FIRST_DAY).cast("date")), F.lit(True))
        ranges = (
            lookup_join(days, listed, ["ticker"])
            .where(kept)
            .groupBy(*SERIES_KEY)
            .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
        )
    days = days_between(F.col("_last"), F.col("_first"))
    return ranges.select(
        *SERIES_KEY,
        F.col("_first").cast("date").alias("start_date"),
        F.col("_last").cast("date").alias("end_date"),
        days.alias("days_available"),
        estimate(F.col("interval"), days).alias("estimated_bars"),
    )


def answer_ranges(requested: DataFrame, ranges: DataFrame) -> DataFrame:
    """One answer per requested series; series without data report zero days."""
    joined = requested.select(*SERIES_KEY).join(ranges, list(SERIES_KEY), "left")
    return joined.select(
        *SERIES_KEY,
        "start_date",
        "end_date",
        F.coalesce("days_available", F.lit(0)).cast("bigint").alias("days_available"),
        F.coalesce("estimated_bars", F.lit(0)).cast("bigint").alias("estimated_bars"),
        F.col("start_date").isNotNull().alias("data_available"),
    )


def timeframe_flags(ranges: DataFrame) -> DataFrame:
    """Per ticker: number of intervals and which families they cover."""

    def has(family: str) -> Column:
        return F.bool_or(F.col("interval").isin(*[i.label for i in VOCABULARY.values() if i.family == family]))

    return ranges.groupBy("ticker").agg(
        F.count_distinct("interval").alias("total_timeframes"),
        has("seconds").alias("has_seconds"),
        has("intraday").alias("has_intraday"),
        has("hourly").alias("has_hourly"),
        has("daily").alias("has_daily"),
        F.bool_or(F.col("interval").isin("1m", "5m")).alias("has_short_minutes"),
    )


def timeframe_map(ranges: DataFrame) -> DataFrame:
    """Per ticker the nested form: interval -> {start_date, end_date, days, estimate}."""
    entry = F.struct(
        F.col("interval"), F.struct("start_date", "end_date", "days_available", "estimated_bars").alias("value")
    )
    return ranges.groupBy("ticker").agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("timeframes"))


def freshness(ranges: DataFrame, marks: DataFrame) -> DataFrame:
    """Provider ranges against stored high-water marks: up_to_date, needs_update or missing."""
    local = marks.select(*SERIES_KEY, "last_timestamp")
    joined = ranges.select(*SERIES_KEY, "start_date", "end_date").join(local, list(SERIES_KEY), "left")
    behind = days_behind(F.col("end_date"), F.col("last_timestamp"))
    return joined.withColumn("days_behind", behind).select(
        *SERIES_KEY,
        "start_date",
        "end_date",
        "last_timestamp",
        "days_behind",
        F.when(F.col("days_behind").isNull(), "missing")
        .when(F.col("days_behind") <= 0, "up_to_date")
        .otherwise("needs_update")
        .alias("status"),
        lag_class(F.col("days_behind")).alias("lag"),
    )


def _of_status(status: str) -> Column:
    return F.count_if(F.col("status") == status)


def _labels(status: str, text: Column) -> Column:
    """At most 25 labels of a ticker, in vocabulary order, joined by commas."""
    position = by_label(F.col("interval"), {i.label: i.position for i in VOCABULARY.values()})
    entry = F.when(F.col("status") == status, F.struct(position.alias("p"), text.alias("t")))
    return F.array_join(F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["t"]), ",")


def verify_tickers(fresh: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Per ticker COMPLETE, PARTIAL or MISSING with its lists of intervals.

    Universe tickers the provider knows nothing about are `no_api_data`.
    """
    label = F.col("interval")
    behind = F.concat(label, F.lit(" ("), F.col("days_behind").cast("string"), F.lit("d behind)"))
    per_ticker = fresh.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("available"),
        _of_status("up_to_date").alias("n_up_to_date"),
        _of_status("needs_update").alias("n_needs_update"),
        _of_status("missing").alias("n_missing"),
        _labels("up_to_date", label).alias("up_to_date"),
        _labels("needs_update", behind).alias("needs_update"),
        _labels("missing", label).alias("missing"),
    )
    if universe is not None:
        per_ticker = universe.select("ticker").distinct().join(per_ticker, "ticker", "left")
    verdict = (
        F.when(F.col("available").isNull(), "no_api_data")
        .when((F.col("n_missing") == 0) & (F.col("n_needs_update") == 0), "COMPLETE")
        .when(F.col("n_missing") == F.col("available"), "MISSING")
        .otherwise("PARTIAL")
    )
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_up_to_date", "n_needs_update", "n_missing")]
    lists = [F.coalesce(c, F.lit("")).alias(c) for c in ("up_to_date", "needs_update", "missing")]
    return per_ticker.select("ticker", verdict.alias("status"), *counts, *lists)


def verify_totals(per_ticker: DataFrame) -> DataFrame:
    """The seven counters over all tickers."""
    return per_ticker.agg(
        _of_status("COMPLETE").alias("tickers_complete"),
        _of_status("PARTIAL").alias("tickers_partial"),
        F.count_if(F.col("status").isin("MISSING", "no_api_data")).alias("tickers_missing"),
        *[
            F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
            for c, name in (
                ("n_up_to_date", "timeframes_up_to_date"),
                ("n_needs_update", "timeframes_need_update"),
                ("n_missing", "timeframes_missing"),
            )
        ],
        F.coalesce(F.sum(F.col("n_needs_update") + F.col("n_missing")), F.lit(0))
        .cast("bigint")
        .alias("total_tasks_needed"),
    )


def plan_outcome(fresh: DataFrame, universe: DataFrame | None = None) -> DataFrame:
    """Per ticker what an update run would do, with its counters."""
    per_ticker = fresh.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("timeframes_available"),
        _of_status("up_to_date").alias("timeframes_skipped"),
        _of_status("needs_update").alias("timeframes_to_update"),
        _of_status("missing").alias("timeframes_new"),
    )
    if universe is not None:
        per_ticker = universe.select("ticker").distinct().join(per_ticker, "ticker", "left")
    names = ("timeframes_available", "timeframes_skipped", "timeframes_to_update", "timeframes_new")
    filled = per_ticker.select("ticker", *[F.coalesce(n, F.lit(0)).cast("bigint").alias(n) for n in names])
    tasks = F.col("timeframes_to_update") + F.col("timeframes_new")
    status = (
        F.when(F.col("timeframes_available") == 0, "no_data")
        .when(tasks == 0, "all_up_to_date")
        .when(tasks < F.col("timeframes_available"), "partial_update")
        .otherwise("full_download")
    )
    return filled.select("ticker", status.alias("status"), *names, tasks.alias("tasks_created"))


def resume_points(ranges: DataFrame, marks: DataFrame, force_refresh: bool = False) -> DataFrame:
    """Per series where to start fetching and whether there is anything to fetch.

    `ranges` holds start_date and end_date per series; without an end the provider
    has nothing (`no_data_available`). `force_refresh` ignores what is stored.
    """
    begin = F.coalesce(F.col("start_date"), F.lit(FIRST_DAY).cast("date")).cast("timestamp_ntz")
    if force_refresh:
        joined = ranges.withColumn("last_timestamp", F.lit(None).cast("timestamp_ntz"))
    else:
        local = marks.select(*SERIES_KEY, "last_timestamp")
        joined = ranges.join(local, list(SERIES_KEY), "left")
    resumed = resume_point(F.col("interval"), F.col("last_timestamp"))
    done = F.col("last_timestamp").isNotNull() & is_past(resumed, F.col("end_date"))
    return joined.select(
        *SERIES_KEY,
        "last_timestamp",
        F.coalesce(resumed, begin).alias("resume_from"),
        "end_date",
        F.when(F.col("end_date").isNull(), "no_data_available").when(done, "up_to_date").otherwise("fetch").alias("action"),
    )


def rows_to_fetch(landed: DataFrame, resume: DataFrame, resume_rows: int | None = None) -> DataFrame:
    """Landed bars at or after the resume point of their series, up to its end day.

    `resume_rows`, when the caller has counted them, allows a broadcast.
    """
    due = resume.where(F.col("action") == "fetch").select(
        *SERIES_KEY, "resume_from", F.date_add("end_date", 1).cast("timestamp_ntz").alias("_stop")
    )
    ts = F.col("timestamp")
    joined = lookup_join(landed, due, SERIES_KEY, "inner", resume_rows)
    return joined.where((ts >= F.col("resume_from")) & (ts < F.col("_stop"))).drop("resume_from", "_stop")


def fetch_report(resume: DataFrame, fetched: DataFrame, stored: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per series the result of a load: success, no_new_data, up_to_date, no_data_available or error.

    `stored` is the store as the counts shall describe it, usually after the merge: its bars, or its series with
    total_records. A series for which the provider names no range (no end_date) has no data available. `errors` lists
    series whose load went wrong (ticker, interval, error); that status and text win.
    """
    keys = list(SERIES_KEY)
    new = fetched.groupBy(*keys).agg(F.count(F.lit(1)).alias("new_records"))
    total = stored if "total_records" in stored.columns else stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("total_records"))
    out = resume.join(new, keys, "left").join(total.select(*keys, "total_records"), keys, "left")
    if errors is not None:
        failed = errors.groupBy(*keys).agg(F.min("error").alias("error"))
        out = out.join(failed, keys, "left")
    status = (
        F.when(F.col("error").isNotNull() if errors is not None else F.lit(False), "error")
        .when(F.col("action") == "no_data_available", "no_data_available")
        .when(F.col("action") == "up_to_date", "up_to_date")
        .when(F.coalesce("new_records", F.lit(0)) == 0, "no_new_data")
        .otherwise("success")
    )
    return out.select(
        *keys,
        status.alias("status"),
        F.coalesce("new_records", F.lit(0)).alias("new_records"),
        F.coalesce("total_records", F.lit(0)).alias("total_records"),
        *(["error"] if errors is not None else []),
    )


def load_summary(report: DataFrame) -> DataFrame:
    """Per ticker: intervals available, loaded, failed and without data, and the sum of new records."""
    counted = F.col("status") != "timeframe_detection"
    ok = F.col("status") == "success"
    return report.groupBy("ticker").agg(
        F.count_if(counted).alias("intervals_total"),
        F.count_if(ok).alias("intervals_completed"),
        F.coalesce(F.sum(F.when(ok, F.col("new_records"))), F.lit(0)).cast("bigint").alias("total_new_records"),
    )


def series_files(files: DataFrame) -> DataFrame:
    """Per ticker what the pre-filter needs from (ticker, interval, modified, last_timestamp, path)."""
    return files.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("n_files"),
        F.max("modified").alias("newest_modified"),
        F.max_by("last_timestamp", "modified").alias("newest_last"),
        F.max_by("path", "modified").alias("newest_path"),
    )


def fresh_tickers(per_ticker: DataFrame, as_of: Column) -> DataFrame:
    """Tickers that may be skipped: enough files, and the newest recent enough."""
    age = age_hours(as_of, F.col("newest_modified"))
    days_old = whole_days(as_of, F.col("newest_last"))
    recent = (age < FRESH_HOURS) | ((age < RECENT_HOURS) & (days_old < RECENT_DAYS))
    return per_ticker.where((F.col("n_files") >= MIN_INTERVALS) & recent)


def to_process(universe: DataFrame, skipped: DataFrame) -> DataFrame:
    return universe.join(skipped.select("ticker"), "ticker", "left_anti")


def work_list(tickers: DataFrame, labels: Iterable[str] = DEFAULT_LABELS) -> DataFrame:
    """Every ticker with every interval: the labels are generated per row, nothing is joined."""
    known = [F.lit(interval_of(label).label) for label in dict.fromkeys(labels)]
    return tickers.select("ticker", F.explode(F.array(*known)).alias("interval"))


def progress(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Universe tickers that have bars, out of all, in percent."""
    done = bars.select("ticker").distinct().withColumn("_done", F.lit(1))
    joined = universe.select("ticker").distinct().join(done, "ticker", "left")
    counted = joined.agg(
        F.count(F.lit(1)).alias("total_tickers"), F.count("_done").alias("completed_tickers")
    )
    return counted.select(
        progress_pct(F.col("completed_tickers"), F.col("total_tickers")).alias("progress_percent"),
        "completed_tickers",
        "total_tickers",
    )


def in_display_order(df: DataFrame) -> DataFrame:
    return df.orderBy("ticker", display_rank(F.col("interval")), "interval")
