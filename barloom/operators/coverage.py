"""What a series holds as sets of ranges, and the difference of two such sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.intervals import VOCABULARY, by_label
from barloom.schemas import SERIES_KEY, period_of

# Longest step between two bars that follow one another, of intervals without a fixed width.
CALENDAR_DAYS = {"week": 7, "month": 31, "quarter": 92, "year": 366}


def bar_step(interval: Column) -> Column:
    """Longest time in micros from a bar to the next one of its interval."""
    steps = {}
    for i in VOCABULARY.values():
        steps[i.label] = (i.seconds or CALENDAR_DAYS[i.trunc_unit] * 86400) * 1_000_000
    return by_label(interval, steps)


def islands(bars: DataFrame, slack: int = 1, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Ranges (keys, first_timestamp, last_timestamp, bars) of bars that follow one another.

    A gap of more than `slack` steps of the interval parts two ranges. Runs are found inside each storage period first,
    which is a shuffle by (series, period), then joined across periods: a series of many bars is in no single task, only
    its few ranges are.
    """
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    step = bar_step(F.col("interval")) * F.lit(slack)
    own = bars.where("timestamp IS NOT NULL").select(*keys, "timestamp", period_of(F.col("interval"), F.col("timestamp")).alias("_period"))
    within = W.partitionBy(*keys, "_period").orderBy("timestamp")
    apart = F.coalesce(micros - F.lag(micros).over(within) > step, F.lit(True))
    runs = own.withColumn("_apart", apart.cast("int")).withColumn("_run", F.sum("_apart").over(within))
    runs = runs.groupBy(*keys, "_period", "_run").agg(
        F.min("timestamp").alias("first_timestamp"), F.max("timestamp").alias("last_timestamp"), F.count(F.lit(1)).alias("bars")
    )
    return _joined(runs, keys, slack)


def _joined(runs: DataFrame, keys: Sequence[str], slack: int) -> DataFrame:
    first, last = (F.unix_micros(F.col(c).cast("timestamp")) for c in ("first_timestamp", "last_timestamp"))
    order = W.partitionBy(*keys).orderBy("first_timestamp")
    apart = F.coalesce(first - F.lag(last).over(order) > bar_step(F.col("interval")) * F.lit(slack), F.lit(True))
    numbered = runs.withColumn("_apart", apart.cast("int")).withColumn("_island", F.sum("_apart").over(order))
    return numbered.groupBy(*keys, "_island").agg(
        F.min("first_timestamp").alias("first_timestamp"), F.max("last_timestamp").alias("last_timestamp"), F.sum("bars").alias("bars")
    ).drop("_island")


def subtract(wanted: DataFrame, held: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Ranges (keys, start, stop) of `wanted` that `held` does not cover; both are sets of half-open ranges (keys, start, stop).

    A sweep over the boundaries of both: ranges of a side may overlap, empty ones do not count. A row per boundary and key,
    no row per day.
    """

    def edges(ranges: DataFrame, name: str) -> DataFrame:
        kept = ranges.where(F.col("start") < F.col("stop"))
        ends = [kept.select(*keys, F.col(c).alias("at"), F.lit(by).alias(name)) for c, by in (("start", 1), ("stop", -1))]
        return ends[0].unionByName(ends[1])

    both = edges(wanted, "_wanted").unionByName(edges(held, "_held"), allowMissingColumns=True)
    steps = both.groupBy(*keys, "at").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_wanted", "_held")])
    order = W.partitionBy(*keys).orderBy("at")
    swept = steps.select(
        *keys,
        F.col("at").alias("start"),
        F.lead("at").over(order).alias("stop"),
        *[F.sum(c).over(order.rowsBetween(W.unboundedPreceding, 0)).alias(c) for c in ("_wanted", "_held")],
    )
    open_ = swept.where((F.col("_wanted") > 0) & (F.col("_held") == 0) & F.col("stop").isNotNull())
    # Pieces that touch are one range: a boundary of `held` that ends where another begins leaves none between.
    new = F.coalesce(F.lag("stop").over(W.partitionBy(*keys).orderBy("start")) != F.col("start"), F.lit(True))
    joined = open_.withColumn("_new", new.cast("int"))
    joined = joined.withColumn("_range", F.sum("_new").over(W.partitionBy(*keys).orderBy("start")))
    return joined.groupBy(*keys, "_range").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("_range")


def fetch_ranges(ranges: DataFrame, bars: DataFrame, slack: int = 1) -> DataFrame:
    """Ranges (ticker, interval, start, stop) that the provider offers and the store lacks, inner gaps among them.

    `ranges` holds start_date and end_date per series, both days included. A stored run covers from its first bar to a step
    behind its last.
    """
    offered = ranges.where("end_date IS NOT NULL").select(
        *SERIES_KEY,
        F.coalesce("start_date", F.lit("1970-01-01").cast("date")).cast("timestamp_ntz").alias("start"),
        F.date_add("end_date", 1).cast("timestamp_ntz").alias("stop"),
    )
    micros = F.unix_micros(F.col("last_timestamp").cast("timestamp")) + bar_step(F.col("interval"))
    held = islands(bars, slack).select(
        *SERIES_KEY, F.col("first_timestamp").alias("start"), F.timestamp_micros(micros).cast("timestamp_ntz").alias("stop")
    )
    return subtract(offered, held.join(offered.select(*SERIES_KEY).distinct(), list(SERIES_KEY), "left_semi"))
