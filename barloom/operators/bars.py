"""Bars from ticks, coarser bars from finer ones, many intervals in one job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.intervals import (
    DAY_FILE_LABELS,
    INTRADAY_LABELS,
    LABELS,
    Interval,
    bin_start,
    can_roll_up,
    common_width,
    interval_of,
    width_bin,
)
from barloom.operators.spread import forget_partitioning, packed_order

PRICE_COLUMNS = ("open", "high", "low", "close")
# Size traded at known prices: what a vwap weighs by. Kept only while bars are to be rolled up.
PRICED = "priced_volume"


def tick_order(timestamp: Column, seq: Column | None) -> Column:
    """Scalar that orders ticks by time and, where times tie, by a sequence number."""
    if seq is None:
        return timestamp
    return packed_order(F.unix_micros(timestamp.cast("timestamp")), seq)


def with_known_price(ticks: DataFrame) -> DataFrame:
    """NaN prices become null, once per row and not once per aggregate."""
    return ticks.withColumn("price", F.nanvl(F.col("price"), F.lit(None).cast("double")))


def tick_aggregates(has_size: bool, tie_break: str | None, extended: bool) -> list[Column]:
    """First, highest, lowest and last known price of a bin and its volume.

    Null prices are passed over; sizes count even where the price is unknown, and
    unknown sizes count as zero.
    """
    price = F.col("price")
    order = F.when(price.isNotNull(), tick_order(F.col("timestamp"), F.col(tie_break) if tie_break else None))
    out = [
        F.min_by(price, order).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, order).alias("close"),
    ]
    if has_size:
        out.append(F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("volume"))
    if extended:
        if has_size:
            weight = F.when(price.isNotNull(), F.col("size"))
            out.append((F.sum(price * weight) / F.nullif(F.sum(weight), F.lit(0))).alias("vwap"))
            out.append(F.coalesce(F.sum(weight), F.lit(0)).cast("bigint").alias(PRICED))
        out.append(F.count(price).alias("transactions"))
    return out


def drop_incomplete(bars: DataFrame) -> DataFrame:
    """Drop bars with an unknown open, high, low, close or volume, and what only a roll-up needs."""
    return bars.dropna(subset=[c for c in (*PRICE_COLUMNS, "volume") if c in bars.columns]).drop(PRICED)


def bars_from_ticks(
    ticks: DataFrame,
    label: str,
    tie_break: str | None = None,
    extended: bool = False,
    keys: Sequence[str] = ("ticker",),
    allowed: Iterable[str] = LABELS,
    complete: bool = True,
) -> DataFrame:
    """OHLC(V) bars per key and bin.

    Bars without a known price are dropped. `complete=False` keeps them, with their volume and the size that a vwap
    weighs by, for a later exact `roll_up`.

    Without `tie_break` the timestamps of a key must be distinct. Both forms are
    hash aggregates with a partial step before the one shuffle, so a hot ticker
    arrives already reduced to its bins.
    """
    interval = interval_of(label, allowed)
    binned = with_known_price(ticks).withColumn("_bin", bin_start("timestamp", interval))
    bars = binned.groupBy(*keys, F.col("_bin").alias("timestamp")).agg(
        *tick_aggregates("size" in ticks.columns, tie_break, extended)
    )
    bars = drop_incomplete(bars) if complete else bars
    return bars.select(*keys, F.lit(label).alias("interval"), *[c for c in bars.columns if c not in keys])


def day_file_bars(ticks: DataFrame, label: str, tie_break: str | None = "seq") -> DataFrame:
    """Bars of day files: five intervals, and the size column is required."""
    if "size" not in ticks.columns:
        raise ValueError("day files need a size column")
    return bars_from_ticks(ticks, label, tie_break, allowed=DAY_FILE_LABELS)


def intraday_bars(ticks: DataFrame, label: str, tie_break: str | None = "seq") -> DataFrame:
    """Bars of the 19 intraday intervals; volume only when sizes are known."""
    return bars_from_ticks(ticks, label, tie_break, allowed=INTRADAY_LABELS)


def roll_aggregates(columns: Iterable[str]) -> list[Column]:
    """Combine finer bars: first known open, highest high, lowest low, last known close, summed counts.

    A vwap weighs by the size traded at known prices where the bars carry it, else by the volume.
    """
    columns = set(columns)
    at = F.when(F.col("open").isNotNull(), F.col("timestamp"))
    out = [
        F.min_by("open", at).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("timestamp"))).alias("close"),
    ]
    if "volume" in columns:
        out.append(F.sum("volume").alias("volume"))
    if {"vwap", "volume"} <= columns:
        weight = F.when(F.col("vwap").isNotNull(), F.col(PRICED if PRICED in columns else "volume"))
        out.append((F.sum(F.col("vwap") * weight) / F.nullif(F.sum(weight), F.lit(0))).alias("vwap"))
    if PRICED in columns:
        out.append(F.sum(PRICED).alias(PRICED))
    if "transactions" in columns:
        out.append(F.sum("transactions").alias("transactions"))
    return out


def roll_up(
    bars: DataFrame, source: str, target: str, keys: Sequence[str] = ("ticker",), extra: Sequence[Column] = ()
) -> DataFrame:
    """Coarser bars from the bars of one finer interval, with the `extra` aggregates of them.

    From bars kept with `complete=False` the result is that of the ticks. From stored bars, which lack bins without a
    known price, it lacks their volume too.
    """
    src, dst = interval_of(source), interval_of(target)
    if not can_roll_up(src, dst):
        raise ValueError(f"{source} bars do not nest in {target} bars")
    fine = bars.where(F.col("interval") == source).withColumn("_bin", bin_start("timestamp", dst))
    coarse = fine.groupBy(*keys, "_bin").agg(*roll_aggregates(bars.columns), *extra)
    coarse = drop_incomplete(coarse) if PRICED in coarse.columns else coarse.dropna(subset=["open"])
    rest = [c for c in coarse.columns if c not in (*keys, "_bin")]
    return coarse.select(*keys, F.lit(target).alias("interval"), F.col("_bin").alias("timestamp"), *rest)


def bars_for_intervals(
    ticks: DataFrame, labels: Iterable[str], tie_break: str | None = None, extended: bool = False
) -> DataFrame:
    """Bars of many intervals from one scan of the ticks.

    1. Ticks become bars of the widest bin that divides every requested interval.
       That shuffle is keyed by (ticker, bin), so a hot ticker spreads over its bins.
    2. Those bars move once by (ticker, day). A group holds at most one day of
       base bins whatever the number of ticks, and every interval up to a day is
       an aggregate within that partitioning: no further shuffle, all branches
       read the same exchange.
    3. Where seconds are asked for beside wider intervals, the wider ones read a
       second, up to sixty times smaller exchange of minute-sized bars.
    4. Week and longer bars roll up from the daily ones.

    Bins without a known price are dropped only from the finished bars: until then their volume counts.
    """
    wanted = [interval_of(label) for label in dict.fromkeys(labels)]
    width = common_width(wanted)
    base = with_known_price(ticks).withColumn("_bin", width_bin("timestamp", width))
    base = base.groupBy("ticker", F.col("_bin").alias("timestamp")).agg(
        *tick_aggregates("size" in ticks.columns, tie_break, extended)
    )
    by_day = base.withColumn("day", F.col("timestamp").cast("date")).repartition("ticker", "day")

    seconds = [i for i in wanted if i.unit == "second"]
    wider = [i for i in wanted if i.unit != "second"]
    branches = [_bars_within_days(by_day, i, width) for i in seconds]
    if seconds and wider:
        finer, width = width, common_width(wider)
        minutes = _within_days(by_day, width, finer)
        by_day = forget_partitioning(minutes, "ticker").repartition("ticker", "day")
    branches += [_bars_within_days(by_day, i, width) for i in wider if i.seconds is not None]
    calendar = [i for i in wider if i.seconds is None]
    if calendar:
        daily = _bars_within_days(by_day, interval_of("1d"), width, complete=False)
        branches += [roll_up(daily, "1d", i.label) for i in calendar]
    return reduce(DataFrame.unionByName, branches)


def _within_days(by_day: DataFrame, width: int, base_width: int) -> DataFrame:
    """Bars of a wider bin inside the (ticker, day) partitioning, same columns."""
    if width == base_width:
        return by_day
    values = [c for c in by_day.columns if c not in ("ticker", "day", "timestamp")]
    binned = by_day.withColumn("_bin", width_bin("timestamp", width))
    bars = binned.groupBy("ticker", "day", "_bin").agg(*roll_aggregates(values))
    return bars.select("ticker", F.col("_bin").alias("timestamp"), *values, "day")


def _bars_within_days(by_day: DataFrame, interval: Interval, base_width: int, complete: bool = True) -> DataFrame:
    bars = _within_days(by_day, interval.seconds, base_width)
    if complete:
        if interval.seconds == base_width:
            # `inline` keeps the null filter above the exchange, which the other branches read too.
            held = [c for c in bars.columns if c not in ("ticker", "day")]
            bars = bars.select("ticker", "day", F.inline(F.array(F.struct(*held))))
        bars = drop_incomplete(bars)
    values = [c for c in bars.columns if c not in ("ticker", "day", "timestamp")]
    return bars.select("ticker", F.lit(interval.label).alias("interval"), "timestamp", *values)
