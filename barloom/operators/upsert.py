"""Merging: keep last or first per key, upserts, temporal split and hybrid series."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.classify import ASSET_TYPES, normal_ticker
from barloom.functions.intervals import Interval, interval_of
from barloom.operators.bars import bars_for_intervals
from barloom.operators.spread import packed_order
from barloom.schemas import BAR_KEY, SERIES_KEY

FIXED_WIDTH = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
# An asset type is carried through hash aggregates as a number: short text has room in a decimal.
MOST_TYPE_BYTES = 15
HALF = 2 ** (4 * MOST_TYPE_BYTES)
# Age in days at which history gives way to recent data.
HISTORY_DAYS = 30


def _lowest(kind: T.DataType) -> Column | None:
    """Least value of an order column, None when its type cannot order a hash aggregate."""
    if isinstance(kind, T.DecimalType):
        return F.lit("-" + "9" * (kind.precision - kind.scale)).cast(kind)
    bits = {T.IntegerType: 31, T.LongType: 63}.get(type(kind))
    return None if bits is None else F.lit(-(2**bits)).cast(kind)


def packed_text(text: Column) -> Column:
    """Text of at most MOST_TYPE_BYTES bytes as a number; the common asset types, which are most rows, at no cost."""
    digits = F.lpad(F.hex(text.cast("binary")), 2 * MOST_TYPE_BYTES, "0")
    high, low = (F.conv(F.substring(digits, k, MOST_TYPE_BYTES), 16, 10).cast("decimal(19,0)") for k in (1, MOST_TYPE_BYTES + 1))
    out = F.lit(None).cast("decimal(38,0)")
    for k, known in enumerate(ASSET_TYPES):
        out = (F.when if k == 0 else out.when)(text == known, F.lit(-1 - k).cast("decimal(38,0)"))
    return out.when(text.isNotNull(), (high * F.lit(HALF).cast("decimal(19,0)")).cast("decimal(38,0)") + low).cast("decimal(38,0)")


def unpacked_text(number: Column) -> Column:
    half = F.lit(HALF).cast("decimal(19,0)")
    halves = [F.call_function("div", number, half), (number % half).cast("bigint")]
    digits = F.concat(*[F.lpad(F.hex(h), MOST_TYPE_BYTES, "0") for h in halves])
    text = F.decode(F.unhex(F.regexp_replace(digits, "^(00)+", "")), "UTF-8")
    for k, known in enumerate(ASSET_TYPES):
        text = F.when(number == -1 - k, known).otherwise(text)
    return text


def keep_one(df: DataFrame, keys: Sequence[str], order: str, keep: str = "last") -> DataFrame:
    """One row per key: the one with the highest (`last`) or lowest (`first`) order value.

    `order` should be distinct within a key; an unknown order comes lowest. When
    all other columns have a fixed width, or are asset types, this is a hash aggregate with a partial
    step; otherwise a window whose rank-one filter Spark also applies before the
    shuffle. Either way copies of a key are dropped where they are read.
    """
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last' or 'first', not {keep!r}")
    values = [c for c in df.columns if c not in keys and c != order]
    text = [c for c in values if c == "asset_type"]
    lowest = _lowest(df.schema[order].dataType)
    if lowest is not None and all(isinstance(df.schema[c].dataType, FIXED_WIDTH) or c in text for c in values):
        # max_by and min_by would pass over rows without an order
        known = F.coalesce(F.col(order), lowest)
        pick = F.max_by if keep == "last" else F.min_by
        held = {c: packed_text(F.col(c)) if c in text else F.col(c) for c in (*values, order)}
        picked = df.groupBy(*keys).agg(*[pick(v, known).alias(c) for c, v in held.items()])
        return picked.select(*[unpacked_text(F.col(c)).alias(c) if c in text else c for c in df.columns])
    direction = F.col(order).desc() if keep == "last" else F.col(order).asc()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(direction))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def combine(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Both sides by column name, columns of one side only become null; `_side` is 0 or 1."""
    return existing.withColumn("_side", F.lit(0)).unionByName(
        new.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )


def _keys_in(df: DataFrame) -> list[str]:
    return [k for k in BAR_KEY if k in df.columns]


def upsert_bars(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str] | None = None,
    keep: str = "last",
    seq: str | None = None,
) -> DataFrame:
    """Union of stored and new bars with one bar per key; a new bar replaces a stored one.

    Within a side, `seq` decides between duplicates; without it a side must hold
    each key once.
    """
    both = combine(existing, new)
    if seq is None:
        merged = keep_one(both, keys or _keys_in(both), "_side", keep)
        return merged.drop("_side")
    ranked = both.withColumn("_order", packed_order(F.col("_side"), F.col(seq))).drop("_side")
    return keep_one(ranked, keys or _keys_in(both), "_order", keep).drop("_order")


def append_first(
    existing: DataFrame, found: DataFrame, key: str = "ticker", order: Sequence[str] = (), within: Sequence[str] = ()
) -> DataFrame:
    """Universe append: existing entries win, entries without a key are dropped.

    Duplicates within a side are decided by `order`, lowest first. A key counts once in each group of `within`.
    """
    both = combine(existing, found).where(F.col(key).isNotNull() & (F.col(key) != ""))
    rank = F.row_number().over(W.partitionBy(*within, key).orderBy("_side", *order))
    return both.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_side")


def count_new(existing: DataFrame, found: DataFrame, key: str = "ticker") -> DataFrame:
    """Totals of an append: count, existing_count, new_tickers_added."""
    sides = combine(existing.select(key), found.select(key))
    known = F.col(key).isNotNull() & (F.col(key) != "")
    per_key = sides.groupBy(key).agg(F.sum(F.when(F.col("_side") == 0, 1).otherwise(0)).alias("_stored"))
    totals = per_key.agg(
        F.count_if(known).alias("count"), F.coalesce(F.sum("_stored"), F.lit(0)).cast("bigint").alias("existing_count")
    )
    return totals.withColumn("new_tickers_added", F.col("count") - F.col("existing_count"))


def cutoff_date(as_of: date, days: int = HISTORY_DAYS) -> date:
    return as_of - timedelta(days=days)


def history_part(ts: Column, start: date, end: date, cutoff: date) -> Column:
    """start .. min(end, cutoff), empty unless the range starts before the cutoff."""
    if start >= cutoff:
        return F.lit(False)
    return _within_days(ts, start, min(end, cutoff))


def recent_part(ts: Column, start: date, end: date, cutoff: date) -> Column:
    """max(start, cutoff) .. end, empty unless the range ends on or after the cutoff."""
    if end < cutoff:
        return F.lit(False)
    return _within_days(ts, max(start, cutoff), end)


def _within_days(ts: Column, first: date, last: date) -> Column:
    after = F.lit(last + timedelta(days=1)).cast("timestamp_ntz")
    return (ts >= F.lit(first).cast("timestamp_ntz")) & (ts < after)


def first_bin_day(day: date, interval: Interval) -> date:
    """First day of the bin of a day; the day itself for intervals up to a day."""
    if interval.seconds is not None:
        return day
    if interval.trunc_unit == "week":
        return day - timedelta(days=day.weekday())
    months = {"month": 1, "quarter": 3, "year": 12}[interval.trunc_unit]
    return date(day.year, (day.month - 1) // months * months + 1, 1)


def last_bin_day(day: date, interval: Interval) -> date:
    """Last day of the bin of a day."""
    if interval.seconds is not None:
        return day
    longest = {"week": 7, "month": 31, "quarter": 92, "year": 366}[interval.trunc_unit]
    return first_bin_day(first_bin_day(day, interval) + timedelta(days=longest), interval) - timedelta(days=1)


def hybrid_series(
    ticks: DataFrame,
    recent_bars: DataFrame,
    labels: Iterable[str],
    start: date,
    end: date,
    cutoff: date,
    tie_break: str | None = None,
) -> DataFrame:
    """History built from ticks, recent bars from the provider, recent winning.

    The bin of the cutoff day is in both parts. Both sides hold whole bins: where weeks or longer reach over the
    start, the cutoff or the end, ticks of the whole bin are read and the provider's bar of that bin counts as
    recent. A bar's identity is (ticker, interval, timestamp), tickers upper-cased, so stored bars with an asset type fit too.
    """
    wanted = [interval_of(label) for label in labels]
    stop = min(end, cutoff)
    history = None
    if start < cutoff:
        first, last = min(first_bin_day(start, i) for i in wanted), max(last_bin_day(stop, i) for i in wanted)
        history = bars_for_intervals(ticks.where(_within_days(F.col("timestamp"), first, last)), [i.label for i in wanted], tie_break)
        history = history.where(_by_interval(wanted, lambda i: _within_days(F.col("timestamp"), first_bin_day(start, i), stop)))
    if end < cutoff:
        recent = recent_bars.where(F.lit(False))
    else:
        begin = max(start, cutoff)
        recent = recent_bars.where(_by_interval(wanted, lambda i: _within_days(F.col("timestamp"), first_bin_day(begin, i), end)))
    sides = [side.withColumn("ticker", normal_ticker(F.col("ticker"))) for side in (history, recent) if side is not None]
    return upsert_bars(*sides, keys=(*SERIES_KEY, "timestamp")) if len(sides) == 2 else sides[0]


def _by_interval(wanted: Sequence[Interval], rule: Callable[[Interval], Column]) -> Column:
    kept = F.lit(False)
    for interval in wanted:
        kept = kept | ((F.col("interval") == interval.label) & rule(interval))
    return kept


def head_tail(bars: DataFrame, n: int = 5, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """First and last n bars of every series, by time.

    Two windows, so that Spark limits each to n rows per series before the shuffle.
    """

    def edge(name: str, order: Column) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*keys).orderBy(order))
        return bars.withColumn("position", rank).where(F.col("position") <= n).withColumn("edge", F.lit(name))

    return edge("first", F.col("timestamp").asc()).unionByName(edge("last", F.col("timestamp").desc()))
