"""The interval vocabulary and the bin a timestamp falls into."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Unit, label suffix and the multipliers in use. Case matters
# (1m is a minute, 1M a month).
UNITS = (
    ("second", "s", (1, 5, 10, 30)),
    ("minute", "m", (1, 2, 3, 5, 10, 15, 30, 45)),
    ("hour", "h", (1, 2, 3, 4, 6, 8, 12)),
    ("day", "d", (1,)),
    ("week", "w", (1,)),
    ("month", "M", (1, 3)),
    ("quarter", "Q", (1,)),
    ("year", "Y", (1,)),
)
UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
UNIT_FAMILY = {"second": "seconds", "minute": "intraday", "hour": "hourly"}
DISPLAY_ORDER = ("1s", "1m", "5m", "15m", "30m", "1h", "1d", "1w", "1M", "3M", "1Q", "1Y")
UNKNOWN_ORDER = 999
EPOCH = "1970-01-01 00:00:00"

DAY_FILE_LABELS = ("1m", "5m", "15m", "1h", "1d")
DEFAULT_LABELS = ("1d", "1h", "15m", "5m", "1m")


@dataclass(frozen=True)
class Interval:
    label: str
    unit: str
    n: int
    position: int

    @property
    def family(self) -> str:
        return UNIT_FAMILY.get(self.unit, "daily")

    @property
    def seconds(self) -> int | None:
        """Width in seconds, None for calendar units."""
        width = UNIT_SECONDS.get(self.unit)
        return None if width is None else width * self.n

    @property
    def trunc_unit(self) -> str | None:
        """Calendar unit to truncate a date to, None for fixed widths."""
        if self.seconds is not None:
            return None
        return "quarter" if (self.unit, self.n) == ("month", 3) else self.unit


_rows = [(f"{n}{suffix}", unit, n) for unit, suffix, ns in UNITS for n in ns]
VOCABULARY = {label: Interval(label, unit, n, i) for i, (label, unit, n) in enumerate(_rows)}
LABELS = tuple(VOCABULARY)
INTRADAY_LABELS = tuple(i.label for i in VOCABULARY.values() if i.unit in UNIT_FAMILY)


def interval_of(label: str, allowed: Iterable[str] = LABELS) -> Interval:
    """Look up a label; an unknown or disallowed label is a ValueError."""
    allowed = tuple(allowed)
    if label not in VOCABULARY or label not in allowed:
        raise ValueError(f"unsupported interval {label!r}, expected one of {', '.join(allowed)}")
    return VOCABULARY[label]


def known_label(interval: Column) -> Column:
    """Whether a label is one of the vocabulary, as written."""
    return interval.isin(*LABELS)


def width_bin(ts: Column | str, seconds: int) -> Column:
    """Start of the epoch-aligned bin of a fixed width.

    `window` reinterprets the timestamp instead of converting it between zones,
    so it is cheaper than arithmetic on epoch micros and zone-free for NTZ. At
    most one window expression may stand in a projection. It drops rows without
    a time, so the default is never used; it tells Spark that bins are not null
    and spares plans over bins the null filters that would make them differ.
    """
    return F.coalesce(F.window(ts, f"{seconds} seconds")["start"], F.lit(EPOCH).cast("timestamp_ntz"))


def calendar_bin(ts: Column, unit: str) -> Column:
    """Start of the calendar bin (weeks start on Monday), zone-free."""
    return F.trunc(ts.cast("date"), unit).cast("timestamp_ntz")


def bin_start(ts: Column | str, interval: Interval) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    if interval.seconds is not None:
        return width_bin(ts, interval.seconds)
    return calendar_bin(ts, interval.trunc_unit)


def common_width(intervals: Iterable[Interval]) -> int:
    """Widest fixed width that divides every given interval (calendar ones count as a day)."""
    return reduce(gcd, [i.seconds or UNIT_SECONDS["day"] for i in intervals])


def can_roll_up(source: Interval, target: Interval) -> bool:
    """True when every source bin lies inside one target bin."""
    if source.label == target.label:
        return True
    if source.seconds is not None:
        if target.seconds is not None:
            return target.seconds % source.seconds == 0
        return UNIT_SECONDS["day"] % source.seconds == 0
    rank = {"month": 1, "quarter": 2, "year": 3}
    s, t = rank.get(source.trunc_unit), rank.get(target.trunc_unit)
    return s is not None and t is not None and s <= t


def vocabulary_frame(spark: SparkSession) -> DataFrame:
    """The 25 labels as a table: interval, unit, n, family, sort_key, display_order."""
    rows = [
        (
            i.label,
            i.unit,
            i.n,
            i.family,
            i.position,
            DISPLAY_ORDER.index(i.label) if i.label in DISPLAY_ORDER else UNKNOWN_ORDER,
        )
        for i in VOCABULARY.values()
    ]
    schema = "interval string, unit string, n int, family string, sort_key int, display_order int"
    return spark.createDataFrame(rows, schema)


def in_family(interval: Column, *units: str) -> Column:
    """True when the label belongs to one of the units."""
    return interval.isin(*[i.label for i in VOCABULARY.values() if i.unit in units])


def by_label(interval: Column, table: dict[str, int | float]) -> Column:
    """Value of a label in a small constant table, null when it has none."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), interval)


def display_rank(interval: Column) -> Column:
    """Position in the display order, unknown labels last."""
    table = {label: rank for rank, label in enumerate(DISPLAY_ORDER)}
    return F.coalesce(by_label(interval, table), F.lit(UNKNOWN_ORDER))
