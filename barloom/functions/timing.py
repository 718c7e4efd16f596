"""Resume points, days behind, ages and bar estimates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.functions.intervals import VOCABULARY, by_label, in_family

# Bars per trading day in the range form of the estimate.
RANGE_BARS_PER_DAY = {"1d": 1.0, "1h": 6.5, "15m": 26.0, "5m": 78.0, "1m": 390.0}
TRADING_HOURS_PER_DAY = 6.5
TRADING_MINUTES_PER_DAY = 390
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 24 * MICROS_PER_HOUR


def micros(ts: Column) -> Column:
    """Epoch micros of a date or timestamp (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp"))


def whole_days(later: Column, earlier: Column) -> Column:
    """Whole days between two moments, floored (so negative spans round down)."""
    span = micros(later) - micros(earlier)
    day = F.lit(MICROS_PER_DAY)
    return ((span - F.pmod(span, day)) / day).cast("bigint")


def age_hours(as_of: Column, moment: Column) -> Column:
    return (micros(as_of) - micros(moment)) / F.lit(float(MICROS_PER_HOUR))


def days_behind(api_end: Column, last_local: Column) -> Column:
    """Days from the last stored bar to midnight of the provider's end date, floored."""
    return whole_days(api_end.cast("date"), last_local)


def lag_class(behind: Column) -> Column:
    return (
        F.when(behind.isNull(), "missing")
        .when(behind <= 0, "up_to_date")
        .when(behind == 1, "recent_update")
        .otherwise("significant_update")
    )


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end.cast("date"), start.cast("date")).cast("bigint")


def resume_point(interval: Column, last: Column) -> Column:
    """Where a series resumes: one unit later, cut to a date except for seconds.

    The step follows the unit only: a 5-minute series also resumes one minute on.
    """

    def step(spec: str) -> Column:
        return last + F.expr(f"INTERVAL {spec}")

    moved = (
        F.when(in_family(interval, "second"), step("'1' SECOND"))
        .when(in_family(interval, "minute"), step("'1' MINUTE"))
        .when(in_family(interval, "hour"), step("'1' HOUR"))
        .when(in_family(interval, "week"), step("'7' DAY"))
        .when(in_family(interval, "month"), step("'31' DAY"))
        .when(in_family(interval, "quarter"), step("'91' DAY"))
        .when(in_family(interval, "year"), step("'365' DAY"))
        .otherwise(step("'1' DAY"))
    )
    whole = moved.cast("date").cast("timestamp_ntz")
    return F.when(in_family(interval, "second"), moved).otherwise(whole)


def is_past(resume: Column, end_date: Column) -> Column:
    """True when nothing is left to fetch: the resume point lies after the end day."""
    return resume >= F.date_add(end_date.cast("date"), 1).cast("timestamp_ntz")


def range_estimate(interval: Column, days: Column) -> Column:
    """Bars expected in a range, by trading hours (5 labels, others one a day)."""
    rate = F.coalesce(by_label(interval, RANGE_BARS_PER_DAY), F.lit(1.0))
    return (days * rate).cast("bigint")


def probe_estimate(interval: Column, days: Column) -> Column:
    """Bars expected by the availability probe: hours ignore the multiplier, minutes divide by it."""
    minutes = by_label(interval, {i.label: i.n for i in VOCABULARY.values() if i.unit == "minute"})
    return (
        F.when(in_family(interval, "hour"), (days * F.lit(TRADING_HOURS_PER_DAY)).cast("bigint"))
        .when(in_family(interval, "minute"), F.floor(days * F.lit(TRADING_MINUTES_PER_DAY) / minutes).cast("bigint"))
        .otherwise(days.cast("bigint"))
    )
