"""Byte sizes, ratios and percentages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BYTE_UNITS = ("B", "KB", "MB", "GB", "TB", "PB")


def _div(a: Column, b: Column | int) -> Column:
    return F.call_function("div", a, F.lit(b))


def human_bytes(size: Column) -> Column:
    """Size with two decimals in the largest unit below 1024, at most PB.

    Formatting a double would round some ties up, so the hundredths are computed
    in whole numbers, an exact tie going to the even one.
    """
    value = size.cast("bigint")
    unit = F.when(value < 1024, F.lit(1).cast("bigint"))
    name = F.when(value < 1024, BYTE_UNITS[0])
    for power in range(1, len(BYTE_UNITS) - 1):
        below = value < 1024 ** (power + 1)
        unit, name = unit.when(below, F.lit(1024**power).cast("bigint")), name.when(below, BYTE_UNITS[power])
    unit, name = unit.otherwise(F.lit(1024 ** (len(BYTE_UNITS) - 1))), name.otherwise(BYTE_UNITS[-1])
    rest = (value % unit) * 100
    part = _div(rest, unit)
    round_up = F.when((rest % unit) * 2 + part % 2 > unit, 1).otherwise(0)
    hundredths = _div(value, unit) * 100 + part + round_up
    text = F.format_string("%d.%02d %s", _div(hundredths, 100), hundredths % 100, name)
    return F.when(size.isNotNull(), text)


def kilobytes(size: Column) -> Column:
    return size / F.lit(1024.0)


def megabytes(size: Column) -> Column:
    return size / F.lit(1024.0 * 1024.0)


def compression_ratio(uncompressed: Column, compressed: Column) -> Column:
    return F.when(compressed > 0, uncompressed / compressed).otherwise(F.lit(1.0))


def savings_pct(uncompressed: Column, compressed: Column) -> Column:
    return F.when(uncompressed > 0, (uncompressed - compressed) / uncompressed * 100).otherwise(F.lit(0.0))


def progress_pct(done: Column, total: Column) -> Column:
    return F.round(F.when(total > 0, done / total * 100).otherwise(F.lit(0.0)), 2)


def batch_count(total: Column, size: int) -> Column:
    return F.ceil(total / F.lit(size)).cast("bigint")
