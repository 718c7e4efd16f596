"""Symbols and intervals out of file names, and dates into folder names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def symbol_of(path: Column) -> Column:
    """Name up to the first dot; null when the name has no dot."""
    return F.nullif(F.regexp_extract(file_name(path), r"^([^.]*)\.", 1), F.lit(""))


def stem_of(path: Column) -> Column:
    """Name without its last extension."""
    return F.regexp_replace(file_name(path), r"\.[^.]*$", "")


def interval_in(path: Column) -> Column:
    """Interval part of `TICKER.interval.ext`."""
    return F.element_at(F.split(stem_of(path), r"\."), -1)


def day_folder(day: Column) -> Column:
    return F.date_format(day, "yyyy/MM/dd")


def day_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def holds_keyword(keywords: tuple[str, ...], *columns: Column) -> Column:
    """True when a keyword occurs in any column, case ignored."""
    found = F.lit(False)
    for column in columns:
        for word in keywords:
            found = found | F.upper(F.coalesce(column, F.lit(""))).contains(word)
    return found
