"""Wider bars that changed finer bars touch, along the nesting of the intervals."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.intervals import bin_start, can_roll_up, interval_of
from barloom.operators.bars import roll_up
from barloom.operators.upsert import packed_text, unpacked_text

LONGEST_BIN = timedelta(days=367)


def nesting(source: str, labels: Iterable[str]) -> list[list[tuple[str, str]]]:
    """Levels of (finer, wider) labels: each wider label above the widest known one whose bins nest in its own.

    A label that no known one nests in is an error.
    """
    known = {interval_of(source).label: 0}
    levels: list[list[tuple[str, str]]] = []
    for wide in sorted((interval_of(label) for label in set(labels) - {source}), key=lambda i: i.position):
        finer = [f for f in map(interval_of, known) if can_roll_up(f, wide) and not can_roll_up(wide, f)]
        if not finer:
            raise ValueError(f"no interval of {', '.join(known)} nests in {wide.label}")
        parent = max(finer, key=lambda i: i.position).label
        known[wide.label] = known[parent] + 1
        while len(levels) < known[wide.label]:
            levels.append([])
        levels[known[parent]].append((parent, wide.label))
    return levels


def touched_bins(changed: DataFrame, label: str) -> DataFrame:
    """Distinct (ticker, timestamp) of the bins of an interval that the changed bars (ticker, timestamp) lie in."""
    return changed.select("ticker", bin_start("timestamp", interval_of(label)).alias("timestamp")).distinct()


def within_bins(rows: DataFrame, bins: DataFrame, label: str, first: datetime, last: datetime) -> DataFrame:
    """The rows (ticker, timestamp, ...) whose bin of the interval is listed.

    The first and the last listed bin prune what is read; of the rest the bin itself decides.
    """
    low, high, beyond = (F.lit(t.isoformat()).cast("timestamp_ntz") for t in (first, last, last + LONGEST_BIN))
    near = rows.where((F.col("timestamp") >= low) & (F.col("timestamp") < beyond))
    near = near.withColumn("_own", bin_start("timestamp", interval_of(label))).where(F.col("_own") <= high)
    listed = bins.select("ticker", F.col("timestamp").alias("_own"))
    return near.join(listed, ["ticker", "_own"], "left_semi").drop("_own")


def rebuilt(fine: DataFrame, bins: DataFrame, finer: str, label: str, first: datetime, last: datetime) -> DataFrame:
    """The touched bars of an interval from bars of a finer one, with the asset type of the last of these."""
    own = within_bins(fine.where(F.col("interval") == interval_of(finer).label), bins, label, first, last)
    kind = F.max_by(packed_text(F.col("asset_type")), F.col("timestamp")).alias("asset_type")
    return roll_up(own, finer, label, extra=[kind]).withColumn("asset_type", unpacked_text(F.col("asset_type")))
