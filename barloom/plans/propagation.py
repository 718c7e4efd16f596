"""Bring the wider bars of the store up to date after finer ones have changed."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.dirty import nesting, rebuilt, touched_bins
from barloom.operators.query import from_day
from barloom.operators.upsert import upsert_bars
from barloom.schemas import BARS
from barloom.session import ensure_checkpoint_dir
from barloom.sources.store import merge_bars, read_bars, shape_bars


def propagate(spark: SparkSession, path: str, changed: DataFrame, source: str, labels: Iterable[str]) -> None:
    """Build again just the wider bars whose bin holds a changed bar (ticker, timestamp) of the `source` interval.

    Level by level, each from the widest finer interval there is, so a year is built of quarters and not of seconds: stored
    bars of the finer interval with those of the level before in their place. All levels are one merge. Bars of `source`
    must be in the store already; a replay changes nothing.
    """
    levels = nesting(source, labels)
    if not levels:
        return
    ensure_checkpoint_dir(spark)
    wide = [label for level in levels for _, label in level]
    bins = reduce(DataFrame.unionByName, [touched_bins(changed, label).withColumn("interval", F.lit(label)) for label in wide]).checkpoint()
    # A row per interval: where its touched bins begin and end.
    bounds = {r["interval"]: r for r in bins.groupBy("interval").agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).collect()}
    if not bounds:
        return
    stored, new, made = read_bars(spark, path).drop("bucket"), {}, []
    for level in levels:
        built = []
        for finer, label in level:
            fine = from_day(stored, bounds[label]["first"].date()).where(F.col("interval") == finer).select(*BARS.names)
            if finer in new:
                fine = upsert_bars(fine, new[finer].where(F.col("interval") == finer))
            own = bins.where(F.col("interval") == label).drop("interval")
            built.append(rebuilt(fine, own, finer, label, bounds[label]["first"], bounds[label]["last"]))
        made.append(shape_bars(reduce(DataFrame.unionByName, built)).checkpoint())
        new |= {label: made[-1] for _, label in level}
    merge_bars(spark, reduce(DataFrame.unionByName, made), path)
