"""Universe snapshots as validity ranges, and what was valid at a time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators.spread import lookup_join

KEY = ("category", "ticker")


def validity(snapshots: DataFrame, attributes: Sequence[str]) -> DataFrame:
    """Ranges of (category, ticker) entries out of successive snapshots (category, created_at, ticker, attributes).

    An entry is valid from the snapshot that first shows it, or shows it changed, until the next snapshot of its category
    that lacks it or shows it otherwise; valid_to is null for what the last snapshot holds. `change` says how a range began
    (added, changed) and `ended` how it ended (dropped, changed, null). Equal entries of a snapshot count once; of several
    the least by its attributes stays.
    """
    known = snapshots.where(F.col("ticker").isNotNull() & (F.col("ticker") != "") & F.col("created_at").isNotNull())
    held = known.groupBy(*KEY, "created_at").agg(F.min(F.struct(*attributes)).alias("_held"))
    # A row per snapshot of a category.
    times = snapshots.select("category", "created_at").where("created_at IS NOT NULL").distinct()
    after = F.lead("created_at").over(W.partitionBy("category").orderBy("created_at"))
    times = times.withColumn("_next", after)
    rows = held.join(times, ["category", "created_at"])
    own = W.partitionBy(*KEY).orderBy("created_at")
    last = F.lag(F.struct("_held", "_next")).over(own)
    rows = rows.withColumn("_last", last)
    follows = F.coalesce(F.col("_last._next") == F.col("created_at"), F.lit(False))
    same = follows & F.col("_last._held").eqNullSafe(F.col("_held"))
    rows = rows.withColumns({"_begins": ~same, "change": F.when(follows, "changed").otherwise("added")})
    rows = rows.withColumn("_range", F.sum(F.col("_begins").cast("int")).over(own))
    ranges = rows.groupBy(*KEY, "_range").agg(
        F.min("created_at").alias("valid_from"),
        F.max_by("_next", "created_at").alias("valid_to"),
        F.min_by("change", "created_at").alias("change"),
        F.first("_held").alias("_held"),
    )
    follower = F.lead("valid_from").over(W.partitionBy(*KEY).orderBy("_range"))
    ended = F.when(F.col("valid_to").isNotNull(), F.when(follower == F.col("valid_to"), "changed").otherwise("dropped"))
    return ranges.withColumn("ended", ended).select(*KEY, *[F.col(f"_held.{a}").alias(a) for a in attributes], "valid_from", "valid_to", "change", "ended")


def as_of(rows: DataFrame, ranges: DataFrame, at: str, on: Sequence[str] = ("ticker",), how: str = "left") -> DataFrame:
    """Rows with the attributes that were valid at their time `at`, from `validity` ranges; null where none was.

    An equi-join on the key of which a hot one is split (see `lookup_join`); the times decide among the few ranges of a key.
    """
    names = [c for c in ranges.columns if c not in on]
    clash = set(names) & set(rows.columns)
    if clash:
        raise ValueError(f"columns on both sides: {', '.join(sorted(clash))}")
    # All ranges of a key in one row, as an array: a row then meets its key once, and stays one row.
    listed = ranges.groupBy(*on).agg(F.collect_list(F.struct(*names)).alias("_ranges"))
    joined = lookup_join(rows, listed, on, "left")

    def valid(r: Column) -> Column:
        return (r["valid_from"] <= F.col(at)) & (r["valid_to"].isNull() | (F.col(at) < r["valid_to"]))

    joined = joined.withColumn("_found", F.filter("_ranges", valid)).drop("_ranges")
    pick = F.explode if how == "inner" else F.explode_outer
    return joined.select(*rows.columns, pick("_found").alias("_one")).select(*rows.columns, *[F.col(f"_one.{n}").alias(n) for n in names])
