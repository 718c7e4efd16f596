"""Joins, numbering and orders that stay cheap when one key holds much of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import ensure_checkpoint_dir

# Above this a lookup is not broadcast on our word; at some 100 bytes a row, 100 MB.
BROADCAST_ROWS = 1_000_000

# More than twice any 64-bit number. Times of the years 1 to 9999 in micros still
# fit a decimal(38,0) when multiplied by it.
SEQ_SPAN = "100000000000000000000"
LEAST_SEQ = str(-(2**63))

# Rows of bars that a task aggregates at once; at some 500 bytes a row in its hash tables, 125 MB.
TASK_ROWS = 250_000


def packed_order(major: Column, minor: Column) -> Column:
    """One number that orders by (major, minor), an unknown minor lowest, as in `keep_one`.

    A decimal is a mutable aggregation buffer and so keeps min_by and max_by hash
    aggregates; ordering by a struct would sort all rows.
    """
    scaled = (major.cast("decimal(18,0)") * F.lit(SEQ_SPAN).cast("decimal(21,0)")).cast("decimal(38,0)")
    return (scaled + F.coalesce(minor.cast("decimal(19,0)"), F.lit(LEAST_SEQ).cast("decimal(19,0)"))).cast("decimal(38,0)")


def lookup_join(
    rows: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left", lookup_rows: int | None = None
) -> DataFrame:
    """Join many rows to one lookup row per string key, whatever share a single key has.

    A lookup known to be small is broadcast. Otherwise Spark decides by measured
    size, and where both sides are shuffled AQE splits the partition of a hot key
    into even pieces. It can do so only where both inputs of the join are plain
    exchanges and nothing above needs the join's partitioning. Hence the join is on
    a hidden copy of the key: an aggregate by key after the join gets its own
    exchange, behind its partial step, and the hot key is in no single task.
    """
    small = lookup_rows is not None and lookup_rows <= BROADCAST_ROWS
    if small:
        return rows.join(F.broadcast(lookup), list(on), how)
    # The rows keep their key as it is, so that filters on it still reach the scan; a hidden copy is joined on.
    hidden = F.concat(F.col(on[0]), F.lit("")).alias("_hidden")
    left = rows.select("*", hidden)
    right = lookup.select(hidden, *[F.col(c).alias(f"_on_{c}") for c in on[1:]], *[c for c in lookup.columns if c not in on])
    same = left["_hidden"] == right["_hidden"]
    for c in on[1:]:
        same = same & (left[c] == right[f"_on_{c}"])
    joined = left.join(right, same, how).drop("_hidden", *[f"_on_{c}" for c in on[1:]])
    first = [*on, *[c for c in rows.columns if c not in on]]
    return joined.select(*first, *[c for c in joined.columns if c not in first])


def deal_by_key(rows: DataFrame, keys: Sequence[str], count: int) -> DataFrame:
    """The rows by key in partitions of some TASK_ROWS, for an aggregate by these keys or more, which needs no further exchange.

    AQE sizes the tasks of an aggregate by compressed bytes, and bars compress to a tenth or less of what they take in a
    hash table. `count` is the number of rows, or a bound on it. A key's copies all reach one task, so this is for keys
    with few copies. A key that may be a literal is left out: the aggregate would know it by another name and exchange again.
    """
    least = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(least, -(-count // TASK_ROWS)), *keys)


def forget_partitioning(df: DataFrame, key: str) -> DataFrame:
    """Same rows; Spark no longer knows that they are partitioned by the string column `key`."""
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))


def restrict_to(rows: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keep the rows whose key is listed."""
    return lookup_join(rows, keys.select(*on).distinct(), on, "left_semi")


def number_rows(df: DataFrame, order: Sequence[str], name: str = "position") -> DataFrame:
    """Add the 0-based position in a global order, without one task holding all rows.

    Rows are range-partitioned and sorted, and their ids fixed by a checkpoint so
    that a lost executor cannot renumber them. The offsets table has one row per
    partition.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    fixed = ranged.withColumn("_id", F.monotonically_increasing_id()).checkpoint()
    parted = fixed.withColumn("_range", F.shiftright("_id", 33)).withColumn(
        "_local", F.col("_id").bitwiseAND((1 << 33) - 1)
    )
    sizes = parted.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return (
        parted.join(F.broadcast(offsets), "_range")
        .withColumn(name, F.col("_local") + F.col("_before"))
        .drop("_id", "_range", "_local", "_before")
    )
