"""Build bars from the ticks of a range and merge them into the store."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators.bars import bars_for_intervals
from barloom.operators.universe import with_asset_type
from barloom.sources.store import merge_bars


def build_bars(
    spark: SparkSession,
    ticks: DataFrame,
    labels: Iterable[str],
    path: str,
    tie_break: str | None = None,
    details: DataFrame | None = None,
) -> None:
    """Ticks to bars of all intervals in one scan, asset type attached, upserted.

    The ticks must cover whole bins: a bar is replaced, not added to.
    """
    bars = bars_for_intervals(ticks, labels, tie_break)
    merge_bars(spark, with_asset_type(bars, details), path)


def building_report(bars: DataFrame, n: int = 10) -> DataFrame:
    """Per interval: symbols processed and the first n of them by name."""
    series = bars.groupBy("interval", "ticker").agg(F.count(F.lit(1)).alias("_bars"))
    counted = series.groupBy("interval").agg(F.count(F.lit(1)).alias("symbols_processed"))
    rank = F.row_number().over(W.partitionBy("interval").orderBy("ticker"))
    first = (
        series.withColumn("_rank", rank)
        .where(F.col("_rank") <= n)
        .groupBy("interval")
        .agg(F.array_join(F.sort_array(F.collect_list("ticker")), ",").alias("symbols"))
    )
    return counted.join(first, "interval")
