"""A tick stream through the lake: bars built from whole bins, late ticks kept and repaired."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.functions.intervals import interval_of
from barloom.operators.bars import bars_from_ticks
from barloom.operators.dirty import nesting, touched_bins, within_bins
from barloom.plans.propagation import propagate
from barloom.schemas import TICKS
from barloom.sources.folders import path_exists
from barloom.sources.store import add_run, commit_run, run_bars

TICKS_FOLDER, LATE_FOLDER, MARKS_FOLDER, REPAIRED_FOLDER = "ticks", "late", "marks", "repaired"
LAKE = T.StructType([*TICKS.fields, T.StructField("batch", T.LongType()), T.StructField("date", T.DateType())])
LATE = T.StructType([*TICKS.fields, T.StructField("batch", T.LongType())])
MARKS = "batch bigint, last_timestamp timestamp_ntz"
REPAIRED = "batch bigint"


def _read(spark: SparkSession, lake: str, folder: str, schema: T.StructType | str) -> DataFrame:
    path = f"{lake}/{folder}"
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


def lake_ticks(spark: SparkSession, lake: str) -> DataFrame:
    """All ticks that have arrived, with their batch and date."""
    return _read(spark, lake, TICKS_FOLDER, LAKE)


def late_ticks(spark: SparkSession, lake: str) -> DataFrame:
    """Ticks that came when the bin they fall into was closed, with their batch."""
    return _read(spark, lake, LATE_FOLDER, LATE)


def bin_closed(ts: Column, label: str, watermark: Column) -> Column:
    """Whether the bin of a time ends at or before the watermark."""
    width = interval_of(label).seconds
    seconds = F.unix_seconds(ts.cast("timestamp"))
    end = (seconds - F.pmod(seconds, F.lit(width)) + width).cast("timestamp").cast("timestamp_ntz")
    return F.coalesce(end <= watermark, F.lit(False))


def _build(spark: SparkSession, lake: str, bins: DataFrame, label: str, path: str, batch: int, wider: Iterable[str]) -> int:
    """Build bars of these bins from all their ticks in the lake and merge them; the number of bars."""
    ticks = lake_ticks(spark, lake)
    first, last = bins.agg(F.min("timestamp"), F.max("timestamp")).first()
    if first is None:
        return 0
    # Bins of a day at most begin on the date of their ticks.
    own = within_bins(ticks.where(F.col("date").between(first.date(), last.date())), bins, label, first, last)
    built = bars_from_ticks(own, label, tie_break="seq").withColumn("ingest_seq", F.lit(batch).cast("bigint"))
    run = add_run(spark, built, path)
    commit_run(spark, path, run)
    found = run_bars(spark, path, run)
    propagate(spark, path, found, label, wider)
    return found.count()


def _write_batch(lake: str, label: str, path: str, lateness: str, wider: tuple[str, ...]) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        shaped = batch.select(*[F.col(f.name).cast(f.dataType) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in TICKS.fields])
        placed = shaped.where("timestamp IS NOT NULL").withColumn("date", F.col("timestamp").cast("date"))
        placed.hint("rebalance", F.col("date")).sortWithinPartitions("date", "ticker", "timestamp").write.mode("overwrite").partitionBy("date").parquet(
            f"{lake}/{TICKS_FOLDER}/batch={batch_id}"
        )
        own = lake_ticks(spark, lake).where(F.col("batch") == batch_id)
        earlier = _read(spark, lake, MARKS_FOLDER, MARKS).where(F.col("batch") < batch_id)
        mark = earlier.agg(F.max("last_timestamp") - F.expr(f"INTERVAL {lateness}")).first()[0]
        closed = bin_closed(F.col("timestamp"), label, F.lit(mark.isoformat() if mark else None).cast("timestamp_ntz"))
        own.where(closed).select(*TICKS.names).write.mode("overwrite").parquet(f"{lake}/{LATE_FOLDER}/batch={batch_id}")
        last = own.agg(F.max("timestamp").alias("last_timestamp"))
        last.write.mode("overwrite").parquet(f"{lake}/{MARKS_FOLDER}/batch={batch_id}")
        _build(spark, lake, touched_bins(own.where(~closed), label), label, path, batch_id, wider)

    return write


def stream_through_lake(
    ticks: DataFrame, label: str, path: str, lake: str, checkpoint: str, lateness: str = "'1' DAY", wider: Iterable[str] = ()
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop. The caller awaits the query.

    Ticks first go to the lake. Bins that they touch are built again from all their ticks and merged, so no bin is ever
    built from a part. The watermark is the last time of earlier batches less `lateness` (an interval of SQL); ticks of
    bins that end before it are kept in a side table and wait for `repair_late`. Every folder is named after its batch, so
    a batch that runs twice writes the same again. A tick stands for itself: one that arrives twice counts twice.
    """
    if interval_of(label).seconds is None:
        raise ValueError(f"{label} bars are built from finer ones; name them in `wider`")
    wider = tuple(wider)
    nesting(label, wider)
    writer = ticks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_write_batch(lake, label, path, lateness, wider))
    return writer.trigger(availableNow=True).start()


def repair_late(spark: SparkSession, label: str, path: str, lake: str, wider: Iterable[str] = ()) -> DataFrame:
    """Build the bins of late ticks again from the lake, and wider bars with them; what has been repaired is not again.

    One row: late_rows and bars_rebuilt of this repair.
    """
    done = _read(spark, lake, REPAIRED_FOLDER, REPAIRED)
    late = late_ticks(spark, lake).join(done, "batch", "left_anti")
    counted = late.groupBy("batch").agg(F.count(F.lit(1)).alias("rows")).collect()
    rows, built = sum(r["rows"] for r in counted), 0
    if rows:
        last = max(r["batch"] for r in counted)
        built = _build(spark, lake, touched_bins(late, label), label, path, last, wider)
        batches = spark.createDataFrame([(r["batch"],) for r in counted], REPAIRED)
        batches.coalesce(1).write.mode("append").parquet(f"{lake}/{REPAIRED_FOLDER}")
    return spark.createDataFrame([(rows, built)], "late_rows bigint, bars_rebuilt bigint")
