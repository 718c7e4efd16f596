"""Ticks arriving over time, built into bars and merged into the store."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from barloom.functions.intervals import interval_of
from barloom.operators.bars import tick_aggregates, with_known_price
from barloom.operators.dirty import nesting
from barloom.plans.propagation import propagate
from barloom.sources.store import add_run, commit_run, run_bars

LATE_ROWS = "query string, batch long, rows_dropped long"


def streaming_bars(ticks: DataFrame, label: str, lateness: str, tie_break: str | None = None) -> DataFrame:
    """Bars of a tick stream in update mode: each change emits the whole bar again.

    The whole window struct is the grouping key; grouping by its start alone
    would lose the watermark and keep all state for ever. Watermarks need
    zoned timestamps, so the time is cast in and back.
    """
    interval = interval_of(label)
    if interval.seconds is None:
        raise ValueError(f"{label} bars roll up from daily ones and are not streamed")
    timed = with_known_price(ticks).withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    grouped = timed.groupBy("ticker", F.window("timestamp", f"{interval.seconds} seconds").alias("_window"))
    bars = grouped.agg(*tick_aggregates("size" in ticks.columns, tie_break, False))
    return bars.where(F.col("open").isNotNull()).select(
        "ticker",
        F.lit(label).alias("interval"),
        F.col("_window.start").cast("timestamp_ntz").alias("timestamp"),
        *[c for c in bars.columns if c not in ("ticker", "_window")],
    )


def merge_into_store(path: str, label: str, wider: Iterable[str] = ()) -> Callable[[DataFrame, int], None]:
    """Batch writer: the re-built bars become a run of the store, then the `wider` bars they touch are built again.

    What a batch writes grows with what it changed. Replaying a batch changes nothing.
    """
    wider = tuple(wider)
    nesting(label, wider)  # unknown or foreign labels are an error before the stream starts

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = add_run(spark, batch.withColumn("ingest_seq", F.lit(batch_id).cast("bigint")), path)
        commit_run(spark, path, run)
        if wider:
            propagate(spark, path, run_bars(spark, path, run), label, wider)

    return write


def stream_to_store(
    ticks: DataFrame,
    label: str,
    path: str,
    checkpoint: str,
    lateness: str = "1 day",
    tie_break: str | None = None,
    wider: Iterable[str] = (),
) -> StreamingQuery:
    """Process what has arrived since the last run, then stop. The caller awaits the query.

    `wider` names intervals, weeks and longer among them, that are kept up to date from the streamed bars.
    """
    return (
        streaming_bars(ticks, label, lateness, tie_break)
        .writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(merge_into_store(path, label, wider))
        .trigger(availableNow=True)
        .start()
    )


class LateRows(StreamingQueryListener):
    """Counts, over all batches of all queries while it is attached, what is dropped behind the watermark.

    Attach it with `spark.streams.addListener` before a query starts. `save` appends the counts of each batch to a table,
    so that a later run goes on from them; `total` sums that table, each batch once.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int], int] = {}

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        batch = event.progress
        dropped = sum(state.numRowsDroppedByWatermark for state in batch.stateOperators)
        self.batches[(str(batch.id), batch.batchId)] = dropped

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(query, batch, n) for (query, batch), n in sorted(self.batches.items())]
        spark.createDataFrame(rows, LATE_ROWS).write.mode("append").parquet(path)
        self.batches.clear()

    @staticmethod
    def total(spark: SparkSession, path: str) -> DataFrame:
        """One row: partially aggregated rows dropped (rows_dropped), by all runs so far."""
        each = spark.read.schema(LATE_ROWS).parquet(path).groupBy("query", "batch").agg(F.max("rows_dropped").alias("rows_dropped"))
        return each.agg(F.coalesce(F.sum("rows_dropped"), F.lit(0)).alias("rows_dropped"))
