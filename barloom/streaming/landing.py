"""Provider rows that land as files over time: bars into the store, rejected lines into a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from barloom.schemas import BAR_VALUES
from barloom.session import session_settings
from barloom.sources.folders import path_exists
from barloom.sources.landed import RAW_BAR, accepted, normalise_bars, rejected
from barloom.sources.store import merge_newest

REJECTS = "line string, reject_reason string, batch bigint"
# Bytes of landed files that a task reads: compressed lines grow some tenfold when read.
TASK_BYTES = 32 << 20


def split_lines(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(bars, rejects) of JSON text lines (value); a bar's number is a hash of its values, a reject keeps its line.

    The number decides between copies of a bar, so the result does not hang on which comes first.
    """
    parsed = lines.select("value", F.from_json("value", RAW_BAR, {"mode": "PERMISSIVE"}).alias("_row"))
    named = normalise_bars(parsed.select(F.col("value").alias("line"), F.inline(F.array("_row"))), keep=["line"])
    bars = accepted(named).drop("line").withColumn("ingest_seq", F.xxhash64(*BAR_VALUES))
    return bars, rejected(named).select("line", "reject_reason")


def read_rejects(spark: SparkSession, path: str) -> DataFrame:
    """Rejected lines, each once, with the batch that it first came with."""
    return spark.read.schema(REJECTS).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], REJECTS)


def _write_batch(path: str, rejects: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bars, bad = split_lines(batch)
        merge_newest(spark, bars, path)
        known = read_rejects(spark, rejects).where(F.col("batch") < batch_id).select("line")
        new = bad.groupBy("line").agg(F.min("reject_reason").alias("reject_reason")).join(known, "line", "left_anti")
        new.write.mode("overwrite").option("compression", "zstd").parquet(f"{rejects}/batch={batch_id}")

    return write


def stream_landing(lines: DataFrame, path: str, rejects: str, checkpoint: str) -> StreamingQuery:
    """Process the files that have landed since the last run, then stop. The caller awaits the query.

    Files may come twice and in any order: bars merge by their own number and rejected lines count once, so the tables end
    as those of one read of all files. A batch that runs twice changes nothing. Nothing that a step of a batch shuffles is
    used again, so it is removed when the step has ended, and not when the driver happens to collect garbage.
    """
    spark = lines.sparkSession
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(_write_batch(path, rejects))
    own = {
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(min(TASK_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())),
    }
    with session_settings(spark, own):
        return writer.trigger(availableNow=True).start()
