"""Append what is discovered to the stored universe documents, as one job."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.universe import append_by_category, discover, discovery_report
from barloom.schemas import UNIVERSE_COLUMNS
from barloom.session import scratch_path
from barloom.sources.folders import path_exists, remove_path
from barloom.sources.universes import DOCUMENT, documents, entries, read_written, write_documents


def update_universes(
    spark: SparkSession, instruments: DataFrame, path: str, created_at: datetime, only: Sequence[str] | None = None, limit: int | None = None
) -> DataFrame:
    """Documents in, documents out: stored entries and newly found ones, the stored entry winning in its category.

    Only categories with something found are written again. Returns per category count and new_tickers_added. What is to
    be written is staged first, since the documents are read while new ones are made.
    """
    found = discover(instruments, only=only, limit=limit)
    stored = read_written(spark, path).drop("path", "file_size_mb") if path_exists(spark, path) else spark.createDataFrame([], DOCUMENT)
    columns = ["category", *UNIVERSE_COLUMNS]
    existing = entries(stored).select(*columns)
    existing = existing.join(found.select("category").distinct(), "category", "left_semi")
    staged = scratch_path(spark, "universes")
    report = discovery_report(existing, found)
    merged = append_by_category(existing, found)
    write_documents(documents(merged, report, created_at), staged)
    made = read_written(spark, staged).drop("path", "file_size_mb")
    write_documents(made, path)
    totals = made.groupBy("category").agg(F.max("count").alias("count"), F.max("new_tickers_added").alias("new_tickers_added"))
    out = spark.createDataFrame(totals.collect(), totals.schema)  # a row per category
    remove_path(spark, staged)
    return out
