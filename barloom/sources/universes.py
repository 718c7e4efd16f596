"""Universe documents: one JSON object with a list of tickers, in files of bounded size."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.sizes import megabytes
from barloom.schemas import UNIVERSE_COLUMNS

# Entries may be objects or plain symbols, so each is taken as JSON text.
DOCUMENT = "category string, created_at string, count bigint, new_tickers_added bigint, tickers array<string>"
ENTRY = (
    "ticker string, name string, market string, type string, locale string, primary_exchange string, "
    "active boolean, currency_name string, last_updated_utc string"
)
ENTRIES_PER_DOCUMENT = 50_000


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Universe documents with their path and size; unreadable ones are left out."""
    docs = spark.read.schema(DOCUMENT).option("multiLine", "true").option("mode", "DROPMALFORMED").json(path)
    return docs.select(
        "*", F.col("_metadata.file_path").alias("path"), megabytes(F.col("_metadata.file_size")).alias("file_size_mb")
    )


def parse_documents(lines: DataFrame, column: str = "value") -> DataFrame:
    """Universe documents from a text column."""
    parsed = lines.select(F.from_json(column, DOCUMENT).alias("_doc")).select("_doc.*")
    return parsed.where(F.col("category").isNotNull() | F.col("tickers").isNotNull())


def entries(docs: DataFrame) -> DataFrame:
    """One row per ticker entry; plain symbols have null attributes."""
    listed = docs.select("category", F.explode("tickers").alias("_entry"))
    parsed = listed.withColumn(
        "_row", F.when(F.col("_entry").startswith("{"), F.from_json("_entry", ENTRY))
    )
    rest = [F.col(f"_row.{c}").alias(c) for c in UNIVERSE_COLUMNS if c != "ticker"]
    symbol = F.when(F.col("_entry").startswith("{"), F.col("_row.ticker")).otherwise(F.col("_entry"))
    return parsed.select("category", symbol.alias("ticker"), *rest)


def headers(docs: DataFrame) -> DataFrame:
    """Per category and creation time the totals; parts of one snapshot share them."""
    rest = [F.sum("file_size_mb").alias("file_size_mb"), F.min("path").alias("path")] if "path" in docs.columns else []
    return docs.groupBy("category", "created_at").agg(
        F.max("count").alias("count"), F.max("new_tickers_added").alias("new_tickers_added"), *rest
    )


def documents(
    universe: DataFrame,
    totals: DataFrame,
    created_at: datetime,
    per_document: int = ENTRIES_PER_DOCUMENT,
) -> DataFrame:
    """Documents as rows: category, created_at, count, new_tickers_added, tickers.

    `totals` holds count and new_tickers_added per category. A category that it
    lacks is written too, with its own count and, as nothing is known of earlier
    ones, all entries as new. A category larger than `per_document` is cut into
    parts by a hash of the entry, so no array grows with the category; identical
    entries are written once.
    """
    parts = F.greatest(F.ceil(F.col("count") / F.lit(per_document)), F.lit(1)).cast("int")
    columns = [c for c in UNIVERSE_COLUMNS if c in universe.columns]
    listed = universe.select("category", *columns).distinct()
    own = listed.groupBy("category").agg(F.count("*").alias("_own"))
    known = own.join(totals, "category", "left").select(
        "category",
        F.coalesce("count", "_own").alias("count"),
        F.coalesce("new_tickers_added", "_own").alias("new_tickers_added"),
    )
    placed = listed.join(known, "category").withColumn("_part", F.pmod(F.xxhash64(*columns), parts))
    grouped = placed.groupBy("category", "_part").agg(
        F.first("count").alias("count"),
        F.first("new_tickers_added").alias("new_tickers_added"),
        F.sort_array(F.collect_list(F.struct(*columns))).alias("tickers"),
    )
    return grouped.select(
        "category", F.lit(created_at.isoformat()).alias("created_at"), "count", "new_tickers_added", "tickers"
    )


def write_documents(docs: DataFrame, path: str) -> None:
    """Write one snapshot, partitioned by category so that a category can be replaced or dropped alone."""
    (
        docs.withColumn("universe", F.col("category"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("ignoreNullFields", "false")
        .partitionBy("universe")
        .json(path)
    )


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """Documents written by `write_documents`, one per line."""
    return spark.read.schema(DOCUMENT).json(path).select(
        "category",
        "created_at",
        "count",
        "new_tickers_added",
        "tickers",
        F.col("_metadata.file_path").alias("path"),
        megabytes(F.col("_metadata.file_size")).alias("file_size_mb"),
    )
