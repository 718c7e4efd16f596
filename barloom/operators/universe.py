"""Instrument universes: categories, filters, classification, batches, listings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.classify import asset_type, market_type
from barloom.functions.names import holds_keyword
from barloom.functions.sizes import batch_count
from barloom.operators.spread import lookup_join, number_rows
from barloom.operators.upsert import append_first
from barloom.schemas import UNIVERSE_COLUMNS

# Category -> market, type (None = any), locale (global = any).
CATEGORIES = {
    "us_equities": ("stocks", "CS", "us"),
    "etf": ("stocks", "ETF", "us"),
    "crypto": ("crypto", None, "global"),
    "fx": ("fx", None, "global"),
    "options": ("options", None, "us"),
    "indices": ("indices", None, "us"),
    "otc": ("otc", None, "us"),
}
TEST_KEYWORDS = ("TEST", "TEMP", "DEMO")
# Parts of a key whose first rows are found apart.
PARTS = 32


def category_frame(spark: SparkSession, categories: dict[str, tuple] | None = None) -> DataFrame:
    """The category table: category, market, type, locale."""
    rows = [(name, *rule) for name, rule in (categories or CATEGORIES).items()]
    return spark.createDataFrame(rows, "category string, market string, type string, locale string")


def discover(
    instruments: DataFrame,
    categories: dict[str, tuple] | None = None,
    only: Sequence[str] | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Active instruments of each category, all categories in one pass.

    The category rules are a fixed handful, so they are broadcast. With `limit`
    the first tickers of each category by symbol are kept.
    """
    rules = dict(categories or CATEGORIES)
    unknown = set(only or ()) - set(rules)
    if unknown:
        raise ValueError(f"unknown category {sorted(unknown)}, expected one of {', '.join(rules)}")
    if only is not None:
        rules = {name: rules[name] for name in only}
    table = category_frame(instruments.sparkSession, rules).alias("c")
    i = instruments.alias("i")
    same = (
        (F.col("i.market") == F.col("c.market"))
        & (F.col("c.type").isNull() | (F.col("i.type") == F.col("c.type")))
        & ((F.col("c.locale") == "global") | (F.col("i.locale") == F.col("c.locale")))
    )
    columns = [c for c in UNIVERSE_COLUMNS if c in instruments.columns]
    found = (
        i.where(F.col("i.active"))
        .join(F.broadcast(table), same, "inner")
        .select("c.category", *[F.col(f"i.{c}") for c in columns])
    )
    if limit is None:
        return found
    return _first_per_category(found, limit)


def _first_per_category(found: DataFrame, limit: int) -> DataFrame:
    """First rows of each category by symbol, then by all other columns, also where one category holds most rows."""
    rest = [c for c in found.columns if c not in ("category", "ticker")]
    return first_of_each(found, ["category"], ["ticker", *rest], limit)


def first_of_each(rows: DataFrame, keys: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows of each key by `order`, of rows equal in it any.

    Lists of n are made of even parts of a key, dealt by a hash of the row, and then of these lists: no order of all rows
    is needed, and a key that holds most rows reaches its last task as PARTS lists. Up to Spark's threshold for limited
    ranks each list is cut before its shuffle too.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS)).alias("_part")
    direction = [F.col(c) for c in order]

    def cut(df: DataFrame, by: Sequence[str]) -> DataFrame:
        rank = F.row_number().over(W.partitionBy(*by).orderBy(*direction))
        return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")

    lists = cut(rows.select("*", part), [*keys, "_part"])
    return cut(lists, keys).drop("_part")


def discovery_report(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Per category: entries after appending and how many of them are new."""
    known = F.col("ticker").isNotNull() & (F.col("ticker") != "")
    sides = existing.select("category", "ticker", F.lit(1).alias("_stored"))
    sides = sides.unionByName(found.select("category", "ticker", F.lit(0).alias("_stored")))
    per_key = sides.groupBy("category", "ticker").agg(F.sum("_stored").alias("_stored"))
    out = per_key.groupBy("category").agg(F.count_if(known).alias("count"), F.sum("_stored").alias("_existing"))
    return out.select("category", "count", (F.col("count") - F.col("_existing")).alias("new_tickers_added"))


def append_universe(existing: DataFrame, found: DataFrame) -> DataFrame:
    """Stored entries and the newly found ones, the stored entry winning per symbol."""
    rest = [c for c in found.columns if c != "ticker"]
    return append_first(existing, found, "ticker", rest)


def append_by_category(existing: DataFrame, found: DataFrame) -> DataFrame:
    """`append_universe` for all categories at once: the stored entry wins within its category."""
    rest = [c for c in found.columns if c not in ("category", "ticker")]
    return append_first(existing, found, "ticker", rest, within=["category"])


def filter_universe(
    universe: DataFrame,
    exchange: str | None = None,
    min_name_length: int = 1,
    exclude_test: bool = True,
    keywords: tuple[str, ...] = TEST_KEYWORDS,
) -> DataFrame:
    """Entries by exchange, name length and absence of test keywords."""
    out = universe.where(F.length(F.coalesce("name", F.lit(""))) >= min_name_length)
    if exchange:
        out = out.where(F.col("primary_exchange") == exchange)
    if exclude_test:
        out = out.where(~holds_keyword(keywords, F.col("ticker"), F.col("name")))
    return out


def with_asset_type(tickers: DataFrame, details: DataFrame | None = None) -> DataFrame:
    """Classify the tickers of any rows; `details` (ticker, type and maybe market) helps where the symbol does not.

    Of several details of a ticker the last by (type, market) counts.
    """
    if details is None:
        return tickers.withColumn("asset_type", asset_type(F.col("ticker")))
    market = F.col("market") if "market" in details.columns else F.lit(None).cast("string")
    # One row for each ticker, the one with the last type and market by name.
    known = details.groupBy("ticker").agg(F.max(F.struct(F.col("type").alias("_type"), market.alias("_market"))).alias("_best"))
    known = known.select("ticker", "_best._type", "_best._market")
    joined = lookup_join(tickers, known, ["ticker"])
    return joined.withColumn("asset_type", asset_type(F.col("ticker"), F.col("_type"), F.col("_market"))).drop(
        "_type", "_market"
    )


def with_market_type(flags: DataFrame, details: DataFrame) -> DataFrame:
    """Market type from the symbol, the available intervals and the reference type."""
    known = details.groupBy("ticker").agg(F.max("type").alias("_type"))
    joined = flags.join(known, "ticker", "left")
    rule = market_type(F.col("ticker"), F.col("has_short_minutes"), F.col("_type"))
    return joined.withColumn("market_type", rule).drop("_type")


def batches(tickers: DataFrame, size: int, start_batch: int = 0, max_batches: int | None = None) -> DataFrame:
    """Tickers of the chosen batches, in symbol order; batch numbers count from 1.

    `max_batches` None or 0 takes all remaining batches.
    """
    placed = number_rows(tickers, ["ticker"])
    number = (F.floor(F.col("position") / F.lit(size)) + 1).cast("bigint")
    chosen = placed.withColumn("batch_number", number).where(F.col("batch_number") > start_batch)
    if max_batches:
        chosen = chosen.where(F.col("batch_number") <= start_batch + max_batches)
    return chosen.drop("position")


def batch_report(tickers: DataFrame, size: int, start_batch: int = 0, max_batches: int | None = None) -> DataFrame:
    """Totals of a batched run: total_tickers, total_batches, processed_batches, remaining_batches."""
    counted = tickers.agg(F.count(F.lit(1)).alias("total_tickers"))
    total = batch_count(F.col("total_tickers"), size)
    stop = F.least(F.lit(start_batch) + F.lit(max_batches), total) if max_batches else F.greatest(total, F.lit(start_batch))
    stop = F.least(stop, total)
    return counted.select(
        "total_tickers",
        total.alias("total_batches"),
        F.greatest(stop - F.lit(start_batch), F.lit(0)).cast("bigint").alias("processed_batches"),
        (total - stop).cast("bigint").alias("remaining_batches"),
    )


def sorted_tickers(rows: DataFrame) -> DataFrame:
    return rows.select("ticker").distinct().orderBy("ticker")


def sample_names(rows: DataFrame, column: str = "ticker", n: int = 10) -> DataFrame:
    """The first n distinct names as one array; only n rows reach the last task."""
    return rows.select(column).distinct().orderBy(column).limit(n).agg(F.sort_array(F.collect_list(column)).alias("sample"))


def latest_snapshots(headers: DataFrame) -> DataFrame:
    """Newest universe document per category."""
    rest = [c for c in headers.columns if c != "category"]
    rank = F.row_number().over(W.partitionBy("category").orderBy(F.desc("created_at"), *rest))
    return headers.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def list_universes(headers: DataFrame) -> DataFrame:
    """Universe documents, newest first, with defaults for missing fields."""
    unknown: Column = F.lit("unknown")
    filled = headers.withColumns(
        {
            "category": F.coalesce("category", unknown),
            "created_at": F.coalesce("created_at", unknown),
            "count": F.coalesce("count", F.lit(0)),
        }
    )
    return filled.orderBy(F.desc("created_at"), "category")
