"""The test tables seen as ticks, bars, instruments and provider ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import pin_utc

AS_OF = "2024-01-31 00:00:00"
CUTOFF = "2024-01-20"
EVENT_INTERVALS = {"click": "1m", "error": "5m", "purchase": "1h", "signup": "1d", "view": "1w"}
SEGMENT_MARKETS = {
    "AUTOMOBILE": "stocks",
    "BUILDING": "crypto",
    "FURNITURE": "fx",
    "HOUSEHOLD": "options",
    "MACHINERY": "otc",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return pin_utc(spark).read.parquet(f"{sf}/{name}.parquet")


def choose(column: str, table: dict[str, str]) -> Column:
    out = F.lit(None).cast("string")
    for key, value in table.items():
        out = F.when(F.col(column) == key, value).otherwise(out)
    return out


def event_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Five heavy tickers, one per event type."""
    return table(spark, sf, "events").select(
        F.col("event_type").alias("ticker"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
        F.col("event_id").alias("seq"),
    )


def user_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Many light tickers, one per user."""
    return table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("ticker"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
        F.col("event_id").alias("seq"),
    )


def order_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Daily prices over years, many orders on one day."""
    return table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("ticker"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderkey").alias("seq"),
    )


def user_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Stored bars of many series: one ticker per user, the interval from the event type."""
    events = table(spark, sf, "events")
    price = F.col("value")
    return events.select(
        F.col("user_id").cast("string").alias("ticker"),
        choose("event_type", EVENT_INTERVALS).alias("interval"),
        F.col("ts").alias("timestamp"),
        price.alias("open"),
        (price + 1).alias("high"),
        (price - 1).alias("low"),
        price.alias("close"),
        F.get_json_object("props", "$.k").cast("bigint").alias("volume"),
        price.alias("vwap"),
        F.lit(1).cast("bigint").alias("transactions"),
    )


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Universe of ticker symbols."""
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("ticker"))


def provider_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """What the provider offers: five intervals for every customer with orders."""
    per_customer = (
        table(spark, sf, "orders")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").cast("date").alias("start_date"))
        .select(
            F.col("o_custkey").cast("string").alias("ticker"),
            "start_date",
            F.date_add(F.lit("2024-01-15").cast("date"), (F.col("o_custkey") % 20).cast("int")).alias("end_date"),
        )
    )
    labels = F.array(*[F.lit(label) for label in EVENT_INTERVALS.values()])
    return per_customer.select("ticker", F.explode(labels).alias("interval"), "start_date", "end_date")


def instruments(spark: SparkSession, sf: str) -> DataFrame:
    """Reference rows out of customers, nations and regions."""
    return (
        table(spark, sf, "customer")
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_name").alias("ticker"),
            F.concat_ws(" ", "n_name", "c_mktsegment").alias("name"),
            choose("c_mktsegment", SEGMENT_MARKETS).alias("market"),
            F.when(F.col("r_name") == "AMERICA", "us").otherwise("global").alias("locale"),
            F.col("n_name").alias("primary_exchange"),
            F.when(F.col("c_acctbal") > 5000, "CS").otherwise("ETF").alias("type"),
            (F.col("c_acctbal") >= 0).alias("active"),
        )
    )


def part_universe(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("type"),
        F.col("p_brand").alias("primary_exchange"),
    )


def shaped_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """Part keys dressed as symbols that reach every classification rule, with a reference type."""
    key = F.col("p_partkey").cast("string")
    forms = [
        F.concat(F.lit("X:"), key), F.concat(key, F.lit("usd")), F.concat(F.lit("UNI"), key),
        F.lit("SPY"), F.concat(key, F.lit("FUND")), F.concat(F.lit("A"), key),
        F.concat(F.lit("B"), key, F.lit("-USD")), F.concat(F.lit("C"), key, F.lit("/EUR")),
    ]
    ticker = F.element_at(F.array(*forms), (F.col("p_partkey") % 8 + 1).cast("int"))
    kind = F.when(F.col("p_type") == "PROMO", "ETP").when(F.col("p_type") == "ECONOMY", "CRYPTO")
    kind = kind.when(F.col("p_type") == "SMALL", "ETF").when(F.col("p_type") == "LARGE", "FX").otherwise("CS")
    symbols = table(spark, sf, "part").select(ticker.alias("ticker"), kind.alias("type"), (F.col("p_size") > 25).alias("minutes"))
    return symbols.groupBy("ticker").agg(F.max("type").alias("type"), F.bool_or("minutes").alias("has_short_minutes"))
