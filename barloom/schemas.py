"""Table schemas. Sources declare these instead of inferring."""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.intervals import in_family

BAR_VALUES = ("open", "high", "low", "close", "volume", "vwap", "transactions")
SERIES_KEY = ("ticker", "interval")
# The asset type is an attribute of a bar, not a part of its identity: details may reclassify a series.
BAR_KEY = (*SERIES_KEY, "timestamp")
# Tickers are dealt to so many buckets of a new store; large ones want more, so that a deletion rewrites little.
BUCKETS = 16

BARS = T.StructType(
    [
        T.StructField("asset_type", T.StringType()),
        T.StructField("ticker", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("vwap", T.DoubleType()),
        T.StructField("transactions", T.LongType()),
        T.StructField("ingest_seq", T.LongType()),
    ]
)
STORED_BARS = T.StructType([*BARS.fields, T.StructField("bucket", T.StringType()), T.StructField("period", T.StringType())])

# What the store knows of a series without reading its bars.
SERIES = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("interval", T.StringType()),
        T.StructField("asset_type", T.StringType()),
        T.StructField("records", T.LongType()),
        T.StructField("first_timestamp", T.TimestampNTZType()),
        T.StructField("last_timestamp", T.TimestampNTZType()),
    ]
)

TICKS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("timestamp", T.TimestampNTZType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("size", T.LongType()),
        T.StructField("seq", T.LongType()),
    ]
)

INSTRUMENT_REQUIRED = ("ticker", "name", "market", "locale", "primary_exchange", "type", "active")
INSTRUMENT = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("market", T.StringType()),
        T.StructField("locale", T.StringType()),
        T.StructField("primary_exchange", T.StringType()),
        T.StructField("type", T.StringType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("currency_name", T.StringType()),
        T.StructField("cik", T.StringType()),
        T.StructField("composite_figi", T.StringType()),
        T.StructField("share_class_figi", T.StringType()),
        T.StructField("last_updated_utc", T.StringType()),
    ]
)
UNIVERSE_COLUMNS = (
    "ticker", "name", "market", "type", "locale", "primary_exchange",
    "active", "currency_name", "last_updated_utc",
)

def period_of(interval: Column, ts: Column) -> Column:
    """Storage period of a bar, shorter where bars are denser: the day of second bars, the month of minute bars, else the
    year, so that neither a file is tiny nor a few new bars touch much."""
    year, month, day = (F.date_format(ts, p) for p in ("yyyy", "yyyy-MM", "yyyy-MM-dd"))
    return F.when(in_family(interval, "second"), day).when(in_family(interval, "minute"), month).otherwise(year)


def bucket_of(ticker: Column, buckets: int) -> Column:
    """Name of a ticker's storage bucket, which tells how many there are."""
    number = F.pmod(F.crc32(ticker.cast("binary")), F.lit(buckets)).cast("string")
    return F.concat(F.lpad(number, 4, "0"), F.lit(f"of{buckets}"))


def bucket_name(ticker: str, buckets: int) -> str:
    """The same without Spark."""
    return f"{zlib.crc32(ticker.upper().encode()) % buckets:04d}of{buckets}"


def in_bucket(bucket: Column, ticker: str) -> Column:
    """Whether a bucket, of whatever number of buckets, is that of a ticker; of the bucket alone, so folders are pruned."""
    number, buckets = (F.substring_index(bucket, "of", k).cast("int") for k in (1, -1))
    return number == F.pmod(F.lit(zlib.crc32(ticker.upper().encode())), buckets)
