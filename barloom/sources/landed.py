"""Provider rows as they land: bars, instruments and market-wide days.

Every normaliser returns all rows with a `reject_reason`, null for good ones;
`accepted` and `rejected` split them, so nothing is lost silently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.intervals import interval_of
from barloom.schemas import INSTRUMENT, INSTRUMENT_REQUIRED

RAW_BAR = (
    "ticker string, interval string, t string, o string, h string, l string, c string, "
    "v string, vw string, n string"
)
RAW_MARKET_DAY = "T string, ticker string, o double, h double, l double, c double, v double, vw double, n bigint"


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("reject_reason").isNotNull())


def _number(name: str) -> Column:
    return F.col(name).try_cast("double")


def parse_json_rows(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Columns of JSON text lines; a line that is no JSON object gives nulls.

    `inline` keeps later filters above it, where they would otherwise each parse
    the text again.
    """
    parsed = F.from_json(F.col(column), schema, {"mode": "PERMISSIVE"})
    return lines.select(F.inline(F.array(parsed)))


def normalise_bars(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Bars from provider rows with text fields t (epoch ms), o, h, l, c, v, vw, n.

    Missing or zero volume is 0, fractions are cut. A bar without a usable time
    or price, or with an unreadable volume, is rejected; a missing vwap is kept.
    Columns of `raw` in `keep` are handed on.
    """
    millis = F.col("t").try_cast("double").try_cast("bigint")
    prices = {"open": "o", "high": "h", "low": "l", "close": "c"}
    volume = F.when(F.col("v").isNull(), F.lit(0).cast("bigint")).otherwise(_number("v").try_cast("bigint"))
    named = raw.select(
        F.upper("ticker").alias("ticker"),
        "interval",
        F.timestamp_millis(millis).cast("timestamp_ntz").alias("timestamp"),
        *[_number(short).alias(name) for name, short in prices.items()],
        volume.alias("volume"),
        _number("vw").alias("vwap"),
        _number("n").try_cast("bigint").alias("transactions"),
        *keep,
    )
    reason = F.when(F.col("timestamp").isNull(), "time")
    for name in prices:
        reason = reason.when(F.col(name).isNull(), name)
    return named.withColumn("reject_reason", reason.when(F.col("volume").isNull(), "volume"))


def normalise_instruments(raw: DataFrame) -> DataFrame:
    """Instrument rows in our schema; a row without a required field is rejected."""
    typed = raw.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in INSTRUMENT.fields
        ]
    )
    reason = F.lit(None).cast(T.StringType())
    for name in reversed(INSTRUMENT_REQUIRED):
        reason = F.when(F.col(name).isNull(), F.lit(name)).otherwise(reason)
    return typed.withColumn("reject_reason", reason)


def normalise_market_days(raw: DataFrame, day: Column, keep: Sequence[str] = ()) -> DataFrame:
    """Daily bars of the whole market from rows with T (or ticker), o, h, l, c, v, vw, n.

    The bar time is the day asked for; rows without a ticker are dropped. Columns of `raw` in `keep` are handed on.
    """
    by_name = {c.lower(): c for c in raw.columns if c != "T"}
    symbols = [F.col("T")] if "T" in raw.columns else []
    symbols += [F.col("ticker")] if "ticker" in by_name else []
    symbol = F.coalesce(*symbols)
    return raw.select(
        symbol.alias("ticker"),
        F.lit(interval_of("1d").label).alias("interval"),
        day.cast("date").cast("timestamp_ntz").alias("timestamp"),
        F.col("o").alias("open"),
        F.col("h").alias("high"),
        F.col("l").alias("low"),
        F.col("c").alias("close"),
        F.col("v").try_cast("bigint").alias("volume"),
        F.col("vw").alias("vwap"),
        F.col("n").try_cast("bigint").alias("transactions"),
        *keep,
    ).where(F.col("ticker").isNotNull() & (F.col("ticker") != ""))


def market_day_report(bars: DataFrame, spine: DataFrame) -> DataFrame:
    """Per weekday: tickers saved and status."""
    saved = bars.groupBy(F.col("timestamp").cast("date").alias("date")).agg(
        F.count_distinct("ticker").alias("_saved")
    )
    joined = spine.join(saved, "date", "left")
    return joined.select(
        "date",
        F.when(F.col("_saved") > 0, "success").otherwise("no_data").alias("status"),
        F.coalesce("_saved", F.lit(0)).alias("tickers_saved"),
    )


def market_range_totals(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("trading_days_processed"),
        F.count_if(F.col("status") == "success").alias("days_with_data"),
    )
