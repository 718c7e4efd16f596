"""Asset type and market type of a ticker."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the classification rules.
ASSET_TYPES = ("equities", "etf", "crypto")
CRYPTO_PREFIXES = (
    "BTC", "ETH", "BNB", "XRP", "ADA", "DOGE", "SOL", "DOT", "MATIC",
    "SHIB", "AVAX", "LINK", "UNI", "ATOM", "LTC", "ETC", "XLM", "ALGO",
)
KNOWN_ETFS = (
    "SPY", "QQQ", "IWM", "EEM", "GLD", "SLV", "USO", "TLT", "XLF", "XLE",
    "XLK", "XLI", "XLV", "XLY", "XLP", "XLU", "XLB", "XLRE", "VTI", "VOO",
    "VEA", "VWO", "AGG", "BND", "LQD", "HYG", "EMB", "TIP", "SHY", "IEF",
)
ETF_SUFFIXES = ("ETF", "ETN", "ETV", "FUND")
CRYPTO_PATTERN = "^X:|USDT?$|^(" + "|".join(CRYPTO_PREFIXES) + ")"
ETF_PATTERN = "(" + "|".join(ETF_SUFFIXES) + ")$"


def normal_ticker(ticker: Column) -> Column:
    return F.upper(ticker)


def asset_type(ticker: Column, detail_type: Column | None = None, detail_market: Column | None = None) -> Column:
    """crypto, etf or equities; symbol patterns decide before reference details."""
    symbol = normal_ticker(ticker)
    dtype = F.upper(F.coalesce(detail_type if detail_type is not None else F.lit(None).cast("string"), F.lit("")))
    dmarket = F.upper(F.coalesce(detail_market if detail_market is not None else F.lit(None).cast("string"), F.lit("")))
    return (
        F.when(symbol.rlike(CRYPTO_PATTERN), "crypto")
        .when(symbol.isin(*KNOWN_ETFS) | symbol.rlike(ETF_PATTERN), "etf")
        .when(dmarket.contains("CRYPTO") | dtype.contains("CRYPTO"), "crypto")
        .when(dtype.contains("ETF") | dtype.contains("ETP"), "etf")
        .otherwise("equities")
    )


def market_type(ticker: Column, has_short_minutes: Column, detail_type: Column) -> Column:
    """stocks, etf, crypto or fx.

    `has_short_minutes` says whether 1m or 5m bars are available; only then do
    the symbol patterns count. The symbol is taken as written.
    """
    by_pattern = F.coalesce(has_short_minutes, F.lit(False))
    return (
        F.when(by_pattern & (ticker.contains("-USD") | ticker.startswith("X:")), "crypto")
        .when(by_pattern & ticker.contains("/"), "fx")
        .when(detail_type == "ETF", "etf")
        .when(detail_type.isin("CRYPTO", "FX"), F.lower(detail_type))
        .otherwise("stocks")
    )
