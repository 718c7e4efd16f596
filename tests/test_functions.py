from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.functions import names, sizes
from barloom.functions.classify import asset_type, market_type
from barloom.functions.intervals import (
    DAY_FILE_LABELS,
    INTRADAY_LABELS,
    LABELS,
    bin_start,
    can_roll_up,
    common_width,
    display_rank,
    interval_of,
    vocabulary_frame,
)
from barloom.functions.timing import (
    days_behind,
    is_past,
    lag_class,
    probe_estimate,
    range_estimate,
    resume_point,
)


def values(spark, schema, rows, **columns):
    df = spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()])
    return [tuple(r) for r in df.collect()]


def test_vocabulary(spark):
    assert len(LABELS) == 25 and len(INTRADAY_LABELS) == 19
    assert interval_of("1m").seconds == 60 and interval_of("1M").trunc_unit == "month"
    assert interval_of("3M").trunc_unit == interval_of("1Q").trunc_unit == "quarter"
    assert vocabulary_frame(spark).count() == 25
    for bad in ("7m", "1D", "", "1S"):
        with pytest.raises(ValueError):
            interval_of(bad)
    with pytest.raises(ValueError):
        interval_of("30m", DAY_FILE_LABELS)
    with pytest.raises(ValueError):
        interval_of("1d", INTRADAY_LABELS)


def test_nesting():
    def nests(a, b):
        return can_roll_up(interval_of(a), interval_of(b))

    assert nests("1m", "45m") and nests("12h", "1d") and nests("1d", "1w") and nests("45m", "1M")
    assert nests("1M", "1Q") and nests("3M", "1Y") and nests("1Q", "3M")
    assert not nests("2m", "15m") and not nests("1w", "1M") and not nests("1Y", "1M") and not nests("1M", "1w")
    assert common_width([interval_of(x) for x in ("2m", "5m")]) == 60
    assert common_width([interval_of(x) for x in ("30m", "45m", "1w")]) == 900


@pytest.mark.parametrize(
    ("label", "moment", "start"),
    [
        ("45m", datetime(2024, 1, 2, 10, 50), datetime(2024, 1, 2, 10, 30)),
        ("1d", datetime(2024, 1, 2, 23, 59), datetime(2024, 1, 2)),
        ("1w", datetime(2024, 1, 7, 5), datetime(2024, 1, 1)),
        ("1M", datetime(2024, 2, 29, 5), datetime(2024, 2, 1)),
        ("1Q", datetime(2024, 6, 30), datetime(2024, 4, 1)),
        ("1Y", datetime(2024, 6, 30), datetime(2024, 1, 1)),
        ("8h", datetime(1969, 12, 31, 23), datetime(1969, 12, 31, 16)),
    ],
)
def test_bin_start(spark, label, moment, start):
    rows = values(spark, "ts timestamp_ntz", [(moment,)], b=bin_start("ts", interval_of(label)))
    assert rows == [(start,)]


def test_bins_ignore_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = values(
            spark,
            "ts timestamp_ntz",
            [(datetime(2024, 3, 10, 2, 30),)],
            d=bin_start("ts", interval_of("1d")),
        ) + values(spark, "ts timestamp_ntz", [(datetime(2024, 3, 10, 2, 30),)], w=bin_start("ts", interval_of("1w")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert rows == [(datetime(2024, 3, 10),), (datetime(2024, 3, 4),)]


@pytest.mark.parametrize(
    ("ticker", "expected"),
    [
        ("X:BTC", "crypto"), ("EURUSD", "crypto"), ("aaveusdt", "crypto"), ("UNIT", "crypto"), ("SOLV", "crypto"),
        ("LINKX", "crypto"), ("SPY", "etf"), ("spy", "etf"), ("ABCETF", "etf"), ("XFUND", "etf"), ("AAPL", "equities"),
        ("USDX", "equities"), ("SPYX", "equities"),
    ],
)
def test_asset_type_by_symbol(spark, ticker, expected):
    assert values(spark, "t string", [(ticker,)], a=asset_type(F.col("t"))) == [(expected,)]


def test_asset_type_by_details(spark):
    rows = [("AAA", "CS", None), ("BBB", "etf", None), ("CCC", "ETP", "stocks"), ("DDD", None, "crypto"), ("EEE", None, None)]
    got = values(spark, "t string, y string, m string", rows, a=asset_type(F.col("t"), F.col("y"), F.col("m")))
    assert [g[0] for g in got] == ["equities", "etf", "etf", "crypto", "equities"]


def test_market_type(spark):
    rows = [
        ("BTC-USD", True, "CS"), ("X:ETH", True, None), ("EUR/USD", True, None), ("AAPL", True, "CS"),
        ("EUR/USD", False, "FX"), ("BTC-USD", False, None), ("SPY", None, "ETF"), ("Q", True, "WARRANT"),
    ]
    got = values(spark, "t string, s boolean, y string", rows, m=market_type(F.col("t"), F.col("s"), F.col("y")))
    assert [g[0] for g in got] == ["crypto", "crypto", "fx", "stocks", "fx", "stocks", "etf", "stocks"]


def test_days_behind_is_floored(spark):
    rows = [
        (date(2024, 1, 5), datetime(2024, 1, 4, 15, 59)),
        (date(2024, 1, 5), datetime(2024, 1, 5, 15, 59)),
        (date(2024, 1, 6), datetime(2024, 1, 4, 15, 59)),
        (date(2024, 1, 6), datetime(2024, 1, 4)),
        (date(2024, 1, 6), None),
    ]
    behind = days_behind(F.col("e"), F.col("l"))
    got = values(spark, "e date, l timestamp_ntz", rows, b=behind, c=lag_class(behind))
    assert got == [(0, "up_to_date"), (-1, "up_to_date"), (1, "recent_update"), (2, "significant_update"), (None, "missing")]


@pytest.mark.parametrize(
    ("label", "last", "expected"),
    [
        ("5m", datetime(2024, 1, 5, 15, 55), datetime(2024, 1, 5)),
        ("1m", datetime(2024, 1, 5, 23, 59), datetime(2024, 1, 6)),
        ("30s", datetime(2024, 1, 5, 15, 55, 30), datetime(2024, 1, 5, 15, 55, 31)),
        ("4h", datetime(2024, 1, 5, 20), datetime(2024, 1, 5)),
        ("1d", datetime(2024, 1, 5), datetime(2024, 1, 6)),
        ("1w", datetime(2024, 1, 1), datetime(2024, 1, 8)),
        ("1M", datetime(2024, 1, 1), datetime(2024, 2, 1)),
        ("3M", datetime(2024, 1, 1), datetime(2024, 2, 1)),
        ("1Q", datetime(2024, 1, 1), datetime(2024, 4, 1)),
        ("1Y", datetime(2024, 1, 1), datetime(2024, 12, 31)),
    ],
)
def test_resume_point(spark, label, last, expected):
    got = values(spark, "i string, l timestamp_ntz", [(label, last)], r=resume_point(F.col("i"), F.col("l")))
    assert got == [(expected,)]


def test_seconds_are_not_up_to_date_a_day_early(spark):
    rows = [(datetime(2024, 1, 5, 15), date(2024, 1, 5)), (datetime(2024, 1, 6), date(2024, 1, 5))]
    assert values(spark, "r timestamp_ntz, e date", rows, p=is_past(F.col("r"), F.col("e"))) == [(False,), (True,)]


def test_estimates(spark):
    rows = [("1h", 10), ("15m", 10), ("1d", 10), ("5m", 3), ("1m", 3), ("1h", 3)]
    got = values(spark, "i string, d bigint", rows, e=range_estimate(F.col("i"), F.col("d")))
    assert [g[0] for g in got] == [65, 260, 10, 234, 1170, 19]
    rows = [("4h", 10), ("45m", 10), ("1w", 10), ("1s", 10), ("1Q", 10), ("1m", 10), ("1h", 3)]
    got = values(spark, "i string, d bigint", rows, e=probe_estimate(F.col("i"), F.col("d")))
    assert [g[0] for g in got] == [65, 86, 10, 10, 10, 3900, 19]


def test_human_bytes(spark):
    rows = [(1023,), (1024,), (1536 * 1024,), (0,), (1024**5 * 3,), (12925,), (12928,), (1024**6 * 5,), (None,)]
    got = [g[0] for g in values(spark, "b bigint", rows, h=sizes.human_bytes(F.col("b")))]
    assert got == ["1023.00 B", "1.00 KB", "1.50 MB", "0.00 B", "3.00 PB", "12.62 KB", "12.62 KB", "5120.00 PB", None]


def test_ratio_guards(spark):
    rows = [(300, 100), (0, 0), (100, 0)]
    got = values(
        spark,
        "u bigint, c bigint",
        rows,
        r=sizes.compression_ratio(F.col("u"), F.col("c")),
        s=F.round(sizes.savings_pct(F.col("u"), F.col("c")), 2),
    )
    assert got == [(3.0, 66.67), (1.0, 0.0), (1.0, 100.0)]
    got = values(spark, "d bigint, t bigint", [(1, 3), (0, 0)], p=sizes.progress_pct(F.col("d"), F.col("t")))
    assert got == [(33.33,), (0.0,)]


def test_names(spark):
    rows = [("file:/x/2024-01-02/AAPL.parquet",), ("/d/AAPL.1m.parquet",), ("/d/_SUCCESS",), ("BRK.A.1h.csv",)]
    got = values(
        spark, "p string", rows,
        s=names.symbol_of(F.col("p")), m=names.stem_of(F.col("p")), i=names.interval_in(F.col("p")),
    )
    assert got[0][:2] == ("AAPL", "AAPL")
    assert got[1] == ("AAPL", "AAPL.1m", "1m")
    assert got[2][0] is None
    assert got[3][2] == "1h"


def test_day_names(spark):
    rows = [(datetime(2024, 1, 2, 3),)]
    got = values(spark, "t timestamp_ntz", rows, f=names.day_folder(F.col("t")), d=names.day_text(F.col("t")))
    assert got == [("2024/01/02", "2024-01-02")]


def test_keywords(spark):
    rows = [("A", "my test fund"), ("ATEMP", None), ("B", "Demonstration"), ("C", "plain")]
    found = names.holds_keyword(("TEST", "TEMP", "DEMO"), F.col("t"), F.col("n"))
    assert [g[0] for g in values(spark, "t string, n string", rows, k=found)] == [True, True, True, False]


def test_display_rank(spark):
    got = values(spark, "i string", [("1s",), ("1Y",), ("2m",), (None,)], r=display_rank(F.col("i")))
    assert [g[0] for g in got] == [0, 11, 999, 999]
