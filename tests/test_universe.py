import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import universe as u
from barloom.sources import store, universes

SCHEMA = "ticker string, name string, market string, locale string, primary_exchange string, type string, active boolean"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def instruments(spark):
    return spark.createDataFrame(
        [
            ("AAPL", "Apple", "stocks", "us", "XNAS", "CS", True),
            ("GONE", "Gone", "stocks", "us", "XNAS", "CS", False),
            ("SPY", "Spider", "stocks", "us", "ARCX", "ETF", True),
            ("SAP", "Sap", "stocks", "de", "XETR", "CS", True),
            ("X:BTC", "Bitcoin", "crypto", "global", "", "", True),
            ("X:DOG", "Doge", "crypto", "us", "", "", True),
            ("C:EUR", "Euro", "fx", "global", "", "", True),
            ("OTCX", "Otc", "otc", "us", "OTC", "CS", True),
        ],
        SCHEMA,
    )


def test_categories(instruments):
    got = rows_of(u.discover(instruments), "category", "ticker")
    assert got == [
        ("crypto", "X:BTC"), ("crypto", "X:DOG"), ("etf", "SPY"), ("fx", "C:EUR"), ("otc", "OTCX"), ("us_equities", "AAPL"),
    ]
    assert rows_of(u.discover(instruments, only=["crypto"], limit=1), "ticker") == [("X:BTC",)]
    with pytest.raises(ValueError):
        u.discover(instruments, only=["bonds"])


def test_limits_beyond_the_window_threshold(spark, instruments):
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "0")
    try:
        got = rows_of(u.discover(instruments, limit=1), "category", "ticker")
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert got == rows_of(u.discover(instruments, limit=1), "category", "ticker")
    assert len(got) == 5


def test_filter(spark):
    rows = [("A", "my test co", "N"), ("B", "temp", "N"), ("CDEMO", "x", "N"), ("D", "Delta", "N"), ("E", "Echo", "Q"), ("F", None, "N")]
    df = spark.createDataFrame(rows, "ticker string, name string, primary_exchange string")
    assert rows_of(u.filter_universe(df), "ticker") == [("D",), ("E",)]
    assert rows_of(u.filter_universe(df, exchange="N"), "ticker") == [("D",)]
    assert rows_of(u.filter_universe(df, min_name_length=0), "ticker") == [("D",), ("E",), ("F",)]
    assert len(rows_of(u.filter_universe(df, exclude_test=False), "ticker")) == 5


def test_batches(spark):
    df = spark.createDataFrame([(f"T{i:03d}",) for i in range(1, 251)], "ticker string")
    chosen = rows_of(u.batches(df, 100, 1, 1), "batch_number", "ticker")
    assert chosen[0] == (2, "T101") and chosen[-1] == (2, "T200") and len(chosen) == 100
    columns = ("total_tickers", "total_batches", "processed_batches", "remaining_batches")
    assert rows_of(u.batch_report(df, 100, 1, 1), *columns) == [(250, 3, 1, 1)]
    assert rows_of(u.batch_report(df, 100), *columns) == [(250, 3, 3, 0)]
    assert rows_of(u.batch_report(df, 100, 2, 0), *columns) == [(250, 3, 1, 0)]
    assert rows_of(u.batch_report(df, 100, 2, 9), *columns) == [(250, 3, 1, 0)]
    assert u.batches(df, 100).count() == 250


def test_discovery_report(spark):
    schema = "category string, ticker string"
    known = spark.createDataFrame([("fx", "A"), ("fx", "B")], schema)
    found = spark.createDataFrame([("fx", "B"), ("fx", "C"), ("fx", None), ("otc", "A")], schema)
    got = rows_of(u.discovery_report(known, found), "category", "count", "new_tickers_added")
    assert got == [("fx", 3, 1), ("otc", 1, 1)]


def test_documents_with_objects_and_plain_symbols(spark, tmp_path):
    docs = {
        "a.json": {"category": "fx", "created_at": "2024-01-02T00:00:00", "count": 2, "new_tickers_added": 1,
                   "tickers": [{"ticker": "A", "name": "x", "active": True}, {"ticker": "B", "name": None}]},
        "b.json": {"created_at": "2024-01-03T00:00:00", "tickers": ["C", "D"]},
    }
    for name, doc in docs.items():
        (tmp_path / name).write_text(json.dumps(doc, indent=2))
    (tmp_path / "broken.json").write_text("{ not json")
    read = universes.read_documents(spark, str(tmp_path))
    got = universes.entries(read)
    assert rows_of(got, "ticker") == [("A",), ("B",), ("C",), ("D",)]
    assert got.where("ticker = 'A'").collect()[0]["active"] is True
    listed = u.list_universes(universes.headers(read)).collect()
    assert [(r["category"], r["created_at"][:10], r["count"]) for r in listed] == [
        ("unknown", "2024-01-03", 0),
        ("fx", "2024-01-02", 2),
    ]
    assert all(r["file_size_mb"] > 0 for r in listed)


def test_documents_are_cut_into_parts(spark, instruments, tmp_path):
    many = spark.range(1000).select(
        F.when(F.col("id") % 10 == 0, "fx").otherwise("otc").alias("category"), F.concat(F.lit("T"), "id").alias("ticker")
    )
    totals = many.groupBy("category").agg(F.count("*").alias("count"), F.lit(0).cast("bigint").alias("new_tickers_added"))
    docs = universes.documents(many, totals, datetime(2024, 1, 31), per_document=100)
    assert docs.where("size(tickers) > 200").count() == 0 and docs.where("category = 'otc'").count() == 9
    path = str(tmp_path / "u")
    universes.write_documents(docs, path)
    read = universes.read_written(spark, path)
    assert universes.entries(read).select("ticker").distinct().count() == 1000
    headers = rows_of(universes.headers(read), "category", "count")
    assert headers == [("fx", 100), ("otc", 900)]
    store.delete_universe(spark, path, "otc")
    assert rows_of(universes.headers(universes.read_written(spark, path)), "category") == [("fx",)]
    with pytest.raises(LookupError):
        store.delete_universe(spark, path, "otc")


def test_latest_snapshot_and_samples(spark):
    headers = spark.createDataFrame([("fx", "2024-01-01", 1), ("fx", "2024-01-03", 2), ("otc", "2024-01-02", 3)], "category string, created_at string, count bigint")
    assert rows_of(u.latest_snapshots(headers), "category", "count") == [("fx", 2), ("otc", 3)]
    tickers = spark.createDataFrame([(f"T{i:02d}",) for i in range(30)] * 2, "ticker string")
    assert u.sample_names(tickers).collect()[0]["sample"] == [f"T{i:02d}" for i in range(10)]
    assert [r["ticker"] for r in u.sorted_tickers(tickers).collect()][:2] == ["T00", "T01"]


def test_duplicate_details_keep_one_row_each(spark):
    bars = spark.createDataFrame([("ABC", 1.0)], "ticker string, close double")
    details = spark.createDataFrame([("ABC", "CS", None), ("ABC", "ETF", None)], "ticker string, type string, market string")
    assert rows_of(u.with_asset_type(bars, details), "ticker", "close", "asset_type") == [("ABC", 1.0, "etf")]


def test_filters_above_a_lookup_reach_the_scan(spark, tmp_path, final_plan):
    path = str(tmp_path / "bars")
    spark.createDataFrame([("ABC", 1.0), ("DEF", 2.0)], "ticker string, close double").write.parquet(path)
    details = spark.createDataFrame([("ABC", "ETF", None)], "ticker string, type string, market string")
    found = u.with_asset_type(spark.read.parquet(path), details).where("ticker = 'ABC'")
    assert "EqualTo(ticker,ABC)" in found._jdf.queryExecution().executedPlan().toString()
    assert rows_of(found, "ticker", "asset_type") == [("ABC", "etf")]


def test_a_category_without_totals_is_written(spark, instruments):
    found = u.discover(instruments)
    totals = spark.createDataFrame([("crypto", 2, 0)], "category string, count long, new_tickers_added long")
    docs = universes.documents(found, totals, datetime(2024, 1, 1))
    got = {r.category: (r["count"], r.new_tickers_added) for r in docs.collect()}
    assert got == {"crypto": (2, 0), "etf": (1, 1), "fx": (1, 1), "otc": (1, 1), "us_equities": (1, 1)}
