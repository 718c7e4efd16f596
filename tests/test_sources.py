from datetime import date, datetime

import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from barloom.operators import calendar, profile, query, storage
from barloom.operators.bars import bars_from_ticks, day_file_bars
from barloom.plans.backfill import backfill
from barloom.plans.bar_building import build_bars, building_report
from barloom.sources import landed, store, ticks


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def hours(*values):
    return [datetime(2024, 1, 1 + h // 24, h % 24) for h in values]


@pytest.fixture
def bars(spark):
    rows = [(t, i, ts, float(n)) for t in ("AAA", "BBB") for i in ("1h", "1M") for n, ts in enumerate([*hours(0, 1, 30), datetime(2024, 2, 1)])]
    return spark.createDataFrame(rows, "ticker string, interval string, timestamp timestamp_ntz, close double")


def test_tick_files_as_pandas_writes_them(spark, tmp_path):
    day = tmp_path / "trades" / "2024-01-02"
    day.mkdir(parents=True)
    frame = pd.DataFrame({"timestamp": pd.to_datetime(["2024-01-02 10:00:01", "2024-01-02 10:00:02"]), "price": [1.0, 2.0], "size": [3, 4]})
    frame.to_parquet(day / "AAPL.parquet")
    frame.drop(columns=["price"]).to_parquet(day / "BAD.parquet")
    read = ticks.read_tick_days(spark, str(tmp_path), date(2024, 1, 1), date(2024, 1, 7))
    built = bars_from_ticks(read, "1m")
    assert rows_of(built, "ticker", "timestamp", "open", "close", "volume") == [("AAPL", datetime(2024, 1, 2, 10), 1.0, 2.0, 7)]
    files = storage.list_files(spark, str(tmp_path))
    report = ticks.day_file_report(files, ["AAPL"], date(2024, 1, 1), date(2024, 1, 7))
    got = rows_of(report, "date", "status", "files_downloaded")
    assert [g[0].day for g in got] == [1, 2, 3, 4, 5]
    assert got[1][1:] == ("success", 1) and got[0][1:] == ("no_data", 0)


def test_tick_lake(spark, tmp_path):
    rows = [("A", datetime(2024, 1, d, 10), 1.0, 1, d) for d in (1, 2, 6)] + [("B", datetime(2023, 12, 29), 1.0, 1, 9)]
    df = spark.createDataFrame(rows, "ticker string, timestamp timestamp_ntz, price double, size bigint, seq bigint")
    path = str(tmp_path / "lake")
    ticks.write_tick_lake(df, path)
    lake = ticks.read_tick_lake(spark, path)
    assert [r["date"].day for r in calendar.available_dates(lake, 2024).collect()] == [1, 2, 6]
    assert [r["date"].day for r in ticks.lake_dates(spark, path, 2024).collect()] == [1, 2, 6]
    assert ticks.lake_dates(spark, path).count() == 4
    one_day = lake.where(F.col("date") == date(2024, 1, 2))
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert day_file_bars(one_day, "1h").count() == 1


def test_calendar(spark):
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 31))], "start_date date, end_date date")
    spine = calendar.day_spine(bounds)
    assert spine.count() == 23 and calendar.day_spine(bounds, weekdays=False).count() == 31
    rows = spark.createDataFrame([(datetime(2024, 1, 2, 5),), (datetime(2024, 1, 6),)], "timestamp timestamp_ntz")
    covered = calendar.day_coverage(spine, calendar.rows_per_day(rows))
    assert covered.where("status = 'success'").count() == 1 and covered.count() == 23
    dates = rows.select(F.col("timestamp").cast("date").alias("date"))
    assert calendar.missing_days(spine, dates).count() == 22
    assert calendar.day_bounds(rows.limit(0)).count() == 0


def test_range_keeps_only_midnight_of_the_end_day(spark):
    rows = [("A", "1h", ts, 1.0) for ts in (datetime(2024, 1, 4), datetime(2024, 1, 5), datetime(2024, 1, 5, 15))]
    df = spark.createDataFrame(rows, "ticker string, interval string, timestamp timestamp_ntz, close double")
    assert query.select_series(df, "a", "1h", end=date(2024, 1, 5)).count() == 2
    assert query.select_series(df, "a", "1h", start=date(2024, 1, 5)).count() == 2
    header = query.series_header(query.select_series(df, "a", "1h")).collect()[0]
    assert header["records"] == 3
    assert query.first_rows(df, ["close"], 2).count() == 2
    assert rows_of(query.with_normal_ticker(df.withColumn("ticker", F.lit("aa"))), "ticker")[0] == ("AA",)


def test_landed_bars(spark):
    schema = "ticker string, interval string, t string, o string, h string, l string, c string, v string, vw string, n string"
    ms = "1704189600000"
    rows = [
        ("a", "1h", ms, "1", "2", "0.5", "1.5", "10.9", None, "3"),
        ("a", "1h", ms, "1", "2", "0.5", "1.5", None, "1.2", None),
        ("a", "1h", ms, "x", "2", "0.5", "1.5", "1", None, None),
        ("a", "1h", None, "1", "2", "0.5", "1.5", "1", None, None),
        ("a", "1h", ms, "1", "2", "0.5", "1.5", "many", None, None),
        ("a", "1h", ms, "1", "2", "0.5", "1.5", "NaN", None, None),
    ]
    parsed = landed.normalise_bars(spark.createDataFrame(rows, schema))
    good = rows_of(landed.accepted(parsed), "ticker", "timestamp", "volume", "vwap", "transactions")
    assert sorted(good, key=str) == sorted(
        [("A", datetime(2024, 1, 2, 10), 10, None, 3), ("A", datetime(2024, 1, 2, 10), 0, 1.2, None)], key=str
    )
    assert rows_of(landed.rejected(parsed), "reject_reason") == [("open",), ("time",), ("volume",), ("volume",)]
    lines = spark.createDataFrame([('{"ticker":"a","t":1704189600000,"o":1.5}',), ("not json",)], "value string")
    parsed = landed.parse_json_rows(lines, landed.RAW_BAR).collect()
    assert (parsed[0]["t"], parsed[0]["o"], parsed[1]["ticker"]) == ("1704189600000", "1.5", None)


def test_landed_instruments_and_market_days(spark):
    rows = [("A", "x", "stocks", "us", "N", "CS", "true"), ("B", None, "stocks", "us", "N", "CS", "true"), ("C", "x", "stocks", "us", "N", "CS", "maybe")]
    raw = spark.createDataFrame(rows, "ticker string, name string, market string, locale string, primary_exchange string, type string, active string")
    parsed = landed.normalise_instruments(raw)
    assert rows_of(landed.accepted(parsed), "ticker") == [("A",)]
    assert rows_of(landed.rejected(parsed), "ticker", "reject_reason") == [("B", "name"), ("C", "active")]
    days = spark.createDataFrame(
        [("A", None, 1.0, 10.5), (None, "B", 2.0, None), (None, None, 3.0, 1.0), ("", None, 3.0, 1.0)],
        "T string, ticker string, o double, v double",
    ).selectExpr("*", "o as h", "o as l", "o as c", "o as vw", "1L as n")
    got = landed.normalise_market_days(days, F.lit(date(2024, 1, 2)))
    assert rows_of(got, "ticker", "timestamp", "open", "volume")[0] == ("A", datetime(2024, 1, 2), 1.0, 10)
    assert got.count() == 2
    bounds = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 3))], "start_date date, end_date date")
    report = landed.market_day_report(got, calendar.day_spine(bounds))
    assert rows_of(report, "date", "status", "tickers_saved")[1] == (date(2024, 1, 2), "success", 2)
    assert rows_of(landed.market_range_totals(report), "trading_days_processed", "days_with_data") == [(3, 1)]


def test_store_merge_touches_only_its_partitions(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    assert store.read_bars(spark, path).count() == 0
    store.merge_bars(spark, bars, path)
    assert store.read_bars(spark, path).count() == 16
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "bars" / "bars").rglob("*.parquet")}
    change = spark.createDataFrame([("AAA", "1h", hours(1)[0], 99.0), ("CCC", "1h", hours(5)[0], 5.0)], bars.schema)
    for _ in range(2):
        store.merge_bars(spark, change, path)
    stored = store.read_bars(spark, path)
    assert stored.count() == 17
    assert rows_of(stored.where("ticker = 'AAA' and interval = '1h'"), "close") == [(0.0,), (2.0,), (3.0,), (99.0,)]
    # what was there is not written again, and what is new touches the changed period alone
    assert all(f.stat().st_mtime_ns == at for f, at in before.items())
    assert {f.parent.name for f in (tmp_path / "bars" / "bars" / "run=2").rglob("*.parquet")} == {"period=2024"}
    # labels that differ only in case stay apart
    assert stored.where("interval = '1M'").count() == 8 and stored.where("interval = '1m'").count() == 0


def test_store_reads_prune(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    store.write_bars(store.shape_bars(bars), path)
    series = query.select_series(store.read_bars(spark, path), "AAA", "1h", date(2024, 2, 1), date(2024, 2, 28)).select("close")
    plan = series._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "interval" in filters and "period" in filters and "bucket" in filters
    assert "PushedFilters: [IsNotNull(ticker)" in plan
    assert "vwap" not in plan.split("ReadSchema")[1]
    assert rows_of(series, "close") == [(3.0,)]


def test_second_bars_are_stored_by_day(spark, tmp_path):
    path = str(tmp_path / "bars")
    rows = [("A", label, datetime(2024, 1, d, 5), float(d)) for label in ("1s", "1m") for d in (1, 15, 31)]
    df = spark.createDataFrame(rows, "ticker string, interval string, timestamp timestamp_ntz, close double")
    store.merge_bars(spark, df, path)
    folders = {p.parent.name + "/" + p.name for p in (tmp_path / "bars").rglob("interval=*/period=*")}
    assert folders == {"interval=1s/period=2024-01-01", "interval=1s/period=2024-01-15", "interval=1s/period=2024-01-31", "interval=1m/period=2024-01"}
    stored = store.read_bars(spark, path)
    for label in ("1s", "1m"):
        def close(start, end):
            return rows_of(query.select_series(stored, "A", label, start, end), "close")

        assert close(date(2024, 1, 2), date(2024, 1, 31)) == [(15.0,)]
        assert close(date(2024, 1, 15), date(2024, 2, 1)) == [(15.0,), (31.0,)]
        assert close(None, date(2024, 1, 16)) == [(1.0,), (15.0,)]
        assert close(date(2023, 12, 31), None) == [(1.0,), (15.0,), (31.0,)]
    day = stored.where("interval = '1s'").where(F.col("period") == "2024-01-15")
    assert day.count() == 1


def test_store_delete(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    store.write_bars(store.shape_bars(bars), path)
    assert store.delete_series(spark, path, "aaa", "1M") == 4
    assert store.read_bars(spark, path).count() == 12
    assert store.delete_series(spark, path, "BBB") == 8
    stored = store.read_bars(spark, path)
    assert rows_of(stored, "ticker", "interval") == [("AAA", "1h")] * 4
    with pytest.raises(LookupError):
        store.delete_series(spark, path, "BBB")


def test_store_writes_one_file_per_partition(spark, bars, tmp_path):
    path = tmp_path / "bars"
    store.write_bars(store.shape_bars(bars.repartition(8)), str(path))
    assert len(list((path / "bars").rglob("*.parquet"))) == len(list((path / "bars").rglob("period=*"))) > 0


def test_text_formats_keep_micros(spark, bars, tmp_path):
    fine = store.shape_bars(bars.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL '0.000123' SECOND")))
    store.write_bar_csv(fine, str(tmp_path / "csv"), single=True)
    store.write_bar_json(fine, str(tmp_path / "json"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 1
    expected = rows_of(fine.drop("vwap"), "ticker", "interval", "timestamp", "close")
    for read in (store.read_bar_csv(spark, str(tmp_path / "csv")), store.read_bar_json(spark, str(tmp_path / "json"))):
        assert rows_of(read, "ticker", "interval", "timestamp", "close") == expected
    text = "asset_type,ticker,interval,timestamp,open,high,low,close,volume,vwap,transactions,ingest_seq\nequities,A,1d,2024-01-02 10:00:00,1,1,1,1,5,,,0\n"
    (tmp_path / "plain").mkdir()
    (tmp_path / "plain" / "a.csv").write_text(text)
    assert rows_of(store.read_bar_csv(spark, str(tmp_path / "plain")), "timestamp", "volume") == [(datetime(2024, 1, 2, 10), 5)]


def test_per_ticker_files_as_pandas_writes_them(spark, tmp_path):
    full = pd.DataFrame({"timestamp": pd.to_datetime(["2024-01-02"]), "open": [1.0], "high": [1.0], "low": [1.0], "close": [2.0], "volume": [5], "vwap": [1.5], "transactions": [3]})
    indexed = full.drop(columns=["vwap", "transactions"]).set_index("timestamp")
    for kind, ticker, label, frame in (("equities", "AAPL", "1d", full), ("crypto", "BTCUSD", "1M", indexed)):
        folder = tmp_path / kind / ticker
        folder.mkdir(parents=True)
        frame.to_parquet(folder / f"{ticker}.{label}.parquet")
    (tmp_path / "equities" / "AAPL" / "AAPL.1h.parquet").write_text("damaged")
    read = store.read_bar_files(spark, str(tmp_path))
    got = sorted((tuple(r) for r in read.select("asset_type", "interval", "timestamp", "close", "volume", "vwap").collect()))
    assert got == [
        ("crypto", "1M", datetime(2024, 1, 2), 2.0, 5, None),
        ("equities", "1d", datetime(2024, 1, 2), 2.0, 5, 1.5),
    ]


def test_backfill(spark, tmp_path):
    path = str(tmp_path / "bars")
    schema = "ticker string, interval string, timestamp timestamp_ntz, close double, ingest_seq bigint"
    days = [datetime(2024, 1, d) for d in range(1, 6)]
    landed_rows = spark.createDataFrame(
        [(t, "1d", d, 1.0, 1) for t in "AB" for d in days] + [("A", "1d", days[4], 7.0, 2)], schema
    )
    offered = spark.createDataFrame(
        [(t, "1d", date(2024, 1, 1), date(2024, 1, 5)) for t in "ABC"],
        "ticker string, interval string, start_date date, end_date date",
    )
    store.write_bars(store.shape_bars(landed_rows.where("ticker = 'A' and timestamp < '2024-01-04'")), path)
    columns = ("ticker", "status", "new_records", "total_records")
    report = backfill(spark, offered, landed_rows, path)
    assert rows_of(report, *columns) == [("A", "success", 2, 5), ("B", "success", 5, 5), ("C", "no_new_data", 0, 0)]
    assert rows_of(store.read_bars(spark, path).where("ticker = 'A'"), "close")[-1] == (7.0,)
    again = backfill(spark, offered, landed_rows, path)
    assert rows_of(again, *columns) == [("A", "up_to_date", 0, 5), ("B", "up_to_date", 0, 5), ("C", "no_new_data", 0, 0)]
    forced = backfill(spark, offered, landed_rows, path, force_refresh=True)
    assert rows_of(forced, *columns)[0] == ("A", "success", 5, 5)


def test_build_bars(spark, tmp_path):
    rows = [("AAA", datetime(2024, 1, 1, h), float(h), 1, h) for h in range(24)] + [("X:B", datetime(2024, 1, 1), 1.0, 1, 99)]
    df = spark.createDataFrame(rows, "ticker string, timestamp timestamp_ntz, price double, size bigint, seq bigint")
    path = str(tmp_path / "bars")
    build_bars(spark, df, ["1h", "1d"], path, tie_break="seq")
    stored = store.read_bars(spark, path)
    assert rows_of(stored.where("interval = '1d'"), "asset_type", "ticker", "open", "close") == [
        ("crypto", "X:B", 1.0, 1.0),
        ("equities", "AAA", 0.0, 23.0),
    ]
    assert rows_of(building_report(stored), "interval", "symbols_processed", "symbols")[0] == ("1d", 2, "AAA,X:B")


def test_profiles(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    store.write_bars(store.shape_bars(bars), path)
    stored = store.read_bars(spark, path)
    sizes = profile.file_sizes(stored)
    asked = spark.createDataFrame([("AAA", "1h"), ("QQQ", "1h")], "ticker string, interval string")
    summary = profile.series_summary(stored, asked, sizes).collect()
    by_ticker = {r["ticker"]: r for r in summary}
    assert by_ticker["AAA"]["status"] == "available" and by_ticker["AAA"]["file_size_mb"] > 0
    assert by_ticker["QQQ"]["status"] == "no_data"
    shape = profile.series_profile(stored, sizes)
    assert rows_of(shape, "ticker", "interval", "records", "date_range_days")[0] == ("AAA", "1M", 4, 31)
    totals = profile.overall_statistics(shape)
    assert rows_of(totals, "ticker", "total_records", "total_days") == [("AAA", 8, 31), ("BBB", 8, 31)]
    assert rows_of(profile.store_statistics(stored), "tickers", "series") == [(2, 4)]
    ends = profile.first_last_bars(stored).where("ticker = 'AAA' and interval = '1h'").collect()[0]
    assert (ends["first_timestamp"], ends["last_close"]) == (datetime(2024, 1, 1), 3.0)


def test_footers_equal_pyarrow(spark, bars, tmp_path):
    path = tmp_path / "bars"
    store.write_bars(store.shape_bars(bars), str(path))
    path = path / "bars"
    files = storage.list_files(spark, str(path))
    chunks = storage.column_chunks(files)
    small = big = rows = 0
    for file in path.rglob("*.parquet"):
        footer = pq.ParquetFile(file).metadata
        rows += footer.num_rows
        for g in range(footer.num_row_groups):
            for c in range(footer.num_columns):
                small += footer.row_group(g).column(c).total_compressed_size
                big += footer.row_group(g).column(c).total_uncompressed_size
    report = storage.file_report(chunks, files)
    sums = report.agg(F.sum("total_compressed_size"), F.sum("total_uncompressed_size"), F.sum("num_rows")).collect()[0]
    assert tuple(sums) == (small, big, rows) and rows == 16
    first = report.collect()[0]
    assert first["num_columns"] == 11 and first["file_size_disk_human"].endswith("KB")
    assert storage.chunk_report(chunks).where("ratio <= 0").count() == 0


def test_compare_and_file_names(spark, tmp_path):
    for name in ("AAPL.1m", "AAPL.1h", "MSFT.1m"):
        pd.DataFrame({"x": range(100)}).to_parquet(tmp_path / f"{name}.parquet")
    files = storage.list_files(spark, str(tmp_path))
    listed = rows_of(storage.ticker_files(files), "ticker", "interval")
    assert listed == [("AAPL", "1h"), ("AAPL", "1m"), ("MSFT", "1m")]
    compared = storage.compare_intervals(storage.file_report(storage.column_chunks(files)))
    assert rows_of(compared, "ticker", "files", "rows") == [("AAPL", 2, 200), ("MSFT", 1, 100)]


def test_tick_files_of_mixed_columns_and_missing_days(spark, tmp_path):
    day = tmp_path / "trades" / "2024-01-02"
    day.mkdir(parents=True)
    times = pd.to_datetime(["2024-01-02 10:00:01", "2024-01-02 10:00:02"])
    pd.DataFrame({"timestamp": times}).to_parquet(day / "AAA.parquet")
    pd.DataFrame({"timestamp": times, "price": [1.0, 2.0]}).to_parquet(day / "BBB.parquet")
    pd.DataFrame({"timestamp": times, "price": [1.0, 2.0], "size": [3, 4]}).to_parquet(day / "CCC.parquet")
    built = bars_from_ticks(ticks.read_tick_days(spark, str(tmp_path), date(2024, 1, 1), date(2024, 1, 7)), "1m")
    assert rows_of(built, "ticker", "volume") == [("BBB", 0), ("CCC", 7)]
    nothing = ticks.read_tick_days(spark, str(tmp_path), date(2023, 1, 1), date(2023, 1, 7))
    assert bars_from_ticks(nothing, "1m").count() == 0


def test_all_rows_without_a_limit(spark):
    df = spark.range(2500).select(F.lit("A").alias("ticker"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id, 0)").alias("timestamp"))
    assert query.first_rows(df).count() == 2500
    assert query.first_rows(df, limit=query.ROW_LIMIT).count() == 1000


def test_writers_agree_on_identity(spark):
    df = spark.createDataFrame([("x:btcusd",), ("spy",), ("aapl",)], "ticker string").withColumns({"interval": F.lit("1d"), "timestamp": F.expr("timestamp_ntz'2024-01-01'")})
    assert rows_of(store.shape_bars(df), "asset_type", "ticker") == [("crypto", "X:BTCUSD"), ("equities", "AAPL"), ("etf", "SPY")]


def test_backfill_does_not_hang_on_partitioning(spark, tmp_path):
    when = datetime(2024, 1, 3)
    ranges = spark.createDataFrame([("A", "1d", date(2024, 1, 1), date(2024, 1, 5))], "ticker string, interval string, start_date date, end_date date")
    landed_rows = spark.createDataFrame([("A", "1d", when, float(n)) for n in range(6)], "ticker string, interval string, timestamp timestamp_ntz, close double")
    found = set()
    for parts in (1, 3, 6):
        path = str(tmp_path / str(parts))
        backfill(spark, ranges, landed_rows.repartition(parts), path)
        found.add(store.read_bars(spark, path).first().close)
    assert len(found) == 1
    last = landed_rows.withColumn("ingest_seq", F.col("close").cast("long")).repartition(3)
    backfill(spark, ranges, last, str(tmp_path / "last"))
    assert store.read_bars(spark, str(tmp_path / "last")).first().close == 5.0


def test_classes_of_folders_read_few_footers(spark, tmp_path, monkeypatch):
    """Folders with one kind of columns are one scan; a file of each folder is looked at, more only while a column lacks."""
    times = pd.to_datetime(["2024-01-02 10:00:01", "2024-01-02 10:00:02"]).astype("datetime64[us]")
    for day in (2, 3, 4, 5):
        folder = tmp_path / "trades" / f"2024-01-0{day}"
        folder.mkdir(parents=True)
        for k, name in enumerate(("AAA", "BBB", "CCC")):
            frame = pd.DataFrame({"timestamp": times, "price": [1.5, 2.5], "size": [3, 4]})
            if day == 4:
                frame = frame.assign(price=["1.5", "2.5"])
            if day == 5:
                frame = frame.drop(columns=["price"] if k == 0 else ["size"])
            frame.to_parquet(folder / f"{name}.parquet")
    looked = []
    monkeypatch.setattr(ticks, "file_schema", lambda s, path, plain=ticks.file_schema: looked.append(path) or plain(s, path))
    read = ticks.read_tick_days(spark, str(tmp_path), date(2024, 1, 1), date(2024, 1, 7))
    assert len(looked) == 5
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2
    built = bars_from_ticks(read, "1d")
    # Sizes count where the price is unknown, and are nought where they are.
    assert rows_of(built, "ticker", "open", "volume") == [("AAA", 1.5, 28), ("BBB", 1.5, 21), ("CCC", 1.5, 21)]
    assert ticks.read_tick_folders(spark, []).isEmpty()
