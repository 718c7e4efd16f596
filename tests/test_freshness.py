from datetime import date, datetime

from pyspark.sql import functions as F

from barloom.operators import freshness as fr
from barloom.plans.verification import verify

RANGES = "ticker string, interval string, start_date date, end_date date"
BARS = "ticker string, interval string, timestamp timestamp_ntz"


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def ranges(spark, *rows):
    return spark.createDataFrame([(t, i, date(2024, 1, 1), e) for t, i, e in rows], RANGES)


def sample(spark):
    offered = ranges(
        spark,
        ("A", "1m", date(2024, 1, 5)), ("A", "1d", date(2024, 1, 5)),
        ("B", "1m", date(2024, 1, 9)), ("B", "1h", date(2024, 1, 9)), ("B", "1d", date(2024, 1, 9)),
        ("C", "1d", date(2024, 1, 9)),
    )
    bars = spark.createDataFrame(
        [
            ("A", "1m", datetime(2024, 1, 4, 15, 59)), ("A", "1d", datetime(2024, 1, 5)),
            ("B", "1m", datetime(2024, 1, 9, 10)), ("B", "1h", datetime(2024, 1, 6, 10)), ("Z", "1d", datetime(2024, 1, 6)),
        ],
        BARS,
    )
    return offered, bars


def test_verification(spark):
    offered, bars = sample(spark)
    universe = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    per_ticker, totals = verify(offered, bars, universe)
    assert rows_of(per_ticker, "ticker", "status", "up_to_date", "needs_update", "missing") == [
        ("A", "COMPLETE", "1m,1d", "", ""),
        ("B", "PARTIAL", "1m", "1h (2d behind)", "1d"),
        ("C", "MISSING", "", "", "1d"),
        ("D", "no_api_data", "", "", ""),
    ]
    row = totals.collect()[0].asDict()
    assert row == {
        "tickers_complete": 1, "tickers_partial": 1, "tickers_missing": 2, "timeframes_up_to_date": 3,
        "timeframes_need_update": 1, "timeframes_missing": 2, "total_tasks_needed": 3,
    }
    assert row["tickers_complete"] + row["tickers_partial"] + row["tickers_missing"] == 4


def test_plan_outcome(spark):
    offered, bars = sample(spark)
    fresh = fr.freshness(offered, fr.high_water_marks(bars))
    universe = spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "ticker string")
    got = rows_of(fr.plan_outcome(fresh, universe), "ticker", "status", "timeframes_available", "tasks_created")
    assert got == [
        ("A", "all_up_to_date", 2, 0),
        ("B", "partial_update", 3, 2),
        ("C", "full_download", 1, 1),
        ("D", "no_data", 0, 0),
    ]


def test_availability(spark):
    bars = spark.createDataFrame(
        [("A", "1h", datetime(2024, 1, d, 12)) for d in (1, 5, 11)] + [("A", "45m", datetime(2024, 1, 3))], BARS
    )
    by_range = rows_of(fr.available_ranges(bars, "range"), "interval", "days_available", "estimated_bars")
    assert by_range == [("1h", 10, 65), ("45m", 0, 0)]
    listed = spark.createDataFrame([("A", "2024-01-04")], "ticker string, list_date string")
    late = rows_of(fr.available_ranges(bars, "range", listed), "interval", "start_date", "days_available")
    assert late == [("1h", date(2024, 1, 5), 6)]
    before_epoch = spark.createDataFrame([("A", "1950-01-04")], "ticker string, list_date string")
    assert fr.available_ranges(bars, "range", before_epoch).count() == 2
    asked = spark.createDataFrame([("A", "1h"), ("Q", "1d")], "ticker string, interval string")
    answers = rows_of(fr.answer_ranges(asked, fr.available_ranges(bars)), "ticker", "days_available", "data_available")
    assert answers == [("A", 10, True), ("Q", 0, False)]
    flags = fr.timeframe_flags(fr.available_ranges(bars)).collect()[0]
    assert (flags["total_timeframes"], flags["has_seconds"], flags["has_intraday"], flags["has_hourly"]) == (2, False, True, True)
    nested = fr.timeframe_map(fr.available_ranges(bars)).collect()[0]["timeframes"]
    assert nested["1h"]["days_available"] == 10 and set(nested) == {"1h", "45m"}


def test_resume_and_report(spark):
    offered, bars = sample(spark)
    marks = fr.high_water_marks(bars)
    resume = fr.resume_points(offered, marks)
    got = {(r["ticker"], r["interval"]): (r["resume_from"], r["action"]) for r in resume.collect()}
    assert got[("A", "1d")] == (datetime(2024, 1, 6), "up_to_date")
    assert got[("A", "1m")] == (datetime(2024, 1, 4), "fetch")
    assert got[("C", "1d")] == (datetime(2024, 1, 1), "fetch")
    forced = fr.resume_points(offered, marks, force_refresh=True)
    assert {r["resume_from"] for r in forced.collect()} == {datetime(2024, 1, 1)}
    landed = spark.createDataFrame(
        [
            ("A", "1d", datetime(2024, 1, 7)),
            ("A", "1m", datetime(2024, 1, 3, 23)), ("A", "1m", datetime(2024, 1, 5, 23)), ("A", "1m", datetime(2024, 1, 6)),
            ("C", "1d", datetime(2024, 1, 2)), ("Q", "1d", datetime(2024, 1, 2)),
        ],
        BARS,
    )
    due = fr.rows_to_fetch(landed, resume)
    assert rows_of(due, *landed.columns) == [
        ("A", "1m", datetime(2024, 1, 5, 23)),
        ("C", "1d", datetime(2024, 1, 2)),
    ]
    report = fr.fetch_report(resume, due, bars)
    assert rows_of(report, "ticker", "interval", "status", "new_records") == [
        ("A", "1d", "up_to_date", 0), ("A", "1m", "success", 1), ("B", "1d", "no_new_data", 0),
        ("B", "1h", "no_new_data", 0), ("B", "1m", "no_new_data", 0), ("C", "1d", "success", 1),
    ]
    extra = report.select("ticker", "status", "new_records").unionByName(
        spark.createDataFrame([("A", "timeframe_detection", 0)], "ticker string, status string, new_records bigint")
    )
    got = rows_of(fr.load_summary(extra), "ticker", "intervals_total", "intervals_completed", "total_new_records")
    assert got == [("A", 2, 1, 1), ("B", 3, 0, 0), ("C", 1, 1, 1)]


def test_prefilter(spark):
    now = datetime(2024, 1, 31)
    schema = "ticker string, interval string, modified timestamp_ntz, last_timestamp timestamp_ntz, path string"

    def files(ticker, n, modified, last):
        labels = ["1m", "5m", "1h", "1d"][:n]
        old = datetime(2023, 1, 1)
        return [(ticker, x, modified if x == "1m" else old, last if x == "1m" else old, f"{ticker}.{x}") for x in labels]

    rows = (
        files("few", 2, datetime(2024, 1, 30, 23), now)
        + files("fresh", 3, datetime(2024, 1, 30, 1), datetime(2020, 1, 1))
        + files("recent", 4, datetime(2024, 1, 28, 12), datetime(2024, 1, 29, 1))
        + files("stale", 3, datetime(2024, 1, 28, 12), datetime(2024, 1, 28))
        + files("old", 3, datetime(2024, 1, 27), now)
        + files("edge", 3, datetime(2024, 1, 30), datetime(2020, 1, 1))
    )
    per_ticker = fr.series_files(spark.createDataFrame(rows, schema))
    assert {r["newest_path"] for r in per_ticker.where("ticker = 'fresh'").collect()} == {"fresh.1m"}
    skipped = fr.fresh_tickers(per_ticker, F.lit(now).cast("timestamp_ntz"))
    assert rows_of(skipped, "ticker") == [("fresh",), ("recent",)]
    universe = spark.createDataFrame([("few",), ("fresh",), ("new",)], "ticker string")
    assert rows_of(fr.to_process(universe, skipped), "ticker") == [("few",), ("new",)]


def test_work_list_and_progress(spark):
    universe = spark.createDataFrame([("A",), ("B",), ("C",)], "ticker string")
    assert fr.work_list(universe).count() == 15
    _, bars = sample(spark)
    assert [tuple(r) for r in fr.progress(universe, bars).collect()] == [(66.67, 2, 3)]
    nobody = spark.createDataFrame([], "ticker string")
    assert [tuple(r) for r in fr.progress(nobody, bars).collect()] == [(0.0, 0, 0)]
