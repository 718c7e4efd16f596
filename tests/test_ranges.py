"""Sets of ranges, nesting of intervals, validity and as-of, first rows of a group."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from barloom.functions.intervals import LABELS
from barloom.operators import coverage, history, universe
from barloom.operators.dirty import nesting

T0 = datetime(2024, 1, 1)
RANGE = "ticker string, interval string, start timestamp_ntz, stop timestamp_ntz"


def test_subtract_equals_a_set_of_hours(spark):
    pick = random.Random(6)

    def made(n):
        return [(t, "1h", *sorted((pick.randrange(60), pick.randrange(60)))) for t in "AB" for _ in range(n)]

    for n, m in ((1, 1), (4, 6), (5, 0), (0, 3), (7, 7)):
        sides = [made(n), made(m)]
        frames = [spark.createDataFrame([(t, i, T0 + timedelta(hours=a), T0 + timedelta(hours=b)) for t, i, a, b in s], RANGE) for s in sides]
        found = coverage.subtract(*frames).collect()
        wanted, held = ({(t, h) for t, _, a, b in s for h in range(a, b)} for s in sides)
        hours = [(r.ticker, int((r.start - T0).total_seconds() // 3600), int((r.stop - T0).total_seconds() // 3600)) for r in found]
        assert {(t, h) for t, a, b in hours for h in range(a, b)} == wanted - held
        assert all(x[0] != y[0] or x[2] < y[1] for x, y in zip(sorted(hours), sorted(hours)[1:], strict=False))  # apart


def test_islands_go_over_periods(spark, final_plan):
    moments = [T0 + timedelta(hours=h) for h in (0, 1, 2, 5, *range(740, 750))]  # the month ends at 744
    rows = [("A", "1h", t) for t in moments] + [("B", "1M", datetime(2024, m, 1)) for m in (1, 2, 3, 6)] + [("C", "1h", None)]
    bars = spark.createDataFrame(rows, "ticker string, interval string, timestamp timestamp_ntz")
    found = sorted((r.ticker, r.first_timestamp, r.last_timestamp, r.bars) for r in coverage.islands(bars).collect())
    assert [(t, n) for t, _, _, n in found] == [("A", 3), ("A", 1), ("A", 10), ("B", 3), ("B", 1)]
    assert len(coverage.islands(bars, slack=4).where("ticker = 'A'").collect()) == 2


def test_fetch_ranges_are_whole_where_nothing_is_stored(spark):
    offered = spark.createDataFrame([("A", "1d", date(2024, 1, 1), date(2024, 1, 9)), ("B", "1d", None, None)], "ticker string, interval string, start_date date, end_date date")
    none = spark.createDataFrame([], "ticker string, interval string, timestamp timestamp_ntz")
    assert [(r.ticker, r.start, r.stop) for r in coverage.fetch_ranges(offered, none).collect()] == [("A", T0, datetime(2024, 1, 10))]
    some = spark.createDataFrame([("A", "1d", datetime(2024, 1, d)) for d in (2, 3, 6)], none.schema)
    got = sorted((r.start.day, r.stop.day) for r in coverage.fetch_ranges(offered, some).collect())
    assert got == [(1, 2), (4, 6), (7, 10)]


def test_nesting():
    assert nesting("1d", ["1w", "1Y", "1M", "1Q"]) == [[("1d", "1w"), ("1d", "1M")], [("1M", "1Q")], [("1Q", "1Y")]]
    assert nesting("1m", ["45m", "1h", "1d"]) == [[("1m", "45m"), ("1m", "1h")], [("1h", "1d")]]
    assert nesting("1h", []) == []
    assert nesting("1d", ["1M", "3M", "1Q"]) == [[("1d", "1M")], [("1M", "3M"), ("1M", "1Q")]]
    assert sum(map(len, nesting("1s", LABELS))) == len(LABELS) - 1
    for wrong in ("45m", "1s", "7m"):
        with pytest.raises(ValueError):
            nesting("30m", [wrong])


def test_validity_and_as_of(spark):
    rows = [("c", "s1", "A", "x"), ("c", "s1", "B", "x"), ("c", "s1", "B", "x"), ("c", "s2", "A", "y"), ("c", "s3", "A", "y"), ("c", "s3", "B", "x"), ("c", "s3", None, "x"), ("d", "s2", "A", None)]
    ranges = history.validity(spark.createDataFrame(rows, "category string, created_at string, ticker string, name string"), ["name"])
    found = sorted(map(tuple, ranges.collect()))
    assert found == [
        ("c", "A", "x", "s1", "s2", "added", "changed"),
        ("c", "A", "y", "s2", None, "changed", None),
        ("c", "B", "x", "s1", "s2", "added", "dropped"),
        ("c", "B", "x", "s3", None, "added", None),
        ("d", "A", None, "s2", None, "added", None),
    ]
    asked = spark.createDataFrame([("A", "s1"), ("A", "s0"), ("B", "s2"), ("B", "s4"), (None, "s1")], "ticker string, at string")
    own = ranges.where("category = 'c'").select("ticker", "name", "valid_from", "valid_to")
    got = sorted((str(r.ticker), r["at"], r.name or "-") for r in history.as_of(asked, own, "at").collect())
    assert got == [("A", "s0", "-"), ("A", "s1", "x"), ("B", "s2", "-"), ("B", "s4", "x"), ("None", "s1", "-")]
    assert history.as_of(asked, own, "at", how="inner").count() == 2
    with pytest.raises(ValueError):
        history.as_of(asked.withColumn("name", F.lit(1)), own, "at")


def test_first_of_each_has_no_global_sort(spark, final_plan):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), (F.col("id") % 700).alias("v"))
    found = universe.first_of_each(rows, ["k"], ["v"], 1500)
    got = sorted(r.v for r in found.where("k = 'HOT'").collect())
    assert got == sorted(i % 700 for i in range(0, 9000, 3))[:1500]
    plan = final_plan(universe.first_of_each(rows, ["k"], ["v"], 5))
    assert "rangepartitioning" not in plan.lower() and "WindowGroupLimit" in plan
