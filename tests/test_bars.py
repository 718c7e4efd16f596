import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.functions.intervals import INTRADAY_LABELS, LABELS, interval_of
from barloom.operators.bars import (
    bars_for_intervals,
    bars_from_ticks,
    day_file_bars,
    intraday_bars,
    roll_up,
)

SCHEMA = "ticker string, timestamp timestamp_ntz, price double, size bigint, seq bigint"
DAY = datetime(2024, 1, 2, 10)


def at(minute, second=0):
    return DAY + timedelta(minutes=minute, seconds=second)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


@pytest.fixture(scope="module")
def random_ticks(spark):
    """Random walk over 40 days; 'HOT' holds a third of the rows, times are distinct per ticker."""
    rng = random.Random(7)
    rows, seen = [], set()
    for seq in range(6000):
        ticker = "HOT" if seq % 3 == 0 else f"T{rng.randrange(6)}"
        ts = datetime(2023, 12, 20) + timedelta(seconds=rng.randrange(40 * 86400))
        if (ticker, ts) not in seen:
            seen.add((ticker, ts))
            rows.append((ticker, ts, float(rng.randrange(1000)), rng.randrange(50), seq))
    return spark.createDataFrame(rows, SCHEMA).cache(), rows


def test_ties_are_ordered_by_sequence(spark):
    ticks = spark.createDataFrame(
        [("A", at(0, 30), 3.0, 3, 3), ("A", at(0, 10), 1.0, 1, 1), ("A", at(0, 10), 2.0, 2, 2)], SCHEMA
    )
    got = rows_of(bars_from_ticks(ticks, "5m", tie_break="seq"), "timestamp", "open", "high", "low", "close", "volume")
    assert got == [(at(0), 1.0, 3.0, 1.0, 3.0, 6)]


def test_tie_at_the_end_of_a_bin(spark):
    ticks = spark.createDataFrame([("A", at(1), 5.0, 1, 8), ("A", at(1), 4.0, 1, 9), ("A", at(0), 3.0, 1, 7)], SCHEMA)
    assert rows_of(bars_from_ticks(ticks, "5m", "seq"), "open", "close") == [(3.0, 4.0)]


def test_negative_and_unknown_sequences(spark):
    ticks = spark.createDataFrame(
        [("A", at(1), 5.0, 1, None), ("A", at(1), 4.0, 1, -(2**63)), ("A", at(1), 6.0, 1, 2**63 - 1), ("B", at(1), 7.0, 1, None)],
        SCHEMA,
    )
    assert rows_of(bars_from_ticks(ticks, "5m", "seq"), "ticker", "open", "close") == [("A", 4.0, 6.0), ("B", 7.0, 7.0)]
    ends = spark.createDataFrame(
        [("A", datetime(9999, 12, 31, 23, 59), 1.0, 1, 2**63 - 1), ("A", datetime(1, 1, 2), 2.0, 1, -(2**63))], SCHEMA
    )
    assert rows_of(bars_from_ticks(ends, "1d", "seq"), "open") == [(1.0,), (2.0,)]


def test_null_prices_and_sizes(spark):
    ticks = spark.createDataFrame(
        [
            ("A", at(7), None, 4, 1),
            ("A", at(12), None, None, 2),
            ("A", at(12, 30), 7.0, None, 3),
            ("A", at(15), float("nan"), 2, 4),
            ("A", at(16), 9.0, 3, 5),
            ("A", None, 9.0, 3, 6),
        ],
        SCHEMA,
    )
    got = rows_of(intraday_bars(ticks, "5m"), "timestamp", "open", "high", "low", "close", "volume")
    assert got == [(at(10), 7.0, 7.0, 7.0, 7.0, 0), (at(15), 9.0, 9.0, 9.0, 9.0, 5)]


def test_volume_only_with_sizes(spark):
    ticks = spark.createDataFrame([("A", at(0), 1.0, 1, 1)], SCHEMA).drop("size")
    assert "volume" not in intraday_bars(ticks, "1m").columns
    with pytest.raises(ValueError):
        day_file_bars(ticks, "1m")


def test_rejected_labels(spark):
    ticks = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError):
        day_file_bars(ticks, "30m")
    with pytest.raises(ValueError):
        intraday_bars(ticks, "1d")
    with pytest.raises(ValueError):
        bars_from_ticks(ticks, "1x")
    assert bars_from_ticks(ticks, "1h").count() == 0
    assert bars_for_intervals(ticks, LABELS).count() == 0


@pytest.mark.parametrize("label", ["1s", "45m", "12h", "1d"])
def test_bars_equal_pandas_resample(random_ticks, label):
    ticks, rows = random_ticks
    frame = pd.DataFrame(rows, columns=["ticker", "timestamp", "price", "size", "seq"])
    expected = []
    for ticker, part in frame.groupby("ticker"):
        series = part.set_index("timestamp").sort_index()
        rule = f"{interval_of(label).seconds}s"
        binned = series["price"].resample(rule).agg(["first", "max", "min", "last"])
        binned["volume"] = series["size"].resample(rule).sum()
        for ts, r in binned.dropna().iterrows():
            expected.append((ticker, ts.to_pydatetime(), r["first"], r["max"], r["min"], r["last"], int(r["volume"])))
    got = rows_of(bars_from_ticks(ticks, label), "ticker", "timestamp", "open", "high", "low", "close", "volume")
    assert got == sorted(expected)


def test_many_intervals_equal_one_at_a_time(random_ticks):
    ticks, _ = random_ticks
    columns = ("ticker", "interval", "timestamp", "open", "high", "low", "close", "volume")
    many = rows_of(bars_for_intervals(ticks, LABELS), *columns)
    single = []
    for label in LABELS:
        single += rows_of(bars_from_ticks(ticks, label), *columns)
    assert many == sorted(single)


def test_many_intervals_equal_one_at_a_time_where_prices_are_unknown(random_ticks):
    ticks, _ = random_ticks
    ticks = ticks.withColumn("price", F.when(F.col("size") % 3 == 0, F.col("price")))
    columns = ("ticker", "interval", "timestamp", "open", "high", "low", "close", "volume", "transactions", "vwap")
    many = bars_for_intervals(ticks, LABELS, extended=True).withColumn("vwap", F.round("vwap", 6))
    single = []
    for label in LABELS:
        single += rows_of(bars_from_ticks(ticks, label, extended=True).withColumn("vwap", F.round("vwap", 6)), *columns)
    assert rows_of(many, *columns) == sorted(single)


def test_volume_does_not_depend_on_the_other_labels(spark):
    ticks = spark.createDataFrame([("A", at(0), 1.0, 1, 1), ("A", at(1), None, 4, 2), ("A", at(2), 3.0, 2, 3)], SCHEMA)
    for labels in (["5m"], ["1m", "5m"], ["1s", "1m", "5m"]):
        five = bars_for_intervals(ticks, labels).where("interval = '5m'")
        assert rows_of(five, "volume") == [(7,)]


@pytest.mark.parametrize(("source", "target"), [("1m", "1h"), ("1h", "1d"), ("1d", "1w"), ("1d", "3M"), ("1M", "1Y")])
def test_roll_up_equals_direct(random_ticks, source, target):
    ticks, _ = random_ticks
    columns = ("ticker", "interval", "timestamp", "open", "high", "low", "close", "volume", "transactions")
    fine = bars_from_ticks(ticks, source, extended=True)
    assert rows_of(roll_up(fine, source, target), *columns) == rows_of(
        bars_from_ticks(ticks, target, extended=True), *columns
    )


def test_roll_up_vwap_is_weighted(spark):
    ticks = spark.createDataFrame([("A", at(0), 10.0, 1, 1), ("A", at(1), 20.0, 3, 2), ("A", at(2), 99.0, 0, 3)], SCHEMA)
    hourly = roll_up(bars_from_ticks(ticks, "1m", extended=True), "1m", "1h")
    assert rows_of(hourly, "vwap", "transactions", "volume") == [(17.5, 3, 4)]


def test_roll_up_refuses_overlapping_bins(spark):
    bars = bars_from_ticks(spark.createDataFrame([], SCHEMA), "1w")
    with pytest.raises(ValueError):
        roll_up(bars, "1w", "1M")


def test_bar_invariants(random_ticks):
    ticks, rows = random_ticks
    bars = bars_for_intervals(ticks, ["5m", "1h", "1w"])
    bad = bars.where("low > open or low > close or high < open or high < close")
    assert bad.count() == 0
    volumes = {r["v"] for r in bars.groupBy("interval").agg(F.sum("volume").alias("v")).collect()}
    assert volumes == {sum(r[3] for r in rows)}


def test_both_forms_plan_as_hash_aggregates(random_ticks, final_plan):
    ticks, _ = random_ticks
    for tie_break in (None, "seq"):
        plan = final_plan(bars_from_ticks(ticks, "1h", tie_break))
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
        assert plan.count("Exchange hashpartitioning") == 1


def test_many_intervals_read_the_ticks_once(spark, random_ticks, final_plan, tmp_path):
    random_ticks[0].write.parquet(str(tmp_path / "ticks"))
    stored = spark.read.parquet(str(tmp_path / "ticks"))
    for labels in (["1m", *INTRADAY_LABELS[8:], "1d", "1w", "1Y"], LABELS):
        plan = final_plan(bars_for_intervals(stored, labels))
        assert plan.count("FileScan") == 1
        moved = [line for line in plan.splitlines() if "- Exchange hashpartitioning" in line]
        by_day = [line for line in moved if "REPARTITION_BY_COL" in line]
        assert len(by_day) == (2 if labels is LABELS else 1)
        calendar = {interval_of(x).trunc_unit for x in labels} - {None}
        assert len(moved) - len(by_day) == 1 + len(calendar)
        assert "seq" not in plan.split("ReadSchema: ")[1].split("\n")[0]
