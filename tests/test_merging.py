from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators import upsert
from barloom.operators.spread import lookup_join, number_rows, restrict_to

BAR = "ticker string, interval string, timestamp timestamp_ntz, close double, vwap double"
T0, T1, T2 = (datetime(2024, 1, 1, h) for h in (0, 1, 2))


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_upsert_keeps_last_and_is_idempotent(spark):
    old = spark.createDataFrame([("A", "1h", T0, 1.0, 1.0), ("A", "1h", T1, 2.0, 2.0)], BAR)
    new = spark.createDataFrame([("A", "1h", T1, 9.0, None), ("A", "1h", T2, 3.0, 3.0)], BAR)
    once = upsert.upsert_bars(old, new)
    expected = [(T0, 1.0, 1.0), (T1, 9.0, None), (T2, 3.0, 3.0)]
    assert rows_of(once, "timestamp", "close", "vwap") == expected
    assert rows_of(upsert.upsert_bars(once, new), "timestamp", "close", "vwap") == expected
    first = upsert.upsert_bars(old, new, keep="first")
    assert rows_of(first, "timestamp", "close") == [(T0, 1.0), (T1, 2.0), (T2, 3.0)]


def test_upsert_with_an_empty_side_still_dedupes(spark):
    empty = spark.createDataFrame([], BAR)
    twice = "ticker string, interval string, timestamp timestamp_ntz, close double, ingest_seq bigint"
    new = spark.createDataFrame([("A", "1h", T0, 1.0, 1), ("A", "1h", T0, 2.0, 2)], twice)
    assert rows_of(upsert.upsert_bars(empty, new, seq="ingest_seq"), "close") == [(2.0,)]
    assert rows_of(upsert.upsert_bars(empty, empty), "close") == []
    old = spark.createDataFrame([("A", "1h", T0, 1.0, 1.0)], BAR)
    assert rows_of(upsert.upsert_bars(old, empty), "close", "vwap") == [(1.0, 1.0)]


def test_new_side_wins_over_a_higher_stored_sequence(spark):
    schema = "ticker string, interval string, timestamp timestamp_ntz, close double, ingest_seq bigint"
    old = spark.createDataFrame([("A", "1h", T0, 1.0, 99)], schema)
    new = spark.createDataFrame([("A", "1h", T0, 2.0, 0)], schema)
    assert rows_of(upsert.upsert_bars(old, new, seq="ingest_seq"), "close", "ingest_seq") == [(2.0, 0)]


def test_unknown_orders_come_lowest_and_lose_nothing(spark):
    df = spark.createDataFrame([("A", 1.0, None), ("A", 2.0, -5), ("B", 3.0, None)], "k string, v double, o bigint")
    assert rows_of(upsert.keep_one(df, ["k"], "o"), "k", "v") == [("A", 2.0), ("B", 3.0)]
    assert rows_of(upsert.keep_one(df, ["k"], "o", "first"), "k", "v") == [("A", 1.0), ("B", 3.0)]
    small = df.withColumn("o", F.col("o").cast("decimal(5,2)"))
    assert rows_of(upsert.keep_one(small, ["k"], "o"), "k", "v") == [("A", 2.0), ("B", 3.0)]
    schema = "ticker string, interval string, timestamp timestamp_ntz, close double, ingest_seq bigint"
    old = spark.createDataFrame([("A", "1h", T0, 1.0, 2**63 - 1), ("B", "1h", T0, 1.0, None)], schema)
    new = spark.createDataFrame([("A", "1h", T0, 2.0, -(2**63)), ("C", "1h", T0, 3.0, None)], schema)
    got = rows_of(upsert.upsert_bars(old, new, seq="ingest_seq"), "ticker", "close")
    assert got == [("A", 2.0), ("B", 1.0), ("C", 3.0)]


def test_keep_one_of_strings(spark, final_plan):
    df = spark.createDataFrame([("A", "x", 1), ("A", "y", 2), ("B", "z", 3)], "k string, v string, o int")
    assert rows_of(upsert.keep_one(df, ["k"], "o"), "k", "v") == [("A", "y"), ("B", "z")]
    assert rows_of(upsert.keep_one(df, ["k"], "o", "first"), "k", "v") == [("A", "x"), ("B", "z")]
    assert "WindowGroupLimit" in final_plan(upsert.keep_one(df, ["k"], "o"))
    with pytest.raises(ValueError):
        upsert.keep_one(df, ["k"], "o", "any")


def test_bar_merge_is_a_hash_aggregate(spark, final_plan):
    old = spark.createDataFrame([("A", "1h", T0, 1.0, 1.0)], BAR)
    plan = final_plan(upsert.upsert_bars(old, old))
    assert "HashAggregate" in plan and "SortAggregate" not in plan and "Window" not in plan


def test_universe_append(spark):
    known = spark.createDataFrame([("A", "x")], "ticker string, name string")
    found = spark.createDataFrame([("A", "y"), ("B", "b"), (None, "n"), ("", "e"), ("B", "c")], known.schema)
    assert rows_of(upsert.append_first(known, found, order=["name"]), "ticker", "name") == [("A", "x"), ("B", "b")]
    assert rows_of(upsert.count_new(known, found), "count", "existing_count", "new_tickers_added") == [(2, 1, 1)]


def test_temporal_split_holds_the_cutoff_day_twice(spark):
    cutoff = upsert.cutoff_date(date(2024, 2, 19))
    assert cutoff == date(2024, 1, 20)
    days = spark.createDataFrame([(datetime(2024, 1, d, 12),) for d in (10, 20, 25)], "ts timestamp_ntz")

    def kept(part, start, end):
        return [r["ts"].day for r in days.where(part(F.col("ts"), start, end, cutoff)).collect()]

    first, last = date(2024, 1, 1), date(2024, 1, 31)
    assert kept(upsert.history_part, first, last) == [10, 20]
    assert kept(upsert.recent_part, first, last) == [20, 25]
    assert kept(upsert.history_part, cutoff, last) == []
    assert kept(upsert.recent_part, first, date(2024, 1, 19)) == []
    assert kept(upsert.history_part, first, date(2024, 1, 19)) == [10]


def test_head_tail(spark):
    rows = [("HOT", "1h", datetime(2024, 1, 1 + i // 24, i % 24), float(i), None) for i in range(300)]
    rows += [("B", "1h", T0, 1.0, None)]
    out = upsert.head_tail(spark.createDataFrame(rows, BAR), 5)
    got = rows_of(out, "ticker", "edge", "position", "close")
    assert [g[3] for g in got if g[:2] == ("HOT", "first")] == [0.0, 1.0, 2.0, 3.0, 4.0]
    assert [g[3] for g in got if g[:2] == ("HOT", "last")] == [299.0, 298.0, 297.0, 296.0, 295.0]
    assert [g for g in got if g[0] == "B"] == [("B", "first", 1, 1.0), ("B", "last", 1, 1.0)]
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") >= 4


def test_number_rows_is_a_global_order(spark):
    names = [f"S{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "ticker string").repartition(7)
    got = {r["ticker"]: r["position"] for r in number_rows(df, ["ticker"]).collect()}
    assert got == {n: i for i, n in enumerate(names)}
    assert number_rows(df.limit(0), ["ticker"]).count() == 0


@pytest.fixture
def shuffled_joins(spark):
    """Small data treated as large: no broadcast, skew from a few kilobytes on."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1000",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_lookup_join_splits_a_hot_key(spark, shuffled_joins, final_plan, tmp_path):
    rows = spark.range(60000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("T"), F.col("id") % 500)).alias("ticker"), "id"
    )
    rows.repartition(8).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    lookup = rows.select("ticker").distinct().withColumn("v", F.length("ticker"))
    joined = lookup_join(rows, lookup, ["ticker"])
    # an aggregate on a superset of the join key does not keep the hot key in one task
    counted = joined.groupBy("ticker", (F.col("id") % 7).alias("bin")).agg(F.count("*").alias("n"), F.sum("v").alias("s"))
    assert "skew" in final_plan(counted).lower()
    assert counted.where("ticker = 'HOT'").agg(F.sum("n"), F.sum("s")).collect()[0] == (20000, 60000)
    assert joined.count() == 60000
    semi = restrict_to(rows, spark.createDataFrame([("HOT",), ("HOT",)], "ticker string"), ["ticker"])
    assert semi.count() == 20000 and semi.columns == ["ticker", "id"]


def test_lookup_join_broadcasts_only_a_counted_lookup(spark, shuffled_joins):
    rows = spark.createDataFrame([("A", 1)], "ticker string, id int")
    lookup = spark.createDataFrame([("A", 1)], "ticker string, v int")

    def plan(**known):
        return lookup_join(rows, lookup, ["ticker"], **known)._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan(lookup_rows=1)
    assert "BroadcastHashJoin" not in plan()
    assert "BroadcastHashJoin" not in plan(lookup_rows=10**9)
