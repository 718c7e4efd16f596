"""The store's runs: the pointer's switch, crashes, readers, joining of runs, states of series, skipping."""

import math
from datetime import datetime, timedelta

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.operators import freshness, profile, query, spread
from barloom.plans.market_days import merge_market_days
from barloom.plans.propagation import propagate
from barloom.schemas import BUCKETS, bucket_name, bucket_of
from barloom.sources import pointer, store
from barloom.sources.folders import create_text

BAR = "ticker string, interval string, timestamp timestamp_ntz, close double"
T0 = datetime(2024, 1, 1)


def bars_of(spark, rows):
    return spark.createDataFrame([(t, i, T0 + timedelta(hours=h), float(c)) for t, i, h, c in rows], BAR)


def held(df):
    return sorted((r.ticker, r.interval, int((r.timestamp - T0).total_seconds() // 3600), r.close) for r in df.collect())


def state(spark, path):
    return sorted((r.ticker, r.interval, r.records, r.first_timestamp, r.last_timestamp) for r in store.read_series(spark, path).collect())


def scanned(spark, path):
    stored = store.read_bars(spark, path).groupBy("ticker", "interval")
    found = stored.agg(F.count("*").alias("n"), F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    return sorted(map(tuple, found.collect()))


def test_a_crash_before_the_switch_loses_nothing(spark, tmp_path):
    path = str(tmp_path)
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 0, 1), ("B", "1h", 0, 2)]), path)
    before = held(store.read_bars(spark, path))
    store.add_run(spark, bars_of(spark, [("A", "1h", 0, 9), ("C", "1h", 1, 3)]), path)  # written, never in force
    assert held(store.read_bars(spark, path)) == before and state(spark, path) == scanned(spark, path)
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 1, 5)]), path)
    assert held(store.read_bars(spark, path)) == [("A", "1h", 0, 1.0), ("A", "1h", 1, 5.0), ("B", "1h", 0, 2.0)]
    store.vacuum(spark, path, keep=1)
    assert sorted(f.name for f in (tmp_path / "bars").iterdir()) == ["run=1", "run=3"]


def test_a_half_written_pointer_is_passed_over(spark, tmp_path):
    path = str(tmp_path)
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 0, 1)]), path)
    assert create_text(spark, f"{path}/_pointer/{2:012d}.json", '{"bars": {')
    assert held(store.read_bars(spark, path)) == [("A", "1h", 0, 1.0)]
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 1, 2)]), path)
    assert pointer.current(spark, path).version == 3
    assert held(store.read_bars(spark, path)) == [("A", "1h", 0, 1.0), ("A", "1h", 1, 2.0)]


def test_of_two_writers_from_one_version_the_second_fails(spark, tmp_path):
    path = str(tmp_path)
    first = pointer.current(spark, path)
    pointer.switch(spark, path, first)
    with pytest.raises(pointer.ChangedMeanwhile):
        pointer.switch(spark, path, first)


def test_a_reader_keeps_what_it_opened(spark, tmp_path):
    path = str(tmp_path)
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 0, 1)]), path)
    opened = store.read_bars(spark, path)
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 0, 2), ("A", "1h", 1, 3)]), path)
    again = store.read_bars(spark, path)
    store.compact(spark, path)
    store.delete_series(spark, path, "a")
    assert held(opened) == [("A", "1h", 0, 1.0)]
    assert held(again) == [("A", "1h", 0, 2.0), ("A", "1h", 1, 3.0)]
    assert held(store.read_bars(spark, path)) == []


def test_states_equal_a_scan_after_every_change(spark, tmp_path):
    path = str(tmp_path)
    tickers = [f"T{k}" for k in range(9)]
    changes = [
        [(t, "1h", h, 1) for t in tickers for h in range(10, 20)],
        [(t, i, h, 2) for t in tickers[:4] for i in ("1h", "1d") for h in (12, 13, 25, 2)],
        [(t, "1h", h, 3) for t in tickers[2:6] for h in range(0, 40, 3)],
    ]
    for rows in [*changes, changes[2], changes[0]]:
        store.merge_bars(spark, bars_of(spark, rows), path)
        assert state(spark, path) == scanned(spark, path)
    assert store.delete_series(spark, path, "t2", "1d") == 4
    assert state(spark, path) == scanned(spark, path)
    store.delete_series(spark, path, "t3")
    for k in range(store.STATE_RUNS + 2):
        store.merge_bars(spark, bars_of(spark, [("T0", "1h", 100 + k, k)]), path)
    assert state(spark, path) == scanned(spark, path)
    assert len(pointer.current(spark, path).series[bucket_name("T0", BUCKETS)]) <= store.STATE_RUNS + 1
    store.compact(spark, path)
    assert state(spark, path) == scanned(spark, path)
    marks = freshness.high_water_marks(store.read_bars(spark, path))
    assert sorted(map(tuple, marks.collect())) == sorted((r.ticker, r.interval, r.last_timestamp) for r in store.read_series(spark, path).collect())
    asked = bars_of(spark, [("T0", "1h", 0, 0), ("ZZ", "1h", 0, 0)]).select("ticker", "interval")
    assert sorted(map(tuple, profile.summary_of_states(store.read_series(spark, path), asked).collect())) == sorted(
        map(tuple, profile.series_summary(store.read_bars(spark, path), asked).collect())
    )


def test_what_a_merge_writes_grows_with_the_change(spark, tmp_path):
    path = str(tmp_path)
    wide = spark.range(60_000).select(
        F.concat(F.lit("T"), F.col("id") % 40).alias("ticker"), F.lit("1m").alias("interval"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, id, 0)").alias("timestamp"),
        F.rand(3).alias("close"),
    )
    store.write_bars(wide, path)
    first = sum(size for runs in pointer.current(spark, path).bars.values() for _, size in runs)
    sizes = {f: f.stat().st_mtime_ns for f in (tmp_path / "bars").rglob("*.parquet")}
    for k in range(6):
        store.merge_bars(spark, wide.where(F.col("ticker") == "T1").limit(20).withColumn("close", F.lit(float(k))), path)
    written = sum(f.stat().st_size for f in (tmp_path / "bars").rglob("*.parquet") if f not in sizes)
    assert all(f.stat().st_mtime_ns == at for f, at in sizes.items())
    assert written < first / 3
    assert store.read_bars(spark, path).count() == 60_000


@given(st.lists(st.integers(1, 10**9), max_size=30))
def test_runs_are_joined_by_size(sizes):
    taken = pointer.runs_to_join(sizes)
    assert taken == 0 or pointer.LEAST_RUNS <= taken <= len(sizes)
    if 0 < taken < len(sizes):  # the next older run is more than RATIO times what was joined
        assert sum(sizes[-taken:]) * pointer.RATIO < sizes[-taken - 1]


@given(st.lists(st.integers(1, 1000), min_size=1, max_size=300))
def test_a_bar_is_rewritten_a_logarithm_of_times(added):
    runs, written = [], 0
    for size in added:
        runs.append(size)
        written += size
        taken = pointer.runs_to_join(runs)
        if taken:
            runs[-taken:] = [sum(runs[-taken:])]
            written += runs[-1]
        steps = math.log(sum(runs) + 1, pointer.RATIO) + 2
        assert len(runs) <= pointer.LEAST_RUNS * steps
    assert sum(runs) == sum(added)
    assert written <= sum(added) * (2 + pointer.RATIO * math.log(sum(added) + 1, 2))


def test_buckets_agree(spark):
    names = [("AAPL",), ("X:BTC",), ("",), ("É",)]
    for n in (1, 16, 4000):
        for r in spark.createDataFrame(names, "t string").select("t", bucket_of(F.col("t"), n).alias("b")).collect():
            assert r.b == bucket_name(r.t, n) and 0 <= int(r.b[:4]) < n


def test_the_number_of_buckets_is_the_store_s_own(spark, tmp_path):
    path = str(tmp_path)
    rows = bars_of(spark, [(f"T{k}", "1h", h, k) for k in range(20) for h in (1, 2)])
    store.write_bars(rows, path, buckets=3)
    store.merge_bars(spark, rows.where("ticker = 'T4'").withColumn("close", F.lit(-1.0)), path)
    assert len({f.name for f in (tmp_path / "bars").rglob("bucket=*")}) <= 3
    found = query.select_series(store.read_bars(spark, path), "t4", "1h")
    assert held(found) == [("T4", "1h", 1, -1.0), ("T4", "1h", 2, -1.0)]
    store.write_bars(store.read_bars(spark, path), path, buckets=5)
    assert held(query.select_series(store.read_bars(spark, path), "t4", "1h")) == held(found)
    assert store.read_bars(spark, path).count() == 40


def test_a_deletion_writes_one_bucket(spark, tmp_path):
    path = str(tmp_path)
    store.write_bars(bars_of(spark, [(f"T{k}", i, h, k) for k in range(30) for i in ("1h", "1d") for h in (1, 2)]), path)
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "bars").rglob("*.parquet")}
    assert store.delete_series(spark, path, "t7", "1d") == 2
    new = [f for f in (tmp_path / "bars").rglob("*.parquet") if f not in files]
    assert {next(p for p in f.parts if p.startswith("bucket=")) for f in new} <= {f"bucket={bucket_name('T7', BUCKETS)}"}
    assert all(f.stat().st_mtime_ns == at for f, at in files.items())
    assert store.read_bars(spark, path).count() == 118 and store.read_bars(spark, path, "T7").where("ticker = 'T7'").count() == 2
    with pytest.raises(LookupError):
        store.delete_series(spark, path, "t7", "1d")


def test_one_series_of_many_skips_row_groups(spark, tmp_path, monkeypatch):
    """Rows that the scan hands on, by the scan's own metric."""
    monkeypatch.setitem(store.SKIPPING, "parquet.block.size", "20000")
    path = str(tmp_path)
    rows = spark.range(200_000).select(
        F.concat(F.lit("T"), F.col("id") % 500).alias("ticker"), F.lit("1m").alias("interval"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("timestamp"),
        F.rand(1).alias("close"), F.rand(2).alias("open"),
    )
    store.write_bars(rows, path, buckets=1)
    store.merge_bars(spark, rows.where(F.second("timestamp") % 2 == 0), path)
    store.compact(spark, path)
    found = query.select_series(store.read_bars(spark, path), "T5", "1m")
    assert found.count() == 400
    executed = found._jdf.queryExecution().executedPlan()
    found._jdf.queryExecution().toRdd().count()
    leaves = executed.collectLeaves()
    read = sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))
    assert 400 <= read <= 200_000 / 10


def test_details_change_a_type_and_keep_one_bar(spark, tmp_path):
    path = str(tmp_path)
    rows = bars_of(spark, [("QQQX", "1d", 0, 1), ("ABC", "1d", 0, 1)])
    store.merge_bars(spark, rows.withColumn("asset_type", F.lit("etf")), path)
    store.merge_bars(spark, rows.where("ticker = 'QQQX'").withColumn("close", F.lit(2.0)), path)
    found = sorted((r.ticker, r.asset_type, r.close) for r in store.read_bars(spark, path).collect())
    assert found == [("ABC", "etf", 1.0), ("QQQX", "equities", 2.0)]
    store.merge_bars(spark, rows.where("ticker = 'ABC'").withColumn("asset_type", F.lit("fonds commun é")), path)
    store.compact(spark, path)
    assert {(r.ticker, r.asset_type) for r in store.read_series(spark, path).collect()} == {("ABC", "fonds commun é"), ("QQQX", "equities")}
    assert {r.asset_type for r in store.read_bars(spark, path).collect()} == {"fonds commun é", "equities"}
    with pytest.raises(Exception, match="asset type too long"):
        store.merge_bars(spark, rows.withColumn("asset_type", F.lit("a type of sixteen")), path)


def test_merge_newest_does_not_hang_on_order(spark, tmp_path):
    rows = [(t, h, seq) for t in "AB" for h in range(4) for seq in (3, 1, 2)]
    ends = set()
    for name, order in (("up", rows), ("down", rows[::-1])):
        path = str(tmp_path / name)
        for k in range(0, len(order), 5):
            part = [(t, "1h", T0 + timedelta(hours=h), float(seq), seq) for t, h, seq in order[k : k + 5]]
            for _ in range(2):
                store.merge_newest(spark, spark.createDataFrame(part, BAR + ", ingest_seq bigint"), path)
        assert state(spark, path) == scanned(spark, path)
        ends.add(tuple(held(store.read_bars(spark, path))))
    assert ends == {tuple((t, "1h", h, 3.0) for t in "AB" for h in range(4))}


def test_merging_and_joining_some_buckets_at_a_time_changes_nothing(spark, tmp_path, monkeypatch, final_plan):
    monkeypatch.setattr(store, "PASS_BYTES", 0)
    commit, writer, seen, written = store.commit_run, store._run_writer, [], []

    def committed(spark, path, number):
        seen.append(sorted(f.name for f in (tmp_path / "bars").iterdir()))
        return commit(spark, path, number)

    monkeypatch.setattr(store, "commit_run", committed)
    monkeypatch.setattr(store, "_run_writer", lambda rows: (written.append(rows), writer(rows))[1])
    path, expected = str(tmp_path), {}
    for batch in range(3):
        changes = [(f"T{k}", "1h", h, batch * 100 + k + (h * 37 + batch * 53) % 90) for k in range(12) for h in range(batch, batch + 6)]
        for t, i, h, c in changes:
            expected[(t, i, h)] = max(float(c), expected.get((t, i, h), 0.0))
        bars = bars_of(spark, changes).withColumn("ingest_seq", F.col("close").cast("bigint"))
        written.clear()
        store.merge_newest(spark, bars, path)
        assert len(written) > 3  # the new run, then several passes
    assert seen == [["run=2"], ["run=2", "run=4"], ["run=2", "run=4", "run=6"]]
    assert held(store.read_bars(spark, path)) == sorted((*key, c) for key, c in expected.items())
    written.clear()
    store.compact(spark, path)
    assert len(written) > 3 and all(final_plan(rows).count("Exchange ") == 1 for rows in written)
    store.vacuum(spark, path, keep=1)
    assert held(store.read_bars(spark, path)) == sorted((*key, c) for key, c in expected.items())
    assert state(spark, path) == scanned(spark, path)


def test_passes_share_the_bytes(monkeypatch):
    sizes = {f"{k:04d}of16": 100 + k for k in range(16)}
    assert store._passes(sizes) == [sorted(sizes)] and store._passes({}) == []
    monkeypatch.setattr(store, "PASS_BYTES", 10)
    found = store._passes(sizes)
    assert sorted(b for some in found for b in some) == sorted(sizes) and 8 <= len(found) <= 16
    assert store._passes({"a": 5000, "b": 1, "c": 1}) == [["a"], ["b", "c"]]


def test_nothing_changed_builds_nothing(spark, tmp_path):
    path = str(tmp_path)
    rows = bars_of(spark, [("A", "1d", 0, 1)]).withColumns({c: F.col("close") for c in ("open", "high", "low")})
    store.merge_bars(spark, rows, path)
    propagate(spark, path, rows.limit(0), "1d", ["1w", "1Y"])
    assert pointer.current(spark, path).version == 1
    propagate(spark, path, rows, "1d", ["1w", "1Y"])
    assert sorted(r.interval for r in store.read_bars(spark, path).collect()) == ["1Y", "1d", "1w"]


@pytest.mark.parametrize("days", [10, 40])
def test_market_days_are_merged_in_tasks_of_bounded_rows(spark, tmp_path, monkeypatch, days):
    """Four times the days are four times the tasks, with one exchange under the search for copies; the bars stay the same."""
    monkeypatch.setattr(spread, "TASK_ROWS", 200)
    raw = spark.range(100 * days).select(
        F.concat(F.lit("t"), F.col("id") % 100).alias("T"), F.expr("date_add(date'2024-01-01', cast(id div 100 as int))").alias("day"),
        *[F.col("id").cast("double").alias(c) for c in ("o", "h", "l", "c", "v", "vw")], F.lit(1).alias("n"),
    )
    raw = raw.union(raw.where("n = 1 AND c < 500").withColumn("c", F.col("c") + 1))
    written, write = [], store._write_run
    monkeypatch.setattr(store, "_write_run", lambda path, bars, *rest: (written.append(bars), write(path, bars, *rest)))
    found = []
    for name, rows in (("plain", None), ("dealt", raw.count())):
        merge_market_days(spark, raw, F.col("day"), str(tmp_path / name), "c", rows=rows)
        found.append(sorted(map(tuple, store.read_bars(spark, str(tmp_path / name)).select("ticker", "timestamp", "close", "volume").collect())))
    assert found[0] == found[1] and len(found[0]) == 100 * days
    plan = written[1]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "REPARTITION_BY_NUM" in plan
    sizes = [r["count"] for r in written[1].groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == -(-raw.count() // 200) and max(sizes) <= 300


def test_an_empty_store(spark, tmp_path):
    path = str(tmp_path / "none")
    assert store.read_bars(spark, path).isEmpty() and store.read_series(spark, path).isEmpty()
    store.merge_bars(spark, bars_of(spark, [("A", "1h", 0, 1)]).limit(0), path)
    assert store.read_bars(spark, path).isEmpty()
    store.compact(spark, path)
    store.vacuum(spark, path)
    with pytest.raises(LookupError):
        store.delete_series(spark, path, "A")
