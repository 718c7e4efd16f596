"""Parts of a stream are written by as many tasks as read the table, and each part is one batch."""

import random
import time
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barloom.sources import pointer, store
from barloom.streaming import landing
from checks import store_queries


@pytest.fixture
def scratch(tmp_path, monkeypatch):
    monkeypatch.setattr(store_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    return tmp_path


def files_in(folder):
    return sorted(f.name for f in Path(folder).glob("part-*"))


def write_lines(spark, folder):
    rng, day = random.Random(5), datetime(1998, 1, 1)
    rows = [(i, i % 7, i % 3, i % 8, 5.0, float(rng.randrange(1, 900)), 0.0, 0.1 * (i % 4), "N", "O", day) for i in range(400)]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
    spark.createDataFrame(rows, schema).repartition(4, "l_orderkey").write.parquet(str(folder / "lineitem.parquet"))


def shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f for k in range(len(folders)) for f in Path(folders[k]).rglob("shuffle_*.data")}


def test_each_part_of_arriving_has_many_files_and_is_one_batch(spark, scratch):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(minutes=i), i % 9, "view", float(i), '{"k": 1}') for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.repartition(4, "event_id").write.parquet(str(scratch / "events.parquet"))
    batches, files = [], []
    for stream in store_queries.arriving(spark, str(scratch)):
        def write(batch, batch_id):
            batches.append((batch_id, {r.part for r in batch.select((F.col("seq") % 5).alias("part")).distinct().collect()}, batch.count()))

        stream.writeStream.option("checkpointLocation", str(scratch / "progress")).foreachBatch(write).trigger(availableNow=True).start().awaitTermination()
        files.append(len(files_in(scratch / "arriving")))
    assert batches == [(k, {k}, 80) for k in range(5)]
    assert all(later - before > 1 for before, later in zip([0, *files], files, strict=False))


def test_streamed_lines_are_written_by_many_tasks_in_six_batches(spark, scratch, monkeypatch):
    write_lines(spark, scratch)
    batches = []

    def counted(lines, path, rejects, checkpoint):
        writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, k: batches.append((k, sorted(r.value for r in batch.collect()))))
        return writer.trigger(availableNow=True).start()

    monkeypatch.setattr(landing, "stream_landing", counted)
    store_queries.streamed(spark, str(scratch))
    assert [k for k, _ in batches] == list(range(6))
    found = [lines for _, lines in batches]
    assert found[0] == found[2] and found[1] == found[5]
    single = sorted(r.value for r in store_queries.queries.landed_text(spark, str(scratch)).collect())
    assert sorted(line for k in (1, 2, 3, 4) for line in found[k]) == single
    assert len(files_in(scratch / "lines")) > 6


def test_streamed_lines_leave_only_what_counts_on_disk(spark, scratch):
    write_lines(spark, scratch)
    path, rejects = store_queries.streamed(spark, str(scratch))[:2]
    assert not list((scratch / "parts").glob("part=*"))
    kept = [spark.read.text(str(scratch / "lines" / name)).count() for name in files_in(scratch / "lines")]
    assert all(name.endswith(".gz") for name in files_in(scratch / "lines")) and sum(kept) < 400  # of 600 that have come
    counting = {run for runs in pointer.current(spark, path).bar_runs().values() for run in runs}
    assert {f.name for f in (scratch / "bars" / "bars").iterdir()} == {f"run={run}" for run in counting}
    once, bad = landing.split_lines(store_queries.queries.landed_text(spark, str(scratch)))
    columns = ["ticker", "timestamp", "ingest_seq"]
    expected = once.groupBy("ticker", "timestamp").agg(F.max("ingest_seq").alias("ingest_seq")).collect()
    assert sorted(map(tuple, store.read_bars(spark, path).select(*columns).collect())) == sorted(map(tuple, expected))
    lines = sorted(r.line for r in landing.read_rejects(spark, rejects).collect())
    assert lines == sorted({r.line for r in bad.collect()})


def test_streamed_landing_is_one_read_and_drops_the_landed_files(spark, scratch):
    write_lines(spark, scratch)
    found = store_queries.streamed_landing(spark, str(scratch))
    assert not (scratch / "lines").exists()
    once, _ = landing.split_lines(store_queries.queries.landed_text(spark, str(scratch)))
    assert {r.as_one_read for r in found.collect()} == {True}
    assert found.count() == once.select("ticker", "timestamp").distinct().count()


def test_streamed_rejects_count_once_and_drop_the_landed_files(spark, scratch):
    write_lines(spark, scratch)
    found = {r.reject_reason: r.lines for r in store_queries.streamed_rejects(spark, str(scratch)).collect()}
    assert not (scratch / "lines").exists()
    _, bad = landing.split_lines(store_queries.queries.landed_text(spark, str(scratch)))
    assert found == {r.reject_reason: r["count"] for r in bad.distinct().groupBy("reject_reason").count().collect()}
    assert all(".zstd." in f.name for f in (scratch / "rejects").rglob("part-*"))


def test_shuffles_of_a_batch_go_with_the_step_that_made_them(spark, scratch, monkeypatch):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, earlier, left, merge = spark.conf.get(setting, None), shuffle_files(spark), [], landing.merge_newest

    def merged(session, bars, path):
        merge(session, bars, path)
        for _ in range(100):  # files go a little later
            if not shuffle_files(spark) - earlier:
                break
            time.sleep(0.1)
        left.append(len(shuffle_files(spark) - earlier))

    monkeypatch.setattr(landing, "merge_newest", merged)
    write_lines(spark, scratch)
    lines = store_queries.queries.landed_text(spark, str(scratch))
    earlier = shuffle_files(spark)
    lines.write.text(str(scratch / "lines"))
    stream = spark.readStream.schema("value string").text(str(scratch / "lines"))
    landing.stream_landing(stream, str(scratch / "bars"), str(scratch / "rejects"), str(scratch / "progress")).awaitTermination()
    assert left == [0]
    assert spark.conf.get(setting, None) == before
