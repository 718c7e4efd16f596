import random
import time
from datetime import datetime, timedelta

import pytest

from barloom.operators.bars import bars_from_ticks
from barloom.sources import store
from barloom.streaming.incremental import LateRows, stream_to_store, streaming_bars

SCHEMA = "ticker string, timestamp timestamp_ntz, price double, size bigint, seq bigint"
COLUMNS = ("ticker", "timestamp", "open", "high", "low", "close", "volume")


def rows_of(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """Thirty days of ticks in six files, each file spanning the whole time."""
    rng = random.Random(3)
    start = datetime(2024, 1, 1)
    moments = rng.sample(range(30 * 86400), 1200)
    rows = [("AB"[i % 2], start + timedelta(seconds=s), float(rng.randrange(100)), 1, i) for i, s in enumerate(moments)]
    folder = tmp_path_factory.mktemp("ticks")
    for part in range(6):
        chunk = spark.createDataFrame([r for r in rows if r[4] % 6 == part], SCHEMA).coalesce(1)
        chunk.write.mode("append").parquet(str(folder / "in"))
    return str(folder / "in"), spark.createDataFrame(rows, SCHEMA)


def late_rows(query):
    return sum(s.get("numRowsDroppedByWatermark", 0) for b in query.recentProgress for s in b["stateOperators"])


def read(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch(spark, shuffled, tmp_path):
    path, ticks = shuffled
    out = str(tmp_path / "bars")
    query = stream_to_store(read(spark, path), "4h", out, str(tmp_path / "progress"), "40 days")
    query.awaitTermination()
    assert len(query.recentProgress) >= 6 and late_rows(query) == 0
    assert rows_of(store.read_bars(spark, out)) == rows_of(bars_from_ticks(ticks, "4h"))
    # nothing new: a second run changes nothing
    stream_to_store(read(spark, path), "4h", out, str(tmp_path / "progress"), "40 days").awaitTermination()
    assert rows_of(store.read_bars(spark, out)) == rows_of(bars_from_ticks(ticks, "4h"))


def test_late_rows_are_dropped_and_counted(spark, shuffled, tmp_path):
    path, ticks = shuffled
    out = str(tmp_path / "bars")
    counter = LateRows()
    spark.streams.addListener(counter)
    query = stream_to_store(read(spark, path), "4h", out, str(tmp_path / "progress"), "1 hour")
    query.awaitTermination()
    assert late_rows(query) > 0
    for _ in range(100):  # the listener hears of a batch a little later
        if sum(counter.batches.values()) == late_rows(query):
            break
        time.sleep(0.1)
    spark.streams.removeListener(counter)
    counts = str(tmp_path / "late")
    counter.save(spark, counts)
    counter.save(spark, counts)
    assert LateRows.total(spark, counts).first().rows_dropped == late_rows(query)
    assert 0 < store.read_bars(spark, out).count() < bars_from_ticks(ticks, "4h").count()
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] < 50


def test_late_ticks_replace_the_bar(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "bars")
    first = [("A", datetime(2024, 1, 1, 10, 5), 2.0, 1, 1), ("A", datetime(2024, 1, 1, 10, 6), 3.0, 1, 2)]
    later = [("A", datetime(2024, 1, 1, 10, 1), 9.0, 4, 3)]
    expected = [("A", datetime(2024, 1, 1, 10), 9.0, 9.0, 2.0, 3.0, 6)]
    for rows in (first, later):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream_to_store(read(spark, source), "1h", out, str(tmp_path / "progress")).awaitTermination()
    assert rows_of(store.read_bars(spark, out)) == expected


def test_calendar_bars_are_not_streamed(spark, shuffled):
    with pytest.raises(ValueError):
        streaming_bars(read(spark, shuffled[0]), "1w", "1 day")
