"""Queries of the store's runs and states, of streams, gaps and histories; `checks/store_oracle.py` holds their SQL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import classify, sizes
from barloom.functions.intervals import LABELS, known_label
from barloom.operators import bars, coverage, freshness, history, profile, query, universe, upsert
from barloom.plans import bar_building, market_days, propagation, universe_update
from barloom.operators.spread import TASK_ROWS
from barloom.session import scratch_path, session_settings
from barloom.sources import store, ticks, universes
from barloom.sources.folders import names_like, path_exists, remove_path
from barloom.streaming import incremental, lake, landing
from checks import inputs, queries

Query = Callable[[SparkSession, str], DataFrame]
OHLCV = ("open", "high", "low", "close", "volume")
PARTS = 5
WIDER = ("1d", "1w", "1M", "3M", "1Q", "1Y")
# JSON lines shrink to a sixth. A compressed file is read by one task, so that it may hold so many lines.
LANDED_FILES = {"compression": "gzip", "maxRecordsPerFile": TASK_ROWS}


def part_of(rows: DataFrame, k: int, parts: int = PARTS) -> DataFrame:
    return rows.where(F.col("seq") % parts == k)


def arriving(spark: SparkSession, sf: str) -> Iterator[DataFrame]:
    """Events as a stream that grows by five parts, each of which spans all the time: once for each part that has come.

    A part has as many files as there are tasks to write it, and is one batch of the run that follows on it.
    """
    rows, source = inputs.event_ticks(spark, sf), scratch_path(spark, "arriving")
    for k in range(PARTS):
        part_of(rows, k).write.mode("append").parquet(source)
        yield spark.readStream.schema(rows.schema).parquet(source)


# Runs and states


def store_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Bars merged in many runs of unlike size, then made one run a bucket: the last merge of a bar wins."""
    hourly = bars.bars_from_ticks(inputs.user_ticks(spark, sf), "1h", "seq")
    path = scratch_path(spark, "bars")
    store.write_bars(hourly, path)
    hour = F.hour("timestamp")
    for k in range(4):
        store.merge_bars(spark, hourly.where(hour % (k + 2) == 0).withColumn("close", F.col("close") + 1000 * (k + 1)), path)
    store.compact(spark, path)
    store.vacuum(spark, path, keep=1)
    return store.read_bars(spark, path).select("ticker", "interval", "timestamp", "close", "volume")


def changed_store(spark: SparkSession, sf: str) -> str:
    """A store after an upsert, a replay of it, an append and two deletions."""
    path = scratch_path(spark, "bars")
    stored = inputs.user_bars(spark, sf)
    cut = F.lit("2024-01-12").cast("timestamp_ntz")
    store.merge_bars(spark, stored.where(F.col("timestamp") < cut), path)
    again = stored.where(F.dayofmonth("timestamp") % 3 == 0)
    for _ in range(2):
        store.merge_bars(spark, again, path)
    store.merge_bars(spark, stored.where(F.col("timestamp") >= cut), path)
    store.delete_series(spark, path, "7")
    store.delete_series(spark, path, "8", "1m")
    return path


def series_state(spark: SparkSession, sf: str) -> DataFrame:
    return store.read_series(spark, changed_store(spark, sf)).drop("asset_type")


def state_totals(spark: SparkSession, sf: str) -> DataFrame:
    """The store's statistics and a summary of asked-for series, both from states alone."""
    states = store.read_series(spark, changed_store(spark, sf))
    asked = freshness.work_list(inputs.customers(spark, sf), ["1m", "1d"])
    summed = profile.summary_of_states(states, asked).groupBy("status").agg(
        F.count(F.lit(1)).alias("series"), F.sum("records").alias("records"), F.min("start_date").alias("start_date"), F.max("end_date").alias("end_date")
    )
    stats = profile.store_statistics(states).select(
        F.lit("all").alias("status"), "series", F.col("tickers").alias("records"), F.lit(None).cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date")
    )
    return summed.unionByName(stats)


def one_identity_details(spark: SparkSession, sf: str) -> DataFrame:
    """Series that details make funds, merged again by a writer without details: one bar a key, the last writer's."""
    path = scratch_path(spark, "bars")
    rows = inputs.event_ticks(spark, sf)
    details = rows.select("ticker").distinct().withColumn("type", F.when(F.col("ticker") != "view", "ETF").otherwise("CS"))
    bar_building.build_bars(spark, rows, ["1h", "1d"], path, details=details)
    later = bars.bars_from_ticks(rows, "1h").where(F.dayofmonth("timestamp") > 15)
    store.merge_bars(spark, later.withColumn("close", F.col("close") * 2), path)
    return store.read_bars(spark, path).select("asset_type", "ticker", "interval", "timestamp", "open", "close", "volume")


def unknown_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of unknown and of negative numbers: an unknown one ranks lowest, on each side and within it."""
    line = inputs.table(spark, sf, "lineitem").groupBy("l_partkey", "l_suppkey", "l_linenumber").agg(F.max("l_extendedprice").alias("close"))
    number = F.when(F.col("l_linenumber") % 3 > 0, F.col("l_suppkey") * 10 + F.col("l_linenumber") - 100_000)
    rows = line.select(
        F.col("l_partkey").cast("string").alias("ticker"), F.lit("1d").alias("interval"), F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"), "close",
        number.cast("bigint").alias("seq"), (F.col("l_suppkey") % 2).alias("side"),
    )
    # Of the unknown ones of a side and ticker one is given, so that there are no ties.
    rows = rows.groupBy("ticker", "interval", "timestamp", "side", "seq").agg(F.max("close").alias("close"))
    old, new = (rows.where(F.col("side") == k).drop("side") for k in (0, 1))
    return upsert.upsert_bars(old, new, seq="seq")


def bucket_series(spark: SparkSession, sf: str) -> DataFrame:
    """One series of a store of many, by its bucket, periods and row groups."""
    path = scratch_path(spark, "bars")
    store.write_bars(bars.bars_from_ticks(inputs.user_ticks(spark, sf), "1h", "seq"), path)
    found = query.select_series(store.read_bars(spark, path), "4", "1h", queries.FIRST, queries.LAST)
    return query.first_rows(found, ["ticker", "timestamp", "open", "close", "volume"])


# Streams


def stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Five micro-batches, late ticks in each, become bars, days, weeks, months, quarters and years."""
    path, progress = scratch_path(spark, "bars"), scratch_path(spark, "stream")
    for rows in arriving(spark, sf):
        incremental.stream_to_store(rows, "1h", path, progress, "40 days", "seq", WIDER).awaitTermination()
    return store.read_bars(spark, path).select("ticker", "interval", "timestamp", *OHLCV)


def rebuilt_bins(spark: SparkSession, sf: str) -> DataFrame:
    """Some daily bars corrected: the wider ones that hold them are built again (number 0), no others (number 7)."""
    path = scratch_path(spark, "bars")
    traded = inputs.order_ticks(spark, sf).withColumn("ticker", F.concat(F.lit("O"), F.col("seq") % 7)).withColumn("size", F.lit(1).cast("bigint"))
    whole = bars.bars_for_intervals(traded, WIDER, "seq")
    store.write_bars(whole.withColumn("ingest_seq", F.lit(7)), path)
    fixed = whole.where("interval = '1d' AND ticker IN ('O1', 'O2') AND timestamp >= '1998-05-01' AND timestamp < '1998-05-20'")
    fixed = fixed.withColumn("low", F.col("low") / 2)
    store.merge_bars(spark, fixed, path)
    propagation.propagate(spark, path, fixed, "1d", WIDER[1:])
    return store.read_bars(spark, path).select("ticker", "interval", "timestamp", *OHLCV, "ingest_seq")


def late_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks later than an hour are kept aside and repaired afterwards, wider bars with them; with their number."""
    path, lake_path, progress = (scratch_path(spark, name) for name in ("bars", "lake", "stream"))
    wider = ("1d", "1w")
    for rows in arriving(spark, sf):
        lake.stream_through_lake(rows, "1h", path, lake_path, progress, "'1' HOUR", wider).awaitTermination()
    repaired = lake.repair_late(spark, "1h", path, lake_path, wider).first()
    again = lake.repair_late(spark, "1h", path, lake_path, wider).first()
    out = store.read_bars(spark, path).select("ticker", "interval", "timestamp", *OHLCV)
    counts = {"late_rows": repaired.late_rows, "late_again": again.late_rows}
    return out.withColumns({name: F.lit(n).cast("bigint") for name, n in counts.items()})


def late_before_repair(spark: SparkSession, sf: str) -> DataFrame:
    """The side table: late ticks by the batch they came with."""
    path, lake_path, progress = (scratch_path(spark, name) for name in ("bars", "lake", "stream"))
    for rows in arriving(spark, sf):
        lake.stream_through_lake(rows, "1h", path, lake_path, progress, "'1' DAY").awaitTermination()
    return lake.late_ticks(spark, lake_path).select("batch", "ticker", "timestamp", "price", "size")


def streamed(spark: SparkSession, sf: str) -> tuple[str, str, str]:
    """Landed lines in parts of which some come twice, the last first; each part is one batch of the run that follows on it.

    The lines are made once and dealt to parts; a part has as many files as there are tasks to write it, and is held until
    it has come for the last time. The store's runs that no longer count go after each batch, landed files after the batch
    that follows theirs: a stream that starts looks at those of the batch before. The folders of the bars, the rejects and
    the landed files.
    """
    source, held, path, rejects, progress = (scratch_path(spark, name) for name in ("lines", "parts", "bars", "rejects", "stream"))
    key = F.pmod(F.xxhash64("value"), F.lit(4)).cast("int")
    with session_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "4"}):  # else each task would sort its lines by part
        queries.landed_text(spark, sf).withColumn("part", key).write.options(**LANDED_FILES).partitionBy("part").text(held)
    arrivals, landed = [3, 1, 3, 0, 2, 1], []
    for k, part in enumerate(arrivals):
        folder = f"{held}/part={part}"
        lines = spark.read.text(folder) if path_exists(spark, folder) else spark.createDataFrame([], "value string")
        lines.write.mode("append").options(**LANDED_FILES).text(source)
        landed.append(set(names_like(spark, f"{source}/part-*")).difference(*landed))
        if part not in arrivals[k + 1 :]:
            remove_path(spark, folder)
        landing.stream_landing(spark.readStream.schema("value string").text(source), path, rejects, progress).awaitTermination()
        store.vacuum(spark, path, keep=1)
        for name in landed[-2] if 0 < k < len(arrivals) - 1 else ():
            remove_path(spark, f"{source}/{name}")
    return path, rejects, source


def streamed_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of the streamed files: of copies of a bar the one that a single read would keep, so counted by what is sure."""
    path, _, source = streamed(spark, sf)
    remove_path(spark, source)
    lines = queries.landed_text(spark, sf)
    once, _ = landing.split_lines(lines)
    key = ["ticker", "interval", "timestamp"]
    kept = upsert.keep_one(store.shape_bars(once), key, "ingest_seq").select(*key, "close", "volume")
    found = store.read_bars(spark, path).select(*key, F.col("close").alias("_close"), F.col("volume").alias("_volume"))
    same = F.col("close").eqNullSafe(F.col("_close")) & F.col("volume").eqNullSafe(F.col("_volume"))
    # The join on the whole key is where `kept` has its rows already.
    return kept.join(found, key, "full").select("ticker", "timestamp", same.alias("as_one_read"))


def streamed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    _, rejects, source = streamed(spark, sf)
    remove_path(spark, source)
    return landing.read_rejects(spark, rejects).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("lines"))


def market_store(spark: SparkSession, sf: str) -> DataFrame:
    """The market's days merged, then those of January 1998 again with other prices: the last rows win."""
    line = inputs.table(spark, sf, "lineitem")
    days = line.groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("day")).agg(
        F.max("l_extendedprice").alias("c"), F.sum("l_quantity").alias("v")
    )
    raw = days.select(F.concat(F.lit("m"), F.col("l_suppkey").cast("string")).alias("T"), "day", "c", "v")
    raw = raw.withColumns({"o": F.col("c") - 1, "h": F.col("c") + 1, "l": F.col("c") - 2, "vw": F.col("c"), "n": F.lit(1)})
    path = scratch_path(spark, "bars")
    market_days.merge_market_days(spark, raw, F.col("day"), path, rows=line.count())
    again = raw.where("day >= '1998-01-01' AND day < '1998-02-01'").withColumn("c", F.col("c") * 2)
    for _ in range(2):
        market_days.merge_market_days(spark, again, F.col("day"), path)
    return store.read_bars(spark, path).select("asset_type", "ticker", "interval", "timestamp", "open", "close", "volume")


# Coverage and history


def gapped(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly bars of which some days and hours are gone."""
    hourly = bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1h")
    gone = (F.dayofmonth("timestamp") % 7 == F.length("ticker") % 7) | (F.hour("timestamp") % 11 == 3)
    return hourly.where(~gone)


def coverage_islands(spark: SparkSession, sf: str) -> DataFrame:
    return coverage.islands(gapped(spark, sf))


def coverage_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """What the provider offers of January and the store lacks, inner gaps among it."""
    held = gapped(spark, sf)
    offered = held.select("ticker", "interval").distinct().withColumns({"start_date": F.lit("2024-01-03").cast("date"), "end_date": F.lit("2024-02-02").cast("date")})
    return coverage.fetch_ranges(offered, held)


def load_statuses(spark: SparkSession, sf: str) -> DataFrame:
    """Every outcome of a load: series without a range, with an error, up to date, without new data, and loaded."""
    local, landed_rows = queries.local_and_landed(spark, sf)
    known = inputs.provider_ranges(spark, sf)
    asked = freshness.work_list(inputs.customers(spark, sf), inputs.EVENT_INTERVALS.values()).join(known, ["ticker", "interval"], "left")
    resume = freshness.resume_points(asked, freshness.high_water_marks(local))
    number = F.col("ticker").cast("bigint")
    errors = resume.where(number % 11 == 0).select("ticker", "interval", F.concat(F.lit("no answer for "), "ticker").alias("error"))
    return freshness.fetch_report(resume, freshness.rows_to_fetch(landed_rows, resume), local, errors)


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Three snapshots of the parts: the second changes some, the third drops some and brings some back."""
    parts = inputs.part_universe(spark, sf).withColumn("k", F.substring("ticker", 2, 20).cast("bigint"))
    made = []
    for n, keep in enumerate((F.col("k") % 5 != 4, F.col("k") % 7 != 3, F.col("k") % 3 != 1)):
        name = F.when((F.col("k") % 4 == 2) & F.lit(n > 0), F.concat("name", F.lit(" II"))).otherwise(F.col("name"))
        made.append(parts.where(keep).select(F.concat(F.lit("b"), F.col("k") % 2).alias("category"), F.lit(f"2024-01-{10 * n + 1:02d}T00:00:00").alias("created_at"), "ticker", name.alias("name"), "type"))
    return made[0].unionByName(made[1]).unionByName(made[2])


def universe_history(spark: SparkSession, sf: str) -> DataFrame:
    return history.validity(snapshots(spark, sf), ["name", "type"])


def universe_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines with the name that their part had on the day they were asked for."""
    line = inputs.table(spark, sf, "lineitem")
    day = F.date_add(F.lit("2023-12-28").cast("date"), (F.col("l_orderkey") % 40).cast("int")).cast("string")
    rows = line.select(F.concat(F.lit("P"), F.col("l_partkey")).alias("ticker"), day.alias("day")).groupBy("ticker", "day").agg(F.count(F.lit(1)).alias("lines"))
    return history.as_of(rows, universe_history(spark, sf).drop("type", "ended"), "day")


def universe_update_job(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of some instruments, then all instruments appended: documents in, documents out."""
    path = scratch_path(spark, "universes")
    found = inputs.instruments(spark, sf)
    early = found.where(F.col("primary_exchange") < "NATION_2").withColumn("name", F.concat(F.lit("old "), "name"))
    universe_update.update_universes(spark, early, path, datetime(2024, 1, 1))
    report = universe_update.update_universes(spark, found, path, datetime(2024, 2, 1))
    listed = universes.entries(universes.read_written(spark, path)).select("category", "ticker", "name")
    return listed.join(report, "category")


def universe_strings(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose entries are plain symbols, and some objects among them."""
    customer = inputs.table(spark, sf, "customer")
    symbol = F.when(F.col("c_custkey") % 5 > 0, F.to_json(F.array("c_name"))).otherwise(F.concat(F.lit("["), F.to_json(F.struct(F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("name"))), F.lit("]")))
    inner = F.regexp_extract(symbol, r"^\[(.*)\]$", 1)
    part = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list(inner)), ","), F.lit("]"))
    docs = customer.groupBy("c_mktsegment", (F.col("c_custkey") % 50).alias("part")).agg(part.alias("tickers"))
    lines = docs.select(F.concat(F.lit('{"category":"'), "c_mktsegment", F.lit('","tickers":'), "tickers", F.lit("}")).alias("value"))
    return universes.entries(universes.parse_documents(lines)).select("category", "ticker", "name")


def category_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first 1200 of each supplier region by price, of rows many of which tie."""
    line = inputs.table(spark, sf, "lineitem")
    rows = line.select((F.col("l_suppkey") % 3).alias("category"), F.col("l_quantity").alias("quantity"), F.col("l_linenumber").alias("line"))
    return universe.first_of_each(rows, ["category"], ["quantity", "line"], 1200).groupBy("category", "quantity", "line").agg(F.count(F.lit(1)).alias("rows"))


def every_asset_type(spark: SparkSession, sf: str) -> DataFrame:
    """Parts named by every crypto prefix, every fund and every ending, and by look-alikes of them."""
    names = [*classify.CRYPTO_PREFIXES, *classify.KNOWN_ETFS, *classify.ETF_SUFFIXES, "USD", "USDT", "X:", "QQ", "X"]
    part = inputs.table(spark, sf, "part")
    name = F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_partkey") % len(names) + 1).cast("int"))
    key = F.col("p_partkey").cast("string")
    ticker = F.when(F.col("p_size") % 4 == 0, name).when(F.col("p_size") % 4 == 1, F.concat(name, key)).when(F.col("p_size") % 4 == 2, F.concat(F.lit("Z"), key, name))
    shaped = part.select(F.coalesce(ticker, F.lower(name)).alias("ticker")).distinct()
    return universe.with_asset_type(shaped)


def day_file_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Files of a day by symbol, listed out of the events: how many there are of some symbols, and their megabytes."""
    day, name = F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lit("U"), F.col("user_id").cast("string"))
    path = F.concat_ws("/", F.lit("/lake/trades"), day, F.concat(name, F.when(F.col("user_id") % 9 > 0, ".csv.gz").otherwise("")))
    files = inputs.table(spark, sf, "events").groupBy(path.alias("path")).agg((F.count(F.lit(1)) * 4096).alias("bytes"))
    report = ticks.day_file_report(files, [f"U{k}" for k in range(1, 60, 3)], queries.FIRST, queries.LAST)
    return report.select("date", "status", F.col("files_downloaded").cast("bigint").alias("files_downloaded"), "total_size_mb")


def mixed_tick_files(spark: SparkSession, sf: str) -> DataFrame:
    """Day folders of files by symbol: with and without size, prices as doubles, text and whole cents, times as text."""
    rows = inputs.event_ticks(spark, sf).withColumn("day", F.dayofmonth("timestamp"))
    root = scratch_path(spark, "days")
    forms = {
        2: {"timestamp": "timestamp", "price": "price", "size": "size", "seq": "seq"},
        3: {"timestamp": "timestamp", "price": "price"},
        4: {"timestamp": "cast(timestamp as string)", "price": "cast(price as string)", "size": "cast(size as int)"},
        5: {"timestamp": "timestamp", "price": "cast(round(price * 100) as int)", "size": "size"},
    }
    for day, form in forms.items():
        for symbol in ("click", "view"):
            chosen = rows.where((F.col("day") == day) & (F.col("ticker") == symbol))
            lacking = ("size",) if (day, symbol) == (2, "click") else ()  # what the folder's other file has
            path = f"{root}/trades/2024-01-{day:02d}/{symbol}.parquet"
            chosen.select(*[F.expr(e).alias(c) for c, e in form.items() if c not in lacking]).coalesce(1).write.parquet(path)
    found = ticks.read_tick_days(spark, root, queries.FIRST, queries.LAST)
    return bars.bars_from_ticks(found, "1h")


def exact_sizes(spark: SparkSession, sf: str) -> DataFrame:
    line = inputs.table(spark, sf, "lineitem")
    sized = line.groupBy("l_suppkey").agg(F.sum(F.floor("l_extendedprice")).cast("bigint").alias("bytes"))
    return sized.select("l_suppkey", sizes.kilobytes(F.col("bytes")).alias("kb"), sizes.megabytes(F.col("bytes")).alias("mb"))


def interval_checks(spark: SparkSession, sf: str) -> DataFrame:
    """Which of the labels that the rows name, and of their spellings in capitals, are intervals."""
    rows = inputs.table(spark, sf, "lineitem").select(F.element_at(F.array(*[F.lit(n) for n in (*LABELS, "7m", "1D", "", "1W", "2d")]), (F.col("l_orderkey") % (len(LABELS) + 5) + 1).cast("int")).alias("interval"))
    return rows.groupBy("interval", known_label(F.col("interval")).alias("known")).agg(F.count(F.lit(1)).alias("rows"))


def registry() -> dict[str, Query]:
    named = (
        store_runs, series_state, state_totals, one_identity_details, unknown_orders, bucket_series,
        stream_batches, rebuilt_bins, late_repair, late_before_repair, streamed_landing, streamed_rejects, market_store,
        coverage_islands, coverage_gaps, load_statuses, universe_history, universe_as_of, universe_update_job,
        universe_strings, category_first, every_asset_type, day_file_counts, mixed_tick_files, exact_sizes, interval_checks,
    )
    return {f.__name__: f for f in named}
