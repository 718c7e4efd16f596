"""One Spark query per operator; `checks/oracle.py` holds the SQL of the same name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import sizes, timing
from barloom.functions.intervals import INTRADAY_LABELS, LABELS
from barloom.operators import bars, calendar, freshness, profile, query, storage, universe, upsert
from barloom.plans import backfill, bar_building
from barloom.schemas import BAR_VALUES
from barloom.session import scratch_path
from barloom.sources import landed, store, ticks, universes
from barloom.streaming import incremental
from checks import inputs

Query = Callable[[SparkSession, str], DataFrame]

FIXED_LABELS = (*INTRADAY_LABELS, "1d")
CALENDAR_LABELS = {"1w": "1w", "1M": "1mo", "3M": "3mo", "1Q": "1q", "1Y": "1y"}
MANY_LABELS = ("1m", "5m", "15m", "45m", "1h", "4h", "12h", "1d", "1w", "1M", "1Y")
FIRST, LAST = date(2024, 1, 1), date(2024, 1, 31)
CUTOFF = date.fromisoformat(inputs.CUTOFF)
HYBRID_FIRST = date(2024, 1, 4)
PART_KEYWORDS = ("RING", "BOLT")
CREATED = datetime(2024, 1, 31, 12, 0)


def as_of():
    return F.lit(inputs.AS_OF).cast("timestamp_ntz")


def spread() -> list[Column]:
    """Aggregates that need all price columns and do not depend on the order of rows."""
    return [f(c).alias(c) for f, c in ((F.max, "open"), (F.max, "high"), (F.min, "low"), (F.max, "close"))]


# Bars


def ohlcv(label: str, spark: SparkSession, sf: str) -> DataFrame:
    return bars.bars_from_ticks(inputs.event_ticks(spark, sf), label)


def ohlc_orders(label: str, spark: SparkSession, sf: str) -> DataFrame:
    return bars.bars_from_ticks(inputs.order_ticks(spark, sf), label, tie_break="seq")


def day_file_bars(spark: SparkSession, sf: str) -> DataFrame:
    return bars.day_file_bars(inputs.event_ticks(spark, sf), "5m")


def intraday_bars(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.event_ticks(spark, sf).withColumn("price", F.when(F.col("size") >= 20, F.col("price")))
    return bars.intraday_bars(rows, "30m")


def user_hourly_bars(spark: SparkSession, sf: str) -> DataFrame:
    per_user = inputs.user_bars(spark, sf).select("ticker", "timestamp", F.col("open").alias("price"), F.col("volume").alias("size"))
    return bars.bars_from_ticks(per_user, "1h")


def vwap_1d(spark: SparkSession, sf: str) -> DataFrame:
    out = bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1d", extended=True)
    return out.withColumn("vwap", F.round("vwap", 4))


def rollup_1m_to_1h(spark: SparkSession, sf: str) -> DataFrame:
    return bars.roll_up(bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1m"), "1m", "1h")


def rollup_1d_to_1q(spark: SparkSession, sf: str) -> DataFrame:
    daily = bars.bars_from_ticks(inputs.order_ticks(spark, sf), "1d", tie_break="seq")
    return bars.roll_up(daily, "1d", "1Q")


def rollup_vwap(spark: SparkSession, sf: str) -> DataFrame:
    fine = bars.bars_from_ticks(inputs.event_ticks(spark, sf), "15m", extended=True)
    return bars.roll_up(fine, "15m", "1d").withColumn("vwap", F.round("vwap", 4))


def holey_ticks(spark: SparkSession, sf: str) -> DataFrame:
    """Ticks of which the small ones have no price, and so whole fine bins have none."""
    return inputs.event_ticks(spark, sf).withColumn("price", F.when(F.col("size") >= 20, F.col("price")))


def rollup_vwap_holey(spark: SparkSession, sf: str) -> DataFrame:
    fine = bars.bars_from_ticks(holey_ticks(spark, sf), "1m", extended=True, complete=False)
    return bars.roll_up(fine, "1m", "1d").withColumn("vwap", F.round("vwap", 4))


def multi_interval_holey(spark: SparkSession, sf: str) -> DataFrame:
    out = bars.bars_for_intervals(holey_ticks(spark, sf), LABELS, extended=True)
    # A third has no exact ties to round.
    return out.withColumn("vwap", F.round(F.col("vwap") / 3, 6))


def multi_interval_bars(spark: SparkSession, sf: str) -> DataFrame:
    return bars.bars_for_intervals(inputs.event_ticks(spark, sf), MANY_LABELS)


def all_interval_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = bars.bars_for_intervals(inputs.event_ticks(spark, sf), LABELS)
    return out.groupBy("interval").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"), *spread())


def building_report(spark: SparkSession, sf: str) -> DataFrame:
    return bar_building.building_report(bars.bars_for_intervals(inputs.event_ticks(spark, sf), ["1h", "1d"]))


def file_symbol_bars(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"timestamp": "o_orderdate", "price": "o_totalprice", "seq": "o_orderkey"}
    rows = ticks.read_tick_files(inputs.pin_utc(spark), f"{sf}/orders.parquet", columns)
    return bars.bars_from_ticks(rows, "1d", tie_break="seq")


# Merging


def split_bars(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    hourly = bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1h")
    doubled = {c: F.col(c) * 2 for c in ("open", "high", "low", "close")}
    existing = hourly.where(F.col("timestamp") < F.lit(inputs.CUTOFF).cast("timestamp_ntz"))
    new = hourly.where(F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp_ntz")).withColumns(doubled)
    return existing, new


def upsert_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert_bars(*split_bars(spark, sf))


def upsert_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.upsert_bars(*split_bars(spark, sf), keep="first")


def duplicates_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    orders = inputs.order_ticks(spark, sf).select("ticker", "timestamp", F.col("price").alias("close"), F.col("seq").alias("ingest_seq"))
    return upsert.keep_one(orders, ["ticker", "timestamp"], "ingest_seq")


def append_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    existing, found = universe_sides(spark, sf)
    return universe.append_universe(existing, found)


def universe_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored entries named after the part, found entries after the supplier, keys overlapping."""
    parts = inputs.table(spark, sf, "part").select(F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("ticker"), F.col("p_name").alias("name"))
    found = inputs.table(spark, sf, "lineitem").groupBy("l_suppkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    number = F.col("l_suppkey") * 100 + F.col("l_linenumber")
    ticker = F.when(F.col("l_linenumber") > 1, F.concat(F.lit("S"), number.cast("string")))
    return parts, found.select(ticker.alias("ticker"), F.concat(F.lit("lot "), F.col("n").cast("string")).alias("name"))


def universe_append_count(spark: SparkSession, sf: str) -> DataFrame:
    return upsert.count_new(*universe_sides(spark, sf))


def hybrid_series(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.event_ticks(spark, sf)
    labels = ["1h", "1d", "1w", "1M"]
    provider = store.shape_bars(bars.bars_for_intervals(rows, labels))
    provider = provider.withColumns({c: F.col(c) + 1000 for c in ("open", "high", "low", "close")})
    out = upsert.hybrid_series(rows, provider, labels, HYBRID_FIRST, LAST, CUTOFF)
    return out.select("asset_type", "ticker", "interval", "timestamp", "open", "high", "low", "close", "volume")


def series_head_tail(spark: SparkSession, sf: str) -> DataFrame:
    out = upsert.head_tail(inputs.user_bars(spark, sf))
    return out.select("ticker", "interval", "edge", F.col("position").cast("bigint").alias("position"), "timestamp", "open", "volume")


# Freshness


def high_water_mark(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.high_water_marks(inputs.user_bars(spark, sf))


def date_range_estimate(spark: SparkSession, sf: str) -> DataFrame:
    requested = freshness.work_list(inputs.customers(spark, sf))
    ranges = freshness.available_ranges(inputs.user_bars(spark, sf), "range")
    return freshness.answer_ranges(requested, ranges)


def listed_ranges(spark: SparkSession, sf: str) -> DataFrame:
    listing = inputs.customers(spark, sf).withColumn("list_date", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("ticker").cast("bigint") % 15).cast("int")))
    return freshness.available_ranges(inputs.user_bars(spark, sf), "range", listing)


def timeframe_availability(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.available_ranges(inputs.user_bars(spark, sf), "probe")


def timeframe_flags(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.timeframe_flags(freshness.available_ranges(inputs.user_bars(spark, sf)))


def timeframe_map(spark: SparkSession, sf: str) -> DataFrame:
    nested = freshness.timeframe_map(freshness.available_ranges(inputs.user_bars(spark, sf)))
    entries = F.transform(F.sort_array(F.map_entries("timeframes")), lambda e: F.concat_ws(":", e["key"], e["value"]["estimated_bars"].cast("string")))
    return nested.select("ticker", F.array_join(entries, ",").alias("timeframes"))


def fresh(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.freshness(inputs.provider_ranges(spark, sf), high_water_mark(spark, sf))


def verify_per_ticker(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.verify_tickers(fresh(spark, sf), inputs.customers(spark, sf))


def verify_totals(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.verify_totals(verify_per_ticker(spark, sf))


def plan_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.plan_outcome(fresh(spark, sf), inputs.customers(spark, sf))


def resume_points(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.resume_points(inputs.provider_ranges(spark, sf), high_water_mark(spark, sf))


def resume_all_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Every label: the marks of the heavy tickers crossed with the vocabulary."""
    marks = inputs.event_ticks(spark, sf).groupBy("ticker").agg(F.max("timestamp").alias("last_timestamp"))
    listed = freshness.work_list(marks, LABELS).join(marks, "ticker")
    point = timing.resume_point(F.col("interval"), F.col("last_timestamp"))
    return listed.select("ticker", "interval", point.alias("resume_from"))


def local_and_landed(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    landed_rows = inputs.user_bars(spark, sf)
    local = landed_rows.where(F.col("timestamp") < F.lit("2024-01-12").cast("timestamp_ntz"))
    return local, landed_rows


def resume_rows(spark: SparkSession, sf: str) -> DataFrame:
    local, landed_rows = local_and_landed(spark, sf)
    return backfill.rows_due(inputs.provider_ranges(spark, sf), landed_rows, local)


def load_report(spark: SparkSession, sf: str) -> DataFrame:
    local, landed_rows = local_and_landed(spark, sf)
    resume = freshness.resume_points(inputs.provider_ranges(spark, sf), freshness.high_water_marks(local))
    return freshness.fetch_report(resume, freshness.rows_to_fetch(landed_rows, resume), local)


def load_summary(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.load_summary(load_report(spark, sf))


def series_file_rows(spark: SparkSession, sf: str) -> DataFrame:
    per_series = inputs.user_bars(spark, sf).groupBy("ticker", "interval").agg(F.max("timestamp").alias("last_timestamp"))
    path = F.concat_ws(".", "ticker", "interval", F.lit("parquet"))
    modified = F.col("last_timestamp") + F.expr("INTERVAL '6' HOUR")
    return per_series.withColumns({"modified": modified, "path": path})


def newest_files(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.series_files(series_file_rows(spark, sf))


def prefilter_skip(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.fresh_tickers(newest_files(spark, sf), as_of()).select("ticker", "n_files", "newest_modified")


def to_process(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.to_process(inputs.customers(spark, sf), prefilter_skip(spark, sf))


def work_list(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.work_list(inputs.customers(spark, sf), LABELS)


def progress(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.progress(inputs.customers(spark, sf), inputs.user_bars(spark, sf))


def series_ages(spark: SparkSession, sf: str) -> DataFrame:
    return series_file_rows(spark, sf).select(
        "ticker",
        "interval",
        F.round(timing.age_hours(as_of(), F.col("modified")), 4).alias("age_hours"),
        timing.whole_days(as_of(), F.col("last_timestamp")).alias("days_old"),
    )


# Universes


def category_filter(spark: SparkSession, sf: str) -> DataFrame:
    return universe.discover(inputs.instruments(spark, sf))


def category_limit(spark: SparkSession, sf: str) -> DataFrame:
    return universe.discover(inputs.instruments(spark, sf), limit=50).select("category", "ticker")


def discovery_report(spark: SparkSession, sf: str) -> DataFrame:
    found = universe.discover(inputs.instruments(spark, sf))
    existing = found.where(F.col("primary_exchange") < "NATION_2")
    return universe.discovery_report(existing, found)


def universe_filter(spark: SparkSession, sf: str) -> DataFrame:
    return universe.filter_universe(inputs.part_universe(spark, sf), "Brand#2", 8, True, PART_KEYWORDS)


def asset_types(spark: SparkSession, sf: str) -> DataFrame:
    symbols = inputs.shaped_symbols(spark, sf)
    return universe.with_asset_type(symbols.select("ticker"), symbols)


def market_types(spark: SparkSession, sf: str) -> DataFrame:
    symbols = inputs.shaped_symbols(spark, sf)
    return universe.with_market_type(symbols.select("ticker", "has_short_minutes"), symbols)


def batches(spark: SparkSession, sf: str) -> DataFrame:
    return universe.batches(inputs.part_universe(spark, sf).select("ticker"), 100)


def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    return universe.batch_report(inputs.part_universe(spark, sf), 100, 1, 2)


def universe_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents built from instruments, encoded as JSON, read back, one row per entry."""
    found = universe.discover(inputs.instruments(spark, sf))
    return universes.entries(universes.parse_documents(document_lines(found)))


def document_lines(found: DataFrame) -> DataFrame:
    totals = found.groupBy("category").agg(F.count(F.lit(1)).alias("count"), F.count(F.lit(1)).alias("new_tickers_added"))
    docs = universes.documents(found, totals, CREATED, per_document=200)
    return docs.select(F.to_json(F.struct(*docs.columns)).alias("value"))


def universe_listing(spark: SparkSession, sf: str) -> DataFrame:
    found = universe.discover(inputs.instruments(spark, sf))
    docs = universes.parse_documents(document_lines(found))
    return universe.list_universes(universes.headers(docs))


def universe_store(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written, one category deleted, the rest read back."""
    found = universe.discover(inputs.instruments(spark, sf))
    totals = found.groupBy("category").agg(F.count(F.lit(1)).alias("count"), F.count(F.lit(1)).alias("new_tickers_added"))
    path = scratch_path(spark, "universes")
    universes.write_documents(universes.documents(found, totals, CREATED), path)
    store.delete_universe(spark, path, "fx")
    docs = universes.read_written(spark, path)
    return universe.latest_snapshots(universes.headers(docs)).select("category", "count", "new_tickers_added")


def sorted_tickers(spark: SparkSession, sf: str) -> DataFrame:
    return universe.sorted_tickers(inputs.user_bars(spark, sf))


def name_sample(spark: SparkSession, sf: str) -> DataFrame:
    return universe.sample_names(inputs.part_universe(spark, sf)).select(F.array_join("sample", ",").alias("sample"))


# Reading and profiles


def series_query(spark: SparkSession, sf: str) -> DataFrame:
    hourly = bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1h")
    series = query.select_series(store.shape_bars(hourly).select(*hourly.columns), "view", "1h", date(2024, 1, 5), date(2024, 1, 25))
    return query.first_rows(series)


def series_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The first thousand of more rows."""
    minutes = store.shape_bars(bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1m"))
    return query.first_rows(query.select_series(minutes, "View", "1m"), ["ticker", "timestamp", "open", "close", "volume"], query.ROW_LIMIT)


def series_columns(spark: SparkSession, sf: str) -> DataFrame:
    daily = bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1d")
    return query.first_rows(query.select_series(daily, start=date(2024, 1, 3)), ["ticker", "timestamp", "close"], 60)


def range_rows(spark: SparkSession, sf: str) -> DataFrame:
    return query.select_series(inputs.user_bars(spark, sf), None, "1m", date(2024, 1, 5), date(2024, 1, 25))


def series_header(spark: SparkSession, sf: str) -> DataFrame:
    return query.series_header(range_rows(spark, sf))


def series_summary(spark: SparkSession, sf: str) -> DataFrame:
    requested = freshness.work_list(inputs.customers(spark, sf), inputs.EVENT_INTERVALS.values())
    return profile.series_summary(inputs.user_bars(spark, sf), requested)


def series_profile(spark: SparkSession, sf: str) -> DataFrame:
    return freshness.in_display_order(profile.series_profile(inputs.user_bars(spark, sf)))


def overall_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.overall_statistics(profile.series_profile(inputs.user_bars(spark, sf)))


def store_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.store_statistics(inputs.user_bars(spark, sf))


def first_last_bars(spark: SparkSession, sf: str) -> DataFrame:
    return profile.first_last_bars(inputs.user_bars(spark, sf))


# Calendar


def weekday_spine(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.day_spine(calendar.day_bounds(inputs.order_ticks(spark, sf)))


def day_coverage(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.table(spark, sf, "orders").select(F.col("o_orderdate").alias("timestamp"))
    return calendar.day_coverage(weekday_spine(spark, sf), calendar.rows_per_day(rows))


def missing_days(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.table(spark, sf, "orders")
    return calendar.missing_days(weekday_spine(spark, sf), rows.select(F.col("o_orderdate").cast("date").alias("date")))


def available_dates(spark: SparkSession, sf: str) -> DataFrame:
    return calendar.available_dates(ticks.with_date(inputs.order_ticks(spark, sf)), 1997)


def symbol_extract(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.user_bars(spark, sf)
    chosen = inputs.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").cast("string").alias("ticker"))
    picked = calendar.extract_range(rows, chosen, F.lit("2024-01-06").cast("date"), F.lit("2024-01-21").cast("date"))
    return picked.select("ticker", "interval", "timestamp", "close")


def symbol_list_extract(spark: SparkSession, sf: str) -> DataFrame:
    rows = inputs.event_ticks(spark, sf)
    return calendar.extract_range(rows, ["click", "view"], F.lit("2024-01-06").cast("date"), F.lit("2024-01-21").cast("date"))


# Landed rows


def landed_text(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines as provider JSON, some without volume or vwap, some malformed."""
    line = inputs.table(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    fields = F.struct(
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("ticker"),
        F.lit("1d").alias("interval"),
        F.when(F.col("l_linenumber") < 7, F.unix_millis(F.col("l_shipdate").cast("timestamp")).cast("string")).alias("t"),
        price.cast("string").alias("o"),
        (price + F.col("l_quantity")).cast("string").alias("h"),
        F.when(F.col("l_tax") > 0, price.cast("string")).otherwise("n/a").alias("l"),
        price.cast("string").alias("c"),
        F.when(F.col("l_returnflag") == "N", (F.col("l_quantity") + 0.5).cast("string")).alias("v"),
        F.when(F.col("l_returnflag") == "A", price.cast("string")).alias("vw"),
        F.col("l_suppkey").alias("n"),
    )
    return line.select(F.to_json(fields).alias("value"))


def landed_bars(spark: SparkSession, sf: str) -> DataFrame:
    parsed = landed.normalise_bars(landed.parse_json_rows(landed_text(spark, sf), landed.RAW_BAR))
    return landed.accepted(parsed)


def landed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    parsed = landed.normalise_bars(landed.parse_json_rows(landed_text(spark, sf), landed.RAW_BAR))
    return landed.rejected(parsed).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


def reference_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = inputs.instruments(spark, sf).withColumn("type", F.when(F.col("locale") == "us", F.col("type")))
    parsed = landed.normalise_instruments(raw.withColumn("active", F.col("active").cast("string")))
    return landed.accepted(parsed).select("ticker", "name", "market", "locale", "primary_exchange", "type", "active")


def market_rows(spark: SparkSession, sf: str) -> DataFrame:
    line = inputs.table(spark, sf, "lineitem")
    price = F.col("l_extendedprice")
    raw = line.select(
        F.when(F.col("l_linenumber") > 1, F.col("l_partkey").cast("string")).alias("T"),
        F.when(F.col("l_linenumber") < 3, F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))).alias("ticker_name"),
        price.alias("o"), (price + 1).alias("h"), (price - 1).alias("l"), price.alias("c"),
        F.col("l_quantity").alias("v"), price.alias("vw"), F.col("l_orderkey").alias("n"), F.col("l_shipdate").alias("day"),
    )
    return landed.normalise_market_days(raw.withColumn("ticker", F.col("ticker_name")).drop("ticker_name"), F.col("day"))


def market_day_report(spark: SparkSession, sf: str) -> DataFrame:
    rows = market_rows(spark, sf)
    return landed.market_day_report(rows, calendar.day_spine(calendar.day_bounds(rows)))


def market_range_totals(spark: SparkSession, sf: str) -> DataFrame:
    return landed.market_range_totals(market_day_report(spark, sf))


# Stores and streams


def store_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Existing bars written, new ones merged twice: the second merge changes nothing."""
    existing, new = split_bars(spark, sf)
    path = scratch_path(spark, "bars")
    store.write_bars(store.shape_bars(existing), path)
    for _ in range(2):
        store.merge_bars(spark, new, path)
    return store.read_bars(spark, path).select("asset_type", "ticker", "interval", "timestamp", "open", "high", "low", "close", "volume")


def store_delete(spark: SparkSession, sf: str) -> DataFrame:
    """All series of one ticker and one series of another removed; the rest stays."""
    path = scratch_path(spark, "bars")
    labels = ["1h", "1d", "1w"]
    built = bars.bars_for_intervals(inputs.event_ticks(spark, sf), labels)
    store.write_bars(store.shape_bars(built), path)
    store.delete_series(spark, path, "click")
    store.delete_series(spark, path, "view", "1d")
    return store.read_bars(spark, path).select("ticker", "interval", "timestamp", "close", "period")


def one_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Crypto series built from ticks, then landed by the provider in capitals, then streamed, in one store."""
    path = scratch_path(spark, "bars")
    rows = inputs.event_ticks(spark, sf).withColumn("ticker", F.concat(F.lit("x:"), "ticker"))
    bar_building.build_bars(spark, rows, ["1h", "1d"], path)
    landed_rows = bars.bars_from_ticks(rows, "1h").withColumns({"ticker": F.upper("ticker"), "close": F.col("close") * 2})
    store.merge_bars(spark, landed_rows, path)
    source = scratch_path(spark, "ticks")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    incremental.stream_to_store(stream, "1d", path, scratch_path(spark, "checkpoint"), lateness="60 days").awaitTermination()
    return store.read_bars(spark, path).select("asset_type", "ticker", "interval", "timestamp", "open", "close", "volume")


def csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """A filtered series as one CSV file, read back."""
    path = scratch_path(spark, "csv")
    hourly = store.shape_bars(bars.bars_from_ticks(inputs.event_ticks(spark, sf), "1h"))
    store.write_bar_csv(query.select_series(hourly, "view", "1h", date(2024, 1, 5), date(2024, 1, 25)), path, single=True)
    found = store.read_bar_csv(spark, path)
    return found.select("ticker", "timestamp", "open", "close", "volume", F.regexp_count("_metadata.file_name", F.lit("part-00000")).cast("bigint").alias("in_first_file"))


def store_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    store.write_bar_csv(store.shape_bars(inputs.user_bars(spark, sf)), path)
    return store.read_bar_csv(spark, path).select("ticker", "interval", "timestamp", *BAR_VALUES)


def store_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "json")
    store.write_bar_json(store.shape_bars(inputs.user_bars(spark, sf)), path)
    return store.read_bar_json(spark, path).select("ticker", "interval", "timestamp", *BAR_VALUES)


def tick_lake(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "ticks")
    ticks.write_tick_lake(inputs.event_ticks(spark, sf), path)
    return calendar.rows_per_day(ticks.read_tick_lake(spark, path))


def day_files(spark: SparkSession, sf: str) -> DataFrame:
    """Events stored by day, then which weekdays have files."""
    path = scratch_path(spark, "ticks")
    ticks.write_tick_lake(inputs.event_ticks(spark, sf), path)
    report = ticks.day_file_report(storage.list_files(spark, path), None, FIRST, LAST)
    return report.select("date", "status", (F.col("files_downloaded") > 0).alias("has_files"), (F.col("total_size_mb") > 0).alias("has_bytes"))


def backfill_report(spark: SparkSession, sf: str) -> DataFrame:
    local, landed_rows = local_and_landed(spark, sf)
    path = scratch_path(spark, "bars")
    store.write_bars(store.shape_bars(local), path)
    return backfill.backfill(spark, inputs.provider_ranges(spark, sf), landed_rows, path)


def build_and_read(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bars")
    bar_building.build_bars(spark, inputs.event_ticks(spark, sf), ["1h", "12h"], path)
    stored = store.read_bars(spark, path)
    return query.select_series(stored, label="12h", start=FIRST, end=LAST).select("asset_type", "ticker", "timestamp", "open", "close", "volume")


def stream_hourly_bars(spark: SparkSession, sf: str) -> DataFrame:
    """Events read as a stream, built into hourly bars and merged into a store."""
    schema = inputs.table(spark, sf, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    rows = events.select(
        F.col("event_type").alias("ticker"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
    )
    path, progress_path = scratch_path(spark, "bars"), scratch_path(spark, "stream")
    incremental.stream_to_store(rows, "1h", path, progress_path, "40 days").awaitTermination()
    return store.read_bars(spark, path).select("ticker", "interval", "timestamp", "open", "high", "low", "close", "volume")


# Storage


def series_file_sizes(spark: SparkSession, sf: str) -> DataFrame:
    events = inputs.table(spark, sf, "events").select(F.col("user_id").cast("string").alias("ticker"), F.col("event_type").alias("interval"), "_metadata")
    sized = profile.file_sizes(events)
    return sized.select("ticker", "interval", "n_files", (F.col("file_bytes") > 0).alias("filled"))


def human_sizes(spark: SparkSession, sf: str) -> DataFrame:
    line = inputs.table(spark, sf, "lineitem")
    powers = {"1": 1.0, "2": 1e3, "3": 1e6, "4": 1e8, "5": 1e10, "6": 1e13, "7": 1e-2}
    scale = F.lit(1.0)
    for number, power in powers.items():
        scale = F.when(F.col("l_linenumber") == int(number), F.lit(power)).otherwise(scale)
    size = F.floor(F.col("l_extendedprice") * scale).cast("bigint")
    sized = line.select(size.alias("bytes"))
    return sized.groupBy(sizes.human_bytes(F.col("bytes")).alias("human")).agg(F.count(F.lit(1)).alias("rows"))


def ratios(spark: SparkSession, sf: str) -> DataFrame:
    line = inputs.table(spark, sf, "lineitem")
    small = F.when(F.col("l_tax") > 0, F.col("l_quantity")).otherwise(0.0)
    sums = line.groupBy("l_suppkey", "l_linenumber").agg(F.sum("l_extendedprice").alias("big"), F.sum(small).alias("small"))
    return sums.select(
        "l_suppkey",
        "l_linenumber",
        F.round(sizes.compression_ratio(F.col("big"), F.col("small")), 2).alias("ratio"),
        F.round(sizes.savings_pct(F.col("big"), F.col("small")), 2).alias("savings"),
    )


def registry() -> dict[str, Query]:
    out: dict[str, Query] = {f"ohlcv_{label}": partial(ohlcv, label) for label in FIXED_LABELS}
    out |= {f"ohlcv_{name}": partial(ohlc_orders, label) for label, name in CALENDAR_LABELS.items()}
    named = (
        day_file_bars, intraday_bars, user_hourly_bars, vwap_1d, rollup_1m_to_1h, rollup_1d_to_1q, rollup_vwap, rollup_vwap_holey,
        multi_interval_holey, multi_interval_bars, all_interval_counts, building_report, file_symbol_bars,
        upsert_keep_last, upsert_keep_first, duplicates_keep_last, append_keep_first, universe_append_count,
        hybrid_series, series_head_tail,
        high_water_mark, date_range_estimate, listed_ranges, timeframe_availability, timeframe_flags, timeframe_map,
        verify_per_ticker, verify_totals, plan_outcome, resume_points, resume_all_intervals, resume_rows,
        load_report, load_summary, newest_files, prefilter_skip, to_process, work_list, progress, series_ages,
        category_filter, category_limit, discovery_report, universe_filter, asset_types, market_types,
        batches, batch_report, universe_documents, universe_listing, universe_store, sorted_tickers, name_sample,
        series_query, series_columns, range_rows, series_header, series_summary, series_profile, overall_stats,
        store_stats, first_last_bars,
        weekday_spine, day_coverage, missing_days, available_dates, symbol_extract, symbol_list_extract,
        landed_bars, landed_rejects, reference_rows, market_rows, market_day_report, market_range_totals,
        store_upsert, store_delete, store_csv, store_json, tick_lake, day_files, backfill_report, build_and_read,
        stream_hourly_bars,
        series_file_sizes, series_limit, one_identity, csv_export,
        human_sizes, ratios,
    )
    out |= {f.__name__: f for f in named}
    out["freshness"] = fresh
    from checks import store_queries  # which reads queries of this module

    return out | store_queries.registry()
