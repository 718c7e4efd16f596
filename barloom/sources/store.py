"""The bar store: sorted runs of bars by ticker bucket, interval and period, put in force by a small pointer.

`{path}/bars/run=N/bucket=B/interval=I/period=P/` holds what one write added, `{path}/series/run=N/bucket=B/` what that
changed of the series' states, and `{path}/_pointer/V.json` says which runs count. A write never touches files that
count: a crash before the switch leaves the store as it was, a reader goes on with the runs it found.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions import classify
from barloom.functions.classify import normal_ticker
from barloom.functions.intervals import interval_of
from barloom.functions.names import interval_in, symbol_of
from barloom.operators.spread import deal_by_key, lookup_join
from barloom.operators.upsert import MOST_TYPE_BYTES, keep_one
from barloom.schemas import BAR_KEY, BARS, SERIES, SERIES_KEY, STORED_BARS, bucket_name, bucket_of, period_of
from barloom.session import ensure_checkpoint_dir
from barloom.sources import pointer as pointers
from barloom.sources.folders import names_like, partition_folders, path_bytes, path_exists, remove_path
from barloom.sources.pointer import Pointer

PARTITIONS = ("bucket", "interval", "period")
BARS_FOLDER, SERIES_FOLDER = "bars", "series"
RUN_BARS = T.StructType([*STORED_BARS.fields, T.StructField("run", T.IntegerType())])
RUN_SERIES = T.StructType([*SERIES.fields, T.StructField("bucket", T.StringType()), T.StructField("run", T.IntegerType())])
# State runs of a bucket that are added up at reading, at most.
STATE_RUNS = 8
# Runs are joined, and new bars compared with stored ones, some buckets at a time: what one pass shuffles is on disk beside
# both the old and the new runs. A pass has a part of the bytes of all runs in question, but so many at least.
PASS_PART = 8
PASS_BYTES = 256 << 20
# A reader of one series skips row groups by the range of tickers, and by a filter where the range says nothing.
SKIPPING = {
    "parquet.block.size": str(32 << 20),
    "parquet.bloom.filter.enabled#ticker": "true",
    "parquet.bloom.filter.expected.ndv#ticker": "20000",
}
# Text formats would otherwise cut times to milliseconds.
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def shape_bars(bars: DataFrame, asset_type: str | None = None, ingest_seq: int = 0) -> DataFrame:
    """All columns of the store in order; columns a bar lacks are filled in.

    The one place where all writers get their identity: tickers are upper-cased, and bars without an asset type are
    classified by their symbol.
    """
    bars = bars.withColumn("ticker", normal_ticker(F.col("ticker")))
    by_symbol = classify.asset_type(F.col("ticker"))
    kind = F.lit(asset_type) if asset_type else by_symbol
    if "asset_type" in bars.columns:
        given = F.col("asset_type")
        long = F.raise_error(F.concat(F.lit("asset type too long: "), given)).cast("string")
        bars = bars.withColumn("asset_type", F.when(F.octet_length(given) > MOST_TYPE_BYTES, long).otherwise(F.coalesce(given, kind)))
    defaults = {"asset_type": kind, "ingest_seq": F.lit(ingest_seq)}
    columns = [
        (F.col(f.name) if f.name in bars.columns else defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name)
        for f in BARS.fields
    ]
    return bars.select(*columns)


def _write_run(path: str, bars: DataFrame, number: int, buckets: int, clustered: bool = False, mode: str = "error") -> None:
    """Write shaped bars as a run: even files for each partition, sorted by ticker and time.

    AQE splits a large partition and joins small ones. `clustered` deals rows by ranges of the ticker instead, so that
    each file of a large partition holds few tickers. With the mode `append` they are added to the run.
    """
    placed = bars.withColumns({"bucket": bucket_of(F.col("ticker"), buckets), "period": period_of(F.col("interval"), F.col("timestamp"))})
    order = [*PARTITIONS, "ticker", "timestamp"]
    dealt = placed.repartitionByRange(*order) if clustered else placed.hint("rebalance", *[F.col(p) for p in PARTITIONS])
    _run_writer(dealt.sortWithinPartitions(*order)).mode(mode).parquet(f"{path}/{BARS_FOLDER}/run={number}")


def _run_writer(ordered: DataFrame) -> DataFrameWriter:
    return ordered.write.option("compression", "zstd").options(**SKIPPING).partitionBy(*PARTITIONS)


def _next_run(spark: SparkSession, path: str) -> int:
    """A number above that of every run there, also of those that never came into force."""
    found = [names_like(spark, f"{path}/{folder}/run=*") for folder in (BARS_FOLDER, SERIES_FOLDER)]
    return max([0, *[int(name.split("=")[1]) for names in found for name in names]]) + 1


def _run_sizes(spark: SparkSession, path: str, number: int) -> dict[str, int]:
    """Bytes of each bucket of a run."""
    folder = f"{path}/{BARS_FOLDER}/run={number}"
    return {b: path_bytes(spark, f"{folder}/bucket={b}") for (b,) in partition_folders(spark, folder, ("bucket",))}


def _passes(sizes: Mapping[str, int]) -> list[list[str]]:
    """Buckets, given their bytes, by the passes that work on them."""
    most = max(PASS_BYTES, sum(sizes.values()) // PASS_PART)
    passes, room = [], 0
    for bucket, size in sorted(sizes.items()):
        if size > room:
            passes.append([])
            room = most
        passes[-1].append(bucket)
        room -= size
    return passes


def _scan(spark: SparkSession, path: str, folder: str, schema: T.StructType, runs: Mapping[str, Collection[int]]) -> DataFrame:
    root = f"{path}/{folder}"
    paths = [f"{root}/run={run}/bucket={bucket}" for bucket, found in sorted(runs.items()) for run in sorted(found)]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def _rows(spark: SparkSession, path: str, runs: Mapping[str, Sequence[int]]) -> DataFrame:
    """Bars of these runs, the newest run's bar for each key. Buckets of one run need no look at other rows."""
    single = {b: found for b, found in runs.items() if len(found) == 1}
    several = {b: found for b, found in runs.items() if len(found) > 1}
    parts = []
    if single or not several:
        parts.append(_scan(spark, path, BARS_FOLDER, RUN_BARS, single).select(*STORED_BARS.names))
    if several:
        merged = keep_one(_scan(spark, path, BARS_FOLDER, RUN_BARS, several), [*BAR_KEY, "bucket", "period"], "run")
        parts.append(merged.select(*STORED_BARS.names))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_bars(spark: SparkSession, path: str, ticker: str | None = None) -> DataFrame:
    """The stored bars as of now; an absent store is an empty table.

    The pointer is read once, so later writes do not show. With `ticker` only its bucket's folders are listed.
    """
    state = pointers.current(spark, path)
    return _rows(spark, path, state.bar_runs(None if ticker is None else [bucket_name(ticker, state.buckets)]))


def run_bars(spark: SparkSession, path: str, number: int) -> DataFrame:
    """Bars of one run, whether in force or not."""
    return _scan(spark, path, BARS_FOLDER, RUN_BARS, {b: [number] for b in _run_sizes(spark, path, number)}).drop("run")


def in_partitions(found: Sequence[tuple]) -> Column:
    """Predicate on partition columns only, so untouched folders are not read."""
    kept = F.lit(False)
    for interval in sorted({label for _, label, _ in found}):
        for period in sorted({p for _, label, p in found if label == interval}):
            buckets = sorted({b for b, label, p in found if (label, p) == (interval, period)})
            kept = kept | ((F.col("interval") == interval) & (F.col("period") == period) & F.col("bucket").isin(buckets))
    return kept


def add_run(
    spark: SparkSession, new: DataFrame, path: str, seq: str | None = None, buckets: int | None = None, rows: int | None = None
) -> int:
    """Write new bars as a run that is not yet in force, and give its number.

    They are built once, their partitions are known from the folder names, and a lost executor re-reads files instead of
    recomputing them. `seq` decides between duplicates among the new bars; without it they must hold each key once.
    With `rows`, a bound on the number of new bars with few copies of a key, duplicates are looked for in tasks of a bounded
    number of rows.
    """
    shaped = shape_bars(new)
    if seq is not None and rows is not None:
        shaped = deal_by_key(shaped, ["ticker", "timestamp"], rows)
    number = _next_run(spark, path)
    buckets = buckets or pointers.current(spark, path).buckets
    _write_run(path, keep_one(shaped, BAR_KEY, seq) if seq is not None else shaped, number, buckets)
    return number


def commit_run(spark: SparkSession, path: str, number: int) -> Pointer:
    """Upsert a written run: its bars replace stored ones of the same key.

    What is written beside the run grows with the run: the change of its series' states, and now and then runs of a like
    size joined into one. Then the pointer is switched.
    """
    before = pointers.current(spark, path)
    sizes = _run_sizes(spark, path, number)
    if not sizes:
        return before
    _write_states(path, _changed_states(spark, path, before, number, sizes), number, before.buckets)
    after = before
    for bucket, size in sizes.items():
        after = after.with_bucket(
            bucket, [*before.bars.get(bucket, ()), (number, size)], [*before.series.get(bucket, ()), number]
        )
    after = _joined(spark, path, after, {b: pointers.runs_to_join([s for _, s in after.bars[b]]) for b in sizes})
    return pointers.switch(spark, path, after)


def merge_bars(spark: SparkSession, new: DataFrame, path: str, seq: str | None = None) -> None:
    """Upsert bars. Without `seq` the new bars must hold each key once."""
    commit_run(spark, path, add_run(spark, new, path, seq))


def merge_newest(spark: SparkSession, new: DataFrame, path: str) -> None:
    """Upsert bars by their `ingest_seq`, whatever order they come in: a stored bar with the same or a higher number stays.

    The run of new bars is written first; of the stored bars only the partitions it touches are read, and what is newer
    becomes the run that counts; the first run is gone before it is joined with others. When nothing is newer the store
    stays as it is.
    """
    staged = add_run(spark, new, path, "ingest_seq")
    folder = f"{path}/{BARS_FOLDER}/run={staged}"
    touched = partition_folders(spark, folder, PARTITIONS)
    number, state = _next_run(spark, path), pointers.current(spark, path)
    sizes = {b: size + sum(held for _, held in state.bars.get(b, ())) for b, size in _run_sizes(spark, path, staged).items()}
    for k, buckets in enumerate(_passes(sizes)):
        fresh = _scan(spark, path, BARS_FOLDER, RUN_BARS, {b: [staged] for b in buckets}).drop("run")
        stored = _rows(spark, path, state.bar_runs(buckets)).where(in_partitions([t for t in touched if t[0] in buckets]))
        known = stored.select(*BAR_KEY, F.col("ingest_seq").alias("_stored_seq"))
        joined = fresh.join(known, list(BAR_KEY), "left")
        newer = joined.where(F.col("_stored_seq").isNull() | (F.col("ingest_seq") > F.col("_stored_seq"))).select(*BARS.names)
        _write_run(path, newer, number, state.buckets, mode="append" if k else "error")
    remove_path(spark, folder)
    if touched:
        commit_run(spark, path, number)


def write_bars(bars: DataFrame, path: str, buckets: int | None = None) -> None:
    """Make these bars all that the store holds, in so many buckets; each key must be there once."""
    spark = bars.sparkSession
    before = pointers.current(spark, path)
    buckets = buckets or before.buckets
    number = add_run(spark, bars, path, buckets=buckets)
    sizes = _run_sizes(spark, path, number)
    _write_states(path, _changed_states(spark, path, Pointer(), number, sizes), number, buckets)
    after = Pointer(before.version, {b: ((number, size),) for b, size in sizes.items()}, {b: (number,) for b in sizes}, buckets)
    pointers.switch(spark, path, after)


def _joined(spark: SparkSession, path: str, state: Pointer, newest: Mapping[str, int]) -> Pointer:
    """The newest runs of buckets, so many of each as `newest` says, made one; long lists of state runs added up."""
    joins = {b: k for b, k in newest.items() if k > 1}
    long = [b for b, runs in state.series.items() if len(runs) > STATE_RUNS]
    number = _next_run(spark, path)
    if joins:
        newest_runs = {b: state.bars[b][-k:] for b, k in joins.items()}
        for k, buckets in enumerate(_passes({b: sum(size for _, size in runs) for b, runs in newest_runs.items()})):
            _write_joined(spark, path, {b: [run for run, _ in newest_runs[b]] for b in buckets}, number, "append" if k else "error")
        for bucket, size in _run_sizes(spark, path, number).items():
            state = state.with_bucket(bucket, [*state.bars[bucket][: -joins[bucket]], (number, size)], state.series[bucket])
    if long:
        _write_states(path, _states(spark, path, state, long), number, state.buckets)
        for bucket in long:
            state = state.with_bucket(bucket, state.bars[bucket], [number])
    return state


def _write_joined(spark: SparkSession, path: str, runs: Mapping[str, Sequence[int]], number: int, mode: str) -> None:
    """Write the bars of these runs, the newest run's bar for each key, as a run or a further part of one.

    One exchange by ranges serves the merge and the order of the files; a key has a row in each run at most. The sort of
    the files also puts a key's newest bar first, so no rows are held for the merge.
    """
    order = [*PARTITIONS, "ticker", "timestamp"]
    dealt = _scan(spark, path, BARS_FOLDER, RUN_BARS, runs).repartitionByRange(*order)
    rank = F.row_number().over(W.partitionBy(*order).orderBy(F.col("run").desc()))
    newest = dealt.withColumn("_rank", rank).where(F.col("_rank") == 1).select(*STORED_BARS.names)
    _run_writer(newest.sortWithinPartitions(*order)).mode(mode).parquet(f"{path}/{BARS_FOLDER}/run={number}")


def compact(spark: SparkSession, path: str) -> None:
    """Make one run of all runs of every bucket that has several."""
    before = pointers.current(spark, path)
    after = _joined(spark, path, before, {b: len(runs) for b, runs in before.bars.items() if len(runs) > 1})
    if after != before:
        pointers.switch(spark, path, after)


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Remove runs that none of the last `keep` versions names; readers of older versions lose their files."""
    kept = pointers.recent(spark, path, keep)
    if not kept:
        return
    for folder, live in (
        (BARS_FOLDER, {(run, b) for p in kept for b, runs in p.bar_runs().items() for run in runs}),
        (SERIES_FOLDER, {(run, b) for p in kept for b, runs in p.series.items() for run in runs}),
    ):
        for run in names_like(spark, f"{path}/{folder}/run=*"):
            number = int(run.split("=")[1])
            if not any(n == number for n, _ in live):
                remove_path(spark, f"{path}/{folder}/{run}")
                continue
            for (bucket,) in partition_folders(spark, f"{path}/{folder}/{run}", ("bucket",)):
                if (number, bucket) not in live:
                    remove_path(spark, f"{path}/{folder}/{run}/bucket={bucket}")
    pointers.forget_before(spark, path, kept[-1].version)


# The states of series


def read_series(spark: SparkSession, path: str, ticker: str | None = None) -> DataFrame:
    """Row per stored series: asset_type, records, first_timestamp, last_timestamp; no bars are read."""
    state = pointers.current(spark, path)
    buckets = list(state.series) if ticker is None else [bucket_name(ticker, state.buckets)]
    return _states(spark, path, state, buckets)


def _states(spark: SparkSession, path: str, state: Pointer, buckets: Collection[str]) -> DataFrame:
    runs = {b: state.series[b] for b in buckets if b in state.series}
    added = _scan(spark, path, SERIES_FOLDER, RUN_SERIES, runs).groupBy(*SERIES_KEY).agg(
        F.max_by("asset_type", "run").alias("asset_type"),
        F.sum("records").alias("records"),
        F.min("first_timestamp").alias("first_timestamp"),
        F.max("last_timestamp").alias("last_timestamp"),
    )
    return added.select(*SERIES.names)


def _write_states(path: str, states: DataFrame, number: int, buckets: int) -> None:
    placed = states.withColumn("bucket", bucket_of(F.col("ticker"), buckets)).hint("rebalance", F.col("bucket"))
    placed.write.partitionBy("bucket").parquet(f"{path}/{SERIES_FOLDER}/run={number}")


def _changed_states(spark: SparkSession, path: str, before: Pointer, number: int, buckets: Collection[str]) -> DataFrame:
    """What a run adds to its series: bars less those it replaces, its first and last time, its asset type.

    Only bars inside the stored span of their series can replace one, and only keys of their partitions are read.
    """
    new = _scan(spark, path, BARS_FOLDER, RUN_BARS, {b: [number] for b in buckets})
    per_series = new.groupBy(*SERIES_KEY).agg(
        F.max_by("asset_type", "timestamp").alias("asset_type"),
        F.count(F.lit(1)).alias("_bars"),
        F.min("timestamp").alias("first_timestamp"),
        F.max("timestamp").alias("last_timestamp"),
    )
    replaced = None
    if any(b in before.bars for b in buckets):
        known = _states(spark, path, before, buckets).select(*SERIES_KEY, "first_timestamp", "last_timestamp")
        keys = new.select(*BAR_KEY, "bucket", "period")
        inside = lookup_join(keys, known, list(SERIES_KEY), "inner")
        inside = inside.where(F.col("timestamp").between(F.col("first_timestamp"), F.col("last_timestamp")))
        touched = [tuple(r) for r in inside.select(*PARTITIONS).distinct().collect()]
        if touched:
            stored = _scan(spark, path, BARS_FOLDER, RUN_BARS, before.bar_runs(buckets)).where(in_partitions(touched))
            both = inside.select(*BAR_KEY).join(stored.select(*BAR_KEY), list(BAR_KEY), "left_semi")
            replaced = both.groupBy(*SERIES_KEY).agg(F.count(F.lit(1)).alias("_replaced"))
    if replaced is None:
        changed = per_series.withColumn("records", F.col("_bars"))
    else:
        joined = per_series.join(replaced, list(SERIES_KEY), "left")
        changed = joined.withColumn("records", F.col("_bars") - F.coalesce("_replaced", F.lit(0)))
    return changed.select(*SERIES.names)


def delete_series(spark: SparkSession, path: str, ticker: str, interval: str | None = None) -> int:
    """Remove a series, or all series of a ticker; returns the bars removed.

    The bucket of the ticker is rewritten without it, no other folder is read or written.
    """
    before = pointers.current(spark, path)
    bucket = bucket_name(ticker, before.buckets)
    doomed = F.col("ticker") == ticker.upper()
    if interval is not None:
        doomed = doomed & (F.col("interval") == interval_of(interval).label)
    states = _states(spark, path, before, [bucket])
    removed = states.where(doomed).agg(F.sum("records")).first()[0]
    if not removed:
        raise LookupError(f"no stored bars for {ticker.upper()} {interval or ''}".rstrip())
    number = _next_run(spark, path)
    rest = _rows(spark, path, before.bar_runs([bucket])).where(~doomed).select(*BARS.names)
    _write_run(path, rest, number, before.buckets, clustered=True)
    sizes = _run_sizes(spark, path, number)
    if sizes:
        _write_states(path, states.where(~doomed), number, before.buckets)
    pointers.switch(spark, path, before.with_bucket(bucket, [(number, size) for size in sizes.values()], [number]))
    return removed


def delete_universe(spark: SparkSession, path: str, category: str) -> None:
    """Remove the documents of one category."""
    folder = f"{path}/universe={category}"
    if not path_exists(spark, folder):
        raise LookupError(f"no universe {category}")
    remove_path(spark, folder)


def write_bar_csv(bars: DataFrame, path: str, single: bool = False) -> None:
    """CSV with header. `single` makes one file of an export of bounded size, in time order.

    The rows are fixed first, so that only the writing of the file, and not the plan above it, is one task.
    """
    out = bars
    if single:
        ensure_checkpoint_dir(bars.sparkSession)
        out = bars.checkpoint().coalesce(1).sortWithinPartitions("ticker", "interval", "timestamp")
    out.write.mode("overwrite").option("header", "true").option("timestampNTZFormat", TIME_FORMAT).csv(path)


def write_bar_json(bars: DataFrame, path: str) -> None:
    out = bars.write.mode("overwrite").option("ignoreNullFields", "false")
    out.option("timestampNTZFormat", TIME_FORMAT).json(path)


def read_bar_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BARS).option("header", "true").option("enforceSchema", "false").csv(path)


def read_bar_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BARS).json(path)


def read_bar_files(spark: SparkSession, root: str, skip_unreadable: bool = True) -> DataFrame:
    """Bars from files laid out as {asset_type}/{TICKER}/{TICKER}.{interval}.parquet.

    Identity comes from the path, columns a file lacks are null, nanosecond
    times are cut to micros. Unreadable files are passed over on request.
    Hadoop paths cannot hold a colon, so a file named after an `X:` ticker has
    to be renamed before it can be read.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    files = (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", "true")
        .option("ignoreCorruptFiles", str(skip_unreadable).lower())
        .parquet(root)
    )
    ts = F.col("timestamp")
    if files.schema["timestamp"].dataType.typeName() == "long":
        ts = F.expr("timestamp_micros(timestamp div 1000)")
    path = F.col("_metadata.file_path")
    values = [f for f in BARS.fields if f.name not in ("asset_type", "ticker", "interval", "timestamp", "ingest_seq")]
    named = files.select(
        F.element_at(F.split(path, "/"), -3).alias("asset_type"),
        F.upper(symbol_of(path)).alias("ticker"),
        interval_in(path).alias("interval"),
        ts.cast("timestamp_ntz").alias("timestamp"),
        *[
            (F.col(f.name) if f.name in files.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in values
        ],
    )
    return shape_bars(named)
