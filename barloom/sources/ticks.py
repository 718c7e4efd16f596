"""Tick files of a day and the date-partitioned tick lake."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.names import file_name, symbol_of
from barloom.operators.calendar import day_coverage, day_spine
from barloom.schemas import TICKS
from barloom.sources.folders import names_like, partition_folders, path_exists

REQUIRED = ("timestamp", "price")


def days_glob(root: str, data_type: str, days: Iterable[date]) -> str:
    """One glob over day folders; days without a folder simply match nothing."""
    return f"{root}/{data_type}/{{{','.join(d.isoformat() for d in days)}}}"


def date_range(start: date, end: date, weekdays: bool) -> list[date]:
    days = [start + timedelta(days=i) for i in range((end - start).days + 1)]
    return [d for d in days if d.weekday() < 5] if weekdays else days


def read_tick_files(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: dict[str, str] | None = None,
) -> DataFrame:
    """Ticks from files named after their symbol: ticker, timestamp, price and, if known, size and seq.

    `columns` maps our names to SQL expressions over the files' columns, which are
    those of all files together. No path gives an empty table. A file
    that lacks the time or the price yields null there, and no bar comes of a
    null time or price, which is how such a file is skipped. Nanosecond times,
    as pandas writes them, are cut to micros; the session flag that lets Spark
    read them is set.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    paths = [path] if isinstance(path, str) else list(path)
    if not paths:
        return spark.createDataFrame([], TICKS)
    raw = spark.read.option("mergeSchema", "true").parquet(*paths)
    mapping = columns or {c: c for c in (*REQUIRED, "size", "seq") if c in raw.columns}
    mapping = {c: "CAST(NULL AS STRING)" for c in REQUIRED} | mapping
    ts = F.expr(mapping["timestamp"])
    if isinstance(raw.select(ts).schema[0].dataType, T.LongType):
        ts = F.expr(f"timestamp_micros({mapping['timestamp']} div 1000)")
    casts = {"price": "double", "size": "bigint", "seq": "bigint"}
    rest = [F.expr(mapping[c]).cast(t).alias(c) for c, t in casts.items() if c in mapping]
    return raw.select(
        F.replace(F.col("_metadata.file_name"), F.lit(".parquet"), F.lit("")).alias("ticker"), ts.cast("timestamp_ntz").alias("timestamp"), *rest
    )


NANOS = "spark.sql.legacy.parquet.nanosAsLong"
# What a column is declared as where the files looked at lack it.
DECLARED = {"timestamp": T.TimestampNTZType(), "price": T.DoubleType(), "size": T.LongType(), "seq": T.LongType()}


def file_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of one file. Only where it holds nanosecond times the session flag that lets Spark read them is set."""
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as error:
        if "NANOS" not in str(error):
            raise
    spark.conf.set(NANOS, "true")
    return spark.read.parquet(path).schema


def folder_class(spark: SparkSession, folder: str) -> T.StructType | None:
    """Our columns with the types that a folder's files have, None for an empty folder.

    The first file tells; others are looked at only while time or price is lacking. A column that none of these has is
    declared all the same, since other files of the folder may have it.
    """
    known: dict[str, T.DataType] = {}
    names = names_like(spark, f"{folder}/*.parquet")
    for name in names:
        found = {f.name: f.dataType for f in file_schema(spark, f"{folder}/{name}").fields if f.name in DECLARED}
        known = {**found, **known}
        if set(REQUIRED) <= set(known):
            break
    return T.StructType([T.StructField(c, known.get(c, t)) for c, t in DECLARED.items()]) if names else None


def read_tick_folders(spark: SparkSession, folders: Sequence[str]) -> DataFrame:
    """Ticks of day folders whose files are named after their symbol, by classes of folders with the same column types.

    One scan with a declared schema for each class, united by name: footers are read of a file or two of a folder to plan,
    not of all files. Columns that a file lacks are null there, so a file without time or price gives no bars. Files of one
    folder may differ in their columns; where they differ in a type too, Spark widens numbers and refuses the rest.
    """
    classes: dict[str, tuple[T.StructType, list[str]]] = {}
    for folder in folders:
        found = folder_class(spark, folder)
        if found is not None:
            classes.setdefault(found.json(), (found, []))[1].append(folder)
    parts = [_class_ticks(spark, schema, paths) for schema, paths in classes.values()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], TICKS)


def _class_ticks(spark: SparkSession, schema: T.StructType, folders: Sequence[str]) -> DataFrame:
    raw = spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(*folders)
    ts = F.col("timestamp")
    if isinstance(schema["timestamp"].dataType, T.LongType):
        ts = F.expr("timestamp_micros(timestamp div 1000)")
    symbol = F.regexp_extract("_metadata.file_path", r"/([^/]+)\.parquet(?:/|$)", 1)  # a file, or a folder that Spark wrote
    rest = [F.col(f.name).cast(f.dataType).alias(f.name) for f in TICKS.fields if f.name not in ("ticker", "timestamp")]
    return raw.select(symbol.alias("ticker"), ts.cast("timestamp_ntz").alias("timestamp"), *rest)


def read_tick_days(
    spark: SparkSession, root: str, start: date, end: date, data_type: str = "trades", weekdays: bool = True
) -> DataFrame:
    """Ticks of the day folders of a range, weekdays only unless told otherwise; days without a folder have none."""
    folders = [f"{root}/{data_type}/{d.isoformat()}" for d in date_range(start, end, weekdays)]
    return read_tick_folders(spark, [f for f in folders if path_exists(spark, f)])


def day_file_report(files: DataFrame, symbols: Sequence[str] | None, start: date, end: date) -> DataFrame:
    """Per weekday of a range: status, number of files and their megabytes.

    `files` lists day files (path, bytes). A file name without a dot has no
    symbol and passes any symbol filter.
    """
    day = F.regexp_extract("path", r"/(?:date=)?(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    listed = files.withColumn("date", F.to_date(F.nullif(day, F.lit(""))))
    any_file = listed.groupBy("date").agg(F.count(F.lit(1)).alias("_listed"))
    kept = listed
    if symbols:
        symbol = symbol_of(file_name(F.col("path")))
        kept = listed.where(symbol.isNull() | symbol.isin(list(symbols)))
    sums = kept.groupBy("date").agg(
        F.count(F.lit(1)).alias("files_downloaded"), (F.sum("bytes") / F.lit(1024.0 * 1024.0)).alias("total_size_mb")
    )
    bounds = files.sparkSession.range(1).select(F.lit(start).alias("start_date"), F.lit(end).alias("end_date"))
    covered = day_coverage(day_spine(bounds), any_file, "_listed").drop("_listed")
    return covered.join(sums, "date", "left").select(
        "date",
        "status",
        F.coalesce("files_downloaded", F.lit(0)).alias("files_downloaded"),
        F.coalesce("total_size_mb", F.lit(0.0)).alias("total_size_mb"),
    )


def with_date(ticks: DataFrame) -> DataFrame:
    return ticks.withColumn("date", F.col("timestamp").cast("date"))


def write_tick_lake(ticks: DataFrame, path: str) -> None:
    """Store ticks partitioned by date, files of even size, sorted by ticker and time."""
    (
        with_date(ticks)
        .hint("rebalance", F.col("date"))
        .sortWithinPartitions("date", "ticker", "timestamp")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def lake_dates(spark: SparkSession, path: str, year: int | None = None) -> DataFrame:
    """Dates of a tick lake from its folder names alone, sorted."""
    found = [(date.fromisoformat(day),) for (day,) in partition_folders(spark, path, ("date",))]
    kept = sorted(d for d in found if year is None or d[0].year == year)
    return spark.createDataFrame(kept, "date date")


def read_tick_lake(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*TICKS.fields, T.StructField("date", T.DateType())])
    return spark.read.schema(schema).parquet(path)
