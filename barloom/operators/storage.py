"""Files on disk: listings, Parquet footers and compression reports."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.names import file_name, interval_in, stem_of, symbol_of
from barloom.functions.sizes import compression_ratio, human_bytes, megabytes, savings_pct

CHUNK_SCHEMA = (
    "path string, row_group int, column string, type string, compression string, encoding string, "
    "compressed_size bigint, uncompressed_size bigint, row_group_rows bigint, "
    "num_row_groups int, num_columns int, created_by string"
)


def list_files(spark: SparkSession, path: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """path, bytes and modification time of the files below a folder; contents are not read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", F.col("length").alias("bytes"), F.col("modificationTime").cast("timestamp_ntz").alias("modified"))
    )
    return found


def ticker_files(files: DataFrame) -> DataFrame:
    """Files named TICKER.interval.ext: ticker, interval, size and age per file."""
    return files.select(
        F.upper(symbol_of(F.col("path"))).alias("ticker"),
        interval_in(F.col("path")).alias("interval"),
        megabytes(F.col("bytes")).alias("size_mb"),
        "modified",
        "path",
    )


def column_chunks(files: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per column chunk; only footers are read, many files per task.

    The number of tasks is given outright: by their bytes the paths would all be
    put into one. The reader is a local function, so it travels by value and
    tasks do not need this package.
    """

    def read_footers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq
        from pyarrow import fs

        for batch in batches:
            rows = []
            for path in batch["path"]:
                uri = path if "://" in path else "file://" + path.removeprefix("file:")
                filesystem, inner = fs.FileSystem.from_uri(uri)
                with filesystem.open_input_file(inner) as handle:
                    footer = pq.ParquetFile(handle).metadata
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        rows.append(
                            (
                                path,
                                g,
                                chunk.path_in_schema,
                                chunk.physical_type,
                                chunk.compression,
                                ",".join(sorted(chunk.encodings)),
                                chunk.total_compressed_size,
                                chunk.total_uncompressed_size,
                                group.num_rows,
                                footer.num_row_groups,
                                footer.num_columns,
                                footer.created_by,
                            )
                        )
            yield pd.DataFrame(rows, columns=[part.split()[0] for part in CHUNK_SCHEMA.split(", ")])

    context = files.sparkSession.sparkContext
    paths = files.select("path").repartition(tasks or 2 * context.defaultParallelism, "path")
    return paths.mapInPandas(read_footers, CHUNK_SCHEMA)


def chunk_report(chunks: DataFrame) -> DataFrame:
    """Ratio and savings of every column chunk."""
    big, small = F.col("uncompressed_size"), F.col("compressed_size")
    return chunks.select(
        "path",
        "row_group",
        "column",
        "type",
        "compression",
        "encoding",
        "compressed_size",
        "uncompressed_size",
        F.round(compression_ratio(big, small), 2).alias("ratio"),
        F.round(savings_pct(big, small), 1).alias("savings_pct"),
    )


def file_report(chunks: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Totals per file: sizes, ratio, savings, rows, columns, row groups and writer."""
    group_rows = chunks.groupBy("path", "row_group").agg(
        F.max("row_group_rows").alias("_rows"),
        F.sum("compressed_size").alias("_small"),
        F.sum("uncompressed_size").alias("_big"),
        F.max("num_row_groups").alias("_groups"),
        F.max("num_columns").alias("_columns"),
        F.max("created_by").alias("_writer"),
    )
    total = group_rows.groupBy("path").agg(
        F.sum("_rows").alias("num_rows"),
        F.max("_columns").alias("num_columns"),
        F.max("_groups").alias("num_row_groups"),
        F.max("_writer").alias("created_by"),
        F.sum("_small").alias("total_compressed_size"),
        F.sum("_big").alias("total_uncompressed_size"),
    )
    small, big = F.col("total_compressed_size"), F.col("total_uncompressed_size")
    out = total.select(
        "*",
        human_bytes(small).alias("total_compressed_human"),
        human_bytes(big).alias("total_uncompressed_human"),
        F.round(compression_ratio(big, small), 2).alias("compression_ratio"),
        F.round(savings_pct(big, small), 2).alias("space_savings_pct"),
    )
    if files is not None:
        on_disk = files.select("path", F.col("bytes").alias("file_size_disk"))
        out = out.join(on_disk, "path", "left").withColumn(
            "file_size_disk_human", human_bytes(F.col("file_size_disk"))
        )
    return out.withColumn("file", file_name(F.col("path")))


def compare_intervals(report: DataFrame) -> DataFrame:
    """Per ticker the plain means of ratio and savings over its interval files."""
    named = report.withColumn("ticker", F.coalesce(symbol_of(F.col("path")), stem_of(F.col("path"))))
    return named.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("files"),
        F.round(F.avg("compression_ratio"), 2).alias("avg_ratio"),
        F.round(F.avg("space_savings_pct"), 1).alias("avg_savings_pct"),
        F.sum("num_rows").alias("rows"),
    )
