"""Folders of partitioned tables, through the file system Spark itself uses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    system, jpath = _file_system(spark, path)
    return system.exists(jpath)


def remove_path(spark: SparkSession, path: str) -> None:
    system, jpath = _file_system(spark, path)
    system.delete(jpath, True)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files under a path."""
    system, jpath = _file_system(spark, path)
    return system.getContentSummary(jpath).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    system, jpath = _file_system(spark, path)
    stream = system.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False when there is one of that name already."""
    system, jpath = _file_system(spark, path)
    try:
        stream = system.create(jpath, False)
    except Exception as error:
        if system.exists(jpath):
            return False
        raise error
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def names_like(spark: SparkSession, pattern: str) -> list[str]:
    """Last names of the paths that match a glob, sorted."""
    system, jpath = _file_system(spark, pattern)
    return sorted(status.getPath().getName() for status in system.globStatus(jpath) or [])


def partition_folders(spark: SparkSession, path: str, columns: Sequence[str]) -> list[tuple[str, ...]]:
    """Values of the partition columns that have a folder; one entry per partition, no rows are read."""
    system, pattern = _file_system(spark, "/".join([path, *[f"{c}=*" for c in columns]]))
    found = []
    for status in system.globStatus(pattern) or []:
        parts = status.getPath().toString().split("/")[-len(columns) :]
        found.append(tuple(part.split("=", 1)[1] for part in parts))
    return found
