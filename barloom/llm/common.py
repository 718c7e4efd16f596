"""Staging, word hashing and connected components shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import scratch_path
from barloom.sources.folders import remove_path

# Text handled at once inside a task; a longer document is handled alone.
SLICE_BYTES = 1 << 20
# Bytes of a batch of rows on its way to a worker. JVM and worker hold a batch of every running task, and 10,000 long texts are 30 MB and more.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Folders that `staged` has written and nobody has removed.
STAGED: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written to the shared folder and read from there: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    STAGED.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_staged(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Remove the folders staged from the `since`-th on, but for the last `keep`; what was read from them is gone then."""
    end = max(since, len(STAGED) - keep)
    for path in STAGED[since:end]:
        remove_path(spark, path)
    del STAGED[since:end]


def small_batches(spark: SparkSession) -> None:
    """Rows go to Python workers in batches of at most BATCH_BYTES, not only of at most so many rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def two_columns(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only id and text, under names of our own, so that further columns cannot clash."""
    return df.select(df[id_col].alias("doc_id"), df[text_col].alias("text"))


def numbered(docs: DataFrame, names: list[str]) -> DataFrame:
    """These columns of `docs` named __0, __1, ..., so that columns put beside them cannot clash."""
    return docs.select(*[docs[c].alias(f"__{k}") for k, c in enumerate(names)])


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch, each of some `most` bytes of text or of one document."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // most
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    for start, stop in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
        yield batch.slice(int(start), int(stop - start))
    # Workers live on for other stages, so they give back what a batch has taken.
    pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after another, and n + 1 offsets; a null counts as empty."""
    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0] : offsets[-1]], offsets - offsets[0]


_rng = np.random.default_rng(20)
BYTE_VALUE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACE_VALUE = _rng.integers(1, 1 << 63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
IN_WORD = np.zeros(256, bool)
IN_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123), *range(128, 256)]] = True


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
    values = (values ^ (values >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words (letters, digits, underscore) and for each text where its words begin (n + 1)."""
    data, offsets = text_bytes(pa.compute.utf8_lower(column.cast(pa.large_string())))
    inside = IN_WORD[data]
    before = np.empty_like(inside)
    before[1:] = inside[:-1]
    if len(before):
        before[0] = False
    at = offsets[:-1]
    before[at[at < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    which = np.cumsum(inside & ~before) - 1
    place = np.arange(len(data)) - starts[np.maximum(which, 0)]
    term = BYTE_VALUE[data] * PLACE_VALUE[place & 4095]
    term[~inside] = 0
    return mixed(np.add.reduceat(term, starts)), np.searchsorted(starts, offsets)


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) of undirected links (u, v); component is the smallest node reachable.

    Alternating large-star and small-star steps: each links all larger (smaller) neighbours of a node to its smallest
    one. Every round is a minimum by node, combined before the shuffle, and a join whose two sides are plain exchanges,
    so AQE splits a node with very many links. Rounds grow with the logarithm of a component's size; each is staged.
    """
    links = staged(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    seen = None
    while True:
        both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        links = _towards_smallest(both, "v > u")
        links = _towards_smallest(links, "v <= u")
        state = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _towards_smallest(links: DataFrame, keep: str) -> DataFrame:
    """Link each neighbour that `keep` names, and for small stars the node itself, to the node's smallest neighbour."""
    least = staged(links.groupBy("u").agg(F.least("u", F.min("v")).alias("m")), "least")
    moved = links.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    if keep == "v <= u":
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    return staged(moved.where("u <> v").distinct(), "links")
