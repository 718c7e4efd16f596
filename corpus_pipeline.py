"""Five stages that turn `documents` into training rows; each works on all that its predecessor kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import decontam, langid, line_chunks, simhash, spiece
from barloom.llm.common import STAGED, read_table, remove_staged, small_batches, staged
from barloom.llm.queries import PIECE_MODEL


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose language is recognised; those that language ID rejects go.

    Null texts, empty ones and texts without a letter are rejected. Rows are judged one by one, also where ids are null or
    repeat; without any labelled text the model knows no language and nothing that has a letter is rejected.
    """
    small_batches(spark)
    return langid.accepted_rows(docs, langid.train(docs, F.lit(True)))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the multi-line chunks that stand in an earlier place.

    Null texts stay null, rows without id stay as they are; every row stays. n_chars is counted anew.
    """
    small_batches(spark)
    found = line_chunks.drop_repeated_chunks(docs).withColumn("n_chars", F.char_length("text").cast("long"))
    return found.select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the smallest id's; null and empty texts are one group, equal rows too."""
    small_batches(spark)
    return simhash.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item, judged one by one; null, empty and very short texts hold none."""
    small_batches(spark)
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row; a null text has null ids, an empty one none. Repeated rows are answered each."""
    small_batches(spark)
    found = spiece.round_trip(docs, spiece.model_bytes(spark, PIECE_MODEL))
    return found.select("doc_id", "ids", "n_byte_ids", "parity", "restored")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("line_chunks", line_stage),
    ("near_copies", near_copy_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. What stages have staged on their way is removed once their result is written."""
    docs, before = read_table(spark, sf_dir, "documents"), len(STAGED)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
        remove_staged(spark, before, keep=1)
    return docs
