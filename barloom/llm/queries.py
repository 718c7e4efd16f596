"""One query for each operator, over its whole tables with production parameters, and the SQL where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (
    cotrain,
    decontam,
    iblt,
    langid,
    line_chunks,
    nnpu,
    simhash,
    spiece,
    suffixes,
    surrogates,
    templates,
    variants,
    whitening,
)
from barloom.llm.common import read_table

# The key of the registered query, unless another is given; jobs of one's own name theirs.
SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "key of the test tables")
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    found = spiece.round_trip(read_table(spark, sf, "documents"), spiece.model_bytes(spark, PIECE_MODEL))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.xxhash64("ids").alias("ids_xxhash64"),
        F.col("n_byte_ids").cast("long").alias("n_byte_ids"),
        "parity",
        "restored",
    )


def op2_surrogates(spark: SparkSession, sf: str) -> DataFrame:
    found = surrogates.replace_entities(read_table(spark, sf, "documents"), SURROGATE_KEY)
    return found.select(
        "doc_id", F.col("n_entities").cast("long").alias("n_entities"), F.sha2("text", 256).alias("text_sha256")
    )


def op3_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    found = line_chunks.drop_repeated_chunks(read_table(spark, sf, "documents"))
    return found.select(
        "doc_id",
        F.col("removed_chunks").cast("long").alias("removed_chunks"),
        F.col("removed_lines").cast("long").alias("removed_lines"),
        F.md5("text").alias("kept_md5"),
    )


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontam.contaminations(read_table(spark, sf, "documents"), read_table(spark, sf, "benchmark"))


def remainder(parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null for a null id, which is thus never held out."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    held_out = remainder(4).eqNullSafe(2)
    model = langid.train(docs, ~held_out)
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "accepted")


def op6_repeats(spark: SparkSession, sf: str) -> DataFrame:
    found = suffixes.drop_repeats(read_table(spark, sf, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return iblt.fingerprints(read_table(spark, sf, "documents"))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    held_out = remainder(3).eqNullSafe(1)
    model = nnpu.train(docs, read_table(spark, sf, "labels"), ~held_out)
    return nnpu.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = read_table(spark, sf, "documents")
    held_out = remainder(5).eqNullSafe(3)
    model = cotrain.train(docs, read_table(spark, sf, "labels"), ~held_out)
    return cotrain.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op10_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf, "documents"))


def op11_extraction(spark: SparkSession, sf: str) -> DataFrame:
    found = templates.extract(read_table(spark, sf, "pages"))
    return found.withColumn("n_chars", F.char_length("text").cast("long"))


def op12_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf, "embeddings"))


def op13_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.spelling_variants(read_table(spark, sf, "documents"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sentencepiece": op1_sentencepiece,
        "op2_surrogates": op2_surrogates,
        "op3_line_chunks": op3_line_chunks,
        "op4_decontamination": op4_decontamination,
        "op5_language": op5_language,
        "op6_repeats": op6_repeats,
        "op7_fingerprints": op7_fingerprints,
        "op8_toxicity": op8_toxicity,
        "op9_quality": op9_quality,
        "op10_simhash": op10_simhash,
        "op11_extraction": op11_extraction,
        "op12_whitening": op12_whitening,
        "op13_variants": op13_variants,
    }


def statements() -> dict[str, str]:
    return {"op3_line_chunks": LINE_CHUNKS}


LINE_CHUNKS = """
WITH lines AS (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i
    FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL
), hashed AS (
    SELECT *, ('0x' || substr(md5(line), 1, 8))::HUGEINT AS v FROM lines
), marked AS (
    SELECT *, ((v + 31 * coalesce(lag(v) OVER (PARTITION BY doc_id ORDER BY i), 0)) * 2654435761) % 4294967296 < 4026531840 AS ends
    FROM hashed
), numbered AS (
    SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
    FROM marked
), chunks AS (
    SELECT doc_id, chunk, min(i) AS start, max(i) AS stop, list(line ORDER BY i) AS body FROM numbered GROUP BY doc_id, chunk
), copies AS (
    SELECT *, count(*) OVER (PARTITION BY body) > 1 AS repeated, row_number() OVER (PARTITION BY body ORDER BY doc_id, chunk) AS copy FROM chunks
), sides AS (
    SELECT *, CASE WHEN lag(repeated) OVER w THEN [] ELSE coalesce(list_reverse(lag(body) OVER w), []) END AS before,
        CASE WHEN lead(repeated) OVER w THEN [] ELSE coalesce(lead(body) OVER w, []) END AS after
    FROM copies WINDOW w AS (PARTITION BY doc_id ORDER BY chunk)
), pairs AS (
    SELECT c.*, f.before AS first_before, f.after AS first_after FROM sides c JOIN sides f ON c.body = f.body AND f.copy = 1 WHERE c.copy > 1
), widened AS (
    SELECT doc_id,
        start - coalesce(list_position([before[k] = first_before[k] FOR k IN range(1, least(len(before), len(first_before)) + 1)], false) - 1,
            least(len(before), len(first_before))) AS low,
        stop + coalesce(list_position([after[k] = first_after[k] FOR k IN range(1, least(len(after), len(first_after)) + 1)], false) - 1,
            least(len(after), len(first_after))) AS high
    FROM pairs
), covered AS (
    SELECT DISTINCT doc_id, unnest(range(low, high + 1)) AS i FROM widened
), runs AS (
    SELECT *, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM covered
), gone AS (
    SELECT doc_id, i, run FROM (
        SELECT r.*, count(*) FILTER (trim(line, ' ' || chr(9) || chr(13)) <> '') OVER (PARTITION BY r.doc_id, run) AS filled
        FROM runs r JOIN lines l ON l.doc_id = r.doc_id AND l.i = r.i)
    WHERE filled >= 2
), kept AS (
    SELECT l.doc_id, count(g.i) AS removed_lines, count(DISTINCT run) AS removed_chunks,
        coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS body
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i GROUP BY l.doc_id
)
SELECT d.doc_id, coalesce(removed_chunks, 0) AS removed_chunks, coalesce(removed_lines, 0) AS removed_lines,
    md5(coalesce(body, d.text)) AS kept_md5
FROM documents d LEFT JOIN kept USING (doc_id)
"""
