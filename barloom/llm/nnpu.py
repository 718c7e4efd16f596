"""Toxicity by non-negative positive-unlabelled learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import mixed, staged, text_bytes, text_slices, two_columns, word_hashes

# Bounds of the sample that the weights are fitted on, whatever the table's size, and of the features kept.
POSITIVES, UNLABELLED, FEATURES = 4000, 12000, 1 << 16
LEAST_POSITIVES = 3
GRAM = 5
SIEVE = 1 << 20
THRESHOLD = 0.7
LEAST_ODDS = 1.0
EDGE, NOTHING = pa.scalar("\0", pa.large_string()), pa.scalar("", pa.large_string())


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Feature hashes of all texts and the text of each: lower-cased words, and runs of bytes in words.

    A run may begin or end with the word's edge. So a rare word counts by itself and by its parts.
    """
    words, starts = word_hashes(column)
    of_word = np.repeat(np.arange(len(column)), np.diff(starts))
    lower = pa.compute.utf8_lower(column.cast(pa.large_string()))
    data, offsets = text_bytes(pa.compute.binary_join_element_wise(EDGE, pa.compute.fill_null(lower, ""), EDGE, NOTHING))
    inside = ((data >= 97) & (data <= 122)) | (data >= 128)
    low = np.where(inside, data, 0).astype(np.uint64)
    size = max(0, len(data) - GRAM + 1)
    value = np.zeros(size, np.uint64)
    for k in range(GRAM):
        value = value * np.uint64(0x100000001B3) + low[k : k + size]
    whole = np.ones(size, bool)
    for k in range(1, GRAM - 1):
        whole &= inside[k : k + size]
    at = np.flatnonzero(whole)
    of_gram = np.searchsorted(offsets, at, side="right") - 1
    return np.concatenate([words, mixed(value[at] + np.uint64(1))]), np.concatenate([of_word, of_gram])


def picked(column: pa.Array, held: np.ndarray, sieve: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, number of feature) once for each of the sorted features `held` that a text has."""
    found, text = features(column)
    maybe = sieve[found & np.uint64(SIEVE - 1)]
    found, text = found[maybe], text[maybe]
    where = np.searchsorted(held, found)
    known = where < len(held)
    known[known] = held[where[known]] == found[known]
    pairs = np.unique(text[known] * np.int64(max(1, len(held))) + where[known])
    return pairs // max(1, len(held)), pairs % max(1, len(held))


def sieve_of(held: np.ndarray) -> np.ndarray:
    sieve = np.zeros(SIEVE, bool)
    sieve[held & np.uint64(SIEVE - 1)] = True
    return sieve


@dataclass
class ToxicityModel:
    """Features (sorted hashes), their weights, the bias."""

    held: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, column: pa.Array, sieve: np.ndarray) -> np.ndarray:
        text, number = picked(column, self.held, sieve)
        z = np.bincount(text, self.weights[number], minlength=len(column)) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def bounded_sample(docs: DataFrame, most: int, name: str) -> DataFrame:
    """The rows with the `most` smallest hashes of their id (column doc_id), one for each id: of several the least by its
    columns, so that an id that very many rows share does not break the bound."""
    key = F.xxhash64(F.col("doc_id").cast("string"))
    ids = staged(docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(key, "doc_id").limit(most), f"{name}-ids")
    return one_row_each(docs.join(ids, "doc_id", "left_semi"))


def one_row_each(rows: DataFrame) -> DataFrame:
    """One row for each doc_id, the least by the other columns."""
    rest = [c for c in rows.columns if c != "doc_id"]
    if not rest:
        return rows.distinct()
    return rows.groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("_row")).select("doc_id", *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*rows.columns)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
    n_features: int = FEATURES,
) -> ToxicityModel:
    """Fit on texts labelled 1 and on texts taken as unlabelled, both among the rows where `learn` holds.

    `learn` is an expression over the id column. The share of ones among the labelled learning rows is the class prior.
    Features are the strings with the largest log odds of standing in a positive text against any text, counted over all
    these rows. Weights are fitted on samples bounded by the parameters; a feature that none of them has keeps its log
    odds less two standard errors. Without a positive or an unlabelled text every score is the prior (0 if
    there is no label).
    """
    plain = two_columns(docs.where(learn), id_col, text_col)
    marks = labels.where(learn).where(labels[label_col].isNotNull()).select(labels[id_col].alias("doc_id"), labels[label_col].alias("label"))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    counted = marks.agg(F.count("*").alias("n"), F.coalesce(F.sum((F.col("label") == 1).cast("int")), F.lit(0)).alias("ones")).first()
    prior = counted.ones / counted.n if counted.n else 0.0
    ones = staged(marks.where("label = 1 AND doc_id IS NOT NULL").select("doc_id"), "all-positive-ids")
    pos = bounded_sample(ones, positives, "positives")
    sample = staged(
        one_row_each(plain.join(staged(pos.distinct(), "positive-ids"), "doc_id", "left_semi")).select("doc_id", "text", F.lit(True).alias("positive"))
        .union(bounded_sample(plain, unlabelled, "unlabelled").select("doc_id", "text", F.lit(False))),
        "toxicity-sample",
    )

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found, text = features(part.column("text"))
                order = np.lexsort((text, found))
                found, text = found[order], text[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (text[1:] != text[:-1])
                value, first = np.unique(found[new], return_index=True)
                number = np.diff(np.append(first, int(new.sum())))
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(number, pa.int64())], ["f", "n"])

    every = plain.where("doc_id IS NOT NULL")
    marked = every.join(ones, "doc_id", "left_semi")
    n_pos, n_un = marked.count(), every.count()
    if not n_pos or not n_un:
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), float(np.log(max(prior, 1e-12) / max(1 - prior, 1e-12))))
    odds = F.log((F.col("p") + 0.5) / (n_pos + 1)) - F.log((F.col("u") + 0.5) / (n_un + 1))
    odds = odds - 2 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("u") + 0.5))
    best = (
        marked.select("text").mapInArrow(counts, "f long, n long").select("f", F.col("n").alias("p"), F.lit(0).alias("u"))
        .union(every.select("text").mapInArrow(counts, "f long, n long").select("f", F.lit(0), "n"))
        .groupBy("f").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))
        .where((F.col("p") >= LEAST_POSITIVES) & (odds > LEAST_ODDS))
        .orderBy((odds * F.col("p")).desc(), "f").limit(n_features).select("f", odds.alias("odds")).collect()
    )
    best.sort(key=lambda r: np.int64(r.f).view(np.uint64))
    held = np.array([r.f for r in best], np.int64).view(np.uint64)
    sieve = sieve_of(held)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                text, number = picked(part.column("text"), held, sieve)
                at = np.searchsorted(text, np.arange(part.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(number, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("positive"), lists], ["positive", "numbers"])

    taken = sample.select("text", "positive").mapInArrow(rows, "positive boolean, numbers array<int>").collect()
    taken.sort(key=lambda r: (r.positive, r.numbers))
    weights, bias = fit([r.numbers for r in taken if r.positive], [r.numbers for r in taken if not r.positive], len(held), prior)
    absent = np.ones(len(held), bool)
    absent[[k for r in taken for k in r.numbers]] = False
    weights[absent] = np.array([r.odds for r in best])[absent]
    return ToxicityModel(held, weights, bias)


def fit(pos: list[list[int]], un: list[list[int]], size: int, prior: float, steps: int = 400, rate: float = 0.05, decay: float = 1e-5) -> tuple[np.ndarray, float]:
    """Weights and bias with the least non-negative risk: prior * R+(positive) + max(0, R-(unlabelled) - prior * R-(positive)).

    Logistic loss, whole-batch Adam, weights of at least 0 since features speak for a positive. Where the corrected negative risk falls below zero, the step goes against it.
    """
    lists = pos + un
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    number = np.array([k for x in lists for k in x], np.int64)
    n_pos, n_un = len(pos), len(un)
    is_pos = np.arange(len(lists)) < n_pos
    w, b = np.zeros(size), 0.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.clip(np.bincount(row, w[number], minlength=len(lists)) + b, -30, 30)
        p = 1 / (1 + np.exp(-z))
        loss_neg = np.logaddexp(0, z)
        negative = loss_neg[~is_pos].mean() - prior * loss_neg[is_pos].mean()
        toward_neg = np.where(is_pos, -prior * p / n_pos, p / n_un)
        if negative >= 0:
            slope = toward_neg + np.where(is_pos, -prior * (1 - p) / n_pos, 0)
        else:
            slope = -toward_neg
        grad = np.append(np.bincount(number, slope[row], minlength=size) + decay * w, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        change = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        w = np.maximum(w - change[:-1], 0)
        b -= change[-1]
    return w, float(b)


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (doc_id, score, predicted), one for each row of `docs`, from its whole text alone.

    Null and empty texts get the score of a text without features. predicted is 1 from `threshold` on. Repeated rows
    are answered each; other columns are not read.
    """
    plain = two_columns(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = sieve_of(model.held)
        for batch in batches:
            for part in text_slices(batch):
                p = model.score(part.column("text"), sieve)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"]
                )

    return plain.mapInArrow(run, f"doc_id {id_type}, score double, predicted int")
