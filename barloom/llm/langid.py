"""Language identification: averaged hashed subword embeddings, a linear softmax, calibrated rejection."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import staged, text_slices, two_columns

BUCKETS = 1 << 16
GRAMS = (2, 3, 4)
UNKNOWN = "und"
# Training rows: so many documents of each language at most, and short pieces of each beside the whole text.
SAMPLE_PER_LANG = 600
PIECES = 3
# Text scored at once: some sixty bytes of arrays for each of its letters.
SLICE = 1 << 19


# Made once in a process. A plain dict, since a cached function would travel by name.
MADE: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Lower-case code point of each letter of Unicode, 0 for all else."""
    if "letters" in MADE:
        return MADE["letters"]
    table = np.zeros(0x110000, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower[0])
    MADE["letters"] = table
    return table


def letters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letters of all texts, zero elsewhere and between texts, and where each text begins (n + 1)."""
    points = np.frombuffer("".join(f"\0{t}\0\0\0" for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter((len(t) + 4 for t in texts), np.int64, len(texts))
    return letter_table()[points], np.concatenate([[0], np.cumsum(sizes)])


def subwords(low: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each length: bucket of the letter n-gram at each place, and whether it counts.

    An n-gram lies in one word, with the word's edge as first or last sign; it has no edge inside.
    """
    wide = low.astype(np.uint64)
    for n in GRAMS:
        size = len(wide) - n + 1
        if size <= 0:
            continue
        value = np.full(size, n, np.uint64)
        for k in range(n):
            value = (value ^ wide[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(31)
        if n == 2:
            counts = (low[:size] != 0) | (low[1:] != 0)
        else:
            counts = np.ones(size, bool)
            for k in range(1, n - 1):
                counts &= low[k : k + size] != 0
        yield (value >> np.uint64(48)).astype(np.int64) % BUCKETS, counts


@dataclass
class LanguageModel:
    """Bucket scores by language (embedding times softmax weights), bias, temperature, least score accepted, buckets learned."""

    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    threshold: float
    known: np.ndarray

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best language number, its score, and whether the text has a letter.

        The score is the calibrated probability times the share of n-grams that were learned: the softmax alone is sure
        of texts in no learned language too.
        """
        low, starts = letters(texts)
        total = np.zeros((len(texts), len(self.languages)))
        number, known = np.zeros(len(texts)), np.zeros(len(texts))
        for bucket, counts in subwords(low):
            at = starts[:-1]
            number += np.add.reduceat(counts, at, dtype=np.int64)
            known += np.add.reduceat(self.known[bucket] & counts, at, dtype=np.int64)
            for k in range(len(self.languages)):
                total[:, k] += np.add.reduceat(self.scores[k][bucket] * counts, at, dtype=np.float64)
        logits = (total / np.maximum(number, 1)[:, None] + self.bias) / self.temperature
        logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(axis=1, keepdims=True)
        has_letter = np.add.reduceat(low != 0, starts[:-1], dtype=np.int64) > 0
        return p.argmax(axis=1), p.max(axis=1) * known / np.maximum(number, 1), has_letter


def example_rows(docs: DataFrame) -> DataFrame:
    """Buckets (16 bits) and their shares, as bytes, of each text and of a few short pieces of it, picked by the id's hash."""

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                keys, langs, buckets, counts, whole = [], [], [], [], []
                for key, lang, text in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    pick = np.random.default_rng(key & 0x7FFFFFFFFFFFFFFF)
                    pieces = [text]
                    for _ in range(PIECES):
                        size = int(pick.integers(20, 200))
                        start = int(pick.integers(0, max(1, len(text) - size)))
                        pieces.append(text[start : start + size])
                    for k, piece in enumerate(pieces):
                        found = [b[c] for b, c in subwords(letters([piece])[0])]
                        number, times = np.unique(np.concatenate(found), return_counts=True)
                        if len(number):
                            keys.append(key)
                            langs.append(lang)
                            buckets.append(number.astype(np.uint16).tobytes())
                            counts.append((times / times.sum()).astype(np.float32).tobytes())
                            whole.append(k == 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(langs, pa.string()),
                        pa.array(buckets, pa.binary()),
                        pa.array(counts, pa.binary()),
                        pa.array(whole, pa.bool_()),
                    ],
                    ["key", "lang", "buckets", "shares", "whole"],
                )

    return docs.mapInArrow(examples, "key long, lang string, buckets binary, shares binary, whole boolean")


def train(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    per_lang: int = SAMPLE_PER_LANG,
    dims: int = 16,
    epochs: int = 8,
    rate: float = 0.5,
    most_errors: float = 0.01,
) -> LanguageModel:
    """Fit on the rows where `learn` holds, text and language being there.

    At most `per_lang` documents a language are used, those with the smallest hash of the id: a bounded sample, whatever
    the table's size. The whole texts of a fifth of them, not trained on, set the temperature (least log loss) and the
    rejection threshold: the lowest score from which on at most `most_errors` of these texts are wrong; 1 if none is. With no usable row the model knows no
    language and answers `und` throughout.
    """
    usable = docs.where(learn & docs[text_col].isNotNull() & docs[lang_col].isNotNull())
    keyed = usable.select(
        F.xxhash64(usable[id_col].cast("string")).alias("key"), usable[lang_col].alias("lang"), usable[text_col].alias("text")
    )
    # Of a frequent language only hashes low enough for some three times the wanted number are ranked;
    # that fewer than wanted are that low is out of the question.
    numbers = staged(keyed.groupBy("lang").agg((3.0 * per_lang / F.count("*")).alias("enough")), "langid-numbers")
    low = keyed.select("key", "lang").join(numbers, "lang").where((F.col("key") / float(1 << 64) + 0.5) < F.col("enough"))
    ranked = low.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy("key")))
    chosen = staged(ranked.where(F.col("r") <= per_lang).select("key", "lang").distinct(), "langid-sample")
    # Written first and read part by part, so that the driver's JVM never holds all of them.
    made = staged(example_rows(keyed.join(chosen, ["key", "lang"], "left_semi").select("key", "lang", "text")), "langid-examples")
    rows = list(made.toLocalIterator())
    rows.sort(key=lambda r: (r.key, r.lang, len(r.buckets), r.buckets))
    return fit(rows, dims, epochs, rate, most_errors)


def fit(rows: list, dims: int, epochs: int, rate: float, most_errors: float) -> LanguageModel:
    """Stochastic gradient descent, one example after another."""
    languages = sorted({r.lang for r in rows})
    if not languages:
        return LanguageModel([UNKNOWN], np.zeros((1, BUCKETS), np.float32), np.zeros(1), 1.0, 0.0, np.ones(BUCKETS, bool))
    data = [
        (np.frombuffer(r.buckets, np.uint16), np.frombuffer(r.shares, np.float32), languages.index(r.lang), r.key % 5 == 0)
        for r in rows
    ]
    learn = [d for d in data if not d[3]] or data
    whole = [d for d, r in zip(data, rows, strict=True) if r.whole] or data
    check = [d for d in whole if d[3]] or whole
    known = np.zeros(BUCKETS, bool)
    for bucket, *_ in learn:
        known[bucket] = True
    pick = np.random.default_rng(7)
    embed = pick.normal(0, 1 / dims, (BUCKETS, dims)).astype(np.float32)
    weights = np.zeros((dims, len(languages)), np.float32)
    bias = np.zeros(len(languages), np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for k in pick.permutation(len(learn)):
            bucket, share, lang, _ = learn[k]
            mean = share @ embed[bucket]
            p = mean @ weights + bias
            p = np.exp(p - p.max())
            p /= p.sum()
            p[lang] -= 1
            back = weights @ p
            weights -= step * np.outer(mean, p)
            bias -= step * 0.1 * p
            embed[bucket] -= step * np.outer(share, back)
    table = np.ascontiguousarray((embed @ weights).T)
    logits = np.array([table[:, b] @ s + bias for b, s, _, _ in check])
    truth = np.array([lang for _, _, lang, _ in check])

    def calibrated(temperature: float) -> np.ndarray:
        z = logits / temperature
        z -= z.max(axis=1, keepdims=True)
        e = np.exp(z)
        return e / e.sum(axis=1, keepdims=True)

    def loss(temperature: float) -> float:
        return -np.log(np.maximum(calibrated(temperature)[np.arange(len(truth)), truth], 1e-12)).mean()

    temperature = min(np.geomspace(0.05, 20, 60), key=loss)
    p = calibrated(temperature)
    score, right = p.max(axis=1) * [s[known[b]].sum() for b, s, _, _ in check], p.argmax(axis=1) == truth
    order = np.argsort(-score, kind="stable")
    wrong_above = np.cumsum(~right[order]) / np.arange(1, len(order) + 1)
    # Rows of equal score are accepted together, so only the last of them counts.
    last = np.append(score[order][1:] < score[order][:-1], True)
    good = np.flatnonzero((wrong_above <= most_errors) & last)
    # A little less, since shares are kept in single precision.
    threshold = float(score[order[good[-1]]]) * (1 - 1e-6) if len(good) else 1.0
    return LanguageModel(languages, table, bias, float(temperature), threshold, known)


def accepted_rows(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text reaches the model's threshold, as they are.

    Each row is judged by its own text, so that no join is needed and rows that share an id do not share their fate. Null
    texts and texts without a letter are not accepted.
    """
    place = docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named = batch.rename_columns([f"_{k}" for k in range(batch.num_columns)])
            for part in text_slices(named, f"_{place}", SLICE):
                _, p, has_letter = model.predict([t or "" for t in part.column(place).to_pylist()])
                yield part.filter(pa.array(has_letter & (p >= model.threshold))).rename_columns(batch.schema.names)

    return docs.mapInArrow(kept, docs.schema)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, lang_pred, score, accepted), one for each row of `docs`, from its whole text alone.

    A null text or one without a letter gets `und`, score 0, not accepted. Else the likeliest language and its
    calibrated probability times the share of learned n-grams; accepted says that this reaches the model's threshold. Ties go to the first language by
    name. Repeated rows are answered each; other columns are not read.
    """
    plain = two_columns(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, most=SLICE):
                best, p, has_letter = model.predict([t or "" for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([model.languages[b] if h else UNKNOWN for b, h in zip(best, has_letter, strict=True)], pa.string()),
                        pa.array(np.where(has_letter, p, 0.0)),
                        pa.array(has_letter & (p >= model.threshold)),
                    ],
                    ["doc_id", "lang_pred", "score", "accepted"],
                )

    return plain.mapInArrow(score, f"doc_id {id_type}, lang_pred string, score double, accepted boolean")
