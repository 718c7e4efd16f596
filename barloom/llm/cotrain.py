"""Quality classifier by co-training two views: text content, and page metadata."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import mixed, staged, text_bytes, text_slices
from barloom.llm.nnpu import bounded_sample, one_row_each

CONTENT, META = 2048, 512
# Bounds of the labelled rows and of the unlabelled pool, whatever the table's size.
LABELLED, POOL = 4000, 8000
ROUNDS, ADDED = 5, 400
KEEP_FROM = 0.5


def content_view(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, case kept, and the share of words that repeat the one before."""
    n = len(offsets) - 1
    out = np.zeros((n, CONTENT), np.float32)
    size = len(data) - 2
    if size > 0:
        wide = data.astype(np.uint64)
        value = mixed((wide[:size] << np.uint64(16)) | (wide[1 : size + 1] << np.uint64(8)) | wide[2:])
        bucket = (value >> np.uint64(40)).astype(np.int64) % (CONTENT - 1)
        of = np.repeat(np.arange(n), np.diff(offsets))[:size]
        inside = np.arange(size) + 2 < offsets[of + 1]
        out[:, : CONTENT - 1] = np.bincount(
            of[inside] * (CONTENT - 1) + bucket[inside], minlength=n * (CONTENT - 1)
        ).reshape(n, -1)
        out[:, : CONTENT - 1] = np.sqrt(out[:, : CONTENT - 1] / np.maximum(1, out.sum(axis=1))[:, None])
    blank = data <= 32
    starts = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]])) if len(data) else np.zeros(0, np.int64)
    if len(starts) > 1:
        term = np.where(blank, np.uint64(0), mixed(data.astype(np.uint64) + (np.arange(len(data)) - starts[np.maximum(np.cumsum(~blank & np.concatenate([[True], blank[:-1]])) - 1, 0)]).astype(np.uint64) * np.uint64(257)))
        word = np.add.reduceat(term, starts)
        doc = np.searchsorted(offsets, starts, side="right") - 1
        same = (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])
        words = np.bincount(doc, minlength=n)
        out[:, CONTENT - 1] = np.bincount(doc[1:][same], minlength=n) / np.maximum(1, words)
    return out


def meta_view(fields: list[list]) -> np.ndarray:
    """One-hot hashed metadata fields, each and every two together; nothing of the text."""
    n = len(fields[0]) if fields else 0
    out = np.zeros((n, META), np.float32)
    named = [[f"{k}:{value}" for value in values] for k, values in enumerate(fields)]
    named += [[f"{a} {b}" for a, b in zip(x, y, strict=True)] for x, y in combinations(named, 2)]
    known: dict[str, int] = {}
    for values in named:
        for row, value in enumerate(values):
            if value not in known:
                known[value] = xxhash.xxh64_intdigest(value.encode()) % META
            out[row, known[value]] = 1
    return out


def meta_columns(docs: DataFrame, names: Sequence[str]) -> list[Column]:
    """Metadata columns as text meta_0, meta_1, ...; of a number its power of two."""
    out = []
    for k, name in enumerate(names):
        column = docs[name]
        if isinstance(docs.schema[name].dataType, T.NumericType):
            column = F.floor(F.log2(F.abs(column.cast("double")) + 1))
        out.append(column.cast("string").alias(f"meta_{k}"))
    return out


@dataclass
class View:
    """Logistic regression with its calibration (slope and offset)."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    offset: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights + self.bias

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * self.raw(x) + self.offset


def logistic(x: np.ndarray, y: np.ndarray, start: View | None = None, steps: int = 300, rate: float = 0.1, decay: float = 1e-4) -> View:
    """Whole-batch Adam in single precision, from another view's weights where given."""
    x, y = x.astype(np.float32, copy=False), y.astype(np.float32)
    w, b = (start.weights, start.bias) if start else (np.zeros(x.shape[1], np.float32), 0.0)
    first, second = np.zeros(len(w) + 1, np.float32), np.zeros(len(w) + 1, np.float32)
    for step in range(1, steps + 1):
        d = (1 / (1 + np.exp(-np.clip(x @ w + np.float32(b), -30, 30))) - y) / np.float32(len(y))
        grad = np.append(d @ x + np.float32(decay) * w, d.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        change = np.float32(rate / (1 - 0.9**step)) * first / (np.sqrt(second / np.float32(1 - 0.999**step)) + np.float32(1e-8))
        w, b = w - change[:-1], b - float(change[-1])
    return View(w, float(b))


@dataclass
class QualityModel:
    """Two calibrated views, their say in the sum, and the metadata columns read."""

    content: View | None
    meta: View | None
    say: tuple[float, float, float]
    meta_cols: list[str]

    def scores(self, batch: pa.RecordBatch) -> np.ndarray:
        """Probability of good quality of each row of (doc_id, text, metadata...)."""
        if self.content is None or self.meta is None:
            return np.full(batch.num_rows, 1 / (1 + np.exp(-self.say[2])))
        xc, xm = views(batch, 1, 2)
        z = self.say[0] * self.content.logit(xc) + self.say[1] * self.meta.logit(xm) + self.say[2]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def views(batch: pa.RecordBatch, text_at: int, meta_at: int) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(batch.column(text_at))
    fields = [batch.column(k).to_pylist() for k in range(meta_at, batch.num_columns)]
    return content_view(data, offsets), meta_view(fields)


def few_rows(batch: pa.RecordBatch, most: int = 2048) -> Iterator[pa.RecordBatch]:
    """Parts bounded by bytes of text and by rows, since a row costs a vector."""
    for part in text_slices(batch):
        for k in range(0, part.num_rows, most):
            yield part.slice(k, most)


def train(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    meta_cols: tuple[str, ...] = ("source", "lang", "n_chars"),
    labelled: int = LABELLED,
    pool: int = POOL,
    rounds: int = ROUNDS,
    added: int = ADDED,
) -> QualityModel:
    """Co-train on a bounded sample of labelled rows and a bounded pool of rows taken as unlabelled.

    In each round either view, fitted on its own training rows, labels the pool rows it is surest of, in the classes'
    proportion, and hands them to the other view. Every fifth labelled row is kept back; on those the views are calibrated
    (Platt) and their say in the sum is fitted. The metadata view sees the metadata columns alone, the content view the text. `learn` is an expression over the id column that restricts labels. Labels
    other than 0 and 1 are not used. With labels of one class only, every score is that class's share.
    """
    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), *meta_columns(docs, meta_cols))
    marks = labels if learn is None else labels.where(learn)
    marks = marks.where(marks[label_col].isin(0, 1)).select(marks[id_col].alias("doc_id"), marks[label_col].alias("label"))
    marks = marks.groupBy("doc_id").agg(F.max("label").alias("label"))
    known = staged(bounded_sample(marks, labelled, "quality-labels"), "quality-known")
    rest = staged(bounded_sample(plain.select("doc_id"), pool, "quality-pool"), "quality-pool").withColumn("label", F.lit(-1))
    chosen = staged(known.select("doc_id", "label").union(rest.join(known, "doc_id", "left_anti").select("doc_id", "label")).distinct(), "quality-ids")
    texts = one_row_each(plain.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi"))
    sample = texts.join(F.broadcast(chosen), "doc_id")  # at most `labelled` + `pool` rows

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in few_rows(batch, 512):
                xc, xm = views(part, 1, 3)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array([x.astype(np.float16).tobytes() for x in xc], pa.binary()), pa.array([np.packbits(x > 0).tobytes() for x in xm], pa.binary())],
                    ["key", "label", "content", "meta"],
                )

    ordered = sample.select(F.xxhash64(F.col("doc_id").cast("string")).alias("key"), "text", "label", *[f"meta_{k}" for k in range(len(meta_cols))])
    # Written first and read part by part, so that the driver's JVM never holds all of them.
    made = staged(ordered.mapInArrow(rows, "key long, label int, content binary, meta binary"), "quality-vectors")
    taken = list(made.toLocalIterator())
    taken.sort(key=lambda r: (r.key, r.label, r.content, r.meta))
    label = np.array([r.label for r in taken], np.int64)
    xc, xm = np.empty((len(taken), CONTENT), np.float32), np.empty((len(taken), META), np.float32)
    for k, r in enumerate(taken):
        xc[k] = np.frombuffer(r.content, np.float16)
        xm[k] = np.unpackbits(np.frombuffer(r.meta, np.uint8))
    held = np.array([r.key % 5 == 0 for r in taken], bool) & (label >= 0)
    del taken
    return fit(xc, xm, label, held, rounds, added, list(meta_cols))


def fit(xc: np.ndarray, xm: np.ndarray, label: np.ndarray, held: np.ndarray, rounds: int, added: int, meta_cols: list[str]) -> QualityModel:
    seen = (label >= 0) & ~held
    if len(np.unique(label[seen])) < 2:
        share = (label[label >= 0].mean() if (label >= 0).any() else 0.5) * 0.998 + 0.001
        return QualityModel(None, None, (0.0, 0.0, float(np.log(share / (1 - share)))), meta_cols)
    good = label[seen].mean()
    free = label < 0
    guess_c, guess_m = label.astype(float).copy(), label.astype(float).copy()  # the training labels of either view
    content = meta = None
    for turn in range(rounds + 1):
        use_c, use_m = (guess_c >= 0) & ~held, (guess_m >= 0) & ~held
        content, meta = logistic(xc[use_c], guess_c[use_c], content), logistic(xm[use_m], guess_m[use_m], meta)
        if turn == rounds:  # what the last exchange gave is fitted, and nothing is exchanged after that
            break
        for view, x, other in ((content, xc, guess_m), (meta, xm, guess_c)):
            open_rows = np.flatnonzero(free & (other < 0))
            p = 1 / (1 + np.exp(-np.clip(view.raw(x[open_rows]), -30, 30)))
            order = open_rows[np.argsort(p, kind="stable")]
            sure = np.sort(p)
            n_bad = min(int(added * (1 - good)), int((sure < 0.1).sum()))
            n_good = min(int(added * good), int((sure > 0.9).sum()))
            other[order[:n_bad]] = 0
            other[order[len(order) - n_good :]] = 1
    judge = held if len(np.unique(label[held])) == 2 else seen
    y = label[judge].astype(float)
    for view, x in ((content, xc), (meta, xm)):
        platt = logistic(view.raw(x[judge])[:, None] / 10, y, steps=400)
        view.slope, view.offset = float(platt.weights[0]) / 10, platt.bias
    both = np.stack([np.clip(content.logit(xc[judge]), -20, 20), np.clip(meta.logit(xm[judge]), -20, 20)], axis=1)
    joint = logistic(both / 10, y, steps=400)
    return QualityModel(content, meta, (float(joint.weights[0]) / 10, float(joint.weights[1]) / 10, joint.bias), meta_cols)


def score(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """Rows (doc_id, score, predicted), one for each row of `docs`, from the whole text and the metadata columns.

    score is the probability of good quality, predicted 1 from `keep_from` on. A null text counts as empty, a null
    metadata field as a value of its own. Repeated rows are answered each; other columns are not read.
    """
    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), *meta_columns(docs, model.meta_cols))
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in few_rows(batch):
                p = model.scores(part)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(p, pa.float64()), pa.array((p >= keep_from).astype(np.int32))], ["doc_id", "score", "predicted"])

    return plain.mapInArrow(run, f"doc_id {id_type}, score double, predicted int")
