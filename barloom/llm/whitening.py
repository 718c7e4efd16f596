"""Embedding whitening by block Jacobi-Davidson over distributed centred products."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import staged

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Ritz vectors carried beyond the wanted ones, inner MINRES steps, and search vectors beyond the carried ones.
GUARD, INNER, ROOM = 8, 8, 3
# A residual of so many roundings of the largest eigenvalue is double precision; eigenvalues under FLOOR of it are nought.
ROUNDINGS, FLOOR = 64, 1e-12
OUTER = 200

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Whitening:
    """`basis` (dimensions x components) and `values` are eigenpairs of the covariance, from the largest down."""

    count: int
    sums: np.ndarray
    trace: float
    basis: np.ndarray
    values: np.ndarray
    residual: float
    products: int


def whole_vectors(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows (vec_id, x array<long>) of vectors without null or non-finite entries, each entry floor(64 c) + 1000000.

    Of vectors of several lengths the commonest length stays, of two as common the longer; empty vectors go.
    """
    rows = embeddings.select(embeddings[id_col].alias("vec_id"), embeddings[vector_col].cast("array<double>").alias("c"))
    bad = F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = rows.where(F.col("c").isNotNull() & (F.size("c") > 0) & ~bad)
    x = F.transform("c", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    rows = staged(rows.select("vec_id", x.alias("x")), "vectors")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).take(1)
    return rows.where(F.size("x") == (lengths[0].d if lengths else 0))


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def totals(vectors: DataFrame) -> tuple[int, np.ndarray]:
    """Number of vectors and the exact sums of their entries."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, None
        for batch in batches:
            if batch.num_rows:
                part = matrix(batch.column(0)).sum(axis=0)
                count, total = count + batch.num_rows, part if total is None else total + part
        if count:
            entries = pa.array(np.append(total, count))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(entries), dtype=np.int32)), entries], ["dim", "s"])

    found = vectors.select("x").mapInArrow(summed, "dim int, s long").groupBy("dim").agg(F.sum("s").alias("s")).collect()
    sums = np.array([r.s for r in sorted(found, key=lambda r: r.dim)], np.int64)
    return (int(sums[-1]), sums[:-1]) if len(sums) else (0, sums)


def centred_product(vectors: DataFrame, count: int, sums: np.ndarray) -> Product:
    """The covariance times a block of columns, by one pass over the vectors; the covariance is never formed.

    Every entry is centred in whole numbers (count * x - sums) before it is multiplied. A task adds up its rows and sends
    one number for each entry of the result, which are summed by Spark.
    """

    def product(block: np.ndarray) -> np.ndarray:
        def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                if batch.num_rows:
                    rows = (matrix(batch.column(0)) * count - sums) / count
                    part = rows.T @ (rows @ block)
                    total = part if total is None else total + part
            if total is not None:
                entry = pa.array(np.arange(total.size, dtype=np.int32))
                yield pa.RecordBatch.from_arrays([entry, pa.array(total.ravel())], ["entry", "value"])

        parts = vectors.select("x").mapInArrow(multiplied, "entry int, value double")
        found = parts.groupBy("entry").agg(F.sum("value").alias("value")).collect()
        out = np.zeros(block.size)
        out[[r.entry for r in found]] = [r.value for r in found]
        return out.reshape(block.shape) / count

    return product


def orthonormal(block: np.ndarray, against: list[np.ndarray], least: float = 1e-10) -> np.ndarray:
    """An orthonormal basis of what `block` adds to the orthonormal bases in `against`."""
    out = np.zeros((len(block), 0))
    for column in block.T:
        size = np.linalg.norm(column)
        if not size:
            continue
        column = column / size
        for _ in range(3):  # more than once, as one step leaves a rounding of what it takes away
            for basis in [*against, out]:
                column = column - basis @ (basis.T @ column)
            size = np.linalg.norm(column)
            if size < least:
                break
            column = column / size
        if size >= least and out.shape[1] + sum(b.shape[1] for b in against) < len(block):
            out = np.column_stack([out, column])
    return out


def minres(apply: Product, right: np.ndarray, steps: int, enough: float = 0.01) -> np.ndarray:
    """Approximate solutions of symmetric systems, one a column of `right`; each step applies them all at once."""
    width = right.shape[1]
    beta = np.linalg.norm(right, axis=0)
    start = beta.copy()
    safe = np.where(beta > 0, beta, 1)
    v_old, v = np.zeros_like(right), right / safe
    w_old, w = np.zeros_like(right), np.zeros_like(right)
    c_old, c = np.ones(width), np.ones(width)
    s_old, s = np.zeros(width), np.zeros(width)
    eta, x = beta.copy(), np.zeros_like(right)
    going = beta > 0
    beta_now = np.zeros(width)
    for _ in range(steps):
        if not going.any():
            break
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta_now * v_old
        beta_next = np.linalg.norm(p, axis=0)
        delta = c * alpha - c_old * s * beta_now
        rho2 = s * alpha + c_old * c * beta_now
        rho3 = s_old * beta_now
        rho1 = np.hypot(delta, beta_next)
        fine = going & (rho1 > 1e-300)
        by = np.where(fine, rho1, 1)
        c_old, c, s_old, s = c, np.where(fine, delta / by, 1), s, np.where(fine, beta_next / by, 0)
        w_old, w = w, (v - rho3 * w_old - rho2 * w) / by
        x = np.where(fine, x + c * eta * w, x)
        eta = -s * eta
        v_old, v = v, p / np.where(beta_next > 0, beta_next, 1)
        beta_now = beta_next
        going = fine & (beta_next > 0) & (np.abs(eta) > enough * start)
    return x


def largest_pairs(product: Product, size: int, wanted: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray, float]:
    """The `wanted` largest eigenpairs of a symmetric positive matrix known by its products, and the largest residual.

    Block Jacobi-Davidson. Rayleigh-Ritz in the search space gives approximate pairs; pairs are locked from the top once
    their residual is at double precision; for the others the correction equation, projected off the locked and the
    approximate vectors, is solved by some MINRES steps, all systems sharing each product, and its solutions widen the
    space. The space is cut back to the best Ritz vectors when it is full. Raises if the residuals do not get there.
    """
    carried = min(size, wanted + GUARD)
    locked, locked_values = np.zeros((size, 0)), np.zeros(0)
    worst, top, best, idle = 0.0, 0.0, np.inf, 0
    space = orthonormal(np.random.default_rng(seed).standard_normal((size, carried)), [])
    image = product(space)
    for _ in range(OUTER):
        inner = space.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        image = image - locked @ (locked.T @ image)
        left = image - space * values
        sizes = np.linalg.norm(left, axis=0)
        top = max(top, values[0], *locked_values, 0.0)
        need = ROUNDINGS * np.finfo(float).eps * top
        open_ = np.flatnonzero(sizes[: wanted - len(locked_values)] > need)
        done = min(int(open_[0]) if len(open_) else wanted - len(locked_values), len(values))
        if done:
            worst = max(worst, *sizes[:done])
            locked = np.column_stack([locked, space[:, :done]])
            locked_values = np.append(locked_values, values[:done])
            space, image, values, left, sizes = space[:, done:], image[:, done:], values[done:], left[:, done:], sizes[done:]
            best, idle = np.inf, 0
        if len(locked_values) >= wanted or not len(values):
            break
        # Rounding of the products may keep a residual just above `need`: several rounds without gain end the search.
        idle, best = (0, sizes[0]) if sizes[0] < best / 2 else (idle + 1, best)
        if idle > 8:
            raise ArithmeticError(f"residual {sizes[0]:.3g} of the largest eigenvalue {top:.3g} does not fall further")
        kept = min(len(values), carried)
        if space.shape[1] > ROOM * carried:
            space, image = space[:, :kept], image[:, :kept]
        aims = np.flatnonzero(sizes[: min(len(values), wanted - len(locked_values) + GUARD)] > need)
        off = np.column_stack([locked, space[:, : len(aims)]])
        shifts = values[aims]

        def projected(block: np.ndarray, off: np.ndarray = off) -> np.ndarray:
            return block - off @ (off.T @ block)

        def correction(block: np.ndarray, shifts: np.ndarray = shifts) -> np.ndarray:
            block = projected(block)
            return projected(product(block) - block * shifts)

        wider = minres(correction, -projected(left[:, aims]), INNER)
        wider = orthonormal(np.column_stack([wider, left[:, aims]]), [locked, space])
        if wider.shape[1]:
            space, image = np.column_stack([space, wider]), np.column_stack([image, product(wider)])
        else:  # the space is complete: products of the vectors themselves, free of what rotations have left
            space = orthonormal(space, [locked])
            image = product(space)
    else:
        raise ArithmeticError(f"{len(locked_values)} of {wanted} eigenpairs after {OUTER} rounds")
    order = np.argsort(-locked_values, kind="stable")
    return locked[:, order], locked_values[order], worst


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening:
    """Eigenpairs of the covariance of all `vectors` (as `whole_vectors` gives them), `components` of them at most.

    No vectors, or only equal ones, have no components; directions without variance are none either.
    """
    count, sums = totals(vectors)
    size = len(sums)
    if not count:
        return Whitening(0, sums, 0.0, np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    centred, calls = centred_product(vectors, count, sums), 0

    def product(block: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return centred(block)

    trace = _trace(vectors, count, sums)
    if not trace:
        return Whitening(count, sums, 0.0, np.zeros((size, 0)), np.zeros(0), 0.0, calls)
    basis, _, _ = largest_pairs(product, size, min(components, size))
    image = product(basis)
    inner = basis.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, basis, image = values[::-1], basis @ turn[:, ::-1], image @ turn[:, ::-1]
    there = values > FLOOR * values[0]
    residual = np.linalg.norm(image - basis * values, axis=0)[there].max()
    basis, values = basis[:, there] / np.linalg.norm(basis[:, there], axis=0), values[there]
    basis = basis * np.where(basis[np.abs(basis).argmax(axis=0), np.arange(len(values))] < 0, -1, 1)
    return Whitening(count, sums, trace, basis, values, float(residual), calls)


def _trace(vectors: DataFrame, count: int, sums: np.ndarray) -> float:
    """Sum of the variances of all dimensions, of centred entries."""

    def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for batch in batches:
            if batch.num_rows:
                total += float((((matrix(batch.column(0)) * count - sums) / count) ** 2).sum())
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["s"])

    found = vectors.select("x").mapInArrow(squared, "s double").agg(F.sum("s").alias("s")).first().s
    return (found or 0.0) / count


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    if not len(model.values):
        return 0.0
    count, sums, scaled = model.count, model.sums, model.basis / np.sqrt(model.values)
    width = len(model.values)

    def crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width))
        for batch in batches:
            if batch.num_rows:
                w = (matrix(batch.column(0)) * count - sums) / count @ scaled
                total[:width] += w.T @ w
                total[width] += w.sum(axis=0)
        entry = pa.array(np.arange(total.size, dtype=np.int32))
        yield pa.RecordBatch.from_arrays([entry, pa.array(total.ravel())], ["entry", "value"])

    parts = vectors.select("x").mapInArrow(crossed, "entry int, value double")
    found = parts.groupBy("entry").agg(F.sum("value").alias("value")).collect()
    total = np.zeros((width + 1) * width)
    total[[r.entry for r in found]] = [r.value for r in found]
    total = total.reshape(width + 1, width) / count
    return float(np.abs(total[:width] - np.outer(total[width], total[width]) - np.eye(width)).max())


def deviations(rows: np.ndarray) -> np.ndarray:
    """Exact sums of squares of each row; raises if one is beyond a long."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * max(rows.shape[1], 1) < 1 << 63:
        return (rows * rows).sum(axis=1)
    found = [sum(int(v) * int(v) for v in row) for row in rows]
    if max(found) >= 1 << 63:
        raise OverflowError("a sum of squared deviations is beyond 64 bits")
    return np.array(found, np.int64)


def whiten(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error), for each whole vector and component.

    Vectors that are null or hold null or non-finite entries go, as do those of a rarer length (see `whole_vectors`);
    repeated rows and ids count and are answered each, a null id too. An empty table, one vector, or equal vectors have
    no components and so no rows. Where the eigenvalues of two components are equal any basis of their plane may be given.
    Further columns are not looked at. A deviation beyond 64 bits is an error.
    """
    vectors = whole_vectors(embeddings, id_col, vector_col)
    model = fit(vectors, components)
    off = identity_error(vectors, model)
    count, sums, width = model.count, model.sums, len(model.values)
    scaled, explained = model.basis / np.sqrt(model.values), model.values / (model.trace or 1)
    schema = T.StructType([vectors.schema["vec_id"]]).add("component", "integer").add("n", "long").add("deviation", "long")
    schema = schema.add("whitened", "double").add("explained", "double").add("identity_error", "double")

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not width:
                continue
            rows, size = matrix(batch.column(1)) * count - sums, batch.num_rows * width
            which = pa.array(np.repeat(np.arange(batch.num_rows), width))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(which),
                    pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), batch.num_rows)),
                    pa.array(np.full(size, count)),
                    pa.array(np.repeat(deviations(rows), width)),
                    pa.array((rows / count @ scaled).ravel()),
                    pa.array(np.tile(explained, batch.num_rows)),
                    pa.array(np.full(size, off)),
                ],
                schema.names,
            )

    return vectors.select("vec_id", "x").mapInArrow(projected, schema)
