"""Removal of long repeated byte strings by blockwise suffix sorting over a cover sample."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import BYTE_VALUE, mixed, staged, text_slices

LENGTH = 400
# Positions of a text handled at once; positions take the low bits of a sort key.
SEGMENT, PLACE_BITS = 1 << 21, 24
# Suffixes of one bucket sorted in one task; larger buckets are compared window by window instead.
BUCKET = 512
PAIRWISE = 24


# Tables made once in a process. A plain dict, since a cached function would travel by name.
MADE: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    if size in MADE:
        return MADE[size]
    base = 0xD1342543DE82EF95
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    MADE[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return MADE[size]


class Rolling:
    """Hashes of any substrings of some bytes from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = powers(1 << max(16, int(len(data)).bit_length()))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUE[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.down[: len(self.sums)][start])


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` values, from running minima of blocks."""
    size = len(values) - width + 1
    padded = np.concatenate([values, np.full(-len(values) % width, ~np.uint64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:size], ahead[width - 1 : width - 1 + size])


def cover_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Runs of window starts that have one sample position: (bucket, run hash, first start, number of starts, place of the sample).

    The sample position of a window of `length` bytes is its substring of half the length with the least hash, the
    first one on a tie. Equal windows have it at the same place, so the sample covers them as a difference cover
    does: whatever two equal windows there are, some common shift leads both to sample positions. Windows of one
    bucket share the sampled half; the run hash is that of all bytes which the run's windows touch.
    """
    half = length // 2
    out = []
    for base in range(0, max(0, len(data) - length + 1), SEGMENT):
        part = data[base : base + SEGMENT + length - 1]
        roll = Rolling(part)
        size = len(part) - half + 1
        grams = roll.of(slice(0, size), slice(half, half + size))
        place = np.arange(size, dtype=np.uint64)
        keyed = (grams & ~np.uint64((1 << PLACE_BITS) - 1)) | place
        sample = (lowest(keyed, length - half + 1) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate([[True], sample[1:] != sample[:-1]]))
        stop = np.append(start[1:], len(sample))
        number, back = stop - start, sample[start] - start
        run = roll.of(start, stop - 1 + length) ^ mixed((number * (length + 1) + back).astype(np.uint64))
        out.append((grams[sample[start]], run, start + base, number, back))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def merged(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open intervals, touching ones joined."""
    if not len(start):
        return start, stop
    order = np.argsort(start, kind="stable")
    start, far = start[order], np.maximum.accumulate(stop[order])
    new = np.concatenate([[True], start[1:] > far[:-1]])
    first = np.flatnonzero(new)
    return start[first], far[np.append(first[1:], len(start)) - 1]


def repeated_offsets(left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Which windows of one bucket are repeated in it: a row for each suffix, a column for each offset to the sample.

    Row m has `left` (bytes before the sample, nearest first) and `right` (bytes after the sampled half), and the
    offsets low..high of its run. The suffixes are sorted by their right side, and by their left side; the common lengths
    of neighbours give each its rank at any depth. A window at offset a needs a bytes to the left and all but a to the
    right, so windows are equal where both ranks are: long ties cost two numbers, not their bytes.
    """
    n, half = left.shape
    depth_ranks = []
    for side in (left, right):
        order = np.lexsort(side.T[::-1])
        differs = side[order[1:]] != side[order[:-1]]
        common = np.where(differs.any(axis=1), differs.argmax(axis=1), half)
        ranks = np.zeros((half + 1, n), np.int64)
        ranks[:, order[1:]] = np.cumsum(common[None, :] < np.arange(half + 1)[:, None], axis=1)
        depth_ranks.append(ranks)
    out = np.zeros((n, half + 1), bool)
    for a in range(half + 1):
        rows = np.flatnonzero((low <= a) & (a <= high))
        if len(rows) > 1:
            key = depth_ranks[0][a, rows] * n + depth_ranks[1][half - a, rows]
            _, back, times = np.unique(key, return_inverse=True, return_counts=True)
            out[rows, a] = times[back] > 1
    return out


def repeated_pairwise(left: np.ndarray, right: np.ndarray, low: np.ndarray, high: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """As `repeated_offsets`, for many small buckets at once, from the common lengths of all pairs in each."""
    half = left.shape[1]
    change = np.zeros((len(left), half + 2), np.int32)
    for size in np.unique(sizes):
        first = starts[sizes == size]
        for i in range(size):
            for k in range(i):
                for at in range(0, len(first), 4096):
                    a, b = first[at : at + 4096] + i, first[at : at + 4096] + k
                    reach = []
                    for side in (left, right):
                        differs = side[a] != side[b]
                        reach.append(np.where(differs.any(axis=1), differs.argmax(axis=1), half))
                    lo = np.maximum(np.maximum(low[a], low[b]), half - reach[1])
                    hi = np.minimum(np.minimum(high[a], high[b]), reach[0])
                    good = lo <= hi
                    for m in (a[good], b[good]):
                        np.add.at(change, (m, lo[good]), 1)
                        np.add.at(change, (m, hi[good] + 1), -1)
    return np.cumsum(change, axis=1)[:, : half + 1] > 0


def _sides(spots: list[bytes], back: np.ndarray, number: np.ndarray, half: int) -> tuple[np.ndarray, np.ndarray]:
    """Left and right contexts as matrices; bytes outside a run's windows are 0 and not looked at."""
    left, right = np.zeros((len(spots), half), np.uint8), np.zeros((len(spots), half), np.uint8)
    for m, spot in enumerate(spots):
        data, b = np.frombuffer(spot, np.uint8), back[m]
        left[m, :b] = data[:b][::-1]
        tail = data[b + half :]
        right[m, : len(tail)] = tail
    return left, right


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, spans, kept), one for each row of `docs`.

    Every byte goes that a string of `length` bytes covers which also starts anywhere else in the corpus, the same text
    included; overlaps count, matches never cross texts, and all strings are judged on the input. spans are the maximal
    runs removed as (start, stop) in UTF-8 bytes, kept the bytes left (binary, since a cut may fall into a character).

    Window starts fall into runs by their cover sample, about two in a hundred bytes, and only buckets with more than one
    run go on. Runs whose bytes are all equal are repeated as a whole. One run of each kind in a mixed bucket sends the bytes
    it touches, and one bucket at a time is sorted. A bucket of more than BUCKET kinds is not sorted in one
    task: its windows are counted by their hash, over all tasks. Null and short texts keep all. Equal rows, with equal
    ids too, are repeats of one another. Other columns are not read.
    """
    half = length // 2
    plain = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text")).withColumn("k", F.xxhash64("text"))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    spot = ("doc_id", "k")

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                rows, cols = [], [[] for _ in range(6)]
                for row, text in enumerate(part.column(1)):
                    if not text.is_valid:
                        continue
                    bucket, run, start, number, back = cover_runs(np.frombuffer(text.as_buffer(), np.uint8), length)
                    if not len(bucket):
                        continue
                    # Of runs alike within a text one goes on, as two; the others are known to be repeated.
                    _, first, same, times = np.unique(run, return_index=True, return_inverse=True, return_counts=True)
                    own = times[same] > 1
                    begin, end = merged(start[own], (start + number)[own])
                    found = (
                        np.concatenate([bucket[first].view(np.int64), np.zeros(len(begin), np.int64)]),
                        np.concatenate([run[first].view(np.int64), np.zeros(len(begin), np.int64)]),
                        np.concatenate([start[first], begin]),
                        np.concatenate([number[first], end - begin]),
                        np.concatenate([back[first], np.zeros(len(begin), np.int64)]),
                        np.concatenate([np.minimum(times, 2), np.zeros(len(begin), np.int64)]),
                    )
                    rows.append(np.full(len(found[0]), row))
                    for column, values in zip(cols, found, strict=True):
                        column.append(values)
                none = np.zeros(0, np.int64)
                at = pa.array(np.concatenate([none, *rows]).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(2).take(at), *[pa.array(np.concatenate([none, *c]), pa.int64()) for c in cols]],
                    [*spot, "bucket", "run", "start", "number", "back", "n"],
                )

    runs = staged(
        plain.mapInArrow(sample, f"doc_id {id_type}, k long, bucket long, run long, start long, number long, back long, n long"), "runs"
    )
    open_runs = runs.where("n > 0")
    shared = staged(open_runs.groupBy("bucket").agg(F.sum("n").alias("total")).where("total > 1").select("bucket"), "buckets")
    open_runs = staged(open_runs.join(shared, "bucket", "left_semi"), "shared-runs")
    kinds = staged(
        open_runs.groupBy("bucket", "run").agg(F.sum("n").alias("n"), F.min(F.struct(*spot, "start", "number", "back")).alias("first")), "kinds"
    )
    whole = open_runs.join(kinds.where("n > 1").select("bucket", "run"), ["bucket", "run"], "left_semi")
    mixed_buckets = staged(
        kinds.groupBy("bucket").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("bucket", "kinds"), "mixed"
    )
    wanted = kinds.join(mixed_buckets, "bucket").groupBy(F.col("first.doc_id").alias("doc_id"), F.col("first.k").alias("k")).agg(
        F.collect_list(F.struct("bucket", "kinds", "n", "first.start", "first.number", "first.back")).alias("wanted")
    )

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                rows, fields, spots = [], [], []
                for row, (text, asked) in enumerate(zip(part.column(1), part.column(3).to_pylist(), strict=True)):
                    data = text.as_buffer().to_pybytes()
                    for ask in asked:
                        rows.append(row)
                        fields.append(ask)
                        spots.append(data[ask["start"] : ask["start"] + ask["number"] - 1 + length])
                at = pa.array(rows, pa.int64())
                names = ("bucket", "kinds", "n", "start", "number", "back")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(2).take(at), *[pa.array([f[c] for f in fields], pa.int64()) for c in names], pa.array(spots, pa.binary())],
                    [*spot, *names, "bytes"],
                )

    asked = staged(wanted, "wanted").hint("merge")
    beside = plain.join(asked, plain["doc_id"].eqNullSafe(asked["doc_id"]) & (plain["k"] == asked["k"])).select(plain["doc_id"], "text", plain["k"], "wanted")
    context = staged(
        beside.mapInArrow(
            contexts, f"doc_id {id_type}, k long, bucket long, kinds long, n long, start long, number long, back long, bytes binary"
        ),
        "contexts",
    )

    def sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not table.num_rows:
                continue
            joined = table.to_batches()[0]
            bucket = joined.column(2).to_numpy()
            done = int(np.searchsorted(bucket, bucket[-1]))
            yield solved(joined.slice(0, done))
            rest = joined.slice(done)
        if rest is not None:
            yield solved(rest)

    def solved(batch: pa.RecordBatch) -> pa.RecordBatch:
        bucket, n, start, number, back = (batch.column(k).to_numpy() for k in (2, 4, 5, 6, 7))
        out: list[list[np.ndarray]] = [[], [], []]
        begin = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(begin, len(bucket)))
        small = sizes <= PAIRWISE
        blocks = []  # row numbers of either many small buckets or a single large one
        if small.any():
            groups = np.flatnonzero(small)
            for some in np.split(groups, np.flatnonzero(np.diff(np.cumsum(sizes[groups]) // 8192)) + 1):
                blocks.append((np.concatenate([np.arange(begin[g], begin[g] + sizes[g]) for g in some]), sizes[some]))
        blocks += [(np.arange(begin[g], begin[g] + sizes[g]), None) for g in np.flatnonzero(~small)]
        for rows, parts in blocks:
            taken = batch.take(pa.array(rows))
            left, right = _sides(taken.column(8).to_pylist(), back[rows], number[rows], half)
            low, high = back[rows] - number[rows] + 1, back[rows]
            if parts is None:
                found = repeated_offsets(left, right, low, high)
            else:
                found = repeated_pairwise(left, right, low, high, np.cumsum(parts) - parts, parts)
            found[n[rows] > 1] = False  # known already
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, first = np.nonzero(edge == 1)
            _, last = np.nonzero(edge == -1)
            # offset a stands for the window that starts a bytes before the sample
            out[0].append(rows[row])
            out[1].append(start[rows[row]] + back[rows[row]] - last + 1)
            out[2].append(last - first)
        none = np.zeros(0, np.int64)
        at = pa.array(np.concatenate([none, *out[0]]))
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate([none, *out[1]])), pa.array(np.concatenate([none, *out[2]]))],
            [*spot, "start", "number"],
        )

    usual = context.where(F.col("kinds") <= BUCKET).repartition("bucket").sortWithinPartitions("bucket", "start", "k")
    starts = [
        runs.where("n = 0").select(*spot, "start", "number"),
        whole.select(*spot, "start", "number"),
        usual.mapInArrow(sort_buckets, f"doc_id {id_type}, k long, start long, number long"),
    ]
    if mixed_buckets.where(F.col("kinds") > BUCKET).take(1):
        starts.append(_counted_windows(context.where(F.col("kinds") > BUCKET), id_type, length))
    every = starts[0]
    for more in starts[1:]:
        every = every.union(more)
    cuts = staged(every.groupBy(*spot).agg(F.collect_list(F.struct("start", "number")).alias("cuts")), "cuts").hint("merge")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                sizes, gone, spans, kept = [], [], [], []
                for text, cuts_of in zip(part.column(1), part.column(2), strict=True):
                    data = text.as_buffer().to_pybytes() if text.is_valid else b""
                    begin = end = np.zeros(0, np.int64)
                    if cuts_of.is_valid:
                        begin = cuts_of.values.field("start").to_numpy()
                        begin, end = merged(begin, begin + cuts_of.values.field("number").to_numpy() - 1 + length)
                    edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(data)]
                    sizes.append(len(data))
                    gone.append(int((end - begin).sum()))
                    spans.append([{"start": a, "stop": b} for a, b in zip(begin.tolist(), end.tolist(), strict=True)])
                    kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(gone, pa.int64()),
                        pa.array([len(s) for s in spans], pa.int64()),
                        pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                        pa.array(kept, pa.binary()),
                    ],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"],
                )

    final = plain.join(cuts, plain["doc_id"].eqNullSafe(cuts["doc_id"]) & (plain["k"].eqNullSafe(cuts["k"])), "left")
    return final.select(plain["doc_id"], "text", "cuts").mapInArrow(
        cut, f"doc_id {id_type}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept binary"
    )


def _counted_windows(context: DataFrame, id_type: str, length: int) -> DataFrame:
    """Repeated windows of the runs given: each window is a row with two hashes, counted before the shuffle."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 2048):
                part = batch.slice(k, 2048)
                start, number = part.column(5).to_numpy(), part.column(6).to_numpy()
                one, two = [], []
                for spot in part.column(8).to_pylist():
                    roll = Rolling(np.frombuffer(spot, np.uint8))
                    size = len(spot) - length + 1
                    value = roll.of(slice(0, size), slice(length, length + size))
                    head = roll.of(slice(0, size), slice(length // 3, length // 3 + size))
                    one.append(value)
                    two.append(mixed(head ^ np.uint64(0x5851F42D4C957F2D)))
                at = pa.array(np.repeat(np.arange(part.num_rows), number))
                place = np.repeat(start, number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(at),
                        part.column(1).take(at),
                        pa.array(place),
                        pa.array(part.column(4).to_numpy().repeat(number)),
                        pa.array(np.concatenate(one).view(np.int64)),
                        pa.array(np.concatenate(two).view(np.int64)),
                    ],
                    ["doc_id", "k", "start", "n", "one", "two"],
                )

    windows = staged(context.mapInArrow(explode, f"doc_id {id_type}, k long, start long, n long, one long, two long"), "windows")
    often = staged(windows.groupBy("one", "two").agg(F.count("*").alias("c")).where("c > 1").select("one", "two"), "often")
    return windows.where("n = 1").join(often, ["one", "two"], "left_semi").select("doc_id", "k", "start", F.lit(1).cast("long").alias("number"))
