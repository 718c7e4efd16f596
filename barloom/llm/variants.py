"""Spelling variants of the corpus's words, found by bidirectional FM-index search schemes."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import staged, text_slices, two_columns

LEAST_CHARS, LEAST_COUNT = 6, 5
# One run in NOISE of the (document, run) pairs loses a code point; a form occurs FORM_TIMES as often as its variant.
NOISE, FORM_TIMES = 199, 5
# Words of one index, words drawn for each index to find its borders, words counted in a task before they are sent on.
BLOCK, DRAWN, HELD = 8192, 8, 300_000
# States of a search that are held at once, and tasks that search.
FRONT, MOST_TASKS = 1 << 16, 20_000
# Runs are of A-Z, a-z and U+00C0 to U+00FF: latin-1 bytes, of which only A-Z become small; all others part runs.
SMALL = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
LETTERS = bytes([0, *range(97, 123), *range(0xC0, 0x100)])  # 0 delimits words
CODE = np.zeros(256, np.uint8)
CODE[list(LETTERS)] = np.arange(len(LETTERS))


def document_words(doc_id: str, text: str) -> Counter:
    """Counts of the words of one text, in latin-1: small-letter runs, of which one in `NOISE` by hash loses a code point."""
    seed = zlib.crc32(f"{doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(text.encode("latin-1", "replace").translate(SMALL).split()).items():
        hashed = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if hashed % NOISE == 0:
            k = hashed % len(run)
            run = run[:k] + run[k + 1 :]
        if len(run) >= LEAST_CHARS:
            out[run] += n
    return out


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, n) of the words with at least `LEAST_CHARS` code points and `LEAST_COUNT` occurrences in all texts."""
    plain = two_columns(docs, id_col, text_col).select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in text_slices(batch):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                    held.update(document_words(doc_id, text.as_py() or ""))
                if len(held) > HELD:
                    yield word_counts(held)
                    held = Counter()
        yield word_counts(held)

    rows = plain.mapInArrow(counted, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def word_counts(held: Counter) -> pa.RecordBatch:
    words = pa.array([w.decode("latin-1") for w in held], pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])


class RankedText:
    """Wavelet matrix of a sequence of small codes: occurrences of a code before a place, and of smaller codes."""

    def __init__(self, codes: np.ndarray, bits: int):
        self.bits = bits
        self.zeros, self.ranks = [], []
        for level in range(bits - 1, -1, -1):
            ones = (codes >> level & 1).astype(bool)
            self.ranks.append(np.concatenate([[0], np.cumsum(ones)]).astype(np.int32))
            self.zeros.append(len(codes) - int(self.ranks[-1][-1]))
            codes = np.concatenate([codes[~ones], codes[ones]])

    def one(self, lo: np.ndarray, hi: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """How often each `code` stands before lo and before hi, and how many smaller codes stand from lo to hi."""
        start, smaller = np.zeros_like(lo), np.zeros_like(lo)
        for level, (zeros, ranks) in enumerate(zip(self.zeros, self.ranks, strict=True)):
            a, b, s = ranks[lo], ranks[hi], ranks[start]
            bit = (code >> (self.bits - 1 - level) & 1).astype(bool)
            smaller += np.where(bit, (hi - lo) - (b - a), 0)
            lo, hi = np.where(bit, zeros + a, lo - a), np.where(bit, zeros + b, hi - b)
            start = np.where(bit, zeros + s, start - s)
        return lo - start, hi - start, smaller

    def all(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, ...]:
        """For every code that stands from lo to hi of each row: (row, code, before lo, before hi, smaller codes)."""
        row = np.arange(len(lo))
        code, smaller, start = (np.zeros(len(lo), np.int64) for _ in range(3))
        for zeros, ranks in zip(self.zeros, self.ranks, strict=True):
            a, b, s = ranks[lo], ranks[hi], ranks[start]
            left, right = (hi - lo) > (b - a), b > a
            code = np.concatenate([code[left] * 2, code[right] * 2 + 1])
            smaller = np.concatenate([smaller[left], (smaller + (hi - lo) - (b - a))[right]])
            row = np.concatenate([row[left], row[right]])
            start = np.concatenate([(start - s)[left], (zeros + s)[right]])
            lo, hi = np.concatenate([(lo - a)[left], (zeros + a)[right]]), np.concatenate([(hi - b)[left], (zeros + b)[right]])
        return row, code, lo - start, hi - start, smaller


@dataclass
class Front:
    """Patterns being matched: ranks of the suffixes that begin with the matched part, in the text (lo) and in its mirror
    (mirror), their number, the word that asks, how many of its code points are left, and whether an error is spent."""

    lo: np.ndarray
    mirror: np.ndarray
    size: np.ndarray
    word: np.ndarray
    left: np.ndarray
    spent: np.ndarray

    def where(self, which: np.ndarray) -> Front:
        return Front(*(v[which] for v in vars(self).values()))

    def on(self, read: int, spent: bool) -> Front:
        """The same with `read` more code points of the word dealt with, and the error spent where `spent`."""
        return Front(self.lo, self.mirror, self.size, self.word, self.left - read, self.spent | spent)

    @staticmethod
    def of(parts: list[Front]) -> Front:
        return Front(*(np.concatenate(v) for v in zip(*(vars(p).values() for p in parts), strict=True)))


class BidirectionalIndex:
    """FM-index of delimited words and of their mirrored text; a match can be extended to either side.

    The text is 0 w1 0 w2 0 ... 0 of the words in order. The suffixes that begin with a delimiter stand first and in the
    order of the words, the last one alone before them, so a word's number is the rank of its suffix less one; ranks in
    the mirrored text count words in the order of their mirror images.
    """

    def __init__(self, words: list[bytes]):
        text = CODE[np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)]
        self.bits = len(LETTERS).bit_length()
        self.count = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << self.bits))])
        self.length = len(text)
        self.forward = RankedText(last_column(text), self.bits)
        self.mirrored = RankedText(last_column(text[::-1]), self.bits)

    def everything(self, word: np.ndarray, left: np.ndarray) -> Front:
        none = np.zeros(len(word), np.int64)
        return Front(none, none, none + self.length, word, left, none.astype(bool))

    def extended(self, front: Front, code: np.ndarray, to_left: bool) -> Front:
        """Each pattern with one more code before it (or after it); patterns that stand nowhere go."""
        side = self.forward if to_left else self.mirrored
        lo, mirror = (front.lo, front.mirror) if to_left else (front.mirror, front.lo)
        a, b, smaller = side.one(lo, lo + front.size, code)
        lo, mirror = self.count[code] + a, mirror + smaller
        lo, mirror = (lo, mirror) if to_left else (mirror, lo)
        out = Front(lo, mirror, b - a, front.word, front.left, front.spent)
        return out.where(out.size > 0)

    def branches(self, front: Front, to_left: bool) -> tuple[Front, np.ndarray]:
        """Every pattern with each code that stands before it (or after it), and those codes."""
        side = self.forward if to_left else self.mirrored
        lo, mirror = (front.lo, front.mirror) if to_left else (front.mirror, front.lo)
        row, code, a, b, smaller = side.all(lo, lo + front.size)
        lo, mirror = self.count[code] + a, mirror[row] + smaller
        lo, mirror = (lo, mirror) if to_left else (mirror, lo)
        return Front(lo, mirror, b - a, front.word[row], front.left[row], front.spent[row]), code


def last_column(text: np.ndarray) -> np.ndarray:
    """Burrows-Wheeler transform of a text of words within delimiters; equal delimited words are in the order of places.

    Suffixes are sorted by doubling; a run from a delimiter to the next decides all, as words are distinct.
    """
    rank, width = text.astype(np.int64), 1
    while True:
        after = np.full(len(rank), -1)
        after[: len(rank) - width] = rank[width:]
        order = np.lexsort((after, rank))
        new = np.empty_like(rank)
        new[order] = np.cumsum(np.concatenate([[0], (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)]))
        if new.max() == len(rank) - 1:
            return text[order - 1]
        rank, width = new, width * 2


def near_words(index: BidirectionalIndex, asking: list[bytes], mirrored: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (number in `asking`, number in the index) at one edit behind the half that both begin with.

    The search scheme of each asking word: its first half is matched exactly, from the middle back to the delimiter; then
    the match is extended over the other half to the closing delimiter, one error allowed at any place. The interval of a
    whole match is one suffix, whose rank is the word's number.
    """
    sizes = np.array([len(w) for w in asking])
    codes = CODE[np.frombuffer(b"".join(asking), np.uint8)].astype(np.int64)
    begin = np.cumsum(sizes) - sizes
    half = np.array([half_of(w, mirrored) for w in asking])
    front = index.everything(np.arange(len(asking)), half)
    while (on := front.left >= 0).any():
        done, step = front.where(~on), front.where(on)
        code = np.where(step.left > 0, codes[begin[step.word] + np.maximum(step.left - 1, 0)], 0)
        step = index.extended(step, code, to_left=True)
        step.left = step.left - 1
        front = Front.of([done, step])
    front.left = (sizes - half)[front.word]

    def next_code(front: Front) -> np.ndarray:
        """The next letter of the word that asks, or the delimiter behind its end."""
        place = sizes[front.word] - np.maximum(front.left, 1)
        return np.where(front.left == 0, 0, codes[begin[front.word] + place])

    asks, found = [], []
    todo = [front]
    while todo:
        front = todo.pop()
        if len(front.lo) > FRONT:
            middle = len(front.lo) // 2
            todo += [front.where(np.s_[middle:]), front.where(np.s_[:middle])]
            continue
        if not len(front.lo):
            continue
        spent, free = front.where(front.spent), front.where(~front.spent)
        spent = index.extended(spent, next_code(spent), to_left=False)
        whole = spent.left == 0  # that was the closing delimiter
        asks.append(spent.word[whole])
        found.append(spent.lo[whole])
        spent = spent.where(~whole).on(1, False)
        more, code = index.branches(free, to_left=False)
        inside, same = more.left > 0, code == next_code(more)
        other = ~same & (code > 0)
        todo.append(
            Front.of(
                [
                    spent,
                    free.where(free.left > 0).on(1, True),  # a letter of the word left out
                    more.where(inside & same).on(1, False),
                    more.where(inside & other).on(1, True),  # another in its place
                    more.where(other).on(0, True),  # another before it
                ]
            )
        )
    # The first suffix is the closing delimiter alone.
    pairs = np.unique(np.stack([np.concatenate(asks), np.concatenate(found) - 1], axis=1), axis=0) if asks else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def half_searches(words: DataFrame, mirrored: bool) -> DataFrame:
    """Rows (word, n_near, best_n, best) of the near words of each word that share its first half (mirrored: its last).

    Words are indexed in blocks of some `BLOCK` that follow one another in order, so all words with one beginning stand in
    one block or in neighbours, and only those are searched. The mirrored search leaves out what the other has found.
    """
    key = F.reverse("word") if mirrored else F.col("word")
    own = words.select(key.alias("key"), "n")
    blocks = -(-own.count() // BLOCK)
    # Words drawn by their hash mark the borders of blocks: DRAWN strings for each block, whatever the text's size.
    drawn = sorted(r.key for r in own.where(F.pmod(F.xxhash64("key"), F.lit(BLOCK // DRAWN)) == 0).select("key").collect()) if blocks > 1 else []
    borders = drawn[DRAWN - 1 :: DRAWN]

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = np.array(borders, dtype=object)
        for batch in batches:
            keys = batch.column(0).to_pylist()
            home = np.searchsorted(marks, np.array(keys, object), "right")
            begin = np.array([k[: half_of(k, mirrored)] for k in keys], object)
            first = np.searchsorted(marks, begin, "right") if len(keys) else home
            last = np.searchsorted(marks, begin + "\uffff", "right") if len(keys) else home
            visits = last - first + 1
            row = np.repeat(np.arange(len(keys)), visits)
            at = np.arange(len(row)) - np.repeat(np.cumsum(visits) - visits, visits) + first[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([home, at]), pa.int32()),
                    pa.array(np.concatenate([np.zeros(len(keys), bool), np.ones(len(row), bool)])),
                    pa.concat_arrays([batch.column(0), batch.column(0).take(pa.array(row))]),
                    pa.concat_arrays([batch.column(1), batch.column(1).take(pa.array(row))]),
                ],
                ["block", "asks", "key", "n"],
            )

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, members, counts, index = None, [], [], None
        for batch in batches:
            blocks_, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.concatenate([[True], (np.diff(blocks_) != 0) | (np.diff(asks.astype(int)) != 0)]))
            for start, stop in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
                keys = batch.column(2).slice(start, stop - start).to_pylist()
                n = batch.column(3).slice(start, stop - start).to_numpy()
                if blocks_[start] != block:
                    block, members, counts, index = blocks_[start], [], [], None
                if not asks[start]:
                    members += keys
                    counts.append(n)
                elif members:
                    index = index or BidirectionalIndex([w.encode("latin-1") for w in members])
                    yield best_near(index, members, np.concatenate(counts), keys, mirrored)

    rows = own.mapInArrow(dealt, "block int, asks boolean, key string, n long")
    # Words before those who ask, so that a task holds the words of one block and passes the others by. The searches cost
    # far more than their bytes say, so the number of tasks follows the blocks and is not left to AQE.
    ordered = rows.repartition(max(1, min(blocks, MOST_TASKS)), "block").sortWithinPartitions("block", "asks", "key")
    return ordered.mapInArrow(searched, "word string, n_near long, best_n long, best string")


def half_of(key: str | bytes, mirrored: bool) -> int:
    """Length of the half that is matched exactly: the first half of a word, the longer half of a mirrored one."""
    return len(key) - len(key) // 2 if mirrored else len(key) // 2


def best_near(
    index: BidirectionalIndex, members: list[str], counts: np.ndarray, asking: list[str], mirrored: bool
) -> pa.RecordBatch:
    """Rows (word, n_near, best_n, best) for the asking words that have near words among the members."""
    who, what = near_words(index, [w.encode("latin-1") for w in asking], mirrored)
    if mirrored and len(who):  # a pair that shares the first half too has been found there
        new = [not members[b].endswith(asking[a][half_of(asking[a], True) :]) for a, b in zip(who, what, strict=True)]
        who, what = who[new], what[new]
    plain = np.array([w[::-1] if mirrored else w for w in members], object)
    out = []
    starts = np.flatnonzero(np.diff(who, prepend=-1))
    for start, stop in zip(starts, np.append(starts[1:], len(who))[: len(starts)], strict=True):
        near = what[start:stop]
        most = counts[near].max()
        word = asking[who[start]]
        out.append((word[::-1] if mirrored else word, stop - start, int(most), min(plain[near[counts[near] == most]])))
    names, types = ["word", "n_near", "best_n", "best"], [pa.string(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names)


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, n, n_near, form, form_n, root), one for each word of the vocabulary.

    Near words differ by one inserted, deleted or replaced code point. A word's form is its near word that occurs most (of
    equals the first by code point), if it occurs `FORM_TIMES` as often as the word; root is where forms end. Null and
    empty texts have no words; a null id hashes as an empty one; repeated rows count again; an empty table has no words.
    """
    words = staged(vocabulary(docs, id_col, text_col), "vocabulary")
    halves = half_searches(words, False).union(half_searches(words, True))
    # The most occurrences first, then the smallest word: the least of (-n, word).
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    near = halves.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    formed = -F.col("b.less") >= FORM_TIMES * F.col("n")
    found = joined.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(formed, F.col("b.best")).alias("form"),
        F.when(formed, -F.col("b.less")).alias("form_n"),
    )
    found = staged(found, "forms")
    return found.join(roots(found), "word", "left").withColumn("root", F.coalesce("root", "word"))


def roots(found: DataFrame) -> DataFrame:
    """Rows (word, root) of the words that have a form. Each round follows twice as many forms; every step multiplies the
    occurrences by `FORM_TIMES`, so a chain has at most 27 and five rounds reach the end."""
    steps = staged(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "steps")
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        further = steps.join(on, "root", "left")
        moved = F.col("further").isNotNull().alias("moved")
        new = staged(further.select("word", F.coalesce("further", "root").alias("root"), moved), "steps")
        steps = new.select("word", "root")
        if not new.where("moved").take(1):
            return steps
