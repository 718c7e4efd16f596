"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import mixed, staged, text_slices, two_columns, word_hashes

GRAM = 3
# A seed's expected place in a million words is the only one, or it is in the rarer half of its item's grams.
RARE, SEED_SHARE = 1e-6, 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD = 0.5
# Bits of the sieves that hold back what cannot meet a word or seed of the benchmark; a fixed size, so full ones only let
# more rows into the joins behind them.
SIEVE_BITS = 1 << 22


def grams(words: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Hash of the n words from each place on."""
    size = max(0, len(words) - n + 1)
    value = np.zeros(size, np.uint64)
    for k in range(n):
        value = mixed(value * np.uint64(31) + words[k : k + size])
    return value


def sieve_of(values: DataFrame, column: str) -> np.ndarray:
    """Marks of the slots that the distinct values of a long column fall into: at most SIEVE_BITS bits reach the driver."""
    slot = F.pmod(F.col(column), F.lit(SIEVE_BITS)) + 1
    bits = values.groupBy(F.bitmap_bucket_number(slot).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
    held = np.zeros(SIEVE_BITS, bool)
    for r in bits.collect():
        own = np.unpackbits(np.frombuffer(bytes(r.bits), np.uint8), bitorder="little").astype(bool)
        start = (r.part - 1) * len(own)
        held[start : start + len(own)] = own[: SIEVE_BITS - start]
    return held


def passing(sieve: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Places of the hashes that the sieve lets through."""
    return np.flatnonzero(sieve[values & np.uint64(SIEVE_BITS - 1)])


def word_shares(docs: DataFrame, held: DataFrame) -> DataFrame:
    """Rows (w, share): the share of each word (column w of `held`) in all words of all documents (column text)."""
    sieve = sieve_of(held, "w")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words, _ = word_hashes(part.column("text"))
                found, times = np.unique(words[passing(sieve, words)], return_counts=True)
                w = pa.array([*found.view(np.int64).tolist(), None], pa.int64())
                yield pa.RecordBatch.from_arrays([w, pa.array(np.append(times, len(words)), pa.int64())], ["w", "n"])

    counts = staged(docs.select("text").mapInArrow(count, "w long, n long").groupBy("w").agg(F.sum("n").alias("n")), "word-counts")
    total = counts.where("w IS NULL").first()
    share = F.coalesce(F.col("n"), F.lit(0)) / F.lit(float(max(1, total.n if total else 1)))
    return held.join(counts, "w", "left").select("w", share.alias("share"))


def rare_seeds(words: np.ndarray, shares: np.ndarray, rare: float, least: float) -> np.ndarray:
    """The item's grams that are rare by the corpus shares of their words, and its rarest ones at least.

    A gram is rare if the product of its words' shares is at most `rare`. That does not grow with the number of copies of an
    item, as a count of the gram itself would, so the seeds of a much copied item stay.
    """
    value = np.prod([shares[j : len(words) - GRAM + 1 + j] for j in range(GRAM)], axis=0)
    found, first = np.unique(grams(words), return_index=True)
    value = value[first]
    keep = value <= rare
    keep[np.argsort(value, kind="stable")[: int(np.ceil(len(found) * least))]] = True
    return found[keep]


def alignments(item: np.ndarray, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best Smith-Waterman score of the item against each row of `passages`, and the column it ends in.

    Passages are padded with 0, which equals no word. Gaps cost by length, so a row's gaps are a running maximum.
    """
    n, width = passages.shape
    slope = np.arange(1, width + 1, dtype=np.int32) * -GAP
    above = np.zeros((n, width + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    for word in item:
        fit = np.where(passages == word, MATCH, MISMATCH).astype(np.int32)
        row = np.maximum(np.maximum(above[:, :-1] + fit, above[:, 1:] + GAP), 0)
        row = np.maximum.accumulate(row + slope, axis=1) - slope
        above[:, 1:] = row
        column = row.argmax(axis=1)
        top = row[np.arange(n), column]
        better = top > best
        best[better], end[better] = top[better], column[better]
    return best, end


def benchmark_items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (item, item_id, words, item_times): distinct items, with how often each stands in the benchmark.

    Those of fewer words than a gram are left out: nothing would tell a copy of them from chance.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, starts = word_hashes(batch.column("text"))
            lists = [words[a:b].view(np.int64) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int64()))], ["item_id", "words"])

    plain = two_columns(benchmark, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()
    lists = plain.mapInArrow(hashed, f"item_id {id_type}, words array<long>").where(F.size("words") >= GRAM)
    each = lists.groupBy("item_id", "words").agg(F.count("*").alias("item_times"))
    return staged(each.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words", "item_times"), "items")


def seed_table(items: DataFrame, docs: DataFrame, rare: float, least: float) -> DataFrame:
    """Rows (gram, item, size): the seeds of each item, and how many words it has."""
    places = items.select("item", F.posexplode("words").alias("at", "w"))
    shares = word_shares(docs, staged(places.select("w").distinct(), "item-words"))
    sorted_shares = F.transform(F.sort_array(F.collect_list(F.struct("at", "share"))), lambda p: p["share"])
    known = places.join(shares, "w").groupBy("item").agg(sorted_shares.alias("shares"))

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, item, size = [], [], []
            for key, words, own in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = np.array(words, np.int64).view(np.uint64)
                new = rare_seeds(words, np.array(own), rare, least)
                found += new.view(np.int64).tolist()
                item += [key] * len(new)
                size += [len(words)] * len(new)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(item, pa.int64()), pa.array(size, pa.int32())], ["gram", "item", "size"])

    rows = items.select("item", "words").join(known, "item")
    return staged(rows.mapInArrow(seeds, "gram long, item long, size int"), "seeds")


def seeded_places(docs: DataFrame, seeds: DataFrame) -> DataFrame:
    """Distinct rows (key, gram, at): the places of documents (key, text) whose gram may be a seed."""
    sieve = sieve_of(seeds, "gram")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words, starts = word_hashes(part.column("text"))
                value = grams(words)
                at = passing(sieve, value)
                doc = np.searchsorted(starts, at, side="right") - 1
                whole = at + GRAM <= starts[doc + 1]
                at, doc = at[whole], doc[whole]
                columns = [part.column(0).take(pa.array(doc)), pa.array(value[at].view(np.int64)), pa.array(at - starts[doc])]
                yield pa.RecordBatch.from_arrays(columns, ["key", "gram", "at"])

    return docs.mapInArrow(search, "key string, gram long, at long").distinct()


def passages(docs: DataFrame) -> DataFrame:
    """Rows (key, item, low, words) out of (key, text, hits of (item, size, at)): passages about seeds that lie close together."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                words, starts = word_hashes(part.column("text"))
                rows, items, lows, lists = [], [], [], []
                for row, hits in enumerate(part.column("hits").to_pylist()):
                    own = words[starts[row] : starts[row + 1]].view(np.int64)
                    last = None
                    for item, size, at in sorted((h["item"], h["size"], h["at"]) for h in hits):
                        if last and last[0] == item and at - last[2] <= size:
                            last[2] = at
                            continue
                        if last:
                            spans(rows, items, lows, lists, row, last, own)
                        last = [item, at, at, size]
                    if last:
                        spans(rows, items, lows, lists, row, last, own)
                columns = [pa.array(items, pa.int64()), pa.array(lows, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(rows, pa.int64())), *columns], ["key", "item", "low", "words"])

    def spans(rows: list, items: list, lows: list, lists: list, row: int, found: list, own: np.ndarray) -> None:
        item, first, last, size = found
        low = max(first - size, 0)
        rows.append(row)
        items.append(item)
        lows.append(low)
        lists.append(own[low : last + GRAM + size])

    return docs.mapInArrow(cut, "key string, item long, low long, words array<long>")


def aligned(pairs: DataFrame, threshold: float) -> DataFrame:
    """Rows (key, item, score, low, end_word) of passages (key, item, low, words, item_words) that reach the threshold."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item, low = batch.column("item").to_numpy(), batch.column("low").to_numpy()
            texts, owns = batch.column("words"), batch.column("item_words")
            sizes = pa.compute.list_value_length(texts).to_numpy()
            order = np.lexsort((sizes, item))
            score, end = np.zeros(len(item)), np.zeros(len(item), np.int64)
            k = 0
            while k < len(order):  # passages of one item and of like width are aligned at once
                stop = k + 1
                while stop < len(order) and stop - k < 512 and item[order[stop]] == item[order[k]] and sizes[order[stop]] <= 2 * sizes[order[k]]:
                    stop += 1
                some = order[k:stop]
                own = owns[int(some[0])].values.to_numpy().view(np.uint64)
                table = np.zeros((len(some), max(1, int(sizes[some].max()))), np.uint64)
                for row, place in enumerate(some):
                    table[row, : sizes[place]] = texts[int(place)].values.to_numpy().view(np.uint64)
                best, column = alignments(own, table)
                score[some], end[some] = best / (MATCH * len(own)), low[some] + column + 1
                k = stop
            good = pa.array(np.flatnonzero(score >= threshold))
            columns = [batch.column("key"), batch.column("item"), pa.array(score), batch.column("low"), pa.array(end)]
            yield pa.RecordBatch.from_arrays([c.take(good) for c in columns], ["key", "item", "score", "low", "end_word"])

    return pairs.mapInArrow(align, "key string, item long, score double, low long, end_word long")


def contaminations(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    seed_share: float = SEED_SHARE,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Rows (doc_id, item_id, score, end_word): documents that hold a benchmark item, copied or edited.

    Words are letters, digits and underscores, lower-cased. An item's 3-grams that are rare by the word counts of the whole
    corpus, and always its rarer half, are its seeds; items of fewer than three words match nothing. Seeds and the grams of all
    documents meet in a join, which a sieve of fixed size keeps small; the passage around the seeds that lie close together,
    wider than the item on both sides, meets the item in another and is aligned (match 2, mismatch and gap -1). The score
    is the best alignment's over that of the item with itself, 1 for an exact copy; end_word is the place after its last word
    (ties: the first place). Neither the benchmark nor the documents pass through the driver. Null and empty texts hold
    nothing. Repeated document rows are answered each, repeated item rows too.
    """
    own_id, own_text = docs[id_col], docs[text_col]
    named = F.coalesce(own_id.cast("string"), F.lit("")), own_id.isNull().cast("string"), F.md5(own_text)
    plain = docs.where(own_text.isNotNull()).select(F.md5(F.concat_ws("\0", *named)).alias("key"), own_id.alias("doc_id"), own_text.alias("text"))
    items = benchmark_items(benchmark, item_id_col, item_text_col)
    seeds = seed_table(items, plain, RARE, seed_share)
    places = staged(seeded_places(plain.select("key", "text"), seeds), "seeded-places")
    hits = places.join(seeds, "gram").groupBy("key").agg(F.collect_list(F.struct("item", "size", "at")).alias("hits"))
    hits = staged(hits, "hits")
    found = plain.join(hits, "key")
    cut = staged(passages(found.select("key", "text", "hits")), "passages")
    pairs = cut.join(items.select("item", F.col("words").alias("item_words")), "item").select("key", "item", "low", "words", "item_words")
    best = aligned(pairs, threshold).groupBy("key", "item").agg(F.min(F.struct(-F.col("score"), "low", "end_word")).alias("best"))
    best = staged(best.select("key", "item", (-F.col("best.col1")).alias("score"), F.col("best.end_word").alias("end_word")), "aligned")
    # Equal rows were one until here; ids come from the rows.
    rows = found.select("key", "doc_id").join(best, "key").join(items.select("item", "item_id", "item_times"), "item")
    return rows.select("doc_id", "item_id", "score", "end_word", F.explode(F.sequence(F.lit(1), F.col("item_times").cast("int"))).alias("_")).drop("_")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item, as they are; each row is judged by its own text.

    Rows that share an id do not share their fate; rows without id are judged too. Null and empty texts stay.
    """
    keyed = docs.select(F.coalesce(F.md5(docs[text_col]), F.lit("")).alias("same"), docs[text_col].alias("text"))
    bad = staged(contaminations(keyed, benchmark, "same", "text").select("doc_id").distinct(), "contaminated")
    return docs.join(bad, F.coalesce(F.md5(docs[text_col]), F.lit("")) == bad["doc_id"], "left_anti")
