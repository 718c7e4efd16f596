"""SimHash near-dedup by covering locality-sensitive hashing."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import components, staged, text_slices, two_columns

BITS = 64
SEED = 42
# Fingerprints compared with one another in one task; a larger bucket is split into pairs of blocks.
BLOCK = 2048
UPPER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
WORD = re.compile(rb"[^\x20\x09-\x0d]+")


def shingles(text: str, width: int) -> np.ndarray:
    """Hashes of the word shingles in order; a text of fewer words is one shingle, one without words has none."""
    words = WORD.findall(text.encode().translate(UPPER))
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[: len(words) - width] + 1]).tolist()
    hash_of = xxhash.xxh64_intdigest
    return np.array([hash_of(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)


def fingerprint(text: str, width: int) -> int:
    """Signed 64-bit SimHash of the word shingles, repeats counted; 0 for a text without words."""
    values = shingles(text, width)
    if not len(values):
        return 0
    total = np.zeros(BITS, np.int64)
    for k in range(0, len(values), 1 << 14):
        part = values[k : k + (1 << 14)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(total * 2 > len(values), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4) -> DataFrame:
    """Rows (doc_id, fp): 64-bit SimHash of `width`-word shingles of the whole text, A-Z lower-cased."""
    plain = two_columns(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch):
                found = [fingerprint(t.as_py() or "", width) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    return plain.mapInArrow(hashed, f"doc_id {id_type}, fp long")


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """2^(radius+1) - 1 masks, signed; any two words with at most `radius` differing bits agree under one of them.

    Bit i gets a vector of radius + 1 bits, all non-zero ones in turn. Mask v keeps bit i where the product of v and
    the vector of i is odd. The vectors of up to `radius` differing bits do not span the space, so some v is at right
    angles to all of them, and its mask leaves out every differing bit. Each mask keeps about half the bits.
    """
    size = (1 << (radius + 1)) - 1
    masks = []
    for v in range(1, size + 1):
        mask = sum(1 << i for i in range(bits) if ((i % size + 1) & v).bit_count() & 1)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    return masks


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of differing bits; of unsigned words, since numpy counts the bits of a signed number's magnitude."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is connected by steps of at most `radius` bits; no node has more than 9 of them."""
    left = np.arange(len(values))
    tails, heads = [], []
    while len(left):
        order = [left[:1]]
        left = left[1:]
        front = order[0]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for k in range(0, len(front), 256):
                apart = differing(values[left][None, :], values[front[k : k + 256]][:, None])
                near |= (apart <= radius).any(axis=0)
            front, left = left[near], left[~near]
            order.append(front)
        found = np.concatenate(order)
        if len(found) > 1:
            k = np.arange(1, len(found))
            tails.append(found[k])
            heads.append(found[(k - 1) // 8])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *tails]), np.concatenate([none, *heads])


def near_links(values: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints (column fp) exactly as all pairs within `radius` bits would.

    Each bucket gives a spanning forest of its links instead of all pairs. A bucket of more than `block` fingerprints
    is split: each fingerprint belongs to a block by its hash, and every pair of blocks is compared in a group of its own.
    """
    masks = covering_masks(radius)
    # Each print becomes a row for every mask, so prints are spread before, not the files as they are.
    parts = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = values.repartition(parts, "fp").select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))).select(
        "fp", F.xxhash64("pos", "col").alias("bucket")
    )
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    large = staged(sizes.where(F.col("n") > block).withColumn("blocks", F.ceil(F.col("n") / block).cast("int")), "large")
    split = rows.join(large.select("bucket", "blocks"), "bucket", "left").withColumn(
        "own", F.pmod(F.xxhash64("fp", F.lit(1)), F.coalesce("blocks", F.lit(1))).cast("int")
    )
    other = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)).alias("other")
    paired = split.select("fp", "bucket", "own", other).select(
        "fp", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("grp")
    )
    grouped = paired.repartition("grp").sortWithinPartitions("grp", "fp")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest_g, rest_v = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            g = np.concatenate([rest_g, batch.column(0).to_numpy()])
            v = np.concatenate([rest_v, batch.column(1).to_numpy()])
            if not len(g):
                continue
            whole = np.searchsorted(g, g[-1])  # the last group may go on in the next batch
            yield links(g[:whole], v[:whole])
            rest_g, rest_v = g[whole:], v[whole:]
        yield links(rest_g, rest_v)

    def links(g: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        first = np.ones(len(g), bool)
        first[1:] = g[1:] != g[:-1]
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(g)))
        two = starts[sizes == 2]
        close = two[differing(v[two], v[two + 1]) <= radius]
        us, vs = [v[close]], [v[close + 1]]
        for start, size in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            own = v[start : start + size]
            tail, head = forest(own, radius)
            us.append(own[tail])
            vs.append(own[head])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(us), pa.int64()), pa.array(np.concatenate(vs), pa.int64())], ["u", "v"]
        )

    return grouped.select("grp", "fp").mapInArrow(linked, "u long, v long").distinct()


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """Rows (doc_id, fingerprint, component_id), one for each row of `docs`.

    Fingerprints with at most `radius` differing bits are linked; component_id is the smallest doc_id reachable over
    any number of links. Equal fingerprints are one node, so a group of copies costs one row a table. Null and
    empty texts have fingerprint 0 and are linked like any other. A null id has its own fingerprint and takes part in
    links, but is no component's name while it has another; repeated rows and ids are answered each.
    """
    prints = staged(fingerprints(docs, id_col, text_col, width), "fingerprints")
    return grouped_prints(prints, radius).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def grouped_prints(prints: DataFrame, radius: int) -> DataFrame:
    """Rows (doc_id, fp, component_id), one for each of the staged rows (doc_id, fp)."""
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    joined = components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(joined, nodes["fp"] == joined["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("root")
    )
    rooted = staged(rooted, "rooted")
    names = staged(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "names")
    of_print = staged(rooted.join(names, "root").select("fp", "component_id"), "classes")
    return prints.join(of_print, "fp").select("doc_id", "fp", "component_id")


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, radius: int = 4
) -> DataFrame:
    """One row of each group of near copies: of each component that `near_duplicates` finds.

    The smallest id stays, of rows that share it the one whose text has the smaller MD5, of equal rows any one; rows
    without id come after all others, so that one of them stays only where the whole group has no id. Every row is
    judged by its own text, also where several share an id. Null and empty texts are copies of one another. An empty
    table stays empty; other columns, whatever their names, are kept as they are.
    """
    same = F.coalesce(F.md5(docs[text_col]), F.lit(""))
    key = F.struct(docs[id_col].isNull().alias("none"), docs[id_col].alias("id"), same.alias("same"))
    prints = staged(fingerprints(docs.select(key.alias("doc_id"), docs[text_col].alias("text")), width=width), "fingerprints")
    found = grouped_prints(prints, radius)
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    gone = staged(found.where(~stays).select("doc_id.id", "doc_id.same").distinct(), "gone")
    rest = docs.join(gone, docs[id_col].eqNullSafe(gone["id"]) & (same == gone["same"]), "left_anti")
    again = found.where(stays).groupBy("doc_id").count().where("count > 1").select("doc_id.id", "doc_id.same")
    again = staged(again, "repeated")
    if again.isEmpty():
        return rest
    repeated = rest[id_col].eqNullSafe(again["id"]) & (F.coalesce(F.md5(rest[text_col]), F.lit("")) == again["same"])
    once = rest.join(again, repeated, "left_semi").dropDuplicates([id_col, text_col])
    return rest.join(again, repeated, "left_anti").unionByName(once)
