"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests, compared by subtraction and peeling."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.llm.common import staged

# A paragraph ends at a line's end or after a sentence's or table cell's last sign.
PARAGRAPH_END = r"(?<=[.!?|])\s+|\n+"
TABLES = 3
BASE_WIDTH = 4
LEAST_WIDTH = 12
CELLS_PER_DIGEST = 1.8
PEEL_STEPS = 15
LEAST_KEY = -(1 << 63)


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's non-empty paragraphs."""
    parts = F.filter(F.split(F.coalesce(text, F.lit("")), PARAGRAPH_END), lambda p: p != "")
    return F.array_distinct(F.transform(parts, lambda p: F.xxhash64(p)))


def cell(digest: Column, table: int | Column, width: int | Column, attempt: int = 0) -> Column:
    """The one cell of a table that a digest falls into, numbered over all tables."""
    table, width = (F.lit(x) if isinstance(x, int) else x for x in (table, width))
    return (table * width + F.pmod(F.xxhash64(digest, table, F.lit(attempt)), width)).cast("int")


def check_sum(digest: Column) -> Column:
    return F.xxhash64(digest, F.lit("check"))


def base_sketch(digests: Column) -> Column:
    """MD5 of a sketch of fixed size: count, XOR of digests and XOR of check sums of each cell."""

    def content(c: int) -> list[Column]:
        table = c // BASE_WIDTH
        own = F.filter(digests, lambda d: cell(d, table, BASE_WIDTH) == c)
        xor = lambda of: F.aggregate(own, F.lit(0).cast("long"), lambda a, d: a.bitwiseXOR(of(d)))
        return [F.size(own).cast("string"), F.hex(xor(lambda d: d)), F.hex(xor(check_sum))]

    return F.md5(F.concat_ws(",", *[x for c in range(TABLES * BASE_WIDTH) for x in content(c)]))


def range_number(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most the key, by halving steps."""
    held = F.lit(bounds).cast("array<bigint>")
    steps = [1 << k for k in reversed(range(len(bounds).bit_length()))]
    if not steps:
        return F.lit(0)
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda at, s: F.when((at + s <= len(bounds)) & (F.get(held, at + s - 1) <= key), at + s).otherwise(at),
    )


def with_next(docs: DataFrame, blocks: int | None = None) -> DataFrame:
    """Add block, place, digests, next_text and next_digests: of the next row by (key, text); after the last comes the first.

    Rows are dealt to blocks by ranges of the key, with bounds from approximate quantiles; a block's first row visits
    the block before it too. So the texts are shuffled once, and no task holds more than a block. The driver gets the
    bounds and first keys, a few for each shuffle partition.
    """
    spark = docs.sparkSession
    blocks = blocks or 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    quantiles = docs.stat.approxQuantile("key", [k / blocks for k in range(1, blocks)], 1 / (4 * blocks))
    bounds = sorted({int(q) for q in quantiles})
    placed = docs.withColumn("block", range_number(F.col("key"), bounds))
    firsts = sorted(
        (r.block, r.first) for r in placed.select("block", "key").groupBy("block").agg(F.min("key").alias("first")).collect()
    )
    first_key, before = [None] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for k, (block, first) in enumerate(firsts):
        first_key[block] = first
        before[block] = firsts[k - 1][0]
    visits = F.col("key") == F.get(F.lit(first_key).cast("array<bigint>"), F.col("block"))
    dealt = placed.withColumn("visited", F.get(F.lit(before), F.col("block"))).withColumn(
        "stay",
        F.explode(
            F.when(visits, F.array(F.struct(F.col("block"), F.lit(0).alias("guest")), F.struct(F.col("visited").alias("block"), F.lit(1).alias("guest"))))
            .otherwise(F.array(F.struct(F.col("block"), F.lit(0).alias("guest"))))
        ),
    )
    dealt = dealt.drop("block", "visited").select("*", "stay.block", "stay.guest").drop("stay")
    order = W.partitionBy("block").orderBy("guest", "key", "text")
    # Digests are made behind the exchange, where they need not travel; small partitions, since sketches outgrow the texts.
    parts = 3 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        dealt.repartition(parts, "block")
        .withColumn("digests", paragraph_digests(F.col("text")))
        .withColumn("place", F.row_number().over(order))
        .withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_digests", F.lead("digests").over(order))
        .where("guest = 0")
    )


def difference_sizes(pairs: DataFrame, attempt: int) -> DataFrame:
    """Rows (block, place, which, total, found, stuck): digests recovered from two sketches' difference, cells left over.

    `pairs` has block, place, which and the digest arrays a and b, and is partitioned by block, which all steps keep, so
    none of them shuffles. Sketches are subtracted cell by cell. A step looks at one table: each of its cells with count
    1 or -1 and the right check sum holds a single digest, which is taken out of its cells in all tables; a digest has
    one cell a table, so none is taken twice. Cells that become empty go. Cell -1 counts what was taken, from 1 on.
    """
    keys = ["block", "place", "which", "total"]
    zero = F.lit(0).cast("long")

    def entry(at: Column | int, n: Column | int, d: Column, chk: Column) -> Column:
        at, n = (F.lit(x) if isinstance(x, int) else x for x in (at, n))
        return F.struct(at.cast("int").alias("at"), n.cast("long").alias("n"), d.alias("d"), chk.alias("chk"))

    total = F.size("a") + F.size("b")
    width = F.greatest(F.lit(LEAST_WIDTH), F.ceil(F.col("total") * CELLS_PER_DIGEST / TABLES)).cast("int") * (1 << attempt)
    signed = F.concat(
        F.transform("a", lambda d: F.struct(d.alias("d"), F.lit(1).alias("s"))),
        F.transform("b", lambda d: F.struct(d.alias("d"), F.lit(-1).alias("s"))),
        F.array(F.struct(zero.alias("d"), F.lit(0).alias("s"))),
    )
    entries = pairs.select("block", "place", "which", total.alias("total"), F.inline(signed)).select(
        *keys,
        F.inline(
            F.when(F.col("s") == 0, F.array(entry(-1, 1, zero, zero))).otherwise(
                F.array(*[entry(cell(F.col("d"), t, width, attempt), F.col("s"), F.col("d"), check_sum(F.col("d"))) for t in range(TABLES)])
            )
        ),
    )
    cells = _summed(entries, keys)
    for step in range(PEEL_STEPS):
        table = step % TABLES
        pure = (
            F.col("at").between(table * width, (table + 1) * width - 1)
            & (F.abs("n") == 1)
            & (F.col("chk") == check_sum(F.col("d")))
        )
        taken = [
            entry(cell(F.col("d"), t, width, attempt), -F.col("n"), F.col("d"), F.col("chk"))
            for t in range(TABLES)
            if t != table
        ]
        stays = entry(F.col("at"), F.col("n"), F.col("d"), F.col("chk"))
        moved = F.when(pure, F.array(entry(-1, 1, zero, zero), *taken)).otherwise(F.array(stays))
        cells = _summed(cells.select(*keys, F.inline(moved)), keys)
    return cells.groupBy(*keys).agg(
        (F.sum(F.when(F.col("at") == -1, F.col("n"))) - 1).alias("found"),
        F.count(F.when(F.col("at") >= 0, 1)).alias("stuck"),
    )


def _summed(entries: DataFrame, keys: list[str]) -> DataFrame:
    summed = entries.groupBy(*keys, "at").agg(
        F.sum("n").alias("n"), F.bit_xor("d").alias("d"), F.bit_xor("chk").alias("chk")
    )
    return summed.where("n <> 0 OR d <> 0 OR chk <> 0")


def edited_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (block, place, doc_id, text, edited_text, digests, next_digests, edited_digests), partitioned by block.

    The edited text has its last floor(n / 2) of n code points replaced by the first as many, or all, of the next
    document's.
    """
    own = docs.select(
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[id_col].try_cast("long"), F.lit(LEAST_KEY)).alias("key"),
        F.coalesce(docs[text_col], F.lit("")).alias("text"),
    )
    rows = with_next(own)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half))
    named = rows.select("block", "place", "doc_id", "text", edited.alias("edited_text"), "digests", "next_digests")
    return named.withColumn("edited_digests", paragraph_digests(F.col("edited_text")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, n_chars, n_paragraphs, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The next document is the one with the next larger integer id (then text); the first follows the last. A fingerprint
    is the MD5 of a sketch of fixed size of the text's distinct paragraph digests. Likeness is 1 - d / (a + b): a and b
    are the numbers of digests of the two texts, d the digests that peeling recovers from the difference of their
    sketches, whose size follows a + b; a pair that does not peel to the end is tried again with twice the cells and
    other hashes. Two texts without paragraphs have likeness 1. A null text counts as empty; null ids, and those that are no
    whole number, come first;
    repeated rows follow one another; a lone document is its own next one. Other columns are not read. Only DataFrame
    functions run here.
    """
    rows = edited_documents(docs, id_col, text_col)
    held = rows.select(
        "block",
        "place",
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.size("digests").cast("long").alias("n_paragraphs"),
        F.sha2("edited_text", 256).alias("edited_sha256"),
        base_sketch(F.col("digests")).alias("fingerprint"),
        base_sketch(F.col("edited_digests")).alias("edited_fingerprint"),
        "digests",
        "edited_digests",
        "next_digests",
    ).persist(StorageLevel.DISK_ONLY)  # kept with its partitioning; a lost part is computed again
    plain = staged(held.drop("digests", "edited_digests", "next_digests"), "fingerprints")
    near = likeness(held)
    held.unpersist()
    return plain.join(near, ["block", "place"]).drop("block", "place")


def likeness(rows: DataFrame) -> DataFrame:
    """Rows (block, place, near_edited, near_next), staged."""
    compared = F.array(
        F.struct(F.lit(0).alias("which"), F.col("digests").alias("a"), F.col("edited_digests").alias("b")),
        F.struct(F.lit(1).alias("which"), F.col("digests").alias("a"), F.col("next_digests").alias("b")),
    )
    pairs = rows.select("block", "place", F.inline(compared))
    done, attempt = None, 0
    while True:
        got = staged(difference_sizes(pairs, attempt), "peeled")
        good = got.where("stuck = 0")
        done = good if done is None else done.union(good)
        left = got.where("stuck > 0").groupBy("block").agg(F.collect_list(F.struct("place", "which")).alias("again"))
        if not left.take(1):
            break
        # By block alone, as the digests are dealt already: only the list of what is left travels.
        again = F.filter(compared, lambda x: F.array_contains("again", F.struct(F.col("place"), x["which"])))
        pairs = rows.join(staged(left, "left").hint("shuffle_hash"), "block").select("block", "place", F.inline(again))
        attempt += 1
    near = F.when(F.col("total") == 0, 1.0).otherwise(1 - F.col("found") / F.col("total"))
    return done.groupBy("block", "place").agg(
        F.max(F.when(F.col("which") == 0, near)).alias("near_edited"),
        F.max(F.when(F.col("which") == 1, near)).alias("near_next"),
    )
