"""Line dedup by content-defined chunks of lines."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import numbered, staged

# A line ends a chunk with this chance, by a rolling hash over it and the line before.
END_SHARE = 0.9375
FACTOR, MIX, RANGE = 31, 2654435761, 1 << 32
MIN_LINES = 2
BLANK = " \t\r"
# Text held in a task before its rows are sent on.
HELD = 1 << 23


def line_value(line: str) -> int:
    """Hash of a line: the first 32 bits of its MD5."""
    return int(hashlib.md5(line.encode()).hexdigest()[:8], 16)


def chunk_lines(text: str, end_share: float = END_SHARE) -> list[list[str]]:
    """Split a text into chunks of whole lines.

    A rolling hash over the hashes of two lines ends a chunk where it is among the lower `end_share` of its values, so a
    line put in or taken out moves only the boundaries next to it.
    """
    chunks, open_chunk, last, least = [], [], 0, int(RANGE * end_share)
    for line in text.split("\n"):
        value = line_value(line)
        open_chunk.append(line)
        if (value + FACTOR * last) * MIX % RANGE < least:
            chunks.append(open_chunk)
            open_chunk = []
        last = value
    if open_chunk:
        chunks.append(open_chunk)
    return chunks


def digest_of(lines: list[str]) -> bytes:
    return hashlib.md5("\n".join(lines).encode()).digest()


def _chunk_digests(docs: DataFrame, end_share: float) -> DataFrame:
    """A row (key, chunk, digest) for each chunk of the texts (key, text)."""
    key = docs.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, digests, numbers, held = [], [], [], 0
            for row, text in enumerate(batch.column(1)):
                chunks = chunk_lines(text.as_py(), end_share)
                rows += [row] * len(chunks)
                numbers += range(len(chunks))
                digests += map(digest_of, chunks)
                held += len(chunks)
                if held > HELD >> 6:
                    yield sent(batch, rows, numbers, digests)
                    rows, digests, numbers, held = [], [], [], 0
            yield sent(batch, rows, numbers, digests)

    def sent(batch: pa.RecordBatch, rows: list, numbers: list, digests: list) -> pa.RecordBatch:
        keys = batch.column(0).take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays([keys, pa.array(numbers, pa.int32()), pa.array(digests, pa.binary())], ["key", "chunk", "digest"])

    return docs.mapInArrow(cut, f"key {key}, chunk int, digest binary")


def _repeated_bodies(docs: DataFrame, end_share: float) -> DataFrame:
    """Rows (key, chunk, digest, first, body, before, after) of the chunks that `marked` (chunk, first) names.

    `before` and `after` are the lines of the neighbouring chunks, empty where that is repeated too: it is judged itself.
    """
    key = docs.schema["key"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, held = [], 0
            for row, (text, marked) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
                chunks = chunk_lines(text.as_py(), end_share)
                first = {m["chunk"]: m["first"] for m in marked.as_py()}
                for k, is_first in first.items():
                    before = chunks[k - 1] if k and k - 1 not in first else []
                    after = chunks[k + 1] if k + 1 < len(chunks) and k + 1 not in first else []
                    out.append((row, k, digest_of(chunks[k]), is_first, "\n".join(chunks[k]), before, after))
                    held += len(out[-1][4]) + sum(map(len, before)) + sum(map(len, after))
                if held > HELD:
                    yield sent(batch, out)
                    out, held = [], 0
            yield sent(batch, out)

    def sent(batch: pa.RecordBatch, out: list) -> pa.RecordBatch:
        lines = pa.list_(pa.string())
        types = [pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.string(), lines, lines]
        rows, *columns = (pa.array([r[k] for r in out], t) for k, t in enumerate(types))
        names = ["key", "chunk", "digest", "first", "body", "before", "after"]
        return pa.RecordBatch.from_arrays([batch.column(0).take(rows), *columns], names)

    schema = f"key {key}, chunk int, digest binary, first boolean, body string, before array<string>, after array<string>"
    return docs.mapInArrow(cut, schema)


def common(a: list[str], b: list[str]) -> int:
    """How many lines two lists share from their start."""
    n = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        n += 1
    return n


def _widened(pairs: DataFrame) -> DataFrame:
    """Rows (key, chunk, back, on): of each later copy, byte for byte equal, how many lines before and behind are equal too."""
    key = pairs.schema["key"].dataType.simpleString()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, back, on = [], [], []
            columns = (batch.column(n).to_pylist() for n in ("body", "before", "after", "first_body", "first_before", "first_after"))
            for row, (body, before, after, first_body, first_before, first_after) in enumerate(zip(*columns, strict=True)):
                if body == first_body:
                    rows.append(row)
                    back.append(common(before[::-1], first_before[::-1]))
                    on.append(common(after, first_after))
            taken = [batch.column(n).take(pa.array(rows, pa.int64())) for n in ("key", "chunk")]
            yield pa.RecordBatch.from_arrays([*taken, pa.array(back, pa.int32()), pa.array(on, pa.int32())], ["key", "chunk", "back", "on"])

    return pairs.mapInArrow(compare, f"key {key}, chunk int, back int, on int")


def drop_repeated_chunks(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_share: float = END_SHARE,
    min_lines: int = MIN_LINES,
) -> DataFrame:
    """Remove runs of at least `min_lines` lines that stand earlier in the corpus; the first copy stays.

    Chunks meet by MD5. Of the copies of one the first, by (id, chunk number), stays; the others are compared with it byte
    for byte and are anchors: each is widened line by line, before and behind, as far as its neighbours equal those of the
    first copy and are in no repeated chunk themselves. Lines that anchors cover and that follow one another are a run; it
    goes if `min_lines` of its lines are not blank. Every line that goes has an equal one that stays in an earlier place.

    Returns all columns and rows, the text replaced, and `removed_lines` (int), `removed_chunks` (int: runs), which replace
    columns of these names. A text that loses everything becomes empty. Null or missing texts and rows without id are
    returned as they are and count nowhere. Rows with equal id and text are one document; rows that share an id only are
    judged each, the order of their texts' MD5s deciding which is earlier.
    """
    same = F.md5(docs[text_col])
    key = F.struct(docs[id_col].alias("id"), same.alias("same"))
    plain = docs.where(docs[id_col].isNotNull() & docs[text_col].isNotNull()).select(key.alias("key"), docs[text_col].alias("text"))
    found = staged(_chunk_digests(plain, end_share), "digests")
    # Digests alone are exchanged here; bodies only of those that repeat.
    copies = found.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("key", "chunk")).alias("place")).where("n > 1")
    copies = staged(copies.select("digest", "place"), "repeated")
    # A merge join, in which AQE splits a digest that very many places share.
    hits = found.join(copies.hint("merge"), "digest").select(
        "key", F.struct("chunk", (F.col("place") == F.struct("key", "chunk")).alias("first")).alias("mark")
    )
    marked = staged(hits.groupBy("key").agg(F.collect_set("mark").alias("marked")), "marked")
    texts = plain.join(marked.hint("merge"), "key").select("key", "text", "marked")
    bodies = staged(_repeated_bodies(texts, end_share), "bodies")
    # Rows of equal id and text give equal first copies; one is enough.
    first = bodies.where("first").dropDuplicates(["digest"])
    # Staged, so that the join below is one of plain exchanges, in which AQE splits a digest of very many copies.
    first = staged(first.select("digest", *[F.col(c).alias(f"first_{c}") for c in ("body", "before", "after")]), "first-copies")
    gone = _widened(bodies.where("NOT first").join(first.hint("merge"), "digest"))
    gone = staged(gone.groupBy("key").agg(F.collect_set(F.struct("chunk", "back", "on")).alias("_drop")), "drop")
    return _rebuilt(docs, gone, id_col, text_col, end_share, min_lines)


def _rebuilt(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, end_share: float, min_lines: int) -> DataFrame:
    """All rows without the lines that `gone` names."""
    names = [c for c in docs.columns if c not in ("removed_lines", "removed_chunks")]
    text_at, own_id = names.index(text_col), f"__{names.index(id_col)}"
    own = F.struct(F.col(own_id).alias("id"), F.md5(f"__{text_at}").alias("same"))
    # A merge join at every size: what is dropped grows with the corpus, so it is no side to broadcast.
    joined = numbered(docs, names).join(gone.hint("merge"), own == F.col("key"), "left").drop("key")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, lines_gone, runs_gone = [], [], []
            for text, drop in zip(batch.column(text_at), batch.column(len(names)), strict=True):
                text, drop = text.as_py(), drop.as_py()
                lines_out = runs_out = 0
                if drop and text is not None:
                    text, lines_out, runs_out = without(text, drop, end_share, min_lines)
                texts.append(text)
                lines_gone.append(lines_out)
                runs_gone.append(runs_out)
            columns = batch.columns[: len(names)]
            columns[text_at] = pa.array(texts, pa.string())
            columns += [pa.array(lines_gone, pa.int32()), pa.array(runs_gone, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "removed_lines", "removed_chunks"])

    counts = [T.StructField("removed_lines", T.IntegerType()), T.StructField("removed_chunks", T.IntegerType())]
    return joined.mapInArrow(rebuild, T.StructType([docs.schema[c] for c in names] + counts))


def without(text: str, drop: list[dict], end_share: float, min_lines: int) -> tuple[str, int, int]:
    """A text without the covered runs that are long enough, and how many lines and runs that took."""
    chunks = chunk_lines(text, end_share)
    starts, at = [], 0
    for chunk in chunks:
        starts.append(at)
        at += len(chunk)
    covered = bytearray(at + 1)
    for d in drop:
        begin, end = starts[d["chunk"]] - d["back"], starts[d["chunk"]] + len(chunks[d["chunk"]]) + d["on"]
        covered[begin:end] = b"\1" * (end - begin)
    lines, kept, run, lines_out, runs_out = text.split("\n"), [], [], 0, 0
    for line, on in zip([*lines, ""], covered, strict=True):
        if on:
            run.append(line)
            continue
        if run:
            if sum(bool(r.strip(BLANK)) for r in run) >= min_lines:
                lines_out, runs_out = lines_out + len(run), runs_out + 1
            else:
                kept += run
            run = []
        kept.append(line)
    return "\n".join(kept[:-1]), lines_out, runs_out
