"""SentencePiece encoding and decoding on the tokenizers library."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.llm.common import text_slices, two_columns

MARK = "▁"
# Fixed values of the model file: piece kinds and model kinds.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def proto_fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of a protobuf message's fields: integers, 4-byte floats, bytes."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        elif kind == 5:
            value, at = struct.unpack("<f", data[at : at + 4])[0], at + 4
        elif kind == 1:
            value, at = struct.unpack("<d", data[at : at + 8])[0], at + 8
        else:
            raise ValueError(f"protobuf wire type {kind} is not known")
        yield key >> 3, value


@dataclass
class PieceModel:
    """What a model file says: pieces with score and kind, the kind of model, the normaliser's settings."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> PieceModel:
        model = cls()
        for number, value in proto_fields(data):
            if number == 1:
                piece = dict(proto_fields(value))
                model.pieces.append((piece[1].decode(), piece.get(2, 0.0), piece.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(proto_fields(value))
                model.model_type = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                spec = dict(proto_fields(value))
                model.charsmap = spec.get(2, b"")
                model.dummy_prefix = bool(spec.get(3, 1))
                model.strip_spaces = bool(spec.get(4, 1))
                model.escape_spaces = bool(spec.get(5, 1))
        if model.model_type not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model.model_type} is not supported, only unigram and BPE are")
        if any(kind == USER_DEFINED for _, _, kind in model.pieces) or not model.escape_spaces:
            raise ValueError("user-defined pieces and unescaped spaces are not supported")
        return model

    @property
    def unknown(self) -> int:
        return next(k for k, (_, _, kind) in enumerate(self.pieces) if kind == UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """All pairs of pieces that make a piece, the best-scored piece first."""
        score = {p: s for p, s, kind in self.pieces if kind in (NORMAL, UNUSED)}
        found = []
        for whole, s in score.items():
            found += [
                (-s, k, whole) for k in range(1, len(whole)) if whole[:k] in score and whole[k:] in score
            ]
        order = {p: k for k, p in enumerate(score)}
        found.sort(key=lambda x: (x[0], order[x[2]], x[1]))
        return [(whole[:k], whole[k:]) for _, k, whole in found]

    def tokenizer(self):
        """The same model as a tokenizers.Tokenizer."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        if self.model_type == UNIGRAM:
            # Control pieces get names that no word has; byte pieces a score that no word prefers.
            low = min(s for _, s, kind in self.pieces if kind in (NORMAL, UNUSED))
            held = [(p + " " * (kind in (CONTROL, UNKNOWN)), low if kind == BYTE else s) for p, s, kind in self.pieces]
            made = Tokenizer(models.Unigram(held, unk_id=self.unknown, byte_fallback=self.byte_fallback))
        else:
            made = Tokenizer(
                models.BPE(
                    {p: k for k, (p, _, _) in enumerate(self.pieces)},
                    self.merges(),
                    unk_token=self.pieces[self.unknown][0],
                    fuse_unk=True,
                    byte_fallback=self.byte_fallback,
                    cache_capacity=0,
                )
            )
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.strip_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        made.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        if self.model_type == UNIGRAM or not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, _ in self.pieces):
            # No piece runs over the end of a word, so words can be encoded, and remembered, one by one.
            made.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}*[^{MARK}]+|{MARK}+"), "isolated")
        parts = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        made.decoder = decoders.Sequence(parts + ([decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []))
        return made

    def normal(self, text: str) -> str:
        """The text as the model's normaliser leaves it, marks in place of spaces."""
        if self.charsmap:
            from tokenizers import normalizers

            text = normalizers.Precompiled(self.charsmap).normalize_str(text)
        if self.strip_spaces:
            text = " ".join(w for w in text.split(" ") if w)
        if self.dummy_prefix and text:
            text = " " + text
        return text.replace(" ", MARK)

    def plain(self, text: str) -> str:
        """What decoding the text's ids gives: the normalised text with spaces, without the one put before it."""
        out = self.normal(text).replace(MARK, " ")
        return out[1:] if self.dummy_prefix else out

    def id_bytes(self) -> list[bytes]:
        """The bytes each id stands for; control pieces stand for none."""
        out = []
        for piece, _, kind in self.pieces:
            if kind == BYTE:
                out.append(bytes([int(piece[3:-1], 16)]))
            elif kind == UNKNOWN:
                out.append(" \u2047 ".encode())
            else:
                out.append(b"" if kind == CONTROL else piece.replace(MARK, " ").encode())
        return out


class Encoder:
    """Encodes batches inside a task; remembers the ids of words, above `most` of them only of those met again."""

    def __init__(self, data: bytes, check: bool = False, most: int = 100_000) -> None:
        self.model = PieceModel.parse(data)
        self.words = self.model.tokenizer()
        self.whole_words = self.words.pre_tokenizer is not None
        self.words.normalizer = normal_of_words()
        self.words.pre_tokenizer = None if self.whole_words else self.words.pre_tokenizer
        self.split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if self.whole_words else re.compile("(?s).+")
        self.is_byte = np.array([kind == BYTE for _, _, kind in self.model.pieces])
        # Bytes of a word that an id covers; the unknown one may cover any number.
        self.covers = np.array([1 if kind == BYTE else 0 if kind == UNKNOWN else len(p.encode()) for p, _, kind in self.model.pieces], np.int64)
        self.most, self.judge = most, None
        if check:
            import sentencepiece

            self.judge = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.number: dict[str, int] = {}
        self.pool, self.starts, self.sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.agrees, self.again = np.zeros(0, bool), np.zeros(0, bool)

    def forget(self) -> None:
        """Keep the words met again since the last time, at most the half of `most`: most others come once in all texts."""
        kept, words = np.flatnonzero(self.again)[-(self.most // 2) :], list(self.number)
        self.number = {words[k]: n for n, k in enumerate(kept.tolist())}
        sizes = self.sizes[kept]
        ends = np.cumsum(sizes)
        self.pool = self.pool[np.repeat(self.starts[kept] - ends + sizes, sizes) + np.arange(int(sizes.sum()))]
        self.starts, self.sizes, self.agrees, self.again = ends - sizes, sizes, self.agrees[kept], np.zeros(len(kept), bool)

    def learn(self, words: list[str]) -> None:
        """Encode new words and compare with the sentencepiece library."""
        ids, sizes = self.encoded(words)
        ends = np.cumsum(sizes)
        right = self.compared(words, ids, ends - sizes, ends) if self.judge else np.ones(len(words), bool)
        self.starts = np.concatenate([self.starts, len(self.pool) + ends - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.pool = np.concatenate([self.pool, ids])
        self.agrees = np.concatenate([self.agrees, right])
        self.again = np.concatenate([self.again, np.zeros(len(words), bool)])

    def encoded(self, words: list[str], most: int = 128) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after another, and how many each has.

        Many words go to a call, each by itself. Where one word's ids end is told by the bytes that ids cover; where that
        does not fit, as with unknown ones, the words go one to a call.
        """
        found = [e.ids for e in self.words.encode_batch_fast([words[k : k + most] for k in range(0, len(words), most)], is_pretokenized=True, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(found), np.int32, sum(map(len, found)))
        covered, wanted = np.cumsum(self.covers[ids]), np.cumsum([len(w.encode()) for w in words])
        ends = np.searchsorted(covered, wanted) + 1
        if self.covers[ids].all() and len(ids) == ends[-1] and np.array_equal(covered[ends - 1], wanted):
            return ids, np.diff(ends, prepend=0)
        found = [e.ids for e in self.words.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int32, int(sizes.sum())), sizes

    def compared(self, words: list[str], ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, most: int = 128) -> np.ndarray:
        """Which words have the ids that the sentencepiece library gives, many words to a call, alone where these differ."""
        lead = 1 if self.model.dummy_prefix else 0
        if not self.whole_words or not lead:
            most = 1
        blank = [k for k, w in enumerate(words) if not w.strip(MARK)] if self.whole_words else []
        if blank:  # marks alone would join the next word, so they are checked behind a word
            right = np.ones(len(words), bool)
            head = self.judge.encode("a")
            for k, got in zip(blank, self.judge.encode(["a" + words[k].replace(MARK, " ") for k in blank]), strict=True):
                right[k] = got == head + ids[starts[k] : ends[k]].tolist()
            rest = np.setdiff1d(np.arange(len(words)), blank)
            if len(rest):
                sizes = (ends - starts)[rest]
                new_ends = np.cumsum(sizes)
                some = ids[np.repeat(starts[rest] - new_ends + sizes, sizes) + np.arange(new_ends[-1])]
                right[rest] = self.compared([words[k] for k in rest], some, new_ends - sizes, new_ends, most)
            return right
        groups = range(0, len(words), most)
        texts = ["".join(words[k : k + most])[lead:].replace(MARK, " ") for k in groups]
        right = np.ones(len(words), bool)
        for k, expected in zip(groups, self.judge.encode(texts, num_threads=1), strict=True):
            stop = min(k + most, len(words))
            if ids[starts[k] : ends[stop - 1]].tolist() != expected:
                right[k:stop] = False if most == 1 else self.compared(words[k:stop], ids, starts[k:stop], ends[k:stop], 1)
        return right

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids one after another, offsets by text (n + 1), and whether a text's normal form and all its words agree with
        sentencepiece."""
        if len(self.number) > self.most:
            self.forget()
        words, counts = [], np.zeros(len(texts) + 1, np.int64)
        alike = np.ones(len(texts), bool)
        for k, text in enumerate(texts):
            normal = self.model.normal(text)
            if self.judge:
                alike[k] = self.judge.normalize(text) == normal
            words += self.split.findall(normal)
            counts[k + 1] = len(words)
        known = len(self.number)
        number = self.number
        fresh = [w for w in dict.fromkeys(words) if w not in number]
        if fresh:
            number.update(zip(fresh, range(known, known + len(fresh)), strict=True))
            self.learn(fresh)
        which = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
        self.again[which[which < known]] = True
        sizes = self.sizes[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(self.starts[which] - ends[:-1], sizes) + np.arange(ends[-1])]
        wrong = np.concatenate([[0], np.cumsum(~self.agrees[which])])[counts]
        return ids, ends[counts], alike & (wrong[1:] == wrong[:-1])


def normal_of_words():
    """Words reach the tokenizer normalised already."""
    from tokenizers import normalizers

    return normalizers.Sequence([])


def model_bytes(spark: SparkSession, path: str) -> bytes:
    """A model file, from the driver's disk or from any store that Spark reads."""
    local = Path(path.removeprefix("file://"))
    if local.is_file():
        return local.read_bytes()
    return bytes(spark.read.format("binaryFile").load(path).first().content)


def encode(
    docs: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    check: bool = False,
) -> DataFrame:
    """Rows (doc_id, ids array<int>, n_byte_ids[, parity]), one for each row of `docs`, for its whole text.

    Ids are those of the SentencePiece model whose file content is `model`. With `check`, parity says that each word of
    the text gets the ids which the sentencepiece library gives it. A null text has null ids (parity null), an empty one no ids.
    Strings like control pieces are ordinary text. Repeated rows are answered each; other columns are not read.
    """
    plain = two_columns(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(model, check)
            for part in text_slices(batch):
                texts = part.column(1)
                ids, offsets, agrees = encoder.encode([t or "" for t in texts.to_pylist()])
                missing = texts.is_null()
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=missing)
                of_bytes = np.concatenate([[0], np.cumsum(encoder.is_byte[ids])])[offsets]
                columns = [part.column(0), lists, pa.array(np.diff(of_bytes).astype(np.int32))]
                if check:
                    columns.append(pa.array(agrees, mask=missing.to_numpy(zero_copy_only=False)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "n_byte_ids"] + ["parity"] * check)

    return plain.mapInArrow(run, f"doc_id {id_type}, ids array<int>, n_byte_ids int" + ", parity boolean" * check)


def decode(rows: DataFrame, model: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the text that an array of ids stands for; null ids give null, no ids the empty text.

    Byte pieces are joined before they are read as UTF-8; bytes that are none give U+FFFD. Unknown ids give the
    model's sign for them, control ids nothing. A column named like `out_col` is replaced. An id that the model
    does not have is an error.
    """
    names = [c for c in rows.columns if c != out_col]
    at = names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parsed = PieceModel.parse(model)
        table = parsed.id_bytes()
        for batch in batches:
            texts = [
                None if ids is None else text_of(ids, table, parsed.dummy_prefix)
                for ids in (x.as_py() if x.is_valid and len(x) < 64 else _numbers(x) for x in batch.column(at))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*names, out_col])

    schema = T.StructType([rows.schema[c] for c in names] + [T.StructField(out_col, T.StringType())])
    return rows.select(*names).mapInArrow(run, schema)


def _numbers(ids: pa.ListScalar) -> list[int] | None:
    return ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else None


def text_of(ids: list[int], table: list[bytes], prefix: bool) -> str:
    text = b"".join([table[i] for i in ids]).decode("utf-8", "replace")
    return text[1:] if prefix and text[:1] == " " else text


def round_trip(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (doc_id, ids, n_byte_ids, parity, restored): as `encode` with its check, and whether the ids decode to the text.

    The text to restore is the normalised one. Encoding and decoding share a pass, so the ids travel once.
    """
    plain = two_columns(docs, id_col, text_col)
    id_type = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = None, []
        for batch in batches:
            if encoder is None:
                encoder = Encoder(model, True)
                table = encoder.model.id_bytes()
            for part in text_slices(batch):
                texts = part.column(1).to_pylist()
                ids, offsets, agrees = encoder.encode([t or "" for t in texts])
                missing = part.column(1).is_null()
                listed, prefix = ids.tolist(), encoder.model.dummy_prefix
                same = [
                    None if t is None else text_of(listed[a:b], table, prefix) == encoder.model.plain(t)
                    for t, a, b in zip(texts, offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)
                ]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()), mask=missing)
                of_bytes = np.concatenate([[0], np.cumsum(encoder.is_byte[ids])])[offsets]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        lists,
                        pa.array(np.diff(of_bytes).astype(np.int32)),
                        pa.array(agrees, mask=missing.to_numpy(zero_copy_only=False)),
                        pa.array(same, pa.bool_()),
                    ],
                    ["doc_id", "ids", "n_byte_ids", "parity", "restored"],
                )

    return plain.mapInArrow(
        run, f"doc_id {id_type}, ids array<int>, n_byte_ids int, parity boolean, restored boolean"
    )
