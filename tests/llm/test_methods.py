"""Each operator against a plain version, an exact round trip or held-out labels."""

import hashlib
import os
import random
import struct

import duckdb
import numpy as np
import pytest
import regex
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import cotrain, decontam, iblt, langid, line_chunks, nnpu, queries, simhash, spiece, suffixes, surrogates
from barloom.llm.common import components, read_table
from barloom.session import scratch_path
from tests.llm import brute

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in read_table(spark, SMALL, "documents").collect()}


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


# SentencePiece


def field(number, value):
    if isinstance(value, int):
        return bytes([number << 3, value]) if value < 128 else bytes([number << 3, value & 127 | 128, value >> 7])
    if isinstance(value, float):
        return bytes([number << 3 | 5]) + struct.pack("<f", value)
    data = value.encode() if isinstance(value, str) else value
    size = bytes([len(data)]) if len(data) < 128 else bytes([len(data) & 127 | 128, len(data) >> 7])
    key = number << 3 | 2
    return (bytes([key]) if key < 128 else bytes([key & 127 | 128, key >> 7])) + size + data


def unigram_model():
    """A model of a few pieces, written by hand: unigram scores with byte fallback."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{k:02X}>", 0.0, 6) for k in range(256)]
    pieces += [(p, -float(k + 2), 1) for k, p in enumerate(["▁the", "▁", "t", "h", "e", "th", "▁cat", "ca", "c", "a", "at", "s", "▁s", "hat"])]
    body = b"".join(field(1, field(1, p) + field(2, s) + field(3, k)) for p, s, k in pieces)
    trainer = field(3, 1) + b"\x98\x02\x01"  # field 35, byte fallback
    return body + field(2, trainer) + field(3, field(1, "identity") + field(3, 1) + field(4, 0) + field(5, 1))


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_equal_the_library(spark, texts, kind):
    model = spiece.model_bytes(spark, queries.PIECE_MODEL) if kind == "bpe" else unigram_model()
    judge = sentencepiece.SentencePieceProcessor(model_proto=model)
    odd = ["", " ", "  a  b ", "\n\tx", "<s> </s> <unk>", "日本 \U0001f600", "é́", "the cat  sat\0", "catthehat the"]
    sample = odd + (list(texts.values()) if kind == "bpe" else [t[:300] for t in list(texts.values())[:40]])
    found = {r.doc_id: r for r in spiece.round_trip(frame(spark, sample), model).collect()}
    whole = spiece.PieceModel.parse(model)
    for k, text in enumerate(sample):
        assert found[k].ids == judge.encode(text), text
        assert found[k].parity and found[k].restored
    made = whole.tokenizer()
    for text in sample[: len(odd) + 20]:
        ids = made.encode(text, add_special_tokens=False).ids
        assert ids == judge.encode(text)
        assert made.normalizer.normalize_str(text) == whole.normal(text)
        assert made.decode(ids, skip_special_tokens=False) == spiece.text_of(ids, whole.id_bytes(), True)


# Surrogates


def test_surrogates_keep_type_format_and_identity(spark):
    rows = [
        "Write Jo.Doe7@mail.example.com or JO.DOE7@mail.example.com, not ann@mail.example.com.",
        "Call +1 (988) 555-2485 or +1 988-555-2485; 42.144.35.254 twice 42.144.35.254; 4111 1111 1111 1111, 4111111111111111",
        "Mr. John Smith, Mrs. SMITH and Mary Smith; Господин Иван Петров; jo.doe7@mail.example.com",
    ]
    found = [r.text for r in surrogates.replace_entities(frame(spark, rows), "k").orderBy("doc_id").collect()]
    again = [r.text for r in surrogates.replace_entities(frame(spark, rows), "k").orderBy("doc_id").collect()]
    other = [r.text for r in surrogates.replace_entities(frame(spark, rows), "other").orderBy("doc_id").collect()]
    assert found == again and all(a != b for a, b in zip(found, other, strict=True))
    mails = [w.strip(",.") for w in " ".join(found).split() if "@" in w]
    assert mails[0].lower() == mails[1].lower() == mails[3] and mails[0] != mails[2]
    assert len({m.split("@")[1].lower() for m in mails}) == 1
    digits = ["".join(c for c in part if c.isdigit()) for part in found[1][5:].split(";")[0].split(" or ")]
    assert digits[0] == digits[1] and len(digits[0]) == 11
    cards = ["".join(c for c in part if c.isdigit()) for part in found[1].split("; ")[2].split(", ")]
    assert cards[0] == cards[1] and cards[0][0] == "4" and luhn(cards[0])
    people = found[2].split(", ")
    family = people[0].split()[-1]
    assert people[0].startswith("Mr. ") and f"Mrs. {family.upper()}" in found[2] and found[2].count(family) == 2
    assert not set("John Mary Smith Иван Петров".split()) & set(found[2].replace(";", "").split())
    assert found[2].split("Господин ")[1][0] in "ИПСАДНМ"


def test_no_personal_data_stays_in_clear(spark):
    rows = {
        "(555) 123-4567": r"\(\d{3}\) \d{3}-\d{4}",
        "555-123-4567": r"\d{3}-\d{3}-\d{4}",
        "at 2001:db8::8a2e:370:7334 or FE80::1": r"at [1-9a-f][0-9a-f]{3}:[0-9a-f]{3}::[0-9a-f]{4}:[0-9a-f]{3}:[0-9a-f]{4} or [1-9A-F][0-9A-F]{3}::[1-9A-F]",
        "Dr Angela Merkow": r"Dr \p{Lu}\p{Ll}+ \p{Lu}\p{Ll}+",
        "rené.x@a.com": r"[a-z]{4}\.[a-z]@[a-z]\.com",
        "John Smith called. Smith said, SMITH and John, not Smithers": r"(\p{L}+) (\p{L}+) called\. \2 said, (\p{Lu}+) and \1, not Smithers",
        "std::string a::b 12:30:45 and call 12-34": "std::string a::b 12:30:45 and call 12-34",
    }
    found = {r.doc_id: r.text for r in surrogates.replace_entities(frame(spark, list(rows)), "k").collect()}
    for k, (text, form) in enumerate(rows.items()):
        assert regex.fullmatch(form, found[k]), found[k]
        assert (found[k] == text) == (text == form)
    same = surrogates.replace_entities(frame(spark, ["+1 (555) 123-4567 is (555) 123-4567"]), "k").first().text
    digits = [regex.sub(r"\D", "", part) for part in same.split(" is ")]
    assert digits[0] == "1" + digits[1] != "15551234567"


def test_the_key_is_in_no_plan(spark):
    found = surrogates.replace_entities(frame(spark, ["Mr. John Smith"]), "a most secret key")
    assert "most secret" not in found._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        surrogates.replace_entities(frame(spark, ["x"]), "")


def luhn(digits):
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def test_colliding_surrogates_move_on(spark):
    tokens = spark.createDataFrame([("given-m-latin", f"name{k}") for k in range(200)] + [("given-m-latin", "james")], "kind string, token string")
    later = surrogates.later_attempts(tokens, "k")
    all_of = tokens.join(later, ["kind", "token"], "left").na.fill({"attempt": 0})
    made = [r.s for r in all_of.select(surrogates.surrogate(F.col("kind"), F.col("token"), F.col("attempt"), "k").alias("s")).collect()]
    assert len(set(made)) == 201 and "james" not in made


# Line chunks


def test_line_chunks_equal_sql_and_plain_version(spark, texts):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    found = sorted(map(tuple, queries.op3_line_chunks(spark, SMALL).collect()))
    assert found == sorted(con.execute(queries.LINE_CHUNKS).fetchall())
    assert sum(r[1] for r in found) > 0
    kept = {r.doc_id: r.text for r in line_chunks.drop_repeated_chunks(read_table(spark, SMALL, "documents")).collect()}
    assert kept == brute.kept_lines(texts)


def test_repeated_passages_of_fifty_words_go(spark):
    """Of the lines of such passages, whole copies of documents left out, at least nine in ten are removed."""
    docs = read_table(spark, MEDIUM, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    seen = set()
    own = {i: t for i, t in sorted(texts.items()) if t and not (t in seen or seen.add(t))}
    expected = brute.repeated_passage_lines(own)
    found = {r.doc_id: r for r in line_chunks.drop_repeated_chunks(docs.where(F.col("doc_id").isin(list(own)))).collect()}
    total = gone = 0
    for i, places in expected.items():
        kept = found[i].text.split("\n")
        lines = own[i].split("\n")
        total += len(places)
        gone += min(len(places), len(lines) - len(kept))
    assert total > 0 and gone >= 0.9 * total


# Decontamination


def test_copies_and_edited_copies_are_found(spark):
    pick = random.Random(4)
    words = [f"w{k}" for k in range(3000)]
    items = [" ".join(pick.choices(words, k=40)) for _ in range(12)]

    def edited(text, share):
        return " ".join(pick.choice(words) if pick.random() < share else w for w in text.split())

    docs, expected = [], set()
    for k in range(60):
        filler = [" ".join(pick.choices(words, k=80)) for _ in range(2)]
        item = k % 12
        middle = {0: items[item], 1: edited(items[item], 0.15), 2: items[item].upper().replace(" ", ", ", 9)}.get(k % 5, "")
        docs.append(f"{filler[0]} {middle} {filler[1]}")
    for d, doc in enumerate(docs):
        for i, item in enumerate(items):
            score = brute.alignment(item, doc)
            if score >= decontam.THRESHOLD:
                expected.add((d, i, round(score, 9)))
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id, round(r.score, 9)) for r in decontam.contaminations(frame(spark, docs), bench).collect()}
    assert found == expected and len(found) >= 36


# Repeated byte strings


def repeating(pick, length):
    common = bytes(pick.choices(range(97, 123), k=length + 60)).decode()
    base = bytes(pick.choices(range(97, 123), k=600)).decode()
    texts = ["ab" * 300, "x" * (length - 1), "x" * length, base, base]
    for _ in range(40):
        cut = pick.randrange(0, 90)
        texts.append(bytes(pick.choices(range(97, 103), k=50)).decode() + common[cut : cut + length + pick.randrange(-5, 30)] + "é" + base[cut : cut + 130])
    for _ in range(30):
        edited = list(base)
        edited[pick.randrange(len(base))] = "Z"
        texts.append("".join(edited))
    return texts


def test_repeats_of_400_bytes_equal_the_plain_version(spark, texts):
    found = {r.doc_id: r for r in queries.op6_repeats(spark, SMALL).collect()}
    ids = sorted(texts)
    expected = brute.without_repeats([(texts[i] or "").encode() for i in ids], 400)
    for i, (removed, spans, kept) in zip(ids, expected, strict=True):
        assert (found[i].n_removed, found[i].n_spans, found[i].kept_sha256) == (removed, spans, hashlib.sha256(kept).hexdigest())
    assert sum(e[0] for e in expected) > 0


@pytest.mark.parametrize(("bucket", "pairwise"), [(512, 24), (512, 2), (3, 2)])
def test_repeats_equal_the_plain_version(spark, monkeypatch, bucket, pairwise):
    """By pairs, by sorted ranks, and by counted windows."""
    monkeypatch.setattr(suffixes, "BUCKET", bucket)
    monkeypatch.setattr(suffixes, "PAIRWISE", pairwise)
    monkeypatch.setattr(suffixes, "SEGMENT", 256)
    texts = repeating(random.Random(bucket + pairwise), 100)
    found = {r.doc_id: r for r in suffixes.drop_repeats(frame(spark, texts), length=100).collect()}
    expected = brute.without_repeats([t.encode() for t in texts], 100)
    for k, (removed, spans, kept) in enumerate(expected):
        assert (found[k].n_removed, found[k].n_spans, bytes(found[k].kept)) == (removed, spans, kept), k
    assert 0 < sum(e[0] for e in expected) < sum(len(t) for t in texts)


# Fingerprints


def test_fingerprints_equal_the_plain_version(spark, texts):
    found = {r.doc_id: r for r in queries.op7_fingerprints(spark, SMALL).collect()}
    ids = sorted(texts)
    for k, i in enumerate(ids):
        text, following = texts[i], texts[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert found[i].near_edited == pytest.approx(brute.likeness(text, edited))
        assert found[i].near_next == pytest.approx(brute.likeness(text, following))
    prints = {}
    for i in ids:
        assert prints.setdefault(texts[i], found[i].fingerprint) == found[i].fingerprint
    assert len(set(prints.values())) == len(prints)


def test_sketches_that_do_not_peel_are_tried_larger(spark, monkeypatch):
    monkeypatch.setattr(iblt, "LEAST_WIDTH", 1)
    monkeypatch.setattr(iblt, "CELLS_PER_DIGEST", 0.5)
    texts = [" ".join(f"Sentence {k} of {d}." for k in range(d * 7)) for d in range(1, 12)]
    found = {r.doc_id: r for r in iblt.fingerprints(frame(spark, texts)).collect()}
    for k, text in enumerate(texts):
        assert found[k].near_next == pytest.approx(brute.likeness(text, texts[(k + 1) % len(texts)]))


# SimHash


def test_simhash_equals_the_plain_version(spark, texts):
    found = {r.doc_id: r for r in queries.op10_simhash(spark, SMALL).collect()}
    prints = {i: brute.simhash(t, 4) for i, t in texts.items()}
    assert {i: int(r.fingerprint, 16) for i, r in found.items()} == prints
    assert {i: r.component_id for i, r in found.items()} == brute.components(prints, 4)


@pytest.mark.parametrize("radius", [1, 4, 6])
def test_masks_cover_the_radius(radius):
    masks = np.array([m & (1 << 64) - 1 for m in simhash.covering_masks(radius)], np.uint64)
    pick = np.random.default_rng(radius)
    for _ in range(500):
        apart = sum(1 << int(b) for b in pick.choice(64, radius, replace=False))
        assert ((masks & np.uint64(apart)) == 0).any()


@pytest.mark.parametrize("block", [4, 2048])
def test_links_join_what_pairs_would(spark, block):
    """Also where buckets are split into blocks."""
    pick = random.Random(block)
    values = [0, (1 << 64) - 1]
    for _ in range(12):
        value = pick.getrandbits(64)
        for _ in range(25):
            values.append(value)
            for bit in pick.sample(range(64), 3):
                value ^= 1 << bit
    signed = {v - (1 << 64) if v >> 63 else v: v for v in values}
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed], "fp long"), 4, block)
    found = {r.node: r.component for r in components(links).collect()}
    groups = brute.components({s: v for s, v in signed.items()}, 4)
    assert {s: found.get(s, s) for s in signed} == groups


# Classifiers, by held-out labels


def held_out_share(found, labels, column):
    joined = found.where("held_out").join(labels.where(F.col(column).isNotNull()), "doc_id")
    return joined


def test_language_of_held_out_texts(spark):
    docs = read_table(spark, MEDIUM, "documents")
    found = queries.op5_language(spark, MEDIUM).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.98
    noise = frame(spark, ["12345 %%% !!!", "", None, "\U0001f600 \U0001f4a9\U0001f680", "\U0001d7d8\U00020000"[:1]])
    model = langid.train(docs, F.lit(True))
    assert {r.lang_pred for r in langid.identify(noise, model).collect()} == {"und"}


def test_toxicity_of_held_out_texts(spark):
    rows = held_out_share(queries.op8_toxicity(spark, MEDIUM), read_table(spark, MEDIUM, "labels"), "toxic").collect()
    clean = [r.predicted for r in rows if r.toxic == 0]
    toxic = [r.predicted for r in rows if r.toxic == 1]
    assert sum(clean) / len(clean) < 0.05 and sum(toxic) / len(toxic) > 0.6


def test_negative_risk_is_not_driven_below_zero():
    pos, un = [[0]] * 20, [[0]] * 20 + [[1]] * 80
    w, b = nnpu.fit(pos, un, 2, 0.2)
    assert w[0] > 1 > w[1] + 0.5 and b < 0


def test_quality_of_held_out_texts(spark):
    rows = held_out_share(queries.op9_quality(spark, MEDIUM), read_table(spark, MEDIUM, "labels"), "quality").collect()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    assert sum(r.predicted for r in rows if r.quality == 1) / sum(r.quality for r in rows) > 0.97


def test_the_metadata_view_sees_no_text(spark):
    docs = read_table(spark, SMALL, "documents")
    labels = read_table(spark, SMALL, "labels")
    model = cotrain.train(docs, labels)
    other = docs.withColumn("text", F.lit("nothing"))
    seen = []
    for table in (docs, other):
        columns = [r for r in table.orderBy("doc_id").select(*cotrain.meta_columns(table, model.meta_cols)).collect()]
        seen.append(model.meta.logit(cotrain.meta_view([list(c) for c in zip(*columns, strict=True)])))
    assert np.array_equal(*seen) and len(set(seen[0].tolist())) > 3


def test_views_teach_one_another():
    pick = np.random.default_rng(0)
    y = pick.integers(0, 2, 400)
    xc = (y[:, None] * 2 - 1 + pick.normal(0, 1, (400, 5))).astype(np.float32)
    xm = (y[:, None] * 2 - 1 + pick.normal(0, 1, (400, 5))).astype(np.float32)
    label = np.where(np.arange(400) < 40, y, -1)
    model = cotrain.fit(xc, xm, label, np.arange(400) < 10, 4, 60, [])
    z = model.say[0] * model.content.logit(xc) + model.say[1] * model.meta.logit(xm) + model.say[2]
    assert ((z > 0) == y).mean() > 0.95


# Pipeline


def test_pipeline_equals_its_plain_stages(spark):
    folder = os.path.dirname(scratch_path(spark, "any"))
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SMALL).collect()}
    # What the stages had staged on their way is gone.
    assert [name.split("-")[0] for name in set(os.listdir(folder)) - before] == ["tokens"]
    docs = read_table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = langid.train(docs, F.lit(True))
    ids = sorted(texts)
    _, p, has_letter = model.predict([texts[i] for i in ids])
    texts = brute.kept_lines({i: texts[i] for i, q, h in zip(ids, p, has_letter, strict=True) if h and q >= model.threshold})
    group = brute.components({i: brute.simhash(t, 4) for i, t in texts.items()}, 4)
    texts = {i: t for i, t in texts.items() if group[i] == i}
    items = [r.text for r in read_table(spark, SMALL, "benchmark").collect()]
    grams = [set(zip(*[t.lower().split()[k:] for k in range(3)], strict=False)) for t in items]
    for i in list(texts):
        own = set(zip(*[texts[i].lower().split()[k:] for k in range(3)], strict=False))
        if any(g & own and brute.alignment(item, texts[i]) >= decontam.THRESHOLD for g, item in zip(grams, items, strict=True)):
            del texts[i]
    judge = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    assert {i: r.ids for i, r in found.items()} == {i: judge.encode(t) for i, t in texts.items()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "line_chunks", "near_copies", "benchmark", "tokens"]
