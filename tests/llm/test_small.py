"""Edge cases of all operators: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import cotrain, decontam, iblt, langid, line_chunks, nnpu, simhash, spiece, suffixes, surrogates
from barloom.llm.queries import PIECE_MODEL

LONG = "Long words make a long text. " * 4000
ROWS = [
    (1, None, "en", "a", 5),
    (2, "", None, None, 0),
    (None, "a text without an id", "en", "a", 1),
    (3, "one", "en", "a", 1),
    (3, "one", "en", "a", 1),
    (4, LONG, "en", "b", None),
    (5, LONG, "en", "b", 2),
    (6, "first line\nsecond line\nthird line\nfourth line\nfifth line\nsixth line", "en", "c", 9),
    (7, "\0   \U0001f600 ß İ", "xx", "c", 9),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ("k", "key", "block", "digest", "chunk", "score", "fp", "bucket", "n", "label", "ids", "_id", "_drop", "positive", "which", "accepted", "gone")


@pytest.fixture(params=["rows", "clash", "empty"])
def docs(request, spark):
    rows = ROWS if request.param != "empty" else []
    out = spark.createDataFrame(rows, SCHEMA)
    if request.param == "clash":
        out = out.withColumns({c: F.lit(f"own {c}") for c in CLASH})
    return out


@pytest.fixture
def labels(spark):
    return spark.createDataFrame([(3, 1, 1), (4, 0, 0), (5, None, None), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def model():
    with open(PIECE_MODEL, "rb") as f:
        return f.read()


def same_rows(docs, found):
    """One row for each row of the input."""
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, (r.doc_id for r in docs.select("doc_id").collect())))


def by_id(found):
    return {r.doc_id: r for r in found}


def test_pieces(docs, model):
    found = spiece.round_trip(docs, model).collect()
    same_rows(docs, found)
    for r in found:
        assert (r.ids is None) == (r.doc_id == 1)
        if r.ids is not None:
            assert r.parity and r.restored
    encoded = spiece.encode(docs, model)
    assert {(r.doc_id, tuple(r.ids or ())) for r in encoded.collect()} == {(r.doc_id, tuple(r.ids or ())) for r in found}
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    for r in spiece.decode(encoded, model).collect():
        assert r.decoded == texts[r.doc_id]


def test_surrogates(docs):
    found = surrogates.replace_entities(docs, "key")
    assert set(found.columns) == {*docs.columns, "n_entities"}
    rows = found.collect()
    same_rows(docs, rows)
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    assert all(r.text == texts[r.doc_id] and (r.n_entities is None) == (r.text is None) for r in rows)


def test_line_chunks(docs):
    found = line_chunks.drop_repeated_chunks(docs)
    assert found.columns == [*docs.columns, "removed_lines", "removed_chunks"]
    rows = found.collect()
    same_rows(docs, rows)
    assert all(r.removed_lines == 0 for r in rows)


def test_decontamination(docs, spark):
    items = spark.createDataFrame([(1, "second line third line fourth line"), (2, None), (3, "one"), (4, "a text without an id")], "item_id long, text string")
    found = decontam.contaminations(docs, items).collect()
    if docs.isEmpty():
        assert not found
    else:
        assert {(r.doc_id, r.item_id) for r in found} == {(6, 1), (None, 4)}
        assert {r.score for r in found} == {1.0}
        kept = decontam.drop_contaminated(docs, items)
        assert kept.columns == docs.columns
        assert kept.count() == len(ROWS) - 2
    none = decontam.contaminations(docs, items.limit(0))
    assert none.columns == ["doc_id", "item_id", "score", "end_word"] and none.isEmpty()


def test_language(docs):
    found = langid.identify(docs, langid.train(docs, F.lit(True))).collect()
    same_rows(docs, found)
    for r in found:
        assert 0 <= r.score <= 1
        assert (r.lang_pred == langid.UNKNOWN) == (r.doc_id in (1, 2))
        assert r.accepted is False or r.doc_id not in (1, 2)


def test_accepted_rows(docs):
    model = langid.train(docs, F.lit(True))
    kept = langid.accepted_rows(docs, model)
    assert kept.columns == docs.columns
    accepted = sorted(str(r.doc_id) for r in langid.identify(docs, model).where("accepted").collect())
    assert sorted(str(r.doc_id) for r in kept.collect()) == accepted


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES, ids=lambda s: s[0])
def test_pipeline_stages(stage, docs, spark, tmp_path):
    """Each stage on odd rows, clashing names and no rows."""
    items = spark.createDataFrame([(1, "second line third line fourth line")], "item_id long, text string")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    name, run = stage
    found = run(spark, docs, str(tmp_path))
    rows = found.collect()
    if name == "tokens":
        assert found.columns == ["doc_id", "ids", "n_byte_ids", "parity", "restored"]
        return same_rows(docs, rows)
    assert found.columns == docs.columns
    kept = sorted(str(r.doc_id) for r in rows)
    if docs.isEmpty():
        assert not kept
    elif name == "line_chunks":
        same_rows(docs, rows)
    elif name == "language":
        assert not {"1", "2"} & set(kept)
    elif name == "near_copies":
        assert kept == sorted(["1", "None", "3", "4", "6", "7"])
    else:
        assert kept == sorted(["1", "2", "3", "3", "4", "5", "7", "None"])


def test_rows_that_share_an_id_are_judged_one_by_one(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    good = docs.where("length(text) > 400").orderBy("doc_id").limit(1)
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    for name, bad in (("language", "12345 67"), ("benchmark", f"so {item} then")):
        both = docs.union(good.withColumn("text", F.lit(bad)))
        kept = [r.text for r in stages[name](spark, both, str(tmp_path)).where(F.col("doc_id") == good.first().doc_id).collect()]
        assert kept == [good.first().text]


def test_string_ids(spark):
    rows = spark.createDataFrame([("a", "One. Two."), ("b", None), ("7", "One. Two."), (None, "x")], "doc_id string, text string")
    assert sorted(str(r.doc_id) for r in iblt.fingerprints(rows).collect()) == ["7", "None", "a", "b"]


def test_a_hot_id_does_not_break_a_bound(spark):
    rows = spark.range(500).select((F.col("id") // 400).alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    found = nnpu.bounded_sample(rows, 1, "hot").collect()
    assert len(found) == 1 and found[0].text == min(f"text {k}" for k in range(500) if k // 400 == found[0].doc_id)


def test_language_without_labels(docs):
    model = langid.train(docs, F.lit(False))
    assert {r.lang_pred for r in langid.identify(docs, model).collect()} <= {langid.UNKNOWN}


def test_repeats(docs):
    found = suffixes.drop_repeats(docs).collect()
    same_rows(docs, found)
    for r in found:
        whole = r.doc_id in (4, 5)
        assert (r.n_removed == r.n_bytes > 0) == whole
        assert r.n_spans == whole


def test_fingerprints(docs):
    found = iblt.fingerprints(docs).collect()
    same_rows(docs, found)
    if found:
        rows = by_id(found)
        assert rows[4].fingerprint == rows[5].fingerprint and rows[4].near_next == 1
        assert rows[1].fingerprint == rows[2].fingerprint and rows[1].near_next == rows[1].near_edited == 1
        assert rows[1].n_chars == 0


@pytest.mark.parametrize("learn", [True, False])
def test_toxicity(docs, labels, learn):
    found = nnpu.score(docs, nnpu.train(docs, labels, F.lit(learn))).collect()
    same_rows(docs, found)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)


def test_quality(docs, labels):
    found = cotrain.score(docs, cotrain.train(docs, labels)).collect()
    same_rows(docs, found)
    assert all(0 <= r.score <= 1 for r in found)
    nothing = cotrain.score(docs, cotrain.train(docs, labels.limit(0))).collect()
    assert all(r.score == 0.5 for r in nothing)


def test_near_duplicates(docs):
    found = simhash.near_duplicates(docs).collect()
    same_rows(docs, found)
    if found:
        rows = by_id(found)
        assert rows[2].fingerprint == "0" * 16 and rows[2].component_id == 1
        assert rows[5].component_id == 4
        kept = simhash.keep_one(docs)
        assert kept.columns == docs.columns
        assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "None", "3", "4", "6", "7"])
