"""The encoder's memory of words, words encoded many to a call, and the size of batches that reach a worker."""

import random
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import spiece
from barloom.llm.common import BATCH_BYTES
from barloom.llm.queries import PIECE_MODEL

pytestmark = pytest.mark.skipif(not Path(PIECE_MODEL).exists(), reason="no model")


def made_texts():
    rng = random.Random(4)
    common = ["the", "of", "été", "12", "日本", "\u2581", "a\nb"]
    rare = ["".join(rng.choices("abcdefgéß日😀", k=rng.randrange(1, 12))) for _ in range(600)]
    return [" ".join(rng.choices(common, k=8) + rng.sample(rare, 20)) for _ in range(80)] + ["", "   ", " x  y "]


def test_words_met_again_are_not_encoded_again():
    data, texts = Path(PIECE_MODEL).read_bytes(), made_texts()
    plain, small = spiece.Encoder(data, True), spiece.Encoder(data, True, most=300)
    learned = []
    real = small.learn
    small.learn = lambda words: (learned.extend(words), real(words))
    got = [small.encode(texts[k : k + 4]) for k in range(0, len(texts), 4)]
    expected = [plain.encode(texts[k : k + 4]) for k in range(0, len(texts), 4)]
    assert all(np.array_equal(a, b) for g, e in zip(got, expected, strict=True) for a, b in zip(g, e, strict=True))
    assert learned.count("\u2581the") == 1
    assert len(small.number) <= 300 + 4 * 30


def test_many_words_in_a_call_have_the_ids_of_each_word():
    encoder = spiece.Encoder(Path(PIECE_MODEL).read_bytes())
    words = list(dict.fromkeys(w for t in made_texts() for w in encoder.split.findall(encoder.model.normal(t))))
    ids, sizes = encoder.encoded(words)
    each = [encoder.words.encode(w, add_special_tokens=False).ids for w in words]
    assert sizes.tolist() == [len(x) for x in each] and ids.tolist() == [i for x in each for i in x]


def test_stages_hand_small_batches_to_workers(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    corpus_pipeline.token_stage(spark, docs, "")

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])

    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("x"), 5000).alias("text"))
    assert max(r.n for r in rows.mapInArrow(sizes, "n long").collect()) < 2 * BATCH_BYTES
