"""One row of each group of near copies stays."""

import random

from pyspark.sql import functions as F

from barloom.llm import simhash
from tests.llm import brute
from tests.llm.test_methods import frame


def test_one_row_of_each_component_stays(spark):
    """Chains of small edits, beside texts of their own."""
    pick = random.Random(3)
    texts = []
    for _ in range(6):
        words = [f"w{pick.randrange(10**6)}" for _ in range(500)]
        for _ in range(12):
            texts.append(" ".join(words))
            words[pick.randrange(500)] = f"new{pick.randrange(10**6)}"
    pick.shuffle(texts)
    groups = brute.components({k: brute.simhash(t, 4) for k, t in enumerate(texts)}, 4)
    kept = [r.doc_id for r in simhash.keep_one(frame(spark, texts)).collect()]
    assert sorted(kept) == sorted(set(groups.values())) and 6 <= len(kept) < len(texts)


def test_rows_that_share_an_id_or_have_none(spark):
    long = [" ".join(f"{name}{k}" for k in range(60)) for name in "abcd"]
    rows = [(1, long[0]), (1, long[0]), (1, long[1]), (2, long[1]), (None, long[1]), (None, long[2]), (None, long[2]), (None, long[3]), (3, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("id", "same", "none", "gone", "count")})
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        [("1", long[0]), ("1", long[1]), ("None", long[2]), ("None", long[3]), ("3", "")]
    )
