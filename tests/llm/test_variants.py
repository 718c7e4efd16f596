"""Spelling variants against a plain version, the index against plain search, borders of blocks, odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import variants
from tests.llm.brute import one_edit, spelling


def as_dict(found):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found}


def test_ranks_and_smaller_codes():
    rng = np.random.default_rng(0)
    codes = rng.integers(0, 90, 500).astype(np.uint8)
    text = variants.RankedText(codes, 7)
    lo = rng.integers(0, 250, 60)
    hi = lo + rng.integers(0, 250, 60)
    code = rng.integers(0, 92, 60)
    a, b, smaller = text.one(lo, hi, code)
    for k in range(60):
        assert (a[k], b[k]) == ((codes[: lo[k]] == code[k]).sum(), (codes[: hi[k]] == code[k]).sum())
        assert smaller[k] == (codes[lo[k] : hi[k]] < code[k]).sum()
    row, found, a, b, smaller = text.all(lo, hi)
    assert sorted(zip(row.tolist(), found.tolist(), strict=True)) == [(k, int(c)) for k in range(60) for c in np.unique(codes[lo[k] : hi[k]])]
    assert all(smaller[i] == (codes[lo[k] : hi[k]] < found[i]).sum() for i, k in enumerate(row))


@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdeÿ×z"])
def test_both_searches_find_every_near_pair_once(letters):
    words = sorted({"".join(random.Random(k).choices(letters, k=6 + k % 4)) for k in range(250)})
    found = []
    for mirrored in (False, True):
        members = sorted(w[::-1] for w in words) if mirrored else words
        index = variants.BidirectionalIndex([w.encode("latin-1") for w in members])
        rows = variants.best_near(index, members, np.ones(len(members), np.int64), members, mirrored).to_pylist()
        found += [(r["word"], r["n_near"]) for r in rows]
    near = {w: sum(one_edit(w, v) for v in words) for w in words}
    assert near == {w: sum(n for v, n in found if v == w) for w in words}


def test_an_index_extends_to_both_sides_alike():
    index = variants.BidirectionalIndex([b"banana", b"bananas", b"cabana"])
    start = index.everything(np.array([0]), np.array([0]))
    for order in ("ana", "naa"):
        front = start
        for k, letter in enumerate({"ana": "ana", "naa": "naa"}[order]):
            front = index.extended(front, variants.CODE[[ord(letter)]].astype(np.int64), to_left=order == "ana" or k == 2)
        assert front.size[0] == {"ana": 5, "naa": 5}[order]


@pytest.mark.parametrize("block", [variants.BLOCK, 64])
def test_variants_of_a_table_equal_a_plain_version(spark, monkeypatch, block):
    monkeypatch.setattr(variants, "BLOCK", block)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = as_dict(variants.spelling_variants(docs).collect())
    assert found == spelling([(r.doc_id, r.text) for r in docs.collect()])
    assert any(f is not None for _, _, f, _, _ in found.values())


def test_chains_ties_nulls_and_clashes(spark):
    texts = ["abcdef " * 5, "abcdeg " * 30, "abcdhg " * 150, "bbcdhg " * 150, "zzàÀ÷×zz " * 6, "UPPERS uppers " * 3, "tiny", "", None]
    rows = [(k, t) for k, t in enumerate(texts)] + [(None, "noidhere " * 5), (50, "x" * 70000 + " 1"), (51, "abcdef")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("own") for c in ("word", "n", "form", "root", "best", "key", "block")})
    docs = docs.union(docs.where("doc_id = 5"))
    found = as_dict(variants.spelling_variants(docs).collect())
    assert found == spelling([(r.doc_id, r.text) for r in docs.collect()])
    assert found["abcdef"][4] == "abcdhg" and "zzàÀ÷×zz" in found
    assert variants.spelling_variants(docs.limit(0)).isEmpty()
