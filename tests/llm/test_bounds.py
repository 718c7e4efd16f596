"""Training takes its whole samples and all its steps."""

import inspect

import numpy as np

from barloom.llm import cotrain, langid


def test_samples_are_not_lowered():
    assert langid.SAMPLE_PER_LANG == 600
    assert (cotrain.LABELLED, cotrain.POOL, cotrain.ADDED, cotrain.CONTENT) == (4000, 8000, 400, 2048)
    assert inspect.signature(cotrain.logistic).parameters["steps"].default == 300


def test_later_rounds_take_all_steps():
    pick = np.random.default_rng(1)
    x = pick.normal(0, 1, (200, 3)).astype(np.float32)
    y = (x[:, 0] > 0).astype(float)
    fresh = cotrain.logistic(x, y)
    warm = cotrain.logistic(x, y, cotrain.View(np.zeros(3, np.float32), 0.0))
    assert np.allclose(fresh.weights, warm.weights) and np.isclose(fresh.bias, warm.bias)
