"""The ordinal fit against a second optimiser on the same features."""

import random

import numpy as np
import pytest

from tabulyst.llm import quality


def loss(p, x, grade):
    """Penalised mean negative log-likelihood; the biases as the first and falls from it."""
    w, biases = p[:-2], np.array([p[-2], p[-2] - np.exp(p[-1])])
    tail = 1 / (1 + np.exp(-(x @ w)[:, None] - biases))
    tail = np.concatenate([np.ones((len(x), 1)), tail, np.zeros((len(x), 1))], axis=1)
    at = np.arange(len(x))
    return -np.log(np.maximum(tail[at, grade] - tail[at, grade + 1], 1e-12)).mean() + quality.PENALTY / 2 * (w @ w)


def newton(x, grade, start):
    """Newton's steps with gradient and curvature by differences."""
    p, h = start.copy(), 1e-4
    eye = np.eye(len(p)) * h

    def slope(q):
        return np.array([loss(q + e, x, grade) - loss(q - e, x, grade) for e in eye]) / (2 * h)

    for _ in range(25):
        g = slope(p)
        curve = np.array([slope(p + e) - slope(p - e) for e in eye]) / (2 * h)
        step = np.linalg.solve(curve + 1e-6 * np.eye(len(p)), g)
        size = 1.0
        while size > 1e-6 and loss(p - size * step, x, grade) > loss(p, x, grade):
            size /= 2
        p = p - size * step
    return p


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_same_optimum(monkeypatch, chunk):
    monkeypatch.setattr(quality, "CHUNK", chunk)
    monkeypatch.setattr(quality, "SUPPORT", 1)
    monkeypatch.setattr(quality, "STEPS", 1500)
    rng, width = random.Random(4), 6
    x = np.array([[rng.gauss(0, 1) for _ in range(width)] for _ in range(400)], np.float32)
    hidden = x @ np.array([1.5, -1, 0.5, 0, 0.2, -0.7]) + np.array([rng.gauss(0, 1.5) for _ in range(400)])
    grade = np.digitize(hidden, [-1.0, 0.8])
    row, bucket = np.repeat(np.arange(400), width), np.tile(np.arange(width) * 1000, 400)
    model = quality.fit(row, bucket, x.ravel(), grade)
    fitted = np.concatenate([model.weights[::1000][:width], [model.biases[0], np.log(model.biases[0] - model.biases[1])]])
    best = newton(x.astype(float), grade, np.zeros(width + 2))
    assert loss(fitted, x, grade) <= loss(best, x, grade) + 1e-5

    def tails(p):
        return 1 / (1 + np.exp(-(x @ p[:-2])[:, None] - np.array([p[-2], p[-2] - np.exp(p[-1])])))

    assert np.abs(tails(fitted) - tails(best)).max() < 1e-3
