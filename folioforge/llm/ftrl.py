"""Linear models of sparse rows, trained on a bounded sample by follow-the-regularised-leader.

The sample's size is a parameter of the operators that call this, so training
is a fixed amount of work on the driver; corpus statistics and predictions are
Spark jobs over all rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Penalties:
    """Step size ``alpha``/``beta`` and elastic net: ``l1`` keeps weights at zero, ``l2`` shrinks the others."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 0.5
    epochs: int = 3


Row = tuple[np.ndarray, np.ndarray]


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_multinomial(rows: list[Row], labels: np.ndarray, features: int, classes: int, p: Penalties, seed: int = 0) -> np.ndarray:
    """Weights (features, classes), most of them zero. A row is (indices, values)."""
    z, n = np.zeros((features, classes)), np.zeros((features, classes))

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zz = z[at]
        w = -(zz - np.sign(zz) * p.l1) / ((p.beta + np.sqrt(n[at])) / p.alpha + p.l2)
        return np.where(np.abs(zz) > p.l1, w, 0.0)

    order = np.random.default_rng(seed)
    for _ in range(p.epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            w = weights(at)
            error = softmax(x @ w)
            error[labels[k]] -= 1
            g = x[:, None] * error
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / p.alpha * w
            n[at] = new
    return weights(slice(None))


def fit_binary(rows: list[Row], labels: np.ndarray, features: int, p: Penalties, seed: int = 0) -> np.ndarray:
    """Weights (features,) of the log-odds of label 1."""
    z, n = np.zeros(features), np.zeros(features)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        zz = z[at]
        w = -(zz - np.sign(zz) * p.l1) / ((p.beta + np.sqrt(n[at])) / p.alpha + p.l2)
        return np.where(np.abs(zz) > p.l1, w, 0.0)

    order = np.random.default_rng(seed)
    for _ in range(p.epochs):
        for k in order.permutation(len(rows)):
            at, x = rows[k]
            w = weights(at)
            g = x * (1 / (1 + np.exp(-np.clip(x @ w, -35, 35))) - labels[k])
            old = n[at]
            new = old + g * g
            z[at] += g - (np.sqrt(new) - np.sqrt(old)) / p.alpha * w
            n[at] = new
    return weights(slice(None))


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes held-back labels most likely, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        q = softmax(logits / np.exp(t))
        return -np.log(np.maximum(q[np.arange(len(labels)), labels], 1e-300)).mean()

    lo, hi, g = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(50):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))
