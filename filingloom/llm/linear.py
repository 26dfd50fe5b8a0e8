"""Small dense logistic models, fitted on the driver on bounded samples."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25, offset: np.ndarray | float = 0.0) -> np.ndarray:
    """Weights, intercept last, by Newton steps; y may be probabilities. offset: what is added to each row's score."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(x @ w + offset)
        g = x.T @ (p - y) + penalty * w
        h = (x * np.maximum(p * (1 - p), 1e-6)[:, None]).T @ x + np.diag(penalty)
        move = np.linalg.solve(h, g)
        size = np.abs(move).max()
        w -= move * min(1, 5 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def fit_sparse(row: np.ndarray, column: np.ndarray, value: np.ndarray, y: np.ndarray, width: int, offset: np.ndarray, ridge: float = 1.0, steps: int = 60) -> np.ndarray:
    """Weights of sparse features beside an offset, by steps of adaptive size along the whole gradient."""
    w, seen = np.zeros(width), np.full(width, 1e-8)
    for _ in range(steps):
        p = sigmoid(offset + np.bincount(row, value * w[column], len(y)))
        g = np.bincount(column, value * (p - y)[row], width) + ridge * w
        seen += g * g
        w -= 0.3 * g / np.sqrt(seen)
    return w


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])
