"""Sparse hashed features and logistic regression, as several classifiers here use them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows of sparse features: those of row i are ``index[first[i]:first[i + 1]]``."""

    index: np.ndarray
    value: np.ndarray
    first: np.ndarray

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int32), np.diff(self.first))

    @staticmethod
    def stack(parts: list["Sparse"]) -> "Sparse":
        sizes = np.concatenate([np.diff(p.first) for p in parts])
        return Sparse(
            np.concatenate([p.index for p in parts]),
            np.concatenate([p.value for p in parts]),
            np.concatenate([[0], np.cumsum(sizes)]),
        )


def counted(index: np.ndarray, first: np.ndarray, dims: int) -> Sparse:
    """Distinct features of each row with how often they occur."""
    row = np.repeat(np.arange(len(first) - 1, dtype=np.int64), np.diff(first))
    key, count = np.unique(row * dims + index, return_counts=True)
    return Sparse(
        (key % dims).astype(np.int32), count.astype(np.float32), np.searchsorted(key // dims, np.arange(len(first)))
    )


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_logistic(
    x: Sparse, y: np.ndarray, dims: int, rounds: int = 60, rate: float = 0.5, decay: float = 1e-4
) -> tuple[np.ndarray, np.ndarray]:
    """Weights (dims, classes) and biases of a softmax regression, by adaptive gradient steps.

    ``y`` has a class number per row, or, for two classes, 0 and 1 and one column of weights.
    """
    classes = int(y.max()) + 1 if y.max() > 1 else 1
    target = np.eye(classes)[y] if classes > 1 else y[:, None].astype(np.float64)
    row, n = x.row, len(y)
    weights, bias = np.zeros((dims, classes)), np.zeros(classes)
    squares, bias_squares = np.full((dims, classes), 1e-8), np.full(classes, 1e-8)
    for _ in range(rounds):
        z = bias + np.stack([np.bincount(row, weights[x.index, k] * x.value, n) for k in range(classes)], axis=1)
        error = (softmax(z) if classes > 1 else logistic(z)) - target
        error /= n
        for k in range(classes):
            grad = np.bincount(x.index, error[row, k] * x.value, dims) + decay * weights[:, k]
            squares[:, k] += grad**2
            weights[:, k] -= rate * grad / np.sqrt(squares[:, k])
        grad = error.sum(axis=0)
        bias_squares += grad**2
        bias -= rate * grad / np.sqrt(bias_squares)
    return weights, bias


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit_platt(z: np.ndarray, y: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities (Platt), by Newton steps.

    Targets are pulled in from 0 and 1, so separable scores keep a finite slope.
    """
    positive, negative = y.sum(), len(y) - y.sum()
    if not positive or not negative:
        return 1.0, 0.0
    target = np.where(y > 0, (positive + 1) / (positive + 2), 1 / (negative + 2))
    scale = max(float(np.std(z)), 1e-6)
    x = np.stack([z / scale, np.ones(len(z))], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = logistic(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])
