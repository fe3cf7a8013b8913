"""A small logistic regression on sparse hashed features, fitted on a bounded table."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Sparse:
    """Rows of (feature, value); ``indptr[i]`` is where row i begins."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray

    def __post_init__(self) -> None:
        self.rows = np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.rows, self.values * weights[self.indices], minlength=len(self.indptr) - 1)

    def transposed_dot(self, per_row: np.ndarray, n_features: int) -> np.ndarray:
        return np.bincount(self.indices, self.values * per_row[self.rows], minlength=n_features)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * x))


def fit_logistic(
    x: Sparse,
    y: np.ndarray,
    n_features: int,
    l2: float,
    rounds: int = 150,
    rate: float = 0.3,
    pairs: tuple[Sparse, np.ndarray] | None = None,
) -> tuple[np.ndarray, float]:
    """Weights and intercept by full-batch Adam, the same for the same input.

    ``pairs`` holds differences between rows and their counterfactuals with a penalty for each:
    their squared score change, averaged, is added to the loss.
    """
    w, b = np.zeros(n_features), 0.0
    m, v, mb, vb = np.zeros(n_features), np.zeros(n_features), 0.0, 0.0
    n = max(1, len(y))
    for step in range(1, rounds + 1):
        miss = (sigmoid(x.dot(w) + b) - y) / n
        grad, grad_b = x.transposed_dot(miss, n_features) + l2 * w, miss.sum()
        if pairs is not None and len(pairs[1]):
            change, penalty = pairs
            grad += change.transposed_dot(2 * penalty * change.dot(w) / len(penalty), n_features)
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        mb, vb = 0.9 * mb + 0.1 * grad_b, 0.99 * vb + 0.01 * grad_b**2
        up, down = 1 - 0.9**step, 1 - 0.99**step
        w -= rate * (m / up) / (np.sqrt(v / down) + 1e-8)
        b -= rate * (mb / up) / (np.sqrt(vb / down) + 1e-8)
    return w, float(b)
