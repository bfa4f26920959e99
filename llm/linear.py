"""Small logistic models, over rows in memory or sums of rows that lie elsewhere."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], penalty: np.ndarray, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method; ``sums`` gives the loss's slope and curve at some weights, without the penalty."""
    w = np.zeros(len(penalty))
    for _ in range(steps):
        slope, curve = sums(w)
        step = np.linalg.solve(curve + np.diag(penalty + 1e-9), slope + penalty * w)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def slope_and_curve(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    p = sigmoid(x @ w)
    return x.T @ (p - y), (x * (p * (1 - p))[:, None]).T @ x


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, free: int = 0, steps: int = 50) -> np.ndarray:
    """Weights of a ridge-penalised logistic regression by Newton's method; the first ``free`` go unpenalised."""
    penalty = np.full(x.shape[1], ridge)
    penalty[:free] = 1e-6
    return newton(lambda w: slope_and_curve(x, y, w), penalty, steps)
