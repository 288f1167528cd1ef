"""Logistic regression for small dense inputs on the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40.0, 40.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50,
                 weight: np.ndarray | None = None) -> np.ndarray:
    """Newton steps with a ridge on all weights but the first, which belongs to a column of ones."""
    weight = np.ones(len(y)) if weight is None else weight
    penalty = np.full(x.shape[1], ridge * weight.sum() / 100 + 1e-6)
    penalty[0] = 1e-6
    beta = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ beta)
        gradient = x.T @ (weight * (p - y)) + penalty * beta
        curve = x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + np.diag(penalty)
        step = np.linalg.solve(curve, gradient)
        beta -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return beta
