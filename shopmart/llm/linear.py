"""One-dimensional logistic calibration, shared by the classifiers."""

from __future__ import annotations

import numpy as np


def fit_sigmoid(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3,
                rounds: int = 50) -> tuple[float, float]:
    """(slope, intercept) of P(y = 1) = sigmoid(slope * x + intercept).

    Newton steps on the log-likelihood with Platt's smoothed targets; without
    rows of both classes the constant 0.5 (or the smoothed share of the one class).
    """
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    if not n1 or not n0:
        return 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    slope, intercept = 0.0, 0.0
    for _ in range(rounds):
        p = sigmoid(slope * x + intercept)
        g = np.array([((p - target) * x).sum() + ridge * slope, (p - target).sum()])
        w = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(w * x * x).sum() + ridge, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        slope, intercept = slope - step[0], intercept - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(slope), float(intercept)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))
