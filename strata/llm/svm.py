"""Linear support vector machine and logistic calibration on a bounded training matrix."""

from __future__ import annotations

import numpy as np


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 200) -> np.ndarray:
    """Weights (bias last) of an L2-regularised squared-hinge SVM; ``y`` holds +1 and -1.

    Accelerated gradient descent on the whole matrix; both classes weigh the same in total. The matrix is not copied.
    """
    y = y.astype(x.dtype)  # one type throughout, or every product would copy the matrix
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(x.dtype) * x.dtype.type(cost)
    step = 1.0 / (1.0 + 2.0 * float((share * (np.einsum("ij,ij->i", x, x) + 1)).sum()))
    w = np.zeros(x.shape[1] + 1, dtype=x.dtype)
    ahead, before = w.copy(), 1.0
    for _ in range(rounds):
        slack = np.maximum(0.0, 1.0 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = share * slack * y
        gradient = ahead - 2.0 * np.append(x.T @ pull, pull.sum())
        new = (ahead - step * gradient).astype(x.dtype)
        now = (1 + np.sqrt(1 + 4 * before * before)) / 2
        ahead = (new + (before - 1) / now * (new - w)).astype(x.dtype)
        w, before = new, now
    return w


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights (bias last) of a logistic regression of ``y`` (0 or 1), by Newton's method."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w
