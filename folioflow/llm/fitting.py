"""Small numpy fits on bounded samples: weighted logistic regression and score calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


class Logistic:
    """L2-regularised logistic regression on standardised columns, fitted by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, l2: float = 1.0, steps: int = 25):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0)
        self.scale = np.where(self.scale > 1e-9, self.scale, 1.0)
        z = self._columns(x)
        weight = np.ones(len(y)) if weight is None else weight
        w = np.zeros(z.shape[1])
        ridge = np.full(z.shape[1], l2)
        ridge[-1] = 1e-3
        for _ in range(steps):
            p = sigmoid(z @ w)
            slope = z.T @ (weight * (p - y)) + ridge * w
            curve = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + np.diag(ridge)
            step = np.linalg.solve(curve, slope)
            size = np.abs(step).max()
            w -= step * min(1.0, 5.0 / max(size, 1e-12))
            if size < 1e-6:
                break
        self.w = w

    def _columns(self, x: np.ndarray) -> np.ndarray:
        # far outliers are held at the edge of what the fit has seen
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([z, np.ones((len(x), 1))])

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self._columns(np.asarray(x, np.float64)) @ self.w


class Platt:
    """Log-odds of a raw score, fitted on rows the model has not seen."""

    def __init__(self, score: np.ndarray, y: np.ndarray):
        fit = Logistic(score[:, None], y.astype(float), l2=1e-2)
        self.slope = max(0.0, fit.w[0] / fit.scale[0])
        self.shift = fit.w[1] - fit.w[0] * fit.mean[0] / fit.scale[0]
        if self.slope == 0.0:                        # a useless or reversed score says no more than the prior
            p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
            self.shift = float(np.log(p / (1 - p)))

    def logit(self, score: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * score + self.shift, -20, 20)
