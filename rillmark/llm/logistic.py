"""A logistic curve over a few features and their products, fitted in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PRODUCTS = 20


def _products(features: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """The scaled features, held to four deviations, and the products of every two."""
    scaled = np.clip((features - mean) / scale, -4, 4)
    a, b = np.triu_indices(scaled.shape[1])
    return np.concatenate([scaled, scaled[:, a] * scaled[:, b]], 1)


@dataclass
class Logistic:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    offset: float

    @classmethod
    def fit(cls, features: np.ndarray, truth: np.ndarray, totals: tuple[int, int], decay: float = 0.5) -> Logistic:
        """Newton steps with a quadratic penalty on balanced classes; ``totals`` are the rows of label 0 and 1 there are.

        With one class only, the curve is flat at the share of label 1 among all.
        """
        width = features.shape[1]
        share = (totals[1] + 0.5) / (sum(totals) + 1)
        prior = float(np.log(share / (1 - share)))
        n = np.bincount(truth, minlength=2)
        if not n.all():
            return cls(np.zeros(width), np.ones(width), np.zeros(width + width * (width + 1) // 2), prior)
        mean, scale = features.mean(0), features.std(0) + 1e-9
        x = np.concatenate([_products(features, mean, scale), np.ones((len(truth), 1))], 1)
        width = x.shape[1] - 1
        weight = np.where(truth == 1, 0.5 / n[1], 0.5 / n[0])
        beta = np.zeros(width + 1)
        # fewer rows, stronger penalty; products are held back more than the features themselves
        penalty = np.diag([decay / len(truth)] * features.shape[1] + [PRODUCTS * decay / len(truth)] * (width - features.shape[1]) + [0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ beta, -40, 40)))
            slope = x.T @ (weight * (p - truth)) + penalty @ beta
            curvature = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(width + 1)
            step = np.linalg.solve(curvature, slope)
            beta -= np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        return cls(mean, scale, beta[:-1], float(beta[-1]) + prior)

    def chance(self, features: np.ndarray) -> np.ndarray:
        z = _products(features, self.mean, self.scale) @ self.weights + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))
