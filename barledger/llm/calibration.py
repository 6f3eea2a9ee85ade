"""Isotonic calibration from counts in bins, so that any number of rows gives a model of bounded size."""

from __future__ import annotations

import numpy as np


def isotonic(values: np.ndarray, weights: np.ndarray, positives: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Points (value, share) of the non-decreasing shares that fit weighted counts best, by pooling adjacent violators.

    values ascend; each has a weight and the weight of its positives. A pool is at the weighted mean of its values.
    Without any weight the share is a half everywhere.
    """
    pools: list[list[float]] = []
    for value, weight, positive in zip(values, weights, positives, strict=True):
        if weight <= 0:
            continue
        pools.append([value * weight, weight, positive])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top, strict=True)]
    if not pools:
        return np.zeros(1), np.full(1, 0.5)
    table = np.array(pools)
    return table[:, 0] / table[:, 1], np.clip(table[:, 2] / table[:, 1], 0, 1)


def calibrated(values: np.ndarray, points: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Shares at values, linear between the points."""
    return np.interp(values, *points)
