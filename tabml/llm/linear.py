"""Small learners that fit on a bounded sample on the driver: sparse logistic regression
and probability calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def calibrated(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn margins into probabilities (smoothed targets, Newton)."""
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    if not pos or not neg:
        return 1.0, 0.0
    n = weight.sum()
    weight = weight / n
    target = np.where(y == 1, 1 - 1 / (len(y) + 2), 1 / (len(y) + 2))
    scale = max(float(np.sqrt((weight * margin**2).sum())), 1e-12)
    x = margin / scale
    a, b = 1.0, 0.0
    for _ in range(60):
        p = sigmoid(a * x + b)
        g = weight * (p - target)
        h = weight * np.maximum(p * (1 - p), 1e-9)
        ga, gb = (g * x).sum() + 1e-5 * a, g.sum()
        haa, hab, hbb = (h * x * x).sum() + 1e-5, (h * x).sum(), h.sum() + 1e-9
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        size = max(abs(da), abs(db))
        damp = min(1.0, 2.0 / size) if size else 0.0
        a, b = a - damp * da, b - damp * db
        if size < 1e-8:
            break
    return a / scale, b


def sparse_logistic(
    slots: list[np.ndarray],
    values: list[np.ndarray],
    y: np.ndarray,
    weight: np.ndarray,
    part: int,
    parts: int,
    rounds: int = 150,
) -> tuple[np.ndarray, float]:
    """Weights per slot and intercept of a ridge logistic regression (full-batch Adam).

    The slots are ``parts`` kinds of ``part`` columns. Columns are scaled by their root
    mean square and that of the strongest column of their kind, so that rare columns
    don't outweigh the rest; the scales are folded into the weights.
    """
    size = part * parts
    index = np.concatenate(slots).astype(np.int64)
    value = np.concatenate(values).astype(np.float64)
    rows = np.repeat(np.arange(len(y)), [len(s) for s in slots])
    square = np.bincount(index, value * value, size) / len(y)
    used = square > 0
    scale = np.zeros(size)
    strongest = np.repeat(square.reshape(parts, part).max(1), part)
    scale[used] = 1 / np.sqrt(square[used] + strongest[used])
    value = value * scale[index]
    weight = weight / weight.sum()
    w, b = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for t in range(1, rounds + 1):
        z = np.bincount(rows, value * w[index], len(y)) + b
        g = weight * (sigmoid(z) - y)
        gw = np.bincount(index, value * g[rows], size) + 1e-6 * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        fix1, fix2 = 1 - 0.9**t, 1 - 0.99**t
        w = w - 0.02 * (m / fix1) / (np.sqrt(v / fix2) + 1e-8)
        b = b - 0.02 * (mb / fix1) / (np.sqrt(vb / fix2) + 1e-8)
    return w * scale, b
