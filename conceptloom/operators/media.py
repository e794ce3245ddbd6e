"""Features of decoded images, for adapters that have pixels: arrays of height x width (x 3), values 0 to 255."""

from __future__ import annotations

import numpy as np


def gray(pixels: np.ndarray) -> np.ndarray:
    return pixels.astype(float) if pixels.ndim == 2 else pixels.astype(float) @ np.array([0.114, 0.587, 0.299])


def brightness_and_sharpness(pixels: np.ndarray) -> tuple[float, float]:
    """Mean gray value, and the variance of the Laplacian."""
    g = gray(pixels)
    if min(g.shape) < 3:
        return float(g.mean()) if g.size else 0.0, 0.0
    edges = g[:-2, 1:-1] + g[2:, 1:-1] + g[1:-1, :-2] + g[1:-1, 2:] - 4 * g[1:-1, 1:-1]
    return float(g.mean()), float(edges.var())


def colour_histogram(pixels: np.ndarray, bins: int = 32) -> np.ndarray:
    """Shares of the cells of a cube of colours."""
    cells = (pixels.reshape(-1, 3).astype(int) * bins) // 256
    counts = np.bincount((cells[:, 0] * bins + cells[:, 1]) * bins + cells[:, 2], minlength=bins**3)
    return counts / max(1, counts.sum())


def correlation(a: np.ndarray, b: np.ndarray) -> float:
    """Pearson correlation of two histograms; two constant ones are alike."""
    x, y = a - a.mean(), b - b.mean()
    n = float(np.sqrt((x @ x) * (y @ y)))
    return float(x @ y) / n if n else 1.0
