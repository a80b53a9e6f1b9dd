"""Douglas-Peucker simplification as an Arrow-batched kernel."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F


def kept(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Numbers of the points that stay: of a stretch, the farthest from its chord if that is farther than the tolerance."""
    stay, todo = {0, len(x) - 1}, [(0, len(x) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        px, py = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a]
        dx, dy = x[b] - x[a], y[b] - y[a]
        square = dx * dx + dy * dy
        t = np.clip((px * dx + py * dy) / square, 0, 1) if square else np.zeros(len(px))
        gap = np.hypot(px - t * dx, py - t * dy)
        k = int(gap.argmax())
        if gap[k] > tolerance:
            stay.add(a + 1 + k)
            todo += [(a, a + 1 + k), (a + 1 + k, b)]
    return np.array(sorted(stay))


def simplified(tolerance: float):
    """A function of (array of x, array of y) columns that gives the numbers of the points that stay."""

    @F.pandas_udf("array<int>")
    def run(xs: pd.Series, ys: pd.Series) -> pd.Series:
        return pd.Series([kept(np.asarray(x), np.asarray(y), tolerance) if len(x) > 1 else np.arange(len(x)) for x, y in zip(xs, ys, strict=True)])

    return run
