"""Small gradient-boosted trees: fitted with numpy, scored as a SQL expression.

Logistic loss, histogram splits on quantile bins, depth-wise trees.  A fitted
model is plain numbers; expression() turns it into nested CASE columns, so
that scoring needs no Python on executors.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Trees:
    features: list[str]
    base: float = 0.0
    #: each tree: nested (feature, threshold, left, right) with floats as leaves
    trees: list = field(default_factory=list)
    #: Platt scaling of the raw score
    scale: tuple[float, float] = (1.0, 0.0)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for t in self.trees:
            out += _apply(t, x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-(a * self.raw(x) + b)))

    def expression(self, column: dict[str, Column]) -> Column:
        """Calibrated probability as a column; `column` has one per feature."""
        total = F.lit(self.base)
        for t in self.trees:
            total = total + _case(t, self.features, column)
        a, b = self.scale
        return 1 / (1 + F.exp(-(total * F.lit(a) + F.lit(b))))


def _apply(t, x: np.ndarray) -> np.ndarray:
    if not isinstance(t, tuple):
        return np.full(len(x), t)
    f, cut, left, right = t
    return np.where(x[:, f] <= cut, _apply(left, x), _apply(right, x))


def _case(t, names: list[str], column: dict[str, Column]) -> Column:
    if not isinstance(t, tuple):
        return F.lit(float(t))
    f, cut, left, right = t
    return F.when(column[names[f]] <= F.lit(float(cut)), _case(left, names, column)).otherwise(_case(right, names, column))


def _grow(x, grad, hess, rows, depth: int, cuts, reg: float, least: int):
    g, h = grad[rows].sum(), hess[rows].sum()
    leaf = float(-g / (h + reg))
    if depth == 0 or len(rows) < 2 * least:
        return leaf
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        v = x[rows, f]
        for cut in cuts[f]:
            left = v <= cut
            n = left.sum()
            if n < least or len(rows) - n < least:
                continue
            gl, hl = grad[rows[left]].sum(), hess[rows[left]].sum()
            gain = gl * gl / (hl + reg) + (g - gl) ** 2 / (h - hl + reg) - g * g / (h + reg)
            if gain > best[0]:
                best = (gain, f, cut)
    if best[1] is None:
        return leaf
    _, f, cut = best
    left = x[rows, f] <= cut
    return (f, float(cut), _grow(x, grad, hess, rows[left], depth - 1, cuts, reg, least), _grow(x, grad, hess, rows[~left], depth - 1, cuts, reg, least))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    features: list[str],
    calibrate: np.ndarray | None = None,
    leave: np.ndarray | None = None,
    rounds: int = 30,
    depth: int = 3,
    rate: float = 0.3,
    bins: int = 8,
    reg: float = 1.0,
    least: int = 5,
) -> Trees:
    """Boost on (x, y in {0, 1}).

    Rows of `calibrate` (every fourth, if not given) calibrate the scores,
    those of `leave` are not looked at, the others grow the trees.
    """
    held = np.arange(len(x)) % 4 == 3 if calibrate is None else calibrate
    grow = ~held if leave is None else ~held & ~leave
    xt, yt = x[grow], y[grow].astype(float)
    rate_pos = np.clip(yt.mean() if len(yt) else 0.5, 0.01, 0.99)
    model = Trees(features, float(np.log(rate_pos / (1 - rate_pos))))
    cuts = [np.unique(np.quantile(xt[:, f], np.linspace(0, 1, bins + 1)[:-1])) if len(xt) else [] for f in range(x.shape[1])]
    score = np.full(len(xt), model.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        t = _grow(xt, p - yt, p * (1 - p), np.arange(len(xt)), depth, cuts, reg, least)
        if not isinstance(t, tuple):
            break
        t = _scaled(t, rate)
        model.trees.append(t)
        score += _apply(t, xt)
    raw, yc = model.raw(x[held]), y[held].astype(float)
    a, b = 1.0, 0.0
    for _ in range(200):  # Platt scaling by gradient steps, lightly held to the identity
        p = 1 / (1 + np.exp(-(a * raw + b)))
        a -= 0.05 * (((p - yc) * raw).mean() + 0.01 * (a - 1)) if len(raw) else 0
        b -= 0.05 * ((p - yc).mean() + 0.01 * b) if len(raw) else 0
    model.scale = (float(max(a, 0.1)), float(b))
    return model


def _scaled(t, rate: float):
    return (t[0], t[1], _scaled(t[2], rate), _scaled(t[3], rate)) if isinstance(t, tuple) else t * rate
