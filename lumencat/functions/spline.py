"""Quadratic interpolating splines: solved once with numpy, evaluated as a Spark expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookup import among


def basis(knots: np.ndarray, degree: int, x: np.ndarray) -> np.ndarray:
    """Values of all B-splines of a degree at x (the last knot's interval is closed)."""
    last = np.searchsorted(knots, knots[-1]) - 1
    span = np.clip(np.searchsorted(knots, x, "right") - 1, 0, last)
    out = (np.arange(len(knots) - 1) == span[:, None]).astype(float)
    for d in range(1, degree + 1):
        n = len(knots) - 1 - d
        width = knots[d:-1] - knots[: n]
        after = knots[d + 1 :] - knots[1 : n + 1]
        rise = np.divide(x[:, None] - knots[:n], width[:n], out=np.zeros((len(x), n)), where=width[:n] > 0)
        fall = np.divide(knots[d + 1 : d + 1 + n] - x[:, None], after[:n], out=np.zeros((len(x), n)), where=after[:n] > 0)
        out = rise * out[:, :n] + fall * out[:, 1 : n + 1]
    return out


@dataclass(frozen=True)
class Curve:
    """Pieces a + b t + c t^2, t = x - start; constants outside [lowest, highest]."""

    starts: tuple[float, ...]
    coefficients: tuple[tuple[float, float, float], ...]
    highest: float
    below: float
    above: float

    def column(self, x: Column) -> Column:
        """The curve at x."""

        def piece(i: int) -> Column:
            (a, b, c), t = self.coefficients[i], x - self.starts[i]
            return a + t * (b + t * c)

        return F.when(x < self.starts[0], self.below).when(x > self.highest, self.above).otherwise(among(x, self.starts, piece))

    def sql(self, x: str) -> str:
        """The same as a SQL expression."""
        whens = "".join(f" WHEN {x} >= {s!r} THEN {a!r} + ({x} - {s!r}) * ({b!r} + ({x} - {s!r}) * {c!r})" for s, (a, b, c) in reversed([*zip(self.starts, self.coefficients, strict=True)]))
        return f"(CASE WHEN {x} < {self.starts[0]!r} THEN {self.below!r} WHEN {x} > {self.highest!r} THEN {self.above!r}{whens} END)"


def quadratic(x: Sequence[float], y: Sequence[float], above: float = 0.0, below: float | None = None) -> Curve:
    """The quadratic spline through (x, y) with knots midway between inner nodes."""
    x, y = np.asarray(x, float), np.asarray(y, float)
    if len(x) < 3 or (np.diff(x) <= 0).any():
        raise ValueError("a quadratic spline needs three or more rising nodes")
    inner = ((x[1:] + x[:-1]) / 2)[1:-1]
    knots = np.concatenate([[x[0]] * 3, inner, [x[-1]] * 3])
    weights = np.linalg.solve(basis(knots, 2, x), y)
    edges = np.concatenate([[x[0]], inner, [x[-1]]])
    pieces = []
    for a, b in zip(edges, edges[1:], strict=False):
        t = np.array([0.0, 0.5, 1.0 - 1e-9]) * (b - a)
        pieces.append(tuple(map(float, np.polynomial.polynomial.polyfit(t, basis(knots, 2, a + t) @ weights, 2))))
    return Curve(tuple(map(float, edges[:-1])), tuple(pieces), float(x[-1]), float(y[0] if below is None else below), float(above))
