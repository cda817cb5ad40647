"""Look-up of a value among breakpoints as a binary tree of comparisons: compiled code, no arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def among(x: Column, starts: Sequence[float | Column | None], leaf: Callable[[int], Column]) -> Column:
    """leaf(i) for the last start i that is not above x (leaf(0) below the first); starts are numbers or literal columns."""

    def tree(lo: int, hi: int) -> Column:
        if hi - lo == 1:
            return leaf(lo)
        middle = (lo + hi) // 2
        start = starts[middle]
        return F.when(x < (start if isinstance(start, Column) else float(start)), tree(lo, middle)).otherwise(tree(middle, hi))

    return tree(0, len(starts))
