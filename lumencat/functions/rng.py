"""Random numbers keyed by (seed, stream, id): independent of partitioning and order."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: str, stream: str, row_id: Column) -> Column:
    """A uniform in [0, 1) from the first 52 bits of an md5; other engines can reproduce it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:{stream}:"), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def normal(seed: str, stream: str, row_id: Column) -> Column:
    """A standard normal deviate by Box-Muller over two uniforms."""
    radius = F.sqrt(-2 * F.log(uniform(seed, f"{stream}a", row_id) + 1e-16))
    return radius * F.cos(2 * math.pi * uniform(seed, f"{stream}b", row_id))
