"""Seeded random columns computed from an id.

`F.rand(seed)` depends on the partitioning of its input. Here every number is a function of
(id, seed) alone, so a re-run, a lost executor or another partitioning gives the same value.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 13
HASH_SPAN = 16**HASH_DIGITS  # 2**52: every value is exact as a DOUBLE


def _column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def _text(value) -> Column:
    return value.cast("string") if isinstance(value, Column) else F.lit(str(value))


def hash52(id_col, seed) -> Column:
    """52-bit integer from the id and a seed (a literal or a column)."""
    text = F.concat(_column(id_col).cast("string"), F.lit(":"), _text(seed))
    return F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("bigint")


def uniform(id_col, seed, lo: float = 0.0, hi: float = 1.0) -> Column:
    """Uniform number on [lo, hi)."""
    unit = hash52(id_col, seed) / F.lit(float(HASH_SPAN))
    return F.lit(float(lo)) + unit * F.lit(float(hi) - float(lo))


def normal(id_col, seed, mean: float = 0.0, sd: float = 1.0) -> Column:
    """Normal number by the Box-Muller transform of two independent uniform streams."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(id_col, f"{seed}r")))
    angle = F.cos(F.lit(2.0 * math.pi) * uniform(id_col, f"{seed}a"))
    return F.lit(float(mean)) + radius * angle * F.lit(float(sd))
