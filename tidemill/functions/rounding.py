"""Rounding of the exact binary value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(value: Column, digits: int) -> Column:
    """Nearest decimal with ``digits`` places to the double itself, halves to even.

    ``bround`` rounds the shortest decimal text of a double, so 0.505 (stored as slightly
    more than that) is a tie for it and becomes 0.50; here it becomes 0.51. The product with
    the scale is kept with its rounding error (a split multiplication), which decides the
    cases where the product alone looks like a tie. For magnitudes below 2**52 / scale.
    """
    scale = F.lit(float(10**digits))
    scaled = value * scale
    big = value * F.lit(134217729.0)
    high = big - (big - value)
    error = (high * scale - scaled) + (value - high) * scale
    down = F.floor(scaled)
    tie = scaled - down == 0.5
    nearest = F.when(tie & (error > 0), down + 1).when(tie & (error < 0), down).otherwise(F.rint(scaled))
    return nearest.cast("double") / scale
