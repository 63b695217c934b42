"""Rounding of binary values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_binary(c: Column, places: int = 3) -> Column:
    """A double rounded to 5 places at most by its exact binary value, a tie to the even digit: 2.675, which is less than it looks, gives 2.67.

    The value is taken apart into two integers, of 2**-30 and of 2**-90, whose sum is exact for all sizes that can be near a tie. From
    2**20 on, and for values that are not finite, Spark's own rounding is used.
    """
    if not 0 <= places <= 5:
        raise ValueError("0 to 5 places")
    size = F.abs(c)
    high = F.floor(size * float(1 << 30)).cast("long")
    low = ((size * float(1 << 30) - high) * float(1 << 60)).cast("long")
    whole = F.lit(str(1 << 60)).cast("decimal(38,0)")
    one = F.lit(str(1 << 90)).cast("decimal(38,0)")
    scaled = (high.cast("decimal(16,0)") * whole + low.cast("decimal(19,0)")).cast("decimal(34,0)") * F.lit(10**places).cast("decimal(6,0)")
    scaled = scaled.cast("decimal(38,0)")
    digits = F.floor(size * (10**places)).cast("long") - 1  # at most one off, before the exact comparison

    def rest(d: Column) -> Column:
        """Twice what is left above ``d``, less one unit: its sign tells on which side of the tie between ``d`` and the next the value lies."""
        return ((scaled - (d.cast("decimal(12,0)") * one).cast("decimal(38,0)")).cast("decimal(37,0)") * 2 - one).cast("decimal(38,0)")

    up = lambda d: (rest(d) > 0) | ((rest(d) == 0) & (F.pmod(d, F.lit(2)) == 1))
    found = digits + F.when(up(digits + 1), F.lit(2)).when(up(digits), F.lit(1)).otherwise(F.lit(0))
    exact = F.signum(c) * (F.greatest(found, F.lit(0)) / float(10**places))
    return F.when(size < float(1 << 20), F.when(exact == 0, c * 0.0).otherwise(exact)).otherwise(F.round(c, places))
