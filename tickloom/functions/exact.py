"""Sums of doubles that do not depend on the order of addition.

A double is cut into whole numbers of 30 bits without any rounding (scaling by powers of two, flooring and
subtracting the floor are exact). Whole numbers add up the same in any order, on the map side and after the
shuffle, in a hash aggregation. Exact for values of 2**-37 to 2**60 in size; what is smaller is cut
at 2**-90. A group with a larger, infinite or NaN value gets the plain sum. A group of more than 2**33 rows fails with an
overflow rather than being wrong.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_LIMB, _FRACTIONS, _WIDEST = 2.0**30, 3, 2.0**60


def _limbs(value: Column) -> list[Column]:
    """Whole numbers: multiples of 2**30, units, and three limbs of the fraction."""
    high = F.floor(value / _LIMB)
    rest = value - high * _LIMB
    limbs = [high, F.floor(rest)]
    for _ in range(_FRACTIONS):
        rest = (rest - F.floor(rest)) * _LIMB
        limbs.append(F.floor(rest))
    return limbs


def exact_sum(value: Column) -> Column:
    """Aggregate: the sum, rounded at the end alone. NULL rows are left out; without others it is NULL."""
    known = F.when(F.abs(value) < _WIDEST, value)
    high, units, *fraction = [F.sum(limb) for limb in _limbs(known)]
    # Put together as decimals: what cancels is gone before anything is rounded.
    def whole(limb: Column) -> Column:
        return limb.cast("decimal(20, 0)")

    size = F.lit(int(_LIMB)).cast("decimal(10, 0)")
    units = whole(high) * size + whole(units)
    upper = whole(fraction[0]) * size + whole(fraction[1])
    total = units.cast("double") + (upper.cast("double") + fraction[2].cast("double") / _LIMB) / _LIMB**2
    return F.when(F.coalesce(F.max(F.abs(value)) >= _WIDEST, F.lit(False)), F.sum(value)).otherwise(total)
