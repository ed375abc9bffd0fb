"""Number columns: rounding, grids, tolerances."""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

MANTISSA_BITS = 53  # of a double
UNIT_SCALE = MANTISSA_BITS  # the scale at which a whole number stands for itself


def dyadic(mass: Column, bits: int = 13) -> Column:
    """Largest multiple of ``2**-bits`` that is not above ``mass``."""
    return F.floor(mass * float(2**bits)) * F.lit(2.0**-bits)


def round_half_even(value: Column, digits: int = 4) -> Column:
    """Scale, round to the nearest even integer, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def ppm_error(observed: Column, expected: Column) -> Column:
    """Relative deviation in parts per million."""
    return (observed - expected) / expected * 1e6


def exact_parts(value: Column) -> tuple[Column, Column, Column]:
    """A double as ``whole * 2 ** (scale - 53)``: scale, whole and, apart, what is not finite.

    No digit is lost, and whole numbers of one scale add up exactly in any order.  A scale stands for 8
    binary exponents, so values of like size share one.  Whole is null for null and non-finite values.
    """
    finite = F.abs(value) <= F.lit(sys.float_info.max)  # NaN is above all numbers
    kept = F.when(finite, value)
    scale = F.coalesce((F.floor(F.log2(F.abs(kept)) / 8) * 8).cast("int"), F.lit(0))  # log2(0) is null
    whole = shifted(kept, F.lit(MANTISSA_BITS) - scale).cast("bigint")
    return scale, whole, F.when(~finite, value)


def exact_total(scale: Column, whole: Column, odd: Column) -> Column:
    """Aggregate: the sum of values in the form of :func:`exact_parts`, whose wholes were added up by scale.

    It does not depend on the order of rows; null if there are none.
    """

    def add(total: Column, part: Column) -> Column:
        return total + shifted(part["whole"].cast("double"), part["scale"] - F.lit(MANTISSA_BITS))

    present = F.when(whole.isNotNull(), F.struct(scale.alias("scale"), whole.alias("whole")))
    total = F.aggregate(F.sort_array(F.collect_list(present)), F.lit(0.0), add)
    return F.coalesce(F.sum(odd), F.when(F.count(whole) > 0, total))


def shifted(value: Column, bits: Column) -> Column:
    """``value * 2 ** bits`` in two steps, as the power alone may be out of range."""
    half = F.floor(bits / 2).cast("int")
    return value * F.pow(F.lit(2.0), half) * F.pow(F.lit(2.0), bits - half)
