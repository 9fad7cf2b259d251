"""Column expressions shared by the operators: rounding, clipping, finiteness."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: 2 sqrt(2 ln 2): full width at half maximum of a Gaussian per sigma.
FWHM = 2.0 * math.sqrt(2.0 * math.log(2.0))
#: Support under which an interpolated value counts as outside.
SUPPORT = 1.0e-3


def snapped(v: Column) -> Column:
    """Nearest millionth: summation order can't move a value across a rounding tie."""
    return F.floor(v * F.lit(1e6) + F.lit(0.5)).cast("double") / F.lit(1e6)


def to_range(v: Column, rounding: str, low: float = 0.0, high: float = 65535.0) -> Column:
    """Rounded (``half_even`` or ``half_up``) and clipped; NaN becomes 0."""
    known = F.nanvl(v, F.lit(0.0))
    whole = F.rint(known) if rounding == "half_even" else F.floor(known + F.lit(0.5)).cast("double")
    return F.least(F.greatest(whole, F.lit(low)), F.lit(high))


def finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))


def micro(v: Column) -> Column:
    """Published form of a floating result: whole millionths, so that engines agree."""
    return F.floor(v * F.lit(1e6) + F.lit(0.5)).cast("long")
