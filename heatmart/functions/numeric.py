"""Rounding and guarded statistics."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero, on millionths (digits up to 6).

    Going through millionths hides the last bits of a double, so sums taken in
    another order round alike, and 1.005 rounds to 1.01. rint() takes ties to
    even, hence the nudge of a tenth of a millionth away from zero; adding zero
    turns a negative zero positive. Plain arithmetic: no decimals, no branch.
    """
    step = 10.0 ** (6 - digits)
    units = F.rint(value * 1e6) / step + F.signum(value) * (0.1 / step)
    return F.rint(units) / (10.0 ** digits) + 0.0


def no_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over the rows where both sides are present; NULL where undefined."""
    x, y = no_nan(x), no_nan(y)
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x), F.when(both, y)
    return F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
