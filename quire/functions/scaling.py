"""Column expressions for scores: safe division, min-max scaling, rounding,
convergence terms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values. Scores print half-up to 5 digits, IDF to 6 digits; the range
# starts at max = 0.0 and min = the largest double; equal ends scale to 0.5.
SCORE_DIGITS = 5
IDF_DIGITS = 6
RANGE_MAX_START = 0.0
RANGE_MIN_START = 1.7976931348623157e308
FLAT_RANGE_VALUE = 0.5
NAN = float("nan")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio_or_nan(num, den) -> Column:
    """num / den, with 0/0 (and x/0) giving NaN as Java double division does.

    Spark 4 in ANSI mode raises on division by zero, so the zero case is
    taken out before dividing.
    """
    return F.when(_col(den) == 0, F.lit(NAN)).otherwise(_col(num) / _col(den))


def not_nan(c) -> Column:
    """The value, or null for NaN, so max/min skip it as ``d > max`` does."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def minmax_scale(value, lo, hi, digits: int | None = SCORE_DIGITS) -> Column:
    """(v - lo) / (hi - lo); 0.5 when hi == lo; NaN printed as 0.0."""
    v, lo, hi = _col(value), _col(lo), _col(hi)
    scaled = F.when(hi == lo, F.lit(FLAT_RANGE_VALUE)).otherwise(
        F.nanvl((v - lo) / (hi - lo), F.lit(0.0)))
    return F.round(scaled, digits) if digits is not None else scaled


def signed_change_term(new, old) -> Column:
    """float((old)^2 - (new)^2): one term of the reference's convergence sum."""
    return (_col(old) * _col(old) - _col(new) * _col(new)).cast("float").cast("double")


def l2_change_term(new, old) -> Column:
    d = _col(new) - _col(old)
    return d * d
