"""Numeric coercion and bounding functions.

All casts are ``try_cast`` so a malformed value becomes null instead of
aborting the job (ANSI mode is on by default in Spark 4).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_number(c, dtype: str = "double") -> Column:
    """Coerce to a number; anything unparsable → null."""
    return _c(c).cast("string").try_cast(dtype)


def decimal_comma(c, dtype: str = "double") -> Column:
    """Parse a decimal-comma string (``'0,0217'``) → number, bad → null."""
    return F.replace(F.trim(_c(c).cast("string")), F.lit(","), F.lit(".")).try_cast(dtype)


def fill_sentinel(c, value=-1) -> Column:
    """Null → sentinel."""
    return F.coalesce(_c(c), F.lit(value))


def to_int(c, strict: bool = False) -> Column:
    """To 64-bit integer.  ``strict`` fails the job on a null (the
    non-nullable cast of the reference); otherwise nulls stay null."""
    # Through a double only what isn't written as an integer: it has 53 bits.
    v = F.coalesce(to_number(c, "bigint"), to_number(c, "double").try_cast("bigint"))
    if strict:
        return F.when(F.assert_true(v.isNotNull(), F.lit("null in non-nullable integer")).isNull(), v)
    return v


def fill_empty(c, value="") -> Column:
    """C4: null → '' (strings) or 0 (numbers)."""
    return F.coalesce(_c(c), F.lit(value))


def clip(c, lo=None, hi=None) -> Column:
    """Bound a value below and/or above; null stays null."""
    v = _c(c)
    if lo is not None:
        v = F.when(v.isNull(), v).otherwise(F.greatest(v, F.lit(lo)))
    if hi is not None:
        v = F.when(v.isNull(), v).otherwise(F.least(v, F.lit(hi)))
    return v


def floor_at(c, lo) -> Column:
    """``max(lo, x)``."""
    return clip(c, lo=lo)


def pct_to_votes(pct, total) -> Column:
    """votes = percentage × total / 100."""
    return _c(pct) * _c(total) / F.lit(100.0)


def fixed_decimals(c, digits: int = 3) -> Column:
    """Fixed-decimal text of a score (``f"{v:.3f}"``)."""
    return F.format_string(f"%.{digits}f", _c(c).cast("double"))


def even_grid(x0, x1, n: int = 100) -> Column:
    """Array of ``n`` evenly spaced values from x0 to x1 inclusive
    (``numpy.linspace``).  Explode it to get one row per grid point."""
    x0c, x1c = _c(x0).cast("double"), _c(x1).cast("double")
    if n == 1:
        return F.array(x0c)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: x0c + i.cast("double") * (x1c - x0c) / F.lit(float(n - 1)))
