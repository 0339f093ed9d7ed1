"""Numeric coercion and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed
from tidepool.functions.text import strip_ws

# Text that a lenient numeric reader accepts: decimal or scientific notation
# with an optional sign, or infinity. Everything else (``nan``, ``1.0d``,
# ``0x10``, ``1_000``, ``28,5``, blanks, booleans) is missing.
NUMBER_PATTERN = r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"

BARE_NUMBER = NUMBER_PATTERN.removesuffix("$") + r"\z"  # not before a last line break


def to_number(c: Column, dtype: T.DataType | None = None) -> Column:
    """Coerce to double; unparsable text and NaN become null."""
    if dtype is not None and isinstance(dtype, T.NumericType):
        d = c.cast("double")
        return F.when(~F.isnan(d), d)
    if dtype is not None and isinstance(dtype, T.BooleanType):
        return F.lit(None).cast("double")
    raw = c.cast("string")
    s = strip_ws(raw)
    # most numbers have no white space about them and need no stripping
    return F.when(raw.rlike(BARE_NUMBER), raw.try_cast("double")).when(s.rlike(NUMBER_PATTERN), s.try_cast("double"))


def round4(c: Column) -> Column:
    """Statistics are reported to 4 places (half-up)."""
    return F.round(c, 4)


def pct(part: Column, whole: Column, places: int = 2) -> Column:
    """``part / whole * 100`` rounded; 0 when ``whole`` is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.round(part / whole * 100.0, places))


def out_of_range(x: Column, lo: Column, hi: Column) -> Column:
    """Strictly outside the inclusive bounds."""
    return (x < lo) | (x > hi)


def fill_number(x: Column) -> Column:
    """Missing numbers are encoded with the fill value."""
    return F.coalesce(x.cast("double"), F.lit(fixed.FILL_NUMBER))
