"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode whitespace at either end; Spark's ``trim`` removes spaces only.
_EDGE_WS = r"(?U)^\s+|\s+$"


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, _EDGE_WS, "")


def clean_text(c: Column) -> Column:
    """strip whitespace; missing and the text ``nan`` become empty text."""
    s = strip_ws(c)
    return F.when(c.isNull() | (s == F.lit("nan")), F.lit("")).otherwise(s)


def is_nonblank(c: Column) -> Column:
    """Not null and not blank after stripping."""
    return c.isNotNull() & (strip_ws(c) != F.lit(""))


def present(c: Column) -> Column:
    """The value if it is non-blank text, else null."""
    return F.nullif(strip_ws(c), F.lit(""))


def fill_text(c: Column, na: str = "") -> Column:
    """Render any value as text with missing as ``na``."""
    return F.coalesce(c.cast("string"), F.lit(na))
