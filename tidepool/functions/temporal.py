"""Timestamp parsing and rendering."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed
from tidepool.functions.text import strip_ws

# --- Fixed values: text layouts tried in order after ISO-8601 ----------------
AUTO_FORMATS = (
    "M/d/yyyy H:mm:ss",
    "M/d/yyyy H:mm",
    "M/d/yyyy",
    "dd-MMM-yyyy HH:mm:ss",
    "dd-MMM-yyyy HH:mm",
    "dd-MMM-yyyy",
    "MM/dd/yy hh:mm a",
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "dd.MM.yyyy HH:mm",
    "dd.MM.yyyy",
    "yyyyMMdd'T'HHmmss",
    "yyyyMMdd",
    "MMM d yyyy HH:mm:ss",
    "MMM d yyyy HH:mm",
    "MMM d yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
)

# --- Fixed values: C strptime directive -> Java DateTimeFormatter letters ----
STRPTIME_TO_JAVA = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%I": "hh",
    "%M": "mm", "%S": "ss", "%f": "SSSSSS", "%p": "a", "%b": "MMM", "%B": "MMMM",
    "%a": "EEE", "%A": "EEEE", "%j": "DDD", "%z": "XX", "%Z": "zzz", "%%": "%",
}


def strptime_to_java(fmt: str) -> str:
    """Translate a strptime format into a Java pattern; literal letters are quoted."""
    out, i, literal = [], 0, []

    def flush():
        if literal:
            text = "".join(literal).replace("'", "''")
            out.append(f"'{text}'" if any(ch.isalpha() for ch in text) else text)
            literal.clear()

    while i < len(fmt):
        two = fmt[i:i + 2]
        if two in STRPTIME_TO_JAVA:
            flush()
            out.append(STRPTIME_TO_JAVA[two])
            i += 2
        else:
            literal.append(fmt[i])
            i += 1
    flush()
    return "".join(out)


# --- Fixed values: a two-digit year at or above this is read as 19xx (POSIX) --
TWO_DIGIT_YEAR_PIVOT = 69


def _try_layout(s: Column, java: str) -> Column:
    """Parse with one Java pattern; two-digit years pivot as strptime does (69-99 -> 19xx)."""
    t = F.try_to_timestamp(s, F.lit(java))
    if "yy" in java and "yyy" not in java:
        t = F.when(F.year(t) >= 2000 + TWO_DIGIT_YEAR_PIVOT, t - F.expr("INTERVAL 100 YEARS")).otherwise(t)
    return t


# what a run of one pattern letter looks like in text
_LOOKS = {"yyyy": r"\d{4}", "yy": r"\d{2}", "MMMM": "[A-Za-z]{3,9}", "MMM": "[A-Za-z]{3}", "a": "[AaPp][Mm]"}
#: ISO-8601 with a four-digit year and a month; what follows the day (clock, offset, zone) is left to the parser
ISO_SHAPE = r"^\d{4}-\d{1,2}(-\d{1,2}([T ].*)?)?$"
SLASHED_MONTH_FIRST = "M/d/yyyy"


def shape_of(java: str) -> str:
    """The regular expression of texts that a Java pattern can parse, made from the pattern letter by letter."""
    out = []
    for quoted, run, _letter, other in re.findall(r"'([^']*)'|(([A-Za-z])\3*)|([^A-Za-z'])", java):
        if run:
            out.append(_LOOKS.get(run) or (r"\d{1,2}" if len(run) == 1 else rf"\d{{{len(run)}}}"))
        else:
            out.append(re.escape(quoted or other))
    return f"^{''.join(out)}$"


def parse_timestamp(c: Column, fmt: str | None = None, formats=AUTO_FORMATS, day_first: Column | None = None) -> Column:
    """T1 (explicit format) / T2, T3 (``auto``: by the shape of each text).

    A layout is tried only on texts that look like it, so a text costs one or two parses, and none if it looks
    like no layout (bare years, six digits, clock times). Bad values become null; text with an offset is converted
    to UTC. ``day_first`` (a condition, see ``operators.dates``) reads ``1/2/2021`` as the first of February.
    """
    s = strip_ws(c.cast("string"))
    if fmt and fmt != "auto":
        java = strptime_to_java(fmt) if "%" in fmt else fmt
        return _try_layout(s, java)
    tries = [F.when(s.rlike(ISO_SHAPE), F.try_to_timestamp(s))]
    for f in formats:
        parsed = _try_layout(s, f)
        if day_first is not None and f.startswith(SLASHED_MONTH_FIRST):
            parsed = F.when(day_first, _try_layout(s, f.replace("M/d", "d/M", 1))).otherwise(parsed)
        tries.append(F.when(s.rlike(shape_of(f)), parsed))
    return F.coalesce(*tries)


def as_timestamp(c: Column, dtype: T.DataType | None = None) -> Column:
    """Timestamp typed input is used as is (NTZ read as UTC); text is parsed."""
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp")
    return parse_timestamp(c)


def iso_utc(ts: Column) -> Column:
    """T4: ISO-8601 text with a literal ``Z``."""
    return F.date_format(ts, fixed.ISO_TIMESTAMP)


def iso_date(ts: Column) -> Column:
    return F.date_format(ts, fixed.ISO_DATE)


def has_time_keyword(name: str, keywords=fixed.TIME_KEYWORDS_PROFILE) -> bool:
    return any(k in name.lower() for k in keywords)
