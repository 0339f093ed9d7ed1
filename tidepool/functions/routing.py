"""Format routing (S3): declared format substring first, else file suffix."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPREADSHEET_SUFFIXES = (".xlsx", ".xls")


def route_format(declared: Column, file_name: Column, spreadsheet_first: bool = False) -> Column:
    """``csv``, ``spreadsheet`` or ``unknown``.

    Validation tests csv first; the transform step tests spreadsheet first
    (``spreadsheet_first=True``), so a file declared ``csv`` but named ``.xlsx``
    routes differently in the two steps.
    """
    fmt = F.coalesce(declared, F.lit(""))
    suffix = F.lower(F.regexp_extract(file_name, r"(\.[^./]*)$", 1))
    is_csv = fmt.contains("csv") | (suffix == ".csv")
    is_sheet = fmt.contains("spreadsheet") | suffix.isin(*SPREADSHEET_SUFFIXES)
    if spreadsheet_first:
        return F.when(is_sheet, "spreadsheet").when(is_csv, "csv").otherwise("unknown")
    return F.when(is_csv, "csv").when(is_sheet, "spreadsheet").otherwise("unknown")
