"""The cleaning step as one lazy projection (§3.1: F2, P1, T1/T2, T4, N1, P14).

Order matters as in the reference: text is stripped first, headers are
renamed next, and time and coordinate columns are picked by their
*normalised* names. No shuffle: one stage, any number of files, and the same
function serves a batch DataFrame or a streaming one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed
from tidepool.functions.headers import keyword_columns, normalized_names
from tidepool.functions.numeric import to_number
from tidepool.functions.temporal import iso_utc, parse_timestamp
from tidepool.functions.text import clean_text
from tidepool.session import stored
from tidepool.sources.text_tables import read_text_table, write_csv


@dataclass(frozen=True)
class TransformConfig:
    strip_whitespace: bool = True
    normalize_headers: bool = True
    timestamp_format: str | None = "auto"  # None disables the step
    standardize_coordinates: bool = True
    na_representation: str | None = None  # applied at the sink only when set


def transform(df: DataFrame, cfg: TransformConfig = TransformConfig()) -> tuple[DataFrame, dict[str, str]]:
    """Clean ``df``; returns the cleaned frame and the raw -> normalised header map."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = {c: F.col(f"`{c}`") for c in df.columns}
    if cfg.strip_whitespace:
        cols = {c: clean_text(e) if isinstance(types[c], T.StringType) else e for c, e in cols.items()}
    names = normalized_names(df.sparkSession, df.columns) if cfg.normalize_headers else list(df.columns)
    mapping = dict(zip(df.columns, names))
    out = {mapping[c]: e for c, e in cols.items()}
    ntypes = {mapping[c]: types[c] for c in df.columns}
    if cfg.timestamp_format is not None:
        for c in keyword_columns(list(out), fixed.TIME_KEYWORDS_TRANSFORM):
            if isinstance(ntypes[c], T.StringType):  # text only (numbers named *time* stay numbers)
                out[c] = iso_utc(parse_timestamp(out[c], cfg.timestamp_format))
            elif isinstance(ntypes[c], (T.TimestampType, T.TimestampNTZType, T.DateType)):
                out[c] = iso_utc(out[c].cast("timestamp"))
    if cfg.standardize_coordinates:
        for c in keyword_columns(list(out), (fixed.LAT_KEYWORD, fixed.LON_KEYWORD)):
            out[c] = to_number(out[c], ntypes[c])
    if cfg.na_representation is not None:
        out = {c: F.coalesce(e.cast("string"), F.lit(cfg.na_representation)) for c, e in out.items()}
    return df.select(*[e.alias(c) for c, e in out.items()]), mapping


class RowsLost(RuntimeError):
    """A cleaned file holds other rows or values than were sent to it."""


def _filled(df: DataFrame, prefix: str) -> list[Column]:
    """How many values of each column are there; texts are missing when blank or ``nan``."""
    out = [F.count(F.lit(1)).alias("rows")]
    for k, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        text = isinstance(f.dataType, T.StringType)
        out.append(F.count_if(F.coalesce(clean_text(c), F.lit("")) != "" if text else c.isNotNull()).alias(f"{prefix}{k}"))
    return out


def transform_to_csv(raw: DataFrame, path: str, cfg: TransformConfig = TransformConfig(), line_ending: str = "unix") -> DataFrame:
    """§3.1 + J-9: clean ``raw``, write it as CSV, read it back; the transform summary, one row a column.

    ``rows_in`` and ``filled_in`` are observed on the raw side of the write itself, ``rows_out`` and ``filled_out`` on
    its cleaned side, so raw data is read once; ``rows_back`` and ``filled_back`` come from the written files.
    ``rejected`` counts values that were there and that the cleaning could not read. ``ok``: no row was lost on
    the way and every value sent is in the files. The step has no shuffle, so a task that is run again counts once.
    """
    before, after = Observation(), Observation()
    watched = raw.observe(before, *_filled(raw, "c"))
    cleaned, mapping = transform(watched, cfg)
    names = cleaned.columns
    write_csv(cleaned.observe(after, *_filled(cleaned, "c")), path, line_ending, cfg.na_representation or "")
    a, b = before.get, after.get
    written = read_text_table(raw.sparkSession, path, names, multi_line=True).select(*[F.col(f"`{c}`") for c in names])
    back = written.agg(*_filled(written, "c"))
    def seen(n):
        return F.lit(n).cast("bigint")

    rows = [F.struct(
        F.lit(c).alias("column"), F.lit(mapping[c]).alias("header"), F.lit(c != mapping[c]).alias("renamed"),
        seen(a["rows"]).alias("rows_in"), seen(b["rows"]).alias("rows_out"), F.col("rows").alias("rows_back"),
        seen(a[f"c{k}"]).alias("filled_in"), seen(b[f"c{k}"]).alias("filled_out"), F.col(f"c{k}").alias("filled_back"),
        seen(a[f"c{k}"] - b[f"c{k}"]).alias("rejected"),
        ((F.col("rows") == F.lit(b["rows"])) & F.lit(a["rows"] == b["rows"]) & (F.col(f"c{k}") == F.lit(b[f"c{k}"]))).alias("ok"),
    ) for k, c in enumerate(raw.columns)]
    return stored(back.select(F.explode(F.array(*rows)).alias("r")).select("r.*"))  # the files are read once


def raise_if_lost(summary: DataFrame) -> None:
    """Raise :class:`RowsLost` naming the columns of a transform summary that are not ``ok`` (one row a column)."""
    bad = [f"{r['header']}: {r['rows_in']} in, {r['rows_out']} out, {r['rows_back']} read back" for r in summary.where("NOT ok").collect()]
    if bad:
        raise RowsLost("; ".join(bad))
