"""Header and name normalisation (F1, F3) and column-role lookup.

Names are data: a ``columns`` table of many datasets, or a small table of one
schema's columns; the same column expressions serve both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.text import strip_ws

_SEPARATORS = r"(?U)[\s\-.]+"
_NOT_NAME = r"[^a-z0-9_]"


def normalize_header(c: Column) -> Column:
    """strip, lower, separators to ``_``, drop other symbols, collapse and trim ``_``."""
    h = F.lower(strip_ws(c))
    h = F.regexp_replace(h, _SEPARATORS, "_")
    h = F.regexp_replace(h, _NOT_NAME, "")
    h = F.regexp_replace(h, "_+", "_")
    return F.btrim(h, F.lit("_"))


def file_slug(c: Column) -> Column:
    """lower, every symbol to ``_`` (not deleted), collapse and trim ``_``."""
    h = F.regexp_replace(F.lower(c), _NOT_NAME, "_")
    h = F.regexp_replace(h, "_+", "_")
    return F.btrim(h, F.lit("_"))


def column_names(spark: SparkSession, columns: list[str]) -> DataFrame:
    """P1/P2 as data: ``(ordinal, raw_name, norm_name)`` of a schema's columns."""
    t = spark.createDataFrame(list(enumerate(columns)), "ordinal int, raw_name string")
    return t.withColumn("norm_name", normalize_header(F.col("raw_name")))


def normalized_names(spark: SparkSession, columns: list[str]) -> list[str]:
    """Normalised names of a schema, in order; a name met before gets the number of times it was met."""
    names = [r["norm_name"] or "column" for r in column_names(spark, columns).orderBy("ordinal").collect()]
    met = [names[:i].count(n) for i, n in enumerate(names)]
    return [f"{n}_{k}" if k else n for n, k in zip(names, met)]


def match_names(spark: SparkSession, columns: list[str], wanted: list[str]) -> DataFrame:
    """``(target_no, target, raw_name)``, the first column whose normalised header equals the lower-cased target."""
    t = spark.createDataFrame(list(enumerate(wanted)), "target_no int, target string")
    hits = column_names(spark, columns).join(t, F.col("norm_name") == F.lower("target"))
    return hits.groupBy("target_no", "target").agg(F.min_by("raw_name", "ordinal").alias("raw_name"))


def keyword_columns(columns: list[str], keywords, first: bool = False):
    """Columns whose lower-cased name contains any keyword."""
    if isinstance(keywords, str):
        keywords = (keywords,)
    hits = [c for c in columns if any(k in c.lower() for k in keywords)]
    return (hits[0] if hits else None) if first else hits


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
