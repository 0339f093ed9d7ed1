"""Duplicate counting (A6, A7, J-4).

Both are exact group-bys on the key (or on every column); partial aggregation
collapses a hot key map-side, so a key holding a third of the rows costs one
counter per map task, not one task holding the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions.headers import match_names


def duplicate_members(df: DataFrame, keys: list[str], subset: list[str]) -> DataFrame:
    """Rows whose ``subset`` value repeats (every member, first included), per ``keys`` group.

    Nulls compare equal, as in a row de-duplication.
    """
    per_key = df.groupBy(*keys, *subset).agg(F.count(F.lit(1)).alias("_n"))
    res = per_key.groupBy(*keys).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("duplicate_members"),
        F.count_if(F.col("_n") > 1).alias("repeated_keys"),
    )
    return res.select(*keys, *[F.col(c).cast("long").alias(c) for c in ("rows", "duplicate_members", "repeated_keys")])


def duplicate_extras(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row on ``columns`` (default all), i.e. rows minus distinct rows.

    Rows are counted by their 256-bit digest: one scan, and no text moves.
    """
    from tidepool.operators.profile import row_digest

    cols = columns or [c for c in df.columns if c not in keys]
    by_digest = df.groupBy(*keys, row_digest(cols).alias("_d")).agg(F.count(F.lit(1)).alias("_k"))
    res = by_digest.groupBy(*keys).agg(F.sum("_k").alias("rows"), F.sum(F.col("_k") - 1).alias("duplicate_rows"))
    return res.select(*keys, F.col("rows").cast("long").alias("rows"), F.col("duplicate_rows").cast("long").alias("duplicate_rows"))


def matched_keys(spark: SparkSession, columns: list[str], wanted: list[str]) -> list[str]:
    """J-4: the configured key names that exist (normalised-equality match), in order."""
    names = [r["raw_name"] for r in match_names(spark, columns, wanted).orderBy("target_no").collect()]  # at most the keys
    return list(dict.fromkeys(names))
