"""Provenance log: append-only sink, scan and compact view."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed


def append_entries(entries: DataFrame, path: str, stamp: Column | None = None) -> None:
    """Append entries as JSON lines, each stamped (``current_timestamp`` unless given)."""
    ts = stamp if stamp is not None else F.date_format(F.current_timestamp(), fixed.ISO_TIMESTAMP)
    entries.withColumn("timestamp", ts).write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Scan the log with a declared schema (no inference pass)."""
    return spark.read.schema(schema).json(path)


def compact(log: DataFrame, width: int = fixed.SUMMARY_DETAIL_CHARS) -> DataFrame:
    """S9 display: action, time, and every other field as JSON cut at ``width`` characters."""
    others = [c for c in log.columns if c not in ("action", "timestamp")]
    detail = F.to_json(F.struct(*[F.col(c) for c in others]))
    cut = F.when(F.length(detail) > width, F.concat(F.substring(detail, 1, width), F.lit("..."))).otherwise(detail)
    return log.select(F.coalesce(F.col("action"), F.lit("unknown")).alias("action"),
                      F.coalesce(F.col("timestamp"), F.lit("")).alias("timestamp"), cut.alias("detail"))


def config_fingerprint(config: Column, length: int = 16) -> Column:
    """H2: leading hex characters of the SHA-256 of a serialised configuration row."""
    return F.substring(F.sha2(F.to_json(config), 256), 1, length)


def canonical(value: Column, dtype: T.DataType) -> Column:
    """A nested value with the keys of its structs and maps in order at every level; arrays keep theirs."""
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name)
        inner = F.struct(*[canonical(value[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(value.isNotNull(), inner)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: canonical(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        entries = F.transform(F.array_sort(F.map_keys(value)), lambda k: F.struct(k, canonical(value[k], dtype.valueType)))
        return F.map_from_entries(entries)
    return value


def canonical_fingerprint(df: DataFrame, config: str, length: int = 16) -> Column:
    """H2 of a nested column of ``df``, whatever the order of its fields and map keys.

    The text hashed is its JSON with keys in order, nulls written as ``null``; a null configuration has no fingerprint.
    Map keys are text. Whole numbers and text read alike everywhere; floats are written as Spark writes them.
    """
    field = df.schema[config]
    text = F.to_json(canonical(F.col(config), field.dataType), {"ignoreNullFields": "false"})
    return F.substring(F.sha2(text, 256), 1, length)
