"""Helpers the operators share: tables, row identity, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stored

WHITE = b" \t\n\x0b\x0c\r"  # the characters [\x20\x09-\x0D]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_keys(df: DataFrame, *cols: str) -> list[Column]:
    """What tells rows apart where ids may repeat or be null: the columns themselves, hashed if text."""
    return [F.xxhash64(df[c]) if dict(df.dtypes)[c] == "string" else df[c] for c in cols]


def keep_rows(docs: DataFrame, kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose (id, text) is in ``kept(id, text_hash)``, one of each, all their columns.

    A null id or text matches a null one. ``text_hash`` is xxhash64(text), null for a null text. Rows that
    repeat id and text are one row; which of them stays shows only in other columns.

    Whole rows are shuffled once and stream past a hash table of the keys, so no text is ever sorted. Only rows that
    repeat both id and text, if the table has any, go on to a window, whose key gathers no more than such repeats.
    """
    left = docs.withColumns({"_tp_id": F.col(f"`{id_col}`"), "_tp_hash": text_hash(text_col)})
    right = kept.select(F.col(id_col).alias("_tk_id"), F.col("text_hash").alias("_tk_hash")).distinct()
    on = left["_tp_id"].eqNullSafe(right["_tk_id"]) & left["_tp_hash"].eqNullSafe(right["_tk_hash"])
    found = left.join(right.hint("shuffle_hash"), on, "left_semi")
    again = left.groupBy(F.col("_tp_id").alias("_tr_id"), F.col("_tp_hash").alias("_tr_hash")).agg(F.count("*").alias("_tr_n"))
    again = stored(again.where("_tr_n > 1").drop("_tr_n"))
    if not again.isEmpty():
        on = found["_tp_id"].eqNullSafe(again["_tr_id"]) & found["_tp_hash"].eqNullSafe(again["_tr_hash"])
        one = Window.partitionBy("_tp_id", "_tp_hash").orderBy("_tp_hash")
        repeats = found.join(again, on, "left_semi").withColumn("_tp_n", F.row_number().over(one)).where("_tp_n = 1").drop("_tp_n")
        found = found.join(again, on, "left_anti").unionAll(repeats)
    return found.select(*(F.col(f"`{c}`") for c in docs.columns))


def text_hash(text_col: str) -> Column:
    """xxhash64 of the text, null for null (Spark's own gives the seed)."""
    c = F.col(f"`{text_col}`")
    return F.when(c.isNotNull(), F.xxhash64(c))


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors, once a session: they may have no copy of their own.

    Arrow batches, where the session says nothing of their size, are cut at 8 MB, as a Python worker holds some of them.
    """
    import os
    import tempfile
    import zipfile

    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")
    if _SHIPPED.get("to") is sc:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidepool-"), "tidepool_modules.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)  # Spark's own file server hands it out
    _SHIPPED["to"] = sc


_SHIPPED: dict = {}


def map_rows(df: DataFrame, rows: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """``rows`` over each partition as Python tuples, in Arrow batches both ways."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    ship(df.sparkSession)
    out = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches):
        def tuples():
            for b in batches:
                # a slice at a time, so that few Python copies of long texts live at once
                for k in range(0, b.num_rows, 256):
                    part = b.slice(k, 256)
                    yield from zip(*(c.to_pylist() for c in part.columns))

        held, weight = [], 0
        for r in rows(tuples()):
            held.append(r)
            weight += 64 + sum(_weight(v) for v in r if hasattr(v, "__len__"))
            if len(held) >= 5000 or weight > 1 << 23:
                yield _batch(pa, held, out)
                held, weight = [], 0
        if held:
            yield _batch(pa, held, out)

    return df.mapInArrow(run, schema)


def _weight(v) -> int:
    """About how many bytes a value takes; a list of arrays takes what they take."""
    if isinstance(v, list) and v and hasattr(v[0], "nbytes"):
        return sum(x.nbytes for x in v)
    return getattr(v, "nbytes", 0) or len(v)


def _batch(pa, rows, schema):
    cols = zip(*rows)
    return pa.RecordBatch.from_arrays([_column(pa, c, f.type) for c, f in zip(cols, schema)], schema=schema)


def _column(pa, values, kind):
    """An Arrow array of a column's values; numpy arrays, and lists of them, are copied as a whole and not number by number."""
    import numpy as np

    def offsets(parts):
        return pa.array(np.cumsum([0, *map(len, parts)]), pa.int32())

    if pa.types.is_list(kind):
        if all(isinstance(v, np.ndarray) and v.ndim == 1 for v in values):
            return pa.ListArray.from_arrays(offsets(values), pa.array(np.concatenate(values), kind.value_type)).cast(kind)
        if pa.types.is_list(kind.value_type) and all(isinstance(v, list) and all(isinstance(x, np.ndarray) for x in v) for v in values):
            inner = [x for v in values for x in v]
            if inner:
                return pa.ListArray.from_arrays(offsets(values), _column(pa, inner, kind.value_type)).cast(kind)
    return pa.array(values, kind)
