"""Many datasets in one plan (A1 A3 A7 A13 A21 T5 N2, J-4 A6): a row is ``(dataset, cells)``, cells a map of column to text.

Datasets may have any columns, so their names are data, not schema: however many datasets there are, the plan is the
same, and classes, quartiles, duplicates, keys and tolerances are found by grouping. A column that a row lacks is a
missing cell of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions.headers import normalize_header
from tidepool.functions.numeric import to_number
from tidepool.operators import profile as P
from tidepool.session import stored


def as_cells(df: DataFrame, dataset: Column, columns: list[str] | None = None) -> DataFrame:
    """A table's rows as ``(dataset, cells)``."""
    cols = columns or df.columns
    return df.select(dataset.alias("dataset"), F.map_from_arrays(
        F.array(*(F.lit(c) for c in cols)), F.array(*(F.col(f"`{c}`").cast("string") for c in cols))).alias("cells"))


def column_table(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(dataset, variable)`` of all columns; ``known(dataset, variable)`` adds those that no row shows."""
    found = rows.select("dataset", F.explode(F.map_keys("cells")).alias("variable"))
    return (found.unionByName(known.select("dataset", "variable")) if known is not None else found).distinct()


def cell_table(rows: DataFrame) -> DataFrame:
    """``(dataset, variable, kind, value)`` in long form, as the profile operators take it."""
    return rows.select("dataset", F.explode("cells").alias("variable", "value")).select(
        "dataset", "variable", F.lit("text").alias("kind"), "value")


def _file_figures(rows: DataFrame, columns: DataFrame) -> DataFrame:
    """A1 A3 A7 per dataset: rows are counted by a digest of their cells in order of column, nulls left out."""
    cells = F.filter(F.map_entries("cells"), lambda e: e["value"].isNotNull())
    digest = F.unhex(F.sha2(F.to_json(F.sort_array(cells)), 256))  # compiled; array_sort would call a lambda for each comparison
    by_digest = rows.groupBy("dataset", digest.alias("_d")).agg(F.count("*").alias("_k"), F.sum(F.size(cells)).alias("_p"))
    figures = by_digest.groupBy("dataset").agg(F.sum("_k").alias("rows"), F.sum("_p").alias("_present"),
                                               F.sum(F.col("_k") - 1).alias("duplicate_rows"))
    widths = columns.groupBy(F.col("dataset").alias("_of")).agg(F.count("*").alias("columns"))
    both = widths.join(figures, F.col("dataset") == F.col("_of"), "left").withColumn("dataset", F.col("_of"))
    both = both.fillna(0, subset=["rows", "_present", "duplicate_rows"])
    cells = F.col("rows") * F.col("columns")
    return both.select("dataset", "rows", "columns", cells.alias("total_cells"), (cells - F.col("_present")).alias("total_missing"),
                       F.when(cells > 0, F.round(F.col("_present") / cells * 100.0, 2)).alias("completeness_pct"), "duplicate_rows")


def profile_catalogue(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """§3.2 for any number of datasets: figures, classes, outliers and grade of each, a row per dataset.

    Classes, the typed numbers and the columns are written once, as later passes read them again. A dataset of
    ``known`` without rows has completeness null and grade D. A null name is taken for the empty one.
    """
    rows = rows.fillna("", subset=["dataset"])
    columns = stored(column_table(rows, known))
    files = stored(_file_figures(rows, columns))
    cells = cell_table(rows)
    classes = stored(P.classify(cells, ["dataset"], files.select("dataset", "rows")))
    wanted = classes.where(F.col("class") == "numeric").select(F.col("dataset").alias("_d"), F.col("variable").alias("_v"))
    numbers = cells.join(wanted, (F.col("dataset") == F.col("_d")) & (F.col("variable") == F.col("_v")), "left_semi")
    numbers = stored(numbers.select("dataset", "variable", to_number(F.col("value")).alias("value")))
    outliers = P.numeric_profile(numbers, ["dataset", "variable"]).groupBy(F.col("dataset").alias("_d")).agg(
        F.sum(F.coalesce("outliers", F.lit(0))).alias("outliers"))
    counts = classes.groupBy(F.col("dataset").alias("_d")).agg(
        *(F.count_if(F.col("class") == c).alias(c) for c in ("numeric", "temporal", "categorical")))
    same = F.col("dataset") == F.col("_d")
    totals = files.select("dataset").join(outliers, same, "left").select("dataset", F.coalesce("outliers", F.lit(0)).alias("outliers"))
    graded = P.grade_files(files, totals, ["dataset"])
    graded = graded.join(counts, same, "left").drop("_d")
    return graded.fillna(0, subset=["numeric", "temporal", "categorical"])


def matched_rules(columns: DataFrame, rules: DataFrame) -> DataFrame:
    """J-4 for many datasets: ``(dataset, tolerance, key_columns)``, the keys of each rule that its dataset has.

    ``rules`` is ``(dataset, keys, tolerance)``. A key matches the column whose normalised header equals it in lower
    case (of several the first by name); rules without any match give no row.
    """
    wanted = rules.select(F.col("dataset").alias("_d"), "tolerance", F.posexplode("keys").alias("no", "target"))
    on = (columns["dataset"] == F.col("_d")) & (normalize_header(F.col("variable")) == F.lower("target"))
    hits = wanted.join(columns, on).groupBy("dataset", "tolerance", "no").agg(F.min("variable").alias("column"))
    names = F.transform(F.array_sort(F.collect_list(F.struct("no", "column"))), lambda x: x["column"])
    return hits.groupBy("dataset", "tolerance").agg(F.array_distinct(names).alias("key_columns"))  # as long as the rule


def duplicates_by_rule(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """A6 for many datasets: each counts its duplicate members on its own keys, against its own tolerance.

    Keys are built from the map, so a rule is a row and not a plan; counts combine before they shuffle, so a hot key
    costs a counter a task. Nulls compare equal. Datasets without a rule, or without any of its keys, give no row.
    """
    found = stored(matched_rules(column_table(rows), rules).withColumnRenamed("dataset", "_d"))
    keyed = rows.join(found, F.col("dataset") == F.col("_d"))
    key = F.transform("key_columns", lambda c: F.element_at("cells", c))
    per_key = keyed.groupBy("dataset", "tolerance", "key_columns", key.alias("_key")).agg(F.count("*").alias("_n"))
    res = per_key.groupBy("dataset", "tolerance", "key_columns").agg(
        F.sum("_n").alias("rows"), F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("duplicate_members"))
    names, n = F.array_join("key_columns", ", "), F.col("duplicate_members")
    return res.select(
        "dataset", F.lit("no_duplicates").alias("check"), (n <= F.col("tolerance")).alias("passed"),
        F.when(n > 0, F.format_string("%d duplicate rows on key [%s]", n, names)).otherwise(F.lit("No duplicates")).alias("detail"),
        names.alias("matched_keys"), n, "rows")
