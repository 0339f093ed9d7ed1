"""Validation checks as rows (§2.8 names, J-1..J-4, A2, A5, A6, A17, V1-V4).

Every check is a row ``(dataset, file, check, passed, detail)``; a report is an
aggregate over those rows. Rules arrive as small DataFrames (broadcast, their
size is the number of configured rules) and never as Python loops over data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions.headers import normalize_header
from tidepool.functions.numeric import out_of_range, to_number
from tidepool.session import stored

def _fmt_bound(c: Column) -> Column:
    return c.cast("double").cast("string")


def required_columns(catalogue: DataFrame, rules: DataFrame, keys: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """J-2 + P3: one ``required_column_{c}`` row per file and rule.

    ``catalogue`` holds ``keys + (ordinal, raw_name)`` (the columns of each
    file), ``rules`` holds ``column`` (targets, compared lower-cased, not
    normalised). The first match by ordinal wins (``min_by``). ``by`` names the keys (say,
    the dataset) that ``rules`` carries too; a rule then holds for the files of its own keys.
    """
    cat = catalogue.select(*keys, "ordinal", "raw_name", normalize_header(F.col("raw_name")).alias("_norm"))
    # written, so that the planner sees how small it is: few names may hold nearly all columns, and must not meet in one task
    r = stored(rules.select(*by, F.col("column").alias("_target"), F.lower(F.col("column")).alias("_norm")))
    hits = cat.join(r, on=[*by, "_norm"]).groupBy(*keys, "_target").agg(
        F.min_by("raw_name", "ordinal").alias("matched")
    )
    files = catalogue.select(*keys).distinct()
    if by:
        pairs = files.join(r.select(*by, "_target"), on=list(by)).select(*keys, "_target")
    else:  # every file with every rule, through the one-row list of rules
        listed = rules.agg(F.collect_list("column").alias("_targets"))
        pairs = files.select(*keys, F.explode(listed.scalar()).alias("_target"))
    j = pairs.join(hits, on=[*keys, "_target"], how="left")
    found = F.col("matched").isNotNull()
    return j.select(
        *keys,
        F.concat(F.lit("required_column_"), F.col("_target")).alias("check"),
        found.alias("passed"),
        F.when(found, F.format_string("Column '%s' found (raw: %s)", F.col("_target"), F.col("matched")))
        .otherwise(F.format_string("Column '%s' MISSING", F.col("_target"))).alias("detail"),
        F.col("matched"),
    )


def value_ranges(long: DataFrame, rules: DataFrame, keys: list[str], columns: list[str] | DataFrame,
                 by: tuple[str, ...] = ()) -> DataFrame:
    """J-3 + A5 + P7: ``range_{c}`` per file and matched rule.

    ``long`` is ``keys + (variable, value)`` over the raw ``columns``; each rule
    ``(column, lo, hi)`` is resolved once against the column catalogue (first
    normalised-equal name by position, P3) and joined to the values, at most one
    row per rule. Rules whose column is absent give no row. With ``by`` (keys that
    ``rules`` carries too, say the dataset) ``columns`` is a catalogue
    ``by + (ordinal, raw_name)`` and a rule holds for its own keys.
    """
    if isinstance(columns, DataFrame):
        cat = columns.select(*by, "ordinal", F.col("raw_name").alias("variable")).distinct()
    else:
        cat = long.sparkSession.createDataFrame(list(enumerate(columns)), "ordinal int, variable string")
    cat = cat.select(*by, "ordinal", "variable", normalize_header(F.col("variable")).alias("_norm"))
    r = rules.select(
        *by, F.col("column").alias("_target"), F.lower(F.col("column")).alias("_norm"),
        F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"),
    )
    # written, so that the planner sees how small it is: a few variables hold all values, which a shuffle by variable would
    # bring to as few tasks
    resolved = stored(cat.join(r, on=[*by, "_norm"]).groupBy(*by, "_target", "lo", "hi").agg(
        F.min_by("variable", "ordinal").alias("variable")
    ))
    kind = long.schema["value"].dataType
    x = to_number(F.col("value"), kind if isinstance(kind, T.DoubleType) else None)  # doubles need not go through text
    j = long.join(resolved, on=[*by, "variable"])
    agg = j.groupBy(*keys, "_target", "lo", "hi").agg(
        F.count(x).alias("numeric_values"),
        F.count_if(out_of_range(x, F.col("lo"), F.col("hi"))).alias("out_of_range"),
    )
    bounds = F.format_string("[%s, %s]", _fmt_bound(F.col("lo")), _fmt_bound(F.col("hi")))
    none = F.col("numeric_values") == 0
    return agg.select(
        *keys,
        F.concat(F.lit("range_"), F.col("_target")).alias("check"),
        (none | (F.col("out_of_range") == 0)).alias("passed"),
        F.when(none, F.lit("No numeric data to check"))
        .when(F.col("out_of_range") > 0, F.format_string("%d values outside %s", F.col("out_of_range"), bounds))
        .otherwise(F.concat(F.lit("All values in "), bounds)).alias("detail"),
        F.col("out_of_range").cast("long").alias("out_of_range"),
    )


def unmatched_rules(catalogue: DataFrame, rules: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Q4: ``by + (column)``, the rules whose column no file of their keys has."""
    have = catalogue.select(*by, normalize_header(F.col("raw_name")).alias("_norm")).distinct()
    want = rules.select(*by, "column", F.lower("column").alias("_norm")).distinct()
    return want.join(have, on=[*by, "_norm"], how="left_anti").select(*by, "column")


def empty_rows(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """A2: rows where every listed column is missing, per file."""
    allnull = F.coalesce(*[F.col(f"`{c}`").cast("string") for c in columns]).isNull()
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(allnull).alias("empty_rows"))
    return agg.select(
        *keys,
        F.lit("no_empty_rows").alias("check"),
        (F.col("empty_rows") == 0).alias("passed"),
        F.when(F.col("empty_rows") > 0, F.format_string("%d completely empty rows found", F.col("empty_rows")))
        .otherwise(F.lit("No empty rows")).alias("detail"),
        F.col("rows").cast("long").alias("rows"),
        F.col("empty_rows").cast("long").alias("empty_rows"),
    )


def no_duplicates(members: DataFrame, keys: list[str], key_names: list[str], tolerance: int = 0) -> DataFrame:
    """A6 verdict: duplicate members within ``tolerance`` pass (the detail keeps the count)."""
    key_text = ", ".join(key_names)
    over = F.col("duplicate_members") > tolerance
    return members.select(
        *keys,
        F.lit("no_duplicates").alias("check"),
        (~over).alias("passed"),
        F.when(F.col("duplicate_members") > 0, F.format_string("%d duplicate rows on key [%s]", F.col("duplicate_members"), F.lit(key_text)))
        .otherwise(F.lit("No duplicates")).alias("detail"),
        F.lit(key_text).alias("matched_keys"),
        "duplicate_members",
    )


def count_check(df: DataFrame, keys: list[str], name: str, failing: Column, what: str) -> DataFrame:
    """V1-V3 style check: passes when no row meets ``failing``."""
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.count_if(failing).alias("failures"))
    return agg.select(
        *keys,
        F.lit(name).alias("check"),
        (F.col("failures") == 0).alias("passed"),
        F.format_string("%d %s", F.col("failures"), F.lit(what)).alias("detail"),
        F.col("rows").cast("long").alias("rows"),
        F.col("failures").cast("long").alias("failures"),
    )


def report(checks: DataFrame, keys: list[str], file_col: str = "file") -> DataFrame:
    """Per dataset, AND of every check, counts and the summary line."""
    agg = checks.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_distinct(F.col(file_col)).alias("files"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
    )
    return agg.select(
        *keys, "files", "checks", "passed_checks", "all_passed",
        F.format_string("%d/%d checks passed across %d files", F.col("passed_checks"), F.col("checks"), F.col("files"))
        .alias("summary"),
    )


FILES_A_ROW = 1000  # files in one row of a nested report


def file_verdicts(checks: DataFrame, keys: list[str], file_col: str = "file") -> DataFrame:
    """A17 per file: ``keys, file, passed, checks``, the checks in report order as an array (as long as the rules are many)."""
    one = F.struct(_seq(F.col("check")).alias("seq"), "check", "passed", "detail")
    listed = F.transform(F.array_sort(F.collect_list(one)), lambda x: F.struct(x["check"].alias("check"), x["passed"].alias("passed"), x["detail"].alias("detail")))
    return checks.groupBy(*keys, file_col).agg(F.bool_and("passed").alias("passed"), listed.alias("checks"))


def nested_report(checks: DataFrame, keys: list[str], file_col: str = "file", files_a_row: int = FILES_A_ROW) -> DataFrame:
    """A17 + S7: ``keys, part, summary, all_passed, files``, the report of a dataset with its files and their checks nested.

    A dataset of more than ``files_a_row`` files has a row for each part of about so many, dealt by the file's name, so no row
    grows with a dataset; summary and verdict are the whole dataset's in each. Files stand in order of name.
    """
    checks = stored(checks)  # read by files and by datasets
    files = file_verdicts(checks, keys, file_col)
    totals = stored(report(checks, keys, file_col).select(*(F.col(k).alias(f"_r_{k}") for k in keys), F.col("files").alias("_files"), "summary", "all_passed"))
    both = files.join(totals, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    part = F.pmod(F.xxhash64(file_col), F.ceil(F.col("_files") / files_a_row)).cast("int")
    nested = F.array_sort(F.collect_list(F.struct(F.col(file_col).alias("file"), F.col("passed"), F.col("checks"))))
    return both.groupBy(*keys, part.alias("part"), "summary", "all_passed").agg(nested.alias("files"))


def flat_report(nested: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, file, file_passed, place, check, passed, detail`` of a nested report."""
    files = nested.select(*keys, F.explode("files").alias("f"))
    rows = files.select(*keys, F.col("f.file").alias("file"), F.col("f.passed").alias("file_passed"), F.posexplode("f.checks").alias("place", "c"))
    return rows.select(*keys, "file", "file_passed", "place", "c.check", "c.passed", "c.detail")


# --- Fixed values: check order in a file's report ----------------------------
CHECK_ORDER = ("file_exists", "encoding", "utf8_readable", "parseable", "no_empty_rows", "required_column_",
               "range_", "no_duplicates")


def _seq(check: Column) -> Column:
    expr = None
    for i, name in enumerate(CHECK_ORDER):
        cond = check.startswith(name) if name.endswith("_") else (check == name)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(len(CHECK_ORDER)))


def validate_files(presence: DataFrame, encoding: DataFrame, parse: DataFrame, later: list[DataFrame],
                   key: str = "file") -> DataFrame:
    """Entry point C (§3.3) as one table of check rows, with the reference's short-circuits.

    * ``presence``: ``key, file_exists`` for every expected file (J-1);
    * ``encoding``: ``key, passed, detail`` (E1) -- only for files that exist;
    * ``parse``: ``key, parseable, rows, columns`` (S2). A file whose bytes are
      not UTF-8 gets ``utf8_readable`` = false and no further check; a file that does not
      parse gets ``parseable`` = false and no further check;
    * ``later``: check tables ``key, check, passed, detail`` (A2, J-2, J-3, A6),
      kept only for readable files (left semi joins, no Python branching).
    Returns ``key, seq, check, passed, detail`` (``seq`` orders a file's report).
    """
    exists = presence.select(key, F.lit("file_exists").alias("check"), F.col("file_exists").alias("passed"),
                             F.when(F.col("file_exists"), F.lit("Found")).otherwise(F.lit("File not found")).alias("detail"))
    present = presence.where(F.col("file_exists")).select(key)
    enc = encoding.join(present, key, "left_semi").select(key, F.lit("encoding").alias("check"), "passed", "detail")
    broken = encoding.join(present, key, "left_semi").where(~F.col("passed")).select(key)
    unreadable = broken.select(key, F.lit("utf8_readable").alias("check"), F.lit(False).alias("passed"),
                               F.lit("Could not parse file").alias("detail"))
    p = parse.join(present, key, "left_semi").join(broken, key, "left_anti")
    ok = F.col("parseable")
    parsed = p.select(key, F.lit("parseable").alias("check"), ok.alias("passed"),
                      F.when(ok, F.format_string("%d rows, %d columns", F.col("rows"), F.col("columns")))
                      .otherwise(F.lit("Could not parse file")).alias("detail"))
    readable = p.where(ok).select(key)
    out = exists.unionByName(enc).unionByName(parsed).unionByName(unreadable)
    for t in later:
        out = out.unionByName(t.select(key, "check", "passed", "detail").join(readable, key, "left_semi"))
    return out.select(key, _seq(F.col("check")).alias("seq"), "check", "passed", "detail")
