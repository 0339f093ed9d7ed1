"""Variable and file profiles.

Variables are profiled in *long* form ``(keys..., variable, value)`` produced
by ``unpivot`` (an in-stage Expand, no shuffle), so one grouped aggregate
covers every column of every dataset; group keys are ``(dataset, variable)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool import fixed
from tidepool.functions.numeric import pct, round4, to_number
from tidepool.functions.temporal import as_timestamp, has_time_keyword
from tidepool.functions.text import is_nonblank
from tidepool.operators.quantiles import exact_quantiles
from tidepool.session import stored

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


# ---------------------------------------------------------------- reshaping --
def to_long(df: DataFrame, columns: list[str], ids: list[str], kind: str = "number") -> DataFrame:
    """Unpivot ``columns`` into ``ids + (variable, value)``.

    ``kind`` decides the value type: ``number`` (N1 coercion), ``text`` (raw
    text) or ``time`` (timestamp, parsed when text).
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    if kind == "number":
        conv = {c: to_number(F.col(c), types[c]) for c in columns}
    elif kind == "time":
        conv = {c: as_timestamp(F.col(c), types[c]) for c in columns}
    else:
        conv = {c: F.col(c).cast("string") for c in columns}
    tmp = [f"_c{i}" for i in range(len(columns))]
    wide = df.select(*ids, *[conv[c].alias(t) for c, t in zip(columns, tmp)])
    long = wide.unpivot(ids, tmp, "_slot", "value")
    names = F.create_map(*[x for c, t in zip(columns, tmp) for x in (F.lit(t), F.lit(c))])
    return long.select(*ids, F.element_at(names, F.col("_slot")).alias("variable"), "value")


# ---------------------------------------------------------------- numeric ----
def numeric_profile(long: DataFrame, keys: list[str]) -> DataFrame:
    """A8 + P9: counts, moments, quartiles, IQR fences and outliers per group.

    Three passes find the exact quartiles (:func:`exact_quantiles`); the last one counts everything
    else next to each group's fences, whose table is broadcast only if the planner sees that it is small.
    """
    long = long.select(*keys, "value")
    v = F.col("value")
    iqr = F.col("p75") - F.col("p25")
    q = exact_quantiles(long, keys, "value", QUARTILES).withColumns({
        "_lf": F.col("p25") - fixed.OUTLIER_IQR_FACTOR * iqr, "_uf": F.col("p75") + fixed.OUTLIER_IQR_FACTOR * iqr})
    q = stored(q.withColumnsRenamed({k: f"_q{k}" for k in keys}))
    rows = long.join(q, [F.col(k).eqNullSafe(F.col(f"_q{k}")) for k in keys], "left")
    stats = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count(v).alias("valid"), F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"),
        F.min(v).alias("_lo"), F.max(v).alias("_hi"), *(F.max(c).alias(c) for c in QUARTILES),
        F.count_if((v < F.col("_lf")) | (v > F.col("_uf"))).alias("outliers"),
    )
    missing = F.col("total") - F.col("valid")
    has = F.col("valid") > 0
    return stats.select(
        *keys,
        "total",
        "valid",
        missing.alias("missing"),
        F.when(has, pct(missing, F.col("total"))).otherwise(F.lit(100.0)).alias("missing_pct"),
        round4(F.col("_mean")).alias("mean"),
        round4(F.col("_std")).alias("std"),
        round4(F.col("_lo")).alias("min"),
        round4(F.col("p25")).alias("p25"),
        round4(F.col("median")).alias("median"),
        round4(F.col("p75")).alias("p75"),
        round4(F.col("_hi")).alias("max"),
        round4(iqr).alias("iqr"),
        F.when(has, F.col("outliers")).alias("outliers"),
        F.when(has, pct(F.col("outliers"), F.col("valid"))).alias("outlier_pct"),
    )


# ------------------------------------------------------------ categorical ----
def categorical_profile(long: DataFrame, keys: list[str]) -> DataFrame:
    """A9 + P8: total, non-blank, missing, missing %, distinct non-blank values.

    Two-level aggregate: ``(keys, value)`` counts first (map-side combined), then
    per group; no group's values are gathered.
    """
    v = F.col("value")
    per_value = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"))
    blank = ~is_nonblank(v)
    res = per_value.groupBy(*keys).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(blank, 0).otherwise(F.col("n"))).alias("valid"),
        F.count_if(~blank).alias("unique"),
    )
    missing = F.col("total") - F.col("valid")
    return res.select(
        *keys,
        F.col("total").cast("long").alias("total"),
        F.col("valid").cast("long").alias("valid"),
        missing.cast("long").alias("missing"),
        pct(missing, F.col("total")).alias("missing_pct"),
        F.col("unique").cast("long").alias("unique"),
    )


def top_values(long: DataFrame, keys: list[str], k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-blank values per group (ties: value ascending).

    ``row_number() <= k`` lets Spark insert a partial ``WindowGroupLimit`` before
    the shuffle, so at most ``k`` rows per group and map task move.
    """
    per_value = (
        long.where(is_nonblank(F.col("value")))
        .groupBy(*keys, "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    w = Window.partitionBy(*keys).orderBy(F.desc("n"), F.asc("value"))
    return per_value.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select(
        *keys, F.col("rank").cast("int").alias("rank"), "value", "n"
    )


# --------------------------------------------------------------- temporal ----
def temporal_profile(long: DataFrame, keys: list[str]) -> DataFrame:
    """A10: total, valid, missing, earliest, latest and span (seconds)."""
    ts = F.col("value")
    res = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count(ts).alias("valid"), F.min(ts).alias("_a"), F.max(ts).alias("_b")
    )
    missing = F.col("total") - F.col("valid")
    return res.select(
        *keys,
        "total",
        "valid",
        missing.alias("missing"),
        F.when(F.col("valid") > 0, pct(missing, F.col("total"))).otherwise(F.lit(100.0)).alias("missing_pct"),
        F.date_format("_a", "yyyy-MM-dd HH:mm:ss").alias("earliest"),
        F.date_format("_b", "yyyy-MM-dd HH:mm:ss").alias("latest"),
        ((F.unix_micros(F.col("_b")) - F.unix_micros(F.col("_a"))) / 1_000_000.0).alias("span_seconds"),
    )


# ----------------------------------------------------------- classification --
def typed_long(df: DataFrame, ids: list[str]) -> DataFrame:
    """``ids + (variable, kind, value)`` of all other columns: the kind their type says, and their text."""
    kinds = {}
    for f in df.schema.fields:
        kinds[f.name] = ("number" if isinstance(f.dataType, T.NumericType) else "boolean" if isinstance(f.dataType, T.BooleanType)
                         else "time" if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)) else "text")
    cols = [c for c in df.columns if c not in ids]
    long = to_long(df, cols, ids, "text")
    lookup = F.create_map(*(F.lit(x) for c in cols for x in (c, kinds[c])))
    return long.withColumn("kind", F.element_at(lookup, F.col("variable")))


def classify(long: DataFrame, keys: list[str], totals: DataFrame | None = None) -> DataFrame:
    """T5 + N2: ``keys + (variable, class)`` of long data with kinds, in one aggregate over all datasets.

    ``totals`` (``keys + rows``) tells how many rows there are where long data lacks cells.

    In this order: temporal (named like a time, no number type, more than half of the values parse, and
    all years are plausible), numeric (by type, or every value converts, or more than half of the rows do),
    else categorical; booleans are categorical.
    """
    v, name = F.col("value"), F.lower("variable")
    named = F.lit(False)
    for k in fixed.TIME_KEYWORDS_PROFILE:
        named = named | name.contains(k)
    t = F.when(named & F.col("kind").isin("text", "time"), as_timestamp(v))
    agg = long.groupBy(*keys, "variable", "kind").agg(
        F.count(F.lit(1)).alias("rows"), F.count(v).alias("values"),
        F.count(F.when(F.col("kind") == "text", to_number(v))).alias("numbers"),  # asked of text alone
        F.count(t).alias("times"), F.min(F.year(t)).alias("y0"), F.max(F.year(t)).alias("y1"))
    if totals is not None:
        known = totals.select(*(F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)), F.col("rows").alias("_rows"))
        agg = agg.join(known, [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)]).withColumn("rows", F.col("_rows"))
    temporal = ((F.col("times") > 0) & (F.col("times") / F.col("values") > 0.5) & (F.col("y0") >= fixed.MIN_PLAUSIBLE_YEAR)
                & (F.col("y1") <= fixed.MAX_PLAUSIBLE_YEAR))
    numeric = (F.col("kind") == "number") | ((F.col("kind") == "text") & (
        (F.col("numbers") == F.col("values")) | (F.col("numbers") / F.greatest("rows", F.lit(1)) > 0.5)))
    verdict = F.when(temporal, "temporal").when(numeric, "numeric").otherwise("categorical")
    return agg.select(*keys, "variable", verdict.alias("class"))


def profile_files(datasets: dict[str, DataFrame]) -> DataFrame:
    """§3.2 end to end: a row per dataset with its classes, completeness, duplicates, outliers and grade.

    Classes are found first, over all datasets in long form; the numeric profile then takes the columns that
    are numeric by class, whatever their type.
    """
    longs = files = None
    for name, df in datasets.items():
        df = df.withColumn("dataset", F.lit(name))
        long, file = typed_long(df, ["dataset"]), file_profile(df, ["dataset"])
        longs, files = (long, file) if longs is None else (longs.unionByName(long), files.unionByName(file))
    classes = stored(classify(longs, ["dataset"]))
    numeric = longs.join(classes.where(F.col("class") == "numeric"), ["dataset", "variable"], "left_semi")
    typed = F.col("value").try_cast("double")  # a number's own text needs no pattern
    number = F.when(F.col("kind") == "number", F.when(~F.isnan(typed), typed)).otherwise(to_number(F.col("value")))
    numeric = stored(numeric.select("dataset", "variable", number.alias("value")))  # texts are read once
    outliers = numeric_profile(numeric, ["dataset", "variable"])
    counts = classes.groupBy("dataset").agg(*(F.count_if(F.col("class") == c).alias(c) for c in ("numeric", "temporal", "categorical")))
    return grade_files(files, outliers, ["dataset"]).join(counts, "dataset")


# ------------------------------------------------------------------- files ---
def file_profile(df: DataFrame, keys: list[str], catalogue: DataFrame | None = None) -> DataFrame:
    """A1 + A3 + A7: rows, columns, cells, missing cells, completeness, duplicate rows.

    ``catalogue`` (the ``keys`` of every known file) keeps files with zero
    rows: they report 0 rows, completeness NULL (and grade D downstream).

    One scan: rows are counted by a 256-bit digest of themselves, so 32 bytes
    of a row move, whatever its texts.
    """
    data_cols = [c for c in df.columns if c not in keys]
    ncols = len(data_cols)
    miss = sum((F.col(f"`{c}`").isNull().cast("long") for c in data_cols), F.lit(0).cast("long"))
    by_digest = df.groupBy(*keys, row_digest(data_cols).alias("_d")).agg(F.count(F.lit(1)).alias("_k"), F.sum(miss).alias("_mm"))
    res = by_digest.groupBy(*keys).agg(F.sum("_k").alias("rows"), F.sum("_mm").alias("total_missing"),
                                       F.sum(F.col("_k") - 1).alias("duplicate_rows"))
    if catalogue is not None:
        res = catalogue.select(*keys).distinct().join(res, on=keys, how="left").fillna(
            0, subset=["rows", "total_missing", "duplicate_rows"])
    cells = F.col("rows") * F.lit(ncols)
    return res.select(
        *keys,
        F.col("rows").cast("long").alias("rows"),
        F.lit(ncols).cast("long").alias("columns"),
        cells.cast("long").alias("total_cells"),
        F.col("total_missing").cast("long").alias("total_missing"),
        F.when(cells > 0, F.round((F.lit(1.0) - F.col("total_missing") / cells) * 100.0, 2)).alias("completeness_pct"),
        F.coalesce(F.col("duplicate_rows"), F.lit(0)).cast("long").alias("duplicate_rows"),
    )


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of a row in an encoding that keeps nulls and column borders apart."""
    cols = [F.col(f"`{c}`") for c in columns]
    return F.unhex(F.sha2(F.to_json(F.struct(*(c.alias(f"c{i}") for i, c in enumerate(cols))), {"ignoreNullFields": "false"}), 256))


def grade_files(files: DataFrame, outliers: DataFrame, keys: list[str]) -> DataFrame:
    """A13 + A21: grade A-D from completeness, duplicate % and outlier % of cells.

    ``outliers`` holds ``keys + outliers`` per numeric variable; their sum is
    joined back per file. Zero rows gives completeness null and grade D.
    """
    tot = outliers.groupBy(*keys).agg(F.sum(F.coalesce(F.col("outliers"), F.lit(0))).alias("total_outliers"))
    j = files.join(tot, on=keys, how="left").withColumn(
        "total_outliers", F.coalesce(F.col("total_outliers"), F.lit(0)).cast("long")
    )
    comp = F.col("completeness_pct")
    dup_pct = F.col("duplicate_rows") / F.greatest(F.col("rows"), F.lit(1)) * 100.0
    out_pct = F.col("total_outliers") / F.greatest(F.col("total_cells"), F.lit(1)) * 100.0
    grade = None
    for g, cmin, dmax, omax in fixed.GRADE_RULES:
        cond = (comp >= cmin) & ((dup_pct == 0) if dmax == 0.0 else (dup_pct < dmax))
        if omax is not None:
            cond = cond & (out_pct < omax)
        grade = F.when(cond, F.lit(g)) if grade is None else grade.when(cond, F.lit(g))
    grade = grade.otherwise(F.lit("D"))
    return j.select(
        "*",
        F.round(dup_pct, 2).alias("duplicate_pct"),
        F.round(out_pct, 2).alias("outlier_pct"),
        F.coalesce(grade, F.lit("D")).alias("grade"),
    )


def quality_notes(graded: DataFrame, keys: list[str]) -> DataFrame:
    """One row per note (completeness < 95, duplicates > 0, outliers > 2 % of cells)."""
    comp = F.col("completeness_pct")
    dup_pct = F.col("duplicate_rows") / F.greatest(F.col("rows"), F.lit(1)) * 100.0
    out_pct = F.col("total_outliers") / F.greatest(F.col("total_cells"), F.lit(1)) * 100.0

    def note(kind, cond, text):
        return F.when(cond, F.struct(F.lit(kind).alias("kind"), text.alias("note")))

    notes = F.array_compact(
        F.array(
            note("completeness", comp < fixed.NOTE_COMPLETENESS_BELOW,
                 F.format_string("Completeness is %s%% - consider investigating missing values", comp.cast("string"))),
            note("duplicates", dup_pct > 0,
                 F.format_string("%d duplicate rows detected (%.1f%%)", F.col("duplicate_rows"), dup_pct)),
            note("outliers", out_pct > fixed.NOTE_OUTLIERS_ABOVE_PCT,
                 F.format_string("%d statistical outliers detected across numeric columns", F.col("total_outliers"))),
        )
    )
    return graded.select(*keys, F.explode(notes).alias("_n")).select(*keys, "_n.kind", "_n.note")


def missing_by_column(long: DataFrame, keys: list[str]) -> DataFrame:
    """A4: missing count and % per column, only columns with missing values."""
    res = long.groupBy(*keys).agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("value").isNull()).alias("missing"))
    return res.where(F.col("missing") > 0).select(*keys, "missing", pct(F.col("missing"), F.col("total")).alias("missing_pct"))


def grade_summary(graded: DataFrame, keys: list[str], file_col: str) -> DataFrame:
    """A22 + J2: ``file: grade | ...`` per dataset (files in name order) and the grade count.

    ``listagg`` gathers one short string per file of a dataset; that is the
    report line itself, sized by the file count, never by data rows.
    """
    pairs = F.concat(F.col(file_col), F.lit(": "), F.col("grade")).alias("_pair")
    g = graded.select(*keys, F.col(file_col).alias("_file"), pairs)
    return g.groupBy(*keys).agg(
        F.expr("listagg(_pair, ' | ') WITHIN GROUP (ORDER BY _file)").alias("grades"),
        F.count(F.lit(1)).alias("files"),
    )


def top_values_map(top: DataFrame, keys: list[str]) -> DataFrame:
    """The top values of each group as a ``value -> count`` map (at most k entries)."""
    return top.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct("value", "n"))).alias("top_values")
    )


def header_map(raw: list[str], normalised: list[str]) -> Column:
    """Raw -> normalised header mapping as a map literal."""
    return F.map_from_arrays(F.array(*[F.lit(x) for x in raw]), F.array(*[F.lit(x) for x in normalised]))


def spatial_coverage(lat: Column, lon: Column, df: DataFrame, keys: list[str]) -> DataFrame:
    """Bounding box of coerced lat/lon and distinct raw positions.

    Positions count ``(lat, lon)`` pairs with nulls equal to each other, as a
    row de-duplication would (``count(distinct a, b)`` would skip nulls).
    """
    pos = df.select(*keys, lat.alias("_la"), lon.alias("_lo")).groupBy(*keys, "_la", "_lo").agg(F.count(F.lit(1)).alias("_n"))
    nla, nlo = to_number(F.col("_la")), to_number(F.col("_lo"))
    res = pos.groupBy(*keys).agg(
        F.min(nla).alias("s"), F.max(nla).alias("n"), F.min(nlo).alias("w"), F.max(nlo).alias("e"),
        F.count(F.lit(1)).alias("unique_positions"),
    )
    return res.select(
        *keys,
        round4(F.col("s")).alias("south_lat"),
        round4(F.col("n")).alias("north_lat"),
        round4(F.col("w")).alias("west_lon"),
        round4(F.col("e")).alias("east_lon"),
        F.col("unique_positions").cast("long").alias("unique_positions"),
    )


def numeric_share(long: DataFrame, keys: list[str]) -> DataFrame:
    """N2 as a report: rows, non-null, numeric-convertible and the majority verdict per group.

    Numeric when every non-null value converts, or when convertible values are
    more than half of all rows (an all-missing column counts as numeric).
    """
    v = F.col("value")
    res = long.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count(v).alias("non_null"), F.count(to_number(v)).alias("numeric")
    )
    verdict = (F.col("non_null") == F.col("numeric")) | (F.col("numeric") / F.greatest(F.col("rows"), F.lit(1)) > 0.5)
    return res.select(*keys, "rows", "non_null", "numeric", verdict.alias("is_numeric"))


def time_column_test(df: DataFrame, dataset: str, columns: list[str] | None = None) -> DataFrame:
    """T5 as a report, one row per column: name keyword, parse share, year bounds, verdict.

    Typed numeric columns are never temporal; the share is over all non-null
    values of the column (order-free), not the first ten. One scan: the
    parsed values are unpivoted next to the raw text.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = columns or df.columns
    structs = []
    for c in cols:
        dt = types[c]
        numeric = isinstance(dt, T.NumericType)
        t = as_timestamp(F.col(f"`{c}`"), dt) if not numeric else F.lit(None).cast("timestamp")
        structs.append(F.struct(F.lit(c).alias("column"), F.lit(has_time_keyword(c)).alias("name_match"),
                                F.lit(numeric).alias("numeric_type"), F.col(f"`{c}`").cast("string").alias("_s"),
                                t.alias("_t")))
    long = df.select(F.explode(F.array(*structs)).alias("_x")).select("_x.*")
    agg = long.groupBy("column", "name_match", "numeric_type").agg(
        F.count("_s").alias("non_null"), F.count("_t").alias("parsed"),
        F.min(F.year("_t")).alias("min_year"), F.max(F.year("_t")).alias("max_year"),
    )
    share = F.when(F.col("non_null") > 0, F.col("parsed") / F.col("non_null"))
    verdict = (
        F.col("name_match") & ~F.col("numeric_type") & (F.col("parsed") > 0)
        & (F.col("min_year") >= fixed.MIN_PLAUSIBLE_YEAR) & (F.col("max_year") <= fixed.MAX_PLAUSIBLE_YEAR)
        & (share > 0.5)
    )
    return agg.select(
        F.lit(dataset).alias("dataset"), "column", "name_match", "non_null", "parsed",
        F.round(share, 4).alias("parsed_share"), "min_year", "max_year", "numeric_type",
        F.coalesce(verdict, F.lit(False)).alias("is_temporal"),
    )
