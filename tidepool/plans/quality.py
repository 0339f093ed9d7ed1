"""File-level quality queries: completeness, duplicates, grades, notes, positions.

Derived datasets are declared once as SQL over the driver tables and used by
both Spark (:func:`sql_over`) and the DuckDB oracle, so the two
sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool import fixed
from tidepool.functions.headers import numeric_columns
from tidepool.operators import catalogue as K
from tidepool.operators import duplicates as D
from tidepool.operators import profile as P
from tidepool.plans import query, sql_over
from tidepool.session import read_table, stored

BASE_TABLES = ("customer", "orders", "lineitem", "events", "documents", "labels")

# Every driver table (or a join of two) is one dataset of the quality report.
DATASETS = {
    "customer": "SELECT * FROM customer",
    "orders": "SELECT * FROM orders",
    "lineitem": "SELECT * FROM lineitem",
    "events": "SELECT * FROM events",
    "documents_labelled": (
        "SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic "
        "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
    ),
    "document_texts": "SELECT text, lang, source FROM documents",
}
NUMERIC = {
    "customer": ["c_custkey", "c_nationkey", "c_acctbal"],
    "orders": ["o_orderkey", "o_custkey", "o_totalprice"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax"],
    "events": ["event_id", "user_id", "value"],
    "documents_labelled": ["doc_id", "n_chars", "quality", "toxic"],
    "document_texts": [],
}
COLUMNS = {
    "customer": ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"],
    "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    "documents_labelled": ["doc_id", "lang", "source", "n_chars", "quality", "toxic"],
    "document_texts": ["text", "lang", "source"],
}


def _dataset(spark, sf_dir, name):
    return sql_over(spark, sf_dir, DATASETS[name], BASE_TABLES)


def _graded(spark, sf_dir):
    files, longs = None, None
    for name in DATASETS:
        df = _dataset(spark, sf_dir, name)
        f = P.file_profile(df.withColumn("dataset", F.lit(name)), ["dataset"])
        files = f if files is None else files.unionByName(f)
        nums = numeric_columns(df)
        if nums:
            lg = P.to_long(df.withColumn("dataset", F.lit(name)), nums, ["dataset"])
            longs = lg if longs is None else longs.unionByName(lg)
    prof = P.numeric_profile(stored(longs), ["dataset", "variable"])  # four passes read it
    return P.grade_files(files, prof.select("dataset", "variable", "outliers"), ["dataset"])


def _sql_file_profile(name: str) -> str:
    cols = COLUMNS[name]
    n = len(cols)
    nulls = " + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in cols)
    outl = "0"
    if NUMERIC[name]:
        parts = []
        for c in NUMERIC[name]:
            parts.append(
                f"(SELECT count(*) FROM ds_{name}, (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b "
                f"FROM ds_{name}) q WHERE {c} < a - 1.5 * (b - a) OR {c} > b + 1.5 * (b - a))"
            )
        outl = " + ".join(parts)
    return f"""
  SELECT '{name}' AS dataset, count(*) AS rows, CAST({n} AS BIGINT) AS columns, count(*) * {n} AS total_cells,
         CAST(sum({nulls}) AS BIGINT) AS total_missing,
         CASE WHEN count(*) > 0 THEN round((1.0 - sum({nulls}) / (count(*) * {n})) * 100.0, 2) END AS completeness_pct,
         count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM ds_{name})) AS duplicate_rows,
         CAST({outl} AS BIGINT) AS total_outliers
  FROM ds_{name}"""


_WITH = "WITH " + ",\n".join(f"ds_{k} AS ({v})" for k, v in DATASETS.items())
_FILES_SQL = f"""{_WITH},
files AS ({' UNION ALL '.join(_sql_file_profile(k) for k in DATASETS)}),
g AS (
  SELECT *, CAST(duplicate_rows AS DOUBLE) / greatest(rows, 1) * 100.0 AS dp,
         CAST(total_outliers AS DOUBLE) / greatest(total_cells, 1) * 100.0 AS op FROM files
)"""

QUALITY_GRADE_SQL = f"""{_FILES_SQL}
SELECT dataset, rows, columns, total_cells, total_missing, completeness_pct, duplicate_rows, total_outliers,
       round(dp, 2) AS duplicate_pct, round(op, 2) AS outlier_pct,
       CASE WHEN completeness_pct >= 98 AND dp = 0 AND op < 1 THEN 'A'
            WHEN completeness_pct >= 95 AND dp < 1 AND op < 3 THEN 'B'
            WHEN completeness_pct >= 90 AND dp < 5 THEN 'C' ELSE 'D' END AS grade
FROM g
"""


@query("quality_grade", QUALITY_GRADE_SQL)
def quality_grade(spark, sf_dir):
    """Per dataset rows, cells, completeness, duplicates, outliers, grade."""
    return _graded(spark, sf_dir)


@query("quality_notes", f"""{_FILES_SQL}
SELECT dataset, 'completeness' AS kind,
       printf('Completeness is %s%% - consider investigating missing values', CAST(completeness_pct AS VARCHAR)) AS note
FROM g WHERE completeness_pct < 95
UNION ALL
SELECT dataset, 'duplicates', printf('%d duplicate rows detected (%.1f%%)', duplicate_rows, dp) FROM g WHERE dp > 0
UNION ALL
SELECT dataset, 'outliers', printf('%d statistical outliers detected across numeric columns', total_outliers)
FROM g WHERE op > 2
""")
def quality_notes(spark, sf_dir):
    """One row per quality note."""
    return P.quality_notes(_graded(spark, sf_dir), ["dataset"])


@query("completeness", """
WITH d AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT source, count(*) AS rows, CAST(5 AS BIGINT) AS columns, count(*) * 5 AS total_cells,
       CAST(sum(CAST(doc_id IS NULL AS INT) + CAST(lang IS NULL AS INT) + CAST(n_chars IS NULL AS INT)
                + CAST(quality IS NULL AS INT) + CAST(toxic IS NULL AS INT)) AS BIGINT) AS total_missing,
       round((1.0 - sum(CAST(doc_id IS NULL AS INT) + CAST(lang IS NULL AS INT) + CAST(n_chars IS NULL AS INT)
                + CAST(quality IS NULL AS INT) + CAST(toxic IS NULL AS INT)) / (count(*) * 5)) * 100.0, 2)
         AS completeness_pct,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM d d2 WHERE d2.source = d.source)) AS duplicate_rows
FROM d GROUP BY source
""")
def completeness(spark, sf_dir):
    """A1 + A3 (+A7): every source of labelled documents as one file."""
    return P.file_profile(_dataset(spark, sf_dir, "documents_labelled"), ["source"])


@query("missing_by_column", """
WITH d AS (SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
long AS (
  SELECT 'doc_id' AS variable, CAST(doc_id AS VARCHAR) AS value FROM d
  UNION ALL SELECT 'lang', lang FROM d
  UNION ALL SELECT 'source', source FROM d
  UNION ALL SELECT 'n_chars', CAST(n_chars AS VARCHAR) FROM d
  UNION ALL SELECT 'quality', CAST(quality AS VARCHAR) FROM d
  UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR) FROM d
)
SELECT 'documents_labelled' AS dataset, variable, count(*) FILTER (WHERE value IS NULL) AS missing,
       round(CAST(count(*) FILTER (WHERE value IS NULL) AS DOUBLE) / count(*) * 100, 2) AS missing_pct
FROM long GROUP BY variable HAVING count(*) FILTER (WHERE value IS NULL) > 0
""")
def missing_by_column(spark, sf_dir):
    """A4: missing count and % per column of the labelled documents."""
    df = _dataset(spark, sf_dir, "documents_labelled").withColumn("dataset", F.lit("documents_labelled"))
    long = P.to_long(df, COLUMNS["documents_labelled"], ["dataset"], kind="text")
    return P.missing_by_column(long, ["dataset", "variable"])


@query("duplicate_extras", """
SELECT lang, count(*) AS rows, count(*) - count(DISTINCT text) AS duplicate_rows FROM documents GROUP BY lang
""")
def duplicate_extras(spark, sf_dir):
    """Repeated document texts per language (exact, all but the first of each)."""
    return D.duplicate_extras(read_table(spark, sf_dir, "documents"), ["lang"], ["text"])


_POSITIONS_SQL = """
  SELECT c_mktsegment,
         CASE WHEN c_custkey % 11 = 0 THEN NULL
              WHEN c_custkey % 13 = 0 THEN CAST((c_custkey * 37) % 180 - 90 AS STRING) || ',5'
              ELSE CAST((c_custkey * 37) % 180 - 90 AS STRING) || '.' || CAST((c_custkey * 7) % 10 AS STRING) END AS lat,
         CASE WHEN c_custkey % 17 = 0 THEN NULL
              ELSE CAST((c_custkey * 53) % 360 - 180 AS STRING) || '.' || CAST((c_custkey * 3) % 10 AS STRING) END AS lon
  FROM customer
"""


@query("bounding_box", f"""
WITH p AS ({_POSITIONS_SQL}),
n AS (SELECT c_mktsegment, lat, lon,
             CASE WHEN regexp_matches(trim(lat), '^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)$')
                  THEN TRY_CAST(trim(lat) AS DOUBLE) END AS la,
             CASE WHEN regexp_matches(trim(lon), '^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)$')
                  THEN TRY_CAST(trim(lon) AS DOUBLE) END AS lo
      FROM p)
SELECT c_mktsegment, round(min(la), 4) AS south_lat, round(max(la), 4) AS north_lat, round(min(lo), 4) AS west_lon,
       round(max(lo), 4) AS east_lon,
       (SELECT count(*) FROM (SELECT DISTINCT lat, lon FROM p WHERE p.c_mktsegment = n.c_mktsegment)) AS unique_positions
FROM n GROUP BY c_mktsegment
""")
def bounding_box(spark, sf_dir):
    """Bounding box of coerced text positions and distinct raw positions (nulls equal)."""
    p = sql_over(spark, sf_dir, _POSITIONS_SQL, BASE_TABLES)
    return P.spatial_coverage(F.col("lat"), F.col("lon"), p, ["c_mktsegment"])


_GS_NUM = ["doc_id", "n_chars", "quality", "toxic"]
_GS_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
_GRADE_SUMMARY_SQL = f"""
WITH d AS ({DATASETS["documents_labelled"]}),
q AS (SELECT lang AS g_lang, source AS g_source,
             {", ".join(f"quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}" for c in _GS_NUM)}
      FROM d GROUP BY lang, source),
o AS (SELECT q.g_lang, q.g_source, CAST(sum({" + ".join(
    f"CASE WHEN d.{c} < a_{c} - 1.5 * (b_{c} - a_{c}) OR d.{c} > b_{c} + 1.5 * (b_{c} - a_{c}) THEN 1 ELSE 0 END"
    for c in _GS_NUM)}) AS BIGINT) AS outl
      FROM d JOIN q ON d.lang = q.g_lang AND d.source = q.g_source GROUP BY q.g_lang, q.g_source),
f AS (SELECT lang AS g_lang, source AS g_source, count(*) AS rows,
             sum({" + ".join(f"CAST({c} IS NULL AS BIGINT)" for c in _GS_COLS)}) AS miss,
             count(*) - count(DISTINCT ({", ".join(_GS_COLS)})) AS dup
      FROM d GROUP BY lang, source),
g AS (SELECT f.g_lang, f.g_source, round((1.0 - f.miss / (f.rows * 6)) * 100.0, 2) AS comp,
             CAST(f.dup AS DOUBLE) / greatest(f.rows, 1) * 100.0 AS dp,
             CAST(o.outl AS DOUBLE) / greatest(f.rows * 6, 1) * 100.0 AS op
      FROM f JOIN o ON f.g_lang = o.g_lang AND f.g_source = o.g_source),
r AS (SELECT g_lang, g_source, CASE WHEN comp >= 98 AND dp = 0 AND op < 1 THEN 'A'
                                  WHEN comp >= 95 AND dp < 1 AND op < 3 THEN 'B'
                                  WHEN comp >= 90 AND dp < 5 THEN 'C' ELSE 'D' END AS grade FROM g)
SELECT g_lang, string_agg(g_source || ': ' || grade, ' | ' ORDER BY g_source) AS grades, count(*) AS files
FROM r GROUP BY g_lang
"""


@query("grade_summary", _GRADE_SUMMARY_SQL)
def grade_summary(spark, sf_dir):
    """Per language, ``source: grade`` of every source file of labelled documents, in name order."""
    d = _dataset(spark, sf_dir, "documents_labelled")
    d = d.withColumn("g_lang", F.col("lang")).withColumn("g_source", F.col("source"))
    keys = ["g_lang", "g_source"]
    files = P.file_profile(d, keys)
    prof = P.numeric_profile(P.to_long(d, _GS_NUM, keys), [*keys, "variable"])
    graded = P.grade_files(files, prof.select(*keys, "variable", "outliers"), keys)
    return P.grade_summary(graded, ["g_lang"], "g_source")


# --------------------------------------------------------- profile end to end --
_READINGS = """SELECT l_orderkey, l_returnflag,
       CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_orderkey % 97 = 0 THEN CAST(l_orderkey * 1000 AS STRING)
            ELSE CAST(l_orderkey % 89 AS STRING) END AS reading,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS sample_date FROM lineitem"""
_GRADE_CASE = " ".join(
    f"WHEN comp >= {c} AND {'dup = 0' if d == 0 else f'dup < {d}'}{'' if o is None else f' AND outl < {o}'} THEN '{g}'"
    for g, c, d, o in fixed.GRADE_RULES)


def _outliers_sql(table: str, column: str) -> str:
    return f"""SELECT count(*) FILTER (WHERE x < a - 1.5 * (b - a) OR x > b + 1.5 * (b - a)) AS n FROM
      (SELECT TRY_CAST({column} AS DOUBLE) AS x FROM {table}) t,
      (SELECT quantile_cont(TRY_CAST({column} AS DOUBLE), 0.25) AS a, quantile_cont(TRY_CAST({column} AS DOUBLE), 0.75) AS b FROM {table}) q"""


@query("profile_submission", f"""
WITH readings AS ({_READINGS.replace('STRING', 'VARCHAR')}),
o AS (SELECT 'readings' AS dataset, (SELECT sum(n) FROM ({' UNION ALL '.join(_outliers_sql('readings', c) for c in ('l_orderkey', 'reading'))})) AS n
      UNION ALL SELECT 'events', (SELECT sum(n) FROM ({' UNION ALL '.join(_outliers_sql('events', c) for c in ('event_id', 'user_id', 'value'))}))),
f AS (SELECT 'readings' AS dataset, count(*) AS rows, 4 AS columns, count(*) - count(DISTINCT (l_orderkey, l_returnflag, reading, sample_date)) AS d,
             sum((l_orderkey IS NULL)::INT + (l_returnflag IS NULL)::INT + (reading IS NULL)::INT + (sample_date IS NULL)::INT) AS miss FROM readings
      UNION ALL SELECT 'events', count(*), 6, count(*) - count(DISTINCT (event_id, ts, user_id, event_type, value, props)),
             sum((event_id IS NULL)::INT + (ts IS NULL)::INT + (user_id IS NULL)::INT + (event_type IS NULL)::INT + (value IS NULL)::INT + (props IS NULL)::INT) FROM events),
g AS (SELECT f.*, o.n, round((1.0 - miss / (rows * columns)) * 100.0, 2) AS comp, d * 100.0 / rows AS dup, n * 100.0 / (rows * columns) AS outl
      FROM f JOIN o USING (dataset))
SELECT dataset, rows, CAST(columns AS BIGINT) AS columns, comp AS completeness_pct, d AS duplicate_rows, CAST(n AS BIGINT) AS total_outliers,
       CASE {_GRADE_CASE} ELSE 'D' END AS grade, CASE dataset WHEN 'events' THEN 3 ELSE 2 END AS numeric,
       CASE dataset WHEN 'events' THEN 0 ELSE 1 END AS temporal, CASE dataset WHEN 'events' THEN 3 ELSE 1 END AS categorical
FROM g
""")
def profile_submission(spark, sf_dir):
    """§3.2: classes decide what is profiled; ``reading`` is text, mostly numbers, and its outliers count in the grade."""
    readings = sql_over(spark, sf_dir, _READINGS, ["lineitem"])
    out = P.profile_files({"readings": readings, "events": read_table(spark, sf_dir, "events")})
    return out.select("dataset", "rows", "columns", "completeness_pct", "duplicate_rows", "total_outliers", "grade",
                      "numeric", "temporal", "categorical")


# ------------------------------------------------------ many datasets at once --
# 220 datasets of four headers. Fixed by the sampling: which reading is no number, which value is missing.
_SHIP = """SELECT l_partkey % 120 AS n, CAST(l_orderkey % 500 AS STRING) AS order_id, CAST(l_linenumber AS STRING) AS line,
       CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_orderkey % 97 = 0 THEN CAST(l_orderkey * 1000 AS STRING)
            ELSE CAST(l_orderkey % 89 AS STRING) END AS reading,
       CAST(CAST(l_shipdate AS DATE) AS STRING) AS sample_date, l_returnflag AS returned FROM lineitem"""
_EVENTS = """SELECT user_id % 100 AS n, CAST(event_id % 40 AS STRING) AS slot, event_type AS kind,
       CASE WHEN event_id % 50 > 0 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING) END AS value FROM events"""


def _catalogue_rows(spark, sf_dir):
    """Rows of ``ship_0`` to ``ship_119``, with a date column where the number is even, and ``ev_0`` to ``ev_99``."""
    ship, ev = sql_over(spark, sf_dir, _SHIP, BASE_TABLES), sql_over(spark, sf_dir, _EVENTS, BASE_TABLES)
    named = lambda p: F.concat(F.lit(p), F.col("n").cast("string"))
    even = F.col("n") % 2 == 0
    parts = [K.as_cells(ship.where(even), named("ship_"), ["order_id", "line", "reading", "sample_date"]),
             K.as_cells(ship.where(~even), named("ship_"), ["order_id", "line", "reading", "returned"]),
             K.as_cells(ev, named("ev_"), ["slot", "kind", "value"])]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_CATALOGUE_SQL = f"""
WITH s AS (SELECT *, row_number() OVER () AS rid FROM ({_SHIP.replace("STRING", "VARCHAR")})),
e AS (SELECT *, -row_number() OVER () AS rid FROM ({_EVENTS.replace("STRING", "VARCHAR")})),
c AS (SELECT 'ship_' || n AS dataset, rid, unnest(['order_id', 'line', 'reading', CASE WHEN n % 2 = 0 THEN 'sample_date' ELSE 'returned' END]) AS variable,
             unnest([order_id, line, reading, CASE WHEN n % 2 = 0 THEN sample_date ELSE returned END]) AS value FROM s
      UNION ALL SELECT 'ev_' || n, rid, unnest(['slot', 'kind', 'value']), unnest([slot, kind, value]) FROM e),
v AS (SELECT dataset, variable, count(*) AS rows, count(value) AS vals, count(TRY_CAST(value AS DOUBLE)) AS nums,
             CASE WHEN variable = 'sample_date' THEN count(TRY_CAST(value AS DATE)) ELSE 0 END AS times FROM c GROUP BY dataset, variable),
k AS (SELECT dataset, variable, CASE WHEN times * 2 > vals THEN 'temporal' WHEN nums = vals OR nums * 2 > rows THEN 'numeric' ELSE 'categorical' END AS class FROM v),
x AS (SELECT c.dataset, c.variable, TRY_CAST(value AS DOUBLE) AS x FROM c JOIN k USING (dataset, variable) WHERE class = 'numeric'),
q AS (SELECT dataset, variable, quantile_cont(x, 0.25) AS a, quantile_cont(x, 0.75) AS b FROM x GROUP BY dataset, variable),
o AS (SELECT dataset, count(*) FILTER (WHERE x < a - 1.5 * (b - a) OR x > b + 1.5 * (b - a)) AS n FROM x JOIN q USING (dataset, variable) GROUP BY dataset),
r AS (SELECT dataset, rid, string_agg(variable || '=' || value, '|' ORDER BY variable) AS t, count(value) AS present FROM c GROUP BY dataset, rid),
f AS (SELECT dataset, count(*) AS rows, CAST(sum(present) AS BIGINT) AS present, count(*) - count(DISTINCT coalesce(t, '')) AS d FROM r GROUP BY dataset),
w AS (SELECT dataset, count(*) AS columns, count(*) FILTER (WHERE class = 'numeric') AS numeric, count(*) FILTER (WHERE class = 'temporal') AS temporal,
             count(*) FILTER (WHERE class = 'categorical') AS categorical FROM k GROUP BY dataset),
g AS (SELECT *, round(present / (rows * columns) * 100.0, 2) AS comp, d * 100.0 / rows AS dup, n * 100.0 / (rows * columns) AS outl
      FROM f JOIN w USING (dataset) JOIN o USING (dataset))
SELECT dataset, rows, columns, rows * columns - present AS total_missing, comp AS completeness_pct, d AS duplicate_rows, n AS total_outliers,
       CASE {_GRADE_CASE} ELSE 'D' END AS grade, numeric, temporal, categorical FROM g
"""


@query("profile_catalogue", _CATALOGUE_SQL)
def profile_catalogue(spark, sf_dir):
    """§3.2 over 220 datasets of different headers in one plan: classes, completeness, duplicates, outliers, grade."""
    out = K.profile_catalogue(_catalogue_rows(spark, sf_dir))
    return out.select("dataset", "rows", "columns", "total_missing", "completeness_pct", "duplicate_rows", "total_outliers", "grade",
                      "numeric", "temporal", "categorical")


# --- Fixed values: key rules of the datasets (names as a submitter writes them, some absent) --
KEY_RULES = (
    ("lineitem", ("L_OrderKey", "l_linenumber"), 0),
    ("events", ("USER_ID", "event_type", "session_id"), 1_000_000_000),
    ("documents", ("source", "lang", "n_chars"), 5),
    ("customer", ("c_custkey",), 0),
    ("orders", ("ship_id",), 0),
)


@query("duplicates_by_rule", """
WITH k AS (SELECT 'lineitem' AS dataset, 0 AS tol, 'l_orderkey, l_linenumber' AS names, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber
           UNION ALL SELECT 'events', 1000000000, 'user_id, event_type', count(*) FROM events GROUP BY user_id, event_type
           UNION ALL SELECT 'documents', 5, 'source, lang, n_chars', count(*) FROM documents GROUP BY source, lang, n_chars
           UNION ALL SELECT 'customer', 0, 'c_custkey', count(*) FROM customer GROUP BY c_custkey),
d AS (SELECT dataset, tol, names, CAST(sum(n) AS BIGINT) AS rows, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS m FROM k GROUP BY dataset, tol, names)
SELECT dataset, 'no_duplicates' AS "check", m <= tol AS passed,
       CASE WHEN m > 0 THEN printf('%d duplicate rows on key [%s]', m, names) ELSE 'No duplicates' END AS detail,
       names AS matched_keys, m AS duplicate_members, rows FROM d
""")
def duplicates_by_rule(spark, sf_dir):
    """J-4 + A6: five datasets with keys and tolerances of their own, given as rows, in one job; one has none of its keys."""
    columns = {"lineitem": ["l_orderkey", "l_linenumber", "l_quantity"], "events": ["event_id", "user_id", "event_type"],
               "documents": ["doc_id", "source", "lang", "n_chars"], "customer": ["c_custkey", "c_name"], "orders": ["o_orderkey"]}
    rows = None
    for name, cols in columns.items():
        part = K.as_cells(read_table(spark, sf_dir, name), F.lit(name), cols)
        rows = part if rows is None else rows.unionByName(part)
    rules = spark.createDataFrame([(d, list(k), t) for d, k, t in KEY_RULES], "dataset string, keys array<string>, tolerance bigint")
    return K.duplicates_by_rule(rows, rules)
