"""Cleaning queries: headers, slugs, text, timestamps, numbers, routing, fills."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.functions.headers import file_slug, normalize_header
from tidepool.functions.numeric import fill_number, to_number
from tidepool.functions.routing import route_format
from tidepool.functions.temporal import iso_utc, parse_timestamp
from tidepool.functions.text import clean_text, fill_text
from tidepool.operators import dates as DT
from tidepool.operators import profile as P
from tidepool.plans import query
from tidepool.session import checkpoint_dir, read_table, stored

# DuckDB twins of the library expressions, used by the oracles only.
SQL_WS = r"[\t\n\x0B\f\r\x{85}\pZ]"
SQL_NUMBER = r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))$"


def sql_normalize(x: str) -> str:
    return (
        f"trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')),"
        f" '({SQL_WS}|[-.])+', '_', 'g'), '[^a-z0-9_]', '', 'g'), '_+', '_', 'g'), '_')"
    )


def sql_to_number(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), '{SQL_NUMBER}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^{SQL_WS}+|{SQL_WS}+$', '', 'g')"


# ------------------------------------------------------------------ headers --
@query("header_normalize", f"""
SELECT p_partkey, raw_header, {sql_normalize('raw_header')} AS norm_header
FROM (SELECT p_partkey, '  ' || p_name || ' - ' || p_type || ' (µm).' AS raw_header FROM part)
""")
def header_normalize(spark, sf_dir):
    """F1 over a header built from every part name and type."""
    part = read_table(spark, sf_dir, "part")
    raw = F.concat(F.lit("  "), F.col("p_name"), F.lit(" - "), F.col("p_type"), F.lit(" (µm)."))
    return part.select("p_partkey", raw.alias("raw_header")).select(
        "p_partkey", "raw_header", normalize_header(F.col("raw_header")).alias("norm_header")
    )


@query("file_slug", """
SELECT doc_id, raw_name,
       trim(regexp_replace(regexp_replace(lower(raw_name), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') AS slug
FROM (SELECT doc_id, 'Cruise ' || source || '-' || CAST(doc_id AS VARCHAR) || ' (RAW)' AS raw_name FROM documents)
""")
def file_slug_query(spark, sf_dir):
    """output file stem of a raw name per document."""
    d = read_table(spark, sf_dir, "documents")
    raw = F.concat(F.lit("Cruise "), F.col("source"), F.lit("-"), F.col("doc_id").cast("string"), F.lit(" (RAW)"))
    return d.select("doc_id", raw.alias("raw_name")).select("doc_id", "raw_name", file_slug(F.col("raw_name")).alias("slug"))


@query("header_diff", f"""
WITH h AS (SELECT DISTINCT raw_name FROM (
  SELECT p_name AS raw_name FROM part UNION ALL SELECT p_type FROM part UNION ALL SELECT p_brand FROM part))
SELECT raw_name, {sql_normalize('raw_name')} AS norm_name FROM h WHERE raw_name <> {sql_normalize('raw_name')}
""")
def header_diff(spark, sf_dir):
    """P1 + P2: distinct header texts whose normalised form differs."""
    part = read_table(spark, sf_dir, "part")
    names = (
        part.select(F.col("p_name").alias("raw_name"))
        .unionByName(part.select(F.col("p_type").alias("raw_name")))
        .unionByName(part.select(F.col("p_brand").alias("raw_name")))
        .distinct()
    )
    out = names.select("raw_name", normalize_header(F.col("raw_name")).alias("norm_name"))
    return out.where(F.col("raw_name") != F.col("norm_name"))


# --------------------------------------------------------------------- text --
_PADDED_SQL = """
SELECT doc_id, lang,
       CASE WHEN doc_id % 10 = 0 THEN chr(9) || 'nan ' ELSE chr(9) || ' ' || text || ' ' || chr(10) END AS padded
FROM documents
"""


@query("strip_text", f"""
WITH p AS ({_PADDED_SQL}),
c AS (SELECT lang, CASE WHEN padded IS NULL OR {sql_strip('padded')} = 'nan' THEN '' ELSE {sql_strip('padded')} END AS cleaned
      FROM p)
SELECT lang, count(*) AS docs, count(*) FILTER (WHERE cleaned = '') AS emptied,
       CAST(sum(length(cleaned)) AS BIGINT) AS total_chars
FROM c GROUP BY lang
""")
def strip_text(spark, sf_dir):
    """F2 over whole document texts padded with tabs; one in ten is the text ``nan``."""
    d = read_table(spark, sf_dir, "documents")
    padded = F.when(F.col("doc_id") % 10 == 0, F.lit("\tnan ")).otherwise(
        F.concat(F.lit("\t "), F.col("text"), F.lit(" \n"))
    )
    c = d.select("lang", clean_text(padded).alias("cleaned"))
    return c.groupBy("lang").agg(
        F.count(F.lit(1)).alias("docs"),
        F.count_if(F.col("cleaned") == "").alias("emptied"),
        F.sum(F.length("cleaned")).cast("long").alias("total_chars"),
    )


# --------------------------------------------------------------- timestamps --
_RENDERED_SQL = """
SELECT o_orderkey, o_orderkey % 4 AS layout,
       CASE WHEN o_orderkey % 7 = 0 THEN '??' ELSE '' END ||
       CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
                           WHEN 1 THEN strftime(o_orderdate, '%m/%d/%Y %H:%M')
                           WHEN 2 THEN strftime(o_orderdate, '%d-%b-%Y %H:%M')
                           ELSE strftime(o_orderdate, '%m/%d/%y %I:%M %p') END AS raw_text
FROM orders
"""
_PARSE_SQL = """coalesce(try_strptime(raw_text, '%Y-%m-%d %H:%M:%S'), try_strptime(raw_text, '%m/%d/%Y %H:%M:%S'),
  try_strptime(raw_text, '%m/%d/%Y %H:%M'), try_strptime(raw_text, '%d-%b-%Y %H:%M'),
  try_strptime(raw_text, '%m/%d/%y %I:%M %p'))"""

LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "dd-MMM-yyyy HH:mm", "MM/dd/yy hh:mm a")


def _rendered(spark, sf_dir, corrupt: bool):
    o = read_table(spark, sf_dir, "orders")
    layout = F.col("o_orderkey") % 4
    text = None
    for i, fmt in enumerate(LAYOUTS):
        r = F.date_format(F.col("o_orderdate").cast("timestamp"), fmt)
        text = F.when(layout == i, r) if text is None else text.when(layout == i, r)
    if corrupt:
        text = F.concat(F.when(F.col("o_orderkey") % 7 == 0, F.lit("??")).otherwise(F.lit("")), text)
    return o.select("o_orderkey", layout.alias("layout"), text.alias("raw_text"))


@query("timestamps_iso", f"""
SELECT o_orderkey, raw_text, strftime({_PARSE_SQL}, '%Y-%m-%dT%H:%M:%SZ') AS iso
FROM ({_RENDERED_SQL.replace("CASE WHEN o_orderkey % 7 = 0 THEN '??' ELSE '' END ||", "")})
""")
def timestamps_iso(spark, sf_dir):
    """T2/T3 + T4: order dates written in four layouts, parsed with the ordered list, rendered ISO-8601."""
    r = _rendered(spark, sf_dir, corrupt=False)
    return r.select("o_orderkey", "raw_text", iso_utc(parse_timestamp(F.col("raw_text"))).alias("iso"))


@query("timestamp_rejects", f"""
SELECT layout, count(*) AS values, count(*) FILTER (WHERE {_PARSE_SQL} IS NULL) AS rejects,
       count(*) FILTER (WHERE {_PARSE_SQL} IS NOT NULL) AS parsed
FROM ({_RENDERED_SQL}) GROUP BY layout
""")
def timestamp_rejects(spark, sf_dir):
    """Parse rejects per layout when every 7th value is corrupted (reported, never dropped)."""
    r = _rendered(spark, sf_dir, corrupt=True).withColumn("_ts", parse_timestamp(F.col("raw_text")))
    return r.groupBy("layout").agg(
        F.count(F.lit(1)).alias("values"),
        F.count_if(F.col("_ts").isNull()).alias("rejects"),
        F.count_if(F.col("_ts").isNotNull()).alias("parsed"),
    )


_VOTED_SQL = """
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS TIMESTAMP) AS t FROM orders),
x AS (SELECT 'eu' AS variable, t, day(t) > 12 AS d, false AS m, true AS s FROM o
      UNION ALL SELECT 'us', t, false, day(t) > 12, true FROM o
      UNION ALL SELECT 'iso', t, false, false, false FROM o
      UNION ALL SELECT 'digits', NULL, false, false, false FROM o
      UNION ALL SELECT 'mostly_eu', CASE WHEN k % 10 > 0 THEN t WHEN day(t) <= 12 THEN make_timestamp(year(t), day(t), month(t), 0, 0, 0) END,
                       k % 10 > 0 AND day(t) > 12, k % 10 = 0 AND day(t) > 12, true FROM o),
v AS (SELECT variable, count(*) AS rows, count(*) FILTER (WHERE s) AS slashed, count(*) FILTER (WHERE d) > count(*) FILTER (WHERE m) AS day_first,
             count(t) AS parsed, min(t) AS a, max(t) AS b, CAST(sum(epoch(t)) AS BIGINT) AS seconds FROM x GROUP BY variable)
SELECT variable, rows, slashed, day_first, parsed, strftime(a, '%Y-%m-%dT%H:%M:%SZ') AS earliest, strftime(b, '%Y-%m-%dT%H:%M:%SZ') AS latest, seconds FROM v
"""


@query("timestamps_by_vote", _VOTED_SQL)
def timestamps_by_vote(spark, sf_dir):
    """Order dates in columns of both orders; each column's values settle its own, digits that are no date cost no parse."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").cast("date").alias("t"))
    us, eu = F.date_format("t", "M/d/yyyy"), F.date_format("t", "d/M/yyyy")
    wide = o.select(eu.alias("eu"), us.alias("us"), F.date_format("t", "yyyy-MM-dd").alias("iso"), F.date_format("t", "yyyyMM").alias("digits"),
                    F.when(F.col("o_orderkey") % 10 == 0, us).otherwise(eu).alias("mostly_eu"))
    long = stored(wide.unpivot([], wide.columns, "variable", "value"))  # read by the votes and by the parse
    votes = DT.order_votes(long, ["variable"]).select("variable", "slashed")
    parsed = DT.parse_by_vote(long, ["variable"]).groupBy("variable", "day_first").agg(
        F.count("*").alias("rows"), F.count("ts").alias("parsed"), iso_utc(F.min("ts")).alias("earliest"),
        iso_utc(F.max("ts")).alias("latest"), F.sum(F.unix_timestamp("ts")).alias("seconds"))
    return parsed.join(votes, "variable")


@query("timestamp_explicit_format", """
SELECT o_orderkey, strftime(try_strptime(raw_text, '%m/%d/%Y %H:%M'), '%Y-%m-%dT%H:%M:%SZ') AS iso
FROM (SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y %H:%M') AS raw_text FROM orders)
""")
def timestamp_explicit_format(spark, sf_dir):
    """A configured strptime format (``%m/%d/%Y %H:%M``) translated to a Java pattern."""
    o = read_table(spark, sf_dir, "orders")
    raw = F.date_format(F.col("o_orderdate").cast("timestamp"), "MM/dd/yyyy HH:mm")
    return o.select("o_orderkey", iso_utc(parse_timestamp(raw, "%m/%d/%Y %H:%M")).alias("iso"))


# ------------------------------------------------------------------ numbers --
_K_SQL = """
SELECT event_id, event_type,
       CASE event_id % 10 WHEN 1 THEN json_extract_string(props, '$.k') || ',5'
                          WHEN 2 THEN 'nan'
                          WHEN 3 THEN json_extract_string(props, '$.k') || '.0d'
                          WHEN 4 THEN ' ' || json_extract_string(props, '$.k') || ' '
                          WHEN 5 THEN '1e' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) % 3 AS VARCHAR)
                          WHEN 6 THEN '+' || json_extract_string(props, '$.k')
                          ELSE json_extract_string(props, '$.k') END AS k_text
FROM events
"""


def _k_text(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    m = F.col("event_id") % 10
    text = (
        F.when(m == 1, F.concat(k, F.lit(",5")))
        .when(m == 2, F.lit("nan"))
        .when(m == 3, F.concat(k, F.lit(".0d")))
        .when(m == 4, F.concat(F.lit(" "), k, F.lit(" ")))
        .when(m == 5, F.concat(F.lit("1e"), (k.cast("long") % 3).cast("string")))
        .when(m == 6, F.concat(F.lit("+"), k))
        .otherwise(k)
    )
    return ev.select("event_id", "event_type", "value", text.alias("k_text"))


@query("coerce_numeric", f"""
SELECT event_type, count(*) AS values, count({sql_to_number('k_text')}) AS numeric,
       sum({sql_to_number('k_text')}) AS total
FROM ({_K_SQL}) GROUP BY event_type
""")
def coerce_numeric(spark, sf_dir):
    """JSON ``k`` as text with commas, ``nan``, ``.0d`` suffixes, padding, exponents, signs."""
    t = _k_text(spark, sf_dir).withColumn("_x", to_number(F.col("k_text")))
    return t.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("values"), F.count("_x").alias("numeric"), F.sum("_x").alias("total")
    )


@query("majority_numeric", f"""
WITH k AS ({_K_SQL}),
t AS (SELECT k.event_id, k.event_type, CAST(e.value AS VARCHAR) AS value_text, k.k_text,
             CASE WHEN k.event_id % 10 < 6 THEN k.k_text ELSE k.event_type END AS mostly_text
      FROM k JOIN events e ON k.event_id = e.event_id),
long AS (SELECT 'event_type' AS variable, event_type AS value FROM t
         UNION ALL SELECT 'k_text', k_text FROM t
         UNION ALL SELECT 'mostly_text', mostly_text FROM t)
SELECT variable, count(*) AS rows, count(value) AS non_null, count({sql_to_number('value')}) AS numeric,
       (count(value) = count({sql_to_number('value')})) OR (count({sql_to_number('value')}) / greatest(count(*), 1) > 0.5)
         AS is_numeric
FROM long GROUP BY variable
""")
def majority_numeric(spark, sf_dir):
    """Which text columns are mostly numbers."""
    t = _k_text(spark, sf_dir).withColumn(
        "mostly_text", F.when(F.col("event_id") % 10 < 6, F.col("k_text")).otherwise(F.col("event_type"))
    )
    long = P.to_long(t, ["event_type", "k_text", "mostly_text"], [], kind="text")
    return P.numeric_share(long, ["variable"])


# ----------------------------------------------------------- time columns ----
_TIME_TEST_SQL = """
SELECT event_id, CAST(ts AS VARCHAR) AS ts_text, CAST(ts AS VARCHAR) AS event_time_text, event_type AS update_type,
       CASE WHEN event_id % 3 = 0 THEN 'n/a' ELSE CAST(ts AS VARCHAR) END AS date_mixed,
       CASE WHEN event_id % 2 = 0 THEN '1850-01-01 00:00:00' ELSE CAST(ts AS VARCHAR) END AS time_old
FROM events
"""


@query("time_column_test", f"""
WITH t AS ({_TIME_TEST_SQL}),
long AS (SELECT 'ts_text' AS "column", ts_text AS s FROM t UNION ALL SELECT 'event_time_text', event_time_text FROM t
         UNION ALL SELECT 'update_type', update_type FROM t UNION ALL SELECT 'date_mixed', date_mixed FROM t
         UNION ALL SELECT 'time_old', time_old FROM t),
p AS (SELECT "column", s, TRY_CAST(s AS TIMESTAMP) AS ts FROM long),
a AS (SELECT "column", count(s) AS non_null, count(ts) AS parsed, CAST(min(year(ts)) AS INTEGER) AS min_year,
             CAST(max(year(ts)) AS INTEGER) AS max_year
      FROM p GROUP BY "column")
SELECT 'events' AS dataset, "column",
       ("column" LIKE '%date%' OR "column" LIKE '%time%') AS name_match, non_null, parsed,
       round(CAST(parsed AS DOUBLE) / non_null, 4) AS parsed_share, min_year, max_year,
       coalesce(("column" LIKE '%date%' OR "column" LIKE '%time%') AND parsed > 0 AND min_year >= 1900
                AND max_year <= 2100 AND CAST(parsed AS DOUBLE) / non_null > 0.5, false) AS is_temporal
FROM a
""")
def time_column_test(spark, sf_dir):
    """T5 over text columns derived from the events times (keyword, share and year bounds)."""
    ev = read_table(spark, sf_dir, "events")
    txt = F.col("ts").cast("string")
    t = ev.select(
        txt.alias("ts_text"), txt.alias("event_time_text"), F.col("event_type").alias("update_type"),
        F.when(F.col("event_id") % 3 == 0, F.lit("n/a")).otherwise(txt).alias("date_mixed"),
        F.when(F.col("event_id") % 2 == 0, F.lit("1850-01-01 00:00:00")).otherwise(txt).alias("time_old"),
    )
    return P.time_column_test(t, "events").drop("numeric_type")


# ------------------------------------------------------------------ routing --
_FILES_SQL = """
SELECT doc_id, source || '_' || CAST(doc_id AS VARCHAR) ||
         CASE doc_id % 4 WHEN 0 THEN '.csv' WHEN 1 THEN '.XLSX' WHEN 2 THEN '.xls' ELSE '.dat' END AS file_name,
       CASE doc_id % 5 WHEN 0 THEN 'spreadsheet/xlsx' WHEN 1 THEN 'text/csv' ELSE NULL END AS declared
FROM documents
"""


@query("format_router", f"""
WITH f AS ({_FILES_SQL}),
s AS (SELECT *, lower(regexp_extract(file_name, '(\\.[^./]*)$', 1)) AS suffix FROM f)
SELECT doc_id, file_name, declared,
  CASE WHEN coalesce(declared, '') LIKE '%csv%' OR suffix = '.csv' THEN 'csv'
       WHEN coalesce(declared, '') LIKE '%spreadsheet%' OR suffix IN ('.xlsx', '.xls') THEN 'spreadsheet'
       ELSE 'unknown' END AS validate_route,
  CASE WHEN coalesce(declared, '') LIKE '%spreadsheet%' OR suffix IN ('.xlsx', '.xls') THEN 'spreadsheet'
       WHEN coalesce(declared, '') LIKE '%csv%' OR suffix = '.csv' THEN 'csv'
       ELSE 'unknown' END AS transform_route
FROM s
""")
def format_router(spark, sf_dir):
    """S3: route each named file to the csv / spreadsheet / unknown reader, both step orders."""
    d = read_table(spark, sf_dir, "documents")
    ext = (
        F.when(F.col("doc_id") % 4 == 0, ".csv").when(F.col("doc_id") % 4 == 1, ".XLSX")
        .when(F.col("doc_id") % 4 == 2, ".xls").otherwise(".dat")
    )
    name = F.concat(F.col("source"), F.lit("_"), F.col("doc_id").cast("string"), ext)
    declared = F.when(F.col("doc_id") % 5 == 0, "spreadsheet/xlsx").when(F.col("doc_id") % 5 == 1, "text/csv")
    f = d.select("doc_id", name.alias("file_name"), declared.alias("declared"))
    return f.select(
        "doc_id", "file_name", "declared",
        route_format(F.col("declared"), F.col("file_name")).alias("validate_route"),
        route_format(F.col("declared"), F.col("file_name"), spreadsheet_first=True).alias("transform_route"),
    )


# -------------------------------------------------------------------- fills --
@query("fill_encode", """
SELECT d.source, count(*) AS rows,
       sum(coalesce(CAST(l.quality AS DOUBLE), -999.0)) AS quality_filled,
       sum(coalesce(CAST(l.toxic AS DOUBLE), -999.0)) AS toxic_filled,
       count(*) FILTER (WHERE coalesce(CAST(l.quality AS VARCHAR), 'NA') = 'NA') AS na_text_cells
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source
""")
def fill_encode(spark, sf_dir):
    """P14 + P15: missing labels encoded as -999.0 (numbers) and ``NA`` (text) at the sink."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, on="doc_id", how="left")
    return j.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(fill_number(F.col("quality"))).alias("quality_filled"),
        F.sum(fill_number(F.col("toxic"))).alias("toxic_filled"),
        F.count_if(fill_text(F.col("quality"), "NA") == "NA").alias("na_text_cells"),
    )


@query("shape_compare", """
WITH raw AS (SELECT lang, count(*) AS raw_rows FROM documents GROUP BY lang),
clean AS (SELECT d.lang, count(*) AS clean_rows FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang)
SELECT raw.lang, raw_rows, CAST(5 AS BIGINT) AS raw_columns, clean_rows, CAST(7 AS BIGINT) AS clean_columns,
       raw_rows = clean_rows AS same_rows
FROM raw JOIN clean ON raw.lang = clean.lang
""")
def shape_compare(spark, sf_dir):
    """J-9: raw versus processed shape per group, as a join of two count aggregates."""
    d = read_table(spark, sf_dir, "documents")
    processed = d.join(read_table(spark, sf_dir, "labels"), on="doc_id", how="left")
    raw = d.groupBy("lang").agg(F.count(F.lit(1)).alias("raw_rows")).withColumn("raw_columns", F.lit(len(d.columns)).cast("long"))
    clean = processed.groupBy("lang").agg(F.count(F.lit(1)).alias("clean_rows")).withColumn(
        "clean_columns", F.lit(len(processed.columns)).cast("long")
    )
    j = raw.join(clean, on="lang")
    return j.select("lang", "raw_rows", "raw_columns", "clean_rows", "clean_columns",
                    (F.col("raw_rows") == F.col("clean_rows")).alias("same_rows"))




# ---------------------------------------------------------------- transform --
@query("transform_table", f"""
WITH r AS ({_RENDERED_SQL.replace("CASE WHEN o_orderkey % 7 = 0 THEN '??' ELSE '' END ||", "")}),
t AS (SELECT r.o_orderkey, r.raw_text, o.o_orderpriority, o.o_totalprice FROM r JOIN orders o USING (o_orderkey))
SELECT o_orderkey AS order_key,
       strftime({_PARSE_SQL}, '%Y-%m-%dT%H:%M:%SZ') AS datetime,
       CASE WHEN {sql_strip("'  ' || o_orderpriority || chr(9)")} = 'nan' THEN ''
            ELSE {sql_strip("'  ' || o_orderpriority || chr(9)")} END AS priority_code,
       o_totalprice AS total_price_usd,
       CAST(((o_orderkey * 37) % 180) - 90 AS DOUBLE) AS latitude_n
FROM t
""")
def transform_table(spark, sf_dir):
    """§3.1 end to end: messy headers and text, mixed-format dates, text latitude -> cleaned table."""
    from tidepool.operators.transform import transform

    r = _rendered(spark, sf_dir, corrupt=False)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    t = r.join(o, "o_orderkey").select(
        F.col("o_orderkey").alias("Order  Key"),
        F.col("raw_text").alias("Date/Time"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit("\t")).alias("Priority-Code"),
        F.col("o_totalprice").alias("Total Price (USD)"),
        ((F.col("o_orderkey") * 37) % 180 - 90).cast("string").alias("Latitude (°N)"),
    )
    cleaned, _ = transform(t)
    return cleaned


_SUMMARY_ROWS = (
    ("Order  Key", "order_key", "n", "n"), ("Date/Time", "datetime", "n", "dates"), ("Priority-Code", "priority_code", "codes", "codes"),
    ("Total Price (USD)", "total_price_usd", "n", "n"), ("Latitude (°N)", "latitude_n", "n", "lats"),
)


@query("transform_summary", f"""
WITH c AS (
  SELECT count(*) AS n, count(*) FILTER (WHERE {_PARSE_SQL} IS NOT NULL) AS dates,
         count(*) FILTER (WHERE o_orderkey % 5 <> 0) AS codes, count(*) FILTER (WHERE o_orderkey % 11 <> 0) AS lats
  FROM ({_RENDERED_SQL}))
{" UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{h}' AS header, true AS renamed, n AS rows_in, n AS rows_out, n AS rows_back, {i} AS filled_in, {o} AS filled_out, {o} AS filled_back, {i} - {o} AS rejected, true AS ok FROM c" for c, h, i, o in _SUMMARY_ROWS)}
""")
def transform_summary(spark, sf_dir):
    """§3.1 + J-9: raw CSV files scanned, cleaned and written; rows, values and rejects seen by the write itself and in what was written."""
    from tidepool.operators.transform import raise_if_lost, transform_to_csv
    from tidepool.sources.text_tables import read_text_table, write_csv

    key = F.col("o_orderkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    t = _rendered(spark, sf_dir, corrupt=True).join(o, "o_orderkey").select(
        key.alias("Order  Key"), F.col("raw_text").alias("Date/Time"),
        F.when(key % 5 == 0, F.lit("nan")).otherwise(F.concat(F.lit("  "), F.col("o_orderpriority"))).alias("Priority-Code"),
        F.col("o_totalprice").alias("Total Price (USD)"),
        F.when(key % 11 == 0, F.lit("off the chart")).otherwise(((key * 37) % 180 - 90).cast("string")).alias("Latitude (°N)"))
    home = f"{checkpoint_dir(spark).rstrip('/')}/transform-{uuid.uuid4().hex}"
    write_csv(t, f"{home}/raw")
    raw = read_text_table(spark, f"{home}/raw", t.columns).select(*[F.col(f"`{c}`") for c in t.columns])
    summary = transform_to_csv(raw, f"{home}/processed")
    raise_if_lost(summary)
    return summary
