"""Validation queries: rule tables against derived submissions, and the report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.functions.temporal import parse_timestamp
from tidepool.operators import checks as C
from tidepool.operators import duplicates as D
from tidepool.operators import profile as P
from tidepool.plans import query
from tidepool.plans.cleaning import _PARSE_SQL, _RENDERED_SQL, _rendered, sql_normalize
from tidepool.session import read_table

# --- Fixed values: the rule tables used by the validation queries -----------
REQUIRED = ("User", "Assistant", "System", "Tool Output")
RANGES = (("L_Quantity", 1.0, 50.0), ("l_discount", 0.0, 0.08), ("l_tax", 0.0, 0.08),
          ("Extended Price", 0.0, 1000000.0), ("l_extendedprice", 1000.0, 100000.0))
EVENT_KEYS = ("USER_ID", "event_type", "session_id")
AS_OF = "1998-01-01 00:00:00"


def _rules_required(spark):
    return spark.createDataFrame([(c,) for c in REQUIRED], "column string")


def _rules_range(spark):
    return spark.createDataFrame(list(RANGES), "column string, lo double, hi double")


def _sql_values(rows, cols):
    vals = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)" for v in r) + ")" for r in rows
    )
    return f"(VALUES {vals}) AS r({', '.join(cols)})"


# --------------------------------------------------------- required columns --
def _role_catalogue(spark, sf_dir):
    """Each conversation is a submitted file whose columns are its speaker roles."""
    conv = read_table(spark, sf_dir, "conversations")
    return conv.groupBy(F.col("conv_id").alias("file"), F.col("role").alias("raw_name")).agg(
        F.min("turn").alias("ordinal")
    )


_REQUIRED_SQL = f"""
WITH cat AS (SELECT conv_id AS file, role AS raw_name, min(turn) AS ordinal FROM conversations GROUP BY conv_id, role),
rules AS (SELECT * FROM {_sql_values([(c,) for c in REQUIRED], ['target'])}),
files AS (SELECT DISTINCT file FROM cat),
hits AS (SELECT c.file, r.target, arg_min(c.raw_name, c.ordinal) AS matched
         FROM cat c JOIN rules r ON {sql_normalize('c.raw_name')} = lower(r.target) GROUP BY c.file, r.target)
SELECT f.file, 'required_column_' || r.target AS "check", h.matched IS NOT NULL AS passed,
       CASE WHEN h.matched IS NOT NULL THEN printf('Column ''%s'' found (raw: %s)', r.target, h.matched)
            ELSE printf('Column ''%s'' MISSING', r.target) END AS detail, h.matched
FROM files f CROSS JOIN rules r LEFT JOIN hits h ON h.file = f.file AND h.target = r.target
"""


@query("required_columns", _REQUIRED_SQL)
def required_columns(spark, sf_dir):
    """J-2 + P3: required roles per conversation, matched by normalised header equality."""
    return C.required_columns(_role_catalogue(spark, sf_dir), _rules_required(spark), ["file"])


# ------------------------------------------------------------- value ranges --
_RANGE_SQL = f"""
WITH long AS (
  SELECT l_returnflag AS file, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_extendedprice', l_extendedprice FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_discount', l_discount FROM lineitem
  UNION ALL SELECT l_returnflag, 'l_tax', l_tax FROM lineitem),
rules AS (SELECT * FROM {_sql_values(RANGES, ['target', 'lo', 'hi'])}),
a AS (SELECT file, target, lo, hi, count(value) AS numeric_values,
             count(*) FILTER (WHERE value < lo OR value > hi) AS out_of_range
      FROM long JOIN rules ON {sql_normalize('variable')} = lower(target) GROUP BY file, target, lo, hi)
SELECT file, 'range_' || target AS "check", numeric_values = 0 OR out_of_range = 0 AS passed,
       CASE WHEN numeric_values = 0 THEN 'No numeric data to check'
            WHEN out_of_range > 0 THEN printf('%d values outside [%s, %s]', out_of_range, CAST(lo AS VARCHAR), CAST(hi AS VARCHAR))
            ELSE printf('All values in [%s, %s]', CAST(lo AS VARCHAR), CAST(hi AS VARCHAR)) END AS detail,
       out_of_range
FROM a
"""


@query("value_ranges", _RANGE_SQL)
def value_ranges(spark, sf_dir):
    """J-3 + A5 + P7: range rules on lineitem measures, one file per return flag."""
    li = read_table(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "file")
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return C.value_ranges(P.to_long(li, columns, ["file"]), _rules_range(spark), ["file"], columns)


# --------------------------------------------------------------- empty rows --
@query("empty_rows", """
SELECT d.source AS file, 'no_empty_rows' AS "check", count(*) FILTER (WHERE l.quality IS NULL AND l.toxic IS NULL) = 0 AS passed,
       CASE WHEN count(*) FILTER (WHERE l.quality IS NULL AND l.toxic IS NULL) > 0
            THEN printf('%d completely empty rows found', count(*) FILTER (WHERE l.quality IS NULL AND l.toxic IS NULL))
            ELSE 'No empty rows' END AS detail,
       count(*) AS rows, count(*) FILTER (WHERE l.quality IS NULL AND l.toxic IS NULL) AS empty_rows
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.source
""")
def empty_rows(spark, sf_dir):
    """A2: label rows with every label missing, one file per source."""
    d = read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id", "left")
    return C.empty_rows(d.withColumnRenamed("source", "file"), ["file"], ["quality", "toxic"])


# --------------------------------------------------------------- duplicates --
@query("duplicate_members", """
WITH k AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'lineitem' AS file, 'no_duplicates' AS "check", sum(n) FILTER (WHERE n > 1) = 0 AS passed,
       printf('%d duplicate rows on key [%s]', CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT), 'l_orderkey, l_linenumber') AS detail,
       'l_orderkey, l_linenumber' AS matched_keys, CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_members
FROM k
""")
def duplicate_members(spark, sf_dir):
    """Every member of a repeated (order, line) key."""
    li = read_table(spark, sf_dir, "lineitem").withColumn("file", F.lit("lineitem"))
    keys = ["l_orderkey", "l_linenumber"]
    return C.no_duplicates(D.duplicate_members(li, ["file"], keys), ["file"], keys)


@query("duplicate_partial_key", """
WITH k AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL)
SELECT 'events' AS file, 'no_duplicates' AS "check", coalesce(sum(n) FILTER (WHERE n > 1), 0) = 0 AS passed,
       printf('%d duplicate rows on key [%s]', CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT), 'user_id, event_type') AS detail,
       'user_id, event_type' AS matched_keys, CAST(sum(n) FILTER (WHERE n > 1) AS BIGINT) AS duplicate_members
FROM k
""")
def duplicate_partial_key(spark, sf_dir):
    """J-4 + A6: configured keys USER_ID / event_type / session_id; only the found ones are used."""
    ev = read_table(spark, sf_dir, "events").withColumn("file", F.lit("events"))
    keys = D.matched_keys(spark, [c for c in ev.columns if c != "file"], list(EVENT_KEYS))
    return C.no_duplicates(D.duplicate_members(ev, ["file"], keys), ["file"], keys)


# ----------------------------------------------------------- extension checks --
_POS_OOB_SQL = """
SELECT c_mktsegment AS file, CAST((c_custkey * 37) % 200 - 100 AS DOUBLE) AS lat,
       CAST((c_custkey * 53) % 380 - 190 AS DOUBLE) AS lon FROM customer
"""


@query("extension_checks", f"""
WITH r AS (SELECT CASE layout WHEN 0 THEN 'iso' WHEN 1 THEN 'us' WHEN 2 THEN 'dmy' ELSE 'us12' END AS file,
                  raw_text, {_PARSE_SQL} AS ts FROM ({_RENDERED_SQL})),
p AS ({_POS_OOB_SQL})
SELECT file, 'timestamps_parseable' AS "check", count(*) FILTER (WHERE trim(raw_text) <> '' AND ts IS NULL) = 0 AS passed,
       printf('%d %s', count(*) FILTER (WHERE trim(raw_text) <> '' AND ts IS NULL), 'unparseable timestamps') AS detail,
       count(*) AS rows, count(*) FILTER (WHERE trim(raw_text) <> '' AND ts IS NULL) AS failures
FROM r GROUP BY file
UNION ALL
SELECT file, 'no_future_dates', count(*) FILTER (WHERE ts > TIMESTAMP '{AS_OF}') = 0,
       printf('%d %s', count(*) FILTER (WHERE ts > TIMESTAMP '{AS_OF}'), 'dates after {AS_OF}'),
       count(*), count(*) FILTER (WHERE ts > TIMESTAMP '{AS_OF}')
FROM r GROUP BY file
UNION ALL
SELECT file, 'coordinates_in_bounds', count(*) FILTER (WHERE lat < -90 OR lat > 90 OR lon < -180 OR lon > 180) = 0,
       printf('%d %s', count(*) FILTER (WHERE lat < -90 OR lat > 90 OR lon < -180 OR lon > 180), 'positions out of bounds'),
       count(*), count(*) FILTER (WHERE lat < -90 OR lat > 90 OR lon < -180 OR lon > 180)
FROM p GROUP BY file
""")
def extension_checks(spark, sf_dir):
    """V1 + V2 + V3: unparseable times, times after an as-of date, positions outside +/-90/180."""
    r = _rendered(spark, sf_dir, corrupt=True)
    names = F.when(F.col("layout") == 0, "iso").when(F.col("layout") == 1, "us").when(F.col("layout") == 2, "dmy") \
        .otherwise("us12")
    r = r.select(names.alias("file"), "raw_text", parse_timestamp(F.col("raw_text")).alias("ts"))
    v1 = C.count_check(r, ["file"], "timestamps_parseable",
                       (F.trim(F.col("raw_text")) != "") & F.col("ts").isNull(), "unparseable timestamps")
    v2 = C.count_check(r, ["file"], "no_future_dates", F.col("ts") > F.lit(AS_OF).cast("timestamp"),
                       f"dates after {AS_OF}")
    c = read_table(spark, sf_dir, "customer")
    p = c.select(F.col("c_mktsegment").alias("file"),
                 ((F.col("c_custkey") * 37) % 200 - 100).cast("double").alias("lat"),
                 ((F.col("c_custkey") * 53) % 380 - 190).cast("double").alias("lon"))
    oob = (F.col("lat") < -90) | (F.col("lat") > 90) | (F.col("lon") < -180) | (F.col("lon") > 180)
    v3 = C.count_check(p, ["file"], "coordinates_in_bounds", oob, "positions out of bounds")
    return v1.unionByName(v2).unionByName(v3)


# ------------------------------------------------------------------- report --
@query("validation_report", f"""
WITH req AS ({_REQUIRED_SQL}), rng AS ({_RANGE_SQL}),
checks AS (
  SELECT 'conversations' AS dataset, CAST(file AS VARCHAR) AS file, passed FROM req
  UNION ALL SELECT 'lineitem', file, passed FROM rng
)
SELECT dataset, count(DISTINCT file) AS files, count(*) AS checks, count(*) FILTER (WHERE passed) AS passed_checks,
       coalesce(bool_and(passed), true) AS all_passed,
       printf('%d/%d checks passed across %d files', count(*) FILTER (WHERE passed), count(*), count(DISTINCT file)) AS summary
FROM checks GROUP BY dataset
""")
def validation_report(spark, sf_dir):
    """Roll-up of required-column and range checks per dataset."""
    req = required_columns(spark, sf_dir).select(F.lit("conversations").alias("dataset"),
                                                 F.col("file").cast("string").alias("file"), "passed")
    rng = value_ranges(spark, sf_dir).select(F.lit("lineitem").alias("dataset"), "file", "passed")
    return C.report(req.unionByName(rng), ["dataset"])




@query("nested_report", f"""
WITH req AS ({_REQUIRED_SQL}), rng AS ({_RANGE_SQL}),
checks AS (SELECT 'conversations' AS dataset, CAST(file AS VARCHAR) AS file, "check", passed, detail FROM req
           UNION ALL SELECT 'lineitem', file, "check", passed, detail FROM rng),
t AS (SELECT dataset, printf('%d/%d checks passed across %d files', count(*) FILTER (WHERE passed), count(*), count(DISTINCT file)) AS summary,
             bool_and(passed) AS all_passed FROM checks GROUP BY dataset)
SELECT dataset, file, bool_and(passed) OVER (PARTITION BY dataset, file) AS file_passed,
       CAST(row_number() OVER (PARTITION BY dataset, file ORDER BY "check") - 1 AS INT) AS place, "check", passed, detail, summary, all_passed
FROM checks JOIN t USING (dataset)
""")
def nested_report(spark, sf_dir):
    """A17 + S7: checks in files in datasets, written as JSON by dataset, read back and flattened."""
    import uuid

    from tidepool.session import checkpoint_dir
    from tidepool.sources.text_tables import write_json_report

    req = required_columns(spark, sf_dir).select(F.lit("conversations").alias("dataset"), F.col("file").cast("string").alias("file"), "check", "passed", "detail")
    rng = value_ranges(spark, sf_dir).select(F.lit("lineitem").alias("dataset"), "file", "check", "passed", "detail")
    nested = C.nested_report(req.unionByName(rng), ["dataset"])
    path = f"{checkpoint_dir(spark).rstrip('/')}/report-{uuid.uuid4().hex}"
    write_json_report(nested, path, partition_by=["dataset"])
    back = spark.read.schema(nested.schema).json(path)
    flat = C.flat_report(back, ["dataset", "summary", "all_passed"])  # each row of the report says them of its dataset
    return flat.select("dataset", "file", "file_passed", "place", "check", "passed", "detail", "summary", "all_passed")


@query("first_errors", f"""
WITH req AS ({_REQUIRED_SQL})
SELECT file, "check", detail FROM req WHERE NOT passed ORDER BY file, "check" LIMIT 5
""")
def first_errors(spark, sf_dir):
    """O2: the first five failed checks in (file, check) order (a head that is the feature)."""
    req = required_columns(spark, sf_dir)
    return req.where(~F.col("passed")).select("file", "check", "detail").orderBy("file", "check").limit(5)


# --- Fixed values: rules that hold for one dataset each --------------------------
RULES_BY_DATASET = (("lineitem", "L_Quantity", 1.0, 50.0), ("lineitem", "value", 0.0, 1.0), ("events", "Value", 0.0, 100.0),
                    ("events", "l_quantity", 0.0, 1.0), ("lineitem", "l_tax", 0.0, 0.05))


@query("rules_by_dataset", """
WITH n AS (SELECT count(*) FILTER (WHERE l_quantity < 1 OR l_quantity > 50) AS q,
                  count(*) FILTER (WHERE l_tax < 0 OR l_tax > 0.05) AS t FROM lineitem),
e AS (SELECT count(*) FILTER (WHERE value < 0 OR value > 100) AS v FROM events),
r AS (SELECT 'lineitem' AS dataset, 'range_L_Quantity' AS "check", q AS n, '[1.0, 50.0]' AS b FROM n
      UNION ALL SELECT 'lineitem', 'range_l_tax', t, '[0.0, 0.05]' FROM n
      UNION ALL SELECT 'events', 'range_Value', v, '[0.0, 100.0]' FROM e)
SELECT dataset, "check", n = 0 AS passed,
       CASE WHEN n > 0 THEN printf('%d values outside %s', n, b) ELSE 'All values in ' || b END AS detail FROM r
UNION ALL SELECT * FROM (VALUES
  ('lineitem', 'required_column_L_Quantity', true, 'Column ''L_Quantity'' found (raw: l_quantity)'),
  ('lineitem', 'required_column_value', false, 'Column ''value'' MISSING'),
  ('lineitem', 'required_column_l_tax', true, 'Column ''l_tax'' found (raw: l_tax)'),
  ('events', 'required_column_Value', true, 'Column ''Value'' found (raw: value)'),
  ('events', 'required_column_l_quantity', false, 'Column ''l_quantity'' MISSING'),
  ('lineitem', 'unmatched_rules', false, 'value'), ('events', 'unmatched_rules', false, 'l_quantity'))
""")
def rules_by_dataset(spark, sf_dir):
    """J-2 + J-3 + Q4 with rules that each hold for one dataset, by their (dataset, column)."""
    own = ("dataset",)
    rules = spark.createDataFrame(list(RULES_BY_DATASET), "dataset string, column string, lo double, hi double")
    li, ev = read_table(spark, sf_dir, "lineitem"), read_table(spark, sf_dir, "events")
    names = [("lineitem", i, c) for i, c in enumerate(li.columns)] + [("events", i, c) for i, c in enumerate(ev.columns)]
    catalogue = spark.createDataFrame(names, "dataset string, ordinal int, raw_name string")
    long = P.to_long(li.withColumn("dataset", F.lit("lineitem")), ["l_quantity", "l_tax"], ["dataset"]).unionByName(
        P.to_long(ev.withColumn("dataset", F.lit("events")), ["value"], ["dataset"]))
    cols = ("dataset", "check", "passed", "detail")
    out = C.required_columns(catalogue, rules, ["dataset"], own).select(*cols)
    out = out.unionByName(C.value_ranges(long, rules, ["dataset"], catalogue, own).select(*cols))
    none = C.unmatched_rules(catalogue, rules, own).select(
        "dataset", F.lit("unmatched_rules").alias("check"), F.lit(False).alias("passed"), F.col("column").alias("detail"))
    return out.unionByName(none)
