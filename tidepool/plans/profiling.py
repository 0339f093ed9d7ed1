"""Profiling queries: numeric, categorical, temporal, top values, file grades."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidepool.operators import profile as P
from tidepool.plans import query, sql_over
from tidepool.session import read_table

LINEITEM_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _numeric_long(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").withColumn("dataset", F.lit("lineitem"))
    ev = read_table(spark, sf_dir, "events").withColumn("dataset", F.lit("events"))
    return P.to_long(li, LINEITEM_NUMS, ["dataset"]).unionByName(P.to_long(ev, ["value"], ["dataset"]))


_NUMERIC_LONG_SQL = """
    SELECT 'lineitem' AS dataset, 'l_quantity' AS variable, l_quantity AS value FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_extendedprice', l_extendedprice FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_discount', l_discount FROM lineitem
    UNION ALL SELECT 'lineitem', 'l_tax', l_tax FROM lineitem
    UNION ALL SELECT 'events', 'value', value FROM events
"""

NUMERIC_PROFILE_SQL = f"""
WITH long AS ({_NUMERIC_LONG_SQL}),
s AS (
  SELECT dataset, variable, count(*) AS total, count(value) AS valid,
         avg(value) AS mean_, stddev_samp(value) AS std_, min(value) AS lo, max(value) AS hi,
         quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3
  FROM long GROUP BY dataset, variable
),
o AS (
  SELECT l.dataset, l.variable,
         count(*) FILTER (WHERE l.value < s.q1 - 1.5 * (s.q3 - s.q1) OR l.value > s.q3 + 1.5 * (s.q3 - s.q1)) AS outliers
  FROM long l JOIN s ON l.dataset = s.dataset AND l.variable = s.variable
  GROUP BY l.dataset, l.variable
)
SELECT s.dataset, s.variable, s.total, s.valid, s.total - s.valid AS missing,
       round(CAST(s.total - s.valid AS DOUBLE) / s.total * 100, 2) AS missing_pct,
       round(mean_, 4) AS mean, round(std_, 4) AS std, round(lo, 4) AS min,
       round(q1, 4) AS p25, round(q2, 4) AS median, round(q3, 4) AS p75, round(hi, 4) AS max,
       round(q3 - q1, 4) AS iqr, o.outliers,
       round(CAST(o.outliers AS DOUBLE) / s.valid * 100, 2) AS outlier_pct
FROM s JOIN o ON s.dataset = o.dataset AND s.variable = o.variable
"""


@query("numeric_profile", NUMERIC_PROFILE_SQL)
def numeric_profile(spark, sf_dir):
    """A8 + P9 on four lineitem measures and the events value."""
    return P.numeric_profile(_numeric_long(spark, sf_dir), ["dataset", "variable"])


_INFINITE = """SELECT l_returnflag, CASE WHEN l_orderkey % 97 = 0 THEN CAST('Infinity' AS DOUBLE)
  WHEN l_orderkey % 101 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE l_extendedprice END AS price FROM lineitem"""


@query("numeric_profile_with_inf", f"""
WITH t AS ({_INFINITE}),
q AS (SELECT l_returnflag, quantile_cont(price, 0.25) AS a, quantile_cont(price, 0.5) AS m, quantile_cont(price, 0.75) AS b FROM t GROUP BY l_returnflag)
SELECT l_returnflag, count(*) AS total, count(price) AS valid, min(price) AS min, round(a, 4) AS p25, round(m, 4) AS median, round(b, 4) AS p75,
       max(price) AS max, round(b - a, 4) AS iqr, count(*) FILTER (WHERE price < a - 1.5 * (b - a) OR price > b + 1.5 * (b - a)) AS outliers
FROM t JOIN q USING (l_returnflag) GROUP BY l_returnflag, a, m, b
""")
def numeric_profile_with_inf(spark, sf_dir):
    """A8 + P9 of prices with infinities of both signs: they count, rank and are outliers, and leave the quartiles finite."""
    t = sql_over(spark, sf_dir, _INFINITE, ["lineitem"])
    out = P.numeric_profile(P.to_long(t, ["price"], ["l_returnflag"]), ["l_returnflag"])
    return out.select("l_returnflag", "total", "valid", "min", "p25", "median", "p75", "max", "iqr", "outliers")


# ------------------------------------------------------------ by group -------
@query("numeric_profile_by_group", """
WITH s AS (
  SELECT event_type, count(*) AS total, count(value) AS valid, avg(value) AS m, stddev_samp(value) AS sd,
         min(value) AS lo, max(value) AS hi, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2,
         quantile_cont(value, 0.75) AS q3
  FROM events GROUP BY event_type
), o AS (
  SELECT e.event_type, count(*) FILTER (WHERE e.value < q1 - 1.5 * (q3 - q1) OR e.value > q3 + 1.5 * (q3 - q1)) AS outliers
  FROM events e JOIN s USING (event_type) GROUP BY e.event_type
)
SELECT event_type, 'value' AS variable, total, valid, total - valid AS missing,
       round(CAST(total - valid AS DOUBLE) / total * 100, 2) AS missing_pct, round(m, 4) AS mean, round(sd, 4) AS std,
       round(lo, 4) AS min, round(q1, 4) AS p25, round(q2, 4) AS median, round(q3, 4) AS p75, round(hi, 4) AS max,
       round(q3 - q1, 4) AS iqr, outliers, round(CAST(outliers AS DOUBLE) / valid * 100, 2) AS outlier_pct
FROM s JOIN o USING (event_type)
""")
def numeric_profile_by_group(spark, sf_dir):
    """A8 grouped: the events value per event type (hot groups stay partial-aggregated)."""
    ev = read_table(spark, sf_dir, "events")
    return P.numeric_profile(P.to_long(ev, ["value"], ["event_type"]), ["event_type", "variable"])


# ------------------------------------------------------------ categorical ----
def _categorical_long(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").withColumn("dataset", F.lit("orders"))
    c = read_table(spark, sf_dir, "customer").withColumn("dataset", F.lit("customer"))
    # A blank and a padded variant of the segment make missing and unstripped values.
    c = c.withColumn(
        "segment_raw",
        F.when(F.col("c_custkey") % 9 == 0, F.lit("  "))
        .when(F.col("c_custkey") % 5 == 0, F.concat(F.lit(" "), F.col("c_mktsegment")))
        .otherwise(F.col("c_mktsegment")),
    )
    return P.to_long(o, ["o_orderpriority", "o_orderstatus"], ["dataset"], kind="text").unionByName(
        P.to_long(c, ["c_mktsegment", "segment_raw"], ["dataset"], kind="text")
    )


_CATEGORICAL_LONG_SQL = """
    SELECT 'orders' AS dataset, 'o_orderpriority' AS variable, o_orderpriority AS value FROM orders
    UNION ALL SELECT 'orders', 'o_orderstatus', o_orderstatus FROM orders
    UNION ALL SELECT 'customer', 'c_mktsegment', c_mktsegment FROM customer
    UNION ALL SELECT 'customer', 'segment_raw',
        CASE WHEN c_custkey % 9 = 0 THEN '  ' WHEN c_custkey % 5 = 0 THEN ' ' || c_mktsegment ELSE c_mktsegment END
      FROM customer
"""


@query("categorical_profile", f"""
WITH long AS ({_CATEGORICAL_LONG_SQL})
SELECT dataset, variable, count(*) AS total,
       count(*) FILTER (WHERE value IS NOT NULL AND trim(value) <> '') AS valid,
       count(*) FILTER (WHERE value IS NULL OR trim(value) = '') AS missing,
       round(CAST(count(*) FILTER (WHERE value IS NULL OR trim(value) = '') AS DOUBLE) / count(*) * 100, 2) AS missing_pct,
       count(DISTINCT value) FILTER (WHERE value IS NOT NULL AND trim(value) <> '') AS "unique"
FROM long GROUP BY dataset, variable
""")
def categorical_profile(spark, sf_dir):
    """A9 + P8: text variables of orders and customer (values counted unstripped)."""
    return P.categorical_profile(_categorical_long(spark, sf_dir), ["dataset", "variable"])


@query("top_values", f"""
WITH long AS ({_CATEGORICAL_LONG_SQL}),
c AS (SELECT dataset, variable, value, count(*) AS n FROM long
      WHERE value IS NOT NULL AND trim(value) <> '' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset, variable ORDER BY n DESC, value ASC) AS rank FROM c)
SELECT dataset, variable, CAST(rank AS INTEGER) AS rank, value, n FROM r WHERE rank <= 5
""")
def top_values(spark, sf_dir):
    """Five most frequent values per variable (count desc, value asc)."""
    return P.top_values(_categorical_long(spark, sf_dir), ["dataset", "variable"], 5)


@query("top_value_maps", f"""
WITH long AS ({_CATEGORICAL_LONG_SQL}),
c AS (SELECT dataset, variable, value, count(*) AS n FROM long
      WHERE value IS NOT NULL AND trim(value) <> '' GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY dataset, variable ORDER BY n DESC, value ASC) AS rank FROM c)
SELECT dataset, variable, string_agg(value || '=' || n, '; ' ORDER BY value) AS entries, count(*) AS size
FROM r WHERE rank <= 5 GROUP BY dataset, variable
""")
def top_value_maps(spark, sf_dir):
    """The five most frequent values of each variable as one map, shown by its sorted entries."""
    keys = ["dataset", "variable"]
    maps = P.top_values_map(P.top_values(_categorical_long(spark, sf_dir), keys, 5), keys)
    entries = F.transform(F.array_sort(F.map_entries("top_values")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return maps.select(*keys, F.array_join(entries, "; ").alias("entries"), F.size("top_values").cast("bigint").alias("size"))


# --------------------------------------------------------------- temporal ----
@query("temporal_profile", """
WITH long AS (
  SELECT 'events' AS dataset, 'ts' AS variable, ts AS value FROM events
  UNION ALL SELECT 'orders', 'o_orderdate', o_orderdate FROM orders
  UNION ALL SELECT 'lineitem', 'l_shipdate', l_shipdate FROM lineitem
)
SELECT dataset, variable, count(*) AS total, count(value) AS valid, count(*) - count(value) AS missing,
       round(CAST(count(*) - count(value) AS DOUBLE) / count(*) * 100, 2) AS missing_pct,
       strftime(min(value), '%Y-%m-%d %H:%M:%S') AS earliest, strftime(max(value), '%Y-%m-%d %H:%M:%S') AS latest,
       (epoch_us(max(value)) - epoch_us(min(value))) / 1000000.0 AS span_seconds
FROM long GROUP BY dataset, variable
""")
def temporal_profile(spark, sf_dir):
    """A10: earliest, latest and span of three time columns."""
    ev = read_table(spark, sf_dir, "events").withColumn("dataset", F.lit("events"))
    o = read_table(spark, sf_dir, "orders").withColumn("dataset", F.lit("orders"))
    li = read_table(spark, sf_dir, "lineitem").withColumn("dataset", F.lit("lineitem"))
    long = (
        P.to_long(ev, ["ts"], ["dataset"], kind="time")
        .unionByName(P.to_long(o, ["o_orderdate"], ["dataset"], kind="time"))
        .unionByName(P.to_long(li, ["l_shipdate"], ["dataset"], kind="time"))
    )
    return P.temporal_profile(long, ["dataset", "variable"])


# -------------------------------------------------------------------- gaps ---
def _gap_sql(key_expr: str | None, ts_us: str) -> str:
    part = f"PARTITION BY {key_expr} " if key_expr else ""
    sel = f"{key_expr}, " if key_expr else ""
    grp = f"GROUP BY {key_expr}" if key_expr else ""
    join = f"USING ({key_expr})" if key_expr else "ON TRUE"
    return f"""
WITH t AS (SELECT {sel}{ts_us} AS us FROM events),
d AS (SELECT {sel}us - lag(us) OVER ({part}ORDER BY us) AS gap FROM t),
m AS (SELECT {sel}quantile_cont(gap, 0.5) AS med, max(gap) AS mx FROM d {grp}),
c AS (SELECT {sel}count(*) AS valid FROM t {grp}),
l AS (SELECT {sel}count(*) FILTER (WHERE d.gap > 3 * m.med) AS large FROM d JOIN m {join} {grp})
SELECT {sel}c.valid, coalesce(m.med / 1e6, 0.0) AS median_gap_seconds, coalesce(m.mx / 1e6, 0.0) AS max_gap_seconds,
       CAST(coalesce(l.large, 0) AS BIGINT) AS large_gaps
FROM c JOIN m {join} JOIN l {join}
"""


@query("gap_analysis", _gap_sql(None, "epoch_us(ts)"))
def gap_analysis(spark, sf_dir):
    """W1 + A11 over the whole events time column, without a global sort."""
    from tidepool.operators.gaps import gap_analysis as ga

    ev = read_table(spark, sf_dir, "events")
    return ga(ev, [], F.col("ts"))


@query("gap_analysis_by_group", _gap_sql("user_id", "epoch_us(ts)"))
def gap_analysis_by_group(spark, sf_dir):
    """W1 + A11 per user."""
    from tidepool.operators.gaps import gap_analysis as ga

    ev = read_table(spark, sf_dir, "events")
    return ga(ev, ["user_id"], F.col("ts"))


@query("gap_analysis_sentinel", _gap_sql(None, "CASE event_id % 1000 WHEN 0 THEN -2208988800000000 WHEN 1 THEN 32503680000000000 ELSE epoch_us(ts) END"))
def gap_analysis_sentinel(spark, sf_dir):
    """W1 + A11 with stray dates of 1900 and 3000 among the times: two great gaps, all others as they were."""
    from tidepool.operators.gaps import gap_analysis as ga

    k, ts = F.col("event_id") % 1000, F.col("ts").cast("timestamp")
    stray = F.when(k == 0, F.timestamp_micros(F.lit(-2208988800000000))).when(k == 1, F.timestamp_micros(F.lit(32503680000000000)))
    return ga(read_table(spark, sf_dir, "events"), [], F.coalesce(stray, ts))


@query("gap_analysis_ties", _gap_sql(None, "CAST(floor(epoch_us(ts) / 600000000.0) * 600000000 AS BIGINT)"))
def gap_analysis_ties(spark, sf_dir):
    """W1 + A11 with times floored to 10 minutes (many repeats, median gap 0)."""
    from tidepool.operators.gaps import gap_analysis as ga

    ev = read_table(spark, sf_dir, "events")
    floored = F.timestamp_micros((F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 600000000.0) * 600000000).cast("long"))
    return ga(ev, [], floored)
