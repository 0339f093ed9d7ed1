"""Extent and vocabulary queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool import fixed
from tidepool.functions.headers import normalize_header
from tidepool.operators import extent as E
from tidepool.operators import vocabulary as V
from tidepool.plans import query, sql_over
from tidepool.plans.cleaning import sql_normalize
from tidepool.plans.quality import _POSITIONS_SQL
from tidepool.session import checkpoint_dir, read_table

# --------------------------------------------------------------------- extent --
_ROLE_VALUES_SQL = f"""
  SELECT c.c_nationkey AS dataset, 'lat' AS role, p.lat AS value, NULL::TIMESTAMP AS ts
  FROM ({_POSITIONS_SQL.replace('SELECT c_mktsegment,', 'SELECT c_custkey, c_mktsegment,')}) p JOIN customer c USING (c_custkey)
  UNION ALL
  SELECT c.c_nationkey, 'lon', p.lon, NULL::TIMESTAMP
  FROM ({_POSITIONS_SQL.replace('SELECT c_mktsegment,', 'SELECT c_custkey, c_mktsegment,')}) p JOIN customer c USING (c_custkey)
  UNION ALL
  SELECT c.c_nationkey, 'time', NULL, o.o_orderdate FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""
_NUM = r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?)$"
_DETECTED_SQL = f"""
  SELECT dataset,
    min(CASE WHEN role = 'lon' AND regexp_matches(trim(value), '{_NUM}') THEN TRY_CAST(trim(value) AS DOUBLE) END) AS west_lon,
    max(CASE WHEN role = 'lon' AND regexp_matches(trim(value), '{_NUM}') THEN TRY_CAST(trim(value) AS DOUBLE) END) AS east_lon,
    min(CASE WHEN role = 'lat' AND regexp_matches(trim(value), '{_NUM}') THEN TRY_CAST(trim(value) AS DOUBLE) END) AS south_lat,
    max(CASE WHEN role = 'lat' AND regexp_matches(trim(value), '{_NUM}') THEN TRY_CAST(trim(value) AS DOUBLE) END) AS north_lat,
    strftime(min(ts), '%Y-%m-%d') AS "begin", strftime(max(ts), '%Y-%m-%d') AS "end"
  FROM ({_ROLE_VALUES_SQL}) GROUP BY dataset
"""


def _role_values(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    o = read_table(spark, sf_dir, "orders")
    pos = sql_over(spark, sf_dir, _POSITIONS_SQL.replace("SELECT c_mktsegment,", "SELECT c_custkey, c_nationkey,"), ["customer"])
    nul = F.lit(None).cast("timestamp")
    lat = pos.select(F.col("c_nationkey").alias("dataset"), F.lit("lat").alias("role"), F.col("lat").alias("value"), nul.alias("ts"))
    lon = pos.select(F.col("c_nationkey").alias("dataset"), F.lit("lon").alias("role"), F.col("lon").alias("value"), nul.alias("ts"))
    t = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("c_nationkey").alias("dataset"), F.lit("time").alias("role"), F.lit(None).cast("string").alias("value"),
        F.col("o_orderdate").cast("timestamp").alias("ts"))
    return lat.unionByName(lon).unionByName(t)


@query("extent_by_dataset", _DETECTED_SQL)
def extent_by_dataset(spark, sf_dir):
    """A15 + U2: per nation, positions of its customers and dates of their orders as one extent."""
    return E.extent(_role_values(spark, sf_dir), ["dataset"])


_CONFIG_SQL = """
  SELECT n_nationkey AS dataset,
         CASE WHEN n_nationkey % 5 = 0 THEN '-10.5' WHEN n_nationkey % 5 = 1 THEN '  ' END AS west_lon,
         CASE WHEN n_nationkey % 4 = 0 THEN '12.25' END AS east_lon,
         CAST(NULL AS VARCHAR) AS south_lat,
         CASE WHEN n_nationkey % 6 = 0 THEN '45' END AS north_lat,
         CASE WHEN n_nationkey % 7 = 0 THEN '1990-01-01' WHEN n_nationkey % 7 = 1 THEN '' END AS "begin",
         CAST(NULL AS VARCHAR) AS "end"
  FROM nation
"""


@query("extent_merge", f"""
WITH c AS ({_CONFIG_SQL}), d AS ({_DETECTED_SQL})
SELECT coalesce(c.dataset, d.dataset) AS dataset,
       coalesce(TRY_CAST(nullif(trim(c.west_lon), '') AS DOUBLE), d.west_lon) AS west_lon,
       coalesce(TRY_CAST(nullif(trim(c.east_lon), '') AS DOUBLE), d.east_lon) AS east_lon,
       coalesce(TRY_CAST(nullif(trim(c.south_lat), '') AS DOUBLE), d.south_lat) AS south_lat,
       coalesce(TRY_CAST(nullif(trim(c.north_lat), '') AS DOUBLE), d.north_lat) AS north_lat,
       coalesce(nullif(trim(c."begin"), ''), d."begin") AS "begin",
       coalesce(nullif(trim(c."end"), ''), d."end") AS "end"
FROM c FULL OUTER JOIN d ON c.dataset = d.dataset
""")
def extent_merge(spark, sf_dir):
    """J-6 + P11: configured extent fields (some blank) override the detected ones."""
    spark_sql = _CONFIG_SQL.replace("CAST(NULL AS VARCHAR)", "CAST(NULL AS STRING)")
    cfg = sql_over(spark, sf_dir, spark_sql.replace('"begin"', "`begin`").replace('"end"', "`end`"), ["nation"])
    return E.merge_extent(cfg, extent_by_dataset(spark, sf_dir), ["dataset"])


_COVERAGE_SQL = """
SELECT event_type,
       min(CAST((user_id * 37) % 180 - 90 AS DOUBLE)) AS geospatial_lat_min,
       max(CAST((user_id * 37) % 180 - 90 AS DOUBLE)) AS geospatial_lat_max,
       min(CAST((user_id * 53) % 360 - 180 AS DOUBLE)) AS geospatial_lon_min,
       max(CAST((user_id * 53) % 360 - 180 AS DOUBLE)) AS geospatial_lon_max,
       min(value) AS geospatial_vertical_min, max(value) AS geospatial_vertical_max,
       strftime(min(ts), '%Y-%m-%dT%H:%M:%SZ') AS time_coverage_start,
       strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS time_coverage_end
FROM events GROUP BY event_type
"""


def _observations(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        "event_type", F.col("event_id").alias("obs_id"),
        ((F.col("user_id") * 37) % 180 - 90.0).alias("latitude"), ((F.col("user_id") * 53) % 360 - 180.0).alias("longitude"),
        F.col("value").alias("depth_m"), F.col("ts").alias("time"),
        F.get_json_object("props", "$.k").cast("double").alias("temperature_c"), F.col("props").alias("comment_text"),
    )


@query("coverage_attributes", _COVERAGE_SQL)
def coverage_attributes(spark, sf_dir):
    """Per-file lat/lon/depth ranges and time coverage of events read as observations."""
    obs = _observations(spark, sf_dir)
    return E.coverage(obs, ["event_type"], "latitude", "longitude", "depth_m", "time")


# ----------------------------------------------------------------- vocabulary --
# --- Fixed values: measurement labels combined with part names as column names --
LABELS = ("Temperature (°C)", "Salinity (PSU)", "Dissolved Oxygen (mg/L)", "pH", "Total Alkalinity (µmol/kg)",
          "NO3 (µmol/L)", "PO4 (µmol/L)", "Depth (m)", "Latitude_DD", "Longitude_DD", "Station ID",
          "Bottom Depth (m)", "Phosphate", "Plate Count", "Notes")

_LABELS_SQL = "[" + ", ".join("'" + x + "'" for x in LABELS) + "]"
_CATALOGUE_SQL = f"""
  SELECT p_brand AS dataset, p_partkey AS ordinal,
         list_extract({_LABELS_SQL}, CAST(p_partkey % {len(LABELS)} AS INTEGER) + 1) || ' ' || p_name AS raw_name
  FROM part
"""
_KEYS = ["temperature", "salinity", "dissolved_oxygen", "ph", "total_alkalinity", "no3", "po4", "depth", "latitude",
         "longitude"]
_STD = ["sea_water_temperature", "sea_water_practical_salinity", "mass_concentration_of_oxygen_in_sea_water",
        "sea_water_ph_reported_on_total_scale", "sea_water_alkalinity_expressed_as_mole_equivalent",
        "mole_concentration_of_nitrate_in_sea_water", "mole_concentration_of_phosphate_in_sea_water", "depth",
        "latitude", "longitude"]
_MATCH_SQL = "CASE " + " ".join(
    f"WHEN contains(replace(lower(norm_name), ' ', '_'), '{k}') THEN '{s}'" for k, s in zip(_KEYS, _STD)
) + " ELSE '' END"


def _catalogue(spark, sf_dir):
    part = read_table(spark, sf_dir, "part")
    labels = F.array(*[F.lit(x) for x in LABELS])
    raw = F.concat(F.element_at(labels, (F.col("p_partkey") % len(LABELS)).cast("int") + 1), F.lit(" "), F.col("p_name"))
    cat = part.select(F.col("p_brand").alias("dataset"), F.col("p_partkey").alias("ordinal"), raw.alias("raw_name"))
    return cat.withColumn("norm_name", normalize_header(F.col("raw_name")))


@query("vocabulary_match", f"""
SELECT dataset, ordinal, raw_name, norm_name, {_MATCH_SQL} AS standard_name
FROM (SELECT *, {sql_normalize('raw_name')} AS norm_name FROM ({_CATALOGUE_SQL}))
""")
def vocabulary_match(spark, sf_dir):
    """J-5 + W3: every catalogued column mapped to the first vocabulary key it contains."""
    m = V.match_vocabulary(_catalogue(spark, sf_dir), "norm_name")
    return m.select("dataset", "ordinal", "raw_name", "norm_name", "standard_name")


@query("vocabulary_coverage", f"""
SELECT dataset, count(*) AS columns, count(*) FILTER (WHERE standard_name <> '') AS mapped
FROM (SELECT dataset, {_MATCH_SQL} AS standard_name
      FROM (SELECT *, {sql_normalize('raw_name')} AS norm_name FROM ({_CATALOGUE_SQL})))
GROUP BY dataset
""")
def vocabulary_coverage(spark, sf_dir):
    """Mapped column count per dataset."""
    m = V.match_vocabulary(_catalogue(spark, sf_dir), "norm_name")
    return m.groupBy("dataset").agg(F.count(F.lit(1)).alias("columns"),
                                    F.count_if(F.col("standard_name") != "").alias("mapped"))


@query("export_verify", """
SELECT event_type, count(*) AS rows_source, count(*) AS rows_written, true AS ok FROM events GROUP BY event_type
""")
def export_verify(spark, sf_dir):
    """S12 + S13: export observations with vocabulary attributes, read back, compare rows per file."""
    obs = _observations(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    V.export_observations(obs, path, partition_by=["event_type"])
    return V.verify_export(spark, obs, path, ["event_type"])


@query("export_failures", """
WITH e AS (SELECT event_type, event_id, dense_rank() OVER (ORDER BY event_type) AS k FROM events)
SELECT event_type, count(*) AS rows_source, count(*) FILTER (WHERE k > 2 OR (k = 2 AND event_id % 7 <> 0)) AS rows_written,
       count(*) = count(*) FILTER (WHERE k > 2 OR (k = 2 AND event_id % 7 <> 0)) AS ok
FROM e GROUP BY event_type
""")
def export_failures(spark, sf_dir):
    """An export that lacks all rows of the first event type and every seventh id of the second."""
    obs = _observations(spark, sf_dir)
    first, second = (r[0] for r in obs.select("event_type").distinct().orderBy("event_type").limit(2).collect())  # two names
    kept = obs.where((F.col("event_type") != first) & ((F.col("event_type") != second) | (F.col("obs_id") % 7 != 0)))
    path = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    V.export_observations(kept, path, partition_by=["event_type"])
    return V.verify_export(spark, obs, path, ["event_type"])


def _sql(v):
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"CAST({v!r} AS DOUBLE)"


_OBS_COLUMNS = (("obs_id", True), ("latitude", True), ("longitude", True), ("depth_m", True), ("time", False), ("temperature_c", True), ("comment_text", False))
_ATTRIBUTES_SQL = f"""
WITH v(k, key, standard_name, long_name, units, lo, hi, axis, positive, comment) AS
  (VALUES {", ".join("(" + str(i) + ", " + ", ".join(_sql(x) for x in row) + ")" for i, row in enumerate(fixed.VOCABULARY))}),
c(name, numeric) AS (VALUES {", ".join(f"('{n}', {'true' if b else 'false'})" for n, b in _OBS_COLUMNS)}),
hit AS (SELECT c.name, c.numeric, v.* FROM c LEFT JOIN v ON c.numeric AND contains(c.name, v.key)
        QUALIFY row_number() OVER (PARTITION BY c.name ORDER BY v.k) = 1),
a AS (
  SELECT name AS "column", 'long_name' AS attribute, coalesce(long_name, name) AS value FROM hit
  UNION ALL SELECT name, 'standard_name', standard_name FROM hit UNION ALL SELECT name, 'units', units FROM hit
  UNION ALL SELECT name, 'axis', axis FROM hit UNION ALL SELECT name, 'positive', positive FROM hit
  UNION ALL SELECT name, 'comment', comment FROM hit
  UNION ALL SELECT name, 'valid_min', CAST(lo AS VARCHAR) FROM hit UNION ALL SELECT name, 'valid_max', CAST(hi AS VARCHAR) FROM hit
  UNION ALL SELECT name, 'valid_range', '[' || lo || ', ' || hi || ']' FROM hit
  UNION ALL SELECT name, '_FillValue', '-999.0' FROM hit WHERE numeric),
g AS (SELECT * FROM ({_COVERAGE_SQL})),
w AS (
  SELECT event_type, 'geospatial_lat_min' AS attribute, CAST(geospatial_lat_min AS VARCHAR) AS value FROM g
  UNION ALL SELECT event_type, 'geospatial_lat_max', CAST(geospatial_lat_max AS VARCHAR) FROM g
  UNION ALL SELECT event_type, 'geospatial_lat_units', 'degrees_north' FROM g
  UNION ALL SELECT event_type, 'geospatial_lon_min', CAST(geospatial_lon_min AS VARCHAR) FROM g
  UNION ALL SELECT event_type, 'geospatial_lon_max', CAST(geospatial_lon_max AS VARCHAR) FROM g
  UNION ALL SELECT event_type, 'geospatial_lon_units', 'degrees_east' FROM g
  UNION ALL SELECT event_type, 'geospatial_vertical_min', CAST(geospatial_vertical_min AS VARCHAR) FROM g
  UNION ALL SELECT event_type, 'geospatial_vertical_max', CAST(geospatial_vertical_max AS VARCHAR) FROM g
  UNION ALL SELECT event_type, 'geospatial_vertical_units', 'm' FROM g
  UNION ALL SELECT event_type, 'geospatial_vertical_positive', 'down' FROM g
  UNION ALL SELECT event_type, 'time_coverage_start', time_coverage_start FROM g
  UNION ALL SELECT event_type, 'time_coverage_end', time_coverage_end FROM g)
SELECT event_type, "column", attribute, value FROM a, (SELECT DISTINCT event_type FROM events) WHERE value IS NOT NULL
UNION ALL SELECT event_type, '', attribute, value FROM w WHERE value IS NOT NULL
"""


@query("export_attributes", _ATTRIBUTES_SQL)
def export_attributes(spark, sf_dir):
    """S12 + P16 + A16 read back: every column attribute of the written export and every coverage attribute written beside it."""
    obs = _observations(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/export-{uuid.uuid4().hex}"
    V.export_observations(obs, f"{path}/data", partition_by=["event_type"])
    covered = E.with_units(E.coverage(obs, ["event_type"], "latitude", "longitude", "depth_m", "time"))
    V.global_attributes(covered, ["event_type"]).write.parquet(f"{path}/attributes")
    of_columns = [F.struct(*[F.lit(r[c]).alias(c) for c in ("column", "attribute", "value")])
                  for r in V.column_attributes(spark, f"{path}/data").collect()]  # some a column
    files = spark.read.parquet(f"{path}/data").select("event_type").distinct()
    rows = files.select("event_type", F.explode(F.array(*of_columns)).alias("a")).select("event_type", "a.*")
    return rows.unionByName(spark.read.parquet(f"{path}/attributes").withColumn("column", F.lit("")))
