"""Spatial and temporal extent (A15, A16, J-6, U2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.numeric import to_number
from tidepool.functions.temporal import iso_date, iso_utc
from tidepool.functions.text import present

EXTENT_FIELDS = ("west_lon", "east_lon", "south_lat", "north_lat", "begin", "end")


def extent(values: DataFrame, keys: list[str]) -> DataFrame:
    """One extent row per group from role-tagged values.

    ``values`` is ``keys + (role, value, ts)``: ``role`` is ``lat``, ``lon`` or
    ``time`` (the union of every matching column of every file, U2), ``value``
    the raw position (coerced here) and ``ts`` the parsed time of ``time`` rows.
    One grouped aggregate; no value lists are gathered.
    """
    num = to_number(F.col("value"))
    is_lat, is_lon = F.col("role") == "lat", F.col("role") == "lon"
    ts = F.when(F.col("role") == "time", F.col("ts"))
    agg = values.groupBy(*keys).agg(
        F.min(F.when(is_lon, num)).alias("west_lon"), F.max(F.when(is_lon, num)).alias("east_lon"),
        F.min(F.when(is_lat, num)).alias("south_lat"), F.max(F.when(is_lat, num)).alias("north_lat"),
        F.min(ts).alias("_b"), F.max(ts).alias("_e"),
    )
    return agg.select(*keys, "west_lon", "east_lon", "south_lat", "north_lat",
                      iso_date(F.col("_b")).alias("begin"), iso_date(F.col("_e")).alias("end"))


def merge_extent(configured: DataFrame, detected: DataFrame, keys: list[str]) -> DataFrame:
    """J-6 + P11: configured value wins per field unless missing or blank.

    A full outer join on the keys, so datasets known on one side only keep
    their extent. Configured values are text (as written in a config).
    """
    j = configured.alias("c").join(detected.alias("d"), on=keys, how="full_outer")
    out = []
    for f in EXTENT_FIELDS:
        cfg = present(F.col(f"c.{f}").cast("string"))
        if f in ("begin", "end"):
            out.append(F.coalesce(cfg, F.col(f"d.{f}")).alias(f))
        else:
            out.append(F.coalesce(to_number(cfg), F.col(f"d.{f}")).alias(f))
    return j.select(*keys, *out)


def coverage(df: DataFrame, keys: list[str], lat: str | None, lon: str | None, depth: str | None,
             time: str | None) -> DataFrame:
    """Per-file coverage attributes (min/max of each role column, time start/end in ISO)."""
    aggs = []
    for role, c in (("geospatial_lat", lat), ("geospatial_lon", lon), ("geospatial_vertical", depth)):
        x = to_number(F.col(c)) if c else F.lit(None).cast("double")
        aggs += [F.min(x).alias(f"{role}_min"), F.max(x).alias(f"{role}_max")]
    t = F.col(time).cast("timestamp") if time else F.lit(None).cast("timestamp")
    aggs += [F.min(t).alias("_t0"), F.max(t).alias("_t1")]
    agg = df.groupBy(*keys).agg(*aggs)
    return agg.select(*keys, *[c for c in agg.columns if c.startswith("geospatial")],
                      iso_utc(F.col("_t0")).alias("time_coverage_start"), iso_utc(F.col("_t1")).alias("time_coverage_end"))


# --- Fixed values: units of the coverage attributes ---
COVERAGE_UNITS = {
    "geospatial_lat": {"units": "degrees_north"},
    "geospatial_lon": {"units": "degrees_east"},
    "geospatial_vertical": {"units": "m", "positive": "down"},
}


def with_units(covered: DataFrame) -> DataFrame:
    """The units of each axis that :func:`coverage` found a range for, and which way depth counts."""
    return covered.withColumns({f"{axis}_{k}": F.when(F.col(f"{axis}_min").isNotNull(), F.lit(v))
                                for axis, attrs in COVERAGE_UNITS.items() for k, v in attrs.items()})
