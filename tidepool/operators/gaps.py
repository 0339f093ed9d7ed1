"""Gap analysis over sorted times without one global sort.

A whole-column ``lag`` over ``Window.orderBy(ts)`` runs in a single task. The
plan here is two-level:

1. distinct times per group with their multiplicity (map-side combined);
   repeats contribute ``n - 1`` zero gaps;
2. the times are dealt out by range of ``(group, time)``, so that each stretch
   holds about as many of them wherever they lie on the axis (a stray date far
   from the others changes nothing), and ``lag`` runs within each stretch;
3. a table with a row per group and stretch carries each stretch's previous
   maximum with a second, small ``lag``; that gives the gaps across edges.

The median gap is an exact weighted quantile (:mod:`quantiles`), the large-gap
count compares each distinct gap with ``3 x median``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool import fixed
from tidepool.operators.quantiles import exact_quantiles
from tidepool.session import stored


def dealt_times(df: DataFrame, keys: list[str], ts: Column) -> DataFrame:
    """``keys + (_t, _n, _p)``: distinct times in microseconds, how often each occurs, and its stretch."""
    base = df.select(*[F.col(k) for k in keys], F.unix_micros(ts.cast("timestamp")).alias("_t"))
    times = base.where(F.col("_t").isNotNull()).groupBy(*keys, "_t").agg(F.count(F.lit(1)).alias("_n"))
    return stored(times.repartitionByRange(*keys, "_t").withColumn("_p", F.spark_partition_id()))


def time_gaps(times: DataFrame, keys: list[str]) -> DataFrame:
    """All consecutive gaps in microseconds as ``keys + (gap_us, w)`` (``w`` = multiplicity) of dealt times."""
    one = F.lit(1).cast("long").alias("_w")
    gap = F.col("_t") - F.lag("_t").over(Window.partitionBy(*keys, "_p").orderBy("_t"))
    within = times.select(*keys, gap.alias("gap_us"), one).where(F.col("gap_us").isNotNull())
    stretches = times.groupBy(*keys, "_p").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    across = F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys).orderBy("_p"))
    edges = stretches.select(*keys, across.alias("gap_us"), one).where(F.col("gap_us").isNotNull())
    repeats = times.where(F.col("_n") > 1).select(*keys, F.lit(0).cast("long").alias("gap_us"), (F.col("_n") - 1).alias("_w"))
    return within.unionByName(edges).unionByName(repeats).groupBy(*keys, "gap_us").agg(F.sum("_w").alias("w"))


def gap_analysis(df: DataFrame, keys: list[str], ts: Column) -> DataFrame:
    """Per group valid count, median gap, max gap and gaps > 3x median (seconds).

    Groups with one valid time report zero gaps, as a sorted diff would; no valid time gives no row.
    """
    times = dealt_times(df, keys, ts)
    gaps = stored(time_gaps(times, keys))  # read by every pass of the median search
    med = exact_quantiles(gaps, keys, "gap_us", {"_med": 0.5}, weight="w")
    counts = times.groupBy(*keys).agg(F.sum("_n").alias("valid")).where(F.col("valid") > 0)
    if keys:
        med = stored(med).withColumnsRenamed({k: f"_m{k}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"_m{k}")) for k in keys]
        g, limit = gaps.join(med, same), F.col("_med")
    else:
        g, limit = gaps, med.scalar()
    summary = g.groupBy(*keys).agg(
        F.max(limit).alias("_med"), F.max("gap_us").alias("_max"),
        F.sum(F.when(F.col("gap_us") > fixed.LARGE_GAP_FACTOR * limit, F.col("w")).otherwise(0)).alias("_large"),
    )
    if keys:
        summary = summary.withColumnsRenamed({k: f"_m{k}" for k in keys})
        res = counts.join(summary, same, "left")
    else:  # one row each
        row = summary.select(F.struct("_med", "_max", "_large"))
        res = counts.withColumn("_r", row.scalar()).select("valid", "_r.*")
    return res.select(
        *keys,
        F.col("valid").cast("long").alias("valid"),
        F.coalesce(F.col("_med") / 1e6, F.lit(0.0)).alias("median_gap_seconds"),
        F.coalesce(F.col("_max") / 1e6, F.lit(0.0)).alias("max_gap_seconds"),
        F.coalesce(F.col("_large"), F.lit(0)).cast("long").alias("large_gaps"),
    )
