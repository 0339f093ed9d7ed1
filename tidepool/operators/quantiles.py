"""Exact quantiles (linear interpolation) that never gather a group in one task.

Spark's exact ``percentile`` keeps every distinct value of a group in one
aggregation buffer, so one hot group (a third of the data) ends in one task.
Here three passes find each wanted rank, whatever the distribution:

1. rows are counted per ``(group, coarse bucket)``, buckets of a signed log
   scale about 3 % wide (infinities have their own); a running sum over a
   group's few thousand buckets tells which ones hold wanted ranks;
2. rows of those buckets are counted per fine bucket, ``FINE`` equal parts
   of the coarse bucket's real range;
3. the few rows left are counted per value, and a running sum over them ends
   at the rank.

Every count combines before its shuffle, a hot group is spread over its
buckets, and the tables between passes hold a row per group and rank. They
are written to the shared checkpoint folder, so the planner knows their size
and broadcasts them only where they are small. The last pass is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import stored

FINE = 65_536
COARSE_PER_E = 32  # coarse buckets for each factor of e in magnitude
# ln of the smallest positive double is about -744.4: shifting by 746 keeps every magnitude positive.
LOG_SHIFT = 746.0


def _coarse(v: Column) -> Column:
    """Monotone in v: the number of its bucket on a signed log scale."""
    scale = F.when(v == 0, F.lit(0.0)).otherwise(F.signum(v) * (F.log(F.abs(v)) + LOG_SHIFT)) * COARSE_PER_E
    inf = F.lit(float("inf"))
    return F.when(v == inf, F.lit(1 << 40)).when(v == -inf, F.lit(-(1 << 40))).otherwise(F.floor(scale).cast("long"))


def _fine(v: Column, lo: Column, hi: Column) -> Column:
    """Monotone in v: the number of its part of [lo, hi] (halves stay finite near the double limits)."""
    part = F.floor((v / 2 - lo / 2) / (hi / 2 - lo / 2) * FINE).cast("long")
    return F.when(hi > lo, F.least(part, F.lit(FINE - 1))).otherwise(F.lit(0).cast("long"))


def _ranks(n: Column, probs: dict[str, float]) -> Column:
    """The (0-based) ranks that the quantiles of n values interpolate between."""
    at = [F.lit(float(p)) * (n - 1).cast("double") for p in probs.values()]
    return F.array_distinct(F.array(*[f(x).cast("long") for x in at for f in (F.floor, F.ceil)]))


def _holding(probs: dict[str, float], count: str) -> Column:
    """The wanted ranks among ``count`` values that follow ``_start`` earlier ones."""
    start = F.col("_start")
    return F.filter(_ranks(F.col("_n"), probs), lambda k: (k >= start) & (k < start + F.col(count)))


def _on(rows: DataFrame, state: DataFrame, keys: list[str]) -> Column:
    cond = rows["_b"] == state["_s_b"]
    for k in keys:
        cond = cond & rows[k].eqNullSafe(state[f"_s{k}"])
    return cond


def _as_state(df: DataFrame, keys: list[str]) -> DataFrame:
    return stored(df.withColumnsRenamed({k: f"_s{k}" for k in [*keys, "_b"]}))


def exact_quantiles(df: DataFrame, keys: list[str], value: str | Column, probs: dict[str, float],
                    weight: str | None = None) -> DataFrame:
    """Per group of ``keys``, the linearly interpolated quantile for each ``probs`` item.

    ``weight`` (a positive count column) makes each row count that many times.
    Null and NaN values do not count; infinities do. Returns ``keys +
    list(probs)`` with one row per group that has a valid value.
    """
    vcol = F.col(value) if isinstance(value, str) else value
    wcol = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    base = df.select(*[F.col(k) for k in keys], vcol.cast("double").alias("_v"), wcol.alias("_w"))
    base = base.where(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.col("_w") > 0)).withColumn("_b", _coarse(F.col("_v")))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)

    coarse = base.groupBy(*keys, "_b").agg(F.sum("_w").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    start = F.coalesce(F.sum("_c").over(before(Window.partitionBy(*keys).orderBy("_b"))), F.lit(0))
    coarse = coarse.withColumn("_start", start).withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    one = _as_state(coarse.where(F.size(_holding(probs, "_c")) > 0).select(*keys, "_b", "_lo", "_hi", "_start", "_n"), keys)

    own = [*keys, "_b"]
    fine = base.join(one, _on(base, one, keys)).withColumn("_f", _fine(F.col("_v"), F.col("_lo"), F.col("_hi")))
    fine = fine.groupBy(*own, "_lo", "_hi", "_n", F.col("_start").alias("_s0"), "_f").agg(F.sum("_w").alias("_c"))
    start = F.col("_s0") + F.coalesce(F.sum("_c").over(before(Window.partitionBy(*own).orderBy("_f"))), F.lit(0))
    fine = fine.withColumn("_start", start).where(F.size(_holding(probs, "_c")) > 0)
    two = _as_state(fine.select(*own, "_lo", "_hi", F.col("_f").alias("_sf"), "_start", "_n"), keys)

    last = base.join(two, _on(base, two, keys)).where(_fine(F.col("_v"), F.col("_lo"), F.col("_hi")) == F.col("_sf"))
    last = last.groupBy(*own, "_sf", "_n", F.col("_start").alias("_s0"), "_v").agg(F.sum("_w").alias("_c"))
    start = F.col("_s0") + F.coalesce(F.sum("_c").over(before(Window.partitionBy(*own, "_sf").orderBy("_v"))), F.lit(0))
    hit = last.withColumn("_start", start).select(*keys, "_n", "_v", F.explode(_holding(probs, "_c")).alias("_k"))

    out = []
    for name, p in probs.items():
        at = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        v0, v1 = (F.max(F.when(F.col("_k") == f(at).cast("long"), F.col("_v"))) for f in (F.floor, F.ceil))
        frac = F.max(at - F.floor(at))
        out.append(F.when(v0 == v1, v0).otherwise(v0 + (v1 - v0) * frac).alias(name))
    return hit.groupBy(*keys).agg(*out)
