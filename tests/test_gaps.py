"""Two-level gap analysis equals the single global window (unique and tied times)."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.operators.gaps import gap_analysis


def _brute(times):
    t = np.sort(np.array(times, dtype="int64"))
    if len(t) < 2:
        return len(t), 0.0, 0.0, 0
    d = np.diff(t)
    med = np.median(d)
    return len(t), med / 1e6, d.max() / 1e6, int((d > 3 * med).sum())


@pytest.mark.parametrize("floor_us", [1, 600_000_000])
def test_global_matches_brute_force(spark, smoke_dir, floor_us):
    ev = spark.read.parquet(f"{smoke_dir}/events.parquet")
    us = (F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / floor_us) * floor_us).cast("long")
    ts = F.timestamp_micros(us)
    got = gap_analysis(ev, [], ts).first()
    times = [r.u for r in ev.select(us.alias("u")).collect()]
    n, med, mx, large = _brute(times)
    assert (got.valid, got.large_gaps) == (n, large)
    assert np.isclose(got.median_gap_seconds, med) and np.isclose(got.max_gap_seconds, mx)


def test_grouped_matches_brute_force(spark, smoke_dir):
    ev = spark.read.parquet(f"{smoke_dir}/events.parquet")
    got = {r.user_id: r for r in gap_analysis(ev, ["user_id"], F.col("ts")).collect()}
    pdf = ev.select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("u")).toPandas()
    for uid, part in pdf.groupby("user_id"):
        n, med, mx, large = _brute(part.u.tolist())
        r = got[uid]
        assert (r.valid, r.large_gaps) == (n, large)
        assert np.isclose(r.median_gap_seconds, med) and np.isclose(r.max_gap_seconds, mx)


def test_sentinels_do_not_gather_times(spark):
    import datetime as dt

    from tidepool.operators.gaps import dealt_times

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        near = spark.range(40_000).select(F.timestamp_seconds(1_600_000_000 + F.col("id") * 3).alias("ts"))
        ends = spark.createDataFrame([(dt.datetime(1970, 1, 1),), (dt.datetime(9999, 12, 31),)], "ts timestamp")
        times = near.unionAll(ends)
        dealt = dealt_times(times, [], F.col("ts"))
        most = dealt.groupBy("_p").count().agg(F.max("count")).first()[0]
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        got = gap_analysis(times, [], F.col("ts")).first()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert most <= 2 * 40_002 / parts
    assert (got.valid, got.median_gap_seconds, got.large_gaps) == (40_002, 3.0, 2)


def test_no_times_give_no_row(spark):
    assert gap_analysis(spark.createDataFrame([(None,)], "ts timestamp"), [], F.col("ts")).count() == 0
    one = gap_analysis(spark.createDataFrame([(1,)], "i int").select(F.timestamp_seconds("i").alias("ts")), [], F.col("ts")).first()
    assert (one.valid, one.median_gap_seconds, one.max_gap_seconds, one.large_gaps) == (1, 0.0, 0.0, 0)
