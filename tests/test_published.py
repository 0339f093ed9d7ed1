"""Published snapshots, exports that fail, transform summaries and canonical configurations."""

import pytest
from pyspark.sql import functions as F

from tidepool.operators import fixity as X
from tidepool.operators import vocabulary as V
from tidepool.operators.transform import RowsLost, raise_if_lost, transform_to_csv
from tidepool.sources import provenance as PV

FILES = "path string, sha256 string, size_bytes bigint, format string, role string"
KV = "key string, value string"


def _files(spark, n):
    return spark.createDataFrame([(f"raw/{k}.csv", "0" * 64, 10, "text/csv", "raw_data") for k in range(n)], FILES)


def _info(spark, path, version=None):
    return {r.key: r.value for r in X.read_manifest(spark, path, version)[1].collect()}


def test_a_snapshot_is_seen_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        X.read_manifest(spark, path)
    assert X.publish_manifest(spark, path, _files(spark, 2), spark.createDataFrame([("owner", "a")], KV)) == 1

    def lost(*_):
        raise RuntimeError("the writer is lost before it can publish")

    with monkeypatch.context() as m:
        m.setattr(X, "_publish", lost)
        with pytest.raises(RuntimeError):
            X.publish_manifest(spark, path, _files(spark, 5))
    files, info = X.read_manifest(spark, path)
    assert files.count() == 2 and {r.key: r.value for r in info.collect()} == {"owner": "a", "total_files": "2", "total_bytes": "20"}
    assert X.publish_manifest(spark, path, _files(spark, 5), spark.createDataFrame([("owner", "b")], KV)) == 2
    assert _info(spark, path) == {"owner": "b", "total_files": "5", "total_bytes": "50"}
    assert _info(spark, path, 1)["owner"] == "a"


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path):
    path = str(tmp_path)
    X.publish_manifest(spark, path, _files(spark, 1))
    assert X.publish_manifest(spark, path, _files(spark, 2), spark.createDataFrame([("by", "first")], KV), base=1) == 2
    with pytest.raises(X.SnapshotConflict):
        X.publish_manifest(spark, path, _files(spark, 3), spark.createDataFrame([("by", "second")], KV), base=1)
    assert _info(spark, path) == {"by": "first", "total_files": "2", "total_bytes": "20"}
    assert X.publish_manifest(spark, path, _files(spark, 3)) == 3 and _info(spark, path)["by"] == "first"


def test_an_empty_file_list_has_totals(spark, tmp_path):
    X.publish_manifest(spark, str(tmp_path), _files(spark, 1).limit(0))
    assert _info(spark, str(tmp_path)) == {"total_files": "0", "total_bytes": "0"}


def test_a_failing_export_raises(spark, tmp_path):
    obs = spark.range(30).select((F.col("id") % 3).cast("string").alias("file"), F.col("id").cast("double").alias("depth_m"))
    V.export_observations(obs, str(tmp_path / "whole"), ["file"])
    V.raise_if_failed(V.verify_export(spark, obs, str(tmp_path / "whole"), ["file"]), ["file"])
    V.export_observations(obs.where("file <> '1' AND depth_m < 25"), str(tmp_path / "short"), ["file"])
    with pytest.raises(V.ExportFailed, match="3 outputs failed: 0: 9 of 10 rows; 1: 0 of 10 rows; 2: 8 of 10 rows"):
        V.raise_if_failed(V.verify_export(spark, obs, str(tmp_path / "short"), ["file"]), ["file"])


def test_column_attributes_read_back(spark, tmp_path):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "file string, depth_m double, other double")
    V.export_observations(df, str(tmp_path / "x"), ["file"])
    got = {(r.column, r.attribute): r.value for r in V.column_attributes(spark, str(tmp_path / "x")).collect()}
    assert got == {
        ("depth_m", "long_name"): "Depth Below Sea Surface", ("depth_m", "standard_name"): "depth", ("depth_m", "units"): "m",
        ("depth_m", "valid_min"): "0.0", ("depth_m", "valid_max"): "11000.0", ("depth_m", "valid_range"): "[0.0, 11000.0]",
        ("depth_m", "axis"): "Z", ("depth_m", "positive"): "down", ("depth_m", "_FillValue"): "-999.0",
        ("other", "long_name"): "other", ("other", "_FillValue"): "-999.0"}


def test_transform_summary_counts_what_is_lost(spark, tmp_path):
    raw = spark.createDataFrame([(" a ", "2024-01-02", "91.5"), ('x, "y"\nz', "no date", "north"), ("nan", None, " ")],
                                "`Station Name` string, `Sample Date` string, lat string")
    summary = transform_to_csv(raw, str(tmp_path / "out"))
    got = {r.column: r.asDict() for r in summary.collect()}
    assert {c: (r["header"], r["renamed"], r["filled_in"], r["filled_out"], r["filled_back"], r["rejected"]) for c, r in got.items()} == {
        "Station Name": ("station_name", True, 2, 2, 2, 0), "Sample Date": ("sample_date", True, 2, 1, 1, 1), "lat": ("lat", False, 2, 1, 1, 1)}
    assert all((r["rows_in"], r["rows_out"], r["rows_back"], r["ok"]) == (3, 3, 3, True) for r in got.values())
    raise_if_lost(summary)
    with pytest.raises(RowsLost, match="lat: 3 in, 3 out, 2 read back"):
        raise_if_lost(summary.where("column = 'lat'").withColumns({"rows_back": F.lit(2), "ok": F.lit(False)}))


def test_transform_summary_of_no_rows(spark, tmp_path):
    raw = spark.createDataFrame([], "`A b` string, n int")
    got = transform_to_csv(raw, str(tmp_path / "out")).collect()
    assert [(r.header, r.rows_in, r.rows_out, r.rows_back, r.ok) for r in got] == [("a_b", 0, 0, 0, True), ("n", 0, 0, 0, True)]


def test_fingerprint_ignores_the_order_of_keys_alone(spark):
    def fp(sql):
        df = spark.sql(f"SELECT {sql} AS c")
        return df.select(PV.canonical_fingerprint(df, "c")).first()[0]

    one = fp("named_struct('b', map('y', 1, 'x', 2), 'a', array(named_struct('q', 1, 'p', cast(null as string))))")
    assert one == fp("named_struct('a', array(named_struct('p', cast(null as string), 'q', 1)), 'b', map('x', 2, 'y', 1))")
    assert one != fp("named_struct('a', array(named_struct('p', '', 'q', 1)), 'b', map('x', 2, 'y', 1))")
    assert fp("named_struct('a', array(1, 2))") != fp("named_struct('a', array(2, 1))")
    assert fp("cast(null as struct<a: int>)") is None and len(one) == 16
