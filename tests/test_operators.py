"""Table operators on small literal fixtures (station-style rows, XML texts, packages)."""

import os
import uuid

from pyspark.sql import functions as F

from tidepool.operators import audit as A
from tidepool.operators import checks as C
from tidepool.operators import duplicates as D
from tidepool.operators import fixity as X
from tidepool.operators import profile as P
from tidepool.operators import records as R
from tidepool.operators.transform import transform
from tidepool.session import checkpoint_dir

STATION = [
    ("GOM-001", "27.5", "-94.1", "5", "24.1", "35.6", "07/18/2021 06:00"),
    ("GOM-001", "27.5", "-94.1", "20", "23.0", "35.7", "07/18/2021 06:00"),
    ("GOM-002", "28.1", "-93.0", "5", "25.2", "35.1", "07/18/2021 12:00"),
    ("GOM-003", "26.9", "-95.5", "5", "26.0", "34.9", "07/19/2021 06:00"),
    ("GOM-004", "29.0", "-91.5", "5", "22.4", "36.1", "07/19/2021 18:00"),
]
HEADER = ["Station", "Latitude", "Longitude", "Depth (m)", "Temperature (°C)", "Salinity (PSU)", "Date/Time"]


def _station(spark):
    return spark.createDataFrame(STATION, ", ".join(f"`{h}` string" for h in HEADER)).withColumn("file", F.lit("s.csv"))


def test_required_and_ranges(spark):
    df = _station(spark)
    cat = spark.createDataFrame([("s.csv", i, h) for i, h in enumerate(HEADER)], "file string, ordinal int, raw_name string")
    rules = spark.createDataFrame([("station",), ("latitude",), ("depth",), ("date_time",)], "column string")
    req = {r.check: r.passed for r in C.required_columns(cat, rules, ["file"]).collect()}
    assert req == {"required_column_station": True, "required_column_latitude": True,
                   "required_column_depth": False, "required_column_date_time": False}
    long = P.to_long(df, [h for h in HEADER if h != "Station"], ["file"], kind="text")
    rr = spark.createDataFrame([("latitude", -90.0, 90.0), ("longitude", -180.0, -92.0), ("depth", 0.0, 10.0)],
                               "column string, lo double, hi double")
    cols = [h for h in HEADER if h != "Station"]
    got = {r.check: (r.passed, r.out_of_range, r.detail) for r in C.value_ranges(long, rr, ["file"], cols).collect()}
    assert got == {"range_latitude": (True, 0, "All values in [-90.0, 90.0]"),
                   "range_longitude": (False, 1, "1 values outside [-180.0, -92.0]")}


def test_rules_meet_values_without_a_shuffle_by_variable(spark):
    long = spark.range(10).select((F.col("id") % 2).cast("string").alias("file"), F.element_at(F.array(F.lit("x"), F.lit("y")), F.when(F.col("id") < 8, 1).otherwise(2)).alias("variable"), F.col("id").cast("double").alias("value"))
    rr = spark.createDataFrame([("X", 0.0, 5.0), ("x", 0.0, 9.0)], "column string, lo double, hi double")
    out = C.value_ranges(long, rr, ["file"], ["x"])
    assert {(r.file, r.check, r.out_of_range) for r in out.collect()} == {
        ("0", "range_X", 1), ("0", "range_x", 0), ("1", "range_X", 1), ("1", "range_x", 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(variable" not in plan
    cat = spark.createDataFrame([("f", 0, "X"), ("g", 1, "y")], "file string, ordinal int, raw_name string")
    req = C.required_columns(cat, rr.select("column").limit(1), ["file"])
    assert {(r.file, r.passed) for r in req.collect()} == {("f", True), ("g", False)}
    assert "hashpartitioning(_norm" not in req._jdf.queryExecution().executedPlan().toString()


def test_duplicates_partial_keys_and_report(spark):
    df = _station(spark)
    keys = D.matched_keys(spark, df.columns, ["station", "Cast", "depth_m"])
    assert keys == ["Station", "Depth (m)"]
    m = D.duplicate_members(df, ["file"], keys).first()
    assert (m.rows, m.duplicate_members) == (5, 0)
    m1 = D.duplicate_members(df, ["file"], ["Station"]).first()
    assert m1.duplicate_members == 2
    chk = C.no_duplicates(D.duplicate_members(df, ["file"], ["Station"]), ["file"], ["Station"], tolerance=2).first()
    assert chk.passed and chk.detail.endswith("duplicate rows on key [Station]")  # the count shows, tolerated or not
    extras = D.duplicate_extras(df.unionByName(df.limit(1)), ["file"]).first()
    assert extras.duplicate_rows == 1
    rep = C.report(spark.createDataFrame([("d", "a", True), ("d", "b", False), ("d", "b", True)],
                                         "dataset string, file string, passed boolean"), ["dataset"]).first()
    assert rep.summary == "2/3 checks passed across 2 files" and rep.all_passed is False


def test_file_profile_grade_zero_rows_and_positions(spark):
    df = _station(spark)
    f = P.file_profile(df.drop("file").withColumn("dataset", F.lit("s")), ["dataset"])
    outl = spark.createDataFrame([("s", 0)], "dataset string, outliers long")
    g = P.grade_files(f, outl, ["dataset"]).first()
    assert (g.rows, g.columns, g.total_cells, g.completeness_pct, g.duplicate_rows, g.grade) == (5, 7, 35, 100.0, 0, "A")
    empty = P.file_profile(df.limit(0).drop("file").withColumn("dataset", F.lit("z")), ["dataset"])
    assert empty.count() == 0  # no rows, no group ...
    cat = spark.createDataFrame([("z",)], "dataset string")
    z = P.file_profile(df.where("false").drop("file").withColumn("dataset", F.lit("z")), ["dataset"], catalogue=cat)
    gz = P.grade_files(z, spark.createDataFrame([], "dataset string, outliers long"), ["dataset"]).first()
    assert (gz.rows, gz.completeness_pct, gz.grade) == (0, None, "D")  # ... unless catalogued: grade D
    pos = spark.createDataFrame([("1", "2"), ("1", None), (None, None), (None, None)], "la string, lo string")
    sc = P.spatial_coverage(F.col("la"), F.col("lo"), pos.withColumn("k", F.lit(1)), ["k"]).first()
    assert sc.unique_positions == 3 and sc.south_lat == 1.0


def test_xml_validation(spark):
    docs = spark.createDataFrame([
        (1, "<MD_Metadata><fileIdentifier>a</fileIdentifier><contact>c</contact><dateStamp>d</dateStamp>"
            "<identificationInfo>i</identificationInfo></MD_Metadata>"),
        (2, "<MD_Metadata><fileIdentifier>a</fileIdentifier>"),
        (3, "<gmd:MD_Metadata xmlns:gmd='u'><gmd:fileIdentifier>a</gmd:fileIdentifier><gmd:contact/>"
            "<gmd:dateStamp/><gmd:identificationInfo/></gmd:MD_Metadata>"),
        (4, "<MD_Metadata><fileIdentifier>a</fileIdentifier></MD_Metadata>"),
    ], "id int, xml string")
    got = {r.id: (r.well_formed, r.valid, r.errors) for r in R.validate_xml(docs, "id", "xml").collect()}
    assert got[1] == (True, True, "") and got[2] == (False, False, "not well-formed XML")
    assert got[3] == (True, True, "") and got[4] == (True, False, "contact; dateStamp; identificationInfo")


def test_complete_package_scores_15(spark):
    rows = spark.createDataFrame([("ds1", "Title", "Abstract", "10.1/x", ["ocean"], "CC-BY-4.0", ["step"])],
                                 "dataset_id string, title string, abstract string, doi string, "
                                 "theme_keywords array<string>, license_name string, steps array<string>")
    rec = R.assemble(rows).select("dataset_id", R.to_xml_text(F.col("record")).alias("xml_text"))
    sub = rec.select("dataset_id", "xml_text", F.lit("10.1/x").alias("doi"), F.lit("CC-BY-4.0").alias("license_name"),
                     F.octet_length("xml_text").alias("xml_bytes"),
                     F.array(*[F.lit(d) for d in ("raw", "processed", "metadata", "docs", "logs")]).alias("dirs"),
                     F.array(F.lit(".csv")).alias("processed_exts"), F.lit(10).alias("provenance_bytes"))
    res = A.rule_results(sub, "dataset_id")
    s = A.score(res, ["dataset_id"]).first()
    assert (s.passed, s.total, s.failed_rules) == (15, 15, "")
    pending = sub.withColumn("doi", F.lit("PENDING")).withColumn("xml_text", F.lit(None).cast("string"))
    failed = A.score(A.rule_results(pending, "dataset_id"), ["dataset_id"]).first().failed_rules.split(",")
    assert "F1" in failed and "F2" in failed and "A1.1" not in failed


def test_fixity_verify_statuses(spark):
    m = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string")
    c = spark.createDataFrame([("a", "1"), ("b", "9"), ("d", "4")], "path string, sha256 string")
    got = {r.path: r.status for r in X.verify(m, c).collect()}
    assert got == {"a": "ok", "b": "changed", "c": "missing", "d": "extra"}


def test_inventory_and_fixity_file(spark, smoke_dir):
    inv = X.inventory(spark, smoke_dir, prefix="raw/")
    rows = {r.path: r for r in inv.collect()}
    assert "raw/region.parquet" in rows and rows["raw/region.parquet"].role == "raw_data"
    assert rows["raw/region.parquet"].size_bytes == os.path.getsize(f"{smoke_dir}/region.parquet")
    out = f"{checkpoint_dir(spark)}/fixity-{uuid.uuid4().hex}"
    X.write_fixity(inv, out)
    lines = [r.value for r in spark.read.text(out).collect()]
    assert lines == sorted(lines) and lines[0].startswith("SHA256 (raw/")


def test_transform_order_and_types(spark):
    df = _station(spark).drop("file")
    cleaned, mapping = transform(df)
    assert mapping["Date/Time"] == "datetime" and mapping["Temperature (°C)"] == "temperature_c"
    r = cleaned.first()
    assert r.datetime == "2021-07-18T06:00:00Z" and r.latitude == 27.5 and r.station == "GOM-001"


def test_manifest_snapshots_keep_keys(spark):
    base = f"{checkpoint_dir(spark)}/manifest-{uuid.uuid4().hex}"
    files = spark.createDataFrame([("raw/a.csv", "x", 10), ("docs/b.md", "y", 5)], "path string, sha256 string, size_bytes long")
    info = spark.createDataFrame([("dataset", "ds1"), ("version", "1")], "key string, value string")
    X.write_manifest(spark, base, X.manifest_rows(files), info)
    X.write_manifest(spark, base, X.manifest_rows(files.limit(1)),
                     spark.createDataFrame([("version", "2")], "key string, value string"))
    kv = {r.key: r.value for r in spark.read.parquet(f"{base}/info").where("v = 2").collect()}
    assert kv == {"dataset": "ds1", "version": "2", "total_files": "1", "total_bytes": "10"}


def test_maps_and_grade_summary(spark):
    top = spark.createDataFrame([("v", "a", 3), ("v", "b", 1)], "variable string, value string, n long")
    m = P.top_values_map(top, ["variable"]).first().top_values
    assert m == {"a": 3, "b": 1}
    hm = spark.range(1).select(P.header_map(["Date/Time"], ["datetime"]).alias("m")).first().m
    assert hm == {"Date/Time": "datetime"}
    g = spark.createDataFrame([("d", "b.csv", "B"), ("d", "a.csv", "A")], "ds string, file string, grade string")
    r = P.grade_summary(g, ["ds"], "file").first()
    assert r.grades == "a.csv: A | b.csv: B" and r.files == 2


def test_dataset_attributes_defaults(spark):
    from tidepool.operators.vocabulary import dataset_attributes

    rows = spark.createDataFrame([("d1", None, ["ocean"]), ("d2", "T", None)],
                                 "dataset_id string, title string, theme_keywords array<string>")
    got = {r.dataset_id: r for r in dataset_attributes(rows).collect()}
    assert got["d1"].title == "Untitled Dataset" and got["d1"].keywords == "ocean"
    assert got["d2"].keywords is None and got["d2"].keywords_vocabulary is None and got["d2"].license == "CC-BY-4.0"


def test_json_report_sink(spark):
    from tidepool.sources.text_tables import write_json_report

    out = f"{checkpoint_dir(spark)}/report-{uuid.uuid4().hex}"
    df = spark.createDataFrame([("f", [("c", True)])], "file string, checks array<struct<check:string,passed:boolean>>")
    write_json_report(df, out)
    back = spark.read.json(out).first()
    assert back.file == "f" and back.checks[0].check == "c"


def test_validate_files_short_circuits(spark):
    presence = spark.createDataFrame([("a", True), ("b", True), ("c", False), ("d", True)], "file string, file_exists boolean")
    enc = spark.createDataFrame([("a", True, "utf-8"), ("b", True, "utf-8"), ("d", False, "not utf-8")], "file string, passed boolean, detail string")
    parse = spark.createDataFrame([("a", True, 5, 3), ("b", False, 0, 3), ("d", True, 1, 3)],
                                  "file string, parseable boolean, rows long, columns int")
    later = spark.createDataFrame([("a", "no_empty_rows", True, "No empty rows"), ("b", "no_empty_rows", True, "x")],
                                  "file string, check string, passed boolean, detail string")
    rows = C.validate_files(presence, enc, parse, [later]).collect()
    by = {}
    for r in rows:
        by.setdefault(r.file, []).append((r.seq, r.check, r.passed))
    assert sorted(by["c"]) == [(0, "file_exists", False)]
    assert sorted(by["b"]) == [(0, "file_exists", True), (1, "encoding", True), (3, "parseable", False)]
    assert sorted(by["d"]) == [(0, "file_exists", True), (1, "encoding", False), (2, "utf8_readable", False)]
    assert (4, "no_empty_rows", True) in by["a"] and len(by["a"]) == 4


def test_transform_options(spark):
    from tidepool.operators.transform import TransformConfig

    df = spark.createDataFrame([(" a ", "18/07/2021 06:00", 1700000000, None), ("b", "bad", 5, 2.5)],
                               "`Site Name` string, `Sample Date` string, `epoch time` long, `Lat` double")
    cfg = TransformConfig(timestamp_format="%d/%m/%Y %H:%M", na_representation="NA")
    out, mapping = transform(df, cfg)
    rows = out.collect()
    assert list(mapping.values()) == ["site_name", "sample_date", "epoch_time", "lat"]
    assert rows[0].sample_date == "2021-07-18T06:00:00Z" and rows[1].sample_date == "NA"
    assert rows[0].epoch_time == "1700000000"  # numbers named like times stay numbers (rendered at the sink)
    assert rows[0].lat == "NA" and rows[1].lat == "2.5" and rows[0].site_name == "a"


def test_inventory_paths_below_a_root_with_its_name(spark, tmp_path):
    from tidepool.operators.fixity import inventory

    root = tmp_path / "raw" / "x" / "raw"
    (root / "raw" / "d").mkdir(parents=True)
    (root / "raw" / "d" / "f.csv").write_text("a")
    for at in (str(root), f"file://{root}/"):
        assert [r.path for r in inventory(spark, at, "raw/").collect()] == ["raw/raw/d/f.csv"]


def test_export_describes_numeric_columns_only(spark, tmp_path):
    from tidepool.operators.vocabulary import export_observations

    df = spark.createDataFrame([("n", 1.5, 2)], "latitude_note string, latitude double, other int")
    plan = export_observations(df, str(tmp_path / "out"))
    meta = {f.name: f.metadata for f in spark.read.parquet(str(tmp_path / "out")).schema.fields}
    assert plan["latitude"] == "latitude" and not plan["latitude_note"]
    assert meta["latitude_note"] == {"long_name": "latitude_note"} and meta["other"]["long_name"] == "other"
    assert meta["latitude"]["valid_range"] == [-90.0, 90.0]


def test_classes_decide_what_is_profiled(spark):
    df = spark.createDataFrame(
        [(1, "1.5", "2021-07-18", "2021-07-18", True, None), (2, "x", "7/19/2021", "b", False, None), (3, "2", "n/a", "c", True, None),
         (4, "900", "2021-07-20", "d", None, None)],
        "key int, reading string, date string, note string, update_time_flag boolean, empty string")
    long = P.typed_long(df.withColumn("dataset", F.lit("d")), ["dataset"])
    got = {r.variable: r["class"] for r in P.classify(long, ["dataset"]).collect()}
    assert got == {"key": "numeric", "reading": "numeric", "date": "temporal", "note": "categorical",
                   "update_time_flag": "categorical", "empty": "numeric"}
    r = P.profile_files({"d": df}).first()
    assert (r.rows, r.numeric, r.temporal, r.categorical, r.grade) == (4, 3, 1, 2, "D")
