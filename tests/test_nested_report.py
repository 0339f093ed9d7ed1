"""Verdicts per file and the nested report against plain loops over the checks."""

from pyspark.sql import functions as F

from tidepool.operators import checks as C

ROWS = [("a", "f1", "range_x", True, "ok"), ("a", "f1", "file_exists", True, "Found"), ("a", "f1", "parseable", False, "bad"), ("a", "f2", "file_exists", False, None),
        ("b", "f1", "no_duplicates", True, "No duplicates"), ("b", "f1", "encoding", True, "utf-8"), (None, "g", "encoding", False, "x")]
SCHEMA = "dataset string, file string, check string, passed boolean, detail string"


def test_verdict_of_each_file(spark):
    got = {(r.dataset, r.file): r for r in C.file_verdicts(spark.createDataFrame(ROWS, SCHEMA), ["dataset"]).collect()}
    assert {k: r.passed for k, r in got.items()} == {("a", "f1"): False, ("a", "f2"): False, ("b", "f1"): True, (None, "g"): False}
    assert [c.check for c in got["a", "f1"].checks] == ["file_exists", "parseable", "range_x"]
    assert [c.check for c in got["b", "f1"].checks] == ["encoding", "no_duplicates"]


def test_report_nests_and_flattens(spark):
    nested = C.nested_report(spark.createDataFrame(ROWS, SCHEMA).repartition(4), ["dataset"])
    got = {r.dataset: r for r in nested.collect()}
    assert (got["a"].summary, got["a"].all_passed) == ("2/4 checks passed across 2 files", False)
    assert (got["b"].summary, got["b"].all_passed) == ("2/2 checks passed across 1 files", True)
    assert [f.file for f in got["a"].files] == ["f1", "f2"]
    flat = {tuple(r) for r in C.flat_report(nested, ["dataset"]).select("dataset", "file", "check", "passed", "detail").collect()}
    assert flat == set(ROWS)
    assert C.nested_report(spark.createDataFrame([], SCHEMA), ["dataset"]).count() == 0


def test_a_dataset_of_many_files_has_rows_of_bounded_length(spark):
    checks = spark.range(3000).select(F.lit("d").alias("dataset"), F.concat(F.lit("f"), "id").alias("file"), F.lit("encoding").alias("check"),
                                      (F.col("id") != 7).alias("passed"), F.lit("x").alias("detail"))
    rows = C.nested_report(checks, ["dataset"], files_a_row=100).collect()
    assert len(rows) == 30 and max(len(r.files) for r in rows) < 160 and sum(len(r.files) for r in rows) == 3000
    assert all(r.summary == "2999/3000 checks passed across 3000 files" and not r.all_passed for r in rows)


def test_checks_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def passed(x):
        made.add(1)
        return x

    checks = spark.createDataFrame(ROWS, SCHEMA).withColumn("passed", passed.asNondeterministic()("passed"))
    assert C.nested_report(checks, ["dataset"]).count() == 3  # files and totals both read it
    assert made.value == len(ROWS)
