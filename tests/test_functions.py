"""Scalar functions: literal tables from the reference's unit tests and the edge tables."""

import math

import pytest
from pyspark.sql import functions as F

from tidepool.functions.hashing import fixity_line, mime_of, role_of, sha256_hex
from tidepool.functions.headers import column_names, file_slug, match_names, normalize_header
from tidepool.functions.numeric import pct, to_number
from tidepool.functions.temporal import iso_utc, parse_timestamp, strptime_to_java
from tidepool.functions.text import clean_text, is_nonblank, present

HEADERS = [
    ("Station Name", "station_name"),
    ("Temperature (°C)", "temperature_c"),
    ("salinity-psu.avg", "salinity_psu_avg"),
    ("  Depth (m)  ", "depth_m"),
    ("lat___lon", "lat_lon"),
    ("", ""),
    ("Date/Time", "datetime"),
    ("Total Alkalinity (µmol/kg)", "total_alkalinity_molkg"),
    ("Station  ID", "station_id"),
    ("\tTab Sep", "tab_sep"),
]


def _col(spark, values, schema="x string"):
    return spark.createDataFrame([(v,) for v in values], schema)


def test_normalize_header_and_match(spark):
    df = _col(spark, [h for h, _ in HEADERS]).select(normalize_header(F.col("x")).alias("y"))
    assert [r.y for r in df.collect()] == [e for _, e in HEADERS]
    names = column_names(spark, [h for h, _ in HEADERS]).orderBy("ordinal").collect()
    assert [r.norm_name for r in names] == [e for _, e in HEADERS]
    got = match_names(spark, ["Depth (m)", "depth m", "pH"], ["depth_m", "PH", "x"]).orderBy("target_no").collect()
    assert [(r.target, r.raw_name) for r in got] == [("depth_m", "Depth (m)"), ("PH", "pH")]


def test_file_slug_replaces_symbols(spark):
    df = _col(spark, ["Station Data (v2)", "CTD-cast.01", "__x__"]).select(file_slug(F.col("x")).alias("y"))
    assert [r.y for r in df.collect()] == ["station_data_v2", "ctd_cast_01", "x"]


def test_sha256_literals(spark):
    df = spark.createDataFrame([(bytearray(b"Hello, tide pool!\n"),), (bytearray(b""),)], "b binary")
    got = [r.h for r in df.select(sha256_hex(F.col("b")).alias("h")).collect()]
    assert got == ["65d782e30ad076e1a2569911e1d9690383612fcdb982c7951d5cb9f2eb99929a",
                   "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"]


def test_roles_mime_and_lines(spark):
    paths = ["raw/a.csv", "processed/b.json", "metadata/x.xml", "docs/r.md", "logs/p.jsonl", "c.bin"]
    df = _col(spark, paths).select(role_of(F.col("x")).alias("r"), mime_of(F.col("x")).alias("m"),
                                   fixity_line(F.col("x"), F.lit("ab")).alias("l"))
    rows = df.collect()
    assert [r.r for r in rows] == ["raw_data", "processed_data", "metadata", "documentation", "provenance", "other"]
    assert rows[0].m == "text/csv" and rows[5].m == "application/octet-stream"
    assert rows[0].l == "SHA256 (raw/a.csv) = ab"


ACCEPTED = [(" 1.5 ", 1.5), ("1e3", 1000.0), ("inf", math.inf), ("+5", 5.0), (".5", 0.5), ("-2", -2.0)]
REJECTED = ["28,5", "1_000", "0x10", "", "true", "nan", "1.0d", "NaN", "abc", None]


def test_to_number_edge_table(spark):
    df = _col(spark, [v for v, _ in ACCEPTED] + REJECTED).select(to_number(F.col("x")).alias("y"))
    got = [r.y for r in df.collect()]
    assert got[: len(ACCEPTED)] == [e for _, e in ACCEPTED]
    assert got[len(ACCEPTED):] == [None] * len(REJECTED)


def test_to_number_typed_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "x double")
    from pyspark.sql import types as T
    assert [r.y for r in df.select(to_number(F.col("x"), T.DoubleType()).alias("y")).collect()] == [1.0, None, None]


def test_pct_zero_safe(spark):
    df = spark.createDataFrame([(1, 3), (0, 0)], "a long, b long")
    assert [r.p for r in df.select(pct(F.col("a"), F.col("b")).alias("p")).collect()] == [33.33, 0.0]


def test_clean_text_and_blank(spark):
    df = _col(spark, ["\t hi \n", "nan", None, "  ", " nan "]).select(clean_text(F.col("x")).alias("c"),
                                                                    is_nonblank(F.col("x")).alias("b"))
    rows = df.collect()
    assert [r.c for r in rows] == ["hi", "", "", "", ""]
    assert [r.b for r in rows] == [True, True, False, False, True]


@pytest.mark.parametrize("text,iso", [
    ("2021-07-18 06:00:00", "2021-07-18T06:00:00Z"),
    ("07/18/2021 06:00", "2021-07-18T06:00:00Z"),
    ("18-Jul-2021 06:00", "2021-07-18T06:00:00Z"),
    ("07/18/21 06:00 PM", "2021-07-18T18:00:00Z"),
    ("01/02/95 12:00 AM", "1995-01-02T00:00:00Z"),
    ("2021-07-18T06:00:00+05:00", "2021-07-18T01:00:00Z"),
    ("not a date", None),
])
def test_parse_timestamp_auto(spark, text, iso):
    got = _col(spark, [text]).select(iso_utc(parse_timestamp(F.col("x"))).alias("y")).first().y
    assert got == iso


def test_strptime_translation(spark):
    assert strptime_to_java("%Y-%m-%dT%H:%M:%S") == "yyyy-MM-dd'T'HH:mm:ss"
    assert strptime_to_java("%m/%d/%y %I:%M %p") == "MM/dd/yy hh:mm a"
    got = _col(spark, ["07/18/2021 06:30"]).select(
        iso_utc(parse_timestamp(F.col("x"), "%m/%d/%Y %H:%M")).alias("y")).first().y
    assert got == "2021-07-18T06:30:00Z"


def test_config_fingerprint_matches_hashlib(spark):
    import hashlib

    from tidepool.sources.provenance import config_fingerprint

    df = spark.createDataFrame([("ds", 2, ["a", "b"])], "name string, version int, steps array<string>")
    r = df.select(F.to_json(F.struct("*")).alias("j"), config_fingerprint(F.struct("*")).alias("f")).first()
    assert r.f == hashlib.sha256(r.j.encode()).hexdigest()[:16] and len(r.f) == 16


def test_mime_of_compressed_and_unknown(spark):
    got = _col(spark, ["a.gz", "a.tar.gz", "a.csv.gz", "a.yaml", "a.parquet"]).select(mime_of(F.col("x")).alias("m")).collect()
    other = "application/octet-stream"
    assert [r.m for r in got] == [other, "application/x-tar", "text/csv", other, other]


def test_timestamp_layouts_users_write(spark):
    texts = ["7/8/2021", "7/18/2021 6:00", "20210718", "Jul 18 2021", "06:00", "\t2021-07-18 "]
    got = _col(spark, texts).select(iso_utc(parse_timestamp(F.col("x"))).alias("t")).collect()
    day = "2021-07-18T00:00:00Z"
    assert [r.t for r in got] == ["2021-07-08T00:00:00Z", "2021-07-18T06:00:00Z", day, day, None, day]


def test_tabs_are_white_space(spark):
    df = spark.createDataFrame([("\t1.5\n",), ("\t",)], "x string")
    assert [tuple(r) for r in df.select(to_number(F.col("x")), present(F.col("x"))).collect()] == [(1.5, "1.5"), (None, None)]
