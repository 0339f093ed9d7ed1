"""Layouts chosen by the shape of a text, and the order of day and month settled by a column's values."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tidepool.functions.temporal import AUTO_FORMATS, iso_utc, parse_timestamp, shape_of
from tidepool.operators.dates import order_votes, parse_by_vote


def test_shapes_follow_from_layouts():
    samples = {"M/d/yyyy H:mm": "7/18/2021 6:00", "dd-MMM-yyyy": "18-Jul-2021", "MM/dd/yy hh:mm a": "07/18/21 06:00 AM", "dd.MM.yyyy": "18.07.2021",
               "yyyyMMdd'T'HHmmss": "20210718T060000", "MMMM d, yyyy": "July 8, 2021"}
    for layout, text in samples.items():
        assert re.match(shape_of(layout), text), layout
    odd = ["199401", "1234", "", "abc", "2021", "7/18", "18072021123", "+199401-01-01"]
    assert not [(f, t) for f in AUTO_FORMATS for t in odd if re.match(shape_of(f), t)]


@pytest.mark.parametrize("text", ["199401", "1234", "2021", "06:00", "T06:00", "12345678901", "7/18", "", "n/a", "18-07-2021"])
def test_texts_that_are_no_dates(spark, text):
    df = spark.createDataFrame([(text,)], "x string")
    assert df.select(parse_timestamp(F.col("x"))).first()[0] is None


def test_every_layout_is_still_read(spark):
    want = dt.datetime(2021, 7, 18)
    texts = ["2021-07-18", "2021-7-18", "2021-07-18T00:00:00Z", "2021-07-18 02:00:00+02:00", "2021-07-18T00:00:00.000", "7/18/2021 0:00:00", "7/18/2021",
             "18-Jul-2021", "07/18/21 12:00 AM", "2021/07/18", "18.07.2021 00:00", "20210718T000000", "20210718", "Jul 18 2021", "Jul 18, 2021", "July 18, 2021"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    got = [r.y for r in df.select(iso_utc(parse_timestamp(F.col("x"))).alias("y")).collect()]
    assert got == [want.strftime("%Y-%m-%dT%H:%M:%SZ")] * len(texts)


def test_votes(spark):
    rows = [("eu", t) for t in ("1/2/2021", "25/12/2021", "13/1/2021 6:00", " 3/4/2021 ")] + [("us", t) for t in ("1/2/2021", "12/25/2021", "x")]
    rows += [("tie", t) for t in ("25/12/2021", "12/25/2021", "1/2/2021")] + [("none", None), (None, "25/12/2021"), ("odd", "99/99/2021"), ("odd", "1/13/21")]
    long = spark.createDataFrame(rows, "variable string, value string")
    votes = {r.variable: (r.slashed, r.day_votes, r.month_votes, r.day_first) for r in order_votes(long, ["variable"]).collect()}
    assert votes == {"eu": (4, 2, 0, True), "us": (2, 0, 1, False), "tie": (3, 1, 1, False), "none": (0, 0, 0, False), None: (1, 1, 0, True), "odd": (1, 0, 0, False)}
    read = lambda mixed: {(r.variable, r.value): r.t for r in parse_by_vote(long, ["variable"], mixed).select("variable", "value", iso_utc(F.col("ts")).alias("t")).collect()}
    got = read(False)
    assert got["eu", "1/2/2021"] == "2021-02-01T00:00:00Z" and got["us", "1/2/2021"] == "2021-01-02T00:00:00Z"
    assert got["eu", "13/1/2021 6:00"] == "2021-01-13T06:00:00Z" and got["tie", "25/12/2021"] is None and got[None, "25/12/2021"] == "2021-12-25T00:00:00Z"
    assert read(True)["tie", "25/12/2021"] == "2021-12-25T00:00:00Z" and len(got) == len(rows)
