"""Many datasets in one plan: figures, classes and grades against the one-dataset operators; keys as data."""

import re

import pytest
from pyspark.sql import functions as F

from tidepool.operators import catalogue as K
from tidepool.operators import duplicates as D
from tidepool.operators import profile as P

MAPS = "dataset string, cells map<string,string>"


def rows_of(spark, n):
    data = []
    for d in range(n):
        for k in range(12):
            cells = {f"reading {d % 7}": str(k * k % 11) if k != 5 else "n/a", "id": str(k // 2), ("date" if d % 2 else "note"): f"2021-07-{k + 1:02d}"}
            if d % 3 == 0 and k == 3:
                cells["id"] = None
            data.append((f"d{d}", cells))
        data.append((f"d{d}", {"id": "900", f"reading {d % 7}": "5000"}))
        data.append((f"d{d}", {"id": "900", f"reading {d % 7}": "5000", "note" if d % 2 == 0 else "date": None}))
    return spark.createDataFrame(data, MAPS)


def test_catalogue_equals_one_dataset_at_a_time(spark):
    rows = rows_of(spark, 6).cache()
    got = {r.dataset: r for r in K.profile_catalogue(rows).collect()}
    for d in range(6):
        cols = ["id", f"reading {d % 7}", "date" if d % 2 else "note"]
        df = rows.where(F.col("dataset") == f"d{d}").select(*(F.element_at("cells", c).alias(c) for c in cols))
        want = P.profile_files({f"d{d}": df}).first().asDict()
        have = got[f"d{d}"].asDict()
        assert {k: have[k] for k in want} == want
        assert have["duplicate_rows"] == 1 and have["temporal"] == d % 2 and have["total_outliers"] >= 2


def nodes(df):
    plan = df._jdf.queryExecution().sparkPlan().toString()
    return len(re.findall(r"(?m)^[\s:+-]*\*?\(?\d*\)?\s*\w+", plan))


def test_plan_does_not_grow_with_datasets(spark):
    few, many = (K.profile_catalogue(rows_of(spark, n)) for n in (2, 200))
    assert many.count() == 200 and few.count() == 2
    assert nodes(few) == nodes(many)


def test_odd_catalogues(spark):
    data = [("a", {"x": "1"}), ("a", {}), ("a", None), (None, {"x": None}), ("", {"x": "2"}), ("b", {"T e": "q", "t": None})]
    known = spark.createDataFrame([("empty", "c1"), ("empty", "c2"), ("a", "y")], "dataset string, variable string")
    got = {r.dataset: r for r in K.profile_catalogue(spark.createDataFrame(data, MAPS), known).collect()}
    assert set(got) == {"a", "", "b", "empty"}
    assert (got["a"].rows, got["a"].columns, got["a"].total_missing, got["a"].completeness_pct) == (3, 2, 5, 16.67)
    assert (got[""].rows, got[""].total_missing) == (2, 1)
    assert (got["empty"].rows, got["empty"].completeness_pct, got["empty"].grade) == (0, None, "D")
    none = K.profile_catalogue(spark.createDataFrame([], MAPS))
    assert none.count() == 0


def test_keys_as_data(spark):
    data = [("a", {"Station ID": str(k % 4), "v": "1"}) for k in range(6)] + [("b", {"id": str(k // 2), "Date/Time": "t"}) for k in range(6)]
    data += [("c", {"id": None}), ("c", {}), ("c", {"id": "1"}), ("d", {"id": "1"}), ("d", {"id": "1"})]
    rows = spark.createDataFrame(data, MAPS)
    rules = spark.createDataFrame([("a", ["STATION_ID", "missing"], 3), ("b", ["datetime", "id"], 6), ("c", ["id"], 1), ("d", ["other"], 0), ("none", ["id"], 0)],
                                  "dataset string, keys array<string>, tolerance bigint")
    got = {r.dataset: r for r in K.duplicates_by_rule(rows, rules).collect()}
    assert set(got) == {"a", "b", "c"}  # d has none of its keys
    assert (got["a"].passed, got["a"].detail, got["a"].duplicate_members) == (False, "4 duplicate rows on key [Station ID]", 4)
    assert (got["b"].passed, got["b"].matched_keys, got["b"].duplicate_members) == (True, "Date/Time, id", 6)
    assert (got["c"].passed, got["c"].duplicate_members, got["c"].rows) == (False, 2, 3)  # nulls and absent cells compare equal
    one = D.duplicate_members(rows.where("dataset = 'a'").select("dataset", F.element_at("cells", "Station ID").alias("s")), ["dataset"], ["s"]).first()
    assert one.duplicate_members == got["a"].duplicate_members


@pytest.mark.parametrize("n", [1, 5])
def test_as_cells(spark, n):
    df = spark.range(n).select("id", (F.col("id") / 2).alias("a`b".replace("`", "")))
    got = K.as_cells(df, F.lit("x")).collect()
    assert [r.cells["id"] for r in got] == [str(k) for k in range(n)] and got[0].cells["ab"] == "0.0"
