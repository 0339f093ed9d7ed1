"""Text scan with ragged rows, CSV sink round trip, provenance log, streaming cleaner."""

import os
import uuid

from pyspark.sql import functions as F

from tidepool.operators.transform import transform
from tidepool.session import checkpoint_dir
from tidepool.sources import provenance as PV
from tidepool.sources import text_tables as TT
from tidepool.streaming.cleaning import read_text_stream, start_cleaning


def _dir(spark, name):
    return f"{checkpoint_dir(spark).replace('file:', '')}/{name}-{uuid.uuid4().hex}"


def test_ragged_csv(spark):
    path = _dir(spark, "csv")
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("a,b,c\n1,2,3\n4,5\n6,7,8,9\n\n,,\nNA,x,nan\n")
    df = TT.read_text_table(spark, path, ["a", "b", "c"])
    rep = TT.parse_report(df, ["a", "b", "c"]).first()
    assert (rep.rows, rep.short_rows, rep.long_rows, rep.empty_rows) == (5, 1, 1, 1)
    assert not rep.parseable and not rep.equal_field_counts
    na = df.where(F.col("b") == "x").first()
    assert na.a is None and na.c is None


def test_header_by_name_quotes_and_line_breaks(spark):
    path = _dir(spark, "named")
    os.makedirs(path)
    for name, text in (("a", "a,b,c\n1,2,3\n"), ("b", "c,b,a\n30,20,10\n"), ("c", '"b","a"\n"x,y,z",1\n"only, one"\n1,2,3\n')):
        with open(f"{path}/{name}.csv", "w") as f:
            f.write(text)
    df = TT.read_text_table(spark, path)
    rows = {(r.a, r.b, r.c, r._fields) for r in df.collect()}
    assert rows == {("1", "2", "3", 3), ("10", "20", "30", 3), ("1", "x,y,z", None, 2), (None, "only, one", None, 1), ("2", "1", None, 3)}
    rep = {r.file[-5]: (r.rows, r.short_rows, r.long_rows) for r in TT.parse_report(df, ["a", "b", "c"]).collect()}
    assert rep == {"a": (1, 0, 0), "b": (1, 0, 0), "c": (3, 1, 1)}
    with open(f"{path}/m.csv", "w") as f:
        f.write('a,b,c\n"l1\nl2",2,"say ""hi"""\n')
    many = TT.read_text_table(spark, f"{path}/m.csv", ["a", "b", "c"], multi_line=True).first()
    assert (many.a, many.b, many.c, many._fields, many._expected) == ("l1\nl2", "2", 'say "hi"', 3, 3)


def test_doubled_quotes_stay_in_their_column(spark):
    path = _dir(spark, "quotes")
    os.makedirs(path)
    with open(f"{path}/q.csv", "w") as f:
        f.write('doc_id,lang,line\n1,en,"he said ""x"", and, y"\n2,de,"a\\"\n3,fr,"""all"""\n')
    want = {("1", "en", 'he said "x", and, y'), ("2", "de", "a\\"), ("3", "fr", '"all"')}
    for multi in (False, True):
        rows = TT.read_text_table(spark, path, ["doc_id", "lang", "line"], multi_line=multi).collect()
        assert {(r.doc_id, r.lang, r.line) for r in rows} == want and all(r._fields == 3 and r._corrupt_record is None for r in rows)


def test_records_over_many_splits(spark):
    """Quoted line breaks, doubled quotes and empty lines within quotes; splits of a few hundred bytes."""
    import csv
    import random

    rng = random.Random(7)
    path = _dir(spark, "splits")
    os.makedirs(path)
    want = set()
    for k in range(3):
        with open(f"{path}/{k}.csv", "w", newline="") as f:
            w = csv.writer(f, lineterminator="\r\n" if k == 1 else "\n")
            names = ["id", "text", "n"] if k else ["text", "n", "id"]
            w.writerow(names)
            for i in range(400):
                text = "".join(rng.choice(['"', "\n", ",", "a", "b ", "\n\n", '""', "é"]) for _ in range(rng.randrange(1, 30)))
                row = {"id": f"{k}-{i}", "text": text, "n": str(len(text))}
                w.writerow([row[c] for c in names])
                want.add((row["id"], text, row["n"]))
    old = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        TT.STRETCH_BITS, bits = 3, TT.STRETCH_BITS
        df = TT.read_text_table(spark, path, ["id", "text", "n"], na_tokens=None, multi_line=True)
        assert spark.read.text(path).rdd.getNumPartitions() > 20
        rows = df.collect()
    finally:
        TT.STRETCH_BITS = bits
        for c, v in old.items():
            spark.conf.set(c, v)
    assert len(rows) == 1200 and {(r.id, r.text, r.n) for r in rows} == want
    assert all(r._fields == 3 and r._corrupt_record is None for r in rows)


def test_a_quote_that_is_never_closed(spark):
    path = _dir(spark, "open")
    os.makedirs(path)
    with open(f"{path}/o.csv", "w") as f:
        f.write("a,b\n1,2\n" + '3,"x\n' + "4,5\n" * 50)
    got = TT.read_records(spark, path, max_lines=10).collect()
    assert len(got) == 53 and sum(not r.closed for r in got) == 51
    table = TT.read_text_table(spark, path, ["a", "b"], multi_line=True)  # 51 lines are one record below the default bound
    rep = TT.parse_report(table, ["a", "b"]).first()
    assert (rep.rows, rep.long_rows, rep.parseable) == (2, 1, False)


def test_csv_sink_quotes_like_its_reader(spark):
    import csv

    out = _dir(spark, "sink-text")
    rows = [("1", 'he said "x"'), ("2", "a,b"), ("3", "back\\slash"), ("4", " both ends "), ("5", "l1\nl2"), ("6", 'end\\"')]
    TT.write_csv(spark.createDataFrame(rows, "k string, v string").coalesce(1), out)
    part = [p for p in os.listdir(out) if p.endswith(".csv")][0]
    with open(f"{out}/{part}", newline="") as f:
        assert [tuple(r) for r in csv.reader(f)] == [("k", "v"), *rows]


def test_csv_sink_crlf_and_na(spark):
    out = _dir(spark, "sink")
    df = spark.createDataFrame([("x", None), ("y", 2)], "k string, v int")
    TT.write_csv(df.coalesce(1), out, line_ending="windows", na="NA")
    part = [p for p in os.listdir(out) if p.endswith(".csv")][0]
    text = open(f"{out}/{part}", "rb").read()
    assert text == b"k,v\r\nx,NA\r\ny,2\r\n"


def test_header_lines_are_found_without_sorting_the_files(spark):
    out = _dir(spark, "heads")
    TT.write_csv(spark.range(100, numPartitions=3).selectExpr("id AS k", "2 * id AS v"), out)
    heads = TT.header_lines(spark, out)
    assert [r.names for r in heads.collect()] == [["k", "v"]] * 3
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


def test_provenance_append_and_compact(spark):
    path = _dir(spark, "prov")
    e1 = spark.createDataFrame([("validate", "x" * 150)], "action string, note string")
    PV.append_entries(e1, path)
    PV.append_entries(spark.createDataFrame([("transform", "short")], "action string, note string"), path)
    log = PV.read_log(spark, path, "action string, note string, timestamp string")
    rows = {r.action: r for r in PV.compact(log).collect()}
    assert rows["validate"].detail.endswith("...") and len(rows["validate"].detail) == 103
    assert rows["transform"].detail == '{"note":"short"}' and rows["transform"].timestamp.endswith("Z")


def test_stream_equals_batch(spark):
    landing, out = _dir(spark, "landing"), _dir(spark, "clean")
    os.makedirs(landing)
    header = ["Station  ID", "Latitude (°N)", "Date/Time"]
    for i in range(3):
        with open(f"{landing}/f{i}.csv", "w") as f:
            f.write(",".join(header) + "\n")
            f.write(f" S{i} ,2{i}.5,07/1{i}/2021 06:00\n\tT{i},bad,2021-07-1{i} 08:00:00\n")
    stream = read_text_stream(spark, landing, header)
    q = start_cleaning(stream, out, name=uuid.uuid4().hex)
    q.awaitTermination(120)
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    batch = TT.read_text_table(spark, landing, header, na_tokens=None).select(*(f"`{c}`" for c in header))
    want = sorted(tuple(r) for r in transform(batch)[0].collect())
    assert got == want and len(got) == 6
    assert ("S0", 20.5, "2021-07-10T06:00:00Z") in got


def test_stream_validation_report(spark):
    from tidepool.streaming.cleaning import read_raw_stream, start_validation

    landing, out = _dir(spark, "landing-v"), _dir(spark, "report")
    os.makedirs(landing)
    with open(f"{landing}/good.csv", "w") as f:
        f.write("a,b\n1,2\n3,4\n")
    with open(f"{landing}/ragged.csv", "w") as f:
        f.write("a,b\n1,2,3\n4\n")
    q = start_validation(read_raw_stream(spark, landing, ["a", "b"]), ["a", "b"], out, name=uuid.uuid4().hex)
    q.awaitTermination(120)
    got = {r.file: (r.rows, r.short_rows, r.long_rows, r.parseable) for r in spark.read.parquet(out).collect()}
    assert got == {"good.csv": (2, 0, 0, True), "ragged.csv": (2, 1, 1, False)}


def test_stream_by_each_files_header(spark):
    from tidepool.streaming.cleaning import start_cleaning_by_name

    landing, out, name = _dir(spark, "landing-n"), _dir(spark, "clean-n"), uuid.uuid4().hex
    os.makedirs(landing)
    with open(f"{landing}/a.csv", "w") as f:
        f.write('Station,Note,Date\nS1,"said ""x"", and\nmore",7/18/2021\n')
    with open(f"{landing}/b.csv", "w") as f:
        f.write("Date,Station\n2021-07-19,S2\n")
    run = lambda: start_cleaning_by_name(spark, landing, ["Station", "Note", "Date"], out, name, max_files_per_trigger=1).awaitTermination(120)
    run()
    with open(f"{landing}/c.csv", "w") as f:
        f.write("Note,Date,Station\nn,07/20/2021,S3\n")
    run()  # only the new file
    got = {(r.station, r.note or None, r.date) for r in spark.read.parquet(out).collect()}
    assert got == {("S1", 'said "x", and\nmore', "2021-07-18T00:00:00Z"), ("S2", None, "2021-07-19T00:00:00Z"), ("S3", "n", "2021-07-20T00:00:00Z")}
    assert spark.read.parquet(out).count() == 3
