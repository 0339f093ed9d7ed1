"""Source and sink queries: CSV scan report, provenance log round trip."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool.plans import query
from tidepool.session import checkpoint_dir, read_table, stored
from tidepool.sources import provenance as PV
from tidepool.sources import text_tables as TT


def _scratch(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_LINES_SQL = """
  SELECT source, CASE WHEN line = '' THEN CAST(doc_id AS VARCHAR)
                      ELSE CAST(doc_id AS VARCHAR) || ',' || lang || ',' || line END AS record
  FROM (SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS line FROM documents)
"""


@query("ragged_rows", f"""
WITH r AS ({_LINES_SQL}), f AS (SELECT source, len(string_split(record, ',')) AS n FROM r)
SELECT source, count(*) AS rows, count(*) FILTER (WHERE n < 3) AS short_rows, count(*) FILTER (WHERE n > 3) AS long_rows,
       CAST(0 AS BIGINT) AS empty_rows,
       count(*) FILTER (WHERE n > 3) = 0 AS parseable, count(*) FILTER (WHERE n <> 3) = 0 AS equal_field_counts
FROM f GROUP BY source
""")
def ragged_rows(spark, sf_dir):
    """S1 + S2 + V4: every line of every document written as a CSV record, scanned back.

    Records are ``doc_id,lang,line`` (commas in the line make long rows, blank
    lines give short ones); the files go to the shared checkpoint folder, one
    folder per source, and are read with the corrupt-record column.
    """
    d = read_table(spark, sf_dir, "documents")
    lines = d.select("doc_id", "lang", "source", F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    rec = F.when(F.col("line") == "", F.col("doc_id").cast("string")).otherwise(
        F.concat_ws(",", F.col("doc_id").cast("string"), F.col("lang"), F.col("line")))
    path = _scratch(spark, "ragged")
    lines.select("source", rec.alias("value")).write.partitionBy("source").text(path)
    df = TT.read_text_table(spark, path, ["doc_id", "lang", "line"], header=False, quote=None, na_tokens=None)
    df = df.withColumn("source", F.regexp_extract(F.col("file"), r"source=([^/]+)/", 1))
    return TT.parse_report(df, ["doc_id", "lang", "line"], keys=("source",))


@query("csv_header_by_name", """
WITH lines AS (SELECT source, doc_id, lang, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT source, count(*) AS rows, CAST(sum(doc_id) AS BIGINT) AS doc_ids, count(lang) AS langs,
       CAST(sum(length(line)) AS BIGINT) AS characters, CAST(0 AS BIGINT) AS malformed
FROM (SELECT source, doc_id, line, CASE WHEN doc_id % 3 <> 2 THEN lang END AS lang FROM lines) GROUP BY source
""")
def csv_header_by_name(spark, sf_dir):
    """Files whose headers order the columns differently, or lack one, and whose quoted text holds commas."""
    d = read_table(spark, sf_dir, "documents")
    lines = d.select("source", "doc_id", "lang", F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    path = _scratch(spark, "by-name")
    for k, order in enumerate((["doc_id", "lang", "line"], ["line", "doc_id", "lang"], ["line", "doc_id"])):
        lines.where(F.col("doc_id") % 3 == k).select("source", *order).write.partitionBy("source").option("header", True).option(
            "escape", '"').csv(f"{path}/{k}")
    df = TT.read_text_table(spark, path, ["doc_id", "lang", "line"], na_tokens=None)
    return df.groupBy(F.regexp_extract(F.col("file"), r"source=([^/]+)/", 1).alias("source")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("doc_id").cast("bigint")).alias("doc_ids"), F.count("lang").alias("langs"),
        F.sum(F.length("line")).alias("characters"), F.count(TT.CORRUPT).alias("malformed"))


@query("csv_sink", """
SELECT l_returnflag, count(*) AS rows, CAST(sum(l_orderkey) AS BIGINT) AS keys, round(sum(l_extendedprice), 2) AS price,
       count(*) FILTER (WHERE l_discount > 0.05) AS missing
FROM lineitem GROUP BY l_returnflag
""")
def csv_sink(spark, sf_dir):
    """Lineitem written as CSV with CRLF line ends and a text for missing values, and read back."""
    li = read_table(spark, sf_dir, "lineitem")
    discount = F.when(F.col("l_discount") <= 0.05, F.col("l_discount")).alias("l_discount")
    path = _scratch(spark, "sink")
    TT.write_csv(li.select("l_returnflag", "l_orderkey", "l_extendedprice", discount), path, line_ending="windows", na="NA")
    back = TT.read_text_table(spark, path)
    return back.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("l_orderkey").cast("bigint")).alias("keys"),
        F.round(F.sum(F.col("l_extendedprice").cast("double")), 2).alias("price"), F.count_if(F.col("l_discount").isNull()).alias("missing"))


@query("csv_text_round_trip", """
SELECT doc_id, lang, length(text) AS characters, sha256(text) AS text_sha256,
       CASE WHEN doc_id % 7 > 0 THEN sha256('\\ "' || source || '", \\"') END AS note_sha256,
       CAST(length(text) - length(replace(text, chr(10), '')) AS BIGINT) AS breaks, true AS whole
FROM documents
""")
def csv_text_round_trip(spark, sf_dir):
    """S6 + S1 + V4: whole texts, with quotes, commas, backslashes and line breaks, written as CSV and read back in splits."""
    d = read_table(spark, sf_dir, "documents")
    note = F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit('\\ "'), F.col("source"), F.lit('", \\"')))
    path = _scratch(spark, "texts")
    TT.write_csv(d.select("doc_id", "text", note.alias("note"), "lang"), path, na="NA")
    back = TT.read_text_table(spark, path, ["doc_id", "lang", "text", "note"], multi_line=True)
    # the default reader takes NA for missing, and so does a text of nothing
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "lang", F.length("text").cast("bigint").alias("characters"),
        F.sha2("text", 256).alias("text_sha256"), F.sha2("note", 256).alias("note_sha256"),
        F.length(F.regexp_replace("text", "[^\n]", "")).cast("bigint").alias("breaks"), F.col(TT.CORRUPT).isNull().alias("whole"))


@query("provenance_compact", """
SELECT role AS action, '2024-01-01T00:00:00Z' AS timestamp,
       CASE WHEN length(d) > 100 THEN substr(d, 1, 100) || '...' ELSE d END AS detail
FROM (SELECT role, json_object('conv_id', conv_id, 'turn', turn, 'text', text)::VARCHAR AS d FROM conversations)
""")
def provenance_compact(spark, sf_dir):
    """S8 + S9: conversation turns appended to a JSON-lines log, scanned back and shown compact."""
    conv = read_table(spark, sf_dir, "conversations")
    path = _scratch(spark, "provenance")
    entries = conv.select(F.col("role").alias("action"), "conv_id", "turn", "text")
    PV.append_entries(entries, path, stamp=F.lit("2024-01-01T00:00:00Z"))
    log = PV.read_log(spark, path, "action string, conv_id long, turn long, text string, timestamp string")
    return PV.compact(log.select("action", "timestamp", "conv_id", "turn", "text"))


# --- Fixed values: rules of the document-file submission ----------------------
SUBMISSION_REQUIRED = ("Doc ID", "lang", "Text")
SUBMISSION_RANGE = ("doc_id", 0.0, 500.0)
SUBMISSION_KEYS = ("doc_id", "Line No")

_SUB_SQL = r"""
WITH files AS (SELECT DISTINCT source AS file, CAST(regexp_extract(source, '\d+') AS INT) % 5 AS v FROM documents),
lines AS (SELECT source AS file, doc_id, unnest(string_split(text, chr(10))) AS line FROM documents
          UNION ALL SELECT source, NULL, NULL FROM documents WHERE CAST(regexp_extract(source, '\d+') AS INT) % 5 = 4),
expected AS (SELECT file FROM files UNION ALL SELECT DISTINCT 'missing_' || lang FROM documents),
per AS (SELECT file, v, count(*) AS rows, count(*) FILTER (WHERE doc_id > 500) AS oor, count(*) FILTER (WHERE doc_id IS NULL) AS empties,
               count(doc_id) AS ids, NOT (v = 1 AND bool_or(coalesce(regexp_matches(line, '[\x{80}-\x{FF}]'), false))) AS utf8,
               NOT (v = 2 AND bool_or(contains(coalesce(line, ''), ','))) AS parses
        FROM lines JOIN files USING (file) GROUP BY file, v),
good AS (SELECT * FROM per WHERE utf8 AND parses),
dk AS (SELECT file, doc_id, count(*) AS n FROM lines GROUP BY file, doc_id),
dup AS (SELECT file, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS d FROM dk WHERE file IN (SELECT file FROM good) GROUP BY file),
checks AS (
  SELECT e.file, 0 AS seq, 'file_exists' AS "check", f.file IS NOT NULL AS passed,
         CASE WHEN f.file IS NOT NULL THEN 'Found' ELSE 'File not found' END AS detail
  FROM expected e LEFT JOIN files f ON e.file = f.file
  UNION ALL SELECT file, 1, 'encoding', utf8, CASE WHEN utf8 THEN 'utf-8' ELSE 'not utf-8' END FROM per
  UNION ALL SELECT file, 2, 'utf8_readable', false, 'Could not parse file' FROM per WHERE NOT utf8
  UNION ALL SELECT file, 3, 'parseable', parses,
         CASE WHEN parses THEN printf('%d rows, %d columns', rows, CASE WHEN v = 3 THEN 2 ELSE 3 END) ELSE 'Could not parse file' END
  FROM per WHERE utf8
  UNION ALL SELECT file, 4, 'no_empty_rows', empties = 0,
         CASE WHEN empties > 0 THEN printf('%d completely empty rows found', empties) ELSE 'No empty rows' END FROM good
  UNION ALL SELECT file, 5, 'required_column_Doc ID', false, 'Column ''Doc ID'' MISSING' FROM good
  UNION ALL SELECT file, 5, 'required_column_lang', v <> 3,
         CASE WHEN v = 3 THEN 'Column ''lang'' MISSING' ELSE 'Column ''lang'' found (raw: lang)' END FROM good
  UNION ALL SELECT file, 5, 'required_column_Text', false, 'Column ''Text'' MISSING' FROM good
  UNION ALL SELECT file, 6, 'range_doc_id', oor = 0,
         CASE WHEN oor > 0 THEN printf('%d values outside [0.0, 500.0]', oor) ELSE 'All values in [0.0, 500.0]' END
  FROM good
  UNION ALL SELECT file, 7, 'no_duplicates', d = 0,
         CASE WHEN d > 0 THEN printf('%d duplicate rows on key [doc_id]', d) ELSE 'No duplicates' END FROM dup)
SELECT file, seq, "check", passed, detail FROM checks
"""


@query("validate_submission", _SUB_SQL)
def validate_submission(spark, sf_dir):
    """§3.3 end to end: every document source written as CSV files, validated with short-circuits.

    The files go to the shared checkpoint folder, a record ``doc_id,lang,line`` for each line of each document. By
    the source's number, one in five is plain, one is written in Latin-1, one without quotes (commas make
    long rows), one without the column ``lang`` and in another order, and one with empty rows. Expected
    files include one absent file per language, which gets no further checks. Columns come from the files' headers.
    """
    from tidepool.operators import checks as C
    from tidepool.operators import duplicates as D
    from tidepool.operators import profile as P

    d = read_table(spark, sf_dir, "documents").withColumn("v", F.regexp_extract("source", r"\d+", 0).cast("int") % 5)
    cols = ["doc_id", "lang", "line"]
    lines = d.select("source", "v", F.col("doc_id").cast("string").alias("doc_id"), "lang",
                     F.explode(F.split(F.col("text"), "\n", -1)).alias("line"))
    blank = d.where("v = 4").select("source", "v", *(F.lit(None).cast("string").alias(c) for c in cols))
    path = _scratch(spark, "submission")
    for v, extra in enumerate(({}, {"encoding": "ISO-8859-1"}, {"quote": "\u0000"}, {}, {})):
        part = lines.unionByName(blank).where(F.col("v") == v).select("source", *(["line", "doc_id"] if v == 3 else cols))
        part.write.partitionBy("source").options(header=True, escape='"', **extra).csv(f"{path}/{v}")
    name = F.regexp_extract(F.col("file"), r"source=([^/]+)/", 1)
    df = stored(TT.read_text_table(spark, path, cols, na_tokens=None).withColumn("file", name))  # text is parsed once
    # a source may lie in several files, all with one header
    catalogue = TT.column_catalogue(TT.header_lines(spark, path)).withColumn("file", name).distinct()
    width = catalogue.groupBy("file").agg(F.count("*").alias("columns"))
    parse = TT.parse_report(df, cols).select("file", "parseable", "rows").join(width, "file")
    files = catalogue.select("file").distinct()
    expected = files.unionByName(d.select(F.concat(F.lit("missing_"), F.col("lang")).alias("file")).distinct())
    presence = expected.join(files.withColumn("_p", F.lit(True)), "file", "left").select(
        "file", F.coalesce(F.col("_p"), F.lit(False)).alias("file_exists"))
    enc = TT.utf8_lines(spark, path).groupBy(name.alias("file")).agg(F.bool_and("passed").alias("passed"))
    enc = enc.withColumn("detail", F.when(F.col("passed"), F.lit("utf-8")).otherwise(F.lit("not utf-8")))
    empty = C.empty_rows(df, ["file"], cols)
    req = C.required_columns(catalogue, spark.createDataFrame([(c,) for c in SUBMISSION_REQUIRED], "column string"), ["file"])
    rr = spark.createDataFrame([SUBMISSION_RANGE], "column string, lo double, hi double")
    rng = C.value_ranges(P.to_long(df, ["doc_id"], ["file"]), rr, ["file"], cols)
    keys = D.matched_keys(spark, cols, list(SUBMISSION_KEYS))
    dup = C.no_duplicates(D.duplicate_members(df, ["file"], keys), ["file"], keys)
    return C.validate_files(presence, enc, parse, [empty, req, rng, dup])


_CONFIG_JSON = """'{"dataset":{"files":[' || files || '],"license":{"name":' || lic || ',"url":null},"title":"Texts of ' || source
  || '"},"rules":{"max_chars":"' || hi || '","min_chars":"' || lo || '"},"version":' || n || '}'"""


@query("config_fingerprints", f"""
WITH f AS (SELECT source, lang, count(*) AS n, min(n_chars) AS lo, max(n_chars) AS hi FROM documents GROUP BY source, lang),
s AS (SELECT source, string_agg('{{"format":"csv","name":"' || lang || '.csv"}}', ',' ORDER BY lang) AS files, CAST(sum(n) AS BIGINT) AS n,
             min(lo) AS lo, max(hi) AS hi, CASE WHEN sum(n) % 2 = 0 THEN '"CC-BY-4.0"' ELSE 'null' END AS lic FROM f GROUP BY source)
SELECT source, left(sha256({_CONFIG_JSON}), 16) AS fingerprint, true AS order_free, true AS told_apart FROM s
""")
def config_fingerprints(spark, sf_dir):
    """H2: nested configurations of every source; the order of fields and map keys does not matter, any value does."""
    d = read_table(spark, sf_dir, "documents")
    by_lang = d.groupBy("source", "lang").agg(F.count(F.lit(1)).alias("n"), F.min("n_chars").alias("lo"), F.max("n_chars").alias("hi"))
    g = by_lang.groupBy("source").agg(F.array_sort(F.collect_list("lang")).alias("langs"),  # one a language
                                      F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    lic, title = F.when(F.col("n") % 2 == 0, F.lit("CC-BY-4.0")), F.concat(F.lit("Texts of "), F.col("source"))
    nul = F.lit(None).cast("string")
    lo, hi = F.col("lo").cast("string"), F.col("hi").cast("string")

    def config(files, bounds, flip, version):
        def struct(*fields):
            return F.struct(*(reversed(fields) if flip else fields))

        dataset = struct(title.alias("title"), struct(lic.alias("name"), nul.alias("url")).alias("license"),
                         F.transform("langs", files).alias("files"))
        return struct(version.alias("version"), dataset.alias("dataset"), F.create_map(*bounds).alias("rules"))

    csv = F.lit("csv")
    one = [F.lit("min_chars"), lo, F.lit("max_chars"), hi]
    two = [F.lit("max_chars"), hi, F.lit("min_chars"), lo]
    rows = g.select(
        "source",
        config(lambda x: F.struct(F.concat(x, F.lit(".csv")).alias("name"), csv.alias("format")), one, False, F.col("n")).alias("a"),
        config(lambda x: F.struct(csv.alias("format"), F.concat(x, F.lit(".csv")).alias("name")), two, True, F.col("n")).alias("b"),
        config(lambda x: F.struct(csv.alias("format"), F.concat(x, F.lit(".csv")).alias("name")), two, True, F.col("n") + 1).alias("c"))
    a, b, c = (PV.canonical_fingerprint(rows, x) for x in "abc")
    return rows.select("source", a.alias("fingerprint"), (a == b).alias("order_free"), (a != c).alias("told_apart"))
