"""Fixity queries: row digests, inventories, manifests, verification, presence."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidepool import fixed
from tidepool.functions.hashing import fixity_line, is_utf8, sha256_hex
from tidepool.operators import fixity as X
from tidepool.plans import query
from tidepool.session import checkpoint_dir, read_table

_DOC_PATH_SQL = """
  CASE CAST(substr(source, 4) AS INTEGER) % 6 WHEN 0 THEN 'raw/' WHEN 1 THEN 'processed/' WHEN 2 THEN 'metadata/'
       WHEN 3 THEN 'docs/' WHEN 4 THEN 'logs/' ELSE '' END || source || '/' || CAST(doc_id AS VARCHAR) || '.txt'"""


def _doc_path():
    k = F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 6
    prefix = F.element_at(F.array(*[F.lit(p) for p in ("raw/", "processed/", "metadata/", "docs/", "logs/", "")]), k + 1)
    return F.concat(prefix, F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))


def _doc_manifest(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    rows = d.select(_doc_path().alias("path"), F.octet_length("text").cast("long").alias("size_bytes"),
                    sha256_hex(F.col("text")).alias("sha256"))
    return X.manifest_rows(rows)


@query("row_fixity", f"""
SELECT path, sha256(text) AS sha256, 'SHA256 (' || path || ') = ' || sha256(text) AS line
FROM (SELECT {_DOC_PATH_SQL} AS path, text FROM documents)
""")
def row_fixity(spark, sf_dir):
    """H1 + H5: SHA-256 of every document text (UTF-8) and its BSD fixity line."""
    m = _doc_manifest(spark, sf_dir)
    return m.select("path", "sha256", fixity_line(F.col("path"), F.col("sha256")).alias("line"))


@query("manifest_totals", f"""
WITH m AS (SELECT {_DOC_PATH_SQL} AS path, octet_length(encode(text)) AS size_bytes FROM documents)
SELECT CASE WHEN starts_with(path, 'raw/') THEN 'raw_data' WHEN starts_with(path, 'processed/') THEN 'processed_data'
            WHEN starts_with(path, 'metadata/') THEN 'metadata' WHEN starts_with(path, 'docs/') THEN 'documentation'
            WHEN starts_with(path, 'logs/') THEN 'provenance' ELSE 'other' END AS role,
       'text/plain' AS format, count(*) AS total_files, CAST(sum(size_bytes) AS BIGINT) AS total_bytes
FROM m GROUP BY ALL
""")
def manifest_totals(spark, sf_dir):
    """A18 + H3 + H4: files and bytes per role of a manifest built from the documents."""
    return X.totals(_doc_manifest(spark, sf_dir), ["role", "format"])


_CURRENT_SQL = f"""
  SELECT {_DOC_PATH_SQL} AS path, sha256(CASE WHEN doc_id % 13 = 0 THEN text || ' ' ELSE text END) AS sha256
  FROM documents WHERE NOT (lang = 'de' AND n_chars < 1000)
  UNION ALL SELECT 'raw/benchmark/' || CAST(item_id AS VARCHAR) || '.txt', sha256(text) FROM benchmark
"""


@query("fixity_verify", f"""
WITH m AS (SELECT {_DOC_PATH_SQL} AS path, sha256(text) AS sha256 FROM documents),
c AS ({_CURRENT_SQL})
SELECT coalesce(m.path, c.path) AS path,
       CASE WHEN c.sha256 IS NULL THEN 'missing' WHEN m.sha256 IS NULL THEN 'extra'
            WHEN m.sha256 = c.sha256 THEN 'ok' ELSE 'changed' END AS status
FROM m FULL OUTER JOIN c ON m.path = c.path
""")
def fixity_verify(spark, sf_dir):
    """J-8: manifest of the documents against a later copy (edited, deleted and added files)."""
    d = read_table(spark, sf_dir, "documents")
    b = read_table(spark, sf_dir, "benchmark")
    text = F.when(F.col("doc_id") % 13 == 0, F.concat(F.col("text"), F.lit(" "))).otherwise(F.col("text"))
    deleted = (F.col("lang") == "de") & (F.col("n_chars") < 1000)  # files gone since the manifest
    current = d.where(~deleted).select(_doc_path().alias("path"), sha256_hex(text).alias("sha256"))
    added = b.select(F.concat(F.lit("raw/benchmark/"), F.col("item_id").cast("string"), F.lit(".txt")).alias("path"),
                     sha256_hex(F.col("text")).alias("sha256"))
    return X.verify(_doc_manifest(spark, sf_dir), current.unionByName(added))


_AREAS = ("raw", "processed", "metadata", "docs", "logs")


@query("file_inventory", f"""
WITH d AS (SELECT doc_id // 100 AS block, string_agg(coalesce(text, '') || chr(10), '' ORDER BY doc_id) AS body FROM documents GROUP BY 1)
SELECT a.area || '/block_' || block || '.txt' AS path, sha256(body) AS sha256, strlen(body) AS size_bytes,
       'text/plain' AS format, a.role
FROM d JOIN (VALUES {', '.join(f"({i}, '{a}', '{dict(fixed.ROLES).get(a + '/', fixed.OTHER_ROLE)}')" for i, a in enumerate(_AREAS))}) AS a(k, area, role)
  ON d.block % {len(_AREAS)} = a.k
""")
def file_inventory(spark, sf_dir):
    """Documents written as text files, a hundred to a file, in the five areas of a package, and listed."""
    block = F.floor(F.col("doc_id") / 100)
    area = F.element_at(F.array(*(F.lit(a) for a in _AREAS)), (block % len(_AREAS) + 1).cast("int"))
    docs = read_table(spark, sf_dir, "documents").select(area.alias("area"), block.alias("block"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    root = f"{checkpoint_dir(spark).rstrip('/')}/package-{uuid.uuid4().hex}"
    dealt = docs.repartition("block").sortWithinPartitions("area", "block", "doc_id")
    dealt.select("area", "block", "text").write.partitionBy("area", "block").text(root)
    found = X.inventory(spark, root, skip=(*fixed.SKIP_FILES, "_SUCCESS"))
    path = F.regexp_replace("path", r"^area=([^/]+)/block=(\d+)/.*$", "$1/block_$2.txt")
    return X.manifest_rows(found.withColumn("path", path))


@query("fixity_file", f"""
SELECT 'SHA256 (' || {_DOC_PATH_SQL} || ') = ' || sha256(text) AS line FROM documents
""")
def fixity_file(spark, sf_dir):
    """The sorted checksum lines of all documents, written and read back."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/fixity-{uuid.uuid4().hex}"
    X.write_fixity(_doc_manifest(spark, sf_dir), path)
    return spark.read.text(path).withColumnRenamed("value", "line")


@query("manifest_snapshots", """
WITH t AS (SELECT count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS b FROM documents),
h AS (SELECT count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS b FROM documents WHERE doc_id % 2 = 0)
SELECT CAST(1 AS BIGINT) AS v, 'owner' AS key, 'data office' AS value
UNION ALL SELECT 1, 'total_files', CAST(n AS VARCHAR) FROM h UNION ALL SELECT 1, 'total_bytes', CAST(b AS VARCHAR) FROM h
UNION ALL SELECT 2, 'owner', 'data office' UNION ALL SELECT 2, 'release', 'final'
UNION ALL SELECT 2, 'total_files', CAST(n AS VARCHAR) FROM t UNION ALL SELECT 2, 'total_bytes', CAST(b AS VARCHAR) FROM t
""")
def manifest_snapshots(spark, sf_dir):
    """A manifest of half the documents, then of all; the second snapshot keeps the first one's keys."""
    files = _doc_manifest(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/manifest-{uuid.uuid4().hex}"
    half = files.where(F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("bigint") % 2 == 0)
    X.write_manifest(spark, path, half, spark.createDataFrame([("owner", "data office")], "key string, value string"))
    X.write_manifest(spark, path, files, spark.createDataFrame([("release", "final")], "key string, value string"))
    return spark.read.parquet(f"{path}/info").select(F.col("v").cast("bigint").alias("v"), "key", "value")


# ------------------------------------------------------------ presence -------
_EXPECTED_SQL = """
  SELECT s.source, s.source || '_' || l.lang || '.csv' AS name,
         CASE WHEN l.lang IN ('en', 'fr') THEN 'incoming/' || s.source || '/' || s.source || '_' || l.lang || '.csv'
              ELSE 'incoming/' || s.source || '/' || upper(l.lang) || '.CSV' END AS source_path
  FROM (SELECT DISTINCT source FROM documents) s, (SELECT unnest(['en', 'fr', 'de', 'es', 'it']) AS lang) l
"""


@query("expected_files", f"""
WITH e AS ({_EXPECTED_SQL}),
p AS (SELECT DISTINCT source, source || '_' || lang || '.csv' AS file_name FROM documents),
j AS (SELECT e.*, regexp_extract(source_path, '([^/]+)$', 1) AS base FROM e)
SELECT j.source, j.name, j.source_path, (pb.file_name IS NOT NULL OR pn.file_name IS NOT NULL) AS file_exists,
       CASE WHEN pb.file_name IS NOT NULL THEN 'source_path' WHEN pn.file_name IS NOT NULL THEN 'name' END AS matched_by,
       CASE WHEN pb.file_name IS NOT NULL THEN j.base WHEN pn.file_name IS NOT NULL THEN j.name END AS raw_file
FROM j LEFT JOIN p pb ON pb.source = j.source AND pb.file_name = j.base
       LEFT JOIN p pn ON pn.source = j.source AND pn.file_name = j.name
""")
def expected_files(spark, sf_dir):
    """J-1: configured files per source found by source-path base name, else by name."""
    d = read_table(spark, sf_dir, "documents")
    langs = F.array(*[F.lit(x) for x in ("en", "fr", "de", "es", "it")])
    e = d.select("source").distinct().select("source", F.explode(langs).alias("lang"))
    name = F.concat(F.col("source"), F.lit("_"), F.col("lang"), F.lit(".csv"))
    sp = F.when(F.col("lang").isin("en", "fr"),
                F.concat(F.lit("incoming/"), F.col("source"), F.lit("/"), name)) \
        .otherwise(F.concat(F.lit("incoming/"), F.col("source"), F.lit("/"), F.upper(F.col("lang")), F.lit(".CSV")))
    expected = e.select("source", name.alias("name"), sp.alias("source_path"))
    present = d.select("source", F.concat(F.col("source"), F.lit("_"), F.col("lang"), F.lit(".csv")).alias("file_name"))
    return X.expected_presence(expected, present, ["source"])


_PRESENT_SQL = """
  SELECT DISTINCT source, path FROM (
    SELECT source, 'raw' AS path FROM documents
    UNION ALL SELECT source, 'processed' FROM documents WHERE lang <> 'es'
    UNION ALL SELECT source, 'metadata/iso19115-2.xml' FROM documents WHERE lang = 'de'
    UNION ALL SELECT source, 'logs/validation_report.json' FROM documents WHERE n_chars > 20000)
"""


@query("missing_artefacts", f"""
WITH r AS (SELECT s.source, a.path, a.description FROM (SELECT DISTINCT source FROM documents) s,
           (VALUES {', '.join(f"('{p}', '{d}')" for p, d in fixed.REQUIRED_ARTEFACTS)}) a(path, description)),
p AS ({_PRESENT_SQL})
SELECT r.source, r.path, r.description FROM r ANTI JOIN p ON r.source = p.source AND r.path = p.path
""")
def missing_artefacts(spark, sf_dir):
    """J-7: required package artefacts missing per source (left anti join)."""
    d = read_table(spark, sf_dir, "documents")
    arte = F.array(*[F.struct(F.lit(p).alias("path"), F.lit(t).alias("description")) for p, t in fixed.REQUIRED_ARTEFACTS])
    required = d.select("source").distinct().select("source", F.explode(arte).alias("a")).select("source", "a.*")
    present = (
        d.select("source", F.lit("raw").alias("path"))
        .unionByName(d.where(F.col("lang") != "es").select("source", F.lit("processed").alias("path")))
        .unionByName(d.where(F.col("lang") == "de").select("source", F.lit(fixed.METADATA_PATH).alias("path")))
        .unionByName(d.where(F.col("n_chars") > 20000).select("source", F.lit("logs/validation_report.json").alias("path")))
    )
    return X.missing_artefacts(required, present, ["source"])


@query("encoding_check", """
WITH b AS (SELECT source, CASE WHEN doc_id % 9 = 0 THEN encode(text) || '\\xFF'::BLOB ELSE encode(text) END AS content
           FROM documents)
SELECT source, 'encoding' AS "check", count(*) AS files, count(*) FILTER (WHERE try(decode(content)) IS NULL) AS not_utf8,
       count(*) FILTER (WHERE try(decode(content)) IS NULL) = 0 AS passed
FROM b GROUP BY source
""")
def encoding_check(spark, sf_dir):
    """UTF-8 validity of every document's bytes (some get a stray 0xFF byte)."""
    d = read_table(spark, sf_dir, "documents")
    content = F.when(F.col("doc_id") % 9 == 0, F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF")))) \
        .otherwise(F.col("text").cast("binary"))
    b = d.select("source", is_utf8(content).alias("_ok"))
    agg = b.groupBy("source").agg(F.count(F.lit(1)).alias("files"), F.count_if(~F.col("_ok")).alias("not_utf8"))
    return agg.select("source", F.lit("encoding").alias("check"), "files", "not_utf8", (F.col("not_utf8") == 0).alias("passed"))


_EXPECTED_DOCS_SQL = """
  SELECT CAST(doc_id AS VARCHAR) || '.txt' AS name,
         'incoming/' || source || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS source_path,
         CASE WHEN lang = 'en' THEN 'text/plain' ELSE 'text/' || lang END AS format,
         CASE WHEN lang IN ('en', 'fr') THEN NULL ELSE 'text/plain' END AS target_format,
         'Document ' || CAST(doc_id AS VARCHAR) || ' (' || lang || ')' AS description,
         lang, n_chars, text
  FROM documents
"""


@query("ingest_inventory", f"""
WITH e AS ({_EXPECTED_DOCS_SQL}),
p AS (SELECT source_path, CAST(octet_length(encode(text)) AS BIGINT) AS size_bytes, sha256(text) AS sha256
      FROM e WHERE NOT (lang = 'es' AND n_chars > 5000))
SELECT e.source_path AS original_path, 'raw/' || e.name AS archive_path, e.name, e.format,
       coalesce(e.target_format, e.format) AS target_format, e.description, p.size_bytes, p.sha256,
       'raw_data' AS role
FROM e LEFT JOIN p ON e.source_path = p.source_path
""")
def ingest_inventory(spark, sf_dir):
    """Every configured document file with archive path, formats, size, digest and role."""
    d = read_table(spark, sf_dir, "documents")
    path = F.concat(F.lit("incoming/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    expected = d.select(
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), path.alias("source_path"),
        F.when(F.col("lang") == "en", F.lit("text/plain")).otherwise(F.concat(F.lit("text/"), F.col("lang"))).alias("format"),
        F.when(~F.col("lang").isin("en", "fr"), F.lit("text/plain")).alias("target_format"),
        F.format_string("Document %d (%s)", F.col("doc_id"), F.col("lang")).alias("description"),
    )
    arrived = ~((F.col("lang") == "es") & (F.col("n_chars") > 5000))  # large Spanish files not delivered
    present = d.where(arrived).select(path.alias("source_path"), F.octet_length("text").cast("long").alias("size_bytes"),
                                      sha256_hex(F.col("text")).alias("sha256"))
    return X.ingest_inventory(expected, present)


# ------------------------------------------------------- published snapshots ---
@query("manifest_published", """
WITH t AS (SELECT count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS b FROM documents),
h AS (SELECT count(*) AS n, CAST(sum(strlen(text)) AS BIGINT) AS b FROM documents WHERE doc_id % 2 = 0)
SELECT CAST(1 AS BIGINT) AS v, 'owner' AS key, 'data office' AS value, h.n AS files FROM h
UNION ALL SELECT 1, 'total_files', CAST(n AS VARCHAR), n FROM h UNION ALL SELECT 1, 'total_bytes', CAST(b AS VARCHAR), n FROM h
UNION ALL SELECT 2, 'owner', 'data office', n FROM t UNION ALL SELECT 2, 'release', 'final', n FROM t
UNION ALL SELECT 2, 'total_files', CAST(n AS VARCHAR), n FROM t UNION ALL SELECT 2, 'total_bytes', CAST(b AS VARCHAR), n FROM t
""")
def manifest_published(spark, sf_dir):
    """Snapshots of half the documents, then of all, with a write between that is never published; each read back."""
    files = _doc_manifest(spark, sf_dir)
    path = f"{checkpoint_dir(spark).rstrip('/')}/published-{uuid.uuid4().hex}"
    kv = "key string, value string"
    half = files.where(F.regexp_extract("path", r"(\d+)\.txt$", 1).cast("bigint") % 2 == 0)
    X.publish_manifest(spark, path, half, spark.createDataFrame([("owner", "data office")], kv))
    files.write.parquet(f"{path}/snapshot-{uuid.uuid4().hex}/files")  # a writer that was lost before it could publish
    X.publish_manifest(spark, path, files, spark.createDataFrame([("release", "final")], kv))
    out = None
    for v in (1, 2):
        members, info = X.read_manifest(spark, path, v)
        part = info.select(F.lit(v).cast("bigint").alias("v"), "key", "value", F.lit(members.count()).cast("bigint").alias("files"))
        out = part if out is None else out.unionByName(part)
    return out
