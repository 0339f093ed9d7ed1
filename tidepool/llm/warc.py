"""Legacy archives to WARC.

ARC files of either version are read record by record, each as long as its header line declares; every record
becomes a WARC record with an identifier, timestamp, type and digests made from what the ARC header says. Of records
with equal payloads one is written in full and the others as revisits of it. Both kinds of file are written by
Spark's text writer (records are rows, what ends a record is the line separator, gzip is the writer's), so
they end in any file system that Spark reaches, whole or not at all.

Archives are read a file a row: as legacy archives are files of about 100 MB, a task holds one such file,
compressed; its records are decompressed one at a time.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, stored
from . import query
from .common import map_rows, table

LEAST = 100  # bytes of a payload from which copies become revisits
ID_HEADER = "X-Page-Id"  # the HTTP header that carries a record's own id, if it has one
#: Header lines of ARC records, by the format's versions.
FIELDS = {1: ("url", "ip", "date", "mime", "length"),
          2: ("url", "ip", "date", "mime", "status", "checksum", "location", "offset", "filename", "length")}
_MEDIA = re.compile(r"[\w.+-]+/[\w.+*-]+")


def _stream(content: bytes):
    """Bytes of an archive, decompressed member by member if it is gzip."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw)) if content[:2] == b"\x1f\x8b" else raw


def arc_records(content: bytes):
    """(offset, fields by name, block) of the records of an ARC file of either version, the version block too.

    The version block's second line says which version the header lines follow; a file without one is read by
    the number of fields. What cannot be a header line, or a record shorter than declared, ends in ValueError.
    """
    stream, version = _stream(content), None
    while True:
        offset = stream.tell()
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        words = line.decode("utf-8", "surrogateescape").rstrip("\r\n").split(" ")
        named = FIELDS.get(version) or next((f for f in FIELDS.values() if len(f) == len(words)), None)
        if words[0].startswith("filedesc:"):
            named = next((f for f in FIELDS.values() if len(f) == len(words)), None)
        if named is None or len(words) < len(named) or not words[-1].isdigit():
            raise ValueError(f"no ARC header line at {offset}: {line[:80]!r}")
        extra = len(words) - len(named)  # a space within the URL
        fields = dict(zip(named, [" ".join(words[: extra + 1]), *words[extra + 1 :]]))
        block = stream.read(int(fields["length"]))
        if len(block) < int(fields["length"]):
            raise ValueError(f"record at {offset} is shorter than it declares")
        if words[0].startswith("filedesc:"):
            head = block.split(b"\n", 1)[0].split(b" ")[0]
            version = int(head) if head.isdigit() and int(head) in FIELDS else None
        yield offset, fields, block


def timestamp(date: str) -> str:
    """An ARC date of 14 digits, or of fewer (the rest at its least), as a WARC timestamp."""
    digits = re.sub(r"\D", "", date)[:14]
    digits += "19700101000000"[len(digits) :]
    return f"{digits[:4]}-{digits[4:6]}-{digits[6:8]}T{digits[8:10]}:{digits[10:12]}:{digits[12:]}Z"


def split_http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, body) of an HTTP message; no head if the block is none."""
    if block[:5] != b"HTTP/":
        return b"", block
    cut = block.find(b"\r\n\r\n")
    if cut >= 0:
        return block[: cut + 4], block[cut + 4 :]
    cut = block.find(b"\n\n")
    return (block[: cut + 2], block[cut + 2 :]) if cut >= 0 else (block, b"")


def header_value(head: bytes, name: str) -> str | None:
    for line in head.split(b"\n"):
        key, _, value = line.partition(b":")
        if key.strip().lower() == name.lower().encode():
            return value.strip().decode("utf-8", "replace")
    return None


def synthesise(fields: dict, block: bytes, offset: int) -> dict:
    """What a WARC record needs, from an ARC record: type, id, date, media type, digests, parts of the block."""
    url = fields["url"]
    head, body = split_http(block)
    if url.startswith("filedesc:"):
        kind, media, head, body = "warcinfo", "text/plain", b"", block
    elif head:
        kind, media = "response", "application/http; msgtype=response"
    else:
        kind, media = "resource", "text/dns" if url.startswith("dns:") else fields["mime"]
        media = media if _MEDIA.fullmatch(media) else "application/octet-stream"
    payload = hashlib.sha256(body).hexdigest()
    name = f"{url} {fields['date']} {offset} {header_value(head, ID_HEADER)} {payload}"
    return {"type": kind, "record_id": f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>", "uri": url, "date": timestamp(fields["date"]),
            "ip": fields["ip"], "media": media, "digest": payload, "n": len(body), "head": head, "body": body,
            "block_digest": hashlib.sha256(block).hexdigest()}


def _own_id(head: bytes) -> int | None:
    value = header_value(head, ID_HEADER)
    return int(value) if value and re.fullmatch(r"-?\d+", value) else None


def _converted(with_block: bool):
    def run(rows):
        for path, content in rows:
            for offset, fields, block in arc_records(content):
                r = synthesise(fields, block, offset)
                if r["type"] == "warcinfo":
                    continue  # a new one heads each WARC file
                yield (path, offset, _own_id(r["head"]), r["type"], r["record_id"], r["uri"], r["date"], r["ip"], r["media"],
                       r["digest"], r["n"], r["block_digest"], *((r["head"], r["body"]) if with_block else ()))

    return run


_RECORD = ("path string, offset bigint, own bigint, type string, record_id string, uri string, date string, ip string, "
           "media string, digest string, n bigint, block_digest string")


def files(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the files in a folder, whole."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")


def _first_in_file() -> Column:
    """True for the first row of each written file: this runs in the stage that writes."""
    return F.expr("monotonically_increasing_id() & 8589934591") == 0


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = LEAST) -> None:
    """Write the records of the ARC files in a folder as gzipped WARC files in another.

    Equal payloads (SHA-256 and length) of at least ``least`` bytes are written once, with the record whose own
    id is smallest (no id: after those that have one), then by file and place; the others become revisits. Only
    digests are grouped and joined for that, copies combining before the shuffle; payloads move once, to
    meet the decision on their own record. An empty folder gives no records.
    """
    names = map_rows(files(spark, arc_path), _converted(False), _RECORD)
    names = cut_lineage(names.where("type != 'warcinfo'"))
    order = F.struct(F.isnull("own").alias("u"), F.col("own"), F.col("path"), F.col("offset"), F.col("record_id"), F.col("uri"), F.col("date"))
    first = names.where(F.col("n") >= least).groupBy("digest", "n").agg(F.count("*").alias("copies"), F.min(order).alias("first"))
    first = stored(first.where("copies > 1").select(F.col("digest").alias("fd"), F.col("n").alias("fn"), "first"))
    again = names.join(first, (F.col("digest") == F.col("fd")) & (F.col("n") == F.col("fn")))
    again = again.where(F.struct("path", "offset") != F.struct("first.path", "first.offset")).select(
        F.col("path").alias("p"), F.col("offset").alias("o"), F.col("first.record_id").alias("to_id"),
        F.col("first.uri").alias("to_uri"), F.col("first.date").alias("to_date"))
    whole = map_rows(files(spark, arc_path), _converted(True), _RECORD + ", head binary, body binary")
    rows = whole.join(again, (F.col("path") == F.col("p")) & (F.col("offset") == F.col("o")), "left")

    revisit = F.col("to_id").isNotNull()
    block = F.when(revisit, F.col("head")).otherwise(F.concat("head", "body"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise(F.col("type")), F.lit("\r\n"),
        _line("WARC-Record-ID", F.col("record_id")), _line("WARC-Date", F.col("date")), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-IP-Address", F.when(~F.col("ip").isin("0.0.0.0", "-", ""), F.col("ip"))), _line("Content-Type", F.col("media")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _line("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.when(revisit, F.sha2("head", 256)).otherwise(F.col("block_digest")))),
        _line("WARC-Refers-To", F.col("to_id")), _line("WARC-Refers-To-Target-URI", F.col("to_uri")), _line("WARC-Refers-To-Date", F.col("to_date")),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n").otherwise(""),
        F.lit("Content-Length: "), F.octet_length(block).cast("string"), F.lit("\r\n\r\n"))
    about = "software: tidepool\r\nformat: WARC File Format 1.1\r\n"
    info = F.concat(F.lit("WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:"), F.expr("uuid()"), F.lit(">\r\nWARC-Date: "),
                    F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("\r\nContent-Type: application/warc-fields\r\n"
                    f"Content-Length: {len(about)}\r\n\r\n{about}\r\n\r\n"))
    record = F.concat(head.cast("binary"), block)
    out = rows.select(F.concat(F.when(_first_in_file(), info).otherwise("").cast("binary"), record).cast("string").alias("value"))
    out.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(warc_path)


def warc_records(content: bytes):
    """(headers by lower-case name, block) of a WARC file's records, each as long as its Content-Length says."""
    stream = _stream(content)
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no WARC version line: {line[:80]!r}")
        headers = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name.strip().lower()] = value.strip()
        size = int(headers["content-length"])
        block = stream.read(size)
        if len(block) < size:
            raise ValueError("record is shorter than it declares")
        yield headers, block


def read_warc(spark: SparkSession, warc_path: str) -> DataFrame:
    """(record_id, type, uri, own, n, digest, intact, refers_to_id) of the records of WARC files, but for warcinfo.

    n and digest are of the full payload; a revisit's are null and its header's. intact: block and payload have the
    digests that the header says.
    """

    def run(rows):
        for _, content in rows:
            for h, block in warc_records(content):
                if h["warc-type"] == "warcinfo":
                    continue
                head, body = split_http(block) if h.get("content-type", "").startswith("application/http") else (b"", block)
                revisit = h["warc-type"] == "revisit"
                said = h.get("warc-payload-digest", "").removeprefix("sha256:")
                digest = said if revisit else hashlib.sha256(body).hexdigest()
                intact = digest == said and h.get("warc-block-digest") == "sha256:" + hashlib.sha256(block).hexdigest()
                yield (h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), _own_id(head), None if revisit else len(body),
                       digest, intact, h.get("warc-refers-to"))

    return map_rows(files(spark, warc_path), run, "record_id string, type string, uri string, own bigint, n bigint, "
                    "digest string, intact boolean, refers_to_id string")


def resolved(records: DataFrame) -> DataFrame:
    """Records with revisits' payload length and own id of the record they revisit (column to_own)."""
    full = records.where("type != 'revisit'").select(F.col("record_id").alias("r"), F.col("n").alias("rn"), F.col("own").alias("to_own"))
    out = records.join(full, F.col("refers_to_id") == F.col("r"), "left")
    return out.withColumn("n", F.coalesce("n", "rn")).drop("r", "rn", "refers_to_id")


def write_arc(pages: DataFrame, arc_path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> None:
    """Pages as gzipped ARC files of both versions, as a crawler of the time would have left them.

    A null body is empty, a null URL is named by the id; white space in a URL is escaped, as it would end the field.
    """
    body = F.coalesce(F.col(f"`{body_col}`"), F.lit(""))
    own = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("-"))
    url = F.coalesce(F.regexp_replace(F.col(f"`{url_col}`"), r"\s", "%20"), F.concat(F.lit("urn:page:"), own))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n{ID_HEADER}: "), own, F.lit("\r\n\r\n"), body)
    size = F.octet_length(http).cast("string")
    two = F.spark_partition_id() % 2 == 1
    line = F.when(two, F.concat(url, F.lit(" 0.0.0.0 20080704120000 text/html 200 - - 0 pages.arc.gz "), size)).otherwise(
        F.concat(url, F.lit(" 0.0.0.0 20010912093000 text/html "), size))
    intro = {v: f"{v} 0 tidepool\n{names}\n" for v, names in (
        (1, "URL IP-address Archive-date Content-type Archive-length"),
        (2, "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length"))}
    start = F.when(two, f"filedesc://pages.arc 0.0.0.0 20080704120000 text/plain 200 - - 0 pages.arc {len(intro[2])}\n{intro[2]}\n").otherwise(
        f"filedesc://pages.arc 0.0.0.0 20010912093000 text/plain {len(intro[1])}\n{intro[1]}\n")
    out = pages.select(F.concat(F.when(_first_in_file(), start).otherwise(""), line, F.lit("\n"), http).alias("value"))
    out.write.option("lineSep", "\n").option("compression", "gzip").text(arc_path)


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op1_arc_to_warc", SQL)
def op1_arc_to_warc(spark, sf_dir):
    """Every page as an ARC record, converted to WARC and read back."""
    home = f"{checkpoint_dir(spark)}/archives-{uuid.uuid4().hex}"
    write_arc(table(spark, sf_dir, "pages"), f"{home}/arc")
    convert(spark, f"{home}/arc", f"{home}/warc")
    out = resolved(read_warc(spark, f"{home}/warc"))
    return out.select(F.col("own").alias("page_id"), F.col("n").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
                      F.col("type").alias("record_type"), F.col("to_own").alias("refers_to"))
