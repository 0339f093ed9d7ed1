"""Secret scan with structural confirmation.

Three plain patterns find candidates (assignments, access-key ids, hex runs). Beyond them, runs that look like
base64, hex or PEM are decoded and parsed: a DER key must have nested lengths that end where their parents end, an
OpenSSH key its length-prefixed fields, a signed token a JSON header that names an algorithm. Only what
parses is reported, under a kind of its own; the spans of the plain patterns always stay.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import query
from .common import map_rows, table, text_hash

KINDS = ("assign", "access", "hex", "pem", "token", "der", "openssh")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # as AKIA[A-Z0-9]+ of 20 or more: no later start in a run is longer
_HEX = re.compile(r"[0-9a-f]{24,}")
_PEM = re.compile(r"-----BEGIN ((?:[A-Z0-9]+ )*PRIVATE KEY)-----([A-Za-z0-9+/=\s]*)-----END \1-----", re.A)
_TOKEN = re.compile(r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
_BASE64 = re.compile(r"[A-Za-z0-9+/]{40,}={0,2}")
_LONG_HEX = re.compile(r"[0-9A-Fa-f]{64,}")


def _der_length(data: bytes, at: int) -> tuple[int, int] | None:
    """(content start, content end) of the DER value at ``at``; None if its length is malformed."""
    if at + 2 > len(data):
        return None
    n, at = data[at + 1], at + 2
    if n >= 0x80:
        k = n & 0x7F
        if not 1 <= k <= 4 or at + k > len(data):
            return None
        n, at = int.from_bytes(data[at : at + k], "big"), at + k
        if n < 0x80 or n >> 8 * (k - 1) == 0:  # DER takes the shortest form
            return None
    return (at, at + n) if at + n <= len(data) else None


def _der_values(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, content start, content end) of the values that fill [start, end) exactly."""
    out = []
    while start < end:
        span = _der_length(data, start)
        if span is None or span[1] > end:
            return None
        out.append((data[start], *span))
        start = span[1]
    return out


def is_der_key(data: bytes) -> bool:
    """A private key in DER: PKCS #1 (integers alone), PKCS #8 or SEC 1, with lengths that nest exactly."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    outer = _der_values(data, 0, len(data))
    if not outer or len(outer) != 1:
        return False
    inner = _der_values(data, *outer[0][1:])
    if not inner or len(inner) < 2 or inner[0][0] != 2 or inner[0][2] - inner[0][1] != 1 or data[inner[0][1]] > 1:
        return False
    tags = [t for t, _, _ in inner]
    if len(inner) >= 9 and set(tags[:9]) == {2}:
        return True
    if len(inner) >= 3 and tags[1] == 0x30 and tags[2] == 4:  # PKCS #8: algorithm, then the key
        algorithm = _der_values(data, *inner[1][1:])
        return bool(algorithm) and algorithm[0][0] == 6
    return tags[1] == 4 and data[inner[0][1]] == 1 and inner[1][2] - inner[1][1] in (24, 28, 32, 48, 66)


def is_openssh_key(data: bytes) -> bool:
    """The magic, then cipher, KDF and its options as length-prefixed fields, a count of keys and as many fields."""
    if not data.startswith(b"openssh-key-v1\0"):
        return False
    at, fields = 15, []

    def field():
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + n > len(data):
            raise ValueError
        at += 4 + n
        return data[at - n : at]

    try:
        fields = [field() for _ in range(3)]
        count = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if not 1 <= count <= 16:
            return False
        for _ in range(count + 1):
            field()
    except ValueError:
        return False
    return bool(fields[0] and fields[1])


def _unbase64(text: str) -> bytes | None:
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(text: str) -> bool:
    """header.claims.signature: the header a JSON object with an algorithm, the claims a JSON object."""
    try:
        head, claims, sign = text.split(".")
        head, claims = (json.loads(base64.urlsafe_b64decode(p + "=" * (-len(p) % 4))) for p in (head, claims))
    except (binascii.Error, ValueError, RecursionError):
        return False
    if not isinstance(head, dict) or not isinstance(claims, dict) or not isinstance(head.get("alg"), str):
        return False
    return bool(sign) != (head["alg"].lower() == "none")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the plain patterns: leftmost, non-overlapping within a kind, in code points."""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)] if "AKIA" in text else []
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of candidates that decode and parse as a key or a signed token."""
    out = []
    if "PRIVATE KEY-----" in text:
        for m in _PEM.finditer(text):
            data = _unbase64("".join(m[2].split()))
            if data and (is_openssh_key(data) if m[1] == "OPENSSH PRIVATE KEY" else
                         is_der_key(data) or m[1] == "ENCRYPTED PRIVATE KEY" and _der_values(data, 0, len(data))):
                out.append((m.start(), 3, m.end()))
    if "eyJ" in text:
        out += [(m.start(), 4, m.end()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])]
    for m in _BASE64.finditer(text):
        data = _unbase64(m[0])
        if data and data[:1] == b"0" and is_der_key(data):
            out.append((m.start(), 5, m.end()))
        elif data and is_openssh_key(data):
            out.append((m.start(), 6, m.end()))
    for m in _LONG_HEX.finditer(text):
        data = bytes.fromhex(m[0][: len(m[0]) & ~1])
        if data[:1] == b"0" and is_der_key(data):
            out.append((m.start(), 5, m.start() + 2 * len(data)))
    return sorted(out)


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, spans, base) for each row: arrays of (kind, start, end, confirmed), over whole texts.

    Offsets are code points, ends exclusive, order is start, then kind. A plain span counts as confirmed if a parsed
    one overlaps it. Null and empty texts have none; repeated rows each get their row; an empty table gives an
    empty one; other columns are not looked at. One scan, no shuffle.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows):
        for i, text, h in rows:
            base, extra = base_spans(text or ""), confirmed_spans(text or "")
            spans = [{"kind": KINDS[k], "start": a, "end": b,
                      "confirmed": k > 2 or any(a < d and c < b for c, _, d in extra)} for a, k, b in sorted(base + extra)]
            yield i, h, spans, _listed(base), _listed(sorted(base + extra))

    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), text_hash(text_col))
    return map_rows(picked, run, f"`{id_col}` {kind}, text_hash bigint, "
                    "spans array<struct<kind: string, start: int, end: int, confirmed: boolean>>, base string, listed string")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span, overlapping ones together, replaced by ``mask``; all columns as they were."""
    from .common import ship

    @F.pandas_udf("string")
    def masked(texts):
        def one(text):
            if text is None:
                return None
            out, at = [], 0
            for a, _, b in sorted(base_spans(text) + confirmed_spans(text)):
                if a >= at:
                    out += [text[at:a], mask]
                at = max(at, b)
            return "".join(out) + text[at:]

        return texts.map(one)

    ship(docs.sparkSession)
    return docs.withColumn(text_col, masked(F.col(f"`{text_col}`")))


@query("op2_secret_scan")
def op2_secret_scan(spark, sf_dir):
    """Secrets in every whole text of documents."""
    found = secret_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id", *(count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")), F.sha2("base", 256).alias("base_sha256"),
        F.col("listed").alias("spans"), F.size(F.filter("spans", lambda s: s["confirmed"])).cast("bigint").alias("n_confirmed"))
