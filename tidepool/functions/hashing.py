"""Digests, roles, MIME types and fixity lines (H1, H3-H5, E1; H2 lives with the provenance log)."""

from __future__ import annotations

import itertools

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidepool import fixed


def sha256_hex(c: Column) -> Column:
    """H1: SHA-256 of bytes (or of UTF-8 text) as lower-case hex."""
    return F.sha2(c, 256)


def role_of(path: Column) -> Column:
    """H3: role of an archive path by its leading directory."""
    expr = None
    for prefix, role in fixed.ROLES:
        cond = path.startswith(prefix)
        expr = F.when(cond, F.lit(role)) if expr is None else expr.when(cond, F.lit(role))
    return expr.otherwise(F.lit(fixed.OTHER_ROLE))


def extension_of(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"\.([^./]+)$", 1))


def mime_of(path: Column, default: str = fixed.DEFAULT_DATA_MIME) -> Column:
    """H4: MIME type by extension, ``default`` when unknown."""
    lookup = F.create_map(*[F.lit(x) for x in itertools.chain.from_iterable(fixed.MIME_TYPES)])
    inner = F.regexp_replace(path, rf"\.({'|'.join(fixed.COMPRESSIONS)})$", "")
    return F.coalesce(F.element_at(lookup, extension_of(inner)), F.lit(default))


def fixity_line(path: Column, digest: Column) -> Column:
    """H5: BSD-style checksum line."""
    return F.format_string("SHA256 (%s) = %s", path, digest)


def is_utf8(content: Column) -> Column:
    """Bytes decode as UTF-8 (ASCII is a subset)."""
    return F.is_valid_utf8(content.cast("string"))
