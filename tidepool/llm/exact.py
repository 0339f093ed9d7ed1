"""Exact dedup by polynomial fingerprints that compose.

The fingerprint of bytes b is the sum of b[i] * 256^(n-1-i) modulo a prime of about 127 bits. For a text
cut in chunks it composes: fp(x + y) = fp(x) * 256^len(y) + fp(y), so texts of more than PIECE characters are cut
in pieces that are hashed apart, in any task, and joined afterwards (``combine``, ``combine_pieces``); only the SHA-256
of a text, which does not compose, runs over it from end to end. Texts with equal length and fingerprint are then compared chunk by chunk with one text of their group, as rows of Spark, so neither
a group nor a text pair is ever gathered in one task.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored
from . import query
from .common import WHITE, keep_rows, map_rows, table, text_hash

CHUNK = 1 << 16  # bytes hashed, and compared, at a time
PIECE = 1 << 20  # code points of a text that are hashed in one task
SALT_ROWS = 128  # members of a group that share one copy of the text they are compared with


def _prime_from(n: int) -> int:
    """The least probable prime >= n (n odd and large), by Miller-Rabin with fixed bases."""

    def passes(p: int, a: int) -> bool:
        d, s = p - 1, 0
        while d % 2 == 0:
            d, s = d // 2, s + 1
        x = pow(a, d, p)
        return x in (1, p - 1) or any((x := x * x % p) == p - 1 for _ in range(s - 1))

    while not all(passes(n, a) for a in (2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37)):
        n += 2
    return n


PRIME = _prime_from(3**80)


def combine(x: tuple[int, int], y: tuple[int, int]) -> tuple[int, int]:
    """(length, fingerprint) of two adjoining chunks taken together."""
    return x[0] + y[0], (x[1] * pow(256, y[0], PRIME) + y[1]) % PRIME


def fingerprint(data: bytes, chunk: int = CHUNK) -> tuple[int, int]:
    """(length, fingerprint) of bytes, chunk by chunk."""
    whole = (0, 0)
    for k in range(0, len(data), chunk):
        part = data[k : k + chunk]
        whole = combine(whole, (len(part), int.from_bytes(part, "big") % PRIME))
    return whole


def combine_pieces(pieces: DataFrame, key: str, order: str, data: str) -> DataFrame:
    """(key, n_bytes, fp) of documents given as many rows of pieces, hashed in parallel.

    ``order`` sorts a document's pieces, ``data`` holds their bytes (null: none). One small (length,
    fingerprint) pair a piece is gathered, in order; the pieces' bytes never are. Pieces that repeat key, order and
    bytes count once.
    """
    parts = map_rows(pieces.select(key, order, data),
                     lambda rows: ((k, o, *_pair(d or b"")) for k, o, d in rows),
                     f"_k {pieces.schema[key].dataType.simpleString()}, _o {pieces.schema[order].dataType.simpleString()}, _n bigint, _fp string")
    parts = parts.distinct()
    lists = parts.groupBy("_k").agg(F.array_sort(F.collect_list(F.struct("_o", "_n", "_fp"))).alias("_l"))

    def fold(rows):
        for k, l in rows:
            whole = (0, 0)
            for x in l:
                whole = combine(whole, (x["_n"], int(x["_fp"], 16)))
            yield k, whole[0], f"{whole[1]:032x}"

    return map_rows(lists, fold, f"`{key}` {pieces.schema[key].dataType.simpleString()}, n_bytes bigint, fp string")


def _pair(data: bytes) -> tuple[int, str]:
    n, fp = fingerprint(data)
    return n, f"{fp:032x}"


def normalised(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").translate(None, WHITE)


def _described(rows):
    for doc_id, text, h in rows:
        data, points = normalised(text), len(text or "")
        pair = _pair(data) if points <= PIECE else (None, None)
        yield doc_id, h, points, *pair, hashlib.sha256(data).hexdigest()


def _long_pairs(picked: DataFrame) -> DataFrame:
    """(key, n_bytes, fp) of the texts longer than PIECE, from pieces dealt out over all tasks; key: (id, text_hash)."""
    size = F.length("text")
    at = F.explode(F.sequence(F.lit(0), F.floor((size - 1) / PIECE).cast("int"))).alias("k")
    cut = picked.where(size > PIECE).select(F.struct("id", "text_hash").alias("key"), "text", at)
    cut = cut.select("key", "k", F.substring("text", F.col("k") * PIECE + 1, F.lit(PIECE)).alias("piece"))
    cut = cut.repartition("key", "k")
    return combine_pieces(cut.withColumn("data", F.translate("piece", WHITE.decode(), "").cast("binary")), "key", "k", "data")


def _pieces(rows):
    """Bytes of a text that is compared, in chunks; other texts under a repeated id are left out."""
    for h, text, group, n, salts, role in rows:
        data = normalised(text)
        if len(data) != n:
            continue
        for salt in salts:
            for k in range(0, len(data), CHUNK):
                yield group, salt, k // CHUNK, h, role, data[k : k + CHUNK]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text_hash, keep_id, group_size, kept, text_sha256) for each row of ``docs``.

    Texts are equal when they are so after deleting [\\x20\\x09-\\x0D]; a null text counts as empty, and all
    empty texts are one group. Of a group stays the row with the most code points, then the smallest id
    (a null id comes last, as the greatest). Rows that repeat both id and text are told apart by place:
    one of them stays and all count in group_size. An empty table gives an empty table. Columns beside the
    two named are neither read nor looked at.

    A group's size only ever meets combined aggregates and joins with one row a key on the other side,
    which adaptive execution splits; compared texts are dealt out by salts of 128 members.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                         text_hash(text_col).alias("text_hash"))
    meta = map_rows(picked.select("id", "text", "text_hash"), _described,
                    f"id {kind}, text_hash bigint, points bigint, n_bytes bigint, fp string, sha string")
    meta = meta.withColumn("row", F.monotonically_increasing_id())
    long = _long_pairs(picked).withColumnsRenamed({"n_bytes": "ln", "fp": "lfp"})
    on = F.col("n_bytes").isNull() & F.col("id").eqNullSafe(F.col("key.id")) & F.col("text_hash").eqNullSafe(F.col("key.text_hash"))
    meta = cut_lineage(meta.join(stored(long), on, "left").select(
        "id", "text_hash", "points", F.coalesce("n_bytes", "ln").alias("n_bytes"), F.coalesce("fp", "lfp").alias("fp"), "sha", "row"))

    order = F.struct((-F.col("points")).alias("p"), F.isnull("id").alias("u"), F.col("id"), F.col("row"))
    sums = meta.groupBy("fp", "n_bytes").agg(F.count("*").alias("size"), F.min(order).alias("best"))
    # groups are written before they are joined: a join right above their aggregate could not split a hot one
    many = stored(sums.where("size > 1").withColumnsRenamed({"fp": "gfp", "n_bytes": "gn"}))
    same = (meta["fp"] == many["gfp"]) & (meta["n_bytes"] == many["gn"])

    # chunkwise comparison of each member with the text that would stay
    salts = F.ceil(F.col("size") / SALT_ROWS).cast("int")
    members = meta.join(many, same).select(
        "id", "text_hash", "gfp", "gn", (F.col("row") == F.col("best.row")).alias("chosen"), salts.alias("salts"))
    wanted = members.select(
        F.col("id").alias("wid"), F.col("text_hash").alias("wh"), "gfp", "gn", "chosen",
        F.when(F.col("chosen"), F.sequence(F.lit(0), F.col("salts") - 1))
        .otherwise(F.array(F.pmod(F.xxhash64("id", "text_hash"), F.col("salts")).cast("int"))).alias("salts"),
    ).where("gn > 0").distinct()
    on = picked["id"].eqNullSafe(wanted["wid"]) & picked["text_hash"].eqNullSafe(wanted["wh"])
    pieces = map_rows(  # texts stream past the keys of those that are wanted; they are not sorted
        picked.join(wanted.hint("shuffle_hash"), on).select("text_hash", "text", "gfp", "gn", "salts", "chosen"), _pieces,
        "gfp string, salt int, k bigint, h bigint, chosen boolean, data binary")
    ours = pieces.where("not chosen").select(F.col("gfp").alias("f"), F.col("salt").alias("s"), F.col("k").alias("i"), "h", F.col("data").alias("d"))
    theirs = pieces.where("chosen").select("gfp", "salt", "k", "data").distinct()
    on = (ours["f"] == theirs["gfp"]) & (ours["s"] == theirs["salt"]) & (ours["i"] == theirs["k"])
    unequal = ours.join(theirs, on, "left").where(~F.col("d").eqNullSafe(F.col("data")))
    odd = cut_lineage(unequal.select(F.col("f").alias("ofp"), F.col("h").alias("oh")).distinct())

    # a fingerprint shared by different texts: those that differ from the compared one go by their digest
    on = (meta["fp"] == odd["ofp"]) & meta["text_hash"].eqNullSafe(odd["oh"])
    marked = meta.join(odd, on, "left").withColumn("other", F.when(F.col("ofp").isNotNull(), F.col("sha")).otherwise(""))
    marked = marked.select("id", "text_hash", "points", "fp", "n_bytes", "sha", "row", "other")
    final = marked.groupBy("fp", "n_bytes", "other").agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    final = stored(final.withColumnsRenamed({"fp": "gfp", "n_bytes": "gn", "other": "go"}))
    on = (marked["fp"] == final["gfp"]) & (marked["n_bytes"] == final["gn"]) & (marked["other"] == final["go"])
    return marked.join(final, on).select(
        F.col("id").alias(id_col), "text_hash", F.col("best.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("best.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    return keep_rows(docs, exact_groups(docs, id_col, text_col).where("kept"), id_col, text_col)


SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
r AS (SELECT doc_id, norm,
             first_value(doc_id) OVER w AS keep_id,
             row_number() OVER w AS rn,
             count(*) OVER (PARTITION BY norm) AS group_size
      FROM n WINDOW w AS (PARTITION BY norm ORDER BY points DESC, doc_id))
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, sha256(norm) AS text_sha256 FROM r
"""


@query("op10_exact_dedup", SQL)
def op10_exact_dedup(spark, sf_dir):
    """Exact groups over every row and whole text of documents."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("text_hash")
