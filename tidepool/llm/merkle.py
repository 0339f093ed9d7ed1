"""Merkle manifest of a dataset by butterfly exchange.

Every row is a leaf. Leaves of a group, in order of id, form a tree of fanout 16, the groups' subroots, in
order of group, another one above it. Leaves are dealt out in aligned blocks of 16^3, whose trees are
small and local. Then the blocks swap: in round r the 16 neighbouring subtrees of 16^r blocks each meet, the
t-th block of one with the t-th block of every other, and each of them hashes the common ancestor for
itself. After the last round every block holds the root and all siblings on its way up, so nothing is sent
down again. Where subtrees of a run have unequal numbers of blocks (the last of a group, groups of
different size), a smaller one stands in for the missing partners in turn, so a meeting has 16 parties at
most and all meetings of a round are alike in size, whatever group is hot.
"""

from __future__ import annotations

import hashlib
from functools import partial
from itertools import groupby

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from . import query
from .common import map_rows, table

FANOUT = 16
LOCAL = 3  # levels of a block: 4,096 leaves
STRETCH = 4096  # stand-ins made at a time


def digest_of(*columns: Column) -> Column:
    """Lower-case hex SHA-256 of the columns, each ``-`` if null, else UTF-8 byte count, ``:`` and value."""
    texts = (c.cast("string") for c in columns)
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts)), 256)


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def local_levels(leaves: list[str], closed: bool, local: int = LOCAL) -> list[list[str]]:
    """The levels of one block, leaves first. ``closed``: its group has no other block, so it stops at one node."""
    levels = [leaves]
    while len(levels) <= local and not (closed and len(levels[-1]) == 1):
        below = levels[-1]
        levels.append([_hash(*below[k : k + FANOUT]) for k in range(0, len(below), FANOUT)])
    return levels


def _roots(local, rows):
    """(rank, block, root) of blocks; rows come sorted by rank, block and place."""
    for (rank, block), leaves in groupby(rows, lambda r: r[:2]):
        leaves = list(leaves)
        yield rank, block, local_levels([r[4] for r in leaves], leaves[0][3] == 1, local)[-1][0]


def _proved(local, rows):
    """Each leaf with its proof; a block's own row, with what it met above, comes before its leaves."""
    for _, block in groupby(rows, lambda r: r[:2]):
        head, *leaves = block
        above, subroot, root = head[7], head[8], head[9]
        levels = local_levels([r[4] for r in leaves], head[3] == 1, local)
        for k, (_, _, _, _, leaf, offered, doc_id, *_) in enumerate(leaves):
            node, siblings = offered, []
            for below in levels[:-1]:
                first = k - k % FANOUT
                before, after = below[first:k], below[k + 1 : first + FANOUT]
                siblings += before + after
                node = _hash(*before, node, *after)
                k //= FANOUT
            for met in above:
                at, others = 64 * met["digit"], met["others"]
                node = _hash(others[:at], node, others[at:])
                siblings.append(others)
            proof = "".join(siblings)
            siblings = [proof[i : i + 64] for i in range(0, len(proof), 64)]
            yield doc_id, leaf, subroot, root, _hash(proof), node, node == root, siblings


def ranked_leaves(leaves: DataFrame, local: int = LOCAL) -> tuple[DataFrame, DataFrame]:
    """Places of leaves(g, id, leaf, offered) in their groups, and one row a group.

    One range shuffle by (g, id, leaf) and counts by (range, group): no window sees more than the ranges of
    a group, or one row a range. Returns (rank, block, place, blocks, leaf, offered, id) and
    (rank, blocks), where rank is the place of the group among the groups.
    """
    order = ("g", "id", "leaf", "tie")
    rows = leaves.withColumn("tie", F.monotonically_increasing_id())  # equal rows need not share a range
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
    rows = stored(rows.withColumn("at", F.monotonically_increasing_id())).withColumn("range", F.shiftright("at", 33))
    spans = rows.groupBy("g", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    group = Window.partitionBy("g")
    spans = stored(spans.select("g", "range", "first", (F.sum("n").over(group.orderBy("first")) - F.col("n")).alias("before"),
                                F.sum("n").over(group).alias("leaves")))
    groups = spans.groupBy("g").agg(F.min("first").alias("start"), F.max("leaves").alias("leaves"))
    groups = groups.withColumn("opens", F.shiftright("start", 33))
    ranges = groups.groupBy(F.col("opens").alias("o")).agg(F.count("*").alias("n"))  # a row a range at most
    ranges = ranges.select("o", (F.sum("n").over(Window.orderBy("o")) - F.col("n")).alias("earlier"))
    rank = F.row_number().over(Window.partitionBy("opens").orderBy("start")) - 1 + F.col("earlier")
    groups = groups.join(ranges, F.col("opens") == F.col("o")).select(
        F.col("g").alias("gg"), rank.alias("rank"), F.ceil(F.col("leaves") / FANOUT**local).alias("blocks"))
    groups = stored(groups)
    spans = stored(spans.join(groups, spans["g"].eqNullSafe(groups["gg"])).select(
        F.col("g").alias("sg"), F.col("range").alias("sr"), "first", "before", "rank", "blocks"))
    place = F.col("at") - F.col("first") + F.col("before")
    placed = rows.join(spans, rows["g"].eqNullSafe(spans["sg"]) & (rows["range"] == spans["sr"])).select(
        "rank", F.floor(place / FANOUT**local).alias("block"), place.alias("place"), "blocks", "leaf", "offered", "id")
    return placed, groups.select("rank", "blocks")


def _stand_ins(nodes: DataFrame) -> DataFrame:
    """Each node at its own place t and, while the run's widest subtree goes on, at t + c, t + 2c and so on."""
    far = F.col("step") * STRETCH
    # a short step at a time, so that no row holds a list that grows with the run
    nodes = nodes.withColumn("step", F.col("c")).withColumn("from", F.explode(F.sequence("t", F.col("widest") - 1, far)))
    last = F.least(F.col("widest") - 1, F.col("from") + far - F.col("step"))
    return nodes.withColumn("at", F.explode(F.sequence("from", last, F.col("step")))).drop("step", "from")


def swap(nodes: DataFrame, tree: Column, a: Column, active: Column, carried: tuple[str, ...]) -> DataFrame:
    """One round: nodes that hold a subtree's root ``h`` meet the others of their run of 16 and hash their ancestor.

    ``a`` is the subtree's place in its level, ``t`` and ``c`` the block's place in the subtree and the
    subtree's number of blocks, ``widest`` the run's greatest c. Where not ``active`` a node stays as it is.
    """
    active = F.coalesce(active, F.lit(False))
    nodes = nodes.withColumns({"active": active, "digit": F.when(active, a % FANOUT).otherwise(0),
                               "tree": F.when(active, tree), "run": F.when(active, F.floor(a / FANOUT)),
                               "widest": F.when(active, F.col("widest")).otherwise(F.col("t") + 1)})
    own = F.when(F.col("at") == F.col("t"), F.struct(*carried, "proof"))
    # a node at rest meets nobody: its block tells its key from all others
    key = F.when(~F.col("active"), F.struct("rank", "block"))
    parties = _stand_ins(nodes).groupBy("active", "tree", "run", key.alias("alone"), "at").agg(
        F.array_sort(F.collect_list(F.struct("digit", "h", "c", own.alias("own")))).alias("m"))
    parent = F.sha2(F.array_join(F.transform("m", lambda x: x["h"]), ""), 256)
    met = parties.select("active", "at", "m", parent.alias("parent"),
                         F.explode(F.filter("m", lambda x: x["own"].isNotNull())).alias("me"))
    others = F.array_join(F.transform(F.filter("m", lambda x: x["digit"] != F.col("me.digit")), lambda x: x["h"]), "")
    earlier = F.filter("m", lambda x: x["digit"] < F.col("me.digit"))
    count = lambda of: F.aggregate(of, F.lit(0).cast("bigint"), lambda s, x: s + x["c"])
    here = F.array(F.struct(F.col("me.digit").cast("int").alias("digit"), others.alias("others")))
    return met.select(
        *(F.col(f"me.own.{x}").alias(x) for x in carried),
        F.when(F.col("active"), F.concat("me.own.proof", here)).otherwise(F.col("me.own.proof")).alias("proof"),
        F.when(F.col("active"), F.col("parent")).otherwise(F.col("me.h")).alias("h"),
        F.when(F.col("active"), F.col("at") + count(earlier)).otherwise(F.col("at")).alias("t"),
        F.when(F.col("active"), count(F.col("m"))).otherwise(F.col("me.c")).alias("c"))


def climb(roots: DataFrame, groups: DataFrame) -> DataFrame:
    """(rank, block, blocks, proof, subroot, root) of roots(rank, block, h), by rounds of swaps.

    Within groups the widths follow from the number of blocks; above them one small table a level has the
    widest subtree of each run. The number of rounds is a logarithm of the blocks and of the groups.
    """
    most, n = groups.agg(F.max("blocks"), F.count("*")).first()
    wide, level, size = groups.withColumn("widths", F.array().cast("array<bigint>")), groups.toDF("a", "c"), 1
    while size < n:
        size *= FANOUT
        level = level.groupBy(F.floor(F.col("a") / FANOUT).alias("a")).agg(F.sum("c").alias("c"), F.max("c").alias("w"))
        found = level.select(F.col("a").alias("up"), "w")
        wide = wide.join(found, F.floor(F.col("rank") / size) == F.col("up")).select(
            "rank", "blocks", F.concat("widths", F.array("w")).alias("widths"))
        level = level.select("a", "c")
    wide = stored(wide.withColumnsRenamed({"rank": "r", "blocks": "blocks"}))
    nodes = roots.join(wide, roots["rank"] == wide["r"]).select(
        "rank", "block", "blocks", "widths", "h", F.array().cast("array<struct<digit:int,others:string>>").alias("proof"))
    carried, size = ("rank", "block", "blocks", "widths"), 1
    while size < (most or 0):
        a = F.floor(F.col("block") / size)
        left = F.col("blocks") - F.floor(a / FANOUT) * size * FANOUT  # blocks of the group from this run on
        nodes = nodes.withColumns({"t": F.col("block") % size, "c": F.least(F.lit(size), F.col("blocks") - a * size),
                                   "widest": F.least(F.lit(size), left)})
        nodes = swap(nodes, F.col("rank"), a, F.col("blocks") > size, carried)
        size *= FANOUT
    nodes = nodes.withColumns({"subroot": F.col("h"), "t": F.col("block"), "c": F.col("blocks")})
    size, k = 1, 0
    while size < n:
        nodes = nodes.withColumn("widest", F.get("widths", F.lit(k)))
        nodes = swap(nodes, F.lit(0), F.floor(F.col("rank") / size), F.lit(True), (*carried, "subroot"))
        size, k = size * FANOUT, k + 1
    return nodes.select("rank", "block", "blocks", "proof", "subroot", F.col("h").alias("root"))


def manifest(docs: DataFrame, fields: list[str], id_col: str = "doc_id", group_col: str = "source",
             offered: dict[str, Column] | None = None, local: int = LOCAL) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified, siblings) for each row of ``docs``.

    A leaf is the digest of ``fields``. ``offered`` gives fields another value, as a copy under test would
    have it; folded_root is made of that row's digest and the original siblings, and verified says whether
    it is the root. ``siblings`` are the hexadecimal digests from the leaf's run up to the root's, left to right.

    A null field is ``-``, an empty text ``0:``. Null groups are one group, the first; within a group null ids
    come first, and rows of equal id are ordered by digest, so equal rows are leaves side by side, each with
    its own proof. ``local`` is the number of levels that a block hashes by itself. An empty table gives an empty one. Columns that are not named are not looked at.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    col = lambda c: F.col(f"`{c}`")
    leaf = digest_of(*map(col, fields))
    other = digest_of(*((offered or {}).get(c, col(c)) for c in fields)) if offered else leaf
    leaves, groups = ranked_leaves(docs.select(
        col(group_col).alias("g"), col(id_col).alias("id"), leaf.alias("leaf"), other.alias("offered")), local)
    dealt = leaves.select("rank", "block", "place", "blocks", "leaf").repartition("rank", "block")
    roots = stored(map_rows(dealt.sortWithinPartitions("rank", "block", "place"), partial(_roots, local),
                            "rank bigint, block bigint, h string"))
    up = climb(roots, groups)
    names = ["rank", "block", "place", "blocks", "leaf", "offered", "id", "proof", "subroot", "root"]
    heads = up.select("rank", "block", F.lit(-1).cast("bigint").alias("place"), "blocks", "proof", "subroot", "root")
    both = heads.unionByName(leaves, allowMissingColumns=True).select(*names)
    both = both.repartition("rank", "block").sortWithinPartitions("rank", "block", "place")
    return map_rows(both, partial(_proved, local), f"`{id_col}` {kind}, leaf string, subroot string, root string, proof_sha256 string, "
                    "folded_root string, verified boolean, siblings array<string>")


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _sql(levels: int = 5, above: int = 3) -> str:
    """The same in SQL, for up to 16^levels rows a source and 16^above sources."""
    part = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(part.format(c) for c in (*FIELDS[:-1], text)) + ")"
    # CRC-32 of the decimal id, a bit at a time (polynomial EDB88320, reflected)
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), "
           "lambda b: [ascii(b)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))), "
           "lambda s, x: xor(xor(s, x) >> 1, 3988292384 * (xor(s, x) & 1))), 4294967295)")
    ctes = [f"d AS (SELECT *, {crc} % 5 = 0 AS hit FROM documents)",
            f"l AS (SELECT doc_id, source AS g, {leaf('text')} AS leaf, CASE WHEN hit THEN "
            f"{leaf(f"translate(text, '{UPPER}', '{LOWER}')")} ELSE {leaf('text')} END AS offered FROM d)",
            "n0 AS (SELECT g, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS k, count(*) OVER (PARTITION BY g) AS n, "
            "leaf AS h, doc_id, offered FROM l)",
            "f0 AS (SELECT doc_id, g, k, n, h AS leaf, offered AS h, '' AS proof FROM n0)"]

    def tier(i: int, extra: str = "") -> None:
        up = "sha256(string_agg({0}, '' ORDER BY n.k))"
        ctes.append(f"n{i + 1} AS (SELECT g, k // 16 AS k, (n + 15) // 16 AS n, CASE WHEN n > 1 THEN {up.format('h')} "
                    f"ELSE min(h) END AS h FROM n{i} n GROUP BY g, k // 16, n)")
        ctes.append(f"f{i + 1} AS (SELECT f.doc_id, f.g, f.k // 16 AS k, (f.n + 15) // 16 AS n, f.leaf{extra}, CASE WHEN f.n > 1 THEN "
                    + up.format("CASE WHEN n.k = f.k THEN f.h ELSE n.h END") + " ELSE f.h END AS h, f.proof || "
                    f"coalesce(string_agg(n.h, '' ORDER BY n.k) FILTER (n.k <> f.k), '') AS proof FROM f{i} f JOIN n{i} n "
                    f"ON n.g IS NOT DISTINCT FROM f.g AND n.k // 16 = f.k // 16 GROUP BY f.doc_id, f.g, f.k, f.n, f.leaf{extra}, f.h, f.proof)")

    for i in range(levels):
        tier(i)
    top = levels + 1
    ctes.append(f"s AS (SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS k, count(*) OVER () AS n FROM n{levels})")
    ctes.append(f"n{top} AS (SELECT 0 AS g, k, n, h FROM s)")
    ctes.append(f"f{top} AS (SELECT f.doc_id, 0 AS g, s.k, s.n, f.leaf, s.h AS subroot, f.h, f.proof FROM f{levels} f "
                "JOIN s ON s.g IS NOT DISTINCT FROM f.g)")
    for i in range(top, top + above):
        tier(i, ", f.subroot")
    end = top + above
    return (f"WITH {', '.join(ctes)} SELECT f.doc_id, f.leaf, f.subroot, n.h AS root, sha256(f.proof) AS proof_sha256, "
            f"f.h AS folded_root, f.h = n.h AS verified FROM f{end} f CROSS JOIN n{end} n")


@query("op11_merkle_manifest", _sql())
def op11_merkle_manifest(spark, sf_dir):
    """Proofs of every row of documents, folded with a copy whose texts are lower-cased where 5 divides crc32(doc_id)."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    tampered = F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    return manifest(table(spark, sf_dir, "documents"), FIELDS, offered={"text": tampered}).drop("siblings")
