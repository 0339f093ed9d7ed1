"""SimHash near-dedup with deletion-variant signatures.

Two 64-bit fingerprints that differ in at most 4 bits, cut into 3 segments, have a segment in which they
differ by at most one bit (3 segments with two bits each would be 6). So every fingerprint is
indexed under each of its segments with each single bit wiped out: 64 keys of (segment, wiped bit, other
bits). Near fingerprints share a key; an equality shuffle brings them together and the full 64 bits are
compared. Five segments, which plain block permutation needs, would leave only 12 bits in a key.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, stored
from . import query
from .common import keep_rows, map_rows, ship, table, text_hash
from .components import connected_components

SHINGLE = 4
DISTANCE = 4
SEED = 42


def simhash(text: str | None, width: int = SHINGLE) -> int:
    """The fingerprint of one text as a signed 64-bit integer; 0 if it has no words.

    A-Z are lower-cased, words are runs of anything but [\\x20\\x09-\\x0D], shingles are ``width`` words
    joined by a space, repeats included; fewer words make one shingle. A bit is set if more than half
    of the shingles' XXH64 (UTF-8, seed 42) have it.
    """
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII rules for both
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    ends = (ends - 1).tolist()
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    n = len(words) - width + 1
    for k in range(0, n, 8192):
        h = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts[k : min(n, k + 8192)], ends[k + width - 1 :])), "<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    fp = int(np.packbits(set_bits * 2 > n, bitorder="little").view("<u8")[0])
    return fp - (1 << 64) if fp >> 63 else fp


def segments(distance: int) -> list[tuple[int, int]]:
    """(lowest bit, bits) of the fewest segments of which one always differs in one bit at most."""
    k = distance // 2 + 1
    cuts = [64 * i // k for i in range(k + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def variants(fps: DataFrame, distance: int) -> DataFrame:
    """(key, fp): every fingerprint under each one-wildcard variant of its segments."""
    cut = [(lo, n, b) for lo, n in segments(distance) for b in range(n)]
    keep = [((1 << n) - 1) & ~(1 << b) for _, n, b in cut]
    at = F.explode(F.sequence(F.lit(0), F.lit(len(cut) - 1))).alias("v")
    rows = fps.select("fp", at)
    lows = F.array(*(F.lit(lo) for lo, _, _ in cut))
    masks = F.array(*(F.lit(m).cast("bigint") for m in keep))
    part = F.expr("shiftrightunsigned(fp, low)").bitwiseAND(F.col("mask"))
    rows = rows.select("fp", "v", F.get(lows, F.col("v")).alias("low"), F.get(masks, F.col("v")).alias("mask"))
    return rows.select((part * 64 + F.col("v")).alias("key"), "fp")


def link_run(fps: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that join what is within ``distance`` in one bucket of different fingerprints.

    A search from one member to another: a member found near is never compared as a target again, so a
    dense bucket of n costs about n comparisons and gives n - 1 links, not n * n of either.
    """
    left, links = fps.view(np.uint64), []
    while left.size > 1:
        todo, left = [left[0]], left[1:]
        while todo and left.size:
            x = todo.pop()
            near = np.bitwise_count(left ^ x) <= distance
            if near.any():
                found, left = left[near], left[~near]
                links.extend((x, y) for y in found)
                todo.extend(found)
    return links


def _bucket_links(distance: int, short: int = 12):
    """Over sorted (key, fp) batches: links of each bucket; a bucket may span batches."""
    import pyarrow as pa

    def links(keys, fps):
        n = len(keys)
        new = np.flatnonzero(np.diff(keys)) + 1
        first = np.concatenate(([0], new))
        size = np.diff(np.concatenate((first, [n])))
        a, b = [], []
        small = np.repeat(size <= short, size)
        for d in range(1, min(short, n)):
            near = (keys[:-d] == keys[d:]) & small[:-d]
            near[near] = np.bitwise_count((fps[:-d][near] ^ fps[d:][near]).view(np.uint64)) <= distance
            a.append(fps[:-d][near])
            b.append(fps[d:][near])
        for k in np.flatnonzero(size > short):
            found = link_run(fps[first[k] : first[k] + size[k]], distance)
            if found:
                pairs = np.array(found, np.uint64).view(np.int64)
                a.append(pairs[:, 0])
                b.append(pairs[:, 1])
        return np.concatenate(a) if a else fps[:0], np.concatenate(b) if b else fps[:0]

    def run(batches):
        names = ["src", "dst"]
        keys, fps = [], []

        def out(k, f):
            src, dst = links(k, f)
            if len(src):
                both = np.unique(np.stack((np.minimum(src, dst), np.maximum(src, dst)), 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=names)

        for batch in batches:
            k, f = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(k):
                continue
            cut = np.searchsorted(k, k[-1])  # the last bucket may go on in the next batch
            keys.append(k[:cut] if cut else k)
            fps.append(f[:cut] if cut else f)
            if cut:
                yield from out(np.concatenate(keys), np.concatenate(fps))
                keys, fps = [k[cut:]], [f[cut:]]
        if keys:
            yield from out(np.concatenate(keys), np.concatenate(fps))

    return run


def near_links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(src, dst) links that connect all different fingerprints within ``distance`` bits (column fp)."""
    ship(fps.sparkSession)
    dealt = variants(fps, distance).repartition("key").sortWithinPartitions("key", "fp")
    return dealt.mapInArrow(_bucket_links(distance), "src bigint, dst bigint").distinct()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE) -> DataFrame:
    """(id, text_hash, fp) of every row; a null text has no words."""
    kind = docs.schema[id_col].dataType.simpleString()
    picked = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), text_hash(text_col))
    return map_rows(picked, lambda rows: ((i, h, simhash(t, width)) for i, t, h in rows),
                    f"id {kind}, text_hash bigint, fp bigint")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                distance: int = DISTANCE) -> DataFrame:
    """(id, text_hash, fingerprint, component_id, root) for each row of ``docs``; root names the group itself.

    component_id is the smallest id among the rows reached by links of at most ``distance`` bits, the row's
    own included; null ids are passed over, and a group of null ids only has a null one. Null, empty and
    blank texts have fingerprint zero and link like any other. Repeated rows each get their row. An empty
    table gives an empty one. Other columns are not looked at.

    Copies collapse to one fingerprint in a combined aggregate before anything is indexed; what is joined
    back afterwards has one row a fingerprint, so adaptive execution can split the copies' side.
    """
    rows = cut_lineage(fingerprints(docs, id_col, text_col, width))
    distinct = cut_lineage(rows.groupBy("fp").agg(F.min("id").alias("least")))
    found = connected_components(near_links(distinct.select("fp"), distance))
    named = distinct.join(found, distinct["fp"] == found["node"], "left")
    named = named.select("fp", "least", F.coalesce("component", "fp").alias("root"))
    lowest = named.groupBy(F.col("root").alias("r")).agg(F.min("least").alias("component_id"))
    by_fp = named.join(lowest, named["root"] == lowest["r"]).select(F.col("fp").alias("f"), "component_id", "root")
    by_fp = stored(by_fp)  # a join right above an aggregate could not split the copies of a hot fingerprint
    return rows.join(by_fp, rows["fp"] == by_fp["f"]).select(
        F.col("id").alias(id_col), "text_hash", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = SHINGLE,
                     distance: int = DISTANCE) -> DataFrame:
    """``docs`` with one row of each near group: that with the smallest id (null last), then text hash."""
    groups = near_groups(docs, id_col, text_col, width, distance)
    first = F.min(F.struct(F.isnull(id_col).alias("u"), F.col(id_col), F.col("text_hash"))).alias("first")
    return keep_rows(docs, groups.groupBy("root").agg(first).select("first.*"), id_col, text_col)


@query("op7_simhash_near_dedup")
def op7_simhash_near_dedup(spark, sf_dir):
    """Near groups over every row and whole text of documents: 4 words, 4 bits."""
    return near_groups(table(spark, sf_dir, "documents")).drop("text_hash", "root")
