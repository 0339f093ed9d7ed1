"""The Merkle manifest against a tree built level by level in memory."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidepool.llm import merkle

FIELDS = ["doc_id", "source", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[k : k + 16]) for k in range(0, len(below), 16)])
    return levels


def path(levels, k):
    for below in levels[:-1]:
        first = k - k % 16
        yield below[first:k], below[k + 1 : first + 16]
        k //= 16


def expected(rows, tampered):
    """{(leaf, place among equals): (id, subroot, root, siblings, folded)} of rows (doc_id, source, text)."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[g] = tree([leaf(*r) for r in groups[g]])
    top, out = tree([trees[g][-1][0] for g in names]), []
    for i, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            node, siblings = leaf(*tampered(r)), []
            for before, after in [*path(trees[g], k), *path(top, i)]:
                node = h(*before, node, *after)
                siblings += before + after
            out.append((r[0], leaf(*r), trees[g][-1][0], top[-1][0], h(*siblings), node, node == top[-1][0], siblings))
    return out


def key(r):
    return (r[0] is not None, r[0] or 0, *r[1:7])


def check(spark, rows, local):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, source string, text string, leaf string, rank int")
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.when(hit, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    got = merkle.manifest(docs.repartition(5), FIELDS, offered={"text": lower}, local=local)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified", "siblings"]

    def tampered(r):
        if r[0] is None or r[2] is None or zlib.crc32(str(r[0]).encode()) % 5:
            return r
        return (*r[:2], "".join(c.lower() if c.isascii() else c for c in r[2]))

    want = sorted(expected(rows, tampered), key=key)
    assert sorted(map(tuple, got.collect()), key=key) == want
    return want


@pytest.mark.parametrize("local", [0, 1, 3])
def test_groups_of_all_sizes(spark, local):
    sizes = {"one": 1, "full": 16, "more": 17, None: 40, "": 3, "deep": 300, "É": 257, "z": 2, **{f"s{k:02d}": 1 + k % 3 for k in range(30)}}
    if not local:
        sizes |= {"deep": 60, "É": 33}
    rows, n = [], 0
    for g, size in sizes.items():
        for _ in range(size):
            rows.append((n * 7 % 10007, g, None if n % 11 == 0 else f"Text É {n}"))
            n += 1
    want = check(spark, rows, local)
    assert 0 < sum(not r[6] for r in want) < len(want)  # lower-casing shows


def test_odd_rows(spark):
    rows = [(None, None, None), (None, "a", "X" * 300_000), (1, "a", ""), (1, "a", ""), (1, "a", "other"), (2, None, "É" * 1000), (5, "a", None)] + [(9, "b", "Same")] * 40
    check(spark, rows, 1)
    check(spark, rows, 3)


def test_one_leaf_and_none(spark):
    want = check(spark, [(4, "a", "t")], 3)
    assert want[0][1] == want[0][2] == want[0][3]  # a lone leaf is the root
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    assert merkle.manifest(docs, FIELDS).count() == 0


def test_stand_ins_are_dealt_in_short_steps(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STRETCH", 4)
    got = merkle._stand_ins(spark.createDataFrame([(2, 3, 50, "a"), (0, 60, 60, "b"), (0, 1, 1, "c")], "t long, c long, widest long, n string"))
    assert {(r["n"], r["at"]) for r in got.collect()} == {("a", x) for x in range(2, 50, 3)} | {("b", 0), ("c", 0)}
    assert got.count() == 18
