"""Embedding near-dedup against all pairs of the same label in memory."""

import math

import numpy as np
import pytest

from tidepool.llm import flat_graph as g

COLUMNS = "vec_id bigint, embedding array<float>, label int, node bigint, shard string, links int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "s", 2, 3) for r in rows], COLUMNS).repartition(3)


def fit(v, label):
    return label is not None and bool(v) and all(c is not None and math.isfinite(c) for c in v) and any(v)


def expected(rows, cosine=0.98):
    """[(vec_id, links, smallest id reached)] in the order of rows, from plain loops over pairs."""
    x = [np.array(v, np.float32).astype(float) if fit(v, lab) else None for _, v, lab in rows]
    near = [[j for j in range(len(rows)) if j != i and x[i] is not None and x[j] is not None and rows[i][2] == rows[j][2] and len(x[i]) == len(x[j])
             and x[i] @ x[j] / math.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= cosine] for i in range(len(rows))]
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], len(near[i]), min(ids) if ids else None))
    return out


def key(r):
    return tuple((v is not None, v or 0) for v in r)


def check(spark, rows, least=1.0, **options):
    got = g.near_vectors(frame(spark, rows), **options).collect()
    want = sorted(expected(rows), key=key)
    assert len(got) == len(rows) and all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    have = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key)
    if least == 1.0:
        assert have == want
    else:
        by = {w[0]: w[1] for w in want}
        assert all(h[1] <= by[h[0]] for h in have)
        assert sum(h[1] for h in have) >= least * sum(by.values())
    return got


def vectors(rng, groups, size, spread, dim=24):
    return [[float(c) for c in centre + spread * rng.normal(size=dim) / math.sqrt(dim)]
            for centre in [(lambda c: c / np.linalg.norm(c))(rng.normal(size=dim)) for _ in range(groups)] for _ in range(size)]


def test_odd_rows(spark):
    a, b = [1.0, 0.5, 0.25], [1.0, 0.51, 0.25]
    rows = [(5, a, 1), (4, a, 1), (7, b, 1), (3, a, 2), (2, a, None), (None, b, 1), (None, [2.0, 1.0, 0.5], 1), (8, None, 1), (9, [], 1),
            (10, [0.0, 0.0, 0.0], 1), (10, [0.0, 0.0, 0.0], 1), (11, [float("nan"), 1.0, 1.0], 1), (12, [float("inf"), 1.0, 1.0], 1), (13, [None, 1.0, 1.0], 1),
            (14, [1.0, 0.5], 1), (15, [1.0, 0.5], 1), (16, [-1.0, -0.5, -0.25], 1), (7, b, 1), (17, [1e30, 0.5e30, 0.25e30], 1), (18, [1e-30, 0.5e-30, 0.25e-30], 1),
            (None, [0.0, 1.0, 0.0], 3), (None, [0.0, 1.0, 0.0], 3)]
    check(spark, rows)
    assert g.near_vectors(frame(spark, [])).count() == 0
    none = g.near_vectors(frame(spark, [(1, None, 1)])).collect()
    assert [tuple(r) for r in none] == [(1, 0, 1, True, None)]


def test_many_cells(spark):
    """Cells of 48 members at most, so that links cross cells, a hot vector, a dense group of many cells, a second label."""
    rng = np.random.default_rng(5)
    vs = vectors(rng, 60, 3, 0.1) + vectors(rng, 1, 150, 0.12) + vectors(rng, 150, 1, 0)
    rows = [(k, v, 1) for k, v in enumerate(vs)] + [(1000 + k, vs[0], 1) for k in range(200)] + [(2000 + k, v, 2) for k, v in enumerate(vs[:100])]
    order = rng.permutation(len(rows))
    got = check(spark, [rows[k] for k in order], least=0.97, limit=48)
    assert got[0].audited_recall >= 0.95
    want = {w[0]: w[2] for w in expected(rows)}
    assert sum(want[r.vec_id] == r.component_id for r in got) >= 0.99 * len(rows)


def test_what_centres_cannot_split(spark, monkeypatch):
    """Vectors of one direction: parts by hash, each of which searches all others."""
    monkeypatch.setattr(g, "LEVELS", 1)
    rows = [(k, [1.0 + k, 2.0 + 2 * k, 0.0], 1) for k in range(120)]
    got = check(spark, rows, least=0.95, limit=32)
    assert all(r.component_id == 0 for r in got)


def test_pruning_and_search():
    rng = np.random.default_rng(6)
    v = g._unit(np.array(vectors(rng, 100, 5, 0.12, 16))).astype(np.float32)
    adj, medoid = g.build(v)
    assert adj.shape == (500, g.DEGREE) and all(k not in a for k, a in enumerate(adj)) and all(len(set(a[a >= 0])) == (a >= 0).sum() for a in adj)
    sim = v.astype(float) @ v.T.astype(float)
    for p in range(0, 500, 7):  # an edge goes where no chosen nearer neighbour is a detour
        a = adj[p][adj[p] >= 0]
        assert a[np.argsort(-sim[p, a])][0] in np.argsort(-sim[p])[1:3]
    found = g.in_range(v, adj, v, medoid, g.BEAM, 0.98)
    true = sum((sim[k] >= 0.98).sum() for k in range(500))
    assert sum((sim[k, f] >= 0.98).sum() for k, f in enumerate(found)) >= 0.98 * true
    out = g.robust_prune(v, np.array([0]), np.array([[0, 3, 3, -1, 7]]), 4, 1.3)[0]
    assert set(out[out >= 0]) <= {3, 7} and len(out[out >= 0]) >= 1
    one, m = g.build(v[:1])
    assert (one < 0).all() and m == 0


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_query(spark, table):
    from tidepool.llm import load_all

    d = f"/root/testdata/{table}"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = load_all()["op13_embedding_near_dedup"][0](spark, d).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == sorted(expected(rows))
