"""Embedding near-dedup by a robust-pruned flat graph.

The different vectors of a label are dealt into cells around centres until a cell holds at most ``SHARD``; each
vector stands in its nearest cell, its home, and in the second nearest as well. Every cell gets a graph of its own:
vectors are inserted in batches, each batch searches the graph so far from the medoid, and robust pruning
keeps of what it met the edges that no shorter detour replaces. A vector's lists from all its cells are united. Then
every vector searches its cells: greedily from the medoid, and once within range through all neighbours in range.
What is found leads on: to the home of each vector found, and to the homes of its neighbours in other cells that may be
in range by the triangle inequality. Searches go on round by round until no cell is new. Links are checked in
double precision, counted at the home of the vector found, and joined to components by spanning links.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from . import query
from .common import ship, table
from .components import connected_components

COSINE = 0.98
SHARD = 1024  # most members of a cell
CELLS = 64  # most cells that one cell is cut into at a time
SAMPLE = 4096  # vectors that centres are fitted on, about, drawn from the whole cell by hash
LEVELS = 10  # times a cell is cut; what is still too large is cut by hash, and each part searches all others
DEGREE, BEAM, ALPHA = 32, 32, 1.3
SLACK = 0.02  # a search walks on through what is this much below the range
TURN = 8192  # rows of a hot cell that share one copy of its centres, or of its graph
AUDIT = 256  # searches compared with brute force; the beam doubles until 0.95 of their links are found, twice at most


def _floats(column) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # neither squares that vanish nor squares that overflow
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _longs(table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


# ---- one cell's graph -------------------------------------------------------------------------------


def beam_search(v: np.ndarray, adj: np.ndarray, q: np.ndarray, start: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy searches for all of ``q`` at once: (ids opened, in order, -1 where ended; their similarities)."""
    n, at = len(q), np.arange(len(q))
    ids, sim = np.full((n, width), -1), np.full((n, width), -np.inf, np.float32)
    ids[:, 0], sim[:, 0] = start, q @ v[start]
    opened, seen = np.zeros((n, width), bool), np.zeros((n, len(v)), bool)
    seen[:, start] = True
    path, near = [], []
    while True:
        best = np.where(opened, -np.inf, sim)
        k = best[at].argmax(1) if len(at) else at
        going = best[at, k] > -np.inf
        at, k = at[going], k[going]
        if not len(at):
            break
        node = ids[at, k]
        opened[at, k] = True
        row, gain = np.full(n, -1), np.full(n, -np.inf, np.float32)
        row[at], gain[at] = node, sim[at, k]
        path.append(row)
        near.append(gain)
        next_to = adj[node]
        fresh = (next_to >= 0) & ~seen[at[:, None], next_to]
        r, c = np.nonzero(fresh)
        seen[at[r], next_to[r, c]] = True
        s = np.full(next_to.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("ij,ij->i", v[next_to[r, c]], q[at[r]])
        all_ids, all_sim = np.hstack((ids[at], next_to)), np.hstack((sim[at], s))
        all_open = np.hstack((opened[at], np.zeros(s.shape, bool)))
        top = np.argpartition(-all_sim, width - 1, axis=1)[:, :width]
        ids[at], sim[at], opened[at] = (np.take_along_axis(a, top, 1) for a in (all_ids, all_sim, all_open))
    return np.array(path).T, np.array(near).T


def robust_prune(v: np.ndarray, own: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each of ``own`` up to ``degree`` of its candidates (-1: none): the nearest, then the nearest of those that
    are not ``alpha`` times nearer to one already chosen than to ``own``, and so on. Equal directions replace nothing."""
    safe = np.maximum(cand, 0)
    to = v[safe]
    sim = np.einsum("bcd,bd->bc", to, v[own])
    alive = (cand >= 0) & (cand != own[:, None])
    out, rows = np.full((len(own), degree), -1), np.arange(len(own))
    for k in range(degree):
        pick = np.where(alive, sim, -np.inf).argmax(1)
        live = alive[rows, pick]
        if not live.any():
            break
        out[live, k] = cand[rows, pick][live]
        between = np.einsum("bcd,bd->bc", to, to[rows, pick])
        alive &= (alpha * alpha * (1 - between) + 1e-6 > 1 - sim) & (cand != cand[rows, pick][:, None])
    return out


def build(v: np.ndarray, degree: int = DEGREE, width: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, int]:
    """(adjacency with -1 where there is none, medoid) of unit vectors, in two passes over batches that double."""
    n = len(v)
    medoid = int((v @ v.sum(0)).argmax())
    adj = np.full((n, degree), -1)
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([medoid], order[order != medoid]))
    for first_pass in (True, False):
        done = 1 if first_pass else 0
        while done < n:
            batch = order[done : done + min(max(done, 1), 256) if first_pass else done + 256]
            path, _ = beam_search(v, adj, v[batch], medoid, width)
            adj[batch] = robust_prune(v, batch, np.hstack((path, np.where(adj[batch] == batch[:, None], -1, adj[batch]))), degree, alpha)
            _turn_back(v, adj, batch, degree, alpha)
            done += len(batch)
    return adj, medoid


def _turn_back(v, adj, batch, degree, alpha) -> None:
    """The batch's edges in the other direction; lists that would grow past ``degree`` are pruned anew."""
    src, dst = np.repeat(batch, degree), adj[batch].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    new = ~(adj[dst] == src[:, None]).any(1)
    src, dst = src[new], dst[new]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    by_size = np.argsort(count)
    for k in range(0, len(nodes), 64):
        part = by_size[k : k + 64]
        wide = count[part].max()
        col = np.arange(wide)
        more = np.where(col < count[part][:, None], src[np.minimum(first[part][:, None] + col, len(src) - 1)], -1)
        have = adj[nodes[part]]
        cand = np.hstack((have, more))
        short = (cand >= 0).sum(1) <= degree
        kept = np.take_along_axis(cand, np.argsort(cand < 0, axis=1, kind="stable"), 1)[:, :degree]
        if not short.all():
            kept[~short] = robust_prune(v, nodes[part][~short], cand[~short], degree, alpha)
        adj[nodes[part]] = kept


def in_range(v: np.ndarray, adj: np.ndarray, q: np.ndarray, medoid: int, width: int, low: float) -> list[np.ndarray]:
    """For each query the vectors at ``low`` or more that it reaches: a greedy search, then on through all in range."""
    path, near = beam_search(v, adj, q, medoid, width)
    out = []
    for k in range(len(q)):
        front = path[k][near[k] >= low]
        found = [front]
        if len(front):
            seen = np.zeros(len(v), bool)
            seen[path[k][path[k] >= 0]] = True
            while len(front):
                ids = adj[front].ravel()
                ids = np.unique(ids[(ids >= 0)])
                ids = ids[~seen[ids]]
                seen[ids] = True
                front = ids[v[ids] @ q[k] >= low]
                found.append(front)
        out.append(np.concatenate(found))
    return out


# ---- cells ------------------------------------------------------------------------------------------


def _fit_centres(key, t):
    """One row: the centres of a cell, from a sample of its members, by a few rounds of spherical k-means."""
    import pyarrow as pa

    x = _unit(_floats(t.column("vec")))
    rng = np.random.default_rng(len(x))
    c = x[rng.permutation(len(x))[: int(t.column("cells")[0].as_py())]]
    for _ in range(8):
        own = (x @ c.T).argmax(1)
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where((np.abs(total).max(1) > 0)[:, None], _unit(np.where(total == 0, 1e-30, total)), c)
    return pa.table({"shard": [key[0].as_py()], "centres": pa.array([c.ravel()], pa.list_(pa.float64()))})


def _assign(left, right):
    """Members of one cell to its nearest parts: a member at home to two, another to one."""
    import pyarrow as pa

    if not left.num_rows or not right.num_rows:
        return left.select(["node", "vec", "weight", "shard", "home"]).slice(0, 0)
    c = np.array(right.column("centres")[0].as_py())
    x = _unit(_floats(left.column("vec")))
    sim = x @ c.reshape(-1, x.shape[1]).T
    two = np.argsort(-sim, axis=1, kind="stable")[:, :2]
    home = left.column("home").to_numpy(zero_copy_only=False)
    second = np.flatnonzero(home) if two.shape[1] > 1 else np.zeros(0, int)
    rows = np.concatenate((np.arange(len(x)), second))
    part = np.concatenate((two[:, 0], two[second, -1]))
    shard = left.column("shard")[0].as_py()
    t = left.take(pa.array(rows))
    return pa.table({"node": t.column("node"), "vec": t.column("vec"), "weight": t.column("weight"), "shard": [f"{shard}/{p}" for p in part],
                     "home": np.concatenate((home, np.zeros(len(second), bool)))})


def cells(nodes: DataFrame, limit: int = SHARD) -> DataFrame:
    """(node, vec, weight, shard, home, also) of nodes(node, vec, weight, shard): each in its cells of at most about
    ``limit`` members.

    Centres are fitted cell by cell on a sample of bounded size, and every member is assigned; a hot cell's members are
    dealt over many tasks, each with a copy of the few centres. ``also`` names the other parts of a cell that
    centres could not split.
    """
    kind = f"node bigint, vec {nodes.schema['vec'].dataType.simpleString()}, weight bigint, shard string, home boolean"
    now, done = nodes.withColumn("home", F.lit(True)), []
    for level in range(LEVELS + 1):
        big = stored(now.groupBy(F.col("shard").alias("s")).agg(F.count("*").alias("size")).where(F.col("size") > limit))
        if big.isEmpty():
            break
        on = now["shard"] == big["s"]
        done.append(now.join(big, on, "left_anti"))
        marked = now.join(big, on)
        if level == LEVELS:
            parts = F.ceil(F.col("size") / limit)
            names = F.transform(F.sequence(F.lit(0).cast("bigint"), parts - 1), lambda k: F.concat("shard", F.lit("#"), k.cast("string")))
            dealt = marked.withColumns({"names": names, "part": F.get(names, F.pmod(F.xxhash64("node"), parts).cast("int"))})
            done.append(dealt.select("node", "vec", "weight", F.col("part").alias("shard"), "home", F.array_remove("names", F.col("part")).alias("also")))
            now = now.limit(0)
            break
        draw = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1 << 30)) < F.lit(float(SAMPLE << 30)) / F.col("size")
        count = F.least(F.lit(CELLS), F.ceil(F.col("size") * 3.4 / limit))
        sample = marked.where(draw).select("shard", "vec", count.alias("cells"))
        centres = stored(sample.groupBy("shard").applyInArrow(_fit_centres, "shard string, centres array<double>"))
        turns = F.ceil(F.col("size") / TURN)
        left = marked.withColumn("turn", F.pmod(F.xxhash64("node"), turns))
        right = centres.join(big, centres["shard"] == big["s"]).withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), turns - 1)))
        now = left.groupBy("shard", "turn").cogroup(right.select("shard", "turn", "centres").groupBy("shard", "turn")).applyInArrow(_assign, kind)
        now = stored(now)
    out = now.withColumn("also", F.lit(None).cast("array<string>"))
    for part in done:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


# ---- tasks ------------------------------------------------------------------------------------------


def _build_cell(t):
    """(node, to, cosine, home_of) for each edge of one cell's graph."""
    import pyarrow as pa

    x = _unit(_floats(t.column("vec")))
    adj, _ = build(x.astype(np.float32))
    src, k = np.nonzero(adj >= 0)
    dst = adj[src, k]
    node, home = _longs(t, "node"), _longs(t, "home_shard")
    return pa.table({"node": node[src], "to": node[dst], "cosine": np.einsum("ij,ij->i", x[src], x[dst]), "home_of": home[dst]})


def _cell(t):
    """A cell's nodes and its part of the united graph: (node, unit, raw, adjacency, edges that leave it)."""
    node = _longs(t, "node")
    raw = _floats(t.column("vec"))
    lists = t.column("edges").combine_chunks()
    many = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten()
    src = np.repeat(np.arange(len(node)), many)
    to, cos, home = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
    order = np.argsort(node)
    at = np.minimum(np.searchsorted(node[order], to), len(node) - 1) if len(node) else to
    inside = node[order][at] == to if len(to) else np.zeros(0, bool)
    a, b = src[inside], order[at[inside]]
    first = np.searchsorted(a, np.arange(len(node)))
    wide = max(1, np.bincount(a, minlength=1).max() if len(a) else 1)
    adj = np.full((len(node), wide), -1)
    adj[a, np.arange(len(a)) - first[a]] = b
    out = ~inside
    return node, _unit(raw), raw, adj, (src[out], cos[out], home[out])


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = (x / np.abs(x).max(1, keepdims=True) for x in (a, b))
    return np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))


def _search(cell, q_node, q_unit, q_raw, cosine: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(query x member) links, and their cosines in double precision."""
    node, unit, raw, adj, _ = cell
    v = unit.astype(np.float32)
    medoid = int((v @ v.sum(0)).argmax())
    linked, exact = np.zeros((len(q_node), len(node)), bool), np.zeros((len(q_node), len(node)))
    for k in range(0, len(q_node), 1024):
        for j, ids in enumerate(in_range(v, adj, q_unit[k : k + 1024].astype(np.float32), medoid, width, cosine - SLACK), k):
            ids = ids[node[ids] != q_node[j]]
            if len(ids):
                c = _cosines(raw[ids], np.broadcast_to(q_raw[j], (len(ids), raw.shape[1])))
                linked[j, ids], exact[j, ids] = c >= cosine, c
    return linked, exact


def _leads(cell, linked, exact, same, shard, home, cosine):
    """For each query the cells where to go on. ``same``: the member that is the query itself, or -1."""
    out = [set() for _ in linked]
    for j in range(len(linked)):
        out[j].update(home[linked[j]].tolist())
    src, cos, homes = cell[4]
    reach = math.acos(cosine)
    for s, c, h in zip(src, cos, homes):
        spare = math.acos(min(1.0, max(-1.0, c))) - reach  # farther from the found vector than this it must be
        if spare <= reach:
            with_it = linked[:, s] & (exact[:, s] <= math.cos(max(0.0, spare)) + 1e-9)
            if spare <= 0:
                with_it |= same == s
            for j in np.flatnonzero(with_it):
                out[j].add(int(h))
    return [sorted(x - {shard}) for x in out]


def _roots(linked: np.ndarray) -> np.ndarray:
    """The component of each row and column of a link matrix, rows first."""
    n, m = linked.shape
    root = np.full(n + m, -1)
    for j in np.flatnonzero(linked.any(1)):
        if root[j] < 0:
            rows, cols = np.zeros(n, bool), np.zeros(m, bool)
            rows[j], front = True, np.array([j])
            while len(front):
                new = linked[front].any(0) & ~cols
                cols |= new
                front = np.flatnonzero(linked[:, new].any(1) & ~rows)
                rows[front] = True
            root[:n][rows] = root[n:][cols] = j
    return root


FOUND = "node bigint, shard bigint, links bigint, root bigint, next array<bigint>"


def _table(node, shard, links, root, leads):
    import pyarrow as pa

    return pa.table({"node": pa.array(node, pa.int64()), "shard": pa.array([shard] * len(node), pa.int64()), "links": pa.array(links, pa.int64()),
                     "root": pa.array(root, pa.int64()), "next": pa.array(leads, pa.list_(pa.int64()))})


def _own_search(cosine: float, width: int):
    """All members of a cell search it. A link found from either end counts for both."""

    def run(key, t):
        shard, cell = key[0].as_py(), _cell(t)
        node, unit, raw = cell[:3]
        linked, exact = _search(cell, node, unit, raw, cosine, width)
        linked, exact = linked | linked.T, np.maximum(exact, exact.T)
        home, weight = _longs(t, "home_shard"), _longs(t, "weight")
        links = linked @ np.where(home == shard, weight, 0)
        roots = _roots(linked)[: len(node)]
        leads = _leads(cell, linked, exact, np.arange(len(node)), shard, home, cosine)
        for x, also in zip(leads, t.column("also").to_pylist()):
            x += also or []
        return _table(node, shard, links, [node[r] if r >= 0 else None for r in roots], leads)

    return run


def _visit(cosine: float, width: int):
    """Vectors of other cells search one cell; members that they link get the root of their component too."""

    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return _table([], 0, [], [], [])
        shard, cell = key[0].as_py(), _cell(left)
        q_node, q_raw = _longs(right, "node"), _floats(right.column("vec"))
        linked, exact = _search(cell, q_node, _unit(q_raw), q_raw, cosine, width)
        home, weight = _longs(left, "home_shard"), _longs(left, "weight")
        roots = _roots(linked)
        leads = _leads(cell, linked, exact, np.full(len(q_node), -1), shard, home, cosine)
        met = np.flatnonzero(roots[len(q_node) :] >= 0)
        node = np.concatenate((q_node, cell[0][met]))
        root = [q_node[r] if r >= 0 else None for r in np.concatenate((roots[: len(q_node)], roots[len(q_node) :][met]))]
        links = np.concatenate((linked @ np.where(home == shard, weight, 0), np.zeros(len(met), np.int64)))
        return _table(node, shard, links, root, [*leads, *([] for _ in met)])

    return run


# ---- the whole --------------------------------------------------------------------------------------


def united_graph(members: DataFrame) -> DataFrame:
    """Members with ``home_shard`` and the united list of their edges (to, cosine, home_of); cells become longs."""
    members = members.withColumns({"shard": F.xxhash64("shard"), "also": F.transform("also", lambda s: F.xxhash64(s))})
    homes = members.where("home").select(F.col("node").alias("n"), F.col("shard").alias("home_shard"))
    members = stored(members.join(homes, members["node"] == homes["n"]).drop("n"))
    edges = members.groupBy("shard").applyInArrow(_build_cell, "node bigint, to bigint, cosine double, home_of bigint")
    edges = edges.groupBy("node", "to").agg(F.max("cosine").alias("cosine"), F.max("home_of").alias("home_of"))
    lists = edges.groupBy(F.col("node").alias("n")).agg(F.collect_list(F.struct("to", "cosine", "home_of")).alias("edges"))
    none = F.array().cast("array<struct<to:bigint,cosine:double,home_of:bigint>>")
    joined = members.join(lists, members["node"] == lists["n"], "left")
    return stored(joined.drop("n").withColumn("edges", F.coalesce("edges", none)))


def searched(nodes: DataFrame, members: DataFrame, cosine: float, width: int) -> DataFrame:
    """(node, shard, links, root) of every search; rounds go on until none leads to a cell that is new to it."""
    found = stored(members.groupBy("shard").applyInArrow(_own_search(cosine, width), FOUND))
    all_found, known = [found], members.select(F.col("node").alias("n"), F.col("shard").alias("s"))
    while True:
        lead = found.select("node", F.explode("next").alias("shard")).distinct()
        visits = stored(lead.join(known, (lead["node"] == known["n"]) & (lead["shard"] == known["s"]), "left_anti"))
        if visits.isEmpty():
            break
        known = known.unionAll(visits)
        turns = stored(visits.groupBy(F.col("shard").alias("s")).agg(F.ceil(F.count("*") / TURN).alias("turns")))
        vectors = nodes.select(F.col("node").alias("n"), "vec")
        right = visits.join(turns, visits["shard"] == turns["s"]).withColumn("turn", F.pmod(F.xxhash64("node"), "turns"))
        right = right.join(vectors, right["node"] == vectors["n"]).select("node", "shard", "turn", "vec")
        left = members.join(turns, members["shard"] == turns["s"])
        left = left.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("turns") - 1))).drop("s", "turns")
        both = left.groupBy("shard", "turn").cogroup(right.groupBy("shard", "turn"))
        found = stored(both.applyInArrow(_visit(cosine, width), FOUND))
        all_found.append(found)
    out = all_found[0]
    for more in all_found[1:]:
        out = out.unionAll(more)
    return out


def audit(nodes: DataFrame, links: DataFrame, cosine: float = COSINE, queries: int = AUDIT) -> float | None:
    """The share of true links that were found, for at most ``queries`` vectors chosen by hash, against all others.

    ``nodes`` (node, vec, weight, shard) and ``links`` (n, links). Only the chosen vectors and their counts are on the
    driver; each task compares its rows with them. None: they have no links.
    """
    chosen = nodes.orderBy(F.xxhash64("node"), "node").limit(queries).join(links, F.col("node") == F.col("n"), "left").collect()
    ask = [(r.node, r.shard, np.array(r.vec, np.float64)) for r in chosen]

    def count(batches):
        import pyarrow as pa

        total = np.zeros(len(ask), np.int64)
        for b in batches:
            shard, weight, node = np.array(b.column(3).to_pylist()), b.column(2).to_numpy(), b.column(0).to_numpy()
            for s in set(shard.tolist()):
                mine = [k for k, a in enumerate(ask) if a[1] == s]
                if not mine:
                    continue
                at = np.flatnonzero(shard == s)
                rows = b.column(1).take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                sim = _unit(rows) @ _unit(np.array([ask[k][2] for k in mine])).T
                hit = (sim >= cosine) & (node[at][:, None] != np.array([ask[k][0] for k in mine]))
                total[mine] += (hit * weight[at][:, None]).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(ask)), pa.int32()), pa.array(total)], names=["k", "links"])

    true = {r.k: r.links for r in nodes.select("node", "vec", "weight", "shard").mapInArrow(count, "k int, links bigint")
            .groupBy("k").agg(F.sum("links").alias("links")).collect()}
    whole = sum(true.values())
    return sum(min(r.links or 0, true.get(k, 0)) for k, r in enumerate(chosen)) / whole if whole else None


def linkable(vector: str, label: str) -> Column:
    """There is a label, and a vector without null, NaN or infinite entries that is not all zero."""
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & ~odd & F.exists(vector, lambda c: c != 0), F.lit(False))


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 cosine: float = COSINE, limit: int = SHARD, width: int = BEAM) -> DataFrame:
    """(id, n_links, component_id, kept, audited_recall) for each row of ``vectors``.

    Vectors link when labels are equal and their cosine in double precision is at least ``cosine``; no link is below
    it, and the share of links found is measured (audited_recall, one value; null if none was to be found). Rows with no
    label, or a vector that is null, empty, zero or holds null, NaN or infinite entries, link with nothing; vectors of
    different lengths do not link. Equal vectors collapse in a combined aggregate first and count as often as they
    stand. component_id is the smallest id reached, null ids passed over; a row with a null id is not kept, and
    rows that repeat an id each count as a row. An empty table gives an empty one. Other columns are not looked at.
    """
    spark = vectors.sparkSession
    ship(spark)
    col = lambda c: F.col(f"`{c}`")
    rows = vectors.select(col(id_col).alias("id"), col(vector_col).alias("vec"), col(label_col).cast("string").alias("label"))
    rows = stored(rows.withColumns({"row": F.monotonically_increasing_id(), "fit": linkable("vec", "label")}))
    nodes = rows.where("fit").groupBy("label", "vec").agg(F.min("row").alias("node"), F.min("id").alias("least"), F.count("*").alias("weight"))
    nodes = stored(nodes.withColumn("shard", F.concat(F.hex("label"), F.lit(":"), F.size("vec").cast("string"))))
    members = united_graph(cells(nodes.select("node", "vec", "weight", "shard"), limit))
    for more in range(3):
        found = stored(searched(nodes, members, cosine, width << more))
        links = stored(found.groupBy(F.col("node").alias("n")).agg(F.sum("links").alias("links")))
        recall = audit(nodes, links, cosine)
        if recall is None or recall >= 0.95:
            break
    parts = connected_components(found.where("root is not null").select(F.col("node").alias("src"), F.col("root").alias("dst")))
    named = nodes.join(parts.toDF("p", "component"), F.col("node") == F.col("p"), "left").withColumn("component", F.coalesce("component", "node"))
    named = stored(named.select("node", "label", "vec", "least", "weight", "component"))
    least = stored(named.groupBy(F.col("component").alias("c")).agg(F.min("least").alias("component_id")))
    named = named.join(least, named["component"] == least["c"]).join(links, F.col("node") == F.col("n"), "left")
    named = stored(named.select(F.col("label").alias("l"), F.col("vec").alias("v"), "component_id",
                                (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    plain = rows.where("not fit").select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    linked = rows.where("fit").join(named, (F.col("label") == F.col("l")) & (F.col("vec") == F.col("v"))).select("id", "n_links", "component_id")
    out = linked.unionAll(plain)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
                      F.lit(recall).cast("double").alias("audited_recall"))


@query("op13_embedding_near_dedup")
def op13_embedding_near_dedup(spark, sf_dir):
    """Links, component and whether it is kept for every row of embeddings."""
    return near_vectors(table(spark, sf_dir, "embeddings"))
