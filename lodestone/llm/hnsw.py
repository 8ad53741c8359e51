"""Approximate nearest neighbours by one HNSW graph per shard (operator 1).

Vectors are collapsed to distinct ones (each with its smallest ids, as many as
a result can hold), dealt to shards of bounded size by a hash of their
values, and each shard gets a hierarchical navigable small-world graph stored
as flat neighbour arrays (one int matrix per level) in the shared folder.
Queries are written there once, in blocks.  What is dealt to tasks are tiles,
a few graphs by a few blocks, as file names: a task loads each of its graphs
once, scores what it finds again in double precision, merges the results of
its graphs and hands on only the best k of each query.

Inner products become distances on a sphere by one more coordinate,
sqrt(R^2 - |x|^2), so that the graph's navigation is sound for vectors of any
length.  Graphs are built level by level from the top: a node's candidates
come from the cells of the pivots (nodes of the level above) nearest to its
own pivot, the diversity heuristic selects its neighbours, reverse links are
added up to the level's limit, and nodes that the pivots cannot reach get a
link from one that they can.  Search scans the lowest upper level of up to
EXACT nodes, so that every cluster's pivots are seen, hands its best entries
down and ends in a beam of ``ef`` on the ground level, many queries in
lockstep.

Cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, neither as query nor as candidate; vectors of other
lengths are searched among their own length.  Repeated vectors tie and go by
vec_id.  Repeated rows (the same id and vector) count once.  With fewer than
k candidates all are returned.  An empty table gives an empty result.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lodestone.llm.scratch import materialise, new_path, parallelism
from lodestone.llm.token_store import filesystem

K = 20
M = 24
CANDIDATES = 64
EF = 320
#: distinct vectors in a shard, about
SHARD_ROWS = 16_384
#: queries in a block
BLOCK = 512
#: graphs and query blocks in a task at most (a block of 512 queries of 768 values is 3 MB)
GRAPHS_TASK, BLOCKS_TASK = 8, 16
SEED = 7
#: nodes of a level up to which all are compared
EXACT = 1_024
#: cells whose nodes are a node's candidates on larger levels
CELLS = 160
#: entries handed from level to level
ENTRIES = 48
#: links that a node gets even if they are not diverse, and links kept free for nodes out of reach
FILL, SPARE = 16, 8


def _top(sim: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest of each row, largest first, ties to the first."""
    k = min(k, sim.shape[1])
    part = np.argpartition(-sim, k - 1, axis=1)[:, :k] if k < sim.shape[1] else np.broadcast_to(np.arange(k), sim.shape).copy()
    part.sort(axis=1)
    return np.take_along_axis(part, np.argsort(-np.take_along_axis(sim, part, 1), axis=1, kind="stable"), 1)


def _diverse(x: np.ndarray, sim: np.ndarray, cand: np.ndarray, m: int, fill: int) -> np.ndarray:
    """Of each row's candidates (nearest first), up to m that are nearer to the node than to one chosen before.

    Only rows with fewer than `fill` such candidates are filled up to `fill` with their nearest others.
    """
    n, c = cand.shape
    v = x[np.maximum(cand, 0)]
    among = np.einsum("ncd,ned->nce", v, v, optimize=True)
    ok = cand >= 0
    chosen = np.zeros((n, c), bool)
    for j in range(c):
        blocked = (chosen & (among[:, j, :] > sim[:, j, None])).any(axis=1)
        chosen[:, j] = ok[:, j] & ~blocked & (chosen.sum(axis=1) < m)
    spare = ok & ~chosen
    spare &= np.cumsum(spare, axis=1) <= (fill - chosen.sum(axis=1))[:, None]
    rank = np.where(chosen, 0, np.where(spare, 1, 3)) * c + np.arange(c)
    order = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.where(np.take_along_axis(chosen | spare, order, 1), np.take_along_axis(cand, order, 1), -1)
    if out.shape[1] < m:
        out = np.concatenate([out, np.full((n, m - out.shape[1]), -1)], axis=1)
    return out


def _pools(x: np.ndarray, pivots: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(nodes, pool) pairs: every node once, with the nodes among which its candidates are sought.

    A level of up to EXACT nodes is one pool.  Beyond, nodes go to the cell of
    their nearest pivot (a node of the level above), and a cell's pool are the
    cells of the CELLS pivots nearest to its own, so the work grows with the
    number of nodes, not with its square.
    """
    n = len(x)
    if n <= EXACT or len(pivots) <= CELLS:
        every = np.arange(n)
        for lo in range(0, n, 256):
            yield every[lo : lo + 256], every
        return
    cell = np.empty(n, np.int64)
    p = x[pivots]
    for lo in range(0, n, 1024):
        cell[lo : lo + 1024] = (x[lo : lo + 1024] @ p.T).argmax(axis=1)
    by = np.argsort(cell, kind="stable")
    bound = np.searchsorted(cell[by], np.arange(len(p) + 1))
    for lo in range(0, len(p), 256):
        near = _top(p[lo : lo + 256] @ p.T, CELLS)
        for c in range(lo, min(lo + 256, len(p))):
            mine = by[bound[c] : bound[c + 1]]
            if len(mine):
                row = np.union1d(near[c - lo], [c])
                pool = np.concatenate([by[bound[k] : bound[k + 1]] for k in row])
                for at in range(0, len(mine), 256):
                    yield mine[at : at + 256], pool


def _reach(flat: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether each node can be reached from `start` along the links."""
    seen = np.zeros(len(flat), bool)
    seen[start] = True
    front = start
    while len(front):
        to = flat[front].ravel()
        to = np.unique(to[to >= 0])
        front = to[~seen[to]]
        seen[front] = True
    return seen


def _level(x: np.ndarray, m: int, limit: int, candidates: int, pivots: np.ndarray) -> np.ndarray:
    """Neighbour matrix (n x (limit + SPARE), -1 where none) of one level's vectors; pivots: the nodes of the level above."""
    n = len(x)
    flat = np.full((n, limit + SPARE), -1, np.int32)
    if n == 1:
        return flat
    out = np.full((n, m), -1, np.int64)
    nearest = np.full(n, -1, np.int64)
    for nodes, pool in _pools(x, pivots):
        sim = x[nodes] @ x[pool].T
        sim[nodes[:, None] == pool] = -np.inf
        pick = _top(sim, min(candidates, len(pool)))
        sim = np.take_along_axis(sim, pick, 1)
        cand = np.where(sim > -np.inf, pool[pick], -1)
        nearest[nodes] = cand[:, 0]
        out[nodes] = _diverse(x, sim, cand, m, min(FILL, m))
    # links both ways; where a node has too many, the selected ones, then the nearest stay
    a = np.repeat(np.arange(n), m)
    b = out.ravel()
    a, b = a[b >= 0], b[b >= 0]
    forward = np.unique(a * n + b)
    pair = np.unique(np.concatenate([forward, b * n + a]))
    a, b = pair // n, pair % n
    sim = np.empty(len(a), x.dtype)
    for lo in range(0, len(a), 1 << 16):
        s = slice(lo, lo + (1 << 16))
        sim[s] = np.einsum("nd,nd->n", x[a[s]], x[b[s]])
    own = np.isin(pair, forward, assume_unique=True)
    order = np.lexsort((b, -sim, ~own, a))
    a, b = a[order], b[order]
    at = np.arange(len(a)) - np.searchsorted(a, a)
    keep = at < limit
    flat[a[keep], at[keep]] = b[keep]
    # nodes out of reach get a link from their nearest that is in reach and has room
    start = pivots if len(pivots) else np.zeros(1, np.int64)
    room = np.full(n, SPARE)
    seen = _reach(flat, start)
    last = int(start[0])
    while not seen.all():
        lost = np.flatnonzero(~seen)
        u = lost[seen[nearest[lost]] & (nearest[lost] >= 0)]
        u = u[room[nearest[u]] > 0]
        if len(u):
            v, first = np.unique(nearest[u], return_index=True)
            u = u[first]
        else:
            u, v = lost[:1], np.array([last if room[last] else int(np.flatnonzero(seen & (room > 0))[0])])
        flat[v, limit + SPARE - room[v]] = u
        room[v] -= 1
        last = int(u[-1])
        seen |= _reach(flat, u)
    return flat


class Graph:
    """A shard's index: vectors, and per level the members and their flat neighbours."""

    def __init__(self, x: np.ndarray, radius: float, members: list[np.ndarray], links: list[np.ndarray]):
        self.x, self.radius, self.members, self.links = x, radius, members, links

    @classmethod
    def build(cls, raw: np.ndarray, m: int = M, candidates: int = CANDIDATES, seed: int = SEED) -> Graph:
        norm = np.einsum("nd,nd->n", raw, raw)
        radius = float(norm.max())
        x = np.concatenate([raw, np.sqrt(np.maximum(radius - norm, 0))[:, None]], axis=1).astype(np.float32)
        draw = np.random.default_rng(seed).random(len(x))
        level = np.minimum((-np.log(np.maximum(draw, 1e-12)) / np.log(m)).astype(int), 8)
        members = [np.flatnonzero(level >= at).astype(np.int32) for at in range(level.max() + 1)]
        links = []
        for at, who in enumerate(members):
            above = np.searchsorted(who, members[at + 1]) if at + 1 < len(members) else np.zeros(0, np.int64)
            links.append(_level(x[who], m, 2 * m if at == 0 else m, candidates, above))
        return cls(x, radius, members, links)

    def search(self, queries: np.ndarray, k: int, ef: int = EF, width: int = 4) -> np.ndarray:
        """Node numbers (len(queries) x min(k, n)), nearest first, -1 where none was found."""
        q = np.concatenate([queries, np.zeros((len(queries), 1))], axis=1).astype(np.float32)
        n = len(self.x)
        # the lowest level of up to EXACT nodes above the ground is scanned, those below it are searched
        top = min([at for at in range(1, len(self.members)) if len(self.members[at]) <= EXACT], default=0)
        if top:
            who = self.members[top]
            entry = who[_top(q @ self.x[who].T, ENTRIES)]
        else:
            entry = np.broadcast_to(np.arange(min(n, ENTRIES)), (len(q), min(n, ENTRIES)))
        for level in range(max(top - 1, 0), -1, -1):
            who = self.members[level]
            at = np.searchsorted(who, entry)
            cand, sims = self._beam(q, level, at, max(ef, k) if level == 0 else ENTRIES, width)
            if level:
                order = np.argsort(-sims, axis=1, kind="stable")
                # all entries were found, or fewer than asked for: the best stands in for those
                best = np.take_along_axis(cand, order, 1)
                entry = who[np.where(best >= 0, best, best[:, :1])]
        top = _top(sims, min(k, n))
        return np.where(np.take_along_axis(sims, top, 1) > -np.inf, np.take_along_axis(cand, top, 1), -1)

    def _beam(self, q: np.ndarray, level: int, entry: np.ndarray, ef: int, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(positions in the level, products) of up to `ef` nodes a query, unordered, from its entry positions."""
        who = self.members[level]
        n, rows = len(who), np.arange(len(q))
        ground = level == 0
        cand = np.full((len(q), ef), -1, np.int64)
        sims = np.full((len(q), ef), -np.inf, np.float32)
        done = np.ones((len(q), ef), bool)
        seen = np.zeros((len(q), n + 1), bool)
        seen[:, n] = True
        entry = np.sort(entry, axis=1)[:, :ef]
        fresh = np.ones(entry.shape, bool)
        fresh[:, 1:] = entry[:, 1:] != entry[:, :-1]
        e = entry.shape[1]
        cand[:, :e] = np.where(fresh, entry, -1)
        sims[:, :e] = np.where(fresh, np.einsum("qd,qed->qe", q, self.x[entry if ground else who[entry]]), -np.inf)
        done[:, :e] = ~fresh
        seen[rows[:, None], entry] = True
        live = rows
        links = np.where(self.links[level] >= 0, self.links[level], n)
        while len(live):
            open_ = np.where(done[live], -np.inf, sims[live])
            pick = _top(open_, width)
            ok = np.take_along_axis(open_, pick, 1) > -np.inf
            done[live[:, None], pick] = True
            near = np.where(ok[:, :, None], links[np.where(ok, cand[live[:, None], pick], 0)], n).reshape(len(live), -1)
            near.sort(axis=1)
            fresh = ~seen[live[:, None], near]
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[live[:, None], near] = True
            r, c = np.nonzero(fresh)
            sim = np.full(near.shape, -np.inf, np.float32)
            ids = near[r, c]
            sim[r, c] = np.einsum("nd,nd->n", q[live[r]], self.x[ids if ground else who[ids]])
            every = np.concatenate([sims[live], sim], axis=1)
            keep = np.argpartition(-every, ef - 1, axis=1)[:, :ef]
            sims[live] = np.take_along_axis(every, keep, 1)
            cand[live] = np.take_along_axis(np.concatenate([cand[live], near], axis=1), keep, 1)
            done[live] = np.take_along_axis(np.concatenate([done[live], ~fresh], axis=1), keep, 1)
            live = live[(~done[live] & (sims[live] > -np.inf)).any(axis=1)]
        return np.where(sims > -np.inf, cand, -1), sims

    def save(self, stream, **more: np.ndarray) -> None:
        body = io.BytesIO()
        np.savez(body, x=self.x, radius=self.radius, levels=len(self.members), **{f"members{i}": a for i, a in enumerate(self.members)}, **{f"links{i}": a for i, a in enumerate(self.links)}, **more)
        stream.write(body.getvalue())

    @classmethod
    def load(cls, stream) -> tuple[Graph, dict]:
        with np.load(io.BytesIO(stream.read()), allow_pickle=False) as z:
            a = {k: z[k] for k in z.files}
        levels = int(a.pop("levels"))
        return cls(a.pop("x"), float(a.pop("radius")), [a.pop(f"members{i}") for i in range(levels)], [a.pop(f"links{i}") for i in range(levels)]), a


BUILT = "shard int, dim int, path string, n int"


def _build(root: str, m: int, candidates: int):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, shard = int(key[0]), int(key[1])
        # the same order, hence the same graph, however rows arrive
        pdf = pdf.sort_values(["k1", "k2"], kind="stable")
        raw = np.array(pdf["embedding"].tolist(), dtype=np.float64).reshape(len(pdf), dim)
        ids = pdf["ids"].tolist()
        fs, base = filesystem(root)
        fs.create_dir(base, recursive=True)
        name, mine = f"shard-{dim}-{shard:06d}.npz", f".{uuid.uuid4().hex}"
        size = np.array([len(i) for i in ids], np.int64)
        with fs.open_output_stream(f"{base}/{mine}") as f:
            Graph.build(raw, m, candidates).save(f, raw=raw, size=size, ids=np.concatenate([np.asarray(i, np.int64) for i in ids]))
        fs.move(f"{base}/{mine}", f"{base}/{name}")
        return pd.DataFrame({"shard": [shard], "dim": [dim], "path": [f"{root}/{name}"], "n": [len(pdf)]})

    return run


def _save_queries(root: str):
    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        dim, block = int(key[0]), int(key[1])
        pdf = pdf.sort_values(["query_id", "k1", "k2"], kind="stable")
        fs, base = filesystem(root)
        fs.create_dir(base, recursive=True)
        name, mine = f"queries-{dim}-{block:06d}.npz", f".{uuid.uuid4().hex}"
        body = io.BytesIO()
        np.savez(body, query_id=pdf["query_id"].to_numpy(np.int64), q=np.array(pdf["embedding"].tolist(), dtype=np.float64).reshape(len(pdf), dim))
        with fs.open_output_stream(f"{base}/{mine}") as f:
            f.write(body.getvalue())
        fs.move(f"{base}/{mine}", f"{base}/{name}")
        return pd.DataFrame({"dim": [dim], "block": [block], "path": [f"{root}/{name}"]})

    return run


FOUND = "query_id long, vec_id long, score double"


def _open(path: str, read):
    fs, name = filesystem(path)
    with fs.open_input_stream(name) as f:
        return read(f)


def _nearest(graph: Graph, more: dict, query_id: np.ndarray, q: np.ndarray, k: int, ef: int) -> pd.DataFrame:
    """Each query's k best of one graph."""
    raw, size, ids = more["raw"], more["size"], more["ids"]
    first = np.concatenate(([0], np.cumsum(size)))
    # one node more: the query's own vector may be among the found
    node = graph.search(q, k + 1, ef)
    who, hit = np.repeat(np.arange(len(q)), node.shape[1])[node.ravel() >= 0], node.ravel()[node.ravel() >= 0]
    score = np.einsum("nd,nd->n", raw[hit], q[who])
    n = size[hit]
    vec = ids[np.repeat(first[hit] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    out = pd.DataFrame({"who": np.repeat(who, n), "query_id": query_id[np.repeat(who, n)], "vec_id": vec, "score": np.repeat(score, n)})
    return out[out["vec_id"] != out["query_id"]]


def _best(found: pd.DataFrame, k: int) -> pd.DataFrame:
    found = found.sort_values(["who", "score", "vec_id"], ascending=[True, False, True], kind="stable")
    return found[found.groupby("who").cumcount() < k]


def _search(k: int, ef: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for graphs, blocks in zip(pdf["graphs"], pdf["blocks"], strict=True):
                asked = [_open(b, lambda f: dict(np.load(io.BytesIO(f.read()), allow_pickle=False))) for b in blocks]
                held: list[pd.DataFrame | None] = [None] * len(asked)
                for g in graphs:
                    graph, more = _open(g, Graph.load)
                    for i, a in enumerate(asked):
                        new = _nearest(graph, more, a["query_id"], a["q"], k, ef)
                        held[i] = _best(new if held[i] is None else pd.concat([held[i], new]), k)
                for found in held:
                    if found is not None:
                        yield found[["query_id", "vec_id", "score"]]

    return run


def _tiles(built: list, blocks: list, tasks: int) -> list[tuple[list[str], list[str]]]:
    """(graphs, query blocks) of each task: every graph meets every block of its length once.

    Tiles grow with the work up to GRAPHS_TASK by BLOCKS_TASK; only file names come to the driver.
    """
    out = []
    for dim in sorted({b["dim"] for b in blocks}):
        g, q = ([x["path"] for x in rows if x["dim"] == dim] for rows in (built, blocks))
        area = max(1, len(g) * len(q) // max(1, tasks))
        wide = min(BLOCKS_TASK, area, len(q))
        high = min(GRAPHS_TASK, max(1, area // wide))
        out += [(g[i : i + high], q[j : j + wide]) for i in range(0, len(g), high) for j in range(0, len(q), wide)]
    return out


def usable(v: Column) -> Column:
    """Whether a vector takes part."""
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def neighbours(vectors: DataFrame, is_query: Column, k: int = K, m: int = M, candidates: int = CANDIDATES, ef: int = EF, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows by inner product."""
    spark = vectors.sparkSession
    v = F.col("embedding").cast("array<double>")
    base = vectors.where(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("embedding"), is_query.alias("is_query")).where(usable(F.col("embedding")))
    # two hashes of the values stand for the vector
    base = materialise(base.withColumn("k1", F.xxhash64("embedding")).withColumn("k2", F.xxhash64(F.lit(1), F.reverse("embedding"))), "vectors")
    few = base.select("k1", "k2", "vec_id", "embedding").withColumn("r", F.dense_rank().over(W.partitionBy("k1", "k2").orderBy("vec_id"))).where(F.col("r") <= k + 1)
    nodes = few.groupBy("k1", "k2").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"), F.first("embedding").alias("embedding"))
    nodes = materialise(nodes.withColumn("dim", F.size("embedding")), "nodes")
    count = nodes.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    dealt = nodes.join(count, "dim").withColumn("shard", F.pmod("k1", "shards").cast("int"))
    root = new_path(spark, "hnsw")
    built = dealt.select("dim", "shard", "k1", "k2", "ids", "embedding").groupBy("dim", "shard").applyInPandas(_build(root, m, candidates), BUILT)
    built = sorted(built.collect(), key=lambda r: r["path"])  # one short row per shard
    asked = base.where("is_query").select(F.col("vec_id").alias("query_id"), "k1", "k2", "embedding", F.size("embedding").alias("dim")).dropDuplicates(["query_id", "k1", "k2"])
    total = base.where("is_query").count()
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id", "k1"), F.lit(max(1, -(-total // BLOCK)))).cast("int"))
    blocks = asked.groupBy("dim", "block").applyInPandas(_save_queries(root), "dim int, block int, path string")
    blocks = sorted(blocks.collect(), key=lambda r: r["path"])  # one short row per block
    tiles = _tiles(built, blocks, 2 * parallelism(spark))
    if not tiles:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tasks = spark.createDataFrame(tiles, "graphs array<string>, blocks array<string>").repartition(len(tiles))
    found = tasks.mapInPandas(_search(k, ef), FOUND)
    # the best k of a query over its tiles; a set, as an id may be there with several vectors
    ranked = found.groupBy("query_id").agg(F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("less"), "vec_id", "score"))).alias("all"))
    hits = ranked.select("query_id", F.posexplode(F.slice("all", 1, k)).alias("at", "hit"))
    return hits.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
