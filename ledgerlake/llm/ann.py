"""Approximate nearest neighbours by robust-pruned directed graphs (operator 7).

Vectors are dealt to shards of a bounded size.  In each shard a directed
graph is built: vectors enter in growing batches, a greedy beam search of
each through the graph so far proposes neighbours, and relaxed distance
pruning keeps a diverse few (a candidate goes if a kept one is, times
``alpha``, nearer to it than the vector is).  Edges are also added backwards
and pruned in the same way.  A query walks every shard's graph by beam
search; what the shards find is scored exactly and merged.

Nearness is the inner product.  Graphs are built in the plane where it is a
distance (one more coordinate makes all norms equal); scores are inner
products of the original vectors in double precision.

Equal vectors are one node that carries its ``k + 1`` smallest ids, which is
all that a result of ``k`` can show of them, so copies neither crowd a beam
nor a bucket.  Vectors that are null, empty, zero or hold null or non-finite
components take no part, as rows or as queries; rows with a null id neither.
Vectors are compared with those of their own dimension.  Rows that repeat an
id are candidates each if their vectors differ, and the id shows once, with
the largest of their scores; a query id that repeats is answered once, each
candidate with its largest score for any of the vectors.  Ties go to the
smaller id.
An empty table gives no rows; there are no texts; other columns can have any
name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize, pick


@dataclass(frozen=True)
class Settings:
    shard_rows: int = 8192     # nodes of a graph, about
    degree: int = 32           # out-edges kept by pruning
    beam_build: int = 64
    beam_search: int = 160
    alpha: float = 1.2
    entries: int = 32          # nodes that a walk starts from
    expand: int = 4            # nodes expanded at once by a walk
    batch: int = 512           # walks made together
    query_block: int = 8192    # queries that meet a shard in one task; a shard is sent once a block
    seed: int = 17


# ---- the graph of one shard ---------------------------------------------------

class Graph:
    """Edges between the rows of ``points`` (float32), padded with -1."""

    def __init__(self, points: np.ndarray, s: Settings):
        self.x, self.s = points, s
        self.norms = np.einsum("ij,ij->i", points, points)
        self.edges = np.full((len(points), s.degree + 8), -1, np.int32)
        self.count = np.zeros(len(points), np.int32)
        self.starts = np.zeros(0, np.int64)

    def far(self, targets: np.ndarray, target_norms: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Squared distances of each target to its row of ids."""
        dots = np.einsum("qd,qkd->qk", targets, self.x[ids])
        return target_norms[:, None] + self.norms[ids] - 2.0 * dots

    def walk(self, targets: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all targets at once: ids and squared distances, nearest first, -1 and inf beyond."""
        q, n, s = len(targets), len(self.x), self.s
        norms = np.einsum("ij,ij->i", targets, targets)
        rows = np.arange(q)[:, None]
        seen = np.zeros((q, n), bool)
        first = np.broadcast_to(self.starts, (q, len(self.starts)))
        ids = np.full((q, beam), -1, np.int64)
        d = np.full((q, beam), np.inf, np.float32)
        take = min(beam, first.shape[1])
        start_d = self.far(targets, norms, first)
        order = np.argsort(start_d, axis=1, kind="stable")[:, :take]
        ids[:, :take], d[:, :take] = first[rows, order], start_d[rows, order]
        seen[rows, first] = True
        done = ids < 0
        while True:
            waiting = np.where(done, np.inf, d)
            if not np.isfinite(waiting).any():
                return ids, d
            at = np.argpartition(waiting, min(s.expand, beam) - 1, axis=1)[:, :s.expand]
            valid = np.isfinite(waiting[rows, at])
            done[rows, at] = True
            nodes = np.where(valid, ids[rows, at], 0)
            new = np.where(valid[:, :, None], self.edges[nodes], -1).reshape(q, -1).astype(np.int64)
            real = new >= 0
            new[~real] = 0
            fresh = real & ~seen[rows, new]
            seen[np.broadcast_to(rows, new.shape)[real], new[real]] = True
            # the same node may come from two expanded ones
            order = np.argsort(np.where(fresh, new, n), axis=1, kind="stable")
            new, fresh = new[rows, order], fresh[rows, order]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            keep = int(fresh.sum(axis=1).max()) if fresh.size else 0
            if not keep:
                continue
            order = np.argsort(~fresh, axis=1, kind="stable")[:, :keep]
            new, fresh = new[rows, order], fresh[rows, order]
            new_d = np.where(fresh, self.far(targets, norms, new), np.inf).astype(np.float32)
            ids = np.concatenate([ids, np.where(fresh, new, -1)], axis=1)
            d = np.concatenate([d, new_d], axis=1)
            done = np.concatenate([done, ~fresh], axis=1)
            order = np.argsort(d, axis=1, kind="stable")[:, :beam]
            ids, d, done = ids[rows, order], d[rows, order], done[rows, order]

    def prune(self, nodes: np.ndarray, ids: np.ndarray, d: np.ndarray) -> np.ndarray:
        """Of each node's candidates (nearest first, -1 beyond) the diverse ones, at most ``degree``."""
        s, b = self.s, len(nodes)
        alive = (ids >= 0) & (ids != nodes[:, None]) & np.isfinite(d)
        safe = np.where(ids >= 0, ids, 0)
        points = self.x[safe]
        norms = self.norms[safe]
        between = norms[:, :, None] + norms[:, None, :] - 2.0 * np.einsum("bid,bjd->bij", points, points, optimize=True)
        kept = np.full((b, s.degree), -1, np.int32)
        rows = np.arange(b)
        for r in range(s.degree):
            some = alive.any(axis=1)
            if not some.any():
                break
            at = alive.argmax(axis=1)
            kept[some, r] = ids[rows, at][some]
            alive &= ~((s.alpha ** 2 * between[rows, at] <= d) & some[:, None])
            alive[rows, at] = False
        return kept

    def link(self, nodes: np.ndarray, kept: np.ndarray) -> None:
        """Sets the nodes' edges and adds the edges backwards, pruning where a node has too many."""
        s = self.s
        self.edges[nodes, :] = -1
        self.edges[nodes[:, None], np.arange(s.degree)[None, :]] = kept
        self.count[nodes] = (kept >= 0).sum(axis=1)
        from_, to = np.repeat(nodes, s.degree), kept.ravel()
        real = to >= 0
        from_, to = from_[real], to[real].astype(np.int64)
        order = np.argsort(to, kind="stable")
        from_, to = from_[order], to[order]
        targets, begin = np.unique(to, return_index=True)
        ends = np.append(begin[1:], len(to))
        full, lists = [], []
        for t, a, e in zip(targets.tolist(), begin.tolist(), ends.tolist()):
            own = self.edges[t, :self.count[t]]
            more = from_[a:e]
            more = more[~np.isin(more, own)]
            if len(own) + len(more) <= s.degree:
                self.edges[t, len(own):len(own) + len(more)] = more
                self.count[t] += len(more)
            else:
                full.append(t)
                lists.append(np.concatenate([own, more]))
        for at in range(0, len(full), s.batch):
            part, some = np.array(full[at:at + s.batch]), lists[at:at + s.batch]
            ids = np.full((len(part), max(map(len, some))), -1, np.int64)
            for i, x in enumerate(some):
                ids[i, :len(x)] = x
            d = np.where(ids >= 0, self.far(self.x[part], self.norms[part], np.where(ids >= 0, ids, 0)), np.inf)
            order = np.argsort(d, axis=1, kind="stable")
            rows = np.arange(len(part))[:, None]
            kept = self.prune(part, ids[rows, order], d[rows, order])
            self.edges[part, :] = -1
            self.edges[part[:, None], np.arange(s.degree)[None, :]] = kept
            self.count[part] = (kept >= 0).sum(axis=1)

    def build(self) -> "Graph":
        s, n = self.s, len(self.x)
        rng = np.random.default_rng(s.seed)
        middle = int(np.argmin(((self.x - self.x.mean(axis=0)) ** 2).sum(axis=1)))
        order = rng.permutation(n)
        order = np.concatenate([[middle], order[order != middle]])
        self.starts = order[:1]
        at, size = 1, 1
        while at < n:
            part = order[at:at + min(size, s.batch)]
            self.starts = order[:min(s.entries, at)]
            ids, d = self.walk(self.x[part], s.beam_build)
            self.link(part, self.prune(part, ids, d))
            at += len(part)
            size *= 2
        self.starts = order[:min(s.entries, n)]
        self.connect()
        return self

    def connect(self) -> None:
        """Gives every node that no walk can reach an edge from a reachable one, or makes it a start."""
        n = len(self.x)
        reached = np.zeros(n, bool)
        front = self.starts
        reached[front] = True
        lost: list[int] = []
        rest = iter(range(n))
        while True:
            while len(front):
                nxt = self.edges[front].ravel()
                nxt = np.unique(nxt[nxt >= 0])
                front = nxt[~reached[nxt]]
                reached[front] = True
            u = next((i for i in rest if not reached[i]), None)
            if u is None:
                break
            own = self.edges[u, :self.count[u]]
            near = [int(v) for v in own if reached[v] and self.count[v] < self.edges.shape[1]]
            if near:
                self.edges[near[0], self.count[near[0]]] = u
                self.count[near[0]] += 1
            else:
                lost.append(u)
            reached[u] = True
            front = np.array([u])
        if lost:
            self.starts = np.concatenate([self.starts, np.array(lost, self.starts.dtype)])


def _lifted(x: np.ndarray) -> np.ndarray:
    """One more coordinate so that all norms are equal: then the largest inner product is the nearest point."""
    squares = np.einsum("ij,ij->i", x.astype(np.float64), x.astype(np.float64))
    scale = float(np.sqrt(squares.max())) or 1.0
    more = np.sqrt(np.maximum(0.0, 1.0 - squares / scale ** 2))
    return np.concatenate([x.astype(np.float64) / scale, more[:, None]], axis=1).astype(np.float32)


def _build_shard(s: Settings):
    def run(key, rows):
        import pandas as pd

        rows = rows.sort_values("digest", kind="stable")
        x = np.array(rows["vector"].tolist(), np.float64)
        g = Graph(_lifted(x), s).build()
        ids = [np.asarray(v, np.int64) for v in rows["ids"]]
        return pd.DataFrame({
            "shard": [int(key[0])], "dim": [int(key[1])], "nodes": [len(x)], "vectors": [x.tobytes()],
            "edges": [g.edges.tobytes()], "starts": [g.starts.astype(np.int64).tobytes()],
            "ids": [np.concatenate(ids).tobytes()], "n_ids": [np.array([len(v) for v in ids], np.int64).tobytes()]})
    return run


INDEX_SCHEMA = ("shard long, dim int, nodes long, vectors binary, edges binary, starts binary, ids binary, "
                "n_ids binary")


def _search_shard(s: Settings, k: int):
    def run(key, index, queries):
        import pandas as pd

        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64),
                              "score": np.zeros(0)})
        if not len(index) or not len(queries):
            return empty
        i = index.iloc[0]
        x = np.frombuffer(i["vectors"], np.float64).reshape(int(i["nodes"]), -1)
        g = Graph(_lifted(x), s)
        g.edges = np.frombuffer(i["edges"], np.int32).reshape(len(x), -1)
        g.starts = np.frombuffer(i["starts"], np.int64)
        n_ids = np.frombuffer(i["n_ids"], np.int64)
        ids, ends = np.frombuffer(i["ids"], np.int64), np.cumsum(n_ids)
        out = []
        q_ids = queries["vec_id"].to_numpy(np.int64)
        q = np.array(queries["vector"].tolist(), np.float64)
        for at in range(0, len(q), s.batch):
            part, names = q[at:at + s.batch], q_ids[at:at + s.batch]
            norms = np.sqrt(np.einsum("ij,ij->i", part, part))[:, None]
            lifted = np.concatenate([part / norms, np.zeros((len(part), 1))], axis=1).astype(np.float32)
            found, _ = g.walk(lifted, max(s.beam_search, k + 1))
            for r in range(len(part)):
                nodes = found[r][found[r] >= 0]
                score = np.einsum("ij,j->i", x[nodes], part[r])
                best = np.argsort(-score, kind="stable")
                if len(best) > k + 1:  # equal scores stay together: ids decide among them
                    best = best[score[best] >= score[best[k]]]
                for b in best.tolist():
                    v = nodes[b]
                    members = ids[ends[v] - n_ids[v]:ends[v]]
                    members = members[members != names[r]]
                    out.append((np.full(len(members), names[r]), members, np.full(len(members), score[b])))
        if not out:
            return empty
        return pd.DataFrame({"query_id": np.concatenate([o[0] for o in out]),
                             "vec_id": np.concatenate([o[1] for o in out]),
                             "score": np.concatenate([o[2] for o in out])})
    return run


# ---- shards on Spark ----------------------------------------------------------

def usable(vector: Column) -> Column:
    """No null or non-finite component, and one that isn't zero."""
    whole = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return vector.isNotNull() & F.coalesce(whole & F.exists(vector, lambda v: v != 0), F.lit(False))


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    src = pick(vectors, vec_id=id_col, vector=vector_col).where(F.col("vec_id").isNotNull())
    src = src.withColumn("vector", F.col("vector").cast("array<double>")).where(usable(F.col("vector")))
    return src.withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("dim", F.size("vector"))


def build_index(vectors: DataFrame, k: int = 20, settings: Settings = Settings(), id_col: str = "vec_id",
                vector_col: str = "embedding") -> DataFrame:
    """The written index: a row per shard with its distinct vectors, graph and ids."""
    s = settings
    rows = _rows(vectors, id_col, vector_col).withColumn(
        "digest", F.md5(F.concat_ws(",", F.col("vector").cast("array<string>"))))
    first = F.row_number().over(Window.partitionBy("digest").orderBy("vec_id"))
    few = rows.dropDuplicates(["digest", "vec_id"]).withColumn("at", first).where(F.col("at") <= k + 1)
    nodes = materialize(few.groupBy("digest", "dim").agg(F.first("vector").alias("vector"),
                                                         F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    shards = max(1, -(-nodes.count() // s.shard_rows))
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)))
    return materialize(dealt.groupBy("shard", "dim").applyInPandas(_build_shard(s), INDEX_SCHEMA), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int = 20, settings: Settings = Settings(),
           id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest found of each query: query_id, rank, vec_id, score.

    Queries meet each shard in blocks, so a task holds one shard and one block.
    """
    s = settings
    rows = materialize(_rows(queries, id_col, vector_col), "queries")
    blocks = max(1, -(-rows.count() // s.query_block))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    shards = index.select(F.col("shard").alias("s"), F.col("dim").alias("d"))
    met = rows.join(shards, F.col("dim") == F.col("d")).select(  # every query of a dimension with its shards
        F.col("s").alias("shard"), "dim", "block", "vec_id", "vector")
    at = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    keys = ["shard", "dim", "block"]
    found = at.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInPandas(
        _search_shard(s, k), "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    ranked = once.withColumn("rank", best.cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_nearest(vectors: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """Neighbours of the rows whose vec_id is divisible by ``every``, among all rows."""
    return search(build_index(vectors, k), vectors.where(F.col("vec_id") % every == 0), k)
