"""Operator 7, approximate nearest neighbours by a hierarchical navigable small-world graph for each shard.

Equal vectors are one node with its smallest ids (k + 1 different ones, with their counts, are all that can show up among
k). Nodes are dealt to shards of about `shard` by a hash of the vector. A shard's graph lives in flat arrays: one row of
neighbour numbers for each node and level, -1 where free. A level's nodes are linked to those of their `build` nearest
that are not nearer to a neighbour already chosen, in both directions; full rows are chosen anew in the same way. Nodes
that no path from the entry reaches get a link from a near node that is reached, so a graph is one piece. The finished
arrays are rows of a written table. Queries are broadcast in blocks of at most BLOCK vectors; every block searches every
shard, each task merges its shards' results, and Spark merges the tasks'. A query's own id is left out before the cut to
k. Final distances are exact, in double precision.

The work of queries is their number by that of shards, so `shard` is to be as large as a task's memory allows (about
1.2 kB for each node of 64 components), and recall is to be measured when it changes.

Defined results. Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows with a
null id. Equal distances: the smaller id first. Repeated ids: each row is a candidate, the query's own id is not. Fewer
than k candidates: all. Vectors of another length than the most common one take no part. Empty tables give empty
results. Other columns are not read.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliograph.llm.common import keep, release

SHARD, LINKS, BUILD, SEARCH, BLOCK, SPARE, ROWS = 65536, 16, 64, 128, 8192, 4, 128


class Graph:
    """An HNSW over the rows of a float32 matrix, which are all different."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, build: int = BUILD):
        self.v = np.ascontiguousarray(vectors, dtype=np.float32)
        n = len(self.v)
        self.norm = np.einsum("ij,ij->i", self.v, self.v)
        # levels by a rule, not by chance: the same rows give the same graph
        u = (np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)).astype(float) / 2**53
        level = np.minimum((-np.log(u + 1e-12) / np.log(links)).astype(np.int64), 8)
        self.seen, self.round, self.near = np.zeros(n, dtype=np.int64), 0, []
        self.top = int(level.max(initial=-1))
        self.entry = int(np.argmax(level)) if n else -1
        for k in range(self.top + 1):
            self.near.append(self._level(np.flatnonzero(level >= k), links * (2 if k == 0 else 1), links, build))
        if n:
            self._join()

    def _between(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.norm[x][:, None] + self.norm[y][None, :] - 2 * (self.v[x] @ self.v[y].T)

    def _level(self, members: np.ndarray, width: int, links: int, build: int) -> np.ndarray:
        """Rows of neighbours of the members, for all nodes, with SPARE free places at the end."""
        rows = np.full((len(self.v), width + SPARE), -1, dtype=np.int32)
        if len(members) < 2:
            return rows
        many = min(build, len(members) - 1)
        source, target, far = [], [], []
        for at in range(0, len(members), ROWS):
            x = members[at : at + ROWS]
            d = self._between(x, members)
            d[np.arange(len(x)), np.arange(at, at + len(x))] = np.inf
            nearest = np.argpartition(d, many - 1, axis=1)[:, :many]
            own = np.take_along_axis(d, nearest, axis=1)
            order = np.lexsort((nearest, own), axis=1)
            nearest, own = members[np.take_along_axis(nearest, order, axis=1)], np.take_along_axis(own, order, axis=1)
            chosen = self._choose(nearest, own, links)
            i, k = np.nonzero(chosen)
            source.append(x[i]), target.append(nearest[i, k]), far.append(own[i, k])
        a, b, d = (np.concatenate(v) for v in (source, target, far))
        # both directions, each link once, the nearest first
        a, b, d = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([d, d])
        first = np.unique(a * np.int64(len(self.v)) + b, return_index=True)[1]
        a, b, d = a[first], b[first], d[first]
        order = np.lexsort((b, d, a))
        a, b, d = a[order], b[order], d[order]
        place = np.arange(len(a)) - np.searchsorted(a, a)
        room = place < max(width, 2 * build)
        a, b, d, place = a[room], b[room], d[room], place[room]
        nodes, number = np.unique(a, return_inverse=True)
        size = np.bincount(number)
        fits = size[number] <= width
        rows[a[fits], place[fits]] = b[fits]
        crowded = np.flatnonzero(size > width)
        for at in range(0, len(crowded), ROWS):
            mine = crowded[at : at + ROWS]
            here = np.isin(number, mine)
            ids = np.full((len(mine), int(size[mine].max())), -1, dtype=np.int64)
            own = np.full(ids.shape, np.inf, dtype=np.float32)
            which = np.searchsorted(mine, number[here])
            ids[which, place[here]], own[which, place[here]] = b[here], d[here]
            chosen = self._choose(ids, own, width)
            i, k = np.nonzero(chosen)
            rows[nodes[mine][i], (np.cumsum(chosen, axis=1) - 1)[i, k]] = ids[i, k]
        return rows

    def _choose(self, ids: np.ndarray, own: np.ndarray, most: int) -> np.ndarray:
        """In each row of ids (nearest first, -1 behind the last), those no nearer to one chosen before than to the row's
        own node, then the nearest left: at most `most`, as a mask."""
        v, norm = self.v[ids], self.norm[ids]
        between = norm[:, :, None] + norm[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
        chosen = np.zeros(ids.shape, dtype=bool)
        closest = np.full(ids.shape, np.inf, dtype=np.float32)
        there = ids >= 0
        for k in range(ids.shape[1]):
            take = there[:, k] & (closest[:, k] > own[:, k]) & (chosen.sum(axis=1) < most)
            chosen[take, k] = True
            closest[take] = np.minimum(closest[take], between[take, k])
        left = there & ~chosen
        return chosen | (left & (np.cumsum(left, axis=1) <= most - chosen.sum(axis=1)[:, None]))

    def _join(self) -> None:
        """Links at level 0 for what a walk from the entry does not reach."""
        rows, reached = self.near[0], np.zeros(len(self.v), dtype=bool)
        front = np.array([self.entry])
        while True:
            reached[front] = True
            while len(front):
                front = np.unique(rows[front])
                front = front[front >= 0]
                front = front[~reached[front]]
                reached[front] = True
            lost = np.flatnonzero(~reached)
            if not len(lost):
                return
            free = np.flatnonzero(reached & (rows[:, -1] < 0))
            if not len(free):  # every reached row is full: one more column for all
                rows = self.near[0] = np.hstack([rows, np.full((len(rows), 1), -1, dtype=np.int32)])
                continue
            u = int(lost[0])
            w = int(free[np.argmin(self._between(lost[:1], free)[0])])
            rows[w, np.flatnonzero(rows[w] < 0)[0]] = u
            front = np.array([u])

    @classmethod
    def load(cls, blob: bytes) -> "Graph":
        self = cls.__new__(cls)
        a = np.load(io.BytesIO(blob))
        self.v, self.near = a["v"], [a[f"near{k}"] for k in range(int(a["levels"]))]
        self.norm = np.einsum("ij,ij->i", self.v, self.v)
        self.entry, self.top = int(a["entry"]), int(a["top"])
        self.seen, self.round = np.zeros(len(self.v), dtype=np.int64), 0
        return self

    def dump(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, v=self.v, levels=len(self.near), entry=self.entry, top=self.top, **{f"near{k}": x for k, x in enumerate(self.near)})
        return out.getvalue()

    def _distances(self, q: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Squared, less the query's own norm."""
        return self.norm[at] - 2 * (self.v[at] @ q)

    def _layer(self, q: np.ndarray, entry: list[tuple[float, int]], level: int, room: int) -> list[tuple[float, int]]:
        self.round += 1
        seen, mark, near = self.seen, self.round, self.near[level]
        best = [(-d, i) for d, i in entry]
        heapq.heapify(best)
        todo = list(entry)
        heapq.heapify(todo)
        for _, i in entry:
            seen[i] = mark
        while todo:
            d, i = heapq.heappop(todo)
            if d > -best[0][0] and len(best) >= room:
                break
            row = near[i]
            row = row[row >= 0]
            row = row[seen[row] != mark]
            if not len(row):
                continue
            seen[row] = mark
            ds = self._distances(q, row)
            if len(best) >= room:
                ok = ds < -best[0][0]
                row, ds = row[ok], ds[ok]
            for x, j in zip(ds.tolist(), row.tolist()):
                if len(best) < room:
                    heapq.heappush(best, (-x, j))
                elif x < -best[0][0]:
                    heapq.heapreplace(best, (-x, j))
                else:
                    continue
                heapq.heappush(todo, (x, j))
        return sorted((-d, i) for d, i in best)

    def search(self, q: np.ndarray, room: int) -> list[int]:
        if self.entry < 0:
            return []
        q = q.astype(np.float32)
        at = [(float(self._distances(q, np.array([self.entry]))[0]), self.entry)]
        for k in range(self.top, 0, -1):
            at = self._layer(q, at[:1], k, 1)
        return [i for _, i in self._layer(q, at, 0, room)]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (array<double>) of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(x, lambda c: c != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).select("vec_id", x.alias("embedding")).where(good)
    size = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("embedding") == (size[0].n if size else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def build_index(vectors: DataFrame, shard: int = SHARD, copies: int = 11) -> DataFrame:
    """shard, ids, times, vectors (doubles) and graph of each shard; vectors as from usable().

    ids and times have `copies` places for each node: its smallest ids and how many rows have them (0 where there is none).
    """
    rows = vectors.groupBy("embedding", F.col("vec_id").cast("long").alias("vec_id")).agg(F.count(F.lit(1)).alias("times"))
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    rows = rows.withColumn("place", place).where(F.col("place") <= copies)
    nodes = keep(rows.groupBy("embedding").agg(F.sort_array(F.collect_list(F.struct("vec_id", "times"))).alias("held")), "hnsw-nodes")
    shards = max(1, -(-nodes.count() // shard))

    def emit(number: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        held = [x for p in parts for x in p["held"].to_pylist()]
        v = np.concatenate([_matrix(p["embedding"]) for p in parts])
        order = sorted(range(len(held)), key=lambda i: (held[i][0]["vec_id"], v[i].tolist()))
        ids, times = np.zeros((len(held), copies), dtype="<i8"), np.zeros((len(held), copies), dtype="<i8")
        for i, k in enumerate(order):
            for j, x in enumerate(held[k]):
                ids[i, j], times[i, j] = x["vec_id"], x["times"]
        v = v[order]
        return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *(pa.array([x.tobytes()]) for x in (ids, times, v.astype("<f8"))), pa.array([Graph(v).dump()])], names=["shard", "ids", "times", "vectors", "graph"])

    def run(batches):
        now, held = None, []
        for batch in batches:
            numbers = batch["shard"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], numbers[1:] != numbers[:-1]]))
            for a, b in zip(cuts, np.append(cuts[1:], len(numbers))):
                if now is not None and numbers[a] != now:
                    yield emit(now, held)
                    held = []
                now = int(numbers[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield emit(now, held)
        release()

    rows = nodes.withColumn("shard", F.pmod(F.xxhash64("embedding"), F.lit(shards)))
    return rows.repartitionByRange(shards, "shard").sortWithinPartitions("shard").mapInArrow(run, "shard long, ids binary, times binary, vectors binary, graph binary")


def search(index: DataFrame, queries: DataFrame, k: int = 10, room: int = SEARCH, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query, by exact Euclidean distance."""
    sc = index.sparkSession.sparkContext
    found, held = [], []

    def look(shared) -> DataFrame:
        def run(batches):
            qids, q = shared.value
            best_d = np.full((len(qids), k), np.inf)
            best_i = np.full((len(qids), k), np.iinfo(np.int64).max)
            for batch in batches:
                for ids, times, vectors, graph in zip(batch["ids"], batch["times"], batch["vectors"], batch["graph"]):
                    graph = Graph.load(graph.as_py())
                    n = len(graph.v)
                    ids, times = (np.frombuffer(x.as_py(), dtype="<i8").reshape(n, -1) for x in (ids, times))
                    v = np.frombuffer(vectors.as_py(), dtype="<f8").reshape(n, -1)
                    if v.shape[1] != q.shape[1]:
                        continue
                    for i in range(len(qids)):
                        at = np.array(graph.search(q[i], max(room, k + 1)), dtype=np.int64)
                        d = np.sqrt(((v[at] - q[i]) ** 2).sum(axis=1))
                        # own rows are no candidates; of one id, k rows are enough
                        many = np.where(ids[at] == qids[i], 0, np.minimum(times[at], k)).ravel()
                        d, own = np.repeat(np.repeat(d, ids.shape[1]), many), np.repeat(ids[at].ravel(), many)
                        d, own = np.concatenate([best_d[i], d]), np.concatenate([best_i[i], own])
                        order = np.lexsort((own, d))[:k]
                        best_d[i], best_i[i] = d[order], own[order]
            row, col = np.nonzero(np.isfinite(best_d))
            yield pa.RecordBatch.from_arrays([pa.array(qids[row]), pa.array(best_i[row, col]), pa.array(best_d[row, col])], names=["query_id", "vec_id", "score"])
            release()

        return index.select("ids", "times", "vectors", "graph").mapInArrow(run, "query_id long, vec_id long, score double")

    def close() -> None:
        ids = np.array([r.vec_id for r in held], dtype=np.int64)
        q = np.array([r.embedding for r in held], dtype=np.float64) if held else np.empty((0, 1))
        found.append(look(sc.broadcast((ids, q))))
        held.clear()

    for row in queries.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").toLocalIterator():
        held.append(row)
        if len(held) == block:
            close()
    if held or not found:
        close()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, every: int = 100, k: int = 10) -> DataFrame:
    """search() of the ids divisible by `every` among all others; of an id's vectors, if several, the least is the query."""
    rows = usable(vectors)
    index = keep(build_index(rows, copies=k + 1), "hnsw")
    return search(index, rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), k)
