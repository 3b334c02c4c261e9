"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard, answers merged.

Equal vectors are one node, which keeps the few smallest ids that any answer can need. Nodes are dealt over
shards of bounded size by hash; each shard's graph (Malkov and Yashunin 2018) is built in one task
and written as one row of flat arrays: vectors, neighbours at the ground level and above.
A node is inserted by searching the graph of those before it. Batches of nodes are searched in step, so that a step is
a few array operations; a batch is no larger than the graph it is inserted into, and its nodes see each other.
Blocks of queries meet every shard; a task holds one graph and one block. Each answers with
its nearest, and the shards' answers are merged by rank.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

NEAREST = 10
#: Nodes of a shard at most, and bytes of its vectors at most.
SHARD_NODES, SHARD_BYTES = 32768, 64 << 20
#: Queries that meet a shard together.
QUERY_BLOCK = 8192
#: Links above the ground level (twice as many on it), candidates of an insertion and of a search.
LINKS, BUILD_WIDTH, SEARCH_WIDTH = 16, 64, 400
#: Nodes or queries that are searched in step at most, and bytes of the vectors that a step looks at.
BATCH, STEP_BYTES = 256, 16 << 20

GRAPH = "shard long, dims int, vectors binary, ids binary, id_starts binary, links array<binary>"


def _distances(x: np.ndarray, at: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Squared distances of rows of ``x`` and the rows of ``q`` beside them."""
    apart = x[at] - q
    return np.einsum("...i,...i->...", apart, apart)


def _diverse(x: np.ndarray, of: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """For each node of ``of``, up to ``most`` of its row of candidates (-1: none): those nearer to it than to any
    chosen before, nearest first, then the nearest others. -1 where there are fewer."""
    chunk = max(1, STEP_BYTES // (8 * candidates.shape[1] * (candidates.shape[1] + x.shape[1])))
    if len(of) > chunk:
        return np.concatenate([_diverse(x, of[i:i + chunk], candidates[i:i + chunk], most) for i in range(0, len(of), chunk)])
    distances = np.where(candidates >= 0, _distances(x, candidates, x[of][:, None]), np.inf)
    order = np.argsort(distances, axis=1, kind="stable")
    candidates, distances = np.take_along_axis(candidates, order, 1), np.take_along_axis(distances, order, 1)
    part = x[candidates]
    norms = np.einsum("tcd,tcd->tc", part, part)
    between = norms[:, :, None] + norms[:, None, :] - 2 * part @ part.transpose(0, 2, 1)
    width = candidates.shape[1]
    chosen, shade = np.zeros(candidates.shape, bool), np.full(candidates.shape, np.inf)
    left = np.full(len(of), most)
    for k in range(width):
        take = np.flatnonzero((candidates[:, k] >= 0) & (distances[:, k] < shade[:, k]) & (left > 0))
        chosen[take, k] = True
        left[take] -= 1
        shade[take] = np.minimum(shade[take], between[take, k])
    rank = np.where(candidates < 0, 2 * width, np.where(chosen, 0, width)) + np.arange(width)
    out = np.full((len(of), most), -1, np.int32)
    first = np.argsort(rank, axis=1)[:, :most]
    out[:, :first.shape[1]] = np.take_along_axis(candidates, first, 1)
    return out


def _beam(x: np.ndarray, links: np.ndarray, q: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """The ``width`` nodes found nearest to each row of ``q``, nearest first (-1: none), best first from ``start``.

    A row ends when none of its nodes is unexpanded. With width 1 this is the greedy walk of the upper levels.
    """
    rows = np.arange(len(q))
    seen = np.zeros((len(q), len(links)), bool)
    seen[rows, start] = True
    nodes, far = np.full((len(q), width), -1, np.int32), np.full((len(q), width), np.inf)
    fresh = np.zeros((len(q), width), bool)
    nodes[:, 0], far[:, 0], fresh[:, 0] = start, _distances(x, start, q), True
    active = rows
    while True:
        ahead = np.where(fresh[active], far[active], np.inf)
        k = ahead.argmin(1)
        going = fresh[active, k]
        active, k = active[going], k[going]
        if not len(active):
            break
        fresh[active, k] = False
        near = links[nodes[active, k]]
        at, column = np.nonzero((near >= 0) & ~seen[active[:, None], near])
        if not len(at):
            continue
        ids = near[at, column]
        seen[active[at], ids] = True
        reached = np.full(near.shape, np.inf)
        reached[at, column] = _distances(x, ids, q[active[at]])
        # rows whose beam changes only
        changed = np.flatnonzero(reached.min(1) < far[active].max(1))
        rows_, new = active[changed], reached[changed]
        all_far = np.concatenate([far[rows_], new], 1)
        keep = np.argpartition(all_far, width - 1, axis=1)[:, :width]
        far[rows_] = np.take_along_axis(all_far, keep, 1)
        nodes[rows_] = np.take_along_axis(np.concatenate([nodes[rows_], np.where(np.isfinite(new), near[changed], -1)], 1), keep, 1)
        fresh[rows_] = np.take_along_axis(np.concatenate([fresh[rows_], np.isfinite(new)], 1), keep, 1)
    return np.take_along_axis(nodes, np.argsort(far, axis=1, kind="stable"), 1)


class Graph:
    """Flat arrays of one shard. Nodes are in falling order of their level, so those of a level are the first ones.

    Row i of ``links[level]`` holds node i's neighbours there, -1 where there are fewer. Node 0 is the entry.
    """

    def __init__(self, x: np.ndarray, links: list[np.ndarray]):
        self.x, self.links = x, links
        self.batch = int(np.clip(STEP_BYTES // (16 * LINKS * max(1, x.shape[1])), 8, BATCH))

    @staticmethod
    def order(n: int, seed: int) -> tuple[np.ndarray, list[int]]:
        """Nodes by falling random level, and how many each level has, the ground first."""
        levels = np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(LINKS)).astype(int), 8)
        return np.argsort(-levels, kind="stable"), [int((levels >= at).sum()) for at in range(int(levels.max(initial=0)) + 1)]

    @classmethod
    def build(cls, x: np.ndarray, sizes: list[int]) -> Graph:
        """Insert the nodes of each level, from the top one down, in batches."""
        graph = cls(x, [np.full((size, LINKS * (1 if level else 2)), -1, np.int32) for level, size in enumerate(sizes)])
        for level in reversed(range(len(sizes))):
            done = 0
            while done < sizes[level]:
                upto = min(sizes[level], done + min(graph.batch, max(done, BUILD_WIDTH)))
                graph._insert(level, done, upto)
                done = upto
        return graph

    def _insert(self, level: int, done: int, upto: int) -> None:
        """Link nodes done .. upto - 1 with a diverse choice of the nearest found among those before each."""
        new, links = np.arange(done, upto), self.links[level]
        q = self.x[done:upto]
        norms = np.einsum("ij,ij->i", q, q)
        mates = np.where(new[None, :] < new[:, None], norms[None, :] - 2 * q @ q.T, np.inf)
        nearest = np.argsort(mates, axis=1, kind="stable")[:, :BUILD_WIDTH // 4 if done else BUILD_WIDTH]
        candidates = np.where(np.isfinite(np.take_along_axis(mates, nearest, 1)), nearest + done, -1)
        if done:
            above = len(self.links[level + 1]) if level + 1 < len(self.links) else 0
            start = self._descend(q, level) if above and done >= above else np.zeros(len(q), np.int64)
            candidates = np.concatenate([_beam(self.x, links[:done], q, start, BUILD_WIDTH), candidates], 1)
        chosen = _diverse(self.x, new, candidates, LINKS)
        links[done:upto, :LINKS] = chosen
        source, column = np.nonzero(chosen >= 0)
        target = chosen[source, column].astype(np.int64)
        by_target = np.argsort(target, kind="stable")
        target, source = target[by_target], new[source[by_target]]
        nth = np.arange(len(target)) - np.searchsorted(target, target)
        most = links.shape[1]
        # as many new neighbours a pass as a node can have
        for low in range(0, int(nth.max(initial=-1)) + 1, most):
            now = (nth >= low) & (nth < low + most)
            of, row = np.unique(target[now], return_inverse=True)
            both = np.concatenate([links[of], np.full((len(of), most), -1, np.int32)], 1)
            both[row, most + nth[now] - low] = source[now]
            both = np.take_along_axis(both, np.argsort(both < 0, axis=1, kind="stable"), 1)
            full = both[:, most] >= 0
            links[of[~full]] = both[~full, :most]
            if full.any():
                links[of[full]] = _diverse(self.x, of[full], both[full], most)

    def _descend(self, q: np.ndarray, level: int) -> np.ndarray:
        """The node reached greedily for each row of ``q``, above ``level``."""
        at = np.zeros(len(q), np.int64)
        for links in reversed(self.links[level + 1:]):
            at = _beam(self.x, links, q, at, 1)[:, 0].astype(np.int64)
        return at

    def search(self, q: np.ndarray, width: int = SEARCH_WIDTH) -> np.ndarray:
        """Nodes found nearest to each row of ``q``, nearest first, -1 where there are fewer than ``width``."""
        parts = [q[i:i + self.batch] for i in range(0, len(q), self.batch)]
        return np.concatenate([_beam(self.x, self.links[0], part, self._descend(part, 0), width) for part in parts])


def _build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    group = group.sort_values("first_id")
    order, sizes = Graph.order(len(group), seed=0)
    group = group.iloc[order]
    x = np.stack(group.v.to_numpy()).astype(np.float64)
    graph = Graph.build(x, sizes)
    ids = [np.asarray(i, np.int64) for i in group.ids]
    starts = np.cumsum([0, *(len(i) for i in ids)]).astype(np.int64)
    return pd.DataFrame([{
        "shard": key[0], "dims": x.shape[1], "vectors": x.tobytes(), "ids": np.concatenate(ids).tobytes(),
        "id_starts": starts.tobytes(), "links": [links.tobytes() for links in graph.links],
    }])


def _search(nearest: int) -> Callable:
    def run(key: tuple, shards: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(shards) and len(queries):
            row = shards.iloc[0]
            x = np.frombuffer(row.vectors, np.float64).reshape(-1, int(row.dims))
            graph = Graph(x, [np.frombuffer(links, np.int32).reshape(-1, LINKS * (1 if level else 2)) for level, links in enumerate(row.links)])
            ids, starts = np.frombuffer(row.ids, np.int64), np.frombuffer(row.id_starts, np.int64)
            asked = np.stack(queries.v.to_numpy()).astype(np.float64)
            for query, q, found in zip(queries.query_id, asked, graph.search(asked)):
                nodes = found[found >= 0]
                scores = np.sqrt(((x[nodes] - q) ** 2).sum(1))
                answers = [(s, i) for s, node in zip(scores.tolist(), nodes) for i in ids[starts[node]:starts[node + 1]].tolist()
                           if i != query]
                out += [(query, i, s) for s, i in sorted(answers)[:nearest]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return run


def usable(vector: Column) -> Column:
    """Not null, not empty, all components finite, not all zero."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda c: c != 0)


def search_nearest(embeddings: DataFrame, is_query: Column, nearest: int = NEAREST, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """query_id, rank, vec_id, score: the ``nearest`` found for each row with ``is_query``, by Euclidean distance.

    ``embeddings`` needs vec_id and embedding; further columns may be used by ``is_query`` only. The row with the
    query's id is no answer to it; equal distances go by vec_id. Rows without vec_id and vectors that are null,
    empty, zero or not finite take no part; vectors of other lengths than the query's are no answers. A
    repeated row counts once. An empty table gives an empty one. A shard has ``shard_nodes`` different vectors on average.
    """
    rows = embeddings.withColumn("_query", is_query).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
        F.coalesce("_query", F.lit(False)).alias("_query"))
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("v")))
    # an answer can hold the smallest ``nearest`` ids of a vector, and the query's own is among one more
    by_vector = Window.partitionBy("v").orderBy("vec_id")
    smallest = rows.select("vec_id", "v").distinct().withColumn("_nth", F.row_number().over(by_vector)).filter(
        F.col("_nth") <= nearest + 1)
    nodes = stored(smallest.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    sizes = nodes.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("n")).select(
        "dims", F.ceil(F.col("n") / F.greatest(F.lit(1), F.least(F.lit(shard_nodes), F.floor(F.lit(SHARD_BYTES) / (8 * F.col("dims"))))))
        .cast("long").alias("shards"))
    # shards are numbered over all vector lengths; there are few of these
    first = Window.orderBy("dims").rowsBetween(Window.unboundedPreceding, -1)
    ranges = stored(sizes.withColumn("first", F.coalesce(F.sum("shards").over(first), F.lit(0))), "shards")
    placed = nodes.withColumn("dims", F.size("v")).join(ranges, "dims").select(
        (F.col("first") + F.pmod(F.xxhash64("v"), F.col("shards"))).alias("shard"), "v", "ids", F.col("ids")[0].alias("first_id"))
    graphs = stored(placed.groupBy("shard").applyInPandas(_build, GRAPH), "graphs")

    queries = stored(rows.filter("_query").select(F.col("vec_id").alias("query_id"), "v").distinct(), "queries")
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    asked = queries.withColumn("dims", F.size("v")).join(ranges, "dims").select(
        F.pmod(F.xxhash64("query_id"), F.lit(blocks)).alias("block"), "query_id", "v",
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1)).alias("shard"))
    held = graphs.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"))
    answers = held.groupBy("shard", "block").cogroup(asked.groupBy("shard", "block")).applyInPandas(
        _search(nearest), "query_id long, vec_id long, score double").distinct()
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return answers.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= nearest).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
