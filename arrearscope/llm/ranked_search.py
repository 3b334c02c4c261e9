"""Exact ranked lexical search by sparse ball trees.

A document is a sparse vector over the query items' terms: the saturated, length-normalised term frequencies. An item is
the vector of its terms' weights, and a score is their inner product, an integer. Every task keeps its documents in
ball trees: a node knows the centroid of its documents and a radius that reaches them all, so that no document below it can score
more than ``q . centroid + |q| * radius``. For each item the nodes are visited best bound first, leaves are scored exactly in
integers, and what can't reach the item's tenth best score any more is left out. Neither sampling nor early stopping: a subtree is
dropped only if its bound is below the tenth score, and bounds are rounded up.

Two things tighten the bounds. Coordinates are multiplied by the square root of the term's weight on both sides, which leaves the product
as it is but makes common words count little in the distances. And outside the terms that occur below a
node both the centroid and the documents are zero, so only the query's part on these terms stands beside the radius.

Spark reads every text once for its length and the items' terms in it, sums the statistics over all of them, and
deals the compact vectors over tasks. A task's best documents for each item go to the merge. Items come in blocks of bounded
size, each searched against all documents.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Documents a leaf has at most; different vectors, and their entries, of one tree.
LEAF, TREE, TREE_ENTRIES = 64, 32_768, 4_000_000
#: Items, and bytes of their texts, that are searched together, about.
BLOCK_ITEMS, BLOCK_BYTES = 2_000, 4_000_000
TOP = 10
#: Relative and absolute allowance above a bound or radius computed in doubles. A block's items have fewer than 2^22 terms, so the
#: relative error of a sum of non-negative numbers over them is below 2^-31.
SAFE, SAFE_ADD = 1 + 2.0**-30, 1.0
#: Bytes to terms: A-Z are lower-cased, other ASCII than digits and letters separates.
_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text as UTF-8, in order, with repeats."""
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split(b" ") if text else []


def counts_of(text: str | None) -> Counter:
    found = Counter(terms_of(text))
    found.pop(b"", None)
    return found


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


@dataclass
class Vectors:
    """Sparse rows: row ``i`` has entries ``offsets[i]`` to ``offsets[i + 1]``."""

    offsets: np.ndarray
    terms: np.ndarray
    values: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def take(self, rows: np.ndarray) -> Vectors:
        sizes = self.offsets[rows + 1] - self.offsets[rows]
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        at = np.arange(offsets[-1]) + np.repeat(self.offsets[rows] - offsets[:-1], sizes)
        return Vectors(offsets, self.terms[at], self.values[at])

    def dot(self, dense: np.ndarray) -> np.ndarray:
        """Inner products with a dense vector; every row has an entry."""
        return np.add.reduceat(self.values * dense[self.terms], self.offsets[:-1])


class BallTree:
    """Ball tree over ``vectors`` (integers, each row with an entry); ``scale`` is the square root of each term's weight."""

    def __init__(self, vectors: Vectors, scale: np.ndarray, leaf: int = LEAF):
        self.scale = scale
        self.nodes: list[tuple] = []  # (terms, centroid, radius, children, rows of a leaf)
        self._dense = np.zeros(len(scale))
        scaled = Vectors(vectors.offsets, vectors.terms, vectors.values * scale[vectors.terms])
        root = np.arange(len(vectors))
        waiting = [(root, None)]
        while waiting:
            rows, parent = waiting.pop()
            own = scaled.take(rows)
            node = self._ball(own)
            number = len(self.nodes)
            if parent is not None:
                self.nodes[parent][3].append(number)
            halves = None if len(rows) <= leaf or node[2] <= SAFE_ADD else self._halves(own)
            self.nodes.append((*node, [], None if halves else vectors.take(rows), rows))
            if halves:
                waiting += [(rows[half], number) for half in halves]

    def _ball(self, own: Vectors) -> tuple[np.ndarray, np.ndarray, float]:
        terms, at = np.unique(own.terms, return_inverse=True)
        centre = np.bincount(at, weights=own.values) / len(own)
        # |x - c|^2 = |c|^2 + sum over the row's entries of (x - c)^2 - c^2, with rounding against the larger parts of it
        near = centre[at]
        square = float(centre @ centre)
        sums = np.add.reduceat((own.values - near) ** 2 - near ** 2, own.offsets[:-1])
        most = np.add.reduceat(own.values ** 2 + 4 * near ** 2, own.offsets[:-1])
        distance = np.maximum(square + sums, 0.0) + (square + most) * (SAFE - 1)
        return terms, centre, math.sqrt(float(distance.max())) * SAFE

    def _halves(self, own: Vectors) -> tuple[np.ndarray, np.ndarray] | None:
        """Rows nearer to one of two far-apart rows than to the other, in halves; none if all are equal."""
        norms = np.add.reduceat(own.values ** 2, own.offsets[:-1])

        def distances(i: int) -> np.ndarray:
            entries = slice(own.offsets[i], own.offsets[i + 1])
            self._dense[own.terms[entries]] = own.values[entries]
            out = norms + norms[i] - 2 * own.dot(self._dense)
            self._dense[own.terms[entries]] = 0
            return out

        one = distances(int(distances(0).argmax()))
        other = distances(int(one.argmax()))
        order = np.argsort(one - other, kind="stable")
        if float((one - other)[order[-1]]) == float((one - other)[order[0]]):
            return None
        return order[:len(order) // 2], order[len(order) // 2:]

    def _bound(self, node: int, query: np.ndarray) -> float:
        terms, centre, radius = self.nodes[node][:3]
        own = query[terms]
        return float(centre @ own + math.sqrt(float(own @ own)) * radius) * SAFE + SAFE_ADD

    def search(self, terms: np.ndarray, weights: np.ndarray, best: TopRows, keys: list) -> int:
        """Offer ``best`` all rows that can be among its highest; ``keys``: of each row. The number of leaves that were scored."""
        exact, query = np.zeros(len(self.scale), np.int64), np.zeros(len(self.scale))
        exact[terms], query[terms] = weights, self.scale[terms]
        heap, scored = [(-self._bound(0, query), 0)], 0
        while heap and -heap[0][0] >= best.least:
            node = heapq.heappop(heap)[1]
            _, _, _, children, own, rows = self.nodes[node]
            for child in children:
                bound = self._bound(child, query)
                if bound >= best.least:
                    heapq.heappush(heap, (-bound, child))
            if own is not None:
                scored += 1
                scores = own.dot(exact)
                for i in np.flatnonzero(scores >= best.least):
                    for key in keys[rows[i]]:
                        best.offer(int(scores[i]), key)
        return scored


class TopRows:
    """The ``n`` highest scores, ties by the smaller doc_id (none first)."""

    def __init__(self, n: int = TOP):
        self.n, self.heap = n, []

    @property
    def least(self) -> int:
        """A score below this can't come in; one of 0 never does."""
        return self.heap[0][0] if len(self.heap) == self.n else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is None, -(doc_id or 0))
        if len(self.heap) < self.n:
            heapq.heappush(self.heap, entry)
        elif entry > self.heap[0]:
            heapq.heapreplace(self.heap, entry)

    def rows(self) -> list[tuple[int | None, int]]:
        return [(None if missing else -negative, score) for score, missing, negative in self.heap]


def _profiles(vocabulary: dict[bytes, int]):
    """For ``mapInArrow``: (doc_id, text) to (doc_id, n_terms, terms, tfs), the numbers of the vocabulary's terms ascending."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, terms, tfs = [], [], []
            for text in batch.column(1):
                found = counts_of(text.as_py())
                lengths.append(found.total())
                own = sorted((vocabulary[t], tf) for t, tf in found.items() if t in vocabulary)
                terms.append([t for t, _ in own])
                tfs.append([tf for _, tf in own])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lengths, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))],
                names=["doc_id", "n_terms", "terms", "tfs"])

    return run


def _searcher(queries: list[tuple[int | None, np.ndarray, np.ndarray]], scale: np.ndarray, top: int):
    """For ``mapInArrow``: (doc_id, terms, values) to this task's best (item, doc_id, score) of every query."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [TopRows(top) for _ in queries]
        held: dict[bytes, tuple[np.ndarray, np.ndarray, list]] = {}
        entries = 0

        def search() -> None:
            groups = list(held.values())
            held.clear()
            vectors = Vectors(
                np.concatenate([[0], np.cumsum([len(t) for t, _, _ in groups])]),
                np.concatenate([t for t, _, _ in groups]), np.concatenate([v for _, v, _ in groups]))
            tree = BallTree(vectors, scale)
            keys = [k for _, _, k in groups]
            for (_, terms, weights), rows in zip(queries, best):
                if len(terms):
                    tree.search(terms, weights, rows, keys)

        for batch in batches:
            offsets = batch.column(1).offsets.to_numpy()
            terms, values = batch.column(1).values.to_numpy(), batch.column(2).values.to_numpy()
            for doc_id, first, last in zip(batch.column(0).to_pylist(), offsets, offsets[1:]):
                own, theirs = terms[first:last], values[first:last]
                name = own.tobytes() + theirs.tobytes()
                if name in held:
                    # of equal vectors, which tie for every item, the first doc_ids only can be among the best
                    keys = held[name][2]
                    keys.append(doc_id)
                    if len(keys) >= 64 + top:
                        keys.sort(key=lambda k: (k is not None, k or 0))
                        del keys[top:]
                    continue
                if len(held) == TREE or entries >= TREE_ENTRIES:
                    search()
                    entries = 0
                held[name] = (own.copy(), theirs.copy(), [doc_id])
                entries += len(own)
        if held:
            search()
        rows = [(i, *row) for i, found in enumerate(best) for row in found.rows()]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    return run


def _search_block(docs: DataFrame, items: list[tuple[int | None, str]], top: int) -> DataFrame | None:
    """Best documents of a block of items, or none if they have no terms. ``items``: (item_id, text)."""
    told: dict[int | None, set[bytes]] = {}
    for item_id, text in items:
        told.setdefault(item_id, set()).update(counts_of(text))
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*told.values())))}
    if not vocabulary:
        return None
    profiles = stored(docs.mapInArrow(
        _profiles(vocabulary), "doc_id long, n_terms long, terms array<int>, tfs array<long>"), "profiles")
    n_docs, n_terms = profiles.filter("n_terms > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    spread = profiles.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for row in spread.collect():  # one row a term of the block's items
        weights[row["term"]] = weight(n_docs, row["df"])
    # zero weights add nothing, and terms without a document have none
    known = [(item_id, np.array(sorted(i for i in map(vocabulary.get, terms) if weights[i] > 0), np.int64)) for item_id, terms in told.items()]
    queries = [(item_id, terms, weights[terms]) for item_id, terms in known]
    m = F.expr(f"10 + (90 * n_terms * {n_docs}L) div {max(n_terms, 1)}L")
    value = F.expr("transform(tfs, tf -> (1000000000L * tf) div (1000L * tf + 8L * m))")
    vectors = profiles.filter(F.size("terms") > 0).withColumn("m", m).select("doc_id", "terms", value.alias("values"))
    found = vectors.mapInArrow(_searcher(queries, np.sqrt(weights.astype(float)), top), "item int, doc_id long, score long")
    names = F.array(*(F.lit(item_id).cast("long") for item_id, _, _ in queries))
    return found.select(F.get(names, F.col("item")).alias("item_id"), "item", "doc_id", "score")


def search_ranked(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` highest-scoring rows of ``docs`` for each item, whole texts, score above 0.

    Equal scores are ranked by ascending doc_id, null first. Repeated rows of ``docs`` are rows of their own and count as such in all
    statistics. Items that share an item_id (null included) are one item with the terms of all. Null and empty texts have no terms:
    such documents are never found and such items find nothing, as in empty tables. Only doc_id, item_id and
    the texts are read, so further columns can't clash.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    told = stored(items.filter(F.col("text").isNotNull()).select(F.col("item_id").cast("long").alias("item_id"), "text"), "items")
    n, size = told.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-size // BLOCK_BYTES))
    found = None
    for block in range(blocks):
        own = told.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # a block of bounded size
        part = _search_block(rows, [tuple(row) for row in own], top) if own else None
        if part is not None:
            part = part.withColumn("block", F.lit(block))
            found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    place = F.row_number().over(Window.partitionBy("block", "item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_first()))
    return found.withColumn("rank", place).filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


SQL = r"""
WITH texts AS (
 SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}') AS terms FROM documents),
asked AS (
 SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{pattern}')) AS term FROM benchmark),
size AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM texts WHERE len(terms) > 0),
tf AS (
 SELECT r, doc_id, len(terms) AS n, term, count(*) AS tf FROM (SELECT r, doc_id, terms, unnest(terms) AS term FROM texts)
 WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, size GROUP BY term),
scored AS (
 SELECT item_id, doc_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
 FROM asked JOIN tf USING (term) JOIN w USING (term), size GROUP BY item_id, doc_id, r),
ranked AS (
 SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= {top}"""


def sql(top: int = TOP) -> str:
    return SQL.replace("{pattern}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").replace("{top}", str(top))
