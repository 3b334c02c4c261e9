"""Gradient-boosted trees with second-order, penalised leaves, grown from histograms.

Rows are binned once, to a byte a feature, and kept in blocks of whole columns. A pass over the blocks adds up gradient, hessian and
number of rows by (node, feature, bin) for all nodes in question at once: tasks sum their own rows, the partial histograms are
summed by groups of features in further tasks, which pick the group's best split of each node. Only these splits reach the
driver. A tree takes as many passes as it has levels. The blocks are an RDD because a pass is imperative work on whole
blocks, and a model takes more than a thousand passes: a plan for each, with Python on both sides of an exchange,
takes four times as long.

Growth is best split first, until a tree has ``leaves`` leaves; without that bound it is the usual growth level by level. A
node's best split depends on nothing but its rows, so all nodes that can still be reached are looked at in one pass, and those
whose split can't be among the chosen ones any more are left out.

Sums are exact: gradients and hessians are rounded to multiples of a power of two that is small enough for
precision and large enough for the total over all rows to fit a double's integers. Once cuts are found, trees don't depend on the order of tasks.
Trees grown since margins were last brought up to date are walked in each pass; new blocks follow every ``REFRESH`` trees.

A fitted model is a table of nodes. Scores walk it in batches of rows, importances and checks are DataFrame expressions over it.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.config import BoostedTreesParams
from arrearscope.operators.metrics import ranking_metrics, score_curve
from arrearscope.sources.storage import stored

#: Trees between two renewals of the blocks' margins, and renewals that build on the one before.
REFRESH, CHAIN = 5, 10
#: Rows of a block, and of a partition of blocks.
BLOCK_ROWS, ROWS_PER_PARTITION = 16_384, 128_000
#: More partitions than cores only for partitions of more rows than this.
MOST_ROWS = 1_000_000
#: Rows that walk a fitted model's trees together: their values stay in the processor's cache.
WALK_ROWS = 4_096
#: Joint bins of features that are added up as one: their sums stay in the processor's cache.
PACK_BINS = 256
#: Rows up to which cuts are exact.
EXACT_ROWS = 1_000
#: Bits of a double's integers that a sum over all rows may take.
SUM_BITS = 52
#: A split must gain more than this.
LEAST_GAIN = 1e-6
NODES = ("tree int, node int, feature int, name string, bin int, threshold double, left int, right int, gain double, "
         "gradient double, hessian double, n long, weight double")
BINNED = "row long, bins binary, label double, weight double, is_validation boolean, margin double"


@dataclass
class Node:
    depth: int
    gradient: float
    hessian: float
    n: int
    best: tuple | None = None  # (gain, feature, bin, left sums, right sums); none yet, or none possible
    seen: bool = False
    left: int = -1
    right: int = -1


@dataclass
class Tree:
    """Arrays by node; a leaf goes to itself."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def leaves_of(self, bins: np.ndarray, rows: np.ndarray | None = None) -> np.ndarray:
        """The leaf each row reaches, or each of ``rows``; ``bins`` has a column a row."""
        flat, rows = bins.ravel(), np.arange(bins.shape[1]) if rows is None else rows
        start, child = self.feature * bins.shape[1], np.stack([self.left, self.right], 1).ravel()
        at = np.zeros(len(rows), np.int64)
        for _ in range(self.depth):
            right = flat.take(start.take(at) + rows) > self.bin.take(at)
            at = child.take(2 * at + right)
        return at


@dataclass
class Booster:
    """A fitted model: ``base`` margin and a row for each node (``NODES``), leaves without a feature."""

    base: float
    nodes: list[tuple]
    feature_names: list[str]
    validation_auc: list[float] = field(default_factory=list)  # of every prefix that was looked at

    @property
    def n_trees(self) -> int:
        return 1 + max((row[0] for row in self.nodes), default=-1)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.nodes, NODES)

    def cut(self, trees: int) -> Booster:
        """The model of the first ``trees`` trees."""
        return Booster(self.base, [row for row in self.nodes if row[0] < trees], self.feature_names, self.validation_auc)

    def margin(self, values: Column) -> Column:
        """Log-odds of rows whose feature values are the array ``values``."""
        return walked_sums(self.nodes, values, self.base)

    def probability(self, values: Column) -> Column:
        return 1 / (1 + F.exp(-self.margin(values)))


def _node_arrays(nodes: Sequence[tuple]) -> tuple[list, ...]:
    """Roots, and feature, threshold, left, right, weight and depth by node, of a node table; a leaf is its own child."""
    ordered = sorted(nodes, key=lambda r: (r[0], r[1]))
    place = {(row[0], row[1]): i for i, row in enumerate(ordered)}
    roots, feature, threshold, left, right, weight, depth = [], [], [], [], [], [], [0] * len(ordered)
    for i, row in enumerate(ordered):
        tree, leaf = row[0], row[2] is None
        roots += [i] if row[1] == 0 else []
        feature.append(0 if leaf else row[2])
        threshold.append(0.0 if leaf else row[5])
        left.append(i if leaf else place[tree, row[6]])
        right.append(i if leaf else place[tree, row[7]])
        weight.append(row[12])
    for i in range(len(ordered)):
        for child in {left[i], right[i]} - {i}:
            depth[child] = depth[i] + 1  # parents come before their children
    return roots, feature, threshold, left, right, weight, depth


def tree_sums(nodes: Sequence[tuple], values: Column, base: float = 0.0) -> Column:
    """``base`` and the weights of the leaves that ``values`` (array of doubles) reaches in all trees of a node table.

    Every tree is walked down level by level in one expression of built-in functions, over node arrays that are literals of
    the plan: all walks take as many steps as the deepest tree has levels.
    """
    if not nodes:
        return F.lit(base)
    roots, feature, threshold, left, right, weight, depth = _node_arrays(nodes)
    steps = F.array(*(F.lit(s) for s in range(max(depth)))).cast("array<int>")
    lists = {name: F.lit(found) for name, found in (
        ("feature", feature), ("threshold", threshold), ("left", left), ("right", right), ("weight", weight))}

    def down(at: Column, _: Column) -> Column:
        return F.when(F.get(values, F.get(lists["feature"], at)) <= F.get(lists["threshold"], at), F.get(lists["left"], at)).otherwise(
            F.get(lists["right"], at))

    return F.aggregate(F.lit(roots), F.lit(float(base)), lambda total, root: total + F.get(
        lists["weight"], F.aggregate(steps, root, down)))


def _walker(nodes: Sequence[tuple], base: float):
    """For ``arrow_udf``: arrays of doubles to ``base`` and the weights of the leaves they reach, tree after tree."""
    roots, *columns, depth = _node_arrays(nodes)
    feature, threshold, left, right, weight = map(np.array, columns)
    child = np.stack([right, left], 1).ravel()  # a missing value goes to the right
    deepest = [max(depth[start:end]) for start, end in zip(roots, [*roots[1:], len(depth)])]

    def sums(values: np.ndarray) -> np.ndarray:
        flat, start = values.ravel(), np.arange(len(values)) * values.shape[1]
        total = np.full(len(values), base)
        for root, levels in zip(roots, deepest):
            at = np.full(len(values), root)
            for _ in range(levels):
                at = child.take(2 * at + (flat.take(start + feature.take(at)) <= threshold.take(at)))
            total += weight.take(at)
        return total

    def run(values: pa.Array) -> pa.Array:
        filled = values.is_valid().to_numpy(zero_copy_only=False)
        found = values.flatten().to_numpy(zero_copy_only=False)
        if not len(found):
            return pa.array(sums(np.full((len(values), int(feature.max()) + 1), np.nan)))
        rows = found.reshape(filled.sum(), -1)
        if not filled.all():
            every = np.full((len(values), rows.shape[1]), np.nan)
            every[filled] = rows
            rows = every
        return pa.array(np.concatenate([sums(rows[i:i + WALK_ROWS]) for i in range(0, len(rows), WALK_ROWS)]))

    return run


def walked_sums(nodes: Sequence[tuple], values: Column, base: float = 0.0) -> Column:
    """What :func:`tree_sums` gives, to the last bit, from batches of rows that walk a tree together."""
    return F.arrow_udf(_walker(nodes, float(base)), "double")(values) if nodes else F.lit(base)


def cut_points(values: DataFrame, names: Sequence[str], max_bins: int, n: int | None = None) -> list[list[float]]:
    """At most ``max_bins - 1`` ascending cuts for each of the double columns ``names``, from one aggregate; ``n``: the rows, if known.

    Up to ``EXACT_ROWS`` the cuts are exact, and so the same for any partitions; beyond, one is off by a tenth of a bin at most, which
    may depend on partitions.
    """
    shares = [i / max_bins for i in range(1, max_bins)]
    n = values.count() if n is None else n
    accuracy = max(10 * max_bins, 2 * n + 1 if n <= EXACT_ROWS else 0)
    row = values.agg(*(F.percentile_approx(name, shares, accuracy).alias(name) for name in names),
                     *(F.max(name).alias(f"max_{name}") for name in names)).first()
    # a cut at the greatest value would leave nothing on its right
    return [sorted({c for c in row[name] or [] if c < row[f"max_{name}"]}) for name in names]


def _binner(cuts: list[list[float]]):
    """For ``mapInArrow``: values to the number of cuts below them, a byte a feature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = [np.array(c) for c in cuts]
        for batch in batches:
            rows, names = batch.num_rows, batch.schema.names
            values = batch.column(names.index("x")).flatten().to_numpy().reshape(rows, len(edges))
            bins = np.empty((rows, len(edges)), np.uint8)
            for i, edge in enumerate(edges):
                bins[:, i] = np.searchsorted(edge, values[:, i], side="left")
            data = pa.Array.from_buffers(pa.binary(), rows, [
                None, pa.py_buffer(np.arange(0, (rows + 1) * len(edges), len(edges), dtype=np.int32)), pa.py_buffer(bins.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), data, *batch.columns[2:]], names=["row", "bins", *names[2:]])

    return run


def _bins(batch: pa.RecordBatch, width: int) -> np.ndarray:
    column = batch.column(1)
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].reshape(len(column), width)


def _uniform(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row and tree, by the mixing steps of splitmix64."""
    with np.errstate(over="ignore"):
        x = row.astype(np.uint64) + np.uint64((seed * 1_000_003 + tree + 1) % 2**64) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53


def _gradients(label: np.ndarray, weight: np.ndarray, margin: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted logistic loss, as whole numbers of ``1 / scale``."""
    p = 1 / (1 + np.exp(-margin))
    return np.rint(weight * (p - label) * scale), np.rint(weight * np.maximum(p * (1 - p), 1e-16) * scale)


def soft(gradient: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(gradient) * np.maximum(np.abs(gradient) - l1, 0.0)


def leaf_weight(gradient: float, hessian: float, l1: float, l2: float) -> float:
    """The weight that minimises the penalised second-order loss of a leaf."""
    return 0.0 if hessian + l2 == 0 else float(-soft(np.float64(gradient), l1) / (hessian + l2))


def best_splits(histogram: np.ndarray, params: BoostedTreesParams, scale: float) -> list[tuple | None]:
    """(gain, feature place, bin, left sums, right sums) of each node's best cut in a (features, nodes, bins, 3) histogram.

    Ties go to the first feature and its lowest bin. Nodes that nothing may split have none.
    """
    left = np.cumsum(histogram, axis=2)[:, :, :-1]
    total = histogram.sum(axis=2, keepdims=True)
    right = total - left

    def quality(sums: np.ndarray) -> np.ndarray:
        return soft(sums[..., 0] / scale, params.l1) ** 2 / np.maximum(sums[..., 1] / scale + params.l2, 1e-300)

    gain = quality(left) + quality(right) - quality(total)
    allowed = ((np.minimum(left[..., 2], right[..., 2]) >= max(params.min_rows_per_leaf, 1))
               & (np.minimum(left[..., 1], right[..., 1]) / scale >= params.min_hessian_per_leaf))
    gain = np.where(allowed, gain, -np.inf).transpose(1, 0, 2)
    flat = gain.reshape(len(gain), -1)
    if not flat.shape[1]:
        return [None] * len(gain)
    out = []
    for node, at in enumerate(flat.argmax(axis=1)):
        f, b = divmod(int(at), gain.shape[2])
        best = float(flat[node, at])
        out.append((best, f, b, left[f, node, b].tolist(), right[f, node, b].tolist()) if best > LEAST_GAIN else None)
    return out


def _better(one: tuple | None, other: tuple | None) -> tuple | None:
    """The split with more gain; of equals that of the first feature."""
    if one is None or other is None:
        return one or other
    return max(one, other, key=lambda split: (split[0], -split[1]))


def _spread(features: Sequence[int], widths: Sequence[int], parts: int) -> list[list[int]]:
    """``features`` in at most ``parts`` groups of about equal numbers of bins."""
    groups = [[] for _ in range(max(1, min(parts, len(features))))]
    sizes = [0] * len(groups)
    for f in sorted(features, key=lambda f: (-widths[f], f)):
        least = sizes.index(min(sizes))
        groups[least].append(f)
        sizes[least] += widths[f]
    return groups


def _packs(features: Sequence[int], widths: Sequence[int]) -> list[tuple[int, list[int]]]:
    """``features`` in packs whose joint bins are ``PACK_BINS`` at most, unless one alone has more; each with their number."""
    packs = []
    for f in sorted(features, key=lambda f: (-widths[f], f)):
        for i, (size, members) in enumerate(packs):
            if size * widths[f] <= PACK_BINS:
                packs[i] = (size * widths[f], [*members, f])
                break
        else:
            packs.append((widths[f], [f]))
    return packs


def _joint(x: np.ndarray, members: Sequence[int], widths: Sequence[int]) -> np.ndarray:
    """The joint bin of a pack's features for each row."""
    code = x[members[0]]
    for f in members[1:]:
        code = code.astype(np.uint16) * np.uint16(widths[f]) + x[f]
    return code


def _histogram(trees: list[Tree], tree: Tree, slots: np.ndarray, groups: list[list[int]], widths: Sequence[int],
               number: int, params: BoostedTreesParams, scale: float):
    """For ``mapPartitions``: blocks to (group, sums of all of them), the (nodes, bins, 3) of a group's features, one after the other.

    Rows are added up by the joint bins of packs of narrow features, whose own sums are those over the others' bins.
    """
    packs = _packs([f for group in groups for f in group], widths)

    def run(blocks: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        wanted = int(slots.max()) + 1
        joint = [np.zeros((3, wanted * size)) for size, _ in packs]
        for row, x, label, weight, margin in blocks:
            mine = np.arange(len(row))
            if params.row_sample < 1:
                mine = np.flatnonzero(_uniform(row, number, params.seed) < params.row_sample)
            slot = slots[tree.leaves_of(x, mine)]
            inside = slot >= 0
            if not inside.all():
                mine, slot = mine[inside], slot[inside]
            if not len(mine):
                continue
            margin = margin[mine]
            for grown in trees:
                margin = margin + grown.value[grown.leaves_of(x, mine)]
            g, h = _gradients(label[mine], weight[mine], margin, scale)
            for (size, members), sums in zip(packs, joint):
                code = _joint(x, members, widths)
                place = slot * size + (code if len(mine) == len(row) else code.take(mine))
                for k, values in enumerate((g, h, None)):
                    sums[k] += np.bincount(place, values, len(sums[k]))
        total = {}
        for (_, members), sums in zip(packs, joint):
            cube = sums.reshape(3, wanted, *(widths[f] for f in members))
            for i, f in enumerate(members):
                total[f] = cube.sum(axis=tuple(j + 2 for j in range(len(members)) if j != i))
        for i, group in enumerate(groups):
            yield i, np.concatenate([total[f].transpose(1, 2, 0).ravel() for f in group])

    return run


def _group_splits(groups: list[list[int]], widths: Sequence[int], wanted: int, params: BoostedTreesParams, scale: float):
    """(group, its sums over all rows) to the sums of each node and its best split among the group's features."""
    def run(found: tuple[int, np.ndarray]) -> tuple[list, list[tuple | None]]:
        group, flat = groups[found[0]], found[1]
        start, best, sums = 0, [None] * wanted, None
        for f in group:
            size = wanted * widths[f] * 3
            histogram = flat[start:start + size].reshape(1, wanted, widths[f], 3)
            start += size
            sums = histogram[0].sum(axis=1).tolist() if sums is None else sums
            own = best_splits(histogram, params, scale)
            best = [_better(b, o and (o[0], f, *o[2:])) for b, o in zip(best, own)]
        return sums, best

    return run


def _chosen(nodes: list[Node], most: float) -> list[int]:
    """Nodes that are split, best gain first, as far as their splits are known."""
    order, heap = [], [(-nodes[0].best[0], 0)] if nodes[0].best else []
    while heap and len(order) + 1 < most:
        at = heapq.heappop(heap)[1]
        order.append(at)
        for child in (nodes[at].left, nodes[at].right):
            if child >= 0 and nodes[child].best:
                heapq.heappush(heap, (-nodes[child].best[0], child))
    return order


def _arrays(nodes: list[Node], chosen: Sequence[int], params: BoostedTreesParams) -> Tree:
    size = len(nodes)
    feature, bins = np.zeros(size, np.int64), np.zeros(size, np.int64)
    left, right = np.arange(size), np.arange(size)
    for at in chosen:
        _, feature[at], bins[at] = nodes[at].best[:3]
        left[at], right[at] = nodes[at].left, nodes[at].right
    value = np.array([params.learning_rate * leaf_weight(n.gradient, n.hessian, params.l1, params.l2) for n in nodes])
    return Tree(feature, bins, left, right, value, max((nodes[at].depth + 1 for at in chosen), default=0))


def grow_tree(blocks: RDD, trees: list[Tree], number: int, cuts: list[list[float]], params: BoostedTreesParams,
              scale: float) -> tuple[list[Node], list[int]]:
    """Nodes of the next tree and those that are split; ``trees``: grown since the margins of ``blocks`` were renewed."""
    widths = [len(c) + 1 for c in cuts]
    random = np.random.default_rng([params.seed, number])
    n_features = max(1, math.ceil(params.column_sample * len(cuts)))
    features = sorted(random.choice(len(cuts), n_features, replace=False).tolist())
    parts = blocks.getNumPartitions()
    groups = _spread(features, widths, parts)
    most = params.leaves or math.inf
    nodes, chosen = [Node(0, 0.0, 0.0, 0)], []
    while True:
        reached = {0} | {c for at in chosen for c in (nodes[at].left, nodes[at].right)}
        wanted = sorted(at for at in reached if not nodes[at].seen and nodes[at].depth < params.depth)
        if not wanted:
            return nodes, chosen
        slots = np.full(len(nodes), -1, np.int64)
        slots[wanted] = np.arange(len(wanted))
        partial = blocks.mapPartitions(
            _histogram(trees, _arrays(nodes, chosen, params), slots, groups, widths, number, params, scale))
        whole = partial if parts == 1 else partial.reduceByKey(np.add, len(groups))
        found = whole.map(_group_splits(groups, widths, len(wanted), params, scale)).collect()
        if 0 in wanted:
            g, h, n = found[0][0][0]
            nodes[0] = Node(0, g / scale, h / scale, int(n))
        for i, at in enumerate(wanted):
            best = reduce(_better, (splits[i] for _, splits in found))
            node = nodes[at]
            node.seen = True
            if best:
                node.best = best
                node.left, node.right = len(nodes), len(nodes) + 1
                nodes += [Node(node.depth + 1, g / scale, h / scale, int(n)) for g, h, n in best[3:]]
        chosen = _chosen(nodes, most)


def _rows_of(number: int, nodes: list[Node], chosen: list[int], cuts: list[list[float]], names: Sequence[str],
             params: BoostedTreesParams) -> list[tuple]:
    """Rows of the node table: what is reached from the root, numbered anew, parents before children."""
    split, order = set(chosen), [0]
    for at in order:
        if at in split:
            order += [nodes[at].left, nodes[at].right]
    new = {at: i for i, at in enumerate(order)}
    out = []
    for at in order:
        node, place = nodes[at], new[at]
        own = (node.gradient, node.hessian, node.n, params.learning_rate * leaf_weight(node.gradient, node.hessian, params.l1, params.l2))
        if at in split:
            gain, feature, cut = node.best[:3]
            out.append((number, place, feature, names[feature], cut, cuts[feature][cut], new[node.left], new[node.right], gain, *own))
        else:
            out.append((number, place, None, None, None, None, None, None, None, *own))
    return out


def _stager(trees: list[Tree], width: int):
    """For ``mapInArrow``: binned rows to (prefix, y, p), the margins after each of ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, label, margin = _bins(batch, width), batch.column(2).cast(pa.int32()), batch.column(5).to_numpy()
            for i, tree in enumerate(trees):
                margin = margin + tree.value[tree.leaves_of(x.T)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), i + 1, np.int32)), label, pa.array(margin)], names=["prefix", "y", "p"])

    return run


def _refresher(trees: list[Tree], width: int):
    """For ``mapInArrow``: binned rows with the margins after ``trees``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, margin = _bins(batch, width), batch.column(5).to_numpy()
            for tree in trees:
                margin = margin + tree.value[tree.leaves_of(x.T)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(margin)], names=batch.schema.names)

    return run


def _packer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For ``mapInArrow``: binned rows to blocks, a column's values in one string of bytes."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            own = batch.slice(start, BLOCK_ROWS)
            bins = _bins(own, -1)
            columns = [own.column(0).to_numpy(), bins, *(own.column(i).to_numpy() for i in (2, 3, 5))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns], names=["row", "bins", "label", "weight", "margin"])


def _blocks(binned: DataFrame, partitions: int) -> RDD:
    """(row, bins, label, weight, margin) arrays of blocks of training rows."""
    def unpacked(block) -> tuple:
        row = np.frombuffer(block[0], np.int64)
        return (row, np.ascontiguousarray(np.frombuffer(block[1], np.uint8).reshape(len(row), -1).T), *(np.frombuffer(block[i], float) for i in (2, 3, 4)))

    train = binned.filter(~F.col("is_validation")).coalesce(partitions)
    return train.mapInArrow(_packer, "row binary, bins binary, label binary, weight binary, margin binary").rdd.map(unpacked)


def block_partitions(rows: int, cores: int) -> int:
    """Partitions of blocks: each one sends sums of its own in every pass, so there are no more of them than work needs."""
    return max(min(rows // ROWS_PER_PARTITION + 1, cores), rows // MOST_ROWS + 1)


def _renewed(trees: list[Tree]):
    def run(block: tuple) -> tuple:
        *other, margin = block
        for tree in trees:
            margin = margin + tree.value[tree.leaves_of(other[1])]
        return (*other, margin)

    return run


def prefix_aucs(held_out: DataFrame, trees: list[Tree], width: int) -> list[float]:
    """AUC after each of ``trees`` on binned rows, all prefixes in one pass; nothing where a class is missing."""
    staged = stored(held_out.mapInArrow(_stager(trees, width), "prefix int, y int, p double"), "staged")
    found = {r["prefix"]: r["auc_roc"] for r in ranking_metrics(score_curve(staged, ["prefix"]), ["prefix"]).collect()}
    return [found[i + 1] for i in range(len(trees)) if found.get(i + 1) is not None]


def stop_at(aucs: Sequence[float], patience: int) -> int | None:
    """Trees of the best prefix once ``patience`` further ones have not been better, else none; the first of equals is best."""
    best = 0
    for i, auc in enumerate(aucs):
        if auc > aucs[best]:
            best = i
        elif i - best >= patience:
            return best + 1
    return None


def binned_rows(rows: DataFrame, cuts: list[list[float]], base: float) -> DataFrame:
    """The stored table that passes read; a row's number is its place in it."""
    plain = rows.select(
        F.monotonically_increasing_id().alias("row"), vector_to_array("features").alias("x"), F.col("label").cast("double").alias("label"),
        F.col("weight").cast("double").alias("weight"), "is_validation", F.lit(base).alias("margin"))
    return stored(plain.mapInArrow(_binner(cuts), BINNED), "binned")


def fit_booster(rows: DataFrame, names: Sequence[str], params: BoostedTreesParams) -> Booster:
    """Fit on ``rows`` (features vector, label 0/1, weight, is_validation); validation rows only decide where to stop.

    Without rows of both classes the model is its base margin. Passes read persisted blocks of a stored table: what a lost
    executor held is read, and its margins are summed, again.
    """
    train = rows.filter(~F.col("is_validation"))
    sums = train.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("label")), F.count(F.lit(1))).first()
    total, positive, n = sums[0] or 0.0, sums[1] or 0.0, sums[2]
    if not 0 < positive < total:
        return Booster(math.inf if total and positive else -math.inf if total else 0.0, [], list(names))
    base = math.log(positive / (total - positive))
    scale = 2.0 ** (SUM_BITS - math.ceil(math.log2(max(total, 1.0))))
    values = train.select(vector_to_array("features").alias("x")).select(*(F.get("x", F.lit(i)).alias(f"f{i}") for i in range(len(names))))
    cuts = cut_points(values, [f"f{i}" for i in range(len(names))], min(params.max_bins, 256), n)
    binned = binned_rows(rows, cuts, base)
    first = _blocks(binned, block_partitions(n, rows.sparkSession.sparkContext.defaultParallelism)).persist(StorageLevel.MEMORY_AND_DISK)
    held_out = None
    if params.patience is not None:
        held_out = stored(binned.filter("is_validation"), "held-out")
        held_out = held_out if held_out.count() else None
    blocks, every, fresh, table, aucs, old, renewals = first, [], [], [], [], [], 0
    booster = Booster(base, table, list(names), aucs)
    try:
        for number in range(params.trees):
            nodes, chosen = grow_tree(blocks, fresh, number, cuts, params, scale)
            while old:
                old.pop().unpersist()  # the blocks that replace them have been computed
            fresh.append(_arrays(nodes, chosen, params))
            table += _rows_of(number, nodes, chosen, cuts, names, params)
            if len(fresh) < REFRESH and number + 1 < params.trees:
                continue
            every += fresh
            if held_out is not None:
                aucs += prefix_aucs(held_out, fresh, len(names))
                best = stop_at(aucs, params.patience)
                if best is not None or number + 1 == params.trees:
                    return booster.cut(best or 1 + max(range(len(aucs)), key=aucs.__getitem__, default=number))
                held_out = stored(held_out.mapInArrow(_refresher(fresh, len(names)), BINNED), "held-out")
            renewals += 1
            # lineages stay short: now and then from the first blocks
            before, new = (first, every) if renewals % CHAIN == 0 else (blocks, fresh)
            old += [] if blocks is first else [blocks]
            blocks, fresh = before.map(_renewed(list(new))).persist(StorageLevel.MEMORY_AND_DISK), []
        return booster
    finally:
        for kept in (first, blocks, *old):
            kept.unpersist()


def importances(nodes: DataFrame, kind: str = "gain") -> DataFrame:
    """(name, importance) of a node table, summing up to one.

    ``gain``: mean gain of a feature's splits; ``total_gain``: their sum; ``splits``: their number; ``cover``: the mean
    hessian of the nodes split. Features that no tree uses have no row.
    """
    measure = {"gain": F.avg("gain"), "total_gain": F.sum("gain"), "splits": F.count(F.lit(1)).cast("double"), "cover": F.avg("hessian")}[kind]
    found = nodes.filter(F.col("feature").isNotNull()).groupBy("name").agg(measure.alias("importance"))
    return found.crossJoin(F.broadcast(found.agg(F.sum("importance").alias("_all")))).select(
        "name", (F.col("importance") / F.col("_all")).alias("importance"))


def wrong_leaves(nodes: DataFrame, params: BoostedTreesParams, tolerance: float = 1e-9) -> DataFrame:
    """Leaves whose weight isn't the closed form of their sums under the penalties."""
    shrunk = F.signum("gradient") * F.greatest(F.abs("gradient") - params.l1, F.lit(0.0))
    closed = -params.learning_rate * shrunk / (F.col("hessian") + params.l2)
    return nodes.filter(F.col("feature").isNull() & (F.abs(F.col("weight") - closed) > tolerance))
