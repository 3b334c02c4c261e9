"""Near duplicates on word shingles by circulant MinHash, banding and exact verification.

1. One pass over the texts gives each document the size and a 128-bit digest of its shingle set and
   a signature: the set goes through one permutation, the coordinates are minima under a second one
   that is shifted circularly by 0, 1, 2, ... (Li and Li 2021). Texts don't leave their tasks.
2. Equal sets are one class from here on, however many copies there are.
3. Classes that agree in a band meet in its bucket. Large buckets are dealt over pairs of blocks.
   A task compares signatures and hands on a spanning forest of the pairs that are near enough to be
   worth a look, not the pairs; components of the forests gather the classes that may be linked.
4. Full texts of gathered classes only are moved, once each (large gatherings again in
   pairs of blocks); with more classes than can be broadcast, all texts take part in one exchange. Tasks compute full sets, confirm every promising link exactly and
   return a spanning forest of the confirmed links, whose components are the result.

No link is given up for size: blocks bound what a task holds. A link is lost only if two
sets of that similarity agree in no band or look unlike by signature; both chances are in
``Settings``' docstring.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.common import components, union_find
from arrearscope.sources.storage import stored


@dataclass(frozen=True)
class Settings:
    """``percent``: a link needs 100 * intersection >= percent * union.

    At a similarity of 0.85 two sets miss all 20 bands of 4 rows with a chance of 4e-7 and
    agree in fewer than ``likely`` of 80 coordinates (mean 68, deviation 3.2) with one of about 1e-7.
    """

    shingle: int = 5
    percent: int = 85
    bands: int = 20
    rows: int = 4
    likely: int = 50
    #: Members of a bucket's block, and weight (shingles and ``OVERHEAD`` a document) of a gathering's block.
    bucket_block: int = 1024
    weight_block: int = 1_000_000
    #: Gathered classes whose ids are broadcast to the texts; about 50 bytes each.
    broadcast_ids: int = 1_000_000

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows


OVERHEAD = 500
#: Shingles that are hashed and permuted together; the arrays stay in the processor's cache.
_FLAT = 60_000
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 2 ** 64)
_BYTE_CODES = np.random.default_rng(20240501).integers(1, 2 ** 63, 256, dtype=np.uint64) | np.uint64(1)


class Shingler:
    """Sets of hashed word shingles of whole texts.

    A-Z are lower-cased and words are runs without space and the five ASCII control spaces. A
    shingle's hash is polynomial over the bytes of its words joined by one space, so running sums over
    the whole text give all of them; it is mixed at the end.
    """

    def __init__(self, shingle: int):
        self.shingle = shingle
        self._grow(1 << 16)

    def _grow(self, size: int) -> None:
        self.powers = np.ones(size, np.uint64)
        self.inverse = np.ones(size, np.uint64)
        self.powers[1:] = _BASE
        self.inverse[1:] = _INVERSE
        np.multiply.accumulate(self.powers, out=self.powers)
        np.multiply.accumulate(self.inverse, out=self.inverse)

    def hashes(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingles; with fewer words the whole sequence is one; without words none."""
        words = b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())
        if not words:
            return np.zeros(0, np.uint64)
        data = np.frombuffer(words, np.uint8)
        while len(data) >= len(self.powers):
            self._grow(2 * len(self.powers))
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * self.powers[:len(data)], out=sums[1:])
        spaces = np.flatnonzero(data == 32)
        starts = np.concatenate([[0], spaces + 1])
        ends = np.concatenate([spaces, [len(data)]])
        last = min(self.shingle, len(starts)) - 1
        starts, ends = starts[:len(starts) - last], ends[last:]
        found = (sums[ends] - sums[starts]) * self.inverse[starts]
        return np.unique(_mix64(found))


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def circulant_minima(sets: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(sets, coordinates) uint32 signatures; no set may be empty.

    The first permutation is the mixed hash itself, cut to 32 bits; the second is a mixer on
    32 bits (a bijection) applied to the value shifted circularly by the coordinate's number.
    """
    first = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), coordinates), np.uint32)
    a, b = np.empty_like(first), np.empty_like(first)
    for k in range(coordinates):
        np.subtract(first, np.uint32(k), out=a)
        np.right_shift(a, np.uint32(16), out=b)
        a ^= b
        a *= np.uint32(0x7FEB352D)
        np.right_shift(a, np.uint32(15), out=b)
        a ^= b
        a *= np.uint32(0x846CA68B)
        np.right_shift(a, np.uint32(16), out=b)
        a ^= b
        out[:, k] = np.minimum.reduceat(a, starts)
    return out


def _sketches(settings: Settings):
    """Function for ``mapInArrow``: (doc_id, text) to (doc_id, n_shingles, d1, d2, signature)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(settings.shingle)
        for batch in batches:
            ids, sizes, digests, signatures = [], [], [], []
            waiting: list[np.ndarray] = []

            def close() -> None:
                if waiting:
                    signatures.extend(row.tobytes() for row in circulant_minima(waiting, settings.coordinates))
                    waiting.clear()

            flat = 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = shingler.hashes(text.as_py())
                ids.append(doc_id)
                sizes.append(len(hashes))
                with np.errstate(over="ignore"):
                    digests.append((hashes.sum(dtype=np.uint64).astype(np.int64),
                                    _mix64(hashes + np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)))
                if not len(hashes):
                    close()
                    signatures.append(b"")
                    flat = 0
                    continue
                waiting.append(hashes)
                flat += len(hashes)
                if flat > _FLAT:
                    close()
                    flat = 0
            close()
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array([d[0] for d in digests], pa.int64()),
                pa.array([d[1] for d in digests], pa.int64()), pa.array(signatures, pa.binary()),
            ], names=["doc_id", "n_shingles", "d1", "d2", "signature"])

    return run


def sketches(docs: DataFrame, settings: Settings) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _sketches(settings), "doc_id long, n_shingles long, d1 long, d2 long, signature binary")


def _close_by_signature(settings: Settings, signatures: np.ndarray, sizes: np.ndarray, split: int | None = None):
    """Pairs (i, [j > i]) that agree in enough coordinates and whose sizes allow the similarity.

    With ``split`` only pairs across that position.
    """
    n = len(signatures)
    for i in range(n if split is None else split):
        rest = np.arange(max(i + 1, split or 0), n)
        small, large = np.minimum(sizes[i], sizes[rest]), np.maximum(sizes[i], sizes[rest])
        rest = rest[100 * small >= settings.percent * large]
        if len(rest):
            same = (signatures[rest] == signatures[i]).sum(1)
            rest = rest[same >= settings.likely]
            if len(rest):
                yield i, rest


def complete_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """One table a group from batches that are sorted by their first ``keys`` columns (long, not null).

    Holds one batch and one group; cheaper for many small groups than a call for each.
    """
    carry: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if carry is not None:
            rows = pa.concat_tables([carry, rows])
        if not len(rows):
            continue
        changes = np.zeros(len(rows) - 1, bool)
        for k in range(keys):
            changes |= np.diff(rows.column(k).to_numpy()) != 0
        starts = [0, *(np.flatnonzero(changes) + 1)]
        for start, end in zip(starts, starts[1:]):
            yield rows.slice(start, end - start)
        carry = rows.slice(starts[-1])
    if carry is not None and len(carry):
        yield carry


def _forests(links_of):
    """Function for ``mapInArrow`` over rows sorted by (group, first, second, side): edges of each group's forest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray] = [np.zeros((0, 2), np.int64)]
        for group in complete_groups(batches, 3):
            ids, sides = group.column("doc_id").to_numpy(), group.column("side").to_numpy()
            split = int((sides == 0).sum())
            pairs = links_of(group, split if split < len(ids) else None)
            roots = np.array(union_find(len(ids), pairs))
            hung = np.flatnonzero(roots != np.arange(len(ids)))
            if len(hung):
                found.append(np.column_stack([ids[hung], ids[roots[hung]]]))
            if len(found) > 10_000:
                found = [np.concatenate(found)]
                yield _edges(found.pop())
                found = [np.zeros((0, 2), np.int64)]
        yield _edges(np.concatenate(found))

    return run


def _edges(pairs: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0], pa.int64()), pa.array(pairs[:, 1], pa.int64())], names=["a", "b"])


def _signatures(group: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(group.column("signature").to_pylist()), np.uint32).reshape(len(group), -1)


def _likely_links(settings: Settings):
    """Pairs of a bucket's pair of blocks that are promising by signature."""
    def links(group: pa.Table, split: int | None) -> Iterator[tuple[int, int]]:
        for i, rest in _close_by_signature(
                settings, _signatures(group), group.column("n_shingles").to_numpy(), split):
            for j in rest.tolist():
                yield i, j

    return links


def _confirmed_links(settings: Settings):
    """Promising pairs of a gathering's pair of blocks whose full sets are similar enough."""
    shingler = Shingler(settings.shingle)

    def links(group: pa.Table, split: int | None) -> Iterator[tuple[int, int]]:
        sets = [shingler.hashes(t.as_py()) for t in group.column("text")]
        sizes = np.array([len(s) for s in sets])
        flat = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        seen = np.zeros(len(flat), np.uint8)
        for i, rest in _close_by_signature(settings, _signatures(group), sizes, split):
            own = flat[starts[i]:ends[i]]
            seen[own] = 1
            for at in range(0, len(rest), 256):
                part = rest[at:at + 256]
                other = np.concatenate([flat[starts[j]:ends[j]] for j in part])
                begins = np.cumsum([0, *sizes[part[:-1]]])
                both = np.add.reduceat(seen[other], begins, dtype=np.int64)
                union = sizes[i] + sizes[part] - both
                for j in part[100 * both >= settings.percent * union].tolist():
                    yield i, j
            seen[own] = 0

    return links


def _in_block_pairs(rows: DataFrame, group: str, blocks: str) -> DataFrame:
    """Each row once for every pair (first <= second) of its group's blocks that holds its own block.

    ``blocks`` is the number of the group's blocks; a group of one block has one pair. ``side`` is
    0 for rows of the first block and 1 for those of the second.
    """
    own = F.pmod(F.xxhash64("doc_id"), F.col(blocks)).cast("long")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks).cast("long") - 1)).alias("_other")
    spread = rows.withColumn("_own", own).select("*", other)
    return spread.select(
        group, F.least("_own", "_other").alias("first"), F.greatest("_own", "_other").alias("second"),
        (F.col("_own") > F.col("_other")).cast("int").alias("side"),
        *(c for c in rows.columns if c not in (group, blocks)),
    )


def _in_groups(spread: DataFrame, links_of) -> DataFrame:
    group = spread.columns[0]
    return spread.repartition(group, "first", "second").sortWithinPartitions(
        group, "first", "second", "side", "doc_id").mapInArrow(_forests(links_of), "a long, b long")


def link_documents(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each row of ``docs``.

    component_id is the smallest doc_id reachable by links; texts with equal sets are linked.
    Null, empty and wordless texts have no shingles and are linked with nothing. Rows without
    doc_id are returned with a null component_id and not kept: nothing can refer to them. doc_id is
    taken for a key: repeated rows are each returned, and if their texts differ, the row counts by
    its own text. An empty table gives an empty one. Only doc_id and text are read, so further
    columns can't clash.
    """
    found = stored(sketches(docs, settings), "sketches")
    named = found.filter(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = stored(named.groupBy("d1", "d2", "n_shingles").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n")), "classes")
    first = classes.select(F.col("class_id").alias("doc_id"), "d1", "d2")
    leaders = named.join(first, ["doc_id", "d1", "d2"], "left_semi").dropDuplicates(["doc_id"])

    width = 4 * settings.rows
    bands = F.transform(
        F.sequence(F.lit(0), F.lit(settings.bands - 1)),
        lambda b: F.xxhash64(b, F.substring(F.col("signature"), b * width + 1, F.lit(width))))
    keyed = leaders.select("doc_id", F.explode(bands).alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(
        "bucket", F.ceil(F.col("n") / settings.bucket_block).cast("long").alias("blocks"))
    meeting = stored(keyed.join(shared, "bucket"), "buckets")
    members = meeting.join(leaders.select("doc_id", "n_shingles", "signature"), "doc_id")
    near = _in_groups(_in_block_pairs(members, "bucket", "blocks"), _likely_links(settings))
    gathered = stored(components(near), "gathered")

    weights = leaders.select("doc_id", F.col("n_shingles").alias("w")).join(
        gathered, F.col("doc_id") == F.col("node")).groupBy("root").agg(
        F.ceil(F.sum(F.col("w") + OVERHEAD) / settings.weight_block).cast("long").alias("blocks"))
    wanted = gathered.join(weights, "root").select(F.col("node").alias("doc_id"), "root", "blocks").join(
        leaders.select("doc_id", "signature"), "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter(F.col("text").isNotNull())
    if gathered.count() <= settings.broadcast_ids:
        # so few ids that they can be sent: the other texts stay where they are
        texts = texts.join(F.broadcast(gathered.select(F.col("node").alias("doc_id"))), "doc_id", "left_semi")
    spread = _in_block_pairs(texts.join(wanted, "doc_id"), "root", "blocks")
    linked = stored(components(_in_groups(spread, _confirmed_links(settings))), "linked")

    ids = found.select("doc_id", "n_shingles", "d1", "d2").join(classes.select("class_id", "d1", "d2", "n_shingles"),
                                                                ["d1", "d2", "n_shingles"], "left")
    placed = ids.join(linked, F.col("class_id") == F.col("node"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "class_id", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))
