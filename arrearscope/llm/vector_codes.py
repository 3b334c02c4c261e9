"""Compress vectors to codes: integer codebooks per part, learnt by rounds of nearest-entry assignment.

Parts are assigned through a lexicographic trie. The distinct parts of a block, sorted, are the leaves of a trie whose
levels are the dimensions; a node's vector of distances to all codebook entries is its parent's plus one squared
difference for each entry. The traversal is depth-first, a run of neighbouring leaves at a time: what the path to the last leaf
has accumulated is carried on, so a prefix that parts share is added up once, and memory is bounded by the
run, not by the trie. A leaf takes the nearest entry and adds its part, weighted by how often it occurs, to the entry's sums.

Spark deals the blocks: vectors never move. They are read once to store sorted distinct parts with their counts; each round reads these
and shuffles one row of sums for each (part position, entry) and task. The codebooks, ``parts * entries`` short
rows, are all that reaches the driver. All arithmetic is in 64-bit integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Leaves of a trie that are walked at once, and vectors whose parts are made distinct together.
LEAVES, BLOCK = 4_096, 32_768
#: Integer components are held within this bound, so that no sum of squares over a vector of 64 leaves 64 bits.
LARGEST = 2**27


@dataclass(frozen=True)
class Settings:
    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: float = 4096.0


def walk(parts: np.ndarray, entries: np.ndarray, leaves: int = LEAVES) -> Iterator[tuple[slice, np.ndarray]]:
    """Squared distances of ``parts`` (rows, best sorted) to ``entries``, a run of leaves at a time."""
    rows, width = parts.shape
    fresh = np.ones((rows, width), bool)  # whether a row's node at a level is not its predecessor's
    np.logical_or.accumulate(parts[1:] != parts[:-1], axis=1, out=fresh[1:])
    path = [np.zeros(len(entries), np.int64) for _ in range(width)]
    for first in range(0, rows, leaves):
        run = slice(first, min(first + leaves, rows))
        nodes, at = np.zeros((1, len(entries)), np.int64), np.zeros(run.stop - first, np.int64)
        for level in range(width):
            new = fresh[run, level]
            own = np.flatnonzero(new)
            step = parts[first + own, level, None] - entries[None, :, level]
            nodes = np.concatenate([path[level][None], nodes[at[own]] + step * step])
            at = np.cumsum(new)
            path[level] = nodes[-1]
        yield run, nodes[at]


def distinct_parts(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct rows, the place of each row among them, and their counts."""
    if not parts.shape[1]:
        return parts[:1], np.zeros(len(parts), np.int64), np.array([len(parts)][:len(parts[:1])], np.int64)
    order = np.lexsort(parts.T[::-1])
    ranked = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ranked[1:] != ranked[:-1]).any(axis=1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], place, np.bincount(place, minlength=int(new.sum()))


def _flat(column: pa.Array, rows: int) -> np.ndarray:
    """A list column without nulls, whose lists are equally long, as a matrix."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.reshape(rows, -1) if rows else values.reshape(0, 0)


def _part_rows(position: int, parts: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    width = parts.shape[1]
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(parts) * width + 1, width, dtype=np.int32)), pa.array(parts.ravel()))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(parts), position, np.int32)), lists, pa.array(counts.astype(np.int64))], names=["position", "part", "n"])


def _leaves(parts: int):
    """For ``mapInArrow``: vectors to the sorted distinct parts of each block of them, with counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def block() -> Iterator[pa.RecordBatch]:
            vectors = np.concatenate(held)
            held.clear()
            for position, own in enumerate(np.split(vectors, parts, axis=1)):
                found, _, counts = distinct_parts(own)
                yield _part_rows(position, found, counts)

        for batch in batches:
            if batch.num_rows:
                held.append(_flat(batch.column(0), batch.num_rows))
            if sum(map(len, held)) >= BLOCK:
                yield from block()
        if held:
            yield from block()

    return run


def _sums(codebooks: np.ndarray):
    """For ``mapInArrow``: distinct parts to a task's (position, entry, sums, n) of the entries that are nearest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(codebooks), np.zeros(codebooks.shape[:2], np.int64)
        for batch in batches:
            positions, parts = batch.column(0).to_numpy(), _flat(batch.column(1), batch.num_rows)
            weights = batch.column(2).to_numpy()
            for position in np.unique(positions):
                own = positions == position
                ours, theirs = parts[own], weights[own]
                for leaves, distances in walk(ours, codebooks[position]):
                    nearest = distances.argmin(axis=1)  # the first of equals
                    np.add.at(sums[position], nearest, ours[leaves] * theirs[leaves, None])
                    np.add.at(counts[position], nearest, theirs[leaves])
        position, entry = np.nonzero(counts)
        if len(position):
            yield pa.RecordBatch.from_arrays([
                pa.array(position.astype(np.int32)), pa.array(entry.astype(np.int32)),
                pa.array(sums[position, entry].tolist(), pa.list_(pa.int64())), pa.array(counts[position, entry]),
            ], names=["position", "entry", "sums", "n"])

    return run


def _codes(codebooks: np.ndarray):
    """For ``mapInArrow``: (row columns ..., vector) to the same with ``code`` and ``error`` in place of the vector."""
    parts = len(codebooks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, last = batch.num_rows, batch.num_columns - 1
            indexes, error = np.zeros((rows, parts), np.uint8), np.zeros(rows, np.int64)
            if rows:
                for position, own in enumerate(np.split(_flat(batch.column(last), rows), parts, axis=1)):
                    found, place, _ = distinct_parts(own)
                    nearest, distance = np.zeros(len(found), np.uint8), np.zeros(len(found), np.int64)
                    for leaves, distances in walk(found, codebooks[position]):
                        nearest[leaves], distance[leaves] = distances.argmin(axis=1), distances.min(axis=1)
                    indexes[:, position] = nearest[place]
                    error += distance[place]
            text = indexes.tobytes().hex()
            code = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:last], pa.array(code, pa.string()), pa.array(error)], names=[*batch.schema.names[:last], "code", "error"])

    return run


def integer_vectors(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, label and ``whole``, the floor of the scaled components, of rows whose vector is whole and finite."""
    def lost(x):
        return x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))

    bound = float(LARGEST)
    floor = F.transform("embedding", lambda x: F.floor(
        F.least(F.greatest(x.cast("double") * settings.scale, F.lit(-bound)), F.lit(bound))).cast("long"))
    return vectors.filter(F.col("embedding").isNotNull() & ~F.exists("embedding", lost)).select(
        F.col("vec_id").cast("long").alias("vec_id"), "label", floor.alias("whole"))


def train_codebooks(whole: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Codebooks (parts, entries, width) after all rounds; ``whole`` (stored) has equally long vectors.

    They start as the parts of the smallest different vec_ids, of which there may be fewer than ``entries``.
    """
    first = whole.filter(F.col("vec_id").isNotNull()).groupBy("vec_id").agg(F.min("whole").alias("whole")).orderBy("vec_id").limit(settings.entries)
    start = np.array([row["whole"] for row in first.collect()], np.int64)
    books = start.reshape(len(start), settings.parts, -1).transpose(1, 0, 2).copy()
    leaves = stored(whole.select("whole").mapInArrow(_leaves(settings.parts), "position int, part array<long>, n long"), "leaves")
    width = books.shape[2]
    for _ in range(settings.rounds):
        partial = leaves.mapInArrow(_sums(books), "position int, entry int, sums array<long>, n long")
        totals = partial.groupBy("position", "entry").agg(
            F.sum("n").alias("n"), *(F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(width)))
        for row in totals.collect():  # parts * entries rows at most
            books[row["position"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(width)]
    return books


def fingerprint(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def encode(whole: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """``whole`` with ``code`` (two hex digits a part) and ``error`` (squared distance to the entries) for the vectors."""
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in whole.drop("whole").schema]
    return whole.mapInArrow(_codes(codebooks), ", ".join([*kept, "code string", "error long"]))


def decode(spark: SparkSession, codes: DataFrame, codebooks: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """``codes`` with ``vector``, the scaled-back entries that ``code`` names; built-in functions only."""
    books = F.lit([[[int(x) for x in entry] for entry in part] for part in codebooks.tolist()])
    parts = F.transform(F.sequence(F.lit(0), F.lit(len(codebooks) - 1)), lambda p: F.get(
        F.get(books, p), F.conv(F.substring("code", 2 * p + 1, F.lit(2)), 16, 10).cast("int")))
    return codes.withColumn("vector", F.transform(F.flatten(parts), lambda x: x / settings.scale))


def compress(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every row with a whole, finite vector.

    Rows whose vector is null, or holds null or a component that is not finite, are left out. Repeated rows are
    all returned and weigh as often as they occur; rows without vec_id are encoded but never start a
    codebook. Vectors have the length of that with the smallest vec_id: rows with other lengths, and all rows if ``parts`` doesn't
    divide it or no row has a vec_id, get null code and error. Components beyond ``LARGEST / scale``
    count as that. Labels without any error have none, rows without label are summed together. Only vec_id,
    embedding and label are read, so further columns can't clash.
    """
    whole = stored(integer_vectors(vectors, settings), "vectors")
    first = whole.filter(F.col("vec_id").isNotNull()).select(F.min(F.struct("vec_id", "whole"))["whole"].alias("first")).first()["first"]
    length = len(first) if first else 0
    fits = (F.size("whole") == length) & F.lit(length > 0 and length % settings.parts == 0)
    parts = whole.filter(fits)
    if length and length % settings.parts == 0:
        books = train_codebooks(parts, settings)
        mark, coded = fingerprint(books), encode(parts, books)
    else:
        mark = hashlib.sha256(b"").hexdigest()
        coded = parts.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    other = whole.filter(~fits).select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    every = stored(coded.unionByName(other), "codes")
    # one row a label; a label with most of the rows is summed before the shuffle, and its rows are not moved by the join if labels are few
    totals = every.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).try_cast("long").alias("label_error"))
    return every.join(totals.withColumnRenamed("label", "_label"), F.col("label").eqNullSafe(F.col("_label")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(mark).alias("codebooks_sha256"))


def sql(settings: Settings = Settings()) -> str:
    """DuckDB SQL for ``compress`` over table ``embeddings``, the rounds written one after the other."""
    p, k = settings.parts, settings.entries
    distance = "CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: (a.v[i] - b.v[i]) * (a.v[i] - b.v[i]))) AS BIGINT)"
    steps = [f"""whole AS MATERIALIZED (
 SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(greatest(least({settings.scale!r} * CAST(x AS DOUBLE), {LARGEST}.0), -{LARGEST}.0)) AS BIGINT)) AS v
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
 SELECT row_number() OVER () AS r, vec_id, label, part, list_slice(v, part * len(v) // {p} + 1, (part + 1) * len(v) // {p}) AS v
 FROM (SELECT *, unnest(range({p})) AS part FROM whole)),
b0 AS MATERIALIZED (
 SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry FROM parts
 WHERE vec_id IN (SELECT vec_id FROM whole ORDER BY vec_id LIMIT {k}))"""]
    for i in range(settings.rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
 SELECT r, min(struct_pack(d := {distance}, entry := b.entry)) AS best FROM parts a JOIN b{i} b USING (part) GROUP BY r)""")
        if i < settings.rounds:
            steps.append(f"""s{i} AS MATERIALIZED (
 SELECT part, best.entry AS entry, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
 FROM (SELECT part, best, v, unnest(range(1, len(v) + 1)) AS i FROM parts JOIN a{i} USING (r)) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (
 SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{i} b LEFT JOIN (
   SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS v FROM s{i} GROUP BY part, entry) m USING (part, entry))""")
    last = settings.rounds
    steps.append(f"""coded AS (
 SELECT vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
 FROM parts JOIN a{last} USING (r) GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
 (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{last}) AS codebooks_sha256 FROM coded""")
    return "WITH " + ",\n".join(steps)
