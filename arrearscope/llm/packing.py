"""Best-fit packing of documents into token sequences by the configuration linear program.

Only the histogram of piece lengths matters for the plan, so at most 2048 numbers leave
Spark. The program (how many sequences of each configuration cover the histogram) is solved by
multiplicative weights: lengths that are covered badly get dearer, and a knapsack dynamic
program over the sequence's capacity finds the dearest configurations at these prices. The
fractional solution is rounded down, the rest of the histogram is packed best-fit decreasing; where plain
best-fit decreasing of all pieces takes fewer sequences, its plan is returned.
The plan is a list of intervals: the pieces of a length with ranks a to b go to that many
sequences in a row, at one offset. Ranks are dealt in Spark, see ``common.numbered``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.common import numbered
from arrearscope.llm.token_pieces import PIECES, piece_batches
from arrearscope.sources.storage import stored

MOST_TOKENS = 2048
#: Pricing rounds of the multiplicative weights and configurations taken from each.
ROUNDS, EACH_ROUND = 200, 64
#: Share of the scarcest demand that a chosen configuration covers, and the weights' learning rate.
STEP, RATE = 0.1, 1.0

Config = tuple[tuple[int, int], ...]  # ((length, times), ...), longest first


class Knapsack:
    """Unbounded knapsack over ``capacity`` for given values of the lengths, all capacities at once."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.usable = np.searchsorted(lengths, np.arange(capacity + 1), side="right")

    def solve(self, values: np.ndarray) -> None:
        best, taken = np.zeros(self.capacity + 1), np.full(self.capacity + 1, -1)
        for c in range(1, self.capacity + 1):
            best[c], k = best[c - 1], self.usable[c]
            if k:
                at = best[c - self.lengths[:k]] + values[:k]
                i = at.argmax()
                if at[i] > best[c]:
                    best[c], taken[c] = at[i], i
        self.best, self.taken = best, taken

    def items(self, c: int) -> dict[int, int]:
        found: dict[int, int] = {}
        while c > 0:
            i = int(self.taken[c])
            if i < 0:
                c -= 1
            else:
                found[i] = found.get(i, 0) + 1
                c -= int(self.lengths[i])
        return found


def fractional_cover(histogram: dict[int, int], capacity: int) -> tuple[dict[Config, float], float]:
    """(sequences for each configuration, lower bound on the number of sequences) by multiplicative weights.

    The bound is the best dual value seen: prices under which no configuration is worth more
    than 1 cannot charge the demand more than the optimum.
    """
    lengths = np.array(sorted(histogram))
    demand = np.array([histogram[n] for n in lengths], float)
    knapsack = Knapsack(lengths, capacity)
    covered = np.zeros(len(lengths))
    amounts: dict[Config, float] = {}
    bound = float(np.dot(lengths, demand)) / capacity
    for _ in range(ROUNDS):
        # a piece costs its share of the capacity, more where its length is covered less than others
        prices = lengths / capacity * np.exp(-RATE * (covered - covered.mean()))
        knapsack.solve(prices)
        bound = max(bound, float(np.dot(prices, demand)) / knapsack.best[capacity])
        for i in np.argsort(covered, kind="stable")[:EACH_ROUND]:
            # the dearest configuration with a piece of this length
            items = knapsack.items(capacity - int(lengths[i]))
            items[int(i)] = items.get(int(i), 0) + 1
            at = np.fromiter(items, int)
            times = np.fromiter(items.values(), float)
            amount = STEP * float((demand[at] / times).min())
            covered[at] += times * amount / demand[at]
            config = tuple(sorted(((int(lengths[k]), n) for k, n in items.items()), reverse=True))
            amounts[config] = amounts.get(config, 0.0) + amount
    scale = 1 / max(covered.mean(), 1e-9)
    return {c: x * scale for c, x in amounts.items()}, bound


def best_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[tuple[Config, int]]:
    """Best-fit decreasing on counts: equal sequences are one group, so the work doesn't grow with the counts."""
    open_groups: dict[int, list[tuple[dict[int, int], int]]] = {}
    rooms: list[int] = []  # kept as a sorted list of free capacities in use
    closed: list[tuple[Config, int]] = []

    def put(items: dict[int, int], count: int, free: int) -> None:
        if free == 0:
            closed.append((tuple(sorted(items.items(), reverse=True)), count))
            return
        if free not in open_groups:
            open_groups[free] = []
            rooms.insert(int(np.searchsorted(rooms, free)), free)
        open_groups[free].append((items, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = int(np.searchsorted(rooms, length))
            if at == len(rooms):
                # new sequences hold as many of this length as fit; so does one by one best fit
                fit = capacity // length
                full, rest = divmod(left, fit)
                if full:
                    put({length: fit}, full, capacity - fit * length)
                if rest:
                    put({length: rest}, 1, capacity - rest * length)
                left = 0
                continue
            free = rooms[at]
            items, count = open_groups[free].pop()
            if not open_groups[free]:
                del open_groups[free]
                del rooms[at]
            used = min(left, count)
            if count > used:
                put(items, count - used, free)
            put(items | {length: items.get(length, 0) + 1}, used, free - length)
            left -= used
    for free, groups in open_groups.items():
        closed.extend((tuple(sorted(items.items(), reverse=True)), count) for items, count in groups)
    return closed


def plan(histogram: dict[int, int], capacity: int = MOST_TOKENS) -> list[tuple[Config, int]]:
    """(configuration, sequences) that hold exactly the pieces of ``histogram``."""
    left = {n: k for n, k in histogram.items() if 0 < n < capacity and k > 0}
    chosen = [(((capacity, 1),), histogram[capacity])] if histogram.get(capacity) else []
    if not left:
        return chosen
    amounts, _ = fractional_cover(left, capacity)
    rest = dict(left)
    for config, amount in sorted(amounts.items(), key=lambda c: -c[1]):
        count = min(int(amount), *(rest[n] // times for n, times in config))
        if count > 0:
            chosen.append((config, count))
            for n, times in config:
                rest[n] -= times * count
    whole = chosen[:1] if histogram.get(capacity) else []
    rounded = chosen + best_fit_decreasing({n: k for n, k in rest.items() if k}, capacity)
    return min(rounded, whole + best_fit_decreasing(left, capacity), key=lambda planned: sum(k for _, k in planned))


def intervals(planned: list[tuple[Config, int]]) -> pd.DataFrame:
    """(length, rank, sequence, offset): pieces of a length from this rank on, one a sequence, till the next row."""
    rows, next_rank, sequence = [], {}, 0
    for config, count in planned:
        offset = 0
        for length, times in config:
            for _ in range(times):
                rank = next_rank.get(length, 0)
                rows.append((length, rank, sequence, offset))
                next_rank[length] = rank + count
                offset += length
        sequence += count
    return pd.DataFrame(rows, columns=["length", "rank", "sequence", "offset"]).sort_values(["length", "rank"])


def _place(shared):
    """Arrow UDF (length, rank) to (sequence_id, offset) by the broadcast intervals."""
    @F.arrow_udf("struct<sequence_id:long,offset:long>")
    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        starts, sequences, offsets = shared.value
        for length, rank in batches:
            key = (np.asarray(length, np.int64) << 48) + np.asarray(rank, np.int64)
            at = np.searchsorted(starts, key, side="right") - 1
            yield pa.StructArray.from_arrays(
                [pa.array(sequences[at] + key - starts[at]), pa.array(offsets[at])], names=["sequence_id", "offset"])

    return place


def pack_documents(docs: DataFrame, tokenizer: str | None = None, most: int = MOST_TOKENS) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one piece of the closing id alone. A null doc_id is kept, repeated
    rows are packed each by itself, an empty table gives an empty one. Only doc_id and text are
    read, so further columns can't clash. Ids are the tokenizer file's, ``add_special_tokens=False``.
    """
    import public_tokenizers

    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    pieces = stored(rows.mapInArrow(piece_batches(path, most), PIECES), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    found = intervals(plan(histogram, most))
    arrays = tuple(a.to_numpy(np.int64) for a in ((found.length.astype("int64") * 2**48) + found["rank"],
                                                  found.sequence, found.offset))
    place = _place(spark.sparkContext.broadcast(arrays))
    ranked = numbered(pieces, "length", ["row", "piece"], "rank", sum(histogram.values()))
    return ranked.withColumn("_at", place("length", "rank")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "_at.sequence_id", "_at.offset",
    )
