"""Minimax contiguous partition: whole groups of equal texts, in a fixed order, cut into shards of smallest capacity.

Groups are ordered by the hash of their text. The smallest feasible capacity is found by
binary search with a greedy check, as in the textbook, but over sums instead of groups: the
hash's leading bits give blocks whose total sizes are summed in Spark, the search narrows the
capacity and tells in which blocks the cuts can lie at all, and only these blocks are summed
again by more bits, until each holds one group. So the driver sees a few thousand sums a
level however many rows there are, the result is the exact optimum, and a cut is a hash value:
the shard of a row follows from its own text, without a join or a sort of all rows.
The capacity is a ceiling: below it, cuts are made at equal shares of what is left, so that beside a
group that alone fills a shard the other shards stay near equal, and none is empty while there are groups for it.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearscope.llm.common import numbered
from arrearscope.sources.storage import stored

#: Leading bits of the first level and further bits of each next one.
FIRST_BITS, MORE_BITS, KEY_BITS = 12, 8, 62
SHARDS = 8
#: With fewer blocks a shard, all blocks of several groups are cut finer before the shards are cut.
BLOCKS_A_SHARD = 64


def text_key(text: Column) -> Column:
    """62 bits of a hash of the text, not negative. Groups of different texts may share one and then stay together."""
    return F.shiftrightunsigned(F.xxhash64(text), 64 - KEY_BITS)


class Frontier:
    """Consecutive blocks in key order, each a range of keys with its total size and whether it is one group."""

    def __init__(self, blocks: list[tuple[int, int, int, bool]]):
        self.blocks = sorted(blocks)  # (first key, bits, size, single group)
        self.ends = []
        total = 0
        for *_, size, _ in self.blocks:
            total += size
            self.ends.append(total)
        self.total = total

    def low_cuts(self, capacity: int, shards: int) -> list[int] | None:
        """Greedy cuts at ends of blocks (a valid partition), as positions; None if ``shards`` aren't enough."""
        cuts, done, at = [], 0, 0
        for _ in range(shards):
            at = bisect_right(self.ends, done + capacity)
            reached = self.ends[at - 1] if at else 0
            if reached <= done and at < len(self.ends):
                return None
            done = reached
            cuts.append(at)
            if at == len(self.ends):
                return cuts
        return None

    def high_end(self, capacity: int, shards: int) -> list[int]:
        """Furthest sums greedy cuts inside blocks could reach: blocks of one group can't be cut, others anywhere."""
        reach, done = [], 0
        for _ in range(shards):
            done = min(done + capacity, self.total)
            at = bisect_right(self.ends, done)
            if at < len(self.ends) and self.blocks[at][3]:
                done = self.ends[at - 1] if at else 0
            reach.append(done)
        return reach

    def share(self, at: int, shards: int) -> float:
        """Size of the next shard, from block ``at`` on, for shards as equal as blocks that are larger than a share allow.

        Those take a shard each; the share is the smallest with which the blocks between them fit into the other shards,
        and the blocks up to the next one of them are shared out equally.
        """
        start = self.ends[at - 1] if at else 0
        low, high = 1, self.total - start
        while low < high:
            middle = (low + high) // 2
            low, high = (low, middle) if self.enough(at, middle, shards, oversized=True) else (middle + 1, high)
        large = next((i for i in range(at, len(self.blocks)) if self.blocks[i][2] > low), len(self.blocks))
        if large == at:
            return self.blocks[at][2]
        size = self.ends[large - 1] - start
        return size / -(-size // low)

    def even_cuts(self, capacity: int, shards: int) -> list[int]:
        """Cuts at ends of blocks near equal shares, none beyond ``capacity``, which must be enough (``low_cuts``)."""
        cuts, at = [], 0
        for left in range(shards, 0, -1):
            done = self.ends[at - 1] if at else 0
            last = bisect_right(self.ends, done + capacity)
            if at == len(self.ends):
                break
            wanted = done + self.share(at, left)
            end = bisect_right(self.ends, wanted)
            if end < len(self.ends) and self.ends[end] - wanted < wanted - (self.ends[end - 1] if end else 0):
                end += 1
            # a block at least, and one for each shard to come
            end = min(max(end, at + 1), max(at + 1, len(self.ends) - left + 1), last)
            if not self.enough(end, capacity, left - 1):
                # what is left is the easier to place the later this shard ends
                low, high = end + 1, last
                while low < high:
                    middle = (low + high) // 2
                    low, high = (low, middle) if self.enough(middle, capacity, left - 1) else (middle + 1, high)
                end = low
            at = end
            cuts.append(at)
        return cuts

    def enough(self, at: int, capacity: int, shards: int, oversized: bool = False) -> bool:
        """Whether the blocks from ``at`` on fit into ``shards``; ``oversized``: larger blocks may have a shard for themselves."""
        for _ in range(shards):
            if at == len(self.ends):
                break
            at = max(bisect_right(self.ends, (self.ends[at - 1] if at else 0) + capacity), at + oversized)
        return at == len(self.ends)

    def bounds(self, shards: int) -> tuple[int, int]:
        """Smallest capacity that could be enough, and the smallest that is enough with cuts between blocks only."""
        def search(enough) -> int:
            low, high = 0, max(self.total, 1)
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if enough(middle) else (middle + 1, high)
            return low

        return (search(lambda c: self.high_end(c, shards)[-1] >= self.total),
                search(lambda c: self.low_cuts(c, shards) is not None))

    def undecided(self, shards: int) -> list[int]:
        """Positions of blocks of several groups that may hold a greedy cut for a capacity between the bounds."""
        least, most = self.bounds(shards)
        if least == most:
            return []
        low, high, found = 0, 0, set()
        for _ in range(shards):
            # the cut of the smallest capacity at worst, of the largest at best
            at = bisect_right(self.ends, low + least)
            low = max(low, self.ends[at - 1] if at else 0)
            high = min(high + most, self.total)
            first, last = bisect_right(self.ends, low), bisect_right(self.ends, high)
            found.update(i for i in range(first, min(last, len(self.blocks) - 1) + 1) if not self.blocks[i][3])
        return sorted(found)


    def coarse(self, shards: int, bits: int) -> list[int]:
        """Positions of blocks of several groups, if there are too few blocks for even cuts and finer ones exist."""
        if len(self.blocks) >= BLOCKS_A_SHARD * shards or bits >= KEY_BITS:
            return []
        return [i for i, block in enumerate(self.blocks) if not block[3]]


def optimal_cuts(groups: DataFrame, shards: int) -> tuple[list[int], int]:
    """(first keys of shards 1.., smallest capacity) for ``groups`` (key, size): contiguous in key order, none split.

    ``groups`` may hold several rows of a key; they stay together. The number of levels is at
    most 2 + (62 - 12) / 8; each sums in Spark and brings one row a block to the driver.
    """
    def sums(rows: DataFrame, bits: int) -> list[tuple[int, int, int, bool]]:
        first = F.shiftleft(F.shiftright("key", KEY_BITS - bits), KEY_BITS - bits)
        found = rows.groupBy(first.alias("first")).agg(
            F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("single"))
        return [(r["first"], bits, r["size"], r["single"]) for r in found.collect()]

    bits = FIRST_BITS
    frontier = Frontier(sums(groups, bits))
    while open_blocks := frontier.undecided(shards) or frontier.coarse(shards, bits):
        chosen = [frontier.blocks[i] for i in open_blocks]
        ranges: list[list[int]] = []
        for first, size, *_ in chosen:
            end = first + (1 << (KEY_BITS - size))
            if ranges and ranges[-1][1] == first:
                ranges[-1][1] = end
            else:
                ranges.append([first, end])
        inside = F.lit(False)
        for first, end in ranges:
            inside = inside | ((F.col("key") >= first) & (F.col("key") < end))
        bits = min(bits + MORE_BITS, KEY_BITS)
        finer = sums(groups.filter(inside), bits)
        closed = set(range(len(frontier.blocks))) - set(open_blocks)
        frontier = Frontier([frontier.blocks[i] for i in closed] + finer)
    _, capacity = frontier.bounds(shards)
    cuts = frontier.even_cuts(capacity, shards)
    return [frontier.blocks[at][0] for at in cuts if at < len(frontier.blocks)], capacity


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of ``docs``.

    The law is ``bytes``: the largest shard is as small as whole groups of equal texts in key
    order allow, the others are near equal under that ceiling. ``grown_shard`` is null under this law. Null text counts as no bytes and
    forms one group with empty text; a null doc_id is kept; repeated rows get slots of their
    own; shards may stay empty when there are fewer groups; an empty table gives an empty one.
    Only doc_id and text are read, so further columns can't clash.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        text_key(text).alias("key"),
        # tells repeated rows apart when slots are dealt; fixed by the table that is written here
        F.monotonically_increasing_id().alias("row"),
    ), "sizes")
    cuts, _ = optimal_cuts(rows.select("key", "size"), shards)
    shard = F.lit(0)
    for cut in cuts:
        shard = shard + (F.col("key") >= cut).cast("int")
    placed = numbered(rows.withColumn("shard", shard), "shard", ["key", "row"], "slot", rows.count())
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
