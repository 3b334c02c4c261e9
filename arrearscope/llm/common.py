"""Helpers shared by the operators: tables, gapless numbers, connected components, pattern matches with places."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrearscope.sources.storage import stored

#: Rows that one task numbers in a gapless numbering, about.
ROWS_PER_BLOCK = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def numbered(rows: DataFrame, group: str, order: list[str], number: str, hint: int) -> DataFrame:
    """``rows`` with a gapless ``number`` from 0 within ``group`` (not null), in no stated order.

    A group of any size is dealt over blocks by the hash of ``order`` (which should identify a
    row): counts per (group, block) are summed up front, so a task numbers one block only.
    ``hint`` is the number of rows. The offsets table has one row for each (group, block);
    it is joined by equality, so its size needs no bound.
    """
    blocks = max(1, -(-hint // ROWS_PER_BLOCK))
    dealt = rows.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    sizes = dealt.groupBy(group, "_block").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(group, "_block").orderBy(*order)
    placed = dealt.withColumn("_row", F.row_number().over(inside).cast("long") - 1)
    joined = placed.join(offsets, [group, "_block"])
    return joined.withColumn(number, F.col("_before") + F.col("_row")).drop("_block", "_before", "_row")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for all nodes of the undirected ``edges`` (a, b); root is the smallest reachable node.

    Alternates the two star operations of the connected-components algorithm for map-reduce
    (Kiveris et al. 2014): neighbours are hung on the smallest known node until only stars are
    left. Each round is a grouped minimum, which combines before the shuffle, and a join on
    that minimum, whose hot nodes adaptive execution splits. Rounds are written to the shared
    folder, which cuts the lineage. The number of rounds is logarithmic; running out of
    ``rounds`` is an error, never a partial result.
    """
    def oriented(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    state = stored(oriented(edges), "edges")
    before = None
    for _ in range(rounds):
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        # large star: every greater neighbour goes to the least node of the neighbourhood
        large = both.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        # small star: a node and its smaller neighbours go to the least of them
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(lowest, "a")
        small = moved.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(lowest.select("a", F.col("m").alias("b")))
        state = stored(small.filter("a <> b").distinct(), "edges")
        now = tuple(state.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
        ).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    stars = state.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())


SPANS = "array<struct<start:int,rank:int,kind:string,end:int,found:string,part:string>>"


def with_matches(docs: DataFrame, text: str, kinds: dict[str, tuple[str, int]], hints: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with a column ``_kind`` for each kind: its leftmost non-overlapping matches as ``SPANS``.

    ``kinds``: pattern and the number of the group that ``part`` holds. ``hints``: a string without which
    there can be no match. Positions are code points: the pieces between the matches, from
    ``split``, and the matches alternate, so running lengths give every start. Built in steps,
    each a projection of its own, so that no pattern is applied twice for the same thing.
    """
    found, parts, pieces = {}, {}, {}
    for k, (pattern, group) in kinds.items():
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        hint = (hints or {}).get(k)
        found[f"_{k}_found"] = F.when(F.col(text).contains(hint), whole).otherwise(F.array().cast("array<string>")) if hint else whole
        some = F.size(f"_{k}_found") > 0
        parts[f"_{k}_part"] = F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else F.col(f"_{k}_found"))
        pieces[f"_{k}_piece"] = F.when(some, F.split(text, pattern, -1))
    out = docs.withColumns(found).withColumns(parts | pieces)
    spans = {f"_{k}": _placed(k, rank) for rank, k in enumerate(kinds)}
    return out.withColumns(spans).drop(*found, *parts, *pieces)


#: Matches whose places are summed up in one array; it is copied for each of them, so it stays short.
_RUN = 64


def _placed(kind: str, rank: int) -> Column:
    """``SPANS`` from the columns that hold the matches, their parts and the pieces between them.

    Lengths are summed up in runs of matches, first inside each run and then over the runs, so the work grows with the
    number of matches and not with its square.
    """
    found, part, piece = (F.col(f"_{kind}_{x}") for x in ("found", "part", "piece"))
    n = F.size(found)

    def after(acc: Column, i: Column) -> Column:
        start = F.element_at(acc, -1)["end"] + F.length(F.element_at(piece, i))
        return F.struct(start.alias("start"), (start + F.length(F.element_at(found, i))).alias("end"))

    def run(end: Column, first: Column) -> Column:
        """(start, end) of the matches from ``first`` on, after a place that is itself the first element."""
        return F.aggregate(
            F.sequence(first, F.least(first + _RUN - 1, n)), F.array(F.struct(F.lit(0).alias("start"), end.alias("end"))),
            lambda acc, i: F.concat(acc, F.array(after(acc, i))))

    runs = F.aggregate(
        F.sequence(F.lit(1), n, F.lit(_RUN)),
        F.array(F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end")))),
        lambda acc, first: F.concat(acc, F.array(run(F.element_at(F.element_at(acc, -1), -1)["end"], first))),
    )
    ends = F.flatten(F.transform(F.slice(runs, 2, F.size(runs)), lambda r: F.slice(r, 2, F.size(r))))
    spans = F.zip_with(
        ends, F.arrays_zip(found.alias("found"), part.alias("part")),
        lambda at, m: F.struct(
            at["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), at["end"].alias("end"),
            m["found"].alias("found"), m["part"].alias("part")),
    )
    return F.when(n > 0, spans).otherwise(F.array()).cast(SPANS)


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of ``SPANS``, by start and then rank, comma-joined."""
    return F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with ``<kind>`` instead of each span; of overlapping spans the first one's kind stands for all."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    done = F.aggregate(
        F.array_sort(spans), state,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(
                acc["text"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit("<"), s["kind"], F.lit(">"),
            )).otherwise(acc["text"]).alias("text"),
        ),
    )
    return F.concat(done["text"], F.substring(text, done["at"] + 1, F.length(text)))


def union_find(n: int, pairs: Iterable[tuple[int, int]]) -> list[int]:
    """Smallest member of the component of each of ``n`` local items."""
    root = list(range(n))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for a, b in pairs:
        a, b = top(a), top(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]
