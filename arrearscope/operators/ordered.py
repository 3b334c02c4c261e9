"""Exact running sums over a global order, without sending the order through one task.

The rows are cut into value ranges of about equal row count. Each range is summed
up in its own window partition; the sums of all ranges before it (a table of one row
per range) are added by an equi-join on the range number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.operators.joins import null_safe_join

RANGE = "_range"
MIN_RANGES = 64
MAX_RANGES = 1024


def range_edges(df: DataFrame, value: str, ranges: int | None = None) -> list[float]:
    """Cut points that put about the same number of rows into each range of ``value``.

    Runs one narrow aggregate over ``df`` and returns at most ``ranges`` numbers. They
    only balance the work: any list of edges gives the same results. The accuracy (half
    a range) keeps the sketches small that one task has to merge.
    """
    if ranges is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        ranges = min(max(MIN_RANGES, partitions), MAX_RANGES)
    shares = [i / ranges for i in range(1, ranges)]
    cuts = df.agg(
        F.percentile_approx(F.col(value).cast("double"), shares, 2 * ranges).alias("cuts")
    ).first()["cuts"]
    distinct = sorted({cut for cut in cuts or [] if cut == cut})
    return [float("-inf"), *(distinct or [0.0]), float("inf")]


def prefix_sums(
    rows: DataFrame,
    groups: Sequence[str],
    order: str,
    sums: Sequence[str],
    edges: Sequence[float],
    ties: Sequence[str] = (),
    descending: bool = True,
    following: Sequence[str] = (),
) -> DataFrame:
    """Add ``cum_<c>`` (running sum, this row included) and ``total_<c>`` for ``c`` in ``sums``.

    The order is ``order`` (numeric), then ``ties`` ascending; together with ``groups``
    it should be unique per row. ``following`` columns also come back as ``next_<c>``
    from the next row in that order. A null group is a group.
    """
    groups = list(groups)
    ranged = Bucketizer(
        splits=list(edges), inputCol="_order", outputCol=RANGE, handleInvalid="keep"
    ).transform(rows.withColumn("_order", F.col(order).cast("double")))
    direction = F.desc if descending else F.asc
    sorting = [direction("_order"), *[F.asc(tie) for tie in ties]]
    inside = Window.partitionBy(*groups, RANGE).orderBy(*sorting)
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    # one row per (group, range): the first row's values are needed by the range before it
    position = F.struct(-F.col("_order") if descending else F.col("_order"), *ties)
    per_range = ranged.groupBy(*groups, RANGE).agg(
        *[F.sum(name).alias(f"_in_{name}") for name in sums],
        *[F.min_by(name, position).alias(f"_first_{name}") for name in following],
    )
    all_ranges = Window.partitionBy(*groups)
    range_order = all_ranges.orderBy(direction(RANGE))
    before = range_order.rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_range.select(
        *groups,
        RANGE,
        *[F.coalesce(F.sum(f"_in_{name}").over(before), F.lit(0)).alias(f"_before_{name}") for name in sums],
        *[F.sum(f"_in_{name}").over(all_ranges).alias(f"total_{name}") for name in sums],
        *[F.lead(f"_first_{name}").over(range_order).alias(f"_after_{name}") for name in following],
    )
    inner = ranged.withColumns(
        {f"_sum_{name}": F.sum(name).over(running) for name in sums}
        | {f"_lead_{name}": F.lead(name).over(inside) for name in following}
    )
    return null_safe_join(inner, offsets, [*groups, RANGE]).select(
        *rows.columns,
        *[(F.col(f"_before_{name}") + F.col(f"_sum_{name}")).alias(f"cum_{name}") for name in sums],
        *[F.col(f"total_{name}") for name in sums],
        *[F.coalesce(f"_lead_{name}", f"_after_{name}").alias(f"next_{name}") for name in following],
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    shares: dict[str, float],
    groups: Sequence[str] = (),
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Interpolated quantiles, one row per group: ``shares`` maps output name to share.

    Same result as a sort of all values, from a table of distinct values with counts.
    Nulls are left out; without any value the result has no row for the group.
    """
    values = df.filter(F.col(value).isNotNull())
    edges = edges or range_edges(values, value)
    counted = values.groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    placed = prefix_sums(counted, groups, value, ["_n"], edges, descending=False)
    last = F.col("total__n") - 1

    def at(rank: Column) -> Column:
        holds = (F.col("cum__n") - F.col("_n") <= rank) & (rank < F.col("cum__n"))
        return F.max(F.when(holds, F.col(value).cast("double")))

    parts = {}
    for name, share in shares.items():
        rank = F.lit(share) * last
        parts[name] = F.struct(
            at(F.floor(rank)).alias("low"), at(F.ceil(rank)).alias("high"),
            F.max(rank - F.floor(rank)).alias("between"),
        )
    found = placed.groupBy(*groups).agg(*[part.alias(name) for name, part in parts.items()])
    return found.select(
        *groups,
        *[(F.col(f"{name}.low") + F.col(f"{name}.between") * (F.col(f"{name}.high") - F.col(f"{name}.low")))
          .alias(name) for name in shares],
    )
