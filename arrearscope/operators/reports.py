"""Score reports: distribution over bands, histograms, deciles, population stability."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrearscope.config import LOAN, SCORE_BANDS, ScoreScale
from arrearscope.functions.scoring import risk_label, score_band, score_points
from arrearscope.operators.joins import null_safe_join, small_side
from arrearscope.operators.metrics import MODEL_SPLIT
from arrearscope.operators.ordered import exact_quantiles, prefix_sums, range_edges

PSI_FLOOR = 1e-6


def add_scores(
    df: DataFrame,
    probability: str = "p",
    score: str = "credit_score_pred",
    scale: ScoreScale = ScoreScale(),
) -> DataFrame:
    """Append the score and its ``risk_bucket``."""
    return df.withColumn(score, score_points(F.col(probability), scale)).withColumn(
        "risk_bucket", risk_label(F.col(score), scale)
    )


def risk_actions(df: DataFrame, risk: str = "risk_bucket") -> DataFrame:
    """Left join of the business action for each risk label (a table of six rows)."""
    actions = df.sparkSession.createDataFrame(
        [(label, action) for _, _, label, action in SCORE_BANDS], f"`{risk}` string, business_action string"
    )
    return df.join(F.broadcast(actions), risk, "left")


def _with_every(table: DataFrame, groups: Sequence[str], key: str, values: Sequence, columns: dict[str, Column]):
    """Rows of ``table`` for every group and every value of ``key``, in place of missing ones ``columns``.

    The table has one row per (group, key), so the list that is built per group is no
    longer than ``values``.
    """
    entries = F.map_from_entries(F.collect_list(F.struct(F.col(key), F.struct(*columns))))
    empty = F.struct(*[default.alias(name) for name, default in columns.items()])
    wanted = F.array(*[F.lit(value) for value in values])
    return (
        table.groupBy(*groups).agg(entries.alias("_found"))
        .select(*groups, "_found", F.explode(wanted).alias(key))
        .withColumn("_row", F.coalesce(F.try_element_at("_found", F.col(key)), empty))
        .select(*groups, key, *[F.col(f"_row.{name}").alias(name) for name in columns])
    )


def score_distribution(
    scored: DataFrame, groups: Sequence[str] = (), score: str = "score", label: str | None = "y",
    scale: ScoreScale = ScoreScale(),
) -> DataFrame:
    """Loans, mean/min/max score, default rate and share of every score band, empty bands included."""
    aggregates = [
        F.count(score).alias("n_loans"),
        F.avg(score).alias("mean_score"),
        F.min(score).alias("min_score"),
        F.max(score).alias("max_score"),
    ]
    empty = {
        "n_loans": F.lit(0).cast("bigint"),
        "mean_score": F.lit(None).cast("double"),
        "min_score": F.lit(None).cast("int"),
        "max_score": F.lit(None).cast("int"),
    }
    if label is not None:
        aggregates.append(F.bround(100.0 * F.avg(F.col(label).cast("double")), 2).alias("default_rate_pct"))
        empty["default_rate_pct"] = F.lit(None).cast("double")
    banded = scored.withColumn("score_bucket", score_band(F.col(score), scale))
    found = banded.groupBy(*groups, "score_bucket").agg(*aggregates)
    found = found.filter(F.col("score_bucket").isNotNull())
    table = _with_every(found, groups, "score_bucket", [name for _, name, _, _ in SCORE_BANDS], empty)
    whole = Window.partitionBy(*groups)  # six rows per group
    return table.withColumn(
        "pct_of_total", F.bround(100.0 * F.try_divide(F.col("n_loans"), F.sum("n_loans").over(whole)), 1)
    )


def _attach(rows: DataFrame, per_group: DataFrame, groups: Sequence[str], how: str = "inner") -> DataFrame:
    """Columns of a table with one row per report group, next to every row.

    A shuffle on few keys would send each group to one task, so the table is broadcast
    after it was counted. Without groups it is a single row and comes in as scalar subqueries.
    """
    if groups:
        return null_safe_join(rows, small_side(per_group, "per-group"), list(groups), how)
    return rows.withColumns({name: per_group.select(name).scalar() for name in per_group.columns})


def histogram(
    df: DataFrame,
    value: str,
    bins: int,
    low: float | None = None,
    high: float | None = None,
    groups: Sequence[str] = ("y",),
) -> DataFrame:
    """Equal-width histogram with density per group; the last bin includes its upper edge.

    Without ``low`` and ``high`` every group's own minimum and maximum are used, which takes
    a second pass over ``df``. Values outside the range are not counted; all bins come out,
    also empty ones.
    """
    values = df.filter(F.col(value).isNotNull()).select(*groups, F.col(value).cast("double").alias("_v"))
    if low is None or high is None:
        limits = values.groupBy(*groups).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        # a single distinct value gets a range of width one around it
        flat = F.col("_low") == F.col("_high")
        limits = limits.withColumns({
            "_low": F.when(flat, F.col("_low") - 0.5).otherwise(F.col("_low")),
            "_high": F.when(flat, F.col("_high") + 0.5).otherwise(F.col("_high")),
        })
        ranged = _attach(values, limits, groups)
    else:
        ranged = values.withColumns({"_low": F.lit(float(low)), "_high": F.lit(float(high))})
    width = (F.col("_high") - F.col("_low")) / bins
    position = F.least(F.floor((F.col("_v") - F.col("_low")) / width), F.lit(bins - 1)).cast("int")
    filled = (
        ranged.filter(F.col("_v").between(F.col("_low"), F.col("_high")))
        .withColumn("bin", position)
        .groupBy(*groups, "bin")
        .agg(F.count(F.lit(1)).alias("n"), F.min("_low").alias("_low"), F.min("_high").alias("_high"))
    )
    table = _with_every(filled, groups, "bin", range(bins), {
        "n": F.lit(0).cast("bigint"), "_low": F.lit(None).cast("double"), "_high": F.lit(None).cast("double"),
    })
    whole = Window.partitionBy(*groups)  # one row per bin
    edges = {"_low": F.min("_low").over(whole), "_high": F.min("_high").over(whole)}
    return table.withColumns(edges).select(
        *groups,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("bin_start"),
        (F.col("_low") + (F.col("bin") + 1) * width).alias("bin_end"),
        "n",
        F.try_divide(F.col("n"), F.sum("n").over(whole) * width).alias("density"),
    )


TIE_DIGITS = 3  # hex digits of the tie-break: one score is cut into up to 4096 blocks


def ks_deciles(
    scored: DataFrame,
    groups: Sequence[str] = MODEL_SPLIT,
    score: str = "p",
    label: str = "y",
    key: str = LOAN,
    bins: int = 10,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Equal-count groups from the highest score down, with cumulative shares and their gap.

    Equal scores are put in the order of the md5 of the loan key, so the group sizes
    differ by one at most, also when a third of all rows share one score. Rows are
    ranked in blocks (score and first digits of the md5); single rows are looked at only in
    the few blocks that straddle a boundary, at most ``bins - 1`` per group.
    """
    rows = scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())
    edges = edges or range_edges(rows, score)
    digest = F.md5(F.col(key).cast("string"))
    block_keys = [*groups, score, "_tie"]
    rows = rows.select(
        *groups, score, F.substring(digest, 1, TIE_DIGITS).alias("_tie"), digest.alias("_digest"),
        F.col(key).alias("_key"), F.col(label).cast("int").alias("_event"),
    )
    blocks = rows.groupBy(*block_keys).agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_event").alias("_pos")
    )
    placed = prefix_sums(blocks, groups, score, ["_n"], edges, ties=["_tie"])

    def bin_of(rows_before: Column) -> Column:
        return (F.floor(bins * rows_before / F.col("total__n")) + 1).cast("int")

    start = F.col("cum__n") - F.col("_n")
    placed = placed.withColumns({
        "_start": start, "_bin": bin_of(start), "_last_bin": bin_of(F.col("cum__n") - 1),
    })
    whole_blocks = placed.filter("_bin = _last_bin").select(
        *groups, F.col("_bin").alias("decile"), "_n", "_pos", score
    )
    # at most bins - 1 rows per group
    straddling = small_side(placed.filter("_bin < _last_bin").select(*block_keys, "_start", "total__n"), "straddling")
    inside = Window.partitionBy(*block_keys).orderBy("_digest", "_key")
    single_rows = (
        null_safe_join(rows, straddling, block_keys)
        .withColumn("_rank", F.col("_start") + F.row_number().over(inside) - 1)
        .select(*groups, bin_of(F.col("_rank")).alias("decile"), F.lit(1).cast("bigint").alias("_n"),
                F.col("_event").cast("bigint").alias("_pos"), score)
    )
    table = whole_blocks.unionByName(single_rows).groupBy(*groups, "decile").agg(
        F.sum("_n").alias("n"), F.sum("_pos").alias("n_default"),
        F.min(score).alias("min_p"), F.max(score).alias("max_p"),
    )
    everything = Window.partitionBy(*groups)  # ``bins`` rows per group
    so_far = everything.orderBy("decile")
    negatives = F.col("n") - F.col("n_default")
    default_share = F.try_divide(F.sum("n_default").over(so_far), F.sum("n_default").over(everything))
    other_share = F.try_divide(F.sum(negatives).over(so_far), F.sum(negatives).over(everything))
    return table.select(
        *groups, "decile", "n", "n_default",
        (F.col("n_default") / F.col("n")).alias("default_rate"),
        "min_p", "max_p",
        (100 * default_share).alias("cum_default_pct"),
        (100 * other_share).alias("cum_non_default_pct"),
        F.abs(default_share - other_share).alias("ks"),
    )


def max_ks(deciles: DataFrame, groups: Sequence[str] = MODEL_SPLIT) -> DataFrame:
    """Greatest gap of a decile table and the (first) decile it occurs in."""
    best = F.max(F.struct("ks", (-F.col("decile")).alias("_decile")))
    return deciles.groupBy(*groups).agg(best.alias("_best")).select(
        *groups, F.col("_best.ks").alias("max_ks"), (-F.col("_best._decile")).alias("decile")
    )


def psi_bins(
    scored: DataFrame,
    groups: Sequence[str] = ("model",),
    value: str = "p",
    split: str = "split",
    expected: str = "oos",
    actual: str = "oot",
    bins: int = 10,
    edges: Sequence[float] | None = None,
) -> DataFrame:
    """Share of expected and actual rows between the expected sample's quantiles.

    The outer bins are open; shares are floored before the logarithm. A group without expected
    rows has no quantiles: its rows are all in the first bin and its contributions are null.
    """
    rows = scored.filter(F.col(split).isin(expected, actual) & F.col(value).isNotNull())
    names = {f"_q{i}": i / bins for i in range(1, bins)}
    cuts = exact_quantiles(rows.filter(F.col(split) == expected), value, names, groups, edges)
    # one plus the number of cut points below: a value on a cut point stays in the lower bin
    position = sum((F.coalesce(F.col(value) > F.col(name), F.lit(False)).cast("int") for name in names), F.lit(1))
    per_bin = _attach(rows, cuts, groups, "left").groupBy(*groups, position.alias("bin")).agg(
        F.sum((F.col(split) == expected).cast("int")).alias("n_expected"),
        F.sum((F.col(split) == actual).cast("int")).alias("n_actual"),
    )
    zero = F.lit(0).cast("bigint")
    table = _with_every(per_bin, groups, "bin", range(1, bins + 1), {"n_expected": zero, "n_actual": zero})
    whole = Window.partitionBy(*groups)  # ``bins`` rows per group

    def share(count: str) -> Column:
        return F.greatest(
            F.try_divide(F.col(count), F.sum(count).over(whole)), F.lit(PSI_FLOOR)
        )

    e, a = share("n_expected"), share("n_actual")
    return table.select(
        *groups, "bin", "n_expected", "n_actual", e.alias("share_expected"), a.alias("share_actual"),
    ).withColumn(
        "contribution",
        F.when(F.sum("n_expected").over(whole) > 0, (F.col("share_actual") - F.col("share_expected"))
               * F.log(F.col("share_actual") / F.col("share_expected"))),
    )


def psi(bins: DataFrame, groups: Sequence[str] = ("model",)) -> DataFrame:
    """Population stability index of :func:`psi_bins` with its verdict."""
    total = bins.groupBy(*groups).agg(F.sum("contribution").alias("psi"))
    return total.withColumn(
        "status",
        F.when(F.col("psi").isNull(), "NO EXPECTED ROWS").when(F.col("psi") < 0.10, "STABLE").when(F.col("psi") < 0.25, "MODERATE SHIFT")
        .otherwise("SIGNIFICANT SHIFT"),
    )


