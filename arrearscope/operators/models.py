"""Training, scoring and persistence of the four learners and their ensemble.

The boosters are this library's (:mod:`arrearscope.operators.boosting`), the forest and the linear model are MLlib's.
"""

from __future__ import annotations

import hashlib
import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass, field

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrearscope.config import LOAN, TARGET, BoostedTreesParams, RiskConfig
from arrearscope.operators import boosting
from arrearscope.operators.boosting import Booster
from arrearscope.operators.encode import apply_codes, fit_codes
from arrearscope.operators.metrics import ranking_metrics, score_curve
from arrearscope.sources.storage import scratch_path, use_checkpoints

logger = logging.getLogger(__name__)

ENSEMBLE = "ensemble"
ROWS_PER_PARTITION = 50_000


@dataclass
class TrainingStats:
    n_neg: int
    n_pos: int

    @property
    def imbalance_ratio(self) -> float:
        return self.n_neg / max(self.n_pos, 1)

    @property
    def weight_sum(self) -> float:
        return self.n_neg + self.n_pos * self.imbalance_ratio


@dataclass
class Features:
    """Encoder and assembler: numeric columns, then ordinal codes of the categories.

    Missing numbers become -1. Categories are numbered alphabetically on the training
    rows; a category they do not contain becomes -1. ``codes`` is a table, whatever its size.
    """

    codes: DataFrame
    numeric: list[str]
    categorical: list[str]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``features``; its own columns stay as they are."""
        copies = {f"_code_{name}": F.col(name) for name in self.categorical}
        codes = self.codes.withColumn("column", F.concat(F.lit("_code_"), "column"))
        filled = {f"_num_{name}": F.coalesce(F.col(name).cast("double"), F.lit(-1.0)) for name in self.numeric}
        coded = apply_codes(df.withColumns(copies | filled), codes, list(copies))
        assembled = VectorAssembler(inputCols=[*filled, *copies], outputCol="features").transform(coded)
        return assembled.drop(*filled, *copies)


@dataclass
class TrainedModels:
    features: Features
    feature_names: list[str]
    models: dict[str, PipelineModel | Booster] = field(default_factory=dict)
    validation_auc: dict[str, float] = field(default_factory=dict)
    weights: dict[str, float] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def present_features(df: DataFrame, config: RiskConfig = RiskConfig()) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature columns of the configured lists that ``df`` has."""
    return (
        [name for name in config.numeric_features if name in df.columns],
        [name for name in config.categorical_features if name in df.columns],
    )


def training_stats(train: DataFrame, target: str = TARGET) -> TrainingStats:
    """Class counts in one aggregate."""
    row = train.agg(
        F.count(F.when(F.col(target) == 0, 1)).alias("n_neg"),
        F.count(F.when(F.col(target) == 1, 1)).alias("n_pos"),
    ).first()
    return TrainingStats(row["n_neg"], row["n_pos"])


def fit_features(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> Features:
    return Features(fit_codes(train, categorical), list(numeric), list(categorical))


def _named(learner, name: str):
    """Own output columns per model, so that several models can score one row."""
    return (
        learner.setProbabilityCol(f"_prob_{name}")
        .setRawPredictionCol(f"_raw_{name}")
        .setPredictionCol(f"_pred_{name}")
    )


def _without_summary(model):
    """The fitted model without its training summary.

    The summary refers to the session, which cannot be sent to executors any more once the
    session has observed a metric; scoring would then fail.
    """
    if model.hasSummary:
        model._java_obj.setSummary(model._java_obj.trainingSummary().empty())
    return model


def _fit_boosted(params: BoostedTreesParams):
    def fit(rows: DataFrame, stats: TrainingStats, names: Sequence[str]) -> Booster:
        return boosting.fit_booster(rows, names, params)

    return fit


def _fit_forest(name: str, config: RiskConfig):
    def fit(rows: DataFrame, stats: TrainingStats, names: Sequence[str]) -> PipelineModel:
        learner = RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight",
            numTrees=config.forest.trees, maxDepth=config.forest.depth,
            minInstancesPerNode=config.forest.min_rows_per_leaf, seed=config.forest.seed,
            # every row's node in every tree is kept between passes: the same trees, without walking each from its root
            cacheNodeIds=True,
        )
        return PipelineModel([_without_summary(_named(learner, name).fit(rows.filter(~F.col("is_validation"))))])

    return fit


def _fit_logistic(name: str, config: RiskConfig):
    def fit(rows: DataFrame, stats: TrainingStats, names: Sequence[str]) -> PipelineModel:
        train = rows.filter(~F.col("is_validation"))
        scaled = f"_scaled_{name}"
        scaler = StandardScaler(inputCol="features", outputCol=scaled, withMean=True, withStd=True).fit(train)
        learner = LogisticRegression(
            featuresCol=scaled, labelCol="label", weightCol="weight",
            # the penalty is given per summed weight, MLlib averages the loss
            regParam=1.0 / (config.logistic.c * stats.weight_sum), elasticNetParam=0.0,
            maxIter=config.logistic.iterations, tol=config.logistic.tolerance, standardization=False,
        )
        return PipelineModel([scaler, _without_summary(_named(learner, name).fit(scaler.transform(train)))])

    return fit


def learners(config: RiskConfig = RiskConfig()) -> dict[str, Callable[[DataFrame, TrainingStats, Sequence[str]], PipelineModel | Booster]]:
    """Name to fit function of the four learners."""
    return {
        "boosted_a": _fit_boosted(config.boosted_a),
        "boosted_b": _fit_boosted(config.boosted_b),
        "random_forest": _fit_forest("random_forest", config),
        "logistic_regression": _fit_logistic("logistic_regression", config),
    }


def train_all(
    rows: DataFrame,
    config: RiskConfig = RiskConfig(),
    only: Sequence[str] | None = None,
    target: str = TARGET,
    whole: bool = False,
) -> TrainedModels:
    """Fit the learners with class weights, then the ensemble weights on the validation rows.

    ``rows`` has an ``is_validation`` column (see ``splits.training_frame``) and is read
    several times: pass a stored table. A learner that fails is logged and left out, its error in ``failures``;
    with ``whole`` it is a ``RuntimeError`` that names it, so that fewer models can't pass for all of them. With
    two or more models the ensemble weights are their validation AUCs divided by the sum.
    """
    use_checkpoints(rows.sparkSession)
    numeric, categorical = present_features(rows, config)
    train = rows.filter(~F.col("is_validation"))
    stats = training_stats(train, target)
    features = fit_features(train, numeric, categorical)
    label = F.col(target).cast("double")
    weighted = features.transform(rows).select(
        "features",
        label.alias("label"),
        F.when(label == 1, stats.imbalance_ratio).otherwise(1.0).alias("weight"),
        "is_validation",
    )
    partitions = max(rows.sparkSession.sparkContext.defaultParallelism, weighted.count() // ROWS_PER_PARTITION + 1)
    weighted = weighted.repartition(partitions).persist(StorageLevel.MEMORY_AND_DISK)
    trained = TrainedModels(features, [*numeric, *categorical])
    try:
        chosen = {name: fit for name, fit in learners(config).items() if only is None or name in only}
        # the boosters are long rows of short jobs: beside each other, one's tasks run while another's driver works
        with ThreadPoolExecutor(max(len(chosen), 1)) as pool:
            fits = {name: pool.submit(copy_context().run, inheritable_thread_target(rows.sparkSession)(fit), weighted, stats, trained.feature_names)
                    for name, fit in chosen.items()}
        cause = None
        for name, found in fits.items():
            try:
                trained.models[name] = found.result()
            except Exception as error:  # noqa: BLE001 - one bad learner must not stop the others
                logger.exception("training %s failed", name)
                trained.failures[name], cause = str(error), cause or error
        if whole and cause is not None:
            raise RuntimeError(f"training failed: {', '.join(trained.failures)}") from cause
        if len(trained.models) >= 2:
            _weigh(trained, weighted.filter("is_validation"))
    finally:
        weighted.unpersist()
    return trained


def _weigh(trained: TrainedModels, held_out: DataFrame) -> None:
    """Ensemble weights from the exact AUC of every model; one number per model is collected."""
    labelled = held_out.select("features", F.col("label").cast("int").alias("y"))
    scored = long_scores(_probabilities(trained, labelled), list(trained.models), ["y"])
    aucs = {row["model"]: row["auc_roc"] for row in ranking_metrics(score_curve(scored, ["model"]), ["model"]).collect()}
    trained.validation_auc = {name: aucs[name] for name in trained.models if aucs.get(name) is not None}
    total = sum(trained.validation_auc.values())
    if total:
        trained.weights = {name: auc / total for name, auc in trained.validation_auc.items()}


def _probabilities(trained: TrainedModels, assembled: DataFrame) -> DataFrame:
    """One probability column per model, and ``ensemble`` if there are weights."""
    kept = [name for name in assembled.columns if name != "features"]
    scored = assembled.withColumn("_values", vector_to_array("features"))
    probability = {}
    for name, model in trained.models.items():
        if isinstance(model, Booster):
            probability[name] = model.probability(F.col("_values"))
        else:
            scored = model.transform(scored)
            probability[name] = vector_to_array(f"_prob_{name}")[1]
    scored = scored.select(*kept, *(p.alias(name) for name, p in probability.items()))
    if trained.weights:
        combined = None
        for name, weight in trained.weights.items():
            part = F.col(name) * weight
            combined = part if combined is None else combined + part
        scored = scored.withColumn(ENSEMBLE, combined)
    return scored


def score(trained: TrainedModels, df: DataFrame) -> DataFrame:
    """``df`` with the predicted default probability of every model, in one narrow pass."""
    assembled = trained.features.transform(df).select(*df.columns, "features")
    return _probabilities(trained, assembled)


def classify(scored: DataFrame, probability: str = ENSEMBLE, threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("predicted", (F.col(probability) >= threshold).cast("int"))


def long_scores(scored: DataFrame, models: Sequence[str], keys: Sequence[str]) -> DataFrame:
    """One row per (row, model): ``keys``, ``model``, ``p``."""
    return scored.unpivot(list(keys), list(models), "model", "p")


def score_splits(
    trained: TrainedModels,
    split: DataFrame,
    parts: Sequence[str] = ("test",),
    loan: str = LOAN,
    target: str = TARGET,
) -> DataFrame:
    """(model, split, loan, y, p) of every model on the ``oos`` and ``oot`` rows of ``parts``."""
    wanted = F.col("split_oos").isin(*parts) | F.col("split_oot").isin(*parts)
    scored = score(trained, split.filter(wanted))
    schemes = F.array_compact(F.array(*[
        F.when(F.col(f"split_{name}").isin(*parts), name) for name in ("oos", "oot")
    ]))
    models = [*trained.models, *([ENSEMBLE] if trained.weights else [])]
    keyed = scored.select(F.explode(schemes).alias("split"), loan, F.col(target).cast("int").alias("y"), *models)
    return long_scores(keyed, models, ["split", loan, "y"]).select("model", "split", loan, "y", "p")


def n_trees(model: PipelineModel | Booster) -> int:
    """Trees of a model, 0 for one without."""
    return model.n_trees if isinstance(model, Booster) else getattr(model.stages[-1], "getNumTrees", 0)


def feature_importances(spark: SparkSession, trained: TrainedModels, kind: str = "gain") -> DataFrame:
    """(model, feature, importance, coefficient): for the linear model the importance is |coefficient|.

    ``kind`` is that of :func:`arrearscope.operators.boosting.importances`, for the boosters.
    """
    rows, table = [], None
    for name, model in trained.models.items():
        if isinstance(model, Booster):
            every = spark.createDataFrame([(name, f) for f in trained.feature_names], "model string, feature string")
            found = boosting.importances(model.table(spark), kind).withColumnRenamed("name", "feature")
            own = every.join(found, "feature", "left").select(
                "model", "feature", F.coalesce("importance", F.lit(0.0)).alias("importance"), F.lit(None).cast("double").alias("coefficient"))
            table = own if table is None else table.unionByName(own)
            continue
        learner = model.stages[-1]
        if hasattr(learner, "featureImportances"):
            rows += [(name, feature, float(value), None)
                     for feature, value in zip(trained.feature_names, learner.featureImportances.toArray())]
        else:
            rows += [(name, feature, abs(float(value)), float(value))
                     for feature, value in zip(trained.feature_names, learner.coefficients.toArray())]
    other = spark.createDataFrame(rows, "model string, feature string, importance double, coefficient double")
    table = other if table is None else table.unionByName(other)
    return table.orderBy("model", F.desc("importance"), "feature")


def top_features(importances: DataFrame, model: str, n: int = 15) -> DataFrame:
    return importances.filter(F.col("model") == model).orderBy(F.desc("importance"), "feature").limit(n)


def node_rows(spark: SparkSession, model: PipelineModel | Booster, names: Sequence[str]) -> list[tuple]:
    """The node table (``boosting.NODES``) of a model of trees; a forest's weights are its leaves' shares of the probability.

    A forest's nodes come from its stored form, so they outlive the session that has fitted it. The number of nodes is bounded
    by the settings.
    """
    if isinstance(model, Booster):
        return model.nodes
    forest = model.stages[-1]
    path = scratch_path(spark, "forest")
    forest.write().save(path)
    trees, found = forest.getNumTrees, []
    for tree, node in spark.read.parquet(f"{path}/data").select("treeID", "nodeData").collect():
        total = sum(node["impurityStats"])
        weight = node["impurityStats"][1] / total / trees if total else 0.0
        sums = (node["impurityStats"][1], total, node["rawCount"], weight)
        feature = node["split"]["featureIndex"]
        if node["leftChild"] < 0:
            found.append((tree, node["id"], *[None] * 7, *sums))
        else:
            found.append((tree, node["id"], feature, names[feature], None, node["split"]["leftCategoriesOrThreshold"][0],
                          node["leftChild"], node["rightChild"], node["gain"], *sums))
    return found


def score_by_nodes(spark: SparkSession, trained: TrainedModels, df: DataFrame) -> DataFrame:
    """``df`` with the probability of every model of trees, from node tables and built-in functions alone and in one narrow pass."""
    assembled = trained.features.transform(df).withColumn("_values", vector_to_array("features"))
    values, columns = F.col("_values"), {}
    for name, model in trained.models.items():
        if isinstance(model, Booster):
            columns[name] = 1 / (1 + F.exp(-boosting.tree_sums(model.nodes, values, model.base)))
        elif hasattr(model.stages[-1], "getNumTrees"):
            columns[name] = boosting.tree_sums(node_rows(spark, model, trained.feature_names), values)
    return assembled.select(*df.columns, *(column.alias(name) for name, column in columns.items()))


def linear_gradient(
    spark: SparkSession, trained: TrainedModels, rows: DataFrame, config: RiskConfig = RiskConfig(), target: str = TARGET,
    name: str = "logistic_regression",
) -> DataFrame:
    """(feature, coefficient, gradient): how far the linear model is from the optimum of its penalised loss.

    ``gradient`` is the derivative of the mean weighted loss and the penalty at the stored coefficients; at the
    optimum all are 0. ``intercept`` has a row of its own. One aggregate over the training rows of ``rows``.
    """
    model = trained.models[name]
    scaler, linear = model.stages[0], model.stages[-1]
    means, deviations, coefficients = scaler.mean.toArray(), scaler.std.toArray(), linear.coefficients.toArray()
    train = rows.filter(~F.col("is_validation"))
    stats = training_stats(train, target)
    scored = model.transform(trained.features.transform(train))
    label = F.col(target).cast("double")
    rest = F.when(label == 1, stats.imbalance_ratio).otherwise(1.0) * (vector_to_array(f"_prob_{name}")[1] - label)
    residuals = scored.select(rest.alias("r"), vector_to_array("features").alias("x"))
    sums = residuals.agg(F.sum("r").alias("all"), *(
        F.sum(F.col("r") * F.get("x", F.lit(j))).alias(f"s{j}") for j in range(len(coefficients)))).first()
    penalty = 1.0 / (config.logistic.c * stats.weight_sum)
    found = [(feature, float(c), float((sums[f"s{j}"] - m * sums["all"]) / d / stats.weight_sum + penalty * c) if d else float(penalty * c))
             for j, (feature, c, m, d) in enumerate(zip(trained.feature_names, coefficients, means, deviations))]
    found.append(("intercept", float(linear.intercept), float(sums["all"] / stats.weight_sum)))
    return spark.createDataFrame(found, "feature string, coefficient double, gradient double")


#: Version of the stored layout.
LAYOUT = 2


def save_models(spark: SparkSession, trained: TrainedModels, path: str) -> None:
    """Encoder, models, feature list, ensemble weights and a manifest under one folder; the manifest is written last."""
    trained.features.codes.write.mode("overwrite").parquet(f"{path}/codes")
    columns = [(i, kind, name) for kind, names in (("numeric", trained.features.numeric), ("categorical", trained.features.categorical))
               for i, name in enumerate(names)]
    spark.createDataFrame(columns, "position int, kind string, name string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/columns")
    for name, model in trained.models.items():
        if isinstance(model, Booster):
            model.table(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/{name}")
        else:
            model.write().overwrite().save(f"{path}/{name}")
    names = [(i, name) for i, name in enumerate(trained.feature_names)]
    spark.createDataFrame(names, "position int, feature string").coalesce(1).write.mode("overwrite").parquet(
        f"{path}/feature_names")
    table = [(i, name, isinstance(model, Booster), getattr(model, "base", None), trained.validation_auc.get(name), trained.weights.get(name))
             for i, (name, model) in enumerate(trained.models.items())]
    spark.createDataFrame(table, "position int, model string, is_booster boolean, base double, auc double, weight double").coalesce(1).write.mode(
        "overwrite").parquet(f"{path}/models")
    spark.createDataFrame([(LAYOUT, _digest(trained.feature_names), len(trained.models))], "layout int, features string, n_models int").coalesce(
        1).write.mode("overwrite").parquet(f"{path}/manifest")


def _digest(names: Sequence[str]) -> str:
    return hashlib.sha256("\n".join(names).encode()).hexdigest()


def load_models(spark: SparkSession, path: str, features: Sequence[str] | None = None) -> TrainedModels:
    """What :func:`save_models` has stored.

    Refused with a ``ValueError``: another layout, parts that don't belong together, and with ``features`` (the columns
    that the caller assembles, in order) models of another feature list.
    """
    manifest = spark.read.parquet(f"{path}/manifest").first()
    if manifest["layout"] != LAYOUT:
        raise ValueError(f"{path} has layout {manifest['layout']}, not {LAYOUT}")
    if features is not None and _digest(features) != manifest["features"]:
        raise ValueError(f"models in {path} were made from another feature list")
    names = spark.read.parquet(f"{path}/feature_names").orderBy("position").collect()
    table = spark.read.parquet(f"{path}/models").orderBy("position").collect()  # one row per model
    columns = spark.read.parquet(f"{path}/columns").orderBy("position").collect()
    feature_names = [row["feature"] for row in names]
    if _digest(feature_names) != manifest["features"] or len(table) != manifest["n_models"]:
        raise ValueError(f"{path} is not whole: its parts were stored at different times")

    def model(row):
        if not row["is_booster"]:
            return PipelineModel.load(f"{path}/{row['model']}")
        nodes = spark.read.parquet(f"{path}/{row['model']}").orderBy("tree", "node").collect()  # bounded by the settings
        return Booster(row["base"], [tuple(node) for node in nodes], feature_names)

    return TrainedModels(
        features=Features(spark.read.parquet(f"{path}/codes"), *(
            [row["name"] for row in columns if row["kind"] == kind] for kind in ("numeric", "categorical"))),
        feature_names=feature_names,
        models={row["model"]: model(row) for row in table},
        validation_auc={row["model"]: row["auc"] for row in table if row["auc"] is not None},
        weights={row["model"]: row["weight"] for row in table if row["weight"] is not None},
    )
