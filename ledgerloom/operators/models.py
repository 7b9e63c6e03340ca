"""Model families on Spark ML: fitting, cross-validation, grid search and selection."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import NUMERIC_FEATURES, EngineConfig
from ledgerloom.operators.metrics import macro_f1
from ledgerloom.operators.preprocessing import INPUTS, preparation_stages

WEIGHT = "class_weight"
VALIDATION_FLAG = "is_validation"
# Spark's default of .01 stops after a few rounds.
VALIDATION_TOLERANCE = 1e-5
PARALLEL_FITS = 8
#: Rows that share a partition where fits run side by side.
FIT_ROWS = 32768
#: Forests deeper than this keep the node of each row instead of following all trees from their roots at every level.
DEEP = 10

Maker = Callable[[DataFrame], object]


@dataclass(frozen=True)
class Family:
    """How to build one model: ``make`` gets the rows it will be fitted on."""

    name: str
    label: str
    make: Maker
    scaled: bool = False
    balanced: bool = False
    early_stop: bool = False


def balanced(train: DataFrame, label: str) -> DataFrame:
    """``train`` with weights n / (classes * class rows); the class counts are a handful of numbers."""
    counts = {r[label]: r["count"] for r in train.groupBy(label).count().collect()}
    total = sum(counts.values())
    weight = F.lit(0.0)
    for value, rows in counts.items():
        weight = F.when(F.col(label) == F.lit(value), total / (len(counts) * rows)).otherwise(weight)
    return train.withColumn(WEIGHT, weight)


def gathered(rows: DataFrame) -> DataFrame:
    """``rows`` in no more partitions than one for each ``FIT_ROWS``, for fits that run side by side.

    A tree learner sends the statistics of every node from every partition, so a table in more partitions than its
    size asks for costs that many times more.
    """
    return rows.coalesce(max(1, -(-rows.count() // FIT_ROWS)))


def prepared_rows(family: Family, train: DataFrame) -> tuple[DataFrame, PipelineModel]:
    """The rows a family learns from, with class weights where it balances, and the preparation fitted on them."""
    rows = balanced(train, family.label) if family.balanced else train
    return rows, Pipeline(stages=preparation_stages(rows, family.scaled)).fit(rows)


def fit(
    family: Family, train: DataFrame, validation: DataFrame | None = None, ready: tuple[DataFrame, PipelineModel] | None = None
) -> PipelineModel:
    """Fit preparation and estimator on ``train``.

    A family that stops early also sees the validation rows, only to decide when to stop. ``ready`` is the result of
    ``prepared_rows`` for these rows, where fits share it.
    """
    rows, prepared = ready or prepared_rows(family, train)
    estimator = family.make(rows)
    if family.early_stop and validation is not None:
        extra = validation.withColumn(WEIGHT, F.lit(1.0)) if family.balanced else validation
        rows = rows.withColumn(VALIDATION_FLAG, F.lit(False)).unionByName(
            extra.withColumn(VALIDATION_FLAG, F.lit(True)), allowMissingColumns=True
        )
        estimator = estimator.copy(
            {estimator.validationIndicatorCol: VALIDATION_FLAG, estimator.validationTol: VALIDATION_TOLERANCE}
        )
    fitted = estimator.fit(prepared.transform(rows))
    return PipelineModel(stages=[*prepared.stages, *(fitted.stages if isinstance(fitted, PipelineModel) else [fitted])])


def churn_families(cfg: EngineConfig) -> dict[str, Family]:
    """Churn classifiers by name, without the grids and the neighbour vote."""
    m = cfg.models

    def logistic(rows: DataFrame) -> LogisticRegression:
        # Balanced weights sum to the row count, which turns C into Spark's mean-loss penalty.
        return LogisticRegression(
            featuresCol=INPUTS,
            labelCol="churn",
            weightCol=WEIGHT,
            regParam=1.0 / (m.logistic_c * rows.count()),
            elasticNetParam=0.0,
            standardization=False,
            maxIter=m.logistic_iterations,
        )

    def tree(_: DataFrame) -> DecisionTreeClassifier:
        return DecisionTreeClassifier(
            featuresCol=INPUTS,
            labelCol="churn",
            weightCol=WEIGHT,
            maxDepth=m.tree_depth,
            minInstancesPerNode=m.tree_min_leaf,
            seed=cfg.seed,
        )

    def wide_boost(_: DataFrame) -> GBTClassifier:
        return GBTClassifier(
            featuresCol=INPUTS,
            labelCol="churn",
            weightCol=WEIGHT,
            maxIter=m.wide_boost_rounds,
            maxDepth=m.wide_boost_depth,
            stepSize=m.wide_boost_rate,
            seed=cfg.seed,
        )

    forest = forest_family(cfg, m.forest_depths[0], m.forest_min_leaves[1])
    boost = boost_family(cfg, m.boost_depths[0], m.boost_rates[0])
    return {
        f.name: f
        for f in (
            Family("LogisticRegression", "churn", logistic, scaled=True, balanced=True),
            Family("DecisionTree", "churn", tree, balanced=True),
            forest,
            boost,
            Family("WideGradientBoosting", "churn", wide_boost, balanced=True),
            network_family(cfg),
        )
    }


def forest_family(cfg: EngineConfig, depth: int, min_leaf: int) -> Family:
    """A balanced random forest at one grid point."""

    def make(_: DataFrame) -> RandomForestClassifier:
        return RandomForestClassifier(
            featuresCol=INPUTS,
            labelCol="churn",
            weightCol=WEIGHT,
            numTrees=cfg.models.forest_trees,
            maxDepth=depth,
            minInstancesPerNode=min_leaf,
            cacheNodeIds=depth > DEEP,
            seed=cfg.seed,
        )

    return Family("RandomForest", "churn", make, balanced=True)


def boost_family(cfg: EngineConfig, depth: int, rate: float) -> Family:
    """Gradient boosting with row and column sampling at one grid point."""
    m = cfg.models

    def make(_: DataFrame) -> GBTClassifier:
        return GBTClassifier(
            featuresCol=INPUTS,
            labelCol="churn",
            maxIter=m.boost_rounds,
            maxDepth=depth,
            stepSize=rate,
            subsamplingRate=m.boost_row_share,
            featureSubsetStrategy=str(m.boost_column_share),
            seed=cfg.seed,
        )

    return Family("GradientBoosting", "churn", make, early_stop=True)


def network_family(cfg: EngineConfig) -> Family:
    """Feed-forward network with two hidden layers (no normalisation or dropout layers in Spark ML)."""
    m = cfg.models

    def make(rows: DataFrame) -> MultilayerPerceptronClassifier:
        width = len(expected_inputs(rows))
        return MultilayerPerceptronClassifier(
            featuresCol=INPUTS,
            labelCol="churn",
            layers=[width, m.hidden, m.second_hidden, 2],
            maxIter=m.network_iterations,
            seed=cfg.seed,
        )

    return Family("NeuralNetwork", "churn", make, scaled=True)


def expected_inputs(rows: DataFrame) -> list[str]:
    """Names of the inputs that preparation will produce: features and the countries of ``rows``."""
    countries = [r.country for r in rows.select("country").distinct().collect()]
    return [*NUMERIC_FEATURES, *countries]


def ridge(label: str, cfg: EngineConfig, name: str = "Ridge") -> Family:
    """Ridge with a sum-of-squares penalty: Spark scales the penalty by rows and label deviation."""

    def make(rows: DataFrame) -> LinearRegression:
        size = rows.agg(F.count("*").alias("n"), F.stddev_pop(label).alias("s")).first()
        return LinearRegression(
            featuresCol=INPUTS,
            labelCol=label,
            predictionCol="prediction",
            regParam=cfg.models.ridge_alpha / size.n * (size.s or 1.0),
            elasticNetParam=0.0,
            standardization=False,
            solver="normal",
        )

    return Family(name, label, make, scaled=True)


def value_families(cfg: EngineConfig) -> dict[str, Family]:
    """Regressors for spend in the outcome window."""
    m = cfg.models

    def forest(_: DataFrame) -> RandomForestRegressor:
        return RandomForestRegressor(
            featuresCol=INPUTS,
            labelCol="clv_90d",
            numTrees=m.value_forest_trees,
            maxDepth=m.value_forest_depth,
            minInstancesPerNode=m.value_forest_min_leaf,
            seed=cfg.seed,
        )

    def boost(_: DataFrame) -> GBTRegressor:
        return GBTRegressor(
            featuresCol=INPUTS,
            labelCol="clv_90d",
            maxIter=m.value_boost_rounds,
            maxDepth=m.value_boost_depth,
            stepSize=m.value_boost_rate,
            minInstancesPerNode=m.value_boost_min_leaf,
            seed=cfg.seed,
        )

    return {
        f.name: f
        for f in (
            ridge("clv_90d", cfg),
            Family("ValueForest", "clv_90d", forest),
            Family("ValueBoosting", "clv_90d", boost),
        )
    }


def category_family(cfg: EngineConfig) -> Family:
    """Balanced forest over the next category."""

    def make(rows: DataFrame) -> Pipeline:
        index = StringIndexer(
            inputCol="next_category", outputCol="category_index", handleInvalid="keep", stringOrderType="alphabetAsc"
        )
        forest = RandomForestClassifier(
            featuresCol=INPUTS,
            labelCol="category_index",
            weightCol=WEIGHT,
            predictionCol="category_prediction",
            probabilityCol="category_probability",
            rawPredictionCol="category_raw",
            numTrees=cfg.models.category_trees,
            maxDepth=cfg.models.category_depth,
            minInstancesPerNode=cfg.models.category_min_leaf,
            seed=cfg.seed,
        )
        names = [r.next_category for r in rows.select("next_category").distinct().collect()]
        words = IndexToString(
            inputCol="category_prediction", outputCol="predicted_category", labels=[*sorted(names), "unknown"]
        )
        return Pipeline(stages=[index, forest, words])

    return Family("CategoryForest", "next_category", make, balanced=True)


def fit_sequence_timing(
    sequences: DataFrame, train: DataFrame, validation: DataFrame, cfg: EngineConfig
) -> PipelineModel:
    """Waiting time from the padded purchase sequence and its length.

    Boosted trees over the flattened sequence take the place of a recurrent network; padding is zero and the
    length is an input, so values after the length carry nothing.
    """
    boost = GBTRegressor(
        featuresCol="sequence",
        labelCol="next_days",
        predictionCol="predicted_next_days",
        maxIter=cfg.models.timing_rounds,
        maxDepth=3,
        stepSize=0.1,
        seed=cfg.seed,
        validationIndicatorCol=VALIDATION_FLAG,
        validationTol=VALIDATION_TOLERANCE,
    )
    columns = ["customer_id", "next_days"]
    rows = train.select(*columns, F.lit(False).alias(VALIDATION_FLAG)).unionByName(
        validation.select(*columns, F.lit(True).alias(VALIDATION_FLAG))
    )
    flat = flatten_sequences(sequences)
    vectors = VectorAssembler(inputCols=[c for c in flat.columns if c != "customer_id"], outputCol="sequence")
    return Pipeline(stages=[vectors, boost]).fit(rows.join(flat, "customer_id"))


def flatten_sequences(sequences: DataFrame) -> DataFrame:
    """One numeric column per step and vector entry, plus the length."""
    flat = F.flatten("values")
    first = sequences.select(F.size(flat).alias("n")).first()
    width = first.n if first else 0
    return sequences.select(
        "customer_id",
        F.col("length").cast("double").alias("length"),
        *[F.get(flat, F.lit(i)).cast("double").alias(f"s{i}") for i in range(width)],
    )


def probability() -> Column:
    """Probability of class one."""
    return vector_to_array("probability")[1]


def auc(scored: DataFrame) -> float:
    """Exact area under the ROC curve of a transformed frame."""
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="churn", numBins=0)
    return evaluator.evaluate(scored)


def r2(scored: DataFrame, label: str) -> float:
    """R2 of a transformed frame, predictions as they are."""
    return RegressionEvaluator(labelCol=label, metricName="r2").evaluate(scored)


def negative_mae(scored: DataFrame, label: str) -> float:
    """Negated mean absolute error."""
    return -RegressionEvaluator(labelCol=label, metricName="mae").evaluate(scored)


def cross_validate(
    family: Family, train: DataFrame, cfg: EngineConfig, metric: Callable[[DataFrame], float]
) -> list[float]:
    """Score per fold; preparation is refitted inside each fold. Fits run side by side."""

    def one(fold: int) -> float:
        fitted = fit(family, gathered(train.filter(F.col("fold") != fold)))
        return metric(fitted.transform(train.filter(F.col("fold") == fold)))

    with ThreadPool(PARALLEL_FITS) as pool:
        return pool.map(one, range(cfg.cv_folds))


def macro_f1_score(scored: DataFrame) -> float:
    """Macro F1 over next categories."""
    return macro_f1(scored, "next_category", "predicted_category").first().macro_f1


def grid_search(
    points: Sequence[tuple[dict, Family]], train: DataFrame, cfg: EngineConfig
) -> tuple[Family, DataFrame]:
    """Best family by mean fold AUC, and a table with one row per grid point and fold.

    Points that prepare their rows alike share the preparation of a fold.
    """
    jobs = [(i, fold) for i in range(len(points)) for fold in range(cfg.cv_folds)]

    def kind(i: int) -> tuple:
        return points[i][1].label, points[i][1].scaled, points[i][1].balanced

    def prepare(key: tuple) -> tuple[DataFrame, PipelineModel]:
        *shared, fold = key
        family = next(points[i][1] for i in range(len(points)) if kind(i) == tuple(shared))
        return prepared_rows(family, gathered(train.filter(F.col("fold") != fold)))

    def one(job: tuple[int, int]) -> float:
        i, fold = job
        fitted = fit(points[i][1], ready[*kind(i), fold][0], ready=ready[*kind(i), fold])
        return auc(fitted.transform(train.filter(F.col("fold") == fold)))

    keys = list(dict.fromkeys((*kind(i), fold) for i, fold in jobs))
    # Deep points take longest and are begun first.
    begun = sorted(jobs, key=lambda job: -points[job[0]][0].get("depth", 0))
    with ThreadPool(PARALLEL_FITS) as pool:
        ready = dict(zip(keys, pool.map(prepare, keys, chunksize=1), strict=True))
        found = dict(zip(begun, pool.map(one, begun, chunksize=1), strict=True))
    scores = [found[job] for job in jobs]
    rows, means = [], {}
    for (i, fold), score in zip(jobs, scores, strict=True):
        rows.append((points[i][1].name, str(points[i][0]), fold, float(score)))
        means.setdefault(i, []).append(score)
    best = max(means, key=lambda i: sum(means[i]) / len(means[i]))
    table = train.sparkSession.createDataFrame(rows, "model string, parameters string, fold int, auc double")
    return points[best][1], table


def forest_grid(cfg: EngineConfig) -> list[tuple[dict, Family]]:
    """All forest grid points."""
    return [
        ({"depth": d, "min_leaf": leaf}, forest_family(cfg, d, leaf))
        for d in cfg.models.forest_depths
        for leaf in cfg.models.forest_min_leaves
    ]


def boost_grid(cfg: EngineConfig) -> list[tuple[dict, Family]]:
    """All boosting grid points."""
    return [
        ({"depth": d, "rate": r}, boost_family(cfg, d, r))
        for d in cfg.models.boost_depths
        for r in cfg.models.boost_rates
    ]
