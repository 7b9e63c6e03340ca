"""Registered queries that fit or apply models. Most have no SQL; the ones that do are checked exactly."""

from __future__ import annotations

import uuid
from multiprocessing.pool import ThreadPool

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.config import FEATURES, NUMERIC_FEATURES
from ledgerloom.operators import (
    anomaly,
    attributions,
    clustering,
    explain,
    metrics,
    models,
    neighbours,
    networks,
    segments,
    sequences,
    serving,
    splits,
)
from ledgerloom.operators.preprocessing import INPUTS, preparation_stages
from ledgerloom.plans import training
from ledgerloom.plans.queries import query, rounded
from ledgerloom.plans.snapshot import saved
from ledgerloom.session import materialize, shared_folder
from ledgerloom.sources import store
from ledgerloom.sources.tables import TABLE_CONFIG as CFG

_CACHE: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, folder: str, name: str, build):
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _CACHE:
        _CACHE[key] = build()
    return _CACHE[key]


def _table(spark, folder, partition: str | None = None) -> DataFrame:
    table = saved(spark, folder, "partitioned")
    return table if partition is None else table.filter(F.col("partition") == partition)


def _train_with_folds(spark, folder) -> DataFrame:
    def build() -> DataFrame:
        table = _table(spark, folder)
        folds = splits.stratified_folds(table, CFG).select("customer_id", "fold")
        return materialize(table.join(folds, "customer_id"), "folds")

    return _once(spark, folder, "folds", build)


def _sequences(spark, folder) -> DataFrame:
    def build() -> DataFrame:
        clean = saved(spark, folder, "clean")
        return materialize(sequences.customer_sequences(clean, _table(spark, folder), CFG), "sequences")

    return _once(spark, folder, "sequences", build)


def _segments(spark, folder) -> clustering.SegmentModel:
    return _once(
        spark, folder, "segments", lambda: clustering.fit_segments(_table(spark, folder, "train"), CFG)
    )


def _forest_search(spark, folder):
    """The winning forest and the logged scores of every grid point and fold."""
    return _once(spark, folder, "forest", lambda: models.grid_search(models.forest_grid(CFG), _train_with_folds(spark, folder), CFG))


def _fold_scores(spark, folder) -> list[tuple[str, str, int, float]]:
    """(model, metric, fold, score); the networks' folds are trained in shared jobs."""

    def build() -> list[tuple]:
        train, series = _train_with_folds(spark, folder), _sequences(spark, folder)
        churn = models.churn_families(CFG)
        jobs = [
            ("roc_auc", churn["LogisticRegression"], models.auc),
            ("roc_auc", churn["DecisionTree"], models.auc),
            ("r2", models.value_families(CFG)["Ridge"], lambda s: models.r2(s, "clv_90d")),
            ("neg_mae", models.ridge("next_days", CFG, "TimingRidge"), lambda s: models.negative_mae(s, "next_days")),
            ("macro_f1", models.category_family(CFG), models.macro_f1_score),
        ]

        def plain(job) -> list[tuple]:
            metric, family, score = job
            return [(family.name, metric, fold, float(value)) for fold, value in enumerate(models.cross_validate(family, train, CFG, score))]

        def churn_network() -> list[tuple]:
            fitted = networks.fold_churn_networks(train, CFG).items()
            return [(training.NETWORK, "roc_auc", fold, float(models.auc(model.transform(train.filter(F.col("fold") == fold))))) for fold, model in fitted]

        def timing_network() -> list[tuple]:
            found = []
            for fold, model in networks.fold_timing_networks(series, train, CFG).items():
                scored = training.score_timing(model, train.filter(F.col("fold") == fold).select("customer_id", "next_days"), series, CFG)
                found.append(("TimingNetwork", "neg_mae", fold, float(models.negative_mae(scored.withColumnRenamed("predicted_next_days", "prediction"), "next_days"))))
            return found

        def forest() -> list[tuple]:
            _forest_search(spark, folder)
            return []

        works = [forest, churn_network, timing_network, *[lambda job=job: plain(job) for job in jobs]]
        with ThreadPool(5) as pool:
            parts = pool.map(lambda work: work(), works, chunksize=1)
        rows = [row for part in parts for row in part]
        best, log = _forest_search(spark, folder)
        means: dict[str, list] = {}
        for r in log.collect():  # one row a grid point and fold
            means.setdefault(r.parameters, []).append((r.fold, r.auc))
        winner = max(means.values(), key=lambda found: sum(v for _, v in found) / len(found))
        rows.extend((best.name, "roc_auc", fold, float(value)) for fold, value in winner)
        return rows

    return _once(spark, folder, "fold_scores", build)


def _run(spark, folder) -> training.FrozenRun:
    def build() -> training.FrozenRun:
        folds: dict[str, dict] = {}
        _train_with_folds(spark, folder)
        with ThreadPool(2) as pool:
            scores, clusters = pool.map(lambda work: work(spark, folder), [_fold_scores, _segments], chunksize=1)
        for name, metric in {(m, k) for m, k, _, _ in scores}:
            values = [v for m, k, _, v in scores if (m, k) == (name, metric)]
            folds.setdefault(name, {})[metric] = sum(values) / len(values)
        parts = (_table(spark, folder), _sequences(spark, folder), CFG)
        return training.train_run(*parts, segment_model=clusters, forest=_forest_search(spark, folder)[0], folds=folds)

    return _once(spark, folder, "run", build)


def _snapshot(spark, folder) -> DataFrame:
    def build() -> DataFrame:
        scored = training.score_snapshot(_run(spark, folder), _table(spark, folder), _sequences(spark, folder))
        return materialize(scored, "snapshot")

    return _once(spark, folder, "snapshot", build)


# ---- Preparation and churn models ------------------------------------------------------------------
_FLAGGED = f"""SELECT customer_id, country, flags, CAST({len(NUMERIC_FEATURES)} + (SELECT count(DISTINCT country) FROM train) AS INTEGER)
    AS inputs FROM (SELECT customer_id, country, CASE WHEN country IN (SELECT country FROM train) THEN 1.0 ELSE 0.0 END::DOUBLE AS flags
    FROM partitioned UNION ALL SELECT customer_id, 'Nowhere', 0.0::DOUBLE FROM partitioned) t"""


@query("onehot_country", _FLAGGED)
def onehot_country(spark, folder):
    """Country indicators fitted on train; for countries unseen there, all are zero."""
    train = _table(spark, folder, "train")
    fitted = Pipeline(stages=preparation_stages(train, scaled=False)).fit(train)
    table = _table(spark, folder)
    unseen = table.withColumn("country", F.lit("Nowhere"))
    flags = vector_to_array("country_flags")
    shown = fitted.transform(table.unionByName(unseen))
    total = F.aggregate(flags, F.lit(0.0), lambda a, x: a + x)
    return shown.select("customer_id", "country", total.alias("flags"), F.size(vector_to_array(INPUTS)).alias("inputs"))


def _churn_query(key: str, name: str) -> None:
    @query(key)
    def run(spark, folder):
        family = models.churn_families(CFG)[name]
        fitted = models.fit(family, _table(spark, folder, "train"), _table(spark, folder, "validation"))
        scored = training.score_churn(fitted, _table(spark, folder))
        return scored.select("customer_id", "partition", "churn", "churn_probability")


_churn_query("churn_logistic", "LogisticRegression")
_churn_query("churn_tree", "DecisionTree")
_churn_query("churn_forest", "RandomForest")
_churn_query("churn_gbt", "GradientBoosting")
_churn_query("churn_gbt_wide", "WideGradientBoosting")


@query("churn_mlp")
def churn_mlp(spark, folder):
    """The weighted network, normalised and with dropout, stopped on the validation rows."""
    model = networks.fit_churn_network(_table(spark, folder, "train"), _table(spark, folder, "validation"), CFG)
    return training.score_churn(model, _table(spark, folder)).select("customer_id", "partition", "churn", "churn_probability")


_KNN_POINT = ", ".join(
    f"({c} - (SELECT avg({c}) FROM train)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM train) AS z_{c}" for c in NUMERIC_FEATURES
)
# Two countries differ in two indicators, a country unknown to train in one.
_KNN_GAP = " + ".join(f"(a.z_{c} - b.z_{c}) ** 2" for c in NUMERIC_FEATURES) + (
    " + CASE WHEN a.country = b.country THEN 0 WHEN a.country IN (SELECT country FROM train) THEN 2 ELSE 1 END"
)


@query(
    "churn_knn",
    f"""SELECT customer_id, "partition", round(sum(churn / d) / sum(1 / d), 6) AS churn_probability FROM (
    SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY d, neighbour) AS r FROM (
    SELECT a.customer_id, a."partition", b.churn, b.customer_id AS neighbour, sqrt({_KNN_GAP}) AS d
    FROM (SELECT customer_id, "partition", country, {_KNN_POINT} FROM partitioned WHERE "partition" <> 'train') a
         CROSS JOIN (SELECT customer_id, churn, country, {_KNN_POINT} FROM train) b))
    WHERE r <= {CFG.models.neighbours} GROUP BY "partition", customer_id""",
)
def churn_knn(spark, folder):
    """Vote of the nearest train customers over all inputs, for the validation and test partitions."""
    table = _table(spark, folder)
    train = table.filter(F.col("partition") == "train")
    scaled = segments.standardize(table, segments.fit_scaling(train, NUMERIC_FEATURES))
    countries = sorted(r.country for r in train.select("country").distinct().collect())  # a fixed dimension
    flags = {f"f_{i}": (F.col("country") == c).cast("double") for i, c in enumerate(countries)}
    scaled = scaled.withColumns(flags)
    near = neighbours.nearest_neighbours(
        scaled.filter(F.col("partition") != "train"),
        scaled.filter(F.col("partition") == "train"),
        [*[f"z_{c}" for c in NUMERIC_FEATURES], *flags],
        "churn",
        CFG.models.neighbours,
        CFG.seed,
    )
    votes = neighbours.neighbour_vote(near).join(table.select("customer_id", "partition"), "customer_id")
    return rounded(votes.select("customer_id", "partition", "churn_probability"))


# ---- Value, timing, category -----------------------------------------------------------------------
def _value_query(key: str, name: str) -> None:
    @query(key)
    def run(spark, folder):
        fitted = models.fit(models.value_families(CFG)[name], _table(spark, folder, "train"))
        scored = training.score_value(fitted, _table(spark, folder))
        return scored.select("customer_id", "partition", "clv_90d", "predicted_clv_90d")


_value_query("value_ridge", "Ridge")
_value_query("value_forest", "ValueForest")
_value_query("value_gbt", "ValueBoosting")


def _within_horizon(column: str):
    """A predicted wait, no longer than the horizon and no shorter than none."""
    clipped = F.least(F.greatest(F.col(column), F.lit(0.0)), F.lit(float(CFG.horizon_days)))
    return clipped.alias("predicted_next_days")


@query("timing_ridge")
def timing_ridge(spark, folder):
    fitted = models.fit(models.ridge("next_days", CFG), _table(spark, folder, "train"))
    scored = fitted.transform(_table(spark, folder))
    return scored.select("customer_id", "partition", "next_days", _within_horizon("prediction"))


@query("timing_sequence")
def timing_sequence(spark, folder):
    table, series = _table(spark, folder), _sequences(spark, folder)
    model = networks.fit_timing_network(series, _table(spark, folder, "train"), _table(spark, folder, "validation"), CFG)
    return training.score_timing(model, table.select("customer_id", "partition", "next_days"), series, CFG)


@query("next_category_forest")
def next_category_forest(spark, folder):
    fitted = models.fit(models.category_family(CFG), _table(spark, folder, "train"))
    scored = training.score_category(fitted, _table(spark, folder))
    return scored.select("customer_id", "partition", "next_category", "predicted_category")


@query("anomaly_scores")
def anomaly_scores(spark, folder):
    fitted = anomaly.fit_anomaly_network(_table(spark, folder, "train"), _table(spark, folder, "validation"), CFG)
    scored = anomaly.anomaly_scores(_table(spark, folder), fitted)
    return scored.select("customer_id", "partition", "anomaly_score", "anomaly")


# ---- Selection -------------------------------------------------------------------------------------
@query("cross_validate")
def cross_validate(spark, folder):
    """Fold scores of the linear, tree, forest and network models for all tasks."""
    return spark.createDataFrame(_fold_scores(spark, folder), "model string, metric string, fold int, score double")


@query("grid_search")
def grid_search(spark, folder):
    """Every forest grid point on every fold."""
    return _forest_search(spark, folder)[1]


@query("learning_curves")
def learning_curves(spark, folder):
    """Loss by iteration of every model trained step by step."""
    return spark.createDataFrame(training.learning_curves(_run(spark, folder)), "model string, iteration int, loss string, value double")


_NO_DIFFERENCE = "SELECT count(*) AS customers, CAST(0 AS BIGINT) AS differences FROM partitioned"


@query("saved_run_scores", _NO_DIFFERENCE)
def saved_run_scores(spark, folder):
    """Customers whose scores by a saved and loaded run differ from those of the run itself."""
    target = f"{shared_folder(spark).rstrip('/')}/ledgerloom/run-{uuid.uuid4().hex}"
    training.save_run(_run(spark, folder), target)
    loaded = training.score_snapshot(training.load_run(target, CFG), _table(spark, folder), _sequences(spark, folder))
    columns = ["customer_id", *[c for c in training.SCORE_COLUMNS if c != "partition"]]
    numbers = [c for c, t in loaded.select(*columns).dtypes if t == "double"]
    pairs = _snapshot(spark, folder).select(*columns).alias("a").join(loaded.select(*columns).alias("b"), "customer_id", "full")
    apart = [F.abs(F.col(f"a.{c}") - F.col(f"b.{c}")) > 1e-9 if c in numbers else ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns[1:]]
    missing = [F.col(f"a.{c}").isNull() != F.col(f"b.{c}").isNull() for c in numbers]
    differ = F.coalesce(F.greatest(*[F.coalesce(x, F.lit(False)) for x in apart + missing]), F.lit(True))
    return pairs.agg(F.count("*").alias("customers"), F.count_if(differ).alias("differences"))


@query("model_comparison")
def model_comparison(spark, folder):
    return training.evaluate_test(_run(spark, folder), _table(spark, folder), _sequences(spark, folder))


@query("score_snapshot")
def score_snapshot(spark, folder):
    return _snapshot(spark, folder)


@query("score_batch")
def score_batch(spark, folder):
    """The whole feature table as one batch."""
    table = _table(spark, folder)
    return training.score_batch(_run(spark, folder), table, CFG)


@query("held_out_diagnostics")
def held_out_diagnostics(spark, folder):
    """Error summaries of the saved test scores."""
    found = training.held_out_diagnostics(_run(spark, folder), _table(spark, folder), _snapshot(spark, folder))
    value = metrics.error_summary(found["value"]).withColumn("task", F.lit("value"))
    return value.unionByName(metrics.error_summary(found["timing"]).withColumn("task", F.lit("timing")))


# ---- Segments --------------------------------------------------------------------------------------
@query("kmeans_select_k")
def kmeans_select_k(spark, folder):
    table = clustering.quality_table(_segments(spark, folder), _table(spark, folder))
    return table.filter(F.col("model") == "KMeans")


@query("inertia_elbow")
def inertia_elbow(spark, folder):
    return kmeans_select_k(spark, folder).select("k", "inertia")


@query("gmm_compare")
def gmm_compare(spark, folder):
    table = clustering.quality_table(_segments(spark, folder), _table(spark, folder))
    return table.filter(F.col("model") == "GaussianMixture").drop("inertia")


@query("assign_segments")
def assign_segments(spark, folder):
    placed = clustering.assign_segments(_table(spark, folder), _segments(spark, folder))
    return placed.select("customer_id", "cluster", "segment", "gmm_cluster")


# ---- Explanation -----------------------------------------------------------------------------------
# A stated linear risk score over z-scores, to check exact contributions against SQL.
_LINEAR = {"recency": 0.9, "frequency": -0.6, "monetary": -0.3, "tenure": 0.1}


@query(
    "shap_linear",
    " UNION ALL ".join(
        f"""SELECT customer_id, '{c}' AS feature, round({c}, 6) AS value,
        round({w} * ({c} - (SELECT avg({c}) FROM train)), 6) AS contribution FROM partitioned"""
        for c, w in _LINEAR.items()
    ),
)
def shap_linear(spark, folder):
    means = _table(spark, folder, "train").agg(*[F.avg(c).alias(c) for c in _LINEAR]).first().asDict()
    return rounded(explain.linear_contributions(_table(spark, folder), _LINEAR, means))


def _scorer(spark, folder) -> explain.Scorer:
    run = _run(spark, folder)
    return lambda df: training.score_churn(run.churn[run.champion], df)


def _contributions(spark, folder) -> DataFrame:
    def build() -> DataFrame:
        run = _run(spark, folder)
        found = attributions.contributions(run.churn[run.champion], _table(spark, folder), _table(spark, folder, "train"))
        return materialize(found, "contributions")

    return _once(spark, folder, "contributions", build)


@query("shap_sampled")
def shap_sampled(spark, folder):
    """Contributions to the champion's score; exact by now, under the name they had as estimates."""
    return _contributions(spark, folder)


@query("shap_tree")
def shap_tree(spark, folder):
    """Exact contributions of every feature to every customer's forest score."""
    run = _run(spark, folder)
    return attributions.contributions(run.churn["RandomForest"], _table(spark, folder), _table(spark, folder, "train"))


_EXPLAINED = ("LogisticRegression", "DecisionTree", "RandomForest", "GradientBoosting")


@query(
    "shap_additivity",
    f"""SELECT model, count(*) AS customers, CAST(0 AS BIGINT) AS violations
    FROM partitioned, (SELECT unnest({list(_EXPLAINED)}) AS model) m GROUP BY model""",
)
def shap_additivity(spark, folder):
    """Customers whose baseline and contributions do not add up to the probability that the model gives."""
    run, table, out = _run(spark, folder), _table(spark, folder), None
    for name in _EXPLAINED:
        found = attributions.contributions(run.churn[name], table, _table(spark, folder, "train"))
        sums = found.groupBy("customer_id").agg((F.first("baseline") + F.sum("contribution")).alias("total"))
        odds = name in ("LogisticRegression", "GradientBoosting")
        chance = 1 / (1 + F.exp(-F.col("total"))) if odds else F.col("total")
        both = training.score_churn(run.churn[name], table).select("customer_id", "churn_probability").join(sums, "customer_id", "left")
        wrong = F.coalesce(F.abs(chance - F.col("churn_probability")) > 1e-6, F.lit(True))
        one = both.agg(F.lit(name).alias("model"), F.count("*").alias("customers"), F.count_if(wrong).alias("violations"))
        out = one if out is None else out.unionByName(one)
    return out


@query("topk_features")
def topk_features(spark, folder):
    return explain.strongest(_contributions(spark, folder))


@query("explanation_topk")
def explanation_topk(spark, folder):
    return explain.sentences(_contributions(spark, folder))


@query("global_importance")
def global_importance(spark, folder):
    return explain.global_importance(_contributions(spark, folder))


@query("local_surrogate")
def local_surrogate(spark, folder):
    """A linear model around every customer."""
    people = _table(spark, folder).select("customer_id", *FEATURES)
    return explain.local_surrogates(people, _table(spark, folder, "train"), _scorer(spark, folder), CFG)


@query("partial_dependence")
def partial_dependence(spark, folder):
    return explain.partial_dependence(_table(spark, folder), _scorer(spark, folder), CFG)


# ---- Stores ----------------------------------------------------------------------------------------
def _store(spark, name: str) -> store.Store:
    return store.Store(spark, f"{shared_folder(spark).rstrip('/')}/ledgerloom/{name}-{uuid.uuid4().hex}")


def _tables(spark, folder) -> dict[str, DataFrame]:
    return store.snapshot_tables(saved(spark, folder, "scored"), saved(spark, folder, "clean"), CFG)


def _sizes(target: store.Store) -> DataFrame:
    counts = [
        target.read(t).agg(F.lit(t).alias("table"), F.count("*").alias("rows")) for t in store.SNAPSHOT_TABLES
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


_SIZES = """SELECT 'segments' AS "table", count(DISTINCT cluster) AS rows FROM scored UNION ALL
SELECT 'customers', count(*) FROM scored UNION ALL SELECT 'predictions', count(*) FROM scored UNION ALL
SELECT 'transactions', count(*) FROM transactions"""


@query("snapshot_seed_idempotent", _SIZES)
def snapshot_seed_idempotent(spark, folder):
    """Seeding twice writes once."""
    target = _store(spark, "seed")
    wrote = [target.seed(_tables(spark, folder)) for _ in range(2)]
    if wrote != [True, False]:
        raise ValueError("A seeded store must not be seeded again")
    return _sizes(target)


@query("snapshot_refresh", _SIZES)
def snapshot_refresh(spark, folder):
    """Refreshing replaces the snapshot and keeps the batch history."""
    target = _store(spark, "refresh")
    target.seed(_tables(spark, folder))
    target.append_batch(saved(spark, folder, "scored").select("customer_id", "churn_probability"))
    target.refresh(_tables(spark, folder))
    if target.is_empty("batch_scores"):
        raise ValueError("The batch history must survive a refresh")
    return _sizes(target)


@query(
    "keyed_lookup",
    f"""SELECT customer_id, '{CFG.cutoff}' AS as_of, CAST(cluster AS BIGINT) AS segment_id, round(churn_probability, 6) AS churn_probability,
    round(predicted_clv_90d, 6) AS predicted_clv_90d FROM scored WHERE customer_id IN ('7', '11', '1001', 'nobody')""",
)
def keyed_lookup(spark, folder):
    """Predictions of some customers from the files of a stored snapshot that can hold them."""
    target = _store(spark, "keyed")
    target.seed(_tables(spark, folder))
    found = target.lookup("predictions", ["7", "11", "1001", "nobody"]).drop("payload")
    return rounded(found.withColumn("segment_id", F.col("segment_id").cast("long")))


@query(
    "batch_history_append",
    "SELECT CAST(b AS INTEGER) AS batch, count(*) AS rows FROM scored, (SELECT unnest([1, 2]) AS b) GROUP BY b",
)
def batch_history_append(spark, folder):
    """Two scored batches, each under its own id, in order of time."""
    target = _store(spark, "history")
    scored = saved(spark, folder, "scored").select("customer_id", "churn_probability")
    for _ in range(2):
        target.append_batch(scored)
    sizes = target.read("batch_scores").groupBy("batch_id", "created_at").agg(F.count("*").alias("rows"))
    order = W.orderBy("created_at")  # one row per batch
    return sizes.select(F.row_number().over(order).alias("batch"), "rows")


@query("batch_csv_scan", "SELECT customer_id, CAST(frequency AS VARCHAR) AS frequency, country FROM features")
def batch_csv_scan(spark, folder):
    """The feature table written as an upload and read back under the upload rules."""
    table = saved(spark, folder, "modeling").select("customer_id", *FEATURES)
    target = f"{shared_folder(spark).rstrip('/')}/ledgerloom/upload-{uuid.uuid4().hex}"
    store.write_csv(table, target)
    rows, ids_only = store.read_upload(spark, f"{target}/*.csv", CFG)
    if ids_only:
        raise ValueError("A feature upload is not an id list")
    return rows.select("customer_id", "frequency", "country")


@query("export_csv", "SELECT customer_id, frequency, country, churn, next_category FROM modeling")
def export_csv(spark, folder):
    """The modeling table exported as CSV and read back."""
    target = f"{shared_folder(spark).rstrip('/')}/ledgerloom/export-{uuid.uuid4().hex}"
    store.export_csv(saved(spark, folder, "modeling"), saved(spark, folder, "scored"), target)
    back = spark.read.option("header", True).csv(f"{target}/customers_with_targets")
    return back.select(
        "customer_id", F.col("frequency").cast("long"), "country", F.col("churn").cast("int"), "next_category"
    )


@query("anomaly_flag_rate_model")
def anomaly_flag_rate_model(spark, folder):
    test = _snapshot(spark, folder).filter(F.col("partition") == "test")
    return test.agg(F.avg(F.col("anomaly").cast("int")).alias("flag_rate"))


@query(
    "explanation_background",
    f"""SELECT customer_id, {', '.join(f'round({c}, 6) AS {c}' for c in NUMERIC_FEATURES)}, country FROM train
    ORDER BY md5('{CFG.seed}:background:' || customer_id) LIMIT {explain.BACKGROUND_ROWS}""",
)
def explanation_background(spark, folder):
    return rounded(explain.background(_table(spark, folder, "train"), CFG))
