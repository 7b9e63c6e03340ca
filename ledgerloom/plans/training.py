"""Training, selection, scoring and the frozen test evaluation."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import FEATURES, EngineConfig
from ledgerloom.operators import anomaly, clustering, metrics, models, networks, segments, validation
from ledgerloom.sources.store import fingerprint

SCORE_COLUMNS = (
    "churn_probability",
    "predicted_clv_90d",
    "purchase_probability",
    "predicted_next_days",
    "predicted_category",
    "anomaly_score",
    "anomaly",
    "segment",
    "cluster",
    "value_tier",
    "partition",
    "priority",
)
CHURN_CANDIDATES = ("LogisticRegression", "DecisionTree", "RandomForest", "GradientBoosting", "WideGradientBoosting")
VALUE_CANDIDATES = ("Ridge", "ValueForest", "ValueBoosting")
NETWORK = "NeuralNetwork"


@dataclass
class FrozenRun:
    """Fitted models and thresholds. Test metrics can only be computed from one of these."""

    cfg: EngineConfig
    churn: dict[str, PipelineModel]
    thresholds: dict[str, float]
    champion: str
    value: dict[str, PipelineModel]
    value_champion: str
    timing: networks.NetworkModel
    timing_baseline: PipelineModel
    category: PipelineModel
    anomaly: anomaly.AnomalyNetwork
    segments: clustering.SegmentModel
    tiers: dict[str, float]
    digest: str
    network: networks.NetworkModel
    validation: dict[str, dict] = field(default_factory=dict)
    folds: dict[str, dict] = field(default_factory=dict)


def score_churn(model: PipelineModel | networks.NetworkModel, df: DataFrame) -> DataFrame:
    """``df`` with the probability of class one."""
    return model.transform(df).select(*df.columns, models.probability().alias("churn_probability"))


def score_value(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with expected spend, never below zero."""
    return model.transform(df).select(*df.columns, F.greatest("prediction", F.lit(0.0)).alias("predicted_clv_90d"))


def score_category(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the predicted next category; true categories are not looked at."""
    kept = df.withColumnRenamed("next_category", "true_category")
    scored = model.transform(kept.withColumn("next_category", F.lit("unknown")))
    own = [F.col("true_category").alias(c) if c == "next_category" else F.col(c) for c in df.columns]
    return scored.select(*own, "predicted_category")


def score_timing(model: networks.NetworkModel, df: DataFrame, sequences: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``df`` with the expected wait, between none and the horizon."""
    waiting = model.transform(df.select("customer_id").join(sequences, "customer_id"))
    clipped = F.least(F.greatest("predicted_next_days", F.lit(0.0)), F.lit(float(cfg.horizon_days)))
    return df.join(waiting.select("customer_id", clipped.alias("predicted_next_days")), "customer_id")


def _churn_quality(scored: DataFrame, threshold: float) -> dict:
    cut = F.lit(threshold)
    rates = metrics.classification_metrics(scored, "churn", "churn_probability", cut).first().asDict()
    rates["roc_auc"] = metrics.roc_auc(scored, "churn", "churn_probability").first().roc_auc
    return rates


def train_run(
    table: DataFrame,
    sequences: DataFrame,
    cfg: EngineConfig,
    churn_candidates: Sequence[str] = CHURN_CANDIDATES,
    value_candidates: Sequence[str] = VALUE_CANDIDATES,
    segment_model: clustering.SegmentModel | None = None,
    forest: models.Family | None = None,
    folds: dict[str, dict] | None = None,
    schedule: networks.Schedule = networks.Schedule(),
) -> FrozenRun:
    """Fit on train, choose on validation. ``table`` is a stored modeling table with its partition.

    The champion is the churn model with the best validation AUC, the network left out, and the value model with the
    best validation R2; the test partition is not read. ``forest`` is the winner of a grid search, ``folds`` the mean
    fold scores by model and metric, kept for the report.
    """
    train = table.filter(F.col("partition") == "train")
    held = table.filter(F.col("partition") == "validation")
    near, near_held = models.gathered(train), models.gathered(held)
    families, regressors = models.churn_families(cfg), models.value_families(cfg)
    if forest:
        families[forest.name] = forest
    fits: dict[tuple[str, str], Callable[[], object]] = {("churn", NETWORK): lambda: networks.fit_churn_network(train, held, cfg, schedule)}
    for name in churn_candidates:
        fits["churn", name] = lambda name=name: models.fit(families[name], near, near_held)
    for name in value_candidates:
        fits["value", name] = lambda name=name: models.fit(regressors[name], near)
    fits["other", "timing"] = lambda: networks.fit_timing_network(sequences, train, held, cfg, schedule)
    fits["other", "timing_baseline"] = lambda: models.fit(models.ridge("next_days", cfg), near)
    fits["other", "category"] = lambda: models.fit(models.category_family(cfg), near)
    fits["other", "anomaly"] = lambda: anomaly.fit_anomaly_network(train, held, cfg, schedule)
    fits["other", "segments"] = lambda: segment_model or clustering.fit_segments(train, cfg)
    # Fits are independent and made of many short jobs, so they run side by side.
    with ThreadPool(models.PARALLEL_FITS) as pool:
        fitted = dict(zip(fits, pool.map(lambda fit: fit(), fits.values(), chunksize=1)))
    churn = {name: fitted["churn", name] for name in (*churn_candidates, NETWORK)}
    value = {name: fitted["value", name] for name in value_candidates}
    thresholds, quality = {}, {}
    for name, model in churn.items():
        scored = score_churn(model, held)
        thresholds[name] = metrics.choose_threshold(scored, "churn", "churn_probability", cfg.recall_target).first().threshold
        quality[name] = _churn_quality(scored, thresholds[name])
    for name, model in value.items():
        quality[name] = metrics.regression_metrics(score_value(model, held), "clv_90d", "predicted_clv_90d").first().asDict()
    network = churn.pop(NETWORK)
    return FrozenRun(
        cfg=cfg,
        churn=churn,
        network=network,
        folds=folds or {},
        thresholds=thresholds,
        champion=max(churn, key=lambda n: quality[n]["roc_auc"]),
        value=value,
        value_champion=max(value, key=lambda n: quality[n]["r2"]),
        timing=fitted["other", "timing"],
        timing_baseline=fitted["other", "timing_baseline"],
        category=fitted["other", "category"],
        anomaly=fitted["other", "anomaly"],
        segments=fitted["other", "segments"],
        tiers=segments.fit_value_tiers(train),
        digest=fingerprint(table).first().digest,
        validation=quality,
    )


def score_snapshot(run: FrozenRun, table: DataFrame, sequences: DataFrame) -> DataFrame:
    """Every customer with all score columns."""
    waiting = score_timing(run.timing, table.select("customer_id"), sequences, run.cfg)
    scored = score_churn(run.churn[run.champion], table)
    scored = score_value(run.value[run.value_champion], scored)
    scored = anomaly.anomaly_scores(scored, run.anomaly)
    scored = clustering.assign_segments(scored, run.segments)
    scored = score_category(run.category, scored).join(waiting, "customer_id")
    scored = segments.value_tiers(scored, run.tiers)
    risk = F.col("churn_probability")
    return scored.withColumns(
        {"purchase_probability": 1 - risk, "priority": risk * F.col("predicted_clv_90d")}
    ).select(*table.columns, *[c for c in SCORE_COLUMNS if c not in table.columns])


def score_batch(run: FrozenRun, rows: DataFrame, cfg: EngineConfig | None = None) -> DataFrame:
    """Validated feature rows with churn, value, category and segment; outcomes in the input are ignored.

    ``cfg`` may lift the row limit of uploads: the work is one job either way.
    """
    table = validation.check_feature_rows(rows, cfg or run.cfg).select("customer_id", *FEATURES)
    scored = score_value(run.value[run.value_champion], score_churn(run.churn[run.champion], table))
    scored = clustering.assign_segments(score_category(run.category, scored), run.segments)
    risk = F.col("churn_probability")
    return scored.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        "churn_probability",
        (1 - risk).alias("purchase_probability"),
        "predicted_clv_90d",
        "predicted_category",
        "segment",
        (risk >= run.thresholds[run.champion]).alias("high_risk"),
    )


def evaluate_test(run: FrozenRun, table: DataFrame, sequences: DataFrame) -> DataFrame:
    """Fold, validation and test metrics of every model in the run, one row each."""
    test = table.filter(F.col("partition") == "test")
    rows = []
    for name, model in (*run.churn.items(), (NETWORK, run.network)):
        quality = _churn_quality(score_churn(model, test), run.thresholds[name])
        for metric in ("accuracy", "precision", "recall", "f1", "roc_auc"):
            rows.append((name, "test", metric, float(quality[metric])))
    errors = ("mae", "mse", "rmse", "r2")
    for name, model in run.value.items():
        quality = metrics.regression_metrics(score_value(model, test), "clv_90d", "predicted_clv_90d").first()
        rows.extend((name, "test", m, float(quality[m])) for m in errors)
    waiting = run.timing_baseline.transform(test)
    clipped = F.least(F.greatest("prediction", F.lit(0.0)), F.lit(float(run.cfg.horizon_days)))
    quality = metrics.regression_metrics(waiting.withColumn("clipped", clipped), "next_days", "clipped").first()
    rows.extend(("TimingRidge", "test", m, float(quality[m])) for m in errors)
    timed = score_timing(run.timing, test.select("customer_id", "next_days"), sequences, run.cfg)
    quality = metrics.regression_metrics(timed, "next_days", "predicted_next_days").first()
    rows.extend(("TimingNetwork", "test", m, float(quality[m])) for m in errors)
    quality = metrics.macro_f1(score_category(run.category, test), "next_category", "predicted_category").first()
    rows.extend(("CategoryForest", "test", m, float(quality[m])) for m in ("accuracy", "macro_f1"))
    flagged = anomaly.anomaly_scores(test, run.anomaly).agg(F.avg("anomaly_score").alias("score"), F.avg(F.col("anomaly").cast("int")).alias("rate")).first()
    rows.extend([("Autoencoder", "test", "reconstruction_error", float(flagged.score)), ("Autoencoder", "test", "flag_rate", float(flagged.rate))])
    for part, found in (("validation", run.validation), ("cross_validation", run.folds)):
        for name, quality in found.items():
            rows.extend((name, part, m, float(v)) for m, v in quality.items() if m in ("roc_auc", "f1", *errors, "neg_mae", "macro_f1"))
    return table.sparkSession.createDataFrame(rows, "model string, partition string, metric string, value double")


def held_out_diagnostics(run: FrozenRun, table: DataFrame, scored: DataFrame) -> dict[str, DataFrame]:
    """Errors of the saved test scores, after checking that they belong to this run and this split."""
    if fingerprint(table).first().digest != run.digest:
        raise ValueError("This table is not the one the run was trained on; train again or pass the original")
    test = table.filter(F.col("partition") == "test")
    saved = scored.select(
        "customer_id",
        "churn_probability",
        "predicted_clv_90d",
        "predicted_next_days",
        F.col("partition").alias("saved_partition"),
    )
    joined = metrics.check_one_to_one(test, saved, "customer_id")
    found = joined.agg(F.count("*").alias("n"), F.count_if(F.col("saved_partition") != "test").alias("w")).first()
    if found.n != test.count() or found.w:
        raise ValueError("Not every test customer has exactly one stored score from the test partition")
    threshold = F.lit(run.thresholds[run.champion])
    fresh = score_churn(run.churn[run.champion], test)
    cells = [
        metrics.confusion_matrix(f, "churn", "churn_probability", threshold).orderBy("actual", "predicted").collect()
        for f in (joined, fresh)
    ]
    if cells[0] != cells[1]:
        raise ValueError("Stored and fresh churn scores give different confusion counts")
    value = metrics.check_errors(metrics.error_rows(joined, "clv_90d", "predicted_clv_90d"))
    timing = metrics.check_errors(metrics.error_rows(joined, "next_days", "predicted_next_days"))
    columns = ["customer_id", "actual", "predicted", "error", "absolute_error", "squared_error"]
    return {
        "value": value.select(*columns),
        "timing": timing.select(*columns),
        "churn": metrics.churn_mistakes(joined, "churn", "churn_probability", threshold),
    }


def learning_curves(run: FrozenRun) -> list[tuple[str, int, str, float]]:
    """(model, iteration, loss, value) of every model that is trained step by step."""
    rows = []
    for name, model in ((NETWORK, run.network), ("TimingNetwork", run.timing), ("Autoencoder", run.anomaly.network)):
        for step in model.history:
            rows.extend((name, int(step["epoch"]), f"{part}_loss", float(step[f"{part}_loss"])) for part in ("train", "validation"))
    for name, model in run.churn.items():
        summary = getattr(model.stages[-1], "summary", None)
        if summary is not None:
            rows.extend((name, k, "objective", float(v)) for k, v in enumerate(summary.objectiveHistory))
    return rows


PIPELINES = ("churn", "value", "category", "timing_baseline")
RUN_VERSION = 1


def save_run(run: FrozenRun, folder: str) -> None:
    """Everything scoring needs under one folder; the manifest is written last, so a folder without one is no run."""
    spark = SparkSession.active()
    models_by_name = {"churn": run.churn[run.champion], "value": run.value[run.value_champion], "category": run.category, "timing_baseline": run.timing_baseline}
    for name, model in models_by_name.items():
        model.write().overwrite().save(f"{folder}/{name}")
    run.timing.save(f"{folder}/timing")
    run.network.save(f"{folder}/network")
    run.anomaly.network.save(f"{folder}/anomaly")
    clustering.save_segments(run.segments, f"{folder}/segments")
    facts = {
        "version": RUN_VERSION,
        "champion": run.champion,
        "thresholds": run.thresholds,
        "value_champion": run.value_champion,
        "tiers": run.tiers,
        "anomaly_threshold": run.anomaly.threshold,
        "digest": run.digest,
        "validation": run.validation,
        "folds": run.folds,
    }
    manifest = json.dumps(facts, sort_keys=True)
    check = hashlib.sha256(manifest.encode()).hexdigest()
    spark.createDataFrame([(manifest, check)], "manifest string, sha256 string").coalesce(1).write.mode("overwrite").json(f"{folder}/manifest")


def load_run(folder: str, cfg: EngineConfig) -> FrozenRun:
    """A saved run that scores like the one it was saved from. A damaged or unknown manifest is refused."""
    found = SparkSession.active().read.schema("manifest string, sha256 string").json(f"{folder}/manifest").first()
    if found is None or hashlib.sha256(found.manifest.encode()).hexdigest() != found.sha256:
        raise ValueError("The manifest of this run is missing or was changed")
    facts = json.loads(found.manifest)
    if facts["version"] != RUN_VERSION:
        raise ValueError(f"Runs of version {facts['version']} cannot be read")
    fitted = {name: load_model(folder, name) for name in PIPELINES}
    return FrozenRun(
        cfg=cfg,
        churn={facts["champion"]: fitted["churn"]},
        thresholds=facts["thresholds"],
        champion=facts["champion"],
        value={facts["value_champion"]: fitted["value"]},
        value_champion=facts["value_champion"],
        timing=networks.NetworkModel.load(f"{folder}/timing"),
        timing_baseline=fitted["timing_baseline"],
        category=fitted["category"],
        anomaly=anomaly.AnomalyNetwork(networks.NetworkModel.load(f"{folder}/anomaly"), facts["anomaly_threshold"]),
        segments=clustering.load_segments(f"{folder}/segments"),
        tiers=facts["tiers"],
        digest=facts["digest"],
        network=networks.NetworkModel.load(f"{folder}/network"),
        validation=facts["validation"],
        folds=facts["folds"],
    )


def load_model(folder: str, name: str) -> PipelineModel:
    """One saved pipeline."""
    return PipelineModel.load(f"{folder}/{name}")
