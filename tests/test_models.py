"""Model fits against closed forms, and properties of scores and explanations."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, NUMERIC_FEATURES, EngineConfig, ModelConfig
from ledgerloom.operators import anomaly, eda, explain, models, splits
from ledgerloom.operators.preprocessing import INPUTS
from ledgerloom.plans import training

CFG = replace(EngineConfig(), models=replace(ModelConfig(), forest_trees=5, boost_rounds=4, category_trees=5))
ROWS = 300


@pytest.fixture(scope="module")
def pdf():
    rng = np.random.default_rng(5)
    data = pd.DataFrame({c: np.round(rng.gamma(2.0, 3.0, ROWS), 4) for c in NUMERIC_FEATURES})
    data["frequency"] = rng.integers(1, 9, ROWS)
    data["affinity_other"] = 0.25
    data.insert(0, "customer_id", [f"{i:04d}" for i in range(ROWS)])
    data["country"] = rng.choice(["UK", "FR", "DE"], ROWS)
    risk = data["recency"] - data["monetary"] + rng.normal(0, 3, ROWS)
    data["churn"] = (risk > 0).astype("int32")
    data["clv_90d"] = 5 * data["monetary"] + rng.normal(0, 2, ROWS)
    data["next_days"] = np.clip(10 * data["recency"], 0, 90)
    data["next_category"] = rng.choice([*CATEGORIES, "no_purchase"], ROWS)
    return data


@pytest.fixture(scope="module")
def table(spark, pdf):
    df = spark.createDataFrame(pdf)
    split = splits.stratified_split(df, CFG).select("customer_id", "partition")
    return df.join(split, "customer_id").persist()


@pytest.fixture(scope="module")
def train(table):
    return table.filter("partition = 'train'")


def inputs(model, df):
    rows = model.transform(df).select(vector_to_array(INPUTS).alias("x")).collect()
    return np.array([r.x for r in rows])


def test_ridge_is_the_closed_form(table, train):
    fitted = models.fit(models.ridge("clv_90d", CFG), train)
    ordered = train.orderBy("customer_id")
    x = inputs(fitted, ordered)
    y = np.array([r.clv_90d for r in ordered.select("clv_90d").collect()])
    xc = x - x.mean(axis=0)
    beta = np.linalg.solve(xc.T @ xc + CFG.models.ridge_alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    assert fitted.stages[-1].coefficients.toArray() == pytest.approx(beta, rel=1e-6, abs=1e-6)


def test_scaling_is_population_scaling(train):
    fitted = models.fit(models.ridge("clv_90d", CFG), train)
    x = inputs(fitted, train)[:, : len(NUMERIC_FEATURES)]
    assert x.mean(axis=0) == pytest.approx(np.zeros(x.shape[1]), abs=1e-9)
    varied = [c != "affinity_other" for c in NUMERIC_FEATURES]
    assert x.std(axis=0)[varied] == pytest.approx(1.0)


def test_logistic_has_no_gradient_left(train):
    fitted = models.fit(models.churn_families(CFG)["LogisticRegression"], train)
    ordered = train.orderBy("customer_id")
    x = inputs(fitted, ordered)
    y = np.array([r.churn for r in ordered.select("churn").collect()])
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    model = fitted.stages[-1]
    w, b = model.coefficients.toArray(), model.intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = CFG.models.logistic_c * (x.T @ (weight * (p - y))) + w
    assert np.abs(gradient).max() < 0.05
    assert models.auc(fitted.transform(train)) > 0.85


def test_unseen_country_still_scores(train, table):
    fitted = models.fit(models.churn_families(CFG)["RandomForest"], train)
    scored = training.score_churn(fitted, table.withColumn("country", F.lit("Nowhere")))
    low, high = scored.agg(F.min("churn_probability"), F.max("churn_probability")).first()
    assert 0 <= low <= high <= 1


def test_saved_pipeline_scores_the_same(train, table, tmp_path):
    fitted = models.fit(models.churn_families(CFG)["DecisionTree"], train)
    fitted.write().overwrite().save(str(tmp_path / "churn"))
    again = training.load_model(str(tmp_path), "churn")
    pair = training.score_churn(fitted, table).select("customer_id", "churn_probability")
    assert pair.exceptAll(training.score_churn(again, table).select("customer_id", "churn_probability")).count() == 0


def test_boosting_stops_on_validation(train, table):
    family = models.boost_family(CFG, 2, 0.08)
    fitted = models.fit(family, train, table.filter("partition = 'validation'"))
    assert 1 <= fitted.stages[-1].getNumTrees <= CFG.models.boost_rounds


def test_grid_search_reports_every_fold(train, table):
    folds = splits.stratified_folds(table, CFG).select("customer_id", "fold")
    rows = train.join(folds, "customer_id").persist()
    grid = [({"depth": d}, models.forest_family(CFG, d, 3)) for d in (1, 4)]
    best, log = models.grid_search(grid, rows, CFG)
    assert log.count() == 2 * CFG.cv_folds and best in [f for _, f in grid]


def test_points_of_a_grid_share_the_preparation_of_a_fold(train, monkeypatch):
    folds = splits.stratified_folds(train, CFG).select("customer_id", "fold")
    joined = train.join(folds, "customer_id").persist()
    made, plain = [], models.preparation_stages
    monkeypatch.setattr(models, "preparation_stages", lambda *a: made.append(a) or plain(*a))
    _, log = models.grid_search(models.forest_grid(CFG), joined, CFG)
    assert len(made) == CFG.cv_folds
    assert log.count() == len(models.forest_grid(CFG)) * CFG.cv_folds


def test_fits_side_by_side_get_the_partitions_their_rows_need(train, monkeypatch):
    spread = train.repartition(7)
    assert models.gathered(spread).rdd.getNumPartitions() == 1
    monkeypatch.setattr(models, "FIT_ROWS", 100)
    assert models.gathered(spread).rdd.getNumPartitions() == -(-train.count() // 100)
    assert sorted(models.gathered(spread).collect()) == sorted(spread.collect())


def test_reconstruction_error(train, table):
    fitted = anomaly.fit_anomaly(train, table.filter("partition = 'validation'"), CFG)
    ordered = table.orderBy("customer_id")
    x = inputs(fitted.prepared, ordered)
    want = anomaly.reconstruction(x, fitted.projection.pc.toArray(), np.array(fitted.mean))
    scored = anomaly.anomaly_scores(table, fitted).orderBy("customer_id").collect()
    assert [r.anomaly_score for r in scored] == pytest.approx(want, rel=1e-6, abs=1e-9)
    held = np.array([r.anomaly_score for r in scored if r.partition == "validation"])
    assert fitted.threshold == pytest.approx(np.quantile(held, CFG.anomaly_quantile))
    assert all(r.anomaly == (r.anomaly_score > fitted.threshold) for r in scored)


def test_contributions_add_up(train, table):
    fitted = models.fit(models.churn_families(CFG)["RandomForest"], train)

    def score(df):
        return training.score_churn(fitted, df)

    base = explain.background(train, CFG)
    people = table.orderBy("customer_id").limit(12)
    found = explain.sampled_contributions(people, base, score, CFG, permutations=3)
    sums = {r.customer_id: r.s for r in found.groupBy("customer_id").agg(F.sum("contribution").alias("s")).collect()}
    start = score(base.orderBy(F.md5("customer_id")).limit(3)).agg(F.avg("churn_probability")).first()[0]
    for r in score(people).collect():
        assert sums[r.customer_id] == pytest.approx(r.churn_probability - start, abs=1e-9)
    top = explain.strongest(found)
    assert top.groupBy("customer_id").count().filter("count <> 10").count() == 0
    assert explain.sentences(found).filter("explanation LIKE '%risk%'").count() == 12


def test_surrogate_finds_a_linear_score(train, table):
    def score(df):
        return df.withColumn("churn_probability", 0.02 * F.col("recency") - 0.03 * F.col("monetary"))

    found = explain.local_surrogates(table.limit(2), train, score, CFG).collect()
    assert len(found) == 2 * explain.SURROGATE_FEATURES
    assert all(r.local_fit > 0.99 for r in found)
    signs = {(r.feature, r.contribution > 0) for r in found if r.feature in ("recency", "monetary")}
    assert signs == {("recency", True), ("monetary", False)}


def test_surrogate_is_the_weighted_ridge(spark):
    """Sums of products give the same coefficients and fit as the rows themselves."""
    rng = np.random.default_rng(12)
    names = list("abcdefghijk")
    z, weight = rng.normal(size=(400, len(names))), rng.random(400)
    y = z @ rng.normal(size=len(names)) + rng.normal(size=400)
    rows = np.column_stack([np.ones(400), z, y])
    features, beta, fit = explain.surrogate((rows * weight[:, None]).T @ rows, 400, names)
    mean, level = np.average(z, axis=0, weights=weight), np.average(y, weights=weight)
    every = np.linalg.solve((z - mean).T @ (weight[:, None] * (z - mean)) + np.eye(len(names)), (z - mean).T @ (weight * (y - level)))
    chosen = np.sort(np.argsort(-np.abs(every))[: explain.SURROGATE_FEATURES])
    part = (z - mean)[:, chosen]
    want = np.linalg.solve(part.T @ (weight[:, None] * part) + np.eye(len(chosen)), part.T @ (weight * (y - level)))
    left = (weight * (y - level - part @ want) ** 2).sum() / (weight * (y - level) ** 2).sum()
    assert features == [names[i] for i in chosen]
    assert beta == pytest.approx(want) and fit == pytest.approx(1 - left)


def test_surrogates_of_all_customers(train, table):
    def score(df):
        return df.withColumn("churn_probability", 0.02 * F.col("recency") + F.when(F.col("country") == "UK", 0.5).otherwise(0.0))

    found = explain.local_surrogates(table, train, score, CFG).collect()
    assert len(found) == ROWS * explain.SURROGATE_FEATURES
    home = {r.customer_id: r.country for r in table.select("customer_id", "country").collect()}
    stays = {r.customer_id: r.contribution for r in found if r.feature == "country"}
    assert len(stays) == ROWS and all((v > 0) == (home[c] == "UK") for c, v in stays.items())


def test_vif_matches_regression(spark, pdf):
    columns = ["recency", "frequency", "monetary", "mixed", "twin"]
    data = pdf[["recency", "frequency", "monetary"]].astype(float).assign(mixed=pdf.recency + pdf.tenure)
    data["twin"] = data["frequency"] * 2 + 1
    found = {r.feature: r.vif for r in eda.vif(spark.createDataFrame(data), columns).collect()}
    assert found["twin"] == found["frequency"] == float("inf")
    x = np.column_stack([np.ones(ROWS), data[["frequency", "monetary", "mixed"]]])
    y = data["recency"].to_numpy()
    residual = y - x @ np.linalg.lstsq(x, y, rcond=None)[0]
    assert found["recency"] == pytest.approx(((y - y.mean()) ** 2).sum() / (residual**2).sum(), rel=1e-6)
