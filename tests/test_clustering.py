"""Clusters: all runs at once against plain Lloyd iterations, costs against Spark's own, saving."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerloom.config import SEGMENT_COLUMNS, EngineConfig
from ledgerloom.operators import clustering
from ledgerloom.operators.clustering import Z_COLUMNS


@pytest.fixture(scope="module")
def cloud():
    draw = np.random.default_rng(4)
    middles = draw.normal(0, 4, (4, len(Z_COLUMNS)))
    return np.concatenate([m + draw.normal(size=(150, len(Z_COLUMNS))) for m in middles])


@pytest.fixture(scope="module")
def points(spark, cloud):
    rows = [(f"{k:05d}", *map(float, x)) for k, x in enumerate(cloud)]
    return spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{c} double" for c in Z_COLUMNS)).repartition(5).persist()


def lloyd(x, centres, turns=clustering.ITERATIONS):
    centres = centres.copy()
    for _ in range(turns):
        near = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
        new = np.array([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
        still = (((new - centres) ** 2).sum(1) <= clustering.MOVE**2).all()
        centres = new
        if still:
            break
    return centres, ((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum()


def test_all_runs_at_once_are_plain_iterations(points, cloud):
    starts = [clustering.spread_starts(cloud, k, 7 + k) for k in (1, 2, 3, 5)] + [np.vstack([cloud[:2], np.full((1, 5), 99.0)])]
    for got, start in zip(clustering.improve(points, starts), starts):
        centres, cost = lloyd(cloud, start)
        assert got.centres == pytest.approx(centres) and got.cost == pytest.approx(cost)
    assert (got.centres[2] == 99.0).all()  # no row is near it


def test_best_start_is_as_good_as_sparks(points):
    cfg = replace(EngineConfig(), models=replace(EngineConfig().models, cluster_starts=8))
    best = clustering.best_of_starts(points, (2, 4), cfg)
    vectors = VectorAssembler(inputCols=Z_COLUMNS, outputCol="v").transform(points)
    for k, found in best.items():
        theirs = min(KMeans(featuresCol="v", k=k, seed=s, maxIter=40).fit(vectors).summary.trainingCost for s in range(3))
        assert found.cost <= theirs * 1.001
        placed = found.transform(points)
        assert placed.select("cluster").distinct().count() == k
        squares = sum(((F.col(c) - F.element_at(F.array(*[F.lit(float(v[d])) for v in found.centres]), F.col("cluster") + 1)) ** 2 for d, c in enumerate(Z_COLUMNS)), F.lit(0.0))
        assert placed.agg(F.sum(squares)).first()[0] == pytest.approx(found.cost)


def test_equal_rows_and_few_rows(spark):
    same = spark.createDataFrame([(str(k), *[1.0] * 5) for k in range(6)], "customer_id string, " + ", ".join(f"{c} double" for c in Z_COLUMNS))
    found = clustering.best_of_starts(same, (2, 3), EngineConfig())
    assert found[2].cost == found[3].cost == 0.0 and found[3].transform(same).select("cluster").distinct().count() == 1


def test_saved_segments_place_customers_alike(spark, tmp_path):
    draw = np.random.default_rng(6)
    rows = [(f"{k:04d}", *map(float, draw.gamma(2, 3, len(SEGMENT_COLUMNS)))) for k in range(240)]
    people = spark.createDataFrame(rows, "customer_id string, " + ", ".join(f"{c} double" for c in SEGMENT_COLUMNS))
    extra = [c for c in ("frequency", "recency", "historical_clv", "monetary", "return_rate", "tenure") if c not in SEGMENT_COLUMNS]
    people = people.withColumns({c: F.lit(1.0) for c in extra})
    cfg = replace(EngineConfig(), cluster_k=(2, 3), models=replace(EngineConfig().models, cluster_starts=3, mixture_starts=1))
    model = clustering.fit_segments(people, cfg)
    clustering.save_segments(model, str(tmp_path / "segments"))
    again = clustering.load_segments(str(tmp_path / "segments"))
    columns = ["customer_id", "cluster", "segment", "gmm_cluster"]
    first, second = (clustering.assign_segments(people, m).select(*columns) for m in (model, again))
    assert first.exceptAll(second).count() == 0 and first.count() == 240 and again.quality == model.quality
