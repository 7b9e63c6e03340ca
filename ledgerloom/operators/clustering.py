"""Choosing and fitting customer clusters on the scaled segmentation inputs.

All starts of all cluster numbers are improved together: an iteration is one pass over the rows, in which every task compares
its rows with the stacked centres of all runs and returns sums for each centre, so the number of passes does not follow the
number of runs, and what reaches the driver is one block of sums a task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import SEGMENT_COLUMNS, EngineConfig
from ledgerloom.operators import segments
from ledgerloom.session import materialize

POINT = "point"
Z_COLUMNS = [f"z_{c}" for c in SEGMENT_COLUMNS]
#: Rows, in hash order, from which first centres are drawn.
SEED_ROWS = 2000
ITERATIONS, MOVE = 40, 1e-4


@dataclass(frozen=True)
class Centres:
    """Fitted cluster centres and the sum of squared distances to them."""

    centres: np.ndarray
    cost: float

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with the number of the nearest centre, the first of equals."""
        far = [reduce(lambda a, b: a + b, [(F.col(c) - float(v)) * (F.col(c) - float(v)) for c, v in zip(Z_COLUMNS, centre)]) for centre in self.centres]
        distances = F.array(*far)
        return df.withColumn("cluster", (F.array_position(distances, F.array_min(distances)) - 1).cast("int"))


@dataclass(frozen=True)
class SegmentModel:
    """Everything needed to place a customer in a named segment."""

    scaling: dict[str, tuple[float, float]]
    kmeans: Centres
    mixture: object
    names: dict[int, str]
    quality: list[dict]


def as_points(customers: DataFrame, scaling: dict[str, tuple[float, float]]) -> DataFrame:
    """Scaled inputs and the vector built from them."""
    inputs = segments.segment_inputs(customers, scaling)
    return VectorAssembler(inputCols=Z_COLUMNS, outputCol=POINT).transform(inputs)


def spread_starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """First centres: each further one is drawn in proportion to its squared distance from those before."""
    draw = np.random.default_rng(seed)
    picked = [sample[draw.integers(len(sample))]]
    for _ in range(k - 1):
        near = np.min([((sample - c) ** 2).sum(1) for c in picked], axis=0)
        picked.append(sample[draw.choice(len(sample), p=near / near.sum())] if near.sum() > 0 else picked[0])
    return np.array(picked)


def improve(points: DataFrame, starts: Sequence[np.ndarray], iterations: int = ITERATIONS) -> list[Centres]:
    """Lloyd iterations of all given runs at once, each until its centres move by less than ``MOVE``.

    A centre without rows stays where it is. One job an iteration, and one for the final costs.
    """
    runs, moving = [np.array(s, float) for s in starts], [True] * len(starts)
    costs = np.zeros(len(runs))
    for turn in range(iterations + 1):
        stacked = np.concatenate(runs)
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in runs])])

        def scan(batches: Iterator[pa.RecordBatch], stacked=stacked, bounds=bounds) -> Iterator[pa.RecordBatch]:
            sums, count, cost = np.zeros(stacked.shape), np.zeros(len(stacked)), np.zeros(len(bounds) - 1)
            length = (stacked**2).sum(1)
            for batch in batches:
                x = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in Z_COLUMNS], 1)
                if not len(x):
                    continue
                far = (x**2).sum(1)[:, None] - 2 * x @ stacked.T + length
                for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
                    near = far[:, a:b].argmin(1)
                    cost[r] += np.maximum(far[np.arange(len(x)), a + near], 0).sum()
                    count[a:b] += np.bincount(near, minlength=b - a)
                    for d in range(x.shape[1]):
                        sums[a:b, d] += np.bincount(near, x[:, d], b - a)
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()]) for v in (sums, count, cost)], ["sums", "count", "cost"])

        got = points.select(*Z_COLUMNS).mapInArrow(scan, "sums binary, count binary, cost binary").collect()
        sums = sum(np.frombuffer(bytes(g["sums"])).reshape(stacked.shape) for g in got)
        count = sum(np.frombuffer(bytes(g["count"])) for g in got)
        costs = sum(np.frombuffer(bytes(g["cost"])) for g in got)
        if turn == iterations or not any(moving):
            break
        for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
            if moving[r]:
                held = count[a:b, None] > 0
                new = np.where(held, sums[a:b] / np.maximum(count[a:b, None], 1), runs[r])
                moving[r] = bool((((new - runs[r]) ** 2).sum(1) > MOVE**2).any())
                runs[r] = new
    return [Centres(run, float(cost)) for run, cost in zip(runs, costs)]


def best_of_starts(points: DataFrame, ks: Sequence[int], cfg: EngineConfig) -> dict[int, Centres]:
    """For each k the cheapest of its seeded starts; the first one on a tie."""
    key = F.md5(F.concat(F.lit(f"{cfg.seed}:starts:"), F.col("customer_id").cast("string")))
    sample = np.array([list(r) for r in points.orderBy(key).limit(SEED_ROWS).select(*Z_COLUMNS).collect()], float)
    runs = [(k, i) for k in ks for i in range(cfg.models.cluster_starts)]
    fitted = improve(points, [spread_starts(sample, k, cfg.seed + i) for k, i in runs])
    best: dict[int, Centres] = {}
    for (k, _), found in zip(runs, fitted):
        if k not in best or found.cost < best[k].cost:
            best[k] = found
    return best


def best_mixture(points: DataFrame, k: int, cfg: EngineConfig):
    """The most likely of several seeded mixtures."""
    starts = [
        GaussianMixture(featuresCol=POINT, predictionCol="cluster", probabilityCol="share", k=k, seed=cfg.seed + i)
        for i in range(cfg.models.mixture_starts)
    ]
    return max((m.fit(points) for m in starts), key=lambda m: m.summary.logLikelihood)


def _quality(name: str, k: int, labelled: DataFrame, inertia: float | None) -> dict:
    silhouette = segments.silhouette_all(labelled, Z_COLUMNS, "cluster").first().silhouette
    scatter = segments.davies_bouldin(labelled, Z_COLUMNS, "cluster").first().davies_bouldin
    return {"model": name, "k": k, "inertia": inertia, "silhouette": silhouette, "davies_bouldin": scatter}


def fit_segments(train: DataFrame, cfg: EngineConfig) -> SegmentModel:
    """Try every k, keep the best silhouette (the smaller k on a tie), compare a mixture at that k."""
    scaling = segments.fit_scaling(segments.log_columns(train), [f"log_{c}" for c in SEGMENT_COLUMNS])
    points = materialize(as_points(train, scaling).select("customer_id", *SEGMENT_COLUMNS, *Z_COLUMNS, POINT), "points")
    fitted = best_of_starts(points, cfg.cluster_k, cfg)
    # Independent jobs over one small table, side by side.
    with ThreadPool(len(cfg.cluster_k)) as pool:
        quality = pool.map(lambda k: _quality("KMeans", k, fitted[k].transform(points), fitted[k].cost), cfg.cluster_k)
    chosen = max(quality, key=lambda q: q["silhouette"])["k"]
    mixture = best_mixture(points, chosen, cfg)
    quality.append(_quality("GaussianMixture", chosen, mixture.transform(points), None))
    named = segments.segment_names(fitted[chosen].transform(points)).collect()
    return SegmentModel(scaling, fitted[chosen], mixture, {r.cluster: r.segment for r in named}, quality)


def save_segments(model: SegmentModel, folder: str) -> None:
    """Centres, scaling and names as one JSON row, the mixture as a Spark ML artifact."""
    model.mixture.write().overwrite().save(f"{folder}/mixture")
    facts = {
        "scaling": model.scaling,
        "centres": model.kmeans.centres.tolist(),
        "cost": model.kmeans.cost,
        "names": {str(k): v for k, v in model.names.items()},
        "quality": model.quality,
    }
    SparkSession.active().createDataFrame([(json.dumps(facts),)], "facts string").coalesce(1).write.mode("overwrite").text(f"{folder}/facts")


def load_segments(folder: str) -> SegmentModel:
    facts = json.loads(SparkSession.active().read.text(f"{folder}/facts").first().value)
    return SegmentModel(
        {c: tuple(v) for c, v in facts["scaling"].items()},
        Centres(np.array(facts["centres"]), facts["cost"]),
        GaussianMixtureModel.load(f"{folder}/mixture"),
        {int(k): v for k, v in facts["names"].items()},
        facts["quality"],
    )


def assign_segments(customers: DataFrame, model: SegmentModel) -> DataFrame:
    """``cluster``, ``segment`` and ``gmm_cluster`` for every customer."""
    points = as_points(customers, model.scaling)
    placed = model.kmeans.transform(points)
    mixed = model.mixture.copy().setPredictionCol("gmm_cluster").transform(placed)
    name = F.lit(None).cast("string")
    for cluster, words in model.names.items():
        name = F.when(F.col("cluster") == cluster, F.lit(words)).otherwise(name)
    return mixed.withColumn("segment", name).drop(*Z_COLUMNS, POINT, "share")


def quality_table(model: SegmentModel, train: DataFrame) -> DataFrame:
    """Model, k, inertia, silhouette and Davies-Bouldin."""
    return train.sparkSession.createDataFrame(
        [tuple(q[c] for c in ("model", "k", "inertia", "silhouette", "davies_bouldin")) for q in model.quality],
        "model string, k int, inertia double, silhouette double, davies_bouldin double",
    )
