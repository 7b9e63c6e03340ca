"""Reconstruction error over the scaled model inputs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import EngineConfig
from ledgerloom.functions.ordering import fit_quantiles
from ledgerloom.operators.networks import NetworkModel, Schedule, fit_autoencoder
from ledgerloom.operators.preprocessing import INPUTS, preparation_stages


@dataclass(frozen=True)
class AnomalyModel:
    """Preparation, projection, centre and the frozen threshold."""

    prepared: PipelineModel
    projection: object
    mean: list[float]
    projected_mean: list[float]
    threshold: float | None = None


def fit_anomaly(train: DataFrame, validation: DataFrame, cfg: EngineConfig) -> AnomalyModel:
    """A linear bottleneck fitted on train; the threshold is a validation quantile.

    The principal components are the best linear autoencoder of that width.
    """
    prepared = Pipeline(stages=preparation_stages(train, scaled=True)).fit(train)
    inputs = prepared.transform(train)
    projection = PCA(k=cfg.models.bottleneck, inputCol=INPUTS, outputCol="bottleneck").fit(inputs)
    mean = inputs.agg(Summarizer.mean(F.col(INPUTS)).alias("m")).first().m.toArray()
    projected = projection.pc.toArray().T @ mean
    model = AnomalyModel(prepared, projection, mean.tolist(), projected.tolist())
    scored = anomaly_scores(validation, model)
    limit = fit_quantiles(scored, {"t": ("anomaly_score", cfg.anomaly_quantile)})["t"]
    return AnomalyModel(prepared, projection, mean.tolist(), projected.tolist(), limit)


@dataclass(frozen=True)
class AnomalyNetwork:
    """An autoencoder and the frozen threshold of its reconstruction error."""

    network: NetworkModel
    threshold: float | None = None


def fit_anomaly_network(train: DataFrame, validation: DataFrame, cfg: EngineConfig, schedule: Schedule = Schedule()) -> AnomalyNetwork:
    """A non-linear bottleneck learned from train; the threshold is a validation quantile of its error."""
    network = fit_autoencoder(train, validation, cfg, schedule)
    scored = network.transform(validation).select("anomaly_score")
    return AnomalyNetwork(network, fit_quantiles(scored, {"t": ("anomaly_score", cfg.anomaly_quantile)})["t"])


def anomaly_scores(customers: DataFrame, model: AnomalyModel | AnomalyNetwork) -> DataFrame:
    """Mean squared reconstruction error, and the flag once a threshold is known.

    Components are orthonormal: the error is the centred length minus the length inside the bottleneck.
    """
    if isinstance(model, AnomalyNetwork):
        scored = model.network.transform(customers)
        return scored if model.threshold is None else scored.withColumn("anomaly", F.col("anomaly_score") > model.threshold)
    placed = model.projection.transform(model.prepared.transform(customers))

    def squared(column: str, centre: list[float]):
        middle = F.array(*[F.lit(float(v)) for v in centre])
        moved = F.zip_with(vector_to_array(column), middle, lambda x, m: (x - m) * (x - m))
        return F.aggregate(moved, F.lit(0.0), lambda acc, v: acc + v)

    error = (squared(INPUTS, model.mean) - squared("bottleneck", model.projected_mean)) / len(model.mean)
    scored = customers.columns
    out = placed.select(*scored, F.greatest(error, F.lit(0.0)).alias("anomaly_score"))
    if model.threshold is None:
        return out
    return out.withColumn("anomaly", F.col("anomaly_score") > model.threshold)


def reconstruction(values: np.ndarray, components: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """The same error in NumPy, for checking small samples."""
    centred = values - mean
    return ((centred - centred @ components @ components.T) ** 2).mean(axis=1)
