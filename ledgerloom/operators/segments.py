"""Customer segments: inputs, quality measures, profiles and names."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import SEGMENT_COLUMNS, EngineConfig
from ledgerloom.functions.ordering import exact_quantiles, fit_quantiles

LAPSED_AFTER_DAYS = 90


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column of the train rows; a constant column is divided by one."""
    row = train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}_std") for c in columns]
    ).first()
    return {c: (row[f"{c}_mean"], row[f"{c}_std"] or 1.0) for c in columns}


def standardize(df: DataFrame, scaling: dict[str, tuple[float, float]], prefix: str = "z_") -> DataFrame:
    """z-scores with fitted parameters."""
    return df.withColumns({f"{prefix}{c}": (F.col(c) - mean) / std for c, (mean, std) in scaling.items()})


def log_columns(customers: DataFrame) -> DataFrame:
    """``log_`` columns of the five segmentation features."""
    return customers.withColumns({f"log_{c}": F.log1p(F.col(c)) for c in SEGMENT_COLUMNS})


def segment_inputs(customers: DataFrame, scaling: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """``z_`` columns of log1p recency, frequency, money, returns and seasonality, scaled on train."""
    logged = log_columns(customers)
    names = [f"log_{c}" for c in SEGMENT_COLUMNS]
    if scaling is None:
        scaling = fit_scaling(logged.filter(F.col("partition") == "train"), names)
    scaled = standardize(logged, scaling)
    return scaled.withColumnsRenamed({f"z_log_{c}": f"z_{c}" for c in SEGMENT_COLUMNS}).drop(*names)


def silhouette_all(points: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Mean silhouette of all rows under squared Euclidean distances, in time linear in the rows.

    The mean squared distance of a row to a cluster follows from the cluster's size, means and mean square, so
    only one row for each cluster is compared with every customer.
    """
    rows = points.select(F.col(cluster).cast("int").alias("cluster"), *columns)
    square = reduce(lambda a, b: a + b, [F.col(c) * F.col(c) for c in columns])
    facts = rows.groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(c).alias(c) for c in columns], F.avg(square).alias("square"))
    listed = facts.agg(F.collect_list(F.struct("cluster", "n", *columns, "square")).alias("clusters"))

    def reach(s):
        product = reduce(lambda a, b: a + b, [F.col(c) * s[c] for c in columns])
        return F.greatest(square - 2 * product + s["square"], F.lit(0.0))

    # One row that lists the clusters.
    placed = rows.crossJoin(F.broadcast(listed)).withColumn(
        "reach", F.transform("clusters", lambda s: F.struct(s["cluster"].alias("cluster"), s["n"].alias("n"), reach(s).alias("d")))
    )
    own = F.get(F.filter("reach", lambda s: s["cluster"] == F.col("cluster")), F.lit(0))
    inside = own["d"] * own["n"] / F.nullif(own["n"] - 1, F.lit(0))
    nearest = F.array_min(F.transform(F.filter("reach", lambda s: s["cluster"] != F.col("cluster")), lambda s: s["d"]))
    width = F.when((own["n"] > 1) & (F.greatest(inside, nearest) > 0), (nearest - inside) / F.greatest(inside, nearest)).otherwise(0.0)
    return placed.agg(F.avg(width).alias("silhouette"), F.count("*").alias("rows"))


def silhouette(points: DataFrame, columns: Sequence[str], cluster: str, cfg: EngineConfig) -> DataFrame:
    """Mean Euclidean silhouette over a hash-ordered sample of ``cfg.silhouette_sample`` customers.

    The sample is the operator's definition: it bounds the comparison set at a few hundred kilobytes, which
    travels to the tasks. Tasks compare their share of the sample with it in NumPy blocks.
    """
    order = F.md5(F.concat(F.lit(f"{cfg.seed}:silhouette:"), F.col("customer_id")))
    sample = (
        points.select("customer_id", F.col(cluster).cast("int").alias("cluster"), *columns)
        .orderBy(order)
        .limit(cfg.silhouette_sample)
    )
    pdf = sample.toPandas()
    coords, labels = pdf[list(columns)].to_numpy(float), pdf["cluster"].to_numpy()
    values, sizes = np.unique(labels, return_counts=True)

    def widths(batches):
        for part in batches:
            own = np.searchsorted(values, part["cluster"].to_numpy())
            gaps = np.sqrt(((part[list(columns)].to_numpy(float)[:, None, :] - coords[None]) ** 2).sum(axis=2))
            sums = np.stack([gaps[:, labels == v].sum(axis=1) for v in values], axis=1)
            row = np.arange(len(part))
            others = np.where(np.arange(len(values)) == own[:, None], np.inf, sums / sizes)
            mates = sizes[own] - 1
            inside = sums[row, own] / np.maximum(mates, 1)
            nearest = others.min(axis=1)
            larger = np.maximum(nearest, inside)
            width = np.divide(nearest - inside, larger, out=np.zeros_like(larger), where=larger > 0)
            yield pd.DataFrame({"width": np.where(mates > 0, width, 0.0)})

    spark = points.sparkSession
    shares = max(1, min(len(pdf) // 100, 64))
    spread = spark.createDataFrame(pdf).repartition(shares)
    return spread.mapInPandas(widths, "width double").agg(
        F.avg("width").alias("silhouette"), F.count("*").alias("sampled")
    )


def davies_bouldin(points: DataFrame, columns: Sequence[str], cluster: str) -> DataFrame:
    """Mean over clusters of the worst (scatter + scatter) / centroid distance.

    Two aggregations over the points; what is compared is one row per cluster.
    """
    centroids = points.groupBy(cluster).agg(*[F.avg(c).alias(f"c_{c}") for c in columns])
    # One row per cluster (k is at most six).
    placed = points.select(cluster, *columns).join(F.broadcast(centroids), cluster)
    distance = F.sqrt(sum(((F.col(c) - F.col(f"c_{c}")) ** 2 for c in columns), F.lit(0.0)))
    center = F.array(*[F.first(f"c_{c}") for c in columns]).alias("center")
    scatter = placed.withColumn("d", distance).groupBy(cluster).agg(F.avg("d").alias("scatter"), center)
    table = scatter.agg(F.collect_list(F.struct(F.col(cluster).alias("id"), "scatter", "center")).alias("all"))

    def apart(a: Column, b: Column) -> Column:
        squares = F.zip_with(a["center"], b["center"], lambda x, y: (x - y) * (x - y))
        return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, s: acc + s))

    def worst(a: Column) -> Column:
        rivals = F.filter("all", lambda b: b["id"] != a["id"])
        return F.array_max(F.transform(rivals, lambda b: (a["scatter"] + b["scatter"]) / apart(a, b)))

    ratios = F.transform("all", worst)
    return table.select(
        (F.aggregate(ratios, F.lit(0.0), lambda acc, r: acc + r) / F.size("all")).alias("davies_bouldin"),
        F.size("all").alias("clusters"),
    )


def segment_profiles(train: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Median of every segment column per cluster."""
    long = exact_quantiles(train, SEGMENT_COLUMNS, [0.5], by=[cluster])
    return long.groupBy(cluster).agg(
        *[F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in SEGMENT_COLUMNS]
    )


def segment_names(train: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster`` and its readable name."""
    median = fit_quantiles(train, {"monetary": ("monetary", 0.5)})["monetary"]
    profiles = segment_profiles(train, cluster)
    activity = F.when(F.col("recency") > LAPSED_AFTER_DAYS, "Lapsed").otherwise("Active")
    value = F.when(F.col("monetary") >= median, "high value").otherwise("low value")
    number = (F.col(cluster) + 1).cast("string")
    return profiles.select(cluster, F.concat(activity, F.lit(", "), value, F.lit(" · "), number).alias("segment"))


def fit_value_tiers(train: DataFrame) -> dict[str, float]:
    """The train rows' .8 and .5 quantiles of monetary."""
    return fit_quantiles(train, {"high": ("monetary", 0.8), "medium": ("monetary", 0.5)})


def value_tiers(customers: DataFrame, cuts: dict[str, float]) -> DataFrame:
    """High, Medium or Low by fitted cut points."""
    tier = (
        F.when(F.col("monetary") >= cuts["high"], "High")
        .when(F.col("monetary") >= cuts["medium"], "Medium")
        .otherwise("Low")
    )
    return customers.withColumn("value_tier", tier)
