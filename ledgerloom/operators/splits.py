"""Frozen stratified partitions, folds and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import EngineConfig
from ledgerloom.functions.columns import half_up, share
from ledgerloom.functions.ordering import ordered_rank

PARTITIONS = ("train", "validation", "test")


def _shuffle_key(seed: int, purpose: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"), F.col("customer_id")))


def stratified_split(customers: DataFrame, cfg: EngineConfig, stratum: str = "churn") -> DataFrame:
    """``customer_id``, stratum and ``partition``; the same ids always land in the same partition."""
    keyed = customers.select("customer_id", stratum).withColumn("_key", _shuffle_key(cfg.seed, "split"))
    ranked = ordered_rank(keyed, stratum, "_key")
    test = half_up(F.col("stratum_size") * cfg.test_fraction)
    validation = half_up(F.col("stratum_size") * cfg.validation_fraction)
    partition = (
        F.when(F.col("rank") <= test, "test")
        .when(F.col("rank") <= test + validation, "validation")
        .otherwise("train")
    )
    return ranked.select("customer_id", stratum, partition.alias("partition"))


def stratified_folds(split: DataFrame, cfg: EngineConfig, stratum: str = "churn") -> DataFrame:
    """``customer_id`` and ``fold`` for the train partition only; every task reuses these folds."""
    train = split.filter(F.col("partition") == "train").select("customer_id", stratum)
    ranked = ordered_rank(train.withColumn("_key", _shuffle_key(cfg.seed, "fold")), stratum, "_key")
    fold = ((F.col("rank") - 1) % cfg.cv_folds).cast("int")
    return ranked.select("customer_id", stratum, fold.alias("fold"))


def class_weights(labels: DataFrame, label: str) -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class)."""
    counts = labels.groupBy(label).agg(F.count("*").alias("rows"))
    whole = counts.agg(F.struct(F.sum("rows").alias("rows"), F.count("*").alias("classes")).alias("w")).scalar()
    weighted = counts.withColumn("whole", whole)
    weight = share(F.col("whole.rows"), F.col("whole.classes") * F.col("rows"))
    return weighted.select(label, "rows", weight.alias("weight"))


def partition_coverage(customers: DataFrame, split: DataFrame) -> DataFrame:
    """One row: sizes, and how many customers are not in exactly one partition."""
    sides = customers.select("customer_id", F.lit(1).alias("known"), F.lit(0).alias("placed")).unionByName(
        split.select("customer_id", F.lit(0).alias("known"), F.lit(1).alias("placed"))
    )
    per_customer = sides.groupBy("customer_id").agg(F.sum("known").alias("known"), F.sum("placed").alias("placed"))
    return per_customer.agg(
        F.sum("known").alias("customers"),
        F.sum("placed").alias("placements"),
        F.count_if((F.col("known") != 1) | (F.col("placed") != 1)).alias("violations"),
    )
