"""From raw ledger to modeling table and to a snapshot scored by fixed rules.

The rule scores stand where model scores stand in a trained snapshot. Being plain expressions over the
features, they let every serving and evaluation query be checked against SQL exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, NO_PURCHASE, EngineConfig
from ledgerloom.functions.ordering import fit_quantiles
from ledgerloom.operators import cleaning, features, labels, segments, serving, splits
from ledgerloom.session import materialize
from ledgerloom.sources.tables import TABLE_CONFIG, raw_ledger


class Ledger:
    """The frames of one ledger, built lazily from each other."""

    def __init__(self, clean: DataFrame, cfg: EngineConfig) -> None:
        self.clean = clean
        self.cfg = cfg

    @classmethod
    def of_tables(cls, spark: SparkSession, folder: str) -> Ledger:
        """The ledger view of the given tables."""
        return cls(cleaning.clean_ledger(raw_ledger(spark, folder), TABLE_CONFIG), TABLE_CONFIG)

    def features(self) -> DataFrame:
        """Customer features."""
        return features.customer_features(self.clean, self.cfg)

    def modeling(self) -> DataFrame:
        """Features joined with labels; the features are stored, as the labels read them too."""
        table = materialize(self.features(), "features")
        return labels.modeling_table(table, labels.customer_targets(self.clean, table, self.cfg))


def prepare(raw: DataFrame, cfg: EngineConfig) -> Ledger:
    """Validated ledger whose clean lines are stored before anything reads them again."""
    clean = cleaning.clean_ledger(cleaning.check_ledger(raw, cfg), cfg)
    return Ledger(labels.check_window(materialize(clean, "clean"), cfg), cfg)


def with_partition(modeling: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The modeling table with its frozen partition."""
    split = splits.stratified_split(modeling, cfg).select("customer_id", "partition")
    return modeling.join(split, "customer_id")


def rule_scores(partitioned: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Every column of a scored snapshot from fixed rules; expects a stored, partitioned table."""
    train = partitioned.filter(F.col("partition") == "train")
    cuts = segments.fit_value_tiers(train)
    strongest = F.greatest(*[F.col("affinity_" + c) for c in CATEGORIES])
    category = reduce(
        lambda chain, c: chain.when(F.col("affinity_" + c) == strongest, F.lit(c)),
        CATEGORIES,
        F.when(strongest == 0, F.lit(NO_PURCHASE)),
    )
    cluster = (F.col("recency") > 90).cast("int") + 2 * (F.col("monetary") >= cuts["medium"]).cast("int")
    scored = partitioned.withColumns(
        {
            "churn_probability": F.round(1 - F.col("engagement") / 100, 6),
            "predicted_clv_90d": F.col("spend_90d"),
            "predicted_next_days": F.least("recency", F.lit(float(cfg.horizon_days))),
            "predicted_category": category,
            "anomaly_score": F.round("gap_variance", 6),
            "cluster": cluster,
        }
    )
    validation = scored.filter(F.col("partition") == "validation")
    limit = fit_quantiles(validation, {"score": ("anomaly_score", cfg.anomaly_quantile)})["score"]
    names = segments.segment_names(scored.filter(F.col("partition") == "train"))
    flagged = scored.withColumns(
        {
            "anomaly": F.col("anomaly_score") > limit,
            "purchase_probability": F.round(1 - F.col("churn_probability"), 6),
            "priority": F.round(F.col("churn_probability") * F.col("predicted_clv_90d"), 6),
        }
    )
    # One name per cluster.
    return segments.value_tiers(flagged.join(F.broadcast(names), "cluster", "left"), cuts)


_SAVED: dict[tuple[str, str, str], DataFrame] = {}


def saved(spark: SparkSession, folder: str, stage: str) -> DataFrame:
    """A stored stage of the given tables: ``clean``, ``catalog``, ``modeling``, ``partitioned`` or ``scored``.

    Serving queries read a saved snapshot, as they would in production; it is written once per session.
    """
    key = (spark.sparkContext.applicationId, folder, stage)
    if key not in _SAVED:
        if stage == "clean":
            frame = prepare(raw_ledger(spark, folder), TABLE_CONFIG).clean
            _SAVED[key] = frame
            return frame
        elif stage == "catalog":
            frame = serving.catalog(saved(spark, folder, "clean"), TABLE_CONFIG)
        elif stage == "modeling":
            frame = Ledger(saved(spark, folder, "clean"), TABLE_CONFIG).modeling()
        elif stage == "partitioned":
            frame = with_partition(saved(spark, folder, "modeling"), TABLE_CONFIG)
        else:
            frame = rule_scores(saved(spark, folder, "partitioned"), TABLE_CONFIG)
        _SAVED[key] = materialize(frame, stage)
    return _SAVED[key]
