"""Outcomes in the half-open window that starts at the cutoff."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import NO_PURCHASE, EngineConfig
from ledgerloom.functions.columns import category_of, elapsed_days, instant, money_sum


def window_end(cfg: EngineConfig) -> Column:
    """First instant after the outcome window."""
    return instant(cfg.cutoff) + F.make_interval(days=F.lit(cfg.horizon_days))


def window_coverage(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row: last ledger date, end of the window and whether the window is complete."""
    latest = F.max("invoice_date")
    return clean.agg(latest.alias("last_date"), (latest >= window_end(cfg)).alias("complete")).select(
        "last_date", window_end(cfg).alias("window_end"), "complete"
    )


def check_window(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Raise where labels would be censored."""
    if not window_coverage(clean, cfg).first().complete:
        raise ValueError("Outcome window is incomplete; labels would be censored")
    return clean


def future_purchases(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Purchases of identified customers inside the window."""
    return clean.filter(
        (F.col("invoice_date") >= instant(cfg.cutoff))
        & (F.col("invoice_date") < window_end(cfg))
        & ~F.col("is_return")
        & F.col("customer_id").isNotNull()
    )


def outcomes(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """What each customer with a purchase in the window did; categories use the line's own description."""
    product = F.when(F.col("is_product"), F.struct("invoice_date", "invoice", "stock_code", "description"))
    found = (
        future_purchases(clean, cfg)
        .groupBy("customer_id")
        .agg(
            money_sum(F.col("amount")).alias("spend"),
            F.min("invoice_date").alias("first_date"),
            F.min(product).alias("first_product"),
        )
    )
    category = category_of(F.col("first_product.description"), cfg.category_rules)
    return found.select(
        "customer_id",
        "spend",
        "first_date",
        F.when(F.col("first_product").isNotNull(), category).alias("category"),
    )


def customer_targets(clean: DataFrame, customers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Churn, spend, capped waiting time and next category for the given customers."""
    wait = elapsed_days(instant(cfg.cutoff), F.col("first_date"))
    return (
        customers.select("customer_id")
        .join(outcomes(clean, cfg), "customer_id", "left")
        .select(
            "customer_id",
            F.when(F.col("first_date").isNull(), 1).otherwise(0).alias("churn"),
            F.coalesce("spend", F.lit(0.0)).alias("clv_90d"),
            F.coalesce(wait, F.lit(float(cfg.horizon_days))).alias("next_days"),
            F.coalesce("category", F.lit(NO_PURCHASE)).alias("next_category"),
        )
    )


def modeling_table(features: DataFrame, targets: DataFrame) -> DataFrame:
    """Features with their labels."""
    return features.join(targets, "customer_id")
