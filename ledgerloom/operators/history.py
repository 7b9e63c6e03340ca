"""What was known before the prediction date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import EngineConfig
from ledgerloom.functions.columns import category_of, instant


def past_lines(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Lines of identified customers strictly before the cutoff."""
    return clean.filter((F.col("invoice_date") < instant(cfg.cutoff)) & F.col("customer_id").isNotNull())


def product_purchases(past: DataFrame) -> DataFrame:
    """Purchased product lines."""
    return past.filter(~F.col("is_return") & F.col("is_product"))


def product_names(past: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Most frequent non-empty description per product and its category; ties go to the smaller text.

    Lines are counted per (product, description) first, so a best seller reaches the second grouping as
    one row per spelling.
    """
    spellings = (
        past.filter(F.col("description") != "").groupBy("stock_code", "description").agg(F.count("*").alias("n"))
    )
    modal = spellings.groupBy("stock_code").agg(
        F.min_by("description", F.struct(-F.col("n"), F.col("description"))).alias("description")
    )
    return modal.withColumn("category", category_of(F.col("description"), cfg.category_rules))


def history(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Past lines under their product's modal description and category."""
    past = past_lines(clean, cfg)
    named = past.drop("description").join(product_names(past, cfg), "stock_code", "left")
    return named.withColumns(
        {
            "description": F.coalesce("description", F.lit("")),
            "category": F.coalesce("category", F.lit("other")),
        }
    )
