"""Business queries over the scored snapshot and the ledger, answered for whole sets of customers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.config import EngineConfig
from ledgerloom.functions.columns import money_sum, share
from ledgerloom.functions.ordering import exact_quantiles, running_totals
from ledgerloom.operators.eda import data_histogram, histogram
from ledgerloom.operators.features import product_prices
from ledgerloom.operators.validation import check_id_list
from ledgerloom.operators.history import past_lines, product_names, product_purchases
from ledgerloom.session import materialize

RECOMMENDED = 5
FORECAST_MONTHS = 3


def customer_list(
    scored: DataFrame,
    segment: str | None = None,
    country: str | None = None,
    value_tier: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Customers that match every given filter, by falling retention priority; all of them without a limit."""
    if limit is not None and limit < 1:
        raise ValueError("limit must be positive")
    for column, wanted in (("segment", segment), ("country", country), ("value_tier", value_tier)):
        if wanted is not None:
            scored = scored.filter(F.col(column) == wanted)
    ordered = scored.orderBy(F.desc("priority"), "customer_id")
    return ordered if limit is None else ordered.limit(limit)


def retention_priorities(scored: DataFrame, limit: int = 12) -> DataFrame:
    """The customers most worth keeping."""
    columns = ["customer_id", "country", "segment", "churn_probability", "predicted_clv_90d", "priority"]
    return customer_list(scored.select(*columns), limit=limit)


def customer_lookup(scored: DataFrame, customer_id: str) -> DataFrame:
    """One saved record; the id filter reaches the table scan."""
    return scored.filter(F.col("customer_id") == customer_id)


def require_customer(scored: DataFrame, customer_id: str) -> DataFrame:
    """One saved record; raises KeyError for an unknown id."""
    found = customer_lookup(scored, customer_id)
    if not found.limit(1).count():
        raise KeyError("The snapshot has no such customer")
    return found


def batch_lookup(scored: DataFrame, ids: DataFrame) -> DataFrame:
    """Saved records of the requested ids; the whole call fails for a missing, repeated or unknown one."""
    check_id_list(ids, scored)
    return scored.join(ids.select("customer_id"), "customer_id")


def invoice_aggregates(clean: DataFrame, scored: DataFrame, cfg: EngineConfig) -> DataFrame:
    """First date and signed amount per invoice of the scored customers."""
    past = past_lines(clean, cfg).join(scored.select("customer_id"), "customer_id", "left_semi")
    return past.groupBy("customer_id", "invoice").agg(
        F.min("invoice_date").alias("invoice_date"), money_sum(F.col("amount")).alias("amount")
    )


def revenue_trend(transactions: DataFrame) -> DataFrame:
    """Net revenue per month from the first to the last, empty months as zero."""
    month = F.trunc("invoice_date", "month")
    monthly = transactions.groupBy(month.alias("month")).agg(money_sum(F.col("amount")).alias("revenue"))
    # One row per month from here on.
    spine = monthly.agg(F.explode(F.sequence(F.min("month"), F.max("month"), F.expr("INTERVAL 1 MONTH"))).alias("month"))
    filled = spine.join(monthly, "month", "left")
    return filled.select(F.col("month").cast("string").alias("month"), F.coalesce("revenue", F.lit(0.0)).alias("revenue"))


def revenue_forecast(trend: DataFrame) -> DataFrame:
    """The mean of the last three months, repeated for the next three."""
    recent = trend.orderBy(F.desc("month")).limit(FORECAST_MONTHS)
    level = recent.agg(F.max("month").cast("date").alias("last"), F.avg("revenue").alias("revenue"))
    ahead = F.explode(F.sequence(F.lit(1), F.lit(FORECAST_MONTHS)))
    months = level.withColumn("ahead", ahead)
    return months.select(F.add_months("last", F.col("ahead")).cast("string").alias("month"), "revenue")


def purchased_products(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Distinct products per customer, one row each so that no customer's list has to fit in a cell."""
    return product_purchases(past_lines(clean, cfg)).select("customer_id", "stock_code").dropDuplicates()


def purchased_lists(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The same as a sorted array per customer, as long as the catalog at most."""
    pairs = purchased_products(clean, cfg)
    return pairs.groupBy("customer_id").agg(F.sort_array(F.collect_list("stock_code")).alias("products"))


def catalog(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Products with their name, category, number of distinct orders and typical price."""
    past = past_lines(clean, cfg)
    products = product_purchases(past)
    # Distinct invoices per product via (product, invoice) rows, so a best seller is counted in parallel.
    ordered = (
        products.select("stock_code", "invoice")
        .dropDuplicates()
        .groupBy("stock_code")
        .agg(F.count("*").alias("orders"))
    )
    prices = product_prices(products).select("stock_code", F.col("median_price").alias("typical_price"))
    return (
        ordered.join(prices, "stock_code")
        .join(product_names(past, cfg), "stock_code", "left")
        .select(
            "stock_code",
            F.coalesce("description", F.lit("")).alias("description"),
            F.coalesce("category", F.lit("other")).alias("category"),
            "orders",
            "typical_price",
        )
    )


def _shelf_ranks(items: DataFrame) -> DataFrame:
    """Popularity ranks inside every category, and over the whole catalog as shelf ``*``.

    Products are counted per number of orders and then per code prefix, so neither a large catalog nor many
    equally popular products are ordered in one task.
    """
    shelves = items.withColumn("shelf", F.explode(F.array(F.col("category"), F.lit("*")))).withColumns(
        {"busy": (-F.col("orders")).cast("double"), "prefix": F.substring("stock_code", 1, 3)}
    )
    lots = shelves.groupBy("shelf", "busy", "prefix").agg(F.count("*").alias("n"))
    sizes = lots.groupBy("shelf", "busy").agg(F.sum("n").alias("n"))
    ahead = running_totals(sizes, "busy", ["n"], key=["shelf"]).select("shelf", "busy", "n_before", "n_total")
    peers = F.sum("n").over(W.partitionBy("shelf", "busy").orderBy("prefix")) - F.col("n")
    starts = lots.withColumn("peers", peers).drop("n").join(ahead, ["shelf", "busy"])
    inside = F.row_number().over(W.partitionBy("shelf", "busy", "prefix").orderBy("stock_code"))
    return (
        shelves.join(starts, ["shelf", "busy", "prefix"])
        .withColumn("rank", F.col("n_before") + F.col("peers") + inside)
        .select("shelf", "rank", "stock_code", F.col("n_total").alias("shelf_size"))
    )


def recommendations(scored: DataFrame, items: DataFrame, purchased: DataFrame, count: int = RECOMMENDED) -> DataFrame:
    """The ``count`` most popular products a customer has not bought, from the predicted category.

    A category without products falls back to the whole catalog. Instead of pairing customers with every
    product of a category, the ranks a customer already owns are turned into the gaps between them; each
    gap yields only the ranks still needed, so exactly ``count`` rows per customer meet the catalog.
    """
    # Ranks of the catalog are used three times; stored, they are computed once.
    ranks = materialize(_shelf_ranks(items), "ranks")
    sizes = ranks.groupBy("shelf").agg(F.max("shelf_size").alias("shelf_size"))
    wanted = (
        scored.select("customer_id", F.col("predicted_category").alias("shelf"))
        .join(F.broadcast(sizes), "shelf", "left")
        .withColumn("shelf", F.when(F.col("shelf_size").isNull(), F.lit("*")).otherwise(F.col("shelf")))
        .select("customer_id", "shelf")
    )
    # Category counts are fixed by configuration, so sizes holds a handful of rows.
    owned = (
        purchased.join(wanted, "customer_id")
        .join(ranks.select("stock_code", "shelf", "rank"), ["stock_code", "shelf"])
        .select("customer_id", "shelf", "rank")
    )
    # Only owned ranks that can push the first `count` gaps down matter: rank - (owned before it) <= count.
    in_order = W.partitionBy("customer_id", "shelf").orderBy("rank")
    start = wanted.select("customer_id", "shelf", F.lit(0).cast("long").alias("rank"))
    marks = owned.unionByName(start).withColumn("seen", F.row_number().over(in_order) - 1)
    free_before = F.col("rank") - F.col("seen")
    gaps = (
        marks.withColumn("next", F.lead("rank").over(in_order))
        .withColumn("free", free_before)
        .filter(F.col("free") < count)
        .join(F.broadcast(sizes), "shelf")
        .withColumn("stop", F.coalesce(F.col("next") - 1, F.col("shelf_size")))
        .withColumn("stop", F.least("stop", F.col("rank") + (F.lit(count) - F.col("free"))))
        .filter(F.col("stop") > F.col("rank"))
    )
    picks = gaps.select("customer_id", "shelf", "rank", "free", F.explode(F.sequence(F.col("rank") + 1, "stop")).alias("pick"))
    placed = picks.select(
        "customer_id",
        "shelf",
        F.col("pick").alias("rank"),
        (F.col("free") + F.col("pick") - F.col("rank")).cast("int").alias("position"),
    )
    named = ranks.join(items, "stock_code").select(
        "shelf", "rank", "stock_code", "description", "category", "orders", "typical_price"
    )
    return placed.join(named, ["shelf", "rank"]).drop("shelf", "rank")


def overview_kpis(scored: DataFrame, threshold: Column) -> DataFrame:
    """Headline numbers."""
    return scored.agg(
        F.count("*").alias("customers"),
        F.count_if(F.col("churn_probability") >= threshold).alias("high_risk"),
        F.sum("predicted_clv_90d").alias("expected_spend"),
        F.count_distinct("segment").alias("segments"),
    )


def select_customers(
    scored: DataFrame,
    countries: Sequence[str] = (),
    segments: Sequence[str] = (),
    tiers: Sequence[str] = (),
) -> DataFrame:
    """Multi-select filters; an empty selection keeps everything."""
    for column, wanted in (("country", countries), ("segment", segments), ("value_tier", tiers)):
        if wanted:
            scored = scored.filter(F.col(column).isin(*wanted))
    return scored


def selection_kpis(selected: DataFrame) -> DataFrame:
    """Size, mean risk and gross spend of a selection."""
    return selected.agg(
        F.count("*").alias("customers"),
        F.avg("churn_probability").alias("average_risk"),
        F.sum("monetary").alias("gross_spend"),
    )


def segment_mix(scored: DataFrame) -> DataFrame:
    """Customers and share per segment."""
    counts = scored.groupBy("segment").agg(F.count("*").alias("customers"))
    total = F.sum("customers").over(W.partitionBy())  # one row per segment
    return counts.withColumn("share", share(F.col("customers"), total))


def segment_summary(scored: DataFrame) -> DataFrame:
    """Size, medians and mean risk per segment, to two decimals."""
    sizes = scored.groupBy("segment").agg(
        F.count("*").alias("customers"), F.round(F.avg("churn_probability"), 2).alias("average_risk")
    )
    medians = exact_quantiles(scored, ["recency", "frequency", "monetary"], [0.5], by=["segment"])
    names = {"recency": "median_recency", "frequency": "median_orders", "monetary": "median_spend"}
    wide = medians.groupBy("segment").agg(
        *[F.round(F.max(F.when(F.col("column") == c, F.col("value"))), 2).alias(n) for c, n in names.items()]
    )
    return sizes.join(wide, "segment")


def risk_histogram(scored: DataFrame, bins: int = 25) -> DataFrame:
    """Churn probability in equal bins over [0, 1]."""
    return histogram(scored, F.col("churn_probability"), bins, F.lit(0.0), F.lit(1.0), "churn_probability")


def error_histogram(rows: DataFrame, bins: int = 40) -> DataFrame:
    """Signed errors in equal bins between their extremes."""
    return data_histogram(rows, F.col("error"), bins, "error")


def customer_card(scored: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The fields of an individual customer report, as text."""

    def percent(column: str) -> Column:
        return F.concat(F.format_number(F.col(column) * 100, 1), F.lit("%"))

    return scored.select(
        "customer_id",
        F.lit(cfg.cutoff).alias("prediction_date"),
        "country",
        "segment",
        percent("churn_probability").alias("churn_risk"),
        F.concat(F.lit("GBP "), F.format_number("predicted_clv_90d", 2)).alias("expected_spend"),
        percent("purchase_probability").alias("purchase_chance"),
    )


def representatives(scored: DataFrame, threshold: Column) -> DataFrame:
    """Lowest-risk, closest-to-threshold and highest-risk customer."""
    risk = F.col("churn_probability")
    picked = scored.withColumn("distance", F.abs(risk - threshold)).agg(
        F.min_by("customer_id", F.struct(risk, F.col("customer_id"))).alias("low"),
        F.min_by("customer_id", F.struct(F.col("distance"), F.col("customer_id"))).alias("borderline"),
        F.max_by("customer_id", F.struct(risk, F.col("customer_id"))).alias("high"),
    )
    return picked.selectExpr("stack(3, 'low', low, 'borderline', borderline, 'high', high) AS (kind, customer_id)")
