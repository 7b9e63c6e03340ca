"""Point-in-time customer features.

Three branches read the past lines, each pre-aggregated before its shuffle:

* invoices  -> days per customer -> customer (recency, frequency, money, rhythm, returns)
* products  -> (customer, product) -> customer (discounts, popularity, category mix)
* countries -> (customer, country) -> customer

The branches end partitioned by customer, so joining them shuffles nothing again. A customer who owns a
third of all lines is spread over its invoices, days and products until only a few rows are left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, NUMERIC_FEATURES, EngineConfig
from ledgerloom.functions.columns import elapsed_days, instant, money, share
from ledgerloom.operators.history import past_lines, product_names, product_purchases

RECENT_DAYS = 90
SPAN_DAYS = 30
TREND_SPANS = 6
DISCOUNT_SHARE = 0.9


def _purchase(value: Column) -> Column:
    return F.when(~F.col("is_return"), value)


def _returned(value: Column) -> Column:
    return F.when(F.col("is_return"), value)


def invoice_totals(past: DataFrame) -> DataFrame:
    """One row per (customer, invoice): purchase date, amount and units, plus net and returned totals."""
    return past.groupBy("customer_id", "invoice").agg(
        F.min(_purchase(F.col("invoice_date"))).alias("date"),
        F.sum(_purchase(money(F.col("amount")))).alias("amount"),
        F.sum(_purchase(F.col("quantity"))).alias("units"),
        F.sum(money(F.col("amount"))).alias("net"),
        F.sum(_returned(F.col("quantity"))).alias("returned"),
    )


def orders(past: DataFrame) -> DataFrame:
    """Purchase invoices."""
    return (
        invoice_totals(past)
        .filter(F.col("date").isNotNull())
        .select("customer_id", "invoice", "date", F.col("amount").cast("double").alias("amount"), "units")
    )


def _day_stats(invoices: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Per customer and calendar day: sums, extremes and squared gaps between orders.

    Orders at one instant have no gap between them, so they are one row first. The instants of a day are
    ordered by a window, which spills, and never gathered into an array.
    """
    recent = F.col("date") >= instant(cfg.cutoff) - F.make_interval(days=F.lit(RECENT_DAYS))
    span = F.floor(elapsed_days(F.col("date"), instant(cfg.cutoff)) / SPAN_DAYS)
    slope = F.when(span < TREND_SPANS, F.lit((TREND_SPANS - 1) / 2) - span)
    dated = invoices.withColumns({"day": F.to_date("date"), "recent": recent, "slope": slope})
    sums = ("orders", "amount", "units", "net", "returned", "recent_orders", "recent_amount", "slope")
    instants = dated.groupBy("customer_id", "day", "date").agg(
        F.count("date").alias("orders"),
        F.sum("amount").alias("amount"),
        F.sum("units").alias("units"),
        F.sum("net").alias("net"),
        F.sum("returned").alias("returned"),
        F.count_if("recent").alias("recent_orders"),
        F.sum(F.when(F.col("recent"), F.col("amount"))).alias("recent_amount"),
        F.sum("slope").alias("slope"),
    )
    earlier = F.lag("date").over(W.partitionBy("customer_id", "day").orderBy("date"))
    gaps = instants.withColumn("squared", F.coalesce(_gap_seconds(earlier, F.col("date")) ** 2, F.lit(0.0)))
    return gaps.groupBy("customer_id", "day").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("squared").alias("squared_gaps"),
    )


def _gap_seconds(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end) / 1e6


def order_profile(past: DataFrame, cfg: EngineConfig) -> DataFrame:
    """All features that come from invoices; one row per customer with at least one purchase."""
    cutoff = instant(cfg.cutoff)
    days = _day_stats(invoice_totals(past), cfg)
    earlier = F.lag("last_date").over(W.partitionBy("customer_id").orderBy("day"))
    bridged = days.withColumn(
        "squared_gaps",
        F.col("squared_gaps") + F.coalesce(_gap_seconds(earlier, F.col("first_date")) ** 2, F.lit(0.0)),
    )
    middle = (TREND_SPANS - 1) / 2
    weight = F.lit(sum((j - middle) ** 2 for j in range(TREND_SPANS)))
    merged = bridged.groupBy("customer_id").agg(
        F.sum("orders").alias("frequency"),
        F.sum("amount").alias("amount"),
        F.sum("units").alias("units"),
        F.sum("net").alias("net"),
        F.sum("returned").alias("returned"),
        F.sum("recent_orders").alias("recent_orders"),
        F.sum("recent_amount").alias("recent_amount"),
        *[F.sum(F.when(F.month("day") == m, F.col("orders"))).alias(f"month_{m}") for m in range(1, 13)],
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.sum("squared_gaps").alias("squared_gaps"),
        (F.coalesce(F.sum("slope"), F.lit(0.0)) / weight).alias("frequency_trend"),
    )
    gaps = F.col("frequency") - 1
    reach = _gap_seconds(F.col("first_date"), F.col("last_date"))
    variance = (F.col("squared_gaps") - reach * reach / F.nullif(gaps, F.lit(0))) / F.nullif(gaps - 1, F.lit(0))
    monetary = F.col("amount").cast("double")
    return merged.filter(F.col("frequency") > 0).select(
        "customer_id",
        "frequency",
        monetary.alias("monetary"),
        share(monetary, F.col("frequency")).alias("average_spend"),
        share(F.col("units"), F.col("frequency")).alias("basket_size"),
        elapsed_days(F.col("last_date"), cutoff).alias("recency"),
        elapsed_days(F.col("first_date"), cutoff).alias("tenure"),
        F.col("net").cast("double").alias("historical_clv"),
        F.when(F.col("frequency") > 2, variance / 86400.0**2).otherwise(0.0).alias("gap_variance"),
        F.col("recent_orders").cast("double").alias("orders_90d"),
        F.coalesce(F.col("recent_amount").cast("double"), F.lit(0.0)).alias("spend_90d"),
        "frequency_trend",
        share(F.greatest(*[F.col(f"month_{m}") for m in range(1, 13)]), F.col("frequency")).alias(
            "seasonal_concentration"
        ),
        F.coalesce(share(F.abs("returned"), F.col("units")), F.lit(0.0)).alias("return_rate"),
    )


def last_country(past: DataFrame) -> DataFrame:
    """Country of the latest purchase line; on the same instant the larger name wins."""
    seen = (
        past.filter(~F.col("is_return"))
        .groupBy("customer_id", "country")
        .agg(F.max("invoice_date").alias("seen"))
    )
    return seen.groupBy("customer_id").agg(F.max_by("country", F.struct("seen", "country")).alias("country"))


def product_prices(products: DataFrame) -> DataFrame:
    """Median line price and number of lines per product.

    Equal prices collapse into one weighted row before the shuffle, so the median of a best seller looks
    at its distinct prices only.
    """
    tally = products.groupBy("stock_code", "price").agg(F.count("*").alias("n"))
    return tally.groupBy("stock_code").agg(
        F.percentile("price", F.lit(0.5), F.col("n")).alias("median_price"),
        F.sum("n").alias("product_lines"),
    )


def product_popularity(products: DataFrame) -> DataFrame:
    """Share of all product lines per product."""
    counts = products.groupBy("stock_code").agg(F.count("*").alias("product_lines"))
    total = counts.agg(F.sum("product_lines").alias("n")).scalar()
    return counts.select("stock_code", "product_lines", share(F.col("product_lines"), total).alias("popularity"))


def product_profile(past: DataFrame, cfg: EngineConfig) -> DataFrame:
    """All features that come from purchased product lines."""
    products = product_purchases(past)
    prices = product_prices(products)
    catalog = prices.join(product_names(past, cfg), "stock_code", "left").select(
        "stock_code",
        "median_price",
        "product_lines",
        F.coalesce("category", F.lit("other")).alias("category"),
    )
    discounted = F.col("price") < F.col("median_price") * DISCOUNT_SHARE
    baskets = (
        products.select("customer_id", "stock_code", "price")
        .join(catalog, "stock_code")
        .groupBy("customer_id", "stock_code", "category", "product_lines")
        .agg(F.count("*").alias("lines"), F.count_if(discounted).alias("discounted"))
    )
    total = prices.agg(F.sum("product_lines").alias("n")).scalar()
    lines = F.sum("lines")
    weighted = F.sum(F.col("lines").cast("double") * F.col("product_lines"))
    return baskets.groupBy("customer_id").agg(
        share(F.sum("discounted"), lines).alias("discount_proxy"),
        (share(weighted, lines) / total).alias("sku_popularity"),
        F.count("*").cast("double").alias("unique_products"),
        *[
            share(F.sum(F.when(F.col("category") == c, F.col("lines")).otherwise(0)), lines).alias("affinity_" + c)
            for c in CATEGORIES
        ],
    )


def engagement() -> Column:
    """Mean of three saturating scores for recency, frequency and money, in percent."""
    warm = F.exp(-F.col("recency") / 90)
    busy = 1 - F.exp(-F.col("frequency") / 10)
    rich = 1 - F.exp(-F.col("monetary") / 2500)
    return (warm + busy + rich) / 3 * 100


def customer_features(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per customer with a purchase before the cutoff."""
    past = past_lines(clean, cfg)
    table = (
        order_profile(past, cfg)
        .join(last_country(past), "customer_id", "left")
        .join(product_profile(past, cfg), "customer_id", "left")
        .withColumn("engagement", engagement())
    )
    columns = [
        F.coalesce(F.col(c), F.lit(0) if c == "frequency" else F.lit(0.0)).alias(c) for c in NUMERIC_FEATURES
    ]
    return table.select("customer_id", *columns, "country")
