"""Ordered, truncated and padded purchase sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, EngineConfig
from ledgerloom.functions.columns import elapsed_days, instant, money_sum, share
from ledgerloom.operators.history import past_lines, product_names, product_purchases

VECTOR = ("amount_log", "gap_log", "age_log", *CATEGORIES)


def product_invoices(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Product purchase invoices: date, amount and the category mix of their lines."""
    past = past_lines(clean, cfg)
    named = product_purchases(past).join(
        product_names(past, cfg).select("stock_code", "category"), "stock_code", "left"
    )
    category = F.coalesce("category", F.lit("other"))
    invoices = named.groupBy("customer_id", "invoice").agg(
        F.min("invoice_date").alias("date"),
        money_sum(F.col("amount")).alias("amount"),
        *[share(F.count_if(category == c), F.count("*")).alias(c) for c in CATEGORIES],
    )
    return invoices.withColumn("age", elapsed_days(F.col("date"), instant(cfg.cutoff)))


def sequence_events(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Every product invoice with the days since the customer's previous one.

    Only the first invoice at an instant has a gap, so gaps are found on distinct instants, first inside
    30-day spans and then across them; the longest ordered group is one span of one customer.
    """
    events = product_invoices(clean, cfg).withColumn("span", F.floor(F.col("age") / 30))
    instants = events.groupBy("customer_id", "span", "date").agg(F.min("invoice").alias("first_invoice"))
    spans = instants.groupBy("customer_id", "span").agg(F.max("date").alias("last_date"))
    by_span = W.partitionBy("customer_id").orderBy(F.col("span").desc())
    bridges = spans.select("customer_id", "span", F.lag("last_date").over(by_span).alias("bridge"))
    inside = F.lag("date").over(W.partitionBy("customer_id", "span").orderBy("date"))
    gaps = (
        instants.withColumn("inside", inside)
        .join(bridges, ["customer_id", "span"])
        .select(
            "customer_id",
            F.col("first_invoice").alias("invoice"),
            elapsed_days(F.coalesce("inside", "bridge"), F.col("date")).alias("gap"),
        )
    )
    return (
        events.join(gaps, ["customer_id", "invoice"], "left")
        .withColumn("gap", F.coalesce("gap", F.lit(0.0)))
        .select("customer_id", "invoice", "date", "amount", "gap", "age", *CATEGORIES)
    )


def last_events(clean: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The last ``sequence_length`` events per customer, numbered from zero in time order.

    One event more than needed is kept to date the first gap. Spark applies the row_number limit inside
    each map task before the shuffle, so a customer's full history is never gathered.
    """
    newest = W.partitionBy("customer_id").orderBy(F.col("date").desc(), F.col("invoice").desc())
    oldest = W.partitionBy("customer_id").orderBy("date", "invoice")
    kept = (
        product_invoices(clean, cfg)
        .withColumn("recent_rank", F.row_number().over(newest))
        .filter(F.col("recent_rank") <= cfg.sequence_length + 1)
    )
    gap = elapsed_days(F.lag("date").over(oldest), F.col("date"))
    size = F.max("recent_rank").over(W.partitionBy("customer_id"))
    length = F.least(size, F.lit(cfg.sequence_length))
    return (
        kept.withColumn("gap", F.coalesce(gap, F.lit(0.0)))
        .withColumn("length", length)
        .filter(F.col("recent_rank") <= cfg.sequence_length)
        .select(
            "customer_id",
            (F.col("length") - F.col("recent_rank")).alias("step"),
            "invoice",
            "date",
            "amount",
            "gap",
            "age",
            *CATEGORIES,
        )
    )


def _scaled(column: str, divisor: float) -> Column:
    return F.log1p(F.col(column)) / divisor


def customer_sequences(clean: DataFrame, customers: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``values`` (sequence_length vectors of eight floats, zeros at the end) and ``length`` per customer.

    Customers without events keep one zero vector; ids without any history are allowed.
    """
    vector = F.array(
        _scaled("amount", 10), _scaled("gap", 7), _scaled("age", 7), *[F.col(c) for c in CATEGORIES]
    ).cast("array<float>")
    steps = last_events(clean, cfg).groupBy("customer_id").agg(
        F.sort_array(F.collect_list(F.struct("step", vector.alias("vector")))).alias("events")
    )
    width = len(VECTOR)
    zero = F.array(*[F.lit(0.0)] * width).cast("array<float>")
    known = F.coalesce(
        F.transform("events", lambda e: e["vector"]), F.array().cast("array<array<float>>")
    )
    padding = F.array_repeat(zero, F.lit(cfg.sequence_length) - F.size(known))
    return (
        customers.select("customer_id")
        .join(steps, "customer_id", "left")
        .select(
            "customer_id",
            F.concat(known, padding).alias("values"),
            F.greatest(F.size(known), F.lit(1)).alias("length"),
        )
    )


def sequence_cells(sequences: DataFrame) -> DataFrame:
    """Sequences in long form: one row per customer and step."""
    steps = sequences.select("customer_id", "length", F.posexplode("values").alias("step", "vector"))
    return steps.select(
        "customer_id", "length", "step", *[F.get("vector", F.lit(i)).alias(n) for i, n in enumerate(VECTOR)]
    )
