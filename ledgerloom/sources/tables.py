"""The star-schema test tables presented as a retail ledger."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import EngineConfig
from ledgerloom.functions.columns import half_up, instant
from ledgerloom.session import spread
from ledgerloom.sources.ledger import combine_parts

# Dates and category words that occur in the test tables.
TABLE_CONFIG = replace(
    EngineConfig(),
    cutoff="2001-03-01",
    minimum_date="1995-01-01",
    maximum_date="2002-01-01",
    category_rules=(
        ("home", "ANVIL|BOLT"),
        ("kitchen", "PLATE|HOT"),
        ("seasonal", "COLD|RED"),
        ("accessories", "RING|GEAR"),
    ),
)
# The ledger arrives in two parts that overlap by a month, which is where its exact duplicates come from.
FIRST_PART_END = "1998-07-01"
SECOND_PART_START = "1998-06-01"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger lines in canonical columns; one scan per table, join strategy left to AQE.

    Orders meet their customers before the lines, so the many lines are dealt twice and not three times.
    """
    wanted = ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag"]
    lines = spread(table(spark, folder, "lineitem").select(*wanted))
    orders = table(spark, folder, "orders")
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    parts = table(spark, folder, "part")
    code = F.col("p_partkey")
    number = code.cast("string")
    # Five digits, then letters for the overflow, so codes stay distinct product codes at any scale.
    product_code = F.concat(
        F.lpad((code % 100000).cast("string"), 5, "0"),
        F.when(code < 100000, F.lit("")).otherwise(
            F.translate(F.floor(code / 100000).cast("string"), "0123456789", "ABCDEFGHIJ")
        ),
    )
    cents = F.round(F.col("l_extendedprice") * 100)
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return (
        lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.concat(
                F.when(F.col("l_returnflag") == "R", F.lit("C")).otherwise(F.lit("")),
                F.col("o_orderkey").cast("string"),
            ).alias("invoice"),
            F.when(F.col("p_type") == "PROMO", F.concat(F.lit("M"), number))
            .otherwise(product_code)
            .alias("stock_code"),
            F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias("description"),
            F.col("l_quantity").alias("quantity"),
            F.col("o_orderdate").alias("invoice_date"),
            (half_up(cents / F.col("l_quantity")) / 100.0).alias("price"),
            # Stand-ins for lines booked without a customer or a country.
            F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey").cast("double")).alias("customer_id"),
            F.when(F.col("o_orderkey") % 97 != 0, F.col("n_name")).alias("country"),
        )
    )


def ledger_parts(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The two overlapping source parts under their original header."""
    from ledgerloom.config import LEDGER_HEADER

    lines = order_lines(spark, folder)
    first = lines.filter(F.col("invoice_date") < instant(FIRST_PART_END))
    second = lines.filter(F.col("invoice_date") >= instant(SECOND_PART_START))
    return [part.toDF(*LEDGER_HEADER) for part in (first, second)]


def raw_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Both parts as one ledger.

    Equal to ``combine_parts(ledger_parts(...))`` row for row, but reads each table once and repeats the
    overlap in place.
    """
    lines = order_lines(spark, folder)
    both = (F.col("invoice_date") >= instant(SECOND_PART_START)) & (F.col("invoice_date") < instant(FIRST_PART_END))
    copies = F.when(both, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return lines.withColumn("_part", F.explode(copies)).drop("_part")


def ingested_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger as read from its parts."""
    return combine_parts(ledger_parts(spark, folder))
