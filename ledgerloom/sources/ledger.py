"""Reading a ledger delivered in parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.config import LEDGER_COLUMNS, LEDGER_HEADER

EXPECTED_PARTS = 2

# Customer ids arrive as "17399.0"; quantity and price stay text so that bad values can be reported.
RAW_CSV_SCHEMA = (
    "`Invoice` string, `StockCode` string, `Description` string, `Quantity` string, "
    "`InvoiceDate` string, `Price` string, `Customer ID` string, `Country` string"
)


def combine_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Check part count and exact header order, rename and append. Duplicates are kept.

    Nothing here orders by date: a distributed frame has no row order, so ordering belongs to the sink.
    """
    if len(parts) != EXPECTED_PARTS:
        raise ValueError(f"Expected {EXPECTED_PARTS} ledger parts, got {len(parts)}")
    for part in parts:
        if tuple(part.columns) != LEDGER_HEADER:
            raise ValueError(f"Unexpected ledger header: {part.columns}")
    first, second = (part.toDF(*LEDGER_COLUMNS) for part in parts)
    return first.unionByName(second)


def read_parts(spark: SparkSession, paths: Sequence[str], file_format: str = "parquet") -> DataFrame:
    """Read one CSV or Parquet folder per part."""
    if file_format == "csv":
        # enforceSchema=False makes Spark compare each file's header with the schema.
        reader = spark.read.schema(RAW_CSV_SCHEMA).option("header", True).option("enforceSchema", False)
        return combine_parts([reader.csv(path) for path in paths])
    if file_format != "parquet":
        raise ValueError(f"Unsupported ledger format: {file_format}")
    return combine_parts([spark.read.parquet(path) for path in paths])
