"""Rules for uploaded feature rows, id lists and single requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, FEATURES, NUMERIC_FEATURES, EngineConfig
from ledgerloom.functions.columns import finite

SIGNED_FEATURES = ("historical_clv", "frequency_trend")
SHARE_FEATURES = ("discount_proxy", "seasonal_concentration", *["affinity_" + c for c in CATEGORIES])
MESSAGES = {
    "missing_ids": "every row needs an id of its own",
    "duplicate_ids": "every row needs an id of its own",
    "nonfinite_values": "All numerical features must be finite numbers",
    "negative_values": "Unexpected negative feature",
    "empty_countries": "Country cannot be empty",
    "shares_above_one": "Shares must be between zero and one",
    "engagement_above_100": "Engagement must be between 0 and 100",
}


def numeric(rows: DataFrame) -> DataFrame:
    """Feature columns as doubles; unparseable text becomes NULL."""
    return rows.withColumns({c: F.col(c).try_cast("double") for c in NUMERIC_FEATURES})


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (F.trim(F.col(column).cast("string")) == "")


def _any(conditions: list[Column]) -> Column:
    return F.coalesce(F.greatest(*[c.cast("int") for c in conditions]) == 1, F.lit(False))


def feature_row_violations(rows: DataFrame) -> DataFrame:
    """How many rows break each rule, in one row; ids are counted in a grouping of their own column."""
    table = numeric(rows)
    repeats = (
        table.groupBy(F.col("customer_id").cast("string").alias("id"))
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0)).alias("d"))
    )
    checks = table.agg(
        F.count("*").alias("rows"),
        F.count_if(_blank("customer_id")).alias("missing_ids"),
        F.count_if(_any([~finite(F.col(c)) for c in NUMERIC_FEATURES])).alias("nonfinite_values"),
        F.count_if(_any([F.col(c) < 0 for c in NUMERIC_FEATURES if c not in SIGNED_FEATURES])).alias("negative_values"),
        F.count_if(_blank("country")).alias("empty_countries"),
        F.count_if(_any([F.col(c) > 1 for c in SHARE_FEATURES])).alias("shares_above_one"),
        F.count_if(F.col("engagement") > 100).alias("engagement_above_100"),
    )
    return checks.withColumn("duplicate_ids", repeats.scalar())


def check_size(rows: int, limit: int | None) -> None:
    """Raise for an empty batch, or one above a limit that the caller has set."""
    if not rows:
        raise ValueError("The batch has no rows")
    if limit is not None and rows > limit:
        raise ValueError(f"The batch has {rows} rows, more than {limit}")


def check_feature_rows(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Raise on the first broken rule; returns the rows with numeric features."""
    missing = sorted({"customer_id", *FEATURES} - set(rows.columns))
    if missing:
        raise ValueError("Missing columns: " + ", ".join(missing))
    found = feature_row_violations(rows).first()
    check_size(found.rows, cfg.batch_limit)
    for rule, message in MESSAGES.items():
        if found[rule]:
            raise ValueError(message)
    return numeric(rows)


def valid_request_id(value: Column) -> Column:
    """1 to 32 digits and nothing else."""
    return F.coalesce(value.rlike(r"^[0-9]{1,32}\z"), F.lit(False))


def check_request(record: dict) -> str:
    """The id of a single-customer request; other fields are refused."""
    value = record.get("customer_id")
    digits = isinstance(value, str) and value.isascii() and value.isdigit() and len(value) <= 32
    if set(record) != {"customer_id"} or not digits:
        raise ValueError("customer_id must be 1 to 32 digits and the only field")
    return value


def id_list_violations(ids: DataFrame, scored: DataFrame) -> DataFrame:
    """One row: missing, repeated and unknown ids of a list."""
    repeats = (
        ids.filter(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("d"))
    )
    unknown = ids.join(scored.select("customer_id"), "customer_id", "left_anti")
    unknown = unknown.filter(F.col("customer_id").isNotNull()).agg(F.count("*").alias("u"))
    found = ids.agg(F.count("*").alias("rows"), F.count_if(F.col("customer_id").isNull()).alias("missing_ids"))
    return found.withColumn("duplicate_ids", repeats.scalar()).withColumn("unknown_ids", unknown.scalar())


def check_id_list(ids: DataFrame, scored: DataFrame, limit: int | None = None) -> DataFrame:
    """Raise for an empty, incomplete or repeated list, or one above ``limit``; KeyError for unknown ids."""
    found = id_list_violations(ids, scored).first()
    check_size(found.rows, limit)
    if found.missing_ids or found.duplicate_ids:
        raise ValueError("Every row of the list needs an id of its own")
    if found.unknown_ids:
        raise KeyError("The snapshot has no such customer")
    return ids
