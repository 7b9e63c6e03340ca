"""Ledger validation, cleaning and the cleaning audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.config import LEDGER_COLUMNS, PRODUCT_CODE_PATTERN, EngineConfig
from ledgerloom.functions.columns import finite, instant, share
from ledgerloom.functions.ordering import fit_quantiles
from ledgerloom.session import materialize


def validate_columns(raw: DataFrame) -> DataFrame:
    """Every ledger column must be there; others are allowed."""
    missing = sorted(set(LEDGER_COLUMNS) - set(raw.columns))
    if missing:
        raise ValueError("The ledger lacks columns: " + ", ".join(missing))
    return raw


#: White space of any script at the ends of a text, and runs of it.
WHITE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"
ENDS = f"^{WHITE}|{WHITE}$"


def dated(raw: DataFrame) -> DataFrame:
    """Dates from text; numbers stay as they came, which is what makes two lines equal."""
    return raw.withColumn("invoice_date", F.col("invoice_date").try_cast("timestamp_ntz"))


def numbered(lines: DataFrame) -> DataFrame:
    """Quantity and price from text."""
    return lines.withColumns({c: F.col(c).try_cast("double") for c in ("quantity", "price")})


def typed(raw: DataFrame) -> DataFrame:
    """Dates and numbers from text; what does not parse becomes NULL and is counted by the checks."""
    return numbered(dated(raw))


def _in_range(cfg: EngineConfig) -> Column:
    return F.col("invoice_date").between(instant(cfg.minimum_date), instant(cfg.maximum_date))


def date_violations(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row: unparseable dates and dates outside the inclusive range."""
    ledger = typed(raw)
    return ledger.agg(
        F.count_if(F.col("invoice_date").isNull()).alias("invalid_dates"),
        F.count_if(~_in_range(cfg)).alias("out_of_range_dates"),
    )


def missing_customer_rate(raw: DataFrame) -> DataFrame:
    """Share of lines without a customer, before duplicates are dropped."""
    missing = F.count_if(F.col("customer_id").isNull())
    return raw.agg(share(missing, F.count("*")).alias("missing_customer_rate"))


def numeric_violations(raw: DataFrame) -> DataFrame:
    """One row: distinct lines whose quantity or price is not a finite number."""
    ledger = distinct_lines(raw)
    return ledger.agg(
        F.count_if(~finite(F.col("quantity"))).alias("nonfinite_quantity"),
        F.count_if(~finite(F.col("price"))).alias("nonfinite_price"),
    )


def check_ledger(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Run every rule in one pass over the raw ledger and raise on the first that fails."""
    ledger = typed(validate_columns(raw))
    found = ledger.agg(
        F.count("*").alias("lines"),
        F.count_if(F.col("invoice_date").isNull()).alias("invalid_dates"),
        F.count_if(~_in_range(cfg)).alias("out_of_range"),
        F.count_if(F.col("customer_id").isNull()).alias("missing"),
        F.count_if(~is_whole_id(ledger)).alias("fractional"),
        F.count_if(~finite(F.col("quantity"))).alias("quantity"),
        F.count_if(~finite(F.col("price"))).alias("price"),
    ).first()
    if found.lines == 0:
        raise ValueError("The ledger is empty")
    if found.invalid_dates:
        raise ValueError("Some invoice dates cannot be read")
    if found.out_of_range:
        raise ValueError("Some invoice dates lie outside the configured span")
    if found.missing / found.lines > cfg.max_missing_customer_rate:
        raise ValueError("Share of lines without a customer exceeds the configured threshold")
    if found.fractional:
        raise ValueError("Customer ids must be whole numbers")
    for column in ("quantity", "price"):
        if found[column]:
            raise ValueError(f"Nonfinite {column}")
    return raw


def distinct_lines(raw: DataFrame) -> DataFrame:
    """Exact duplicates dropped (NULLs compare equal); copies collapse before the shuffle."""
    return numbered(dated(raw).dropDuplicates())


def duplicate_count(raw: DataFrame) -> DataFrame:
    """Lines beyond the first of each identical group."""
    groups = dated(raw).groupBy(*raw.columns).agg(F.count("*").alias("copies"))
    return groups.agg(
        F.sum("copies").alias("raw_rows"),
        F.count("*").alias("distinct_rows"),
        F.sum(F.col("copies") - 1).alias("exact_duplicate_rows"),
    )


def fit_fences(lines: DataFrame) -> dict[str, float]:
    """Quartiles of quantity and price over stored distinct lines."""
    return fit_quantiles(
        lines,
        {
            "quantity_q1": ("quantity", 0.25),
            "quantity_q3": ("quantity", 0.75),
            "price_q1": ("price", 0.25),
            "price_q3": ("price", 0.75),
        },
    )


def _outside_fences(column: str, fences: dict[str, float]) -> Column:
    q1, q3 = fences[f"{column}_q1"], fences[f"{column}_q3"]
    reach = 1.5 * (q3 - q1)
    return ~F.col(column).between(q1 - reach, q3 + reach)


def iqr_flags(raw: DataFrame) -> DataFrame:
    """Quartiles and the number of distinct lines beyond 1.5 IQR. Flagged lines are kept.

    Duplicates are dropped once; only the two columns are stored for the passes that follow.
    """
    lines = materialize(distinct_lines(raw).select("quantity", "price"), "distinct")
    fences = fit_fences(lines)
    return lines.agg(
        *[F.lit(value).alias(name) for name, value in fences.items()],
        F.count_if(_outside_fences("quantity", fences)).alias("quantity_iqr_flagged"),
        F.count_if(_outside_fences("price", fences)).alias("price_iqr_flagged"),
    )


def is_invalid() -> Column:
    """Lines that carry no accounting value."""
    return (F.col("price") <= 0) | (F.col("quantity") == 0)


def is_extreme(cfg: EngineConfig) -> Column:
    """Lines beyond the configured bounds."""
    return (F.abs(F.col("quantity")) > cfg.max_quantity) | (F.col("price") > cfg.max_price)


def rejected_lines(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Invalid lines, and extreme lines that are not already invalid."""
    return distinct_lines(raw).agg(
        F.count_if(is_invalid()).alias("invalid_price_or_zero_quantity"),
        F.count_if(is_extreme(cfg) & ~is_invalid()).alias("quarantined_extremes"),
    )


def quarantine(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Extreme raw lines, deduplicated; unlike the audit count this keeps invalid ones too."""
    return distinct_lines(raw).filter(is_extreme(cfg))


def stripped(column: str) -> Column:
    """Upper case, without white space at either end."""
    return F.regexp_replace(F.upper(column), ENDS, "")


def normalize_text(lines: DataFrame) -> DataFrame:
    """Codes and descriptions upper-cased and trimmed; missing text replaced."""
    squeezed = F.regexp_replace(F.upper(F.coalesce("description", F.lit(""))), WHITE, " ")
    return lines.withColumns(
        {
            "invoice": stripped("invoice"),
            "stock_code": stripped("stock_code"),
            "description": F.trim(squeezed),
            "country": F.coalesce("country", F.lit("Unknown")),
        }
    )


def _id_number(lines: DataFrame) -> Column:
    """Ids as numbers; text goes through decimals, which hold ids beyond 2^53 exactly."""
    text = lines.schema["customer_id"].dataType.simpleString() == "string"
    return F.col("customer_id").cast("decimal(38,6)") if text else F.col("customer_id")


def is_whole_id(lines: DataFrame) -> Column:
    """False for an id with a fraction, which would merge two customers."""
    number = _id_number(lines)
    return F.coalesce(number == F.floor(number), F.lit(True))


def customer_key(lines: DataFrame) -> DataFrame:
    """Numeric customer ids as integer strings; missing ids stay missing."""
    return lines.withColumn("customer_id", _id_number(lines).cast("decimal(38,0)").cast("string"))


def mark_returns(lines: DataFrame) -> DataFrame:
    """Returns are negative or on a C invoice; their quantity is negative either way."""
    returned = (F.col("quantity") < 0) | F.coalesce(F.col("invoice").startswith("C"), F.lit(False))
    signed = F.when(returned, -F.abs(F.col("quantity"))).otherwise(F.col("quantity"))
    marked = lines.withColumn("is_return", returned).withColumn("quantity", signed)
    return marked.withColumn("amount", F.col("quantity") * F.col("price"))


def mark_products(lines: DataFrame) -> DataFrame:
    """Five digits and optional letters make a product; everything else is administrative."""
    return lines.withColumn("is_product", F.coalesce(F.col("stock_code").rlike(PRODUCT_CODE_PATTERN), F.lit(False)))


def clean_ledger(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """The clean ledger. Lazy: call ``check_ledger`` first where bad input must raise."""
    kept = distinct_lines(raw.select(*LEDGER_COLUMNS)).filter(~is_invalid() & ~is_extreme(cfg))
    return mark_products(mark_returns(customer_key(normalize_text(kept))))


def audit_lines(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One narrow row per distinct line, with its number of copies and everything the audit counts."""
    groups = numbered(dated(raw.select(*LEDGER_COLUMNS)).groupBy(*LEDGER_COLUMNS).agg(F.count("*").alias("copies")))
    return customer_key(groups).select(
        "quantity",
        "price",
        "copies",
        "customer_id",
        "invoice_date",
        is_invalid().alias("invalid"),
        is_extreme(cfg).alias("extreme"),
        ((F.col("quantity") < 0) | F.coalesce(stripped("invoice").startswith("C"), F.lit(False))).alias("is_return"),
    )


def cleaning_audit(raw: DataFrame, cfg: EngineConfig) -> DataFrame:
    """All counts of the cleaning in one row.

    One grouping of the raw ledger serves the counts before and after deduplication; it is stored without
    the text columns, and the quartiles and counts read that.
    """
    lines = materialize(audit_lines(raw, cfg), "audit")
    fences = fit_fences(lines)
    kept = ~F.col("invalid") & ~F.col("extreme")
    missing = F.sum(F.when(F.col("customer_id").isNull(), F.col("copies")).otherwise(0))
    return lines.agg(
        F.sum("copies").alias("raw_rows"),
        share(missing, F.sum("copies")).alias("missing_customer_rate"),
        F.sum(F.col("copies") - 1).alias("exact_duplicate_rows"),
        F.count_if(_outside_fences("quantity", fences)).alias("quantity_iqr_flagged"),
        F.count_if(_outside_fences("price", fences)).alias("price_iqr_flagged"),
        F.count_if("invalid").alias("invalid_price_or_zero_quantity"),
        F.count_if(F.col("extreme") & ~F.col("invalid")).alias("quarantined_extremes"),
        F.count_if(kept).alias("clean_rows"),
        F.count_if(kept & F.col("is_return")).alias("return_rows"),
        F.count_distinct(F.when(kept, F.col("customer_id"))).alias("identified_customers"),
        F.min(F.when(kept, F.col("invoice_date"))).cast("string").alias("min_date"),
        F.max(F.when(kept, F.col("invoice_date"))).cast("string").alias("max_date"),
    )
