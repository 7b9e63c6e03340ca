"""The registered queries: every operator over the given tables, next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, FEATURES, NUMERIC_FEATURES, SEGMENT_COLUMNS, TARGETS
from ledgerloom.functions.columns import category_of
from ledgerloom.operators import (
    cleaning,
    eda,
    features,
    history,
    labels,
    metrics,
    segments,
    sequences,
    serving,
    splits,
    validation,
)
from ledgerloom.plans import oracles
from ledgerloom.plans.oracles import STEPS, compose
from ledgerloom.plans.snapshot import Ledger, rule_scores, saved
from ledgerloom.sources import store
from ledgerloom.sources.tables import TABLE_CONFIG as CFG
from ledgerloom.sources.tables import ingested_ledger, raw_ledger

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

THRESHOLD = 0.5


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say the same, its statement."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = compose(sql)
        return function

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals, for comparison across engines."""
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _r(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    """The stored clean ledger, which is what everything after cleaning reads."""
    return saved(spark, folder, "clean")


def _ledger(spark: SparkSession, folder: str) -> Ledger:
    return Ledger(_clean(spark, folder), CFG)


def _past(spark: SparkSession, folder: str) -> DataFrame:
    return history.past_lines(_clean(spark, folder), CFG)


def _scored(spark: SparkSession, folder: str, partition: str | None = None) -> DataFrame:
    table = saved(spark, folder, "scored")
    return table if partition is None else table.filter(F.col("partition") == partition)


# ---- Ledger ----------------------------------------------------------------------------------------
_RAW = "invoice, stock_code, description, quantity, invoice_date, price, customer_id, country"


@query("ledger_ingest", f"SELECT {_RAW} FROM raw_ledger")
def ledger_ingest(spark, folder):
    return ingested_ledger(spark, folder)


@query(
    "ledger_parquet_roundtrip",
    "SELECT invoice, stock_code, description, quantity, invoice_date, price, customer_id, country, is_return, "
    "round(amount, 6) AS amount, is_product FROM clean_ledger",
)
def ledger_parquet_roundtrip(spark, folder):
    return rounded(saved(spark, folder, "clean").select(*_CLEAN))


_CLEAN = [
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "price",
    "customer_id",
    "country",
    "is_return",
    "amount",
    "is_product",
]


@query(
    "validate_dates",
    f"""SELECT count(*) FILTER (invoice_date IS NULL) AS invalid_dates,
    count(*) FILTER (NOT invoice_date BETWEEN TIMESTAMP '{CFG.minimum_date}' AND TIMESTAMP '{CFG.maximum_date}')
    AS out_of_range_dates FROM raw_ledger""",
)
def validate_dates(spark, folder):
    return cleaning.date_violations(raw_ledger(spark, folder), CFG)


@query(
    "missing_customer_rate",
    "SELECT round(avg(CAST(customer_id IS NULL AS INTEGER)), 6) AS missing_customer_rate FROM raw_ledger",
)
def missing_customer_rate(spark, folder):
    return rounded(cleaning.missing_customer_rate(raw_ledger(spark, folder)))


@query(
    "exact_duplicates",
    """SELECT (SELECT count(*) FROM raw_ledger) AS raw_rows, count(*) AS distinct_rows,
    (SELECT count(*) FROM raw_ledger) - count(*) AS exact_duplicate_rows FROM distinct_lines""",
)
def exact_duplicates(spark, folder):
    return cleaning.duplicate_count(raw_ledger(spark, folder))


@query(
    "validate_numeric",
    """SELECT count(*) FILTER (NOT coalesce(isfinite(quantity), false)) AS nonfinite_quantity,
    count(*) FILTER (NOT coalesce(isfinite(price), false)) AS nonfinite_price FROM distinct_lines""",
)
def validate_numeric(spark, folder):
    return cleaning.numeric_violations(raw_ledger(spark, folder))


_QUARTILES = """(SELECT quantile_cont(quantity, 0.25) AS quantity_q1, quantile_cont(quantity, 0.75) AS quantity_q3,
    quantile_cont(price, 0.25) AS price_q1, quantile_cont(price, 0.75) AS price_q3 FROM distinct_lines)"""
_FLAGS = f"""count(*) FILTER ({oracles._outside('quantity')}) AS quantity_iqr_flagged,
    count(*) FILTER ({oracles._outside('price')}) AS price_iqr_flagged"""


@query(
    "iqr_flags",
    f"""SELECT round(min(quantity_q1), 6) AS quantity_q1, round(min(quantity_q3), 6) AS quantity_q3,
    round(min(price_q1), 6) AS price_q1, round(min(price_q3), 6) AS price_q3, {_FLAGS}
    FROM distinct_lines CROSS JOIN {_QUARTILES}""",
)
def iqr_flags(spark, folder):
    return rounded(cleaning.iqr_flags(raw_ledger(spark, folder)))


_INVALID = "(price <= 0 OR quantity = 0)"
_EXTREME = f"(abs(quantity) > {CFG.max_quantity} OR price > {CFG.max_price})"


@query(
    "invalid_lines",
    f"SELECT count(*) FILTER ({_INVALID}) AS invalid_price_or_zero_quantity FROM distinct_lines",
)
def invalid_lines(spark, folder):
    return cleaning.rejected_lines(raw_ledger(spark, folder), CFG).select("invalid_price_or_zero_quantity")


@query(
    "extreme_lines",
    f"SELECT count(*) FILTER ({_EXTREME} AND NOT {_INVALID}) AS quarantined_extremes FROM distinct_lines",
)
def extreme_lines(spark, folder):
    return cleaning.rejected_lines(raw_ledger(spark, folder), CFG).select("quarantined_extremes")


@query("quarantine", f"SELECT {_RAW} FROM distinct_lines WHERE {_EXTREME}")
def quarantine(spark, folder):
    return cleaning.quarantine(raw_ledger(spark, folder), CFG)


@query(
    "normalize_text",
    rf"""SELECT {oracles.stripped('invoice')} AS invoice, {oracles.stripped('stock_code')} AS stock_code,
    trim(regexp_replace(upper(coalesce(description, '')), '{oracles.WHITE}', ' ', 'g')) AS description,
    coalesce(country, 'Unknown') AS country, count(*) AS lines FROM raw_ledger GROUP BY ALL""",
)
def normalize_text(spark, folder):
    named = cleaning.normalize_text(raw_ledger(spark, folder))
    return named.groupBy("invoice", "stock_code", "description", "country").agg(F.count("*").alias("lines"))


@query(
    "customer_id_cast",
    """SELECT CAST(CAST(customer_id AS BIGINT) AS VARCHAR) AS customer_id, count(*) AS lines
    FROM raw_ledger GROUP BY 1""",
)
def customer_id_cast(spark, folder):
    keyed = cleaning.customer_key(raw_ledger(spark, folder))
    return keyed.groupBy("customer_id").agg(F.count("*").alias("lines"))


@query(
    "mark_returns",
    """SELECT is_return, count(*) AS lines, sum(quantity) AS units,
    round(CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE), 2) AS amount FROM clean_ledger GROUP BY is_return""",
)
def mark_returns(spark, folder):
    from ledgerloom.functions.columns import money_sum

    totals = Ledger.of_tables(spark, folder).clean.groupBy("is_return")
    return totals.agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
        F.round(money_sum(F.col("amount")), 2).alias("amount"),
    )


@query(
    "mark_products",
    "SELECT stock_code, is_product, count(*) AS lines FROM clean_ledger GROUP BY stock_code, is_product",
)
def mark_products(spark, folder):
    return _clean(spark, folder).groupBy("stock_code", "is_product").agg(F.count("*").alias("lines"))


@query(
    "clean_ledger",
    "SELECT invoice, stock_code, description, quantity, invoice_date, price, customer_id, country, is_return, "
    "round(amount, 6) AS amount, is_product FROM clean_ledger",
)
def clean_ledger(spark, folder):
    return Ledger.of_tables(spark, folder).clean.withColumn("amount", F.round("amount", 6))


@query(
    "cleaning_audit",
    f"""SELECT (SELECT count(*) FROM raw_ledger) AS raw_rows,
    (SELECT round(avg(CAST(customer_id IS NULL AS INTEGER)), 6) FROM raw_ledger) AS missing_customer_rate,
    (SELECT count(*) FROM raw_ledger) - count(*) AS exact_duplicate_rows, {_FLAGS},
    count(*) FILTER ({_INVALID}) AS invalid_price_or_zero_quantity,
    count(*) FILTER ({_EXTREME} AND NOT {_INVALID}) AS quarantined_extremes,
    (SELECT count(*) FROM clean_ledger) AS clean_rows,
    (SELECT count(*) FROM clean_ledger WHERE is_return) AS return_rows,
    (SELECT count(DISTINCT customer_id) FROM clean_ledger) AS identified_customers,
    (SELECT CAST(min(invoice_date) AS VARCHAR) FROM clean_ledger) AS min_date,
    (SELECT CAST(max(invoice_date) AS VARCHAR) FROM clean_ledger) AS max_date
    FROM distinct_lines CROSS JOIN {_QUARTILES}""",
)
def cleaning_audit(spark, folder):
    return rounded(cleaning.cleaning_audit(raw_ledger(spark, folder), CFG))


# ---- Requests --------------------------------------------------------------------------------------
_SIGNLESS = [c for c in NUMERIC_FEATURES if c not in validation.SIGNED_FEATURES]


def _mutated(table: DataFrame) -> DataFrame:
    """Feature rows as an upload would bring them: whole table plus a copy with broken values."""
    broken = table.select(
        "customer_id",
        *[
            {
                "recency": F.lit(float("nan")),
                "monetary": -F.col("monetary"),
                "affinity_home": F.col("affinity_home") + 1.5,
                "engagement": F.col("engagement") * 4,
            }
            .get(c, F.col(c))
            .alias(c)
            for c in NUMERIC_FEATURES
        ],
        F.lit(" ").alias("country"),
    )
    return table.unionByName(broken)


_SQL_MUTATED = f"""(SELECT customer_id, {', '.join(NUMERIC_FEATURES)}, country FROM features UNION ALL
    SELECT customer_id, {', '.join(
        {'recency': "CAST('nan' AS DOUBLE)", 'monetary': '-monetary', 'affinity_home': 'affinity_home + 1.5',
         'engagement': 'engagement * 4'}.get(c, c) for c in NUMERIC_FEATURES)}, ' ' FROM features)"""


@query(
    "validate_feature_rows",
    f"""SELECT count(*) AS rows, count(*) FILTER (customer_id IS NULL OR trim(customer_id) = '') AS missing_ids,
    count(*) - count(DISTINCT customer_id) AS duplicate_ids,
    count(*) FILTER ({' OR '.join(f'NOT isfinite({c})' for c in NUMERIC_FEATURES)}) AS nonfinite_values,
    count(*) FILTER ({' OR '.join(f'{c} < 0' for c in _SIGNLESS)}) AS negative_values,
    count(*) FILTER (country IS NULL OR trim(country) = '') AS empty_countries,
    count(*) FILTER ({' OR '.join(f'{c} > 1' for c in validation.SHARE_FEATURES)}) AS shares_above_one,
    count(*) FILTER (engagement > 100) AS engagement_above_100 FROM {_SQL_MUTATED}""",
)
def validate_feature_rows(spark, folder):
    table = saved(spark, folder, "modeling").select("customer_id", *FEATURES)
    return validation.feature_row_violations(_mutated(table.withColumn("frequency", F.col("frequency").cast("double"))))


@query(
    "validate_request_id",
    "SELECT invoice AS id, regexp_full_match(invoice, '[0-9]{1,32}') AS valid FROM clean_ledger GROUP BY invoice",
)
def validate_request_id(spark, folder):
    ids = _clean(spark, folder).select(F.col("invoice").alias("id")).dropDuplicates()
    return ids.withColumn("valid", validation.valid_request_id(F.col("id")))


# An id list as large as the ledger: ids repeat, some are missing, customers without a purchase are unknown.
@query(
    "validate_id_list",
    """SELECT count(*) AS rows, count(*) FILTER (customer_id IS NULL) AS missing_ids,
    count(customer_id) - count(DISTINCT customer_id) AS duplicate_ids,
    count(*) FILTER (customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM scored)) AS unknown_ids
    FROM clean_ledger""",
)
def validate_id_list(spark, folder):
    return validation.id_list_violations(_clean(spark, folder).select("customer_id"), _scored(spark, folder))


# ---- History and features --------------------------------------------------------------------------
_HISTORY = [*_CLEAN, "category"]


@query(
    "history",
    "SELECT invoice, stock_code, description, quantity, invoice_date, price, customer_id, country, is_return, "
    "round(amount, 6) AS amount, is_product, category FROM history",
)
def history_lines(spark, folder):
    return history.history(_clean(spark, folder), CFG).withColumn("amount", F.round("amount", 6)).select(*_HISTORY)


@query("modal_description", "SELECT stock_code, description, category FROM product_names")
def modal_description(spark, folder):
    return history.product_names(_past(spark, folder), CFG)


@query(
    "category_rules",
    f"""SELECT description, {oracles._category('description')} AS category, count(*) AS lines
    FROM clean_ledger GROUP BY description""",
)
def category_rules(spark, folder):
    counts = _clean(spark, folder).groupBy("description").agg(F.count("*").alias("lines"))
    return counts.withColumn("category", category_of(F.col("description"), CFG.category_rules))


@query(
    "orders",
    "SELECT customer_id, invoice, date, CAST(amount AS DOUBLE) AS amount, units FROM invoices",
)
def orders(spark, folder):
    return features.orders(_past(spark, folder))


def _profile_query(name: str, columns: list[str]) -> None:
    @query(name, f"SELECT customer_id, {_r(columns)} FROM feature_base")
    def run(spark, folder):
        return rounded(features.order_profile(_past(spark, folder), CFG).select("customer_id", *columns))


_profile_query("feat_recency_tenure", ["recency", "tenure"])
_profile_query("feat_historical_clv", ["historical_clv"])
_profile_query("feat_gap_variance", ["gap_variance"])
_profile_query("feat_recent_90d", ["orders_90d", "spend_90d"])
_profile_query("feat_frequency_trend", ["frequency_trend"])
_profile_query("feat_seasonal_concentration", ["seasonal_concentration"])
_profile_query("feat_return_rate", ["return_rate"])


@query(
    "feat_rfm",
    f"SELECT customer_id, frequency, {_r(['monetary', 'average_spend', 'basket_size'])} FROM feature_base",
)
def feat_rfm(spark, folder):
    columns = ["frequency", "monetary", "average_spend", "basket_size"]
    return rounded(features.order_profile(_past(spark, folder), CFG).select("customer_id", *columns))


@query("feat_country", "SELECT customer_id, country FROM country_features")
def feat_country(spark, folder):
    return features.last_country(_past(spark, folder))


@query("sku_median_price", "SELECT stock_code, round(median_price, 6) AS median_price, product_lines FROM product_prices")
def sku_median_price(spark, folder):
    return rounded(features.product_prices(history.product_purchases(_past(spark, folder))))


@query(
    "sku_popularity_catalog",
    "SELECT stock_code, product_lines, round(popularity, 9) AS popularity FROM product_popularity",
)
def sku_popularity_catalog(spark, folder):
    return rounded(features.product_popularity(history.product_purchases(_past(spark, folder))), 9)


def _product_query(name: str, columns: list[str], digits: int = 6) -> None:
    @query(name, f"SELECT customer_id, {_r(columns, digits)} FROM product_features")
    def run(spark, folder):
        return rounded(features.product_profile(_past(spark, folder), CFG).select("customer_id", *columns), digits)


_product_query("feat_discount_proxy", ["discount_proxy"])
_product_query("feat_sku_popularity", ["sku_popularity"], 9)
_product_query("feat_unique_products", ["unique_products"])
_product_query("feat_affinity", ["affinity_" + c for c in CATEGORIES])


@query("feat_engagement", "SELECT customer_id, round(engagement, 6) AS engagement FROM features")
def feat_engagement(spark, folder):
    profile = features.order_profile(_past(spark, folder), CFG)
    return rounded(profile.select("customer_id", features.engagement().alias("engagement")))


_FLOATS = [c for c in NUMERIC_FEATURES if c != "frequency"]
_FEATURE_SELECT = f"customer_id, frequency, {_r(_FLOATS)}, country"


@query("customer_features", f"SELECT {_FEATURE_SELECT} FROM features")
def customer_features(spark, folder):
    return rounded(_ledger(spark, folder).features())


@query("feature_leakage_check", "SELECT CAST(0 AS BIGINT) AS changed_rows")
def feature_leakage_check(spark, folder):
    """Features from the full ledger and from one whose later lines are changed: no row may differ."""
    clean = _clean(spark, folder)
    later = F.col("invoice_date") >= F.lit(CFG.cutoff).cast("timestamp_ntz")
    changed = clean.withColumn("amount", F.when(later, F.col("amount") * 3).otherwise(F.col("amount"))).withColumn(
        "quantity", F.when(later, F.col("quantity") + 7).otherwise(F.col("quantity"))
    )
    before = features.customer_features(clean, CFG)
    after = features.customer_features(changed, CFG)
    moved = before.exceptAll(after).unionByName(after.exceptAll(before))
    return moved.agg(F.count("*").alias("changed_rows"))


# ---- Labels and sequences --------------------------------------------------------------------------
@query(
    "label_window_complete",
    f"""SELECT max(invoice_date) AS last_date, {oracles.WINDOW_END} AS window_end,
    max(invoice_date) >= {oracles.WINDOW_END} AS complete FROM clean_ledger""",
)
def label_window_complete(spark, folder):
    return labels.window_coverage(_clean(spark, folder), CFG)


@query(
    "future_purchases",
    "SELECT invoice, stock_code, description, quantity, invoice_date, price, customer_id, country, is_return, "
    "round(amount, 6) AS amount, is_product FROM future",
)
def future_purchases(spark, folder):
    return labels.future_purchases(_clean(spark, folder), CFG).withColumn("amount", F.round("amount", 6))


def _targets(spark, folder) -> DataFrame:
    ledger = _ledger(spark, folder)
    customers = features.orders(history.past_lines(ledger.clean, CFG)).select("customer_id").dropDuplicates()
    return labels.customer_targets(ledger.clean, customers, CFG)


def _label_query(name: str, columns: str) -> None:
    @query(name, f"SELECT customer_id, {columns} FROM targets")
    def run(spark, folder):
        return _targets(spark, folder).select("customer_id", *columns.split(", "))


_label_query("label_churn", "churn")
_label_query("label_clv", "clv_90d")
_label_query("label_next_days", "next_days")
_label_query("label_next_category", "next_category")
_label_query("customer_targets", "churn, clv_90d, next_days, next_category")


@query("modeling_table", f"SELECT {_FEATURE_SELECT}, churn, clv_90d, next_days, next_category FROM modeling")
def modeling_table(spark, folder):
    return rounded(_ledger(spark, folder).modeling())


@query(
    "sequence_events",
    f"SELECT customer_id, invoice, date, amount, gap, age, {_r(CATEGORIES)} FROM events_seq",
)
def sequence_events(spark, folder):
    return rounded(sequences.sequence_events(_clean(spark, folder), CFG))


@query(
    "sequence_last_n",
    f"SELECT customer_id, step, invoice, date, amount, gap, age, {_r(CATEGORIES)} FROM last_events",
)
def sequence_last_n(spark, folder):
    last = sequences.last_events(_clean(spark, folder), CFG)
    return rounded(last.withColumn("step", F.col("step").cast("long")))


_SEQUENCE_SQL = (
    f"""SELECT s.customer_id, CAST(s.step AS INTEGER) AS step,
    CAST(least(coalesce(n.events, 1), {CFG.sequence_length}) AS INTEGER) AS length,
    {', '.join(f"round(coalesce(CAST({e} AS FLOAT), 0), 4) AS {n}" for n, e in
               [('amount_log', 'ln(1 + amount) / 10'), ('gap_log', 'ln(1 + gap) / 7'), ('age_log', 'ln(1 + age) / 7'),
                *[(c, 'e.' + c) for c in CATEGORIES]])}
    FROM (SELECT customer_id, unnest(generate_series(0, {CFG.sequence_length - 1})) AS step FROM features) s
    LEFT JOIN last_events e ON s.customer_id = e.customer_id AND s.step = e.step
    LEFT JOIN (SELECT customer_id, count(*) AS events FROM event_base GROUP BY customer_id) n
         ON s.customer_id = n.customer_id"""
)


def _long_cells(table):
    cells = sequences.sequence_cells(table)
    return cells.select("customer_id", "step", "length", *[F.round(c, 4).alias(c) for c in sequences.VECTOR])


@query("sequence_vectors", _SEQUENCE_SQL)
def sequence_vectors(spark, folder):
    clean = _clean(spark, folder)
    customers = features.orders(history.past_lines(clean, CFG)).select("customer_id").dropDuplicates()
    return _long_cells(sequences.customer_sequences(clean, customers, CFG))


@query("sequence_sink", _SEQUENCE_SQL)
def sequence_sink(spark, folder):
    """Sequences stored as nested arrays, read back and laid out."""
    from ledgerloom.session import materialize

    clean = saved(spark, folder, "clean")
    table = sequences.customer_sequences(clean, saved(spark, folder, "modeling"), CFG)
    return _long_cells(materialize(table, "sequences"))


# ---- Partitions ------------------------------------------------------------------------------------
@query("stratified_split", "SELECT customer_id, churn, partition FROM split")
def stratified_split(spark, folder):
    return splits.stratified_split(_targets(spark, folder), CFG)


@query("stratified_folds", "SELECT customer_id, churn, fold FROM folds")
def stratified_folds(spark, folder):
    return splits.stratified_folds(_scored(spark, folder).select("customer_id", "churn", "partition"), CFG)


@query(
    "balanced_class_weights",
    """SELECT next_category, count(*) AS rows,
    round(CAST(sum(count(*)) OVER () AS DOUBLE) / (count(*) OVER () * count(*)), 6) AS weight
    FROM train GROUP BY next_category""",
)
def balanced_class_weights(spark, folder):
    return rounded(splits.class_weights(_scored(spark, folder, "train"), "next_category"))


@query(
    "partition_coverage",
    """SELECT CAST(count(*) AS BIGINT) AS customers, CAST((SELECT count(*) FROM split) AS BIGINT) AS placements,
    CAST(0 AS BIGINT) AS violations FROM targets""",
)
def partition_coverage(spark, folder):
    modeling = saved(spark, folder, "modeling")
    return splits.partition_coverage(modeling, splits.stratified_split(modeling, CFG))


@query(
    "validated_one_to_one_join",
    """SELECT customer_id, count(*) FILTER (side = 'l') AS left_rows, count(*) FILTER (side = 'r') AS right_rows FROM (
    SELECT customer_id, 'l' AS side FROM scored UNION ALL SELECT customer_id, 'r' FROM transactions)
    GROUP BY customer_id""",
)
def validated_one_to_one_join(spark, folder):
    """Scored customers against invoices: the right side repeats, and the counts say where."""
    scored = _scored(spark, folder)
    invoices = serving.invoice_aggregates(saved(spark, folder, "clean"), scored, CFG)
    return metrics.one_to_one(scored, invoices, "customer_id")


@query(
    "median_impute",
    f"""SELECT {', '.join(f"round(quantile_cont({c}, 0.5), 6) AS {c}" for c in NUMERIC_FEATURES)} FROM train""",
)
def median_impute(spark, folder):
    from ledgerloom.operators.preprocessing import train_medians

    return rounded(train_medians(_scored(spark, folder, "train"), NUMERIC_FEATURES))


@query(
    "standard_scale",
    f"""SELECT customer_id, {', '.join(
        f"round(({c} - (SELECT avg({c}) FROM train)) / (SELECT CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) "
        f"ELSE 1 END FROM train), 6) AS z_{c}" for c in ('recency', 'frequency', 'monetary', 'tenure'))}
    FROM partitioned""",
)
def standard_scale(spark, folder):
    columns = ["recency", "frequency", "monetary", "tenure"]
    table = _scored(spark, folder)
    scaling = segments.fit_scaling(table.filter(F.col("partition") == "train"), columns)
    scaled = segments.standardize(table, scaling)
    return rounded(scaled.select("customer_id", *[f"z_{c}" for c in columns]))


# ---- Segments --------------------------------------------------------------------------------------
@query(
    "segment_inputs",
    f"""SELECT customer_id, {', '.join(
        f"round((ln(1 + {c}) - (SELECT avg(ln(1 + {c})) FROM train)) / (SELECT stddev_pop(ln(1 + {c})) FROM train), 6)"
        f" AS z_{c}" for c in SEGMENT_COLUMNS)} FROM partitioned""",
)
def segment_inputs(spark, folder):
    return rounded(
        segments.segment_inputs(_scored(spark, folder)).select("customer_id", *[f"z_{c}" for c in SEGMENT_COLUMNS])
    )


STEPS["points"] = f"""
SELECT customer_id, cluster, {', '.join(
    f"(ln(1 + {c}) - (SELECT avg(ln(1 + {c})) FROM train)) / (SELECT stddev_pop(ln(1 + {c})) FROM train) AS z_{c}"
    for c in SEGMENT_COLUMNS)}, partition FROM base_scores"""
STEPS["sampled"] = f"""
SELECT * FROM points WHERE partition = 'train'
ORDER BY md5('{CFG.seed}:silhouette:' || customer_id) LIMIT {CFG.silhouette_sample}"""
_DISTANCE = "sqrt(" + " + ".join(f"(a.z_{c} - b.z_{c}) ** 2" for c in SEGMENT_COLUMNS) + ")"
STEPS["mean_distances"] = f"""
SELECT a.customer_id, a.cluster, b.cluster AS other,
       sum({_DISTANCE}) / (count(*) - CAST(a.cluster = b.cluster AS INTEGER)) AS d, count(*) AS n
FROM sampled a CROSS JOIN sampled b GROUP BY a.customer_id, a.cluster, b.cluster"""


@query(
    "silhouette",
    """SELECT round(avg(CASE WHEN n = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette,
    count(*) AS sampled FROM (
      SELECT customer_id, max(d) FILTER (other = cluster) AS a, min(d) FILTER (other <> cluster) AS b,
             max(n) FILTER (other = cluster) AS n FROM mean_distances GROUP BY customer_id)""",
)
def silhouette(spark, folder):
    points = segments.segment_inputs(_scored(spark, folder)).filter(F.col("partition") == "train")
    return rounded(segments.silhouette(points, [f"z_{c}" for c in SEGMENT_COLUMNS], "cluster", CFG))


_SQUARE = " + ".join(f"p.z_{c} * p.z_{c}" for c in SEGMENT_COLUMNS)
STEPS["cluster_facts"] = f"""
SELECT cluster, count(*) AS n, {', '.join(f'avg(z_{c}) AS z_{c}' for c in SEGMENT_COLUMNS)}, avg({_SQUARE}) AS square
FROM points p WHERE partition = 'train' GROUP BY cluster"""
STEPS["cluster_reach"] = f"""
SELECT p.customer_id, p.cluster, s.cluster AS other, s.n,
       greatest({_SQUARE} - 2 * ({' + '.join(f'p.z_{c} * s.z_{c}' for c in SEGMENT_COLUMNS)}) + s.square, 0) AS d
FROM points p CROSS JOIN cluster_facts s WHERE p.partition = 'train'"""


@query(
    "silhouette_all",
    """SELECT round(avg(CASE WHEN n > 1 AND greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette,
    count(*) AS rows FROM (
      SELECT customer_id, max(d * n / (n - 1)) FILTER (other = cluster AND n > 1) AS a, min(d) FILTER (other <> cluster) AS b,
             max(n) FILTER (other = cluster) AS n FROM cluster_reach GROUP BY customer_id)""",
)
def silhouette_all(spark, folder):
    """The measure that chooses the number of clusters, over every train row."""
    points = segments.segment_inputs(_scored(spark, folder)).filter(F.col("partition") == "train")
    return rounded(segments.silhouette_all(points, [f"z_{c}" for c in SEGMENT_COLUMNS], "cluster"))


STEPS["centroids"] = f"""
SELECT cluster, {', '.join(f'avg(z_{c}) AS z_{c}' for c in SEGMENT_COLUMNS)}
FROM points WHERE partition = 'train' GROUP BY cluster"""
STEPS["scatters"] = f"""
SELECT a.cluster, avg({_DISTANCE}) AS s FROM points a JOIN centroids b USING (cluster)
WHERE a.partition = 'train' GROUP BY a.cluster"""


@query(
    "davies_bouldin",
    f"""SELECT round(avg(worst), 6) AS davies_bouldin, CAST(count(*) AS INTEGER) AS clusters FROM (
    SELECT a.cluster, max((x.s + y.s) / {_DISTANCE}) AS worst
    FROM centroids a JOIN centroids b ON a.cluster <> b.cluster
         JOIN scatters x ON x.cluster = a.cluster JOIN scatters y ON y.cluster = b.cluster GROUP BY a.cluster)""",
)
def davies_bouldin(spark, folder):
    points = segments.segment_inputs(_scored(spark, folder)).filter(F.col("partition") == "train")
    return rounded(segments.davies_bouldin(points, [f"z_{c}" for c in SEGMENT_COLUMNS], "cluster"))


@query("segment_profiles_train", f"SELECT cluster, {_r(SEGMENT_COLUMNS)} FROM profiles")
def segment_profiles_train(spark, folder):
    return rounded(segments.segment_profiles(_scored(spark, folder, "train")))


@query("segment_names", "SELECT cluster, segment FROM names")
def segment_names(spark, folder):
    return segments.segment_names(_scored(spark, folder, "train"))


@query("value_tier", "SELECT customer_id, value_tier FROM scored")
def value_tier(spark, folder):
    table = saved(spark, folder, "partitioned")
    cuts = segments.fit_value_tiers(table.filter(F.col("partition") == "train"))
    return segments.value_tiers(table, cuts).select("customer_id", "value_tier")


# ---- Evaluation ------------------------------------------------------------------------------------
STEPS["test_confusion"] = f"""
SELECT count(*) FILTER (churn = 0 AND churn_probability < {THRESHOLD}) AS tn,
       count(*) FILTER (churn = 0 AND churn_probability >= {THRESHOLD}) AS fp,
       count(*) FILTER (churn = 1 AND churn_probability < {THRESHOLD}) AS fn,
       count(*) FILTER (churn = 1 AND churn_probability >= {THRESHOLD}) AS tp
FROM test_scores"""


@query(
    "classification_metrics",
    """SELECT tn, fp, fn, tp, round((tn + tp) / (tn + fp + fn + tp), 6) AS accuracy,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 6) AS precision, round(coalesce(tp / nullif(tp + fn, 0), 0), 6) AS recall,
    round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM test_confusion""",
)
def classification_metrics(spark, folder):
    test = _scored(spark, folder, "test")
    return rounded(metrics.classification_metrics(test, "churn", "churn_probability", F.lit(THRESHOLD)))


@query(
    "roc_auc",
    """SELECT round(sum(CASE WHEN a.churn_probability > b.churn_probability THEN 1.0
                      WHEN a.churn_probability = b.churn_probability THEN 0.5 ELSE 0 END) / count(*), 6) AS roc_auc,
    count(DISTINCT a.customer_id) AS pos, count(DISTINCT b.customer_id) AS neg
    FROM test_scores a CROSS JOIN test_scores b WHERE a.churn = 1 AND b.churn = 0""",
)
def roc_auc(spark, folder):
    return rounded(metrics.roc_auc(_scored(spark, folder, "test"), "churn", "churn_probability"))


@query(
    "confusion_matrix",
    """SELECT 0 AS actual, 0 AS predicted, tn AS customers FROM test_confusion UNION ALL
    SELECT 0, 1, fp FROM test_confusion UNION ALL SELECT 1, 0, fn FROM test_confusion UNION ALL
    SELECT 1, 1, tp FROM test_confusion""",
)
def confusion_matrix(spark, folder):
    test = _scored(spark, folder, "test")
    return metrics.confusion_matrix(test, "churn", "churn_probability", F.lit(THRESHOLD))


STEPS["cuts"] = """
SELECT t / 100.0::DOUBLE AS threshold, sum(CAST(churn = 1 AND churn_probability >= t / 100.0::DOUBLE AS INTEGER)) AS tp,
       sum(CAST(churn = 0 AND churn_probability >= t / 100.0::DOUBLE AS INTEGER)) AS fp,
       sum(CAST(churn = 1 AND churn_probability < t / 100.0::DOUBLE AS INTEGER)) AS fn
FROM validation_scores CROSS JOIN (SELECT unnest(generate_series(5, 95)) AS t) GROUP BY t"""


@query(
    "choose_threshold",
    f"""SELECT coalesce(max(threshold), 0) AS threshold, round(max(f1), 6) AS f1 FROM (
    SELECT threshold, 2 * tp / (2 * tp + fp + fn) AS f1,
           row_number() OVER (ORDER BY 2 * tp / (2 * tp + fp + fn) DESC, threshold DESC) AS pick
    FROM cuts WHERE tp / (tp + fn) >= {CFG.recall_target}) WHERE pick = 1""",
)
def choose_threshold(spark, folder):
    validation_rows = _scored(spark, folder, "validation")
    return rounded(metrics.choose_threshold(validation_rows, "churn", "churn_probability", CFG.recall_target))


STEPS["value_errors"] = """
SELECT customer_id, clv_90d AS actual, predicted_clv_90d AS predicted, predicted_clv_90d - clv_90d AS error,
       abs(predicted_clv_90d - clv_90d) AS absolute_error, (predicted_clv_90d - clv_90d) ** 2 AS squared_error
FROM test_scores"""
_REGRESSION = """round(avg(absolute_error), 4) AS mae, round(avg(squared_error), 2) AS mse,
    round(sqrt(avg(squared_error)), 4) AS rmse,
    round(1 - sum(squared_error) / (SELECT sum((v.actual - m.a) ** 2) FROM value_errors v,
          (SELECT avg(actual) AS a FROM value_errors) m), 6) AS r2"""
_REGRESSION_DIGITS = {"mae": 4, "mse": 2, "rmse": 4, "r2": 6}


def _value_errors(spark, folder) -> DataFrame:
    rows = metrics.error_rows(_scored(spark, folder, "test"), "clv_90d", "predicted_clv_90d")
    return rows.select("customer_id", "actual", "predicted", "error", "absolute_error", "squared_error")


def _digits(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("regression_metrics", f"SELECT {_REGRESSION} FROM value_errors")
def regression_metrics(spark, folder):
    test = _scored(spark, folder, "test")
    return _digits(metrics.regression_metrics(test, "clv_90d", "predicted_clv_90d"), _REGRESSION_DIGITS)


STEPS["label_scores"] = """
SELECT label, count(*) FILTER (label = next_category AND label = predicted_category) AS hits,
       count(*) FILTER (label = next_category) + count(*) FILTER (label = predicted_category) AS mentions
FROM test_scores, (SELECT next_category AS label FROM test_scores UNION SELECT predicted_category FROM test_scores)
GROUP BY label"""


@query(
    "macro_f1_accuracy",
    """SELECT (SELECT round(avg(CAST(next_category = predicted_category AS INTEGER)), 6) FROM test_scores) AS accuracy,
    round(avg(2 * hits / mentions), 6) AS macro_f1 FROM label_scores""",
)
def macro_f1_accuracy(spark, folder):
    return rounded(metrics.macro_f1(_scored(spark, folder, "test"), "next_category", "predicted_category"))


_ERROR_COLUMNS = ("actual", "predicted", "error", "absolute_error", "squared_error")


@query("error_rows", f"SELECT customer_id, {_r(_ERROR_COLUMNS, 3)} FROM value_errors")
def error_rows(spark, folder):
    return rounded(_value_errors(spark, folder), 3)


@query(
    "error_summary",
    f"""SELECT {_REGRESSION}, round(median(absolute_error), 4) AS median_absolute_error,
    round(avg(error), 4) AS mean_error,
    round((SELECT sum(squared_error) FROM (SELECT squared_error FROM value_errors ORDER BY 1 DESC LIMIT 10))
          / sum(squared_error), 6) AS worst_10_squared_error_share, count(*) AS count FROM value_errors""",
)
def error_summary(spark, folder):
    digits = {**_REGRESSION_DIGITS, "median_absolute_error": 4, "mean_error": 4, "worst_10_squared_error_share": 6}
    return _digits(metrics.error_summary(_value_errors(spark, folder)), digits)


@query(
    "churn_mistakes",
    """SELECT round((fp + fn) / (tn + fp + fn + tp), 6) AS error_rate, fp + fn AS incorrect, tn + tp AS correct,
    fp AS false_positives, fn AS false_negatives FROM test_confusion""",
)
def churn_mistakes(spark, folder):
    test = _scored(spark, folder, "test")
    return rounded(metrics.churn_mistakes(test, "churn", "churn_probability", F.lit(THRESHOLD)))


@query(
    "largest_errors",
    f"SELECT customer_id, {_r(_ERROR_COLUMNS, 3)} FROM value_errors ORDER BY absolute_error DESC, customer_id LIMIT 15",
)
def largest_errors(spark, folder):
    return rounded(metrics.largest_errors(_value_errors(spark, folder)), 3)


@query(
    "error_histogram",
    """SELECT 'error' AS feature, CAST(least(floor((error - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin,
    count(*) AS customers FROM value_errors, (SELECT min(error) AS lo, max(error) AS hi FROM value_errors) GROUP BY 2""",
)
def error_histogram(spark, folder):
    return serving.error_histogram(_value_errors(spark, folder))


@query(
    "anomaly_flag_rate",
    "SELECT round(avg(CAST(anomaly AS INTEGER)), 6) AS flag_rate, count(*) AS customers FROM test_scores",
)
def anomaly_flag_rate(spark, folder):
    test = _scored(spark, folder, "test")
    return rounded(test.agg(F.avg(F.col("anomaly").cast("int")).alias("flag_rate"), F.count("*").alias("customers")))


# ---- Serving ---------------------------------------------------------------------------------------
_SCORES = [
    "churn_probability",
    "predicted_clv_90d",
    "purchase_probability",
    "predicted_next_days",
    "anomaly_score",
    "priority",
]
_SCORED_FLOATS = [*_FLOATS, "clv_90d", "next_days", *_SCORES]
_SCORED_OTHERS = [
    "customer_id",
    "frequency",
    "country",
    "churn",
    "next_category",
    "predicted_category",
    "anomaly",
    "segment",
    "cluster",
    "value_tier",
    "partition",
]
_SCORED_SELECT = f"{', '.join(_SCORED_OTHERS)}, {_r(_SCORED_FLOATS)}"


def _record(df: DataFrame) -> DataFrame:
    return rounded(df.select(*_SCORED_OTHERS, *_SCORED_FLOATS))


@query("rule_scored_snapshot", f"SELECT {_SCORED_SELECT} FROM scored")
def rule_scored_snapshot(spark, folder):
    return _record(rule_scores(saved(spark, folder, "partitioned"), CFG))


@query(
    "retention_priorities",
    f"""SELECT customer_id, country, segment, {_r(['churn_probability', 'predicted_clv_90d', 'priority'])}
    FROM scored ORDER BY priority DESC, customer_id LIMIT 12""",
)
def retention_priorities(spark, folder):
    return rounded(serving.retention_priorities(_scored(spark, folder)))


@query(
    "customer_list",
    f"SELECT {_SCORED_SELECT} FROM scored WHERE value_tier = 'High' ORDER BY priority DESC, customer_id",
)
def customer_list(spark, folder):
    return _record(serving.customer_list(_scored(spark, folder), value_tier="High"))


@query("customer_lookup", f"SELECT {_SCORED_SELECT} FROM scored WHERE customer_id = '7'")
def customer_lookup(spark, folder):
    return _record(serving.customer_lookup(_scored(spark, folder), "7"))


@query("batch_lookup", f"SELECT {_SCORED_SELECT} FROM scored WHERE customer_id IN (SELECT customer_id FROM future)")
def batch_lookup(spark, folder):
    """The saved records of everybody who bought in the outcome window."""
    buyers = labels.future_purchases(saved(spark, folder, "clean"), CFG).select("customer_id").dropDuplicates()
    scored = _scored(spark, folder)
    known = buyers.join(scored.select("customer_id"), "customer_id", "left_semi")
    return _record(serving.batch_lookup(scored, known))


@query("invoice_aggregates", "SELECT * FROM transactions")
def invoice_aggregates(spark, folder):
    return serving.invoice_aggregates(saved(spark, folder, "clean"), _scored(spark, folder), CFG)


def _trend(spark, folder) -> DataFrame:
    clean = saved(spark, folder, "clean")
    return serving.revenue_trend(serving.invoice_aggregates(clean, _scored(spark, folder), CFG))


@query("revenue_trend", "SELECT month, round(revenue, 2) AS revenue FROM trend")
def revenue_trend(spark, folder):
    return rounded(_trend(spark, folder), 2)


@query(
    "revenue_forecast",
    """SELECT CAST(CAST(CAST(last AS DATE) + to_months(CAST(a AS INTEGER)) AS DATE) AS VARCHAR) AS month, round(revenue, 2) AS revenue FROM (
    SELECT max(month) AS last, avg(revenue) AS revenue FROM (SELECT * FROM trend ORDER BY month DESC LIMIT 3)),
    (SELECT unnest(generate_series(1, 3)) AS a)""",
)
def revenue_forecast(spark, folder):
    return rounded(serving.revenue_forecast(_trend(spark, folder)), 2)


@query(
    "catalog",
    "SELECT stock_code, description, category, orders, round(typical_price, 6) AS typical_price FROM catalog",
)
def catalog(spark, folder):
    return rounded(serving.catalog(_clean(spark, folder), CFG))


@query("purchased_products", "SELECT DISTINCT customer_id, stock_code FROM products")
def purchased_products(spark, folder):
    return serving.purchased_products(_clean(spark, folder), CFG)


STEPS["shelves"] = """
SELECT customer_id, c.*, row_number() OVER (PARTITION BY customer_id ORDER BY orders DESC, c.stock_code) AS position
FROM scored s JOIN catalog c ON c.category = s.predicted_category
     OR s.predicted_category NOT IN (SELECT category FROM catalog)
WHERE NOT EXISTS (SELECT 1 FROM products p WHERE p.customer_id = s.customer_id AND p.stock_code = c.stock_code)"""


@query(
    "recommendations",
    """SELECT customer_id, CAST(position AS INTEGER) AS position, stock_code, description, category, orders,
    round(typical_price, 6) AS typical_price FROM shelves WHERE position <= 5""",
)
def recommendations(spark, folder):
    clean = saved(spark, folder, "clean")
    items = saved(spark, folder, "catalog")
    bought = serving.purchased_products(clean, CFG)
    return rounded(serving.recommendations(_scored(spark, folder), items, bought))


@query(
    "overview_kpis",
    f"""SELECT count(*) AS customers, count(*) FILTER (churn_probability >= {THRESHOLD}) AS high_risk,
    round(sum(predicted_clv_90d), 2) AS expected_spend, count(DISTINCT segment) AS segments FROM scored""",
)
def overview_kpis(spark, folder):
    return rounded(serving.overview_kpis(_scored(spark, folder), F.lit(THRESHOLD)), 2)


_TIERS = ("High", "Medium")
_COUNTRIES = tuple(f"NATION_{i}" for i in range(5))


@query(
    "filtered_segments",
    f"""SELECT count(*) AS customers, round(avg(churn_probability), 6) AS average_risk,
    round(sum(monetary), 2) AS gross_spend FROM scored
    WHERE value_tier IN {_TIERS} AND country IN {_COUNTRIES}""",
)
def filtered_segments(spark, folder):
    chosen = serving.select_customers(_scored(spark, folder), countries=_COUNTRIES, tiers=_TIERS)
    return _digits(serving.selection_kpis(chosen), {"average_risk": 6, "gross_spend": 2})


@query(
    "segment_mix",
    """SELECT segment, count(*) AS customers, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 6) AS share
    FROM scored GROUP BY segment""",
)
def segment_mix(spark, folder):
    return rounded(serving.segment_mix(_scored(spark, folder)))


@query(
    "segment_profiles",
    """SELECT segment, count(*) AS customers, round(median(recency), 2) AS median_recency,
    round(median(frequency), 2) AS median_orders, round(median(monetary), 2) AS median_spend,
    round(avg(churn_probability), 2) AS average_risk FROM scored GROUP BY segment""",
)
def segment_profiles(spark, folder):
    return serving.segment_summary(_scored(spark, folder))


@query(
    "risk_histogram",
    """SELECT 'churn_probability' AS feature,
    CAST(least(floor(churn_probability / ((1.0::DOUBLE - 0) / 25)), 24) AS INTEGER) AS bin, count(*) AS customers
    FROM scored GROUP BY 2""",
)
def risk_histogram(spark, folder):
    return serving.risk_histogram(_scored(spark, folder))


@query(
    "customer_card",
    f"""SELECT customer_id, '{CFG.cutoff}' AS prediction_date, country, segment,
    format('{{:.1f}}%', churn_probability * 100) AS churn_risk,
    'GBP ' || format('{{:,.2f}}', predicted_clv_90d) AS expected_spend,
    format('{{:.1f}}%', purchase_probability * 100) AS purchase_chance FROM scored""",
)
def customer_card(spark, folder):
    return serving.customer_card(_scored(spark, folder), CFG)


@query(
    "representatives",
    f"""(SELECT 'low' AS kind, customer_id FROM scored ORDER BY churn_probability, customer_id LIMIT 1) UNION ALL
    (SELECT 'borderline', customer_id FROM scored ORDER BY abs(churn_probability - {THRESHOLD}), customer_id LIMIT 1)
    UNION ALL (SELECT 'high', customer_id FROM scored ORDER BY churn_probability DESC, customer_id DESC LIMIT 1)""",
)
def representatives(spark, folder):
    return serving.representatives(_scored(spark, folder), F.lit(THRESHOLD))


# ---- Descriptive -----------------------------------------------------------------------------------
@query(
    "feature_summary",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
        round(CAST(min({c}) AS DOUBLE), 4) AS min, round(CAST(max({c}) AS DOUBLE), 4) AS max,
        round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50,
        round(quantile_cont({c}, 0.75), 4) AS q75 FROM modeling"""
        for c in eda.DESCRIBED
    ),
)
def feature_summary(spark, folder):
    return rounded(eda.feature_summary(saved(spark, folder, "modeling")), 4)


@query(
    "feature_correlations",
    f"""SELECT feature_x, feature_y, round(correlation, 6) AS correlation FROM (SELECT unnest([{', '.join(
        f"{{'feature_x': '{a}', 'feature_y': '{b}', 'correlation': "
        + (f"CASE WHEN stddev_pop({a}) > 0 THEN 1.0::DOUBLE END" if a == b else f"corr({a}, {b})")
        + "}" for a in eda.DESCRIBED for b in eda.DESCRIBED)}], recursive := true) FROM modeling)""",
)
def feature_correlations(spark, folder):
    return rounded(eda.feature_correlations(saved(spark, folder, "modeling")))


@query("vif")
def vif(spark, folder):
    return rounded(eda.vif(_scored(spark, folder, "train")))


def _sql_histogram(name: str, value: str, bins: int) -> str:
    return f"""SELECT '{name}' AS feature, CAST(least(floor(({value} - lo) / ((hi - lo) / {bins})), {bins - 1}) AS INTEGER)
    AS bin, count(*) AS customers
    FROM modeling, (SELECT min({value}) AS lo, max({value}) AS hi FROM modeling) GROUP BY 2"""


@query(
    "rfm_histograms",
    " UNION ALL ".join(
        [
            _sql_histogram("recency", "recency", 35),
            _sql_histogram("frequency", "ln(1 + frequency)", 35),
            _sql_histogram("monetary", "ln(1 + monetary)", 35),
        ]
    ),
)
def rfm_histograms(spark, folder):
    return eda.rfm_histograms(saved(spark, folder, "modeling"))


@query(
    "monthly_net_revenue",
    """SELECT CAST(CAST(date_trunc('month', invoice_date) AS DATE) AS VARCHAR) AS month,
    round(CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE), 2) AS net_revenue FROM past GROUP BY 1""",
)
def monthly_net_revenue(spark, folder):
    return rounded(eda.monthly_net_revenue(_clean(spark, folder), CFG), 2)


@query(
    "top_countries",
    """SELECT country, round(CAST(sum(CAST(amount AS DECIMAL(18,6))) AS DOUBLE), 2) AS net_spend
    FROM past GROUP BY country ORDER BY 2 DESC, 1 LIMIT 10""",
)
def top_countries(spark, folder):
    return rounded(eda.top_countries(_clean(spark, folder), CFG), 2)


# ---- Stored tables ---------------------------------------------------------------------------------
@query("processed_table", f"SELECT {_FEATURE_SELECT} FROM features")
def processed_table(spark, folder):
    return rounded(store.processed_table("features", saved(spark, folder, "modeling"), _scored(spark, folder)))


@query(
    "dataset_preview",
    f"SELECT {_FEATURE_SELECT} FROM features ORDER BY customer_id LIMIT 100",
)
def dataset_preview(spark, folder):
    return rounded(store.dataset_preview(saved(spark, folder, "modeling"), CFG)[1])


@query(
    "dataset_description",
    f"""SELECT count(*) AS rows, {len(FEATURES)} AS feature_count, '{CFG.cutoff}' AS cutoff,
    {CFG.horizon_days} AS horizon_days, '{','.join(FEATURES)}' AS feature_columns,
    '{','.join(TARGETS)}' AS target_columns FROM modeling""",
)
def dataset_description(spark, folder):
    return store.dataset_preview(saved(spark, folder, "modeling"), CFG)[0]


@query(
    "snapshot_fingerprint",
    """SELECT count(*) AS rows, CAST(sum(CAST(CAST('0x' || substr(md5(concat_ws('~',
      CAST(churn AS VARCHAR), format('{:.6f}', clv_90d), customer_id, next_category, format('{:.6f}', next_days)
    )), 1, 8) AS BIGINT) AS DECIMAL(38,0))) AS VARCHAR) AS digest FROM targets""",
)
def snapshot_fingerprint(spark, folder):
    return store.fingerprint(saved(spark, folder, "modeling").select("customer_id", *TARGETS))


@query(
    "snapshot_tables",
    f"""SELECT customer_id, '{CFG.cutoff}' AS as_of, cluster AS segment_id, round(churn_probability, 6) AS churn_probability,
    round(predicted_clv_90d, 6) AS predicted_clv_90d FROM scored""",
)
def snapshot_tables(spark, folder):
    tables = store.snapshot_tables(_scored(spark, folder), saved(spark, folder, "clean"), CFG)
    return rounded(tables["predictions"].drop("payload"))


@query("snapshot_segments", "SELECT DISTINCT cluster AS segment_id, segment AS name FROM scored")
def snapshot_segments(spark, folder):
    return store.snapshot_tables(_scored(spark, folder), saved(spark, folder, "clean"), CFG)["segments"]
