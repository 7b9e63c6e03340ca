"""Engine configuration: one frozen object passed to every operator."""

from __future__ import annotations

from dataclasses import dataclass, field

# ---- Fixed values: names and patterns that define the data contract ----------------
LEDGER_HEADER = (
    "Invoice",
    "StockCode",
    "Description",
    "Quantity",
    "InvoiceDate",
    "Price",
    "Customer ID",
    "Country",
)
LEDGER_COLUMNS = (
    "invoice",
    "stock_code",
    "description",
    "quantity",
    "invoice_date",
    "price",
    "customer_id",
    "country",
)
CATEGORIES = ("home", "kitchen", "seasonal", "accessories", "other")
CATEGORY_RULES = (
    ("home", "HEART|CANDLE|LANTERN|FRAME|CLOCK|CUSHION"),
    ("kitchen", "MUG|CUP|PLATE|BOWL|KITCHEN|TEA|CAKE"),
    ("seasonal", "CHRISTMAS|XMAS|EASTER|SANTA|HALLOWEEN"),
    ("accessories", "BAG|NECKLACE|BRACELET|PURSE|RING"),
)
PRODUCT_CODE_PATTERN = r"^\d{5}[A-Z]*$"
NUMERIC_FEATURES = (
    "recency",
    "frequency",
    "monetary",
    "average_spend",
    "historical_clv",
    "basket_size",
    "frequency_trend",
    "gap_variance",
    "seasonal_concentration",
    "return_rate",
    "discount_proxy",
    "engagement",
    "tenure",
    "orders_90d",
    "spend_90d",
    "unique_products",
    "sku_popularity",
    "affinity_home",
    "affinity_kitchen",
    "affinity_seasonal",
    "affinity_accessories",
    "affinity_other",
)
SEGMENT_COLUMNS = ("recency", "frequency", "monetary", "return_rate", "seasonal_concentration")
FEATURE_LABELS = {
    "recency": "days since the last purchase",
    "spend_90d": "recent spending",
    "historical_clv": "historical net spending",
    "frequency": "order frequency",
    "monetary": "historical gross spending",
    "orders_90d": "recent order count",
    "engagement": "the engagement score",
    "gap_variance": "irregular purchase intervals",
}
# ------------------------------------------------------------------------------------

FEATURES = (*NUMERIC_FEATURES, "country")
TARGETS = ("churn", "clv_90d", "next_days", "next_category")
NO_PURCHASE = "no_purchase"


@dataclass(frozen=True)
class ModelConfig:
    """Estimator settings (fixed values of the data product being rebuilt)."""

    logistic_c: float = 0.2
    logistic_iterations: int = 2500
    tree_depth: int = 5
    tree_min_leaf: int = 25
    forest_trees: int = 180
    # MLlib stops at depth 30; an unlimited depth is expressed as 20.
    forest_depths: tuple[int, ...] = (6, 20)
    forest_min_leaves: tuple[int, ...] = (3, 8)
    boost_rounds: int = 220
    boost_depths: tuple[int, ...] = (2, 3)
    boost_rates: tuple[float, ...] = (0.04, 0.08)
    boost_row_share: float = 0.85
    boost_column_share: float = 0.85
    wide_boost_rounds: int = 180
    wide_boost_depth: int = 4
    wide_boost_rate: float = 0.04
    neighbours: int = 35
    ridge_alpha: float = 100.0
    value_forest_trees: int = 250
    value_forest_depth: int = 9
    value_forest_min_leaf: int = 4
    value_boost_rounds: int = 200
    value_boost_depth: int = 3
    value_boost_rate: float = 0.03
    value_boost_min_leaf: int = 30
    category_trees: int = 160
    category_depth: int = 8
    category_min_leaf: int = 6
    hidden: int = 48
    second_hidden: int = 24
    network_iterations: int = 100
    timing_rounds: int = 60
    bottleneck: int = 5
    cluster_starts: int = 20
    mixture_starts: int = 3


@dataclass(frozen=True)
class EngineConfig:
    """Everything an operator needs to know besides its input frames."""

    seed: int = 42
    cutoff: str = "2011-09-01"
    horizon_days: int = 90
    max_missing_customer_rate: float = 0.30
    minimum_date: str = "2009-01-01"
    maximum_date: str = "2012-01-01"
    max_quantity: float = 50000.0
    max_price: float = 20000.0
    cv_folds: int = 5
    test_fraction: float = 0.15
    validation_fraction: float = 0.15
    recall_target: float = 0.70
    sequence_length: int = 12
    cluster_k: tuple[int, ...] = (2, 3, 4, 5, 6)
    anomaly_quantile: float = 0.95
    silhouette_sample: int = 2000
    # Limits of an uploaded batch; none unless a caller sets them.
    batch_limit: int | None = None
    upload_bytes: int | None = None
    category_rules: tuple[tuple[str, str], ...] = CATEGORY_RULES
    models: ModelConfig = field(default_factory=ModelConfig)
