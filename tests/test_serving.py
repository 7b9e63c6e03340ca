"""Upload rules, stores, trends and recommendations."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORIES, FEATURES, NUMERIC_FEATURES, EngineConfig
from ledgerloom.operators import serving, validation
from ledgerloom.sources import store

CFG = EngineConfig()


@pytest.fixture(scope="module")
def rows(spark):
    base = spark.createDataFrame([("1",), ("2",)], "customer_id string")
    return base.select(
        "customer_id", *[F.lit(1 if c == "frequency" else 0.5).alias(c) for c in NUMERIC_FEATURES], F.lit("UK").alias("country")
    ).select("customer_id", *FEATURES)


@pytest.mark.parametrize(
    "change",
    [
        lambda d: d.drop("frequency"),
        lambda d: d.limit(0),
        lambda d: d.withColumn("recency", F.lit(float("nan"))),
        lambda d: d.withColumn("customer_id", F.lit("1")),
        lambda d: d.withColumn("customer_id", F.lit(" ")),
        lambda d: d.withColumn("monetary", F.lit(-1.0)),
        lambda d: d.withColumn("country", F.lit("")),
        lambda d: d.withColumn("affinity_home", F.lit(2.0)),
        lambda d: d.withColumn("engagement", F.lit(101.0)),
    ],
)
def test_bad_uploads_are_refused(rows, change):
    with pytest.raises(ValueError):
        validation.check_feature_rows(change(rows), CFG)


def test_good_uploads_pass(rows):
    signed = rows.withColumn("historical_clv", F.lit("-5")).withColumn("frequency_trend", F.lit(-1.0))
    assert validation.check_feature_rows(signed, CFG).count() == 2


def test_id_lists(spark, rows):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "customer_id string")
    validation.check_id_list(ids("1", "2"), rows)
    for bad in (("1", "1"), ("1", None)):
        with pytest.raises(ValueError):
            validation.check_id_list(ids(*bad), rows)
    with pytest.raises(KeyError):
        validation.check_id_list(ids("1", "9"), rows)
    with pytest.raises(KeyError):
        serving.require_customer(rows, "9")


@pytest.mark.parametrize("record", [{"customer_id": "12a"}, {"customer_id": ""}, {"customer_id": "1" * 33}, {"customer_id": "1", "x": 1}, {}])
def test_bad_requests(record):
    with pytest.raises(ValueError):
        validation.check_request(record)
    assert validation.check_request({"customer_id": "12"}) == "12"


def test_upload_limits(spark, tmp_path):
    path = tmp_path / "ids.csv"
    path.write_text("customer_id\n00123\n")
    found, ids_only = store.read_upload(spark, str(path), CFG)
    assert ids_only and found.first().customer_id == "00123"
    path.write_text("customer_id\n")
    with pytest.raises(ValueError, match="no rows"):
        store.read_upload(spark, str(path), CFG)
    path.write_text("customer_id\n" + "1\n" * 6000)
    assert store.read_upload(spark, str(path), CFG)[0].count() == 6000
    with pytest.raises(ValueError, match="more than 5 rows|more than 5$"):
        store.read_upload(spark, str(path), replace(CFG, batch_limit=5))
    with pytest.raises(ValueError, match="100 bytes"):
        store.read_upload(spark, str(path), replace(CFG, upload_bytes=100))


def test_processed_tables(rows):
    full = rows.selectExpr("*", "0 AS churn", "0.0 AS clv_90d", "1.0 AS next_days", "'home' AS next_category")
    assert store.processed_table("features", full, full).columns == ["customer_id", *FEATURES]
    with pytest.raises(ValueError):
        store.processed_table("secrets", full, full)


def test_fingerprint_ignores_order_and_sees_changes(rows):
    first = store.fingerprint(rows).first()
    assert store.fingerprint(rows.repartition(3)).first() == first
    assert store.fingerprint(rows.withColumn("recency", F.lit(0.6))).first() != first


def test_trend_fills_empty_months_and_forecast_is_flat(spark):
    days = [(datetime(2011, 1, 5), 10.0), (datetime(2011, 1, 9), -4.0), (datetime(2011, 4, 1), 30.0)]
    trend = serving.revenue_trend(spark.createDataFrame(days, "invoice_date timestamp_ntz, amount double"))
    assert {r.month: r.revenue for r in trend.collect()} == {
        "2011-01-01": 6.0,
        "2011-02-01": 0.0,
        "2011-03-01": 0.0,
        "2011-04-01": 30.0,
    }
    ahead = {r.month: r.revenue for r in serving.revenue_forecast(trend).collect()}
    assert ahead == {"2011-05-01": 10.0, "2011-06-01": 10.0, "2011-07-01": 10.0}


def test_recommendations_skip_what_was_bought(spark):
    items = spark.createDataFrame(
        [(f"{i:05d}", f"ITEM {i}", CATEGORIES[i % 2], 20 - i // 2, 1.0) for i in range(16)],
        "stock_code string, description string, category string, orders long, typical_price double",
    )
    scored = spark.createDataFrame(
        [("a", "home"), ("b", "kitchen"), ("c", "no_purchase"), ("d", "home")], "customer_id string, predicted_category string"
    )
    bought = [("a", "00000"), ("a", "00004"), ("a", "00001"), ("c", "00000"), *[("d", f"{i:05d}") for i in range(0, 14, 2)]]
    found = serving.recommendations(scored, items, spark.createDataFrame(bought, "customer_id string, stock_code string"))
    picks = {}
    for r in found.orderBy("customer_id", "position").collect():
        picks.setdefault(r.customer_id, []).append((r.position, r.stock_code))
    ranked = sorted((r for r in items.collect()), key=lambda r: (-r.orders, r.stock_code))
    for customer, category in (("a", "home"), ("b", "kitchen"), ("c", None), ("d", "home")):
        owned = {s for c, s in bought if c == customer}
        want = [r.stock_code for r in ranked if category in (None, r.category) and r.stock_code not in owned][:5]
        assert picks[customer] == list(enumerate(want, start=1))


def test_store_seeds_once_and_keeps_batches(spark, tmp_path):
    target = store.Store(spark, str(tmp_path / "db"))
    table = spark.createDataFrame([("1", "{}")], "customer_id string, payload string")
    tables = dict.fromkeys(store.SNAPSHOT_TABLES, table)
    assert target.seed(tables) and not target.seed(tables)
    target.append_batch(table)
    target.append_batch(table)
    target.refresh(tables)
    assert target.read("batch_scores").select("batch_id").distinct().count() == 2
    assert target.payloads().count() == 1
