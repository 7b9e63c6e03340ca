"""Cleaning, features, labels and sequences on a hand-computed ledger."""

from __future__ import annotations

import math
from dataclasses import replace
from datetime import datetime

import pytest
from conftest import ROWS, SCHEMA
from pyspark.sql import functions as F

from ledgerloom.config import CATEGORY_RULES, LEDGER_HEADER
from ledgerloom.functions.columns import category_of
from ledgerloom.operators import cleaning, features, labels, sequences
from ledgerloom.sources.ledger import combine_parts, read_parts


def by_id(df):
    return {r.customer_id: r for r in df.collect()}


def test_features_of_known_customer(clean, cfg):
    row = by_id(features.customer_features(clean, cfg))["1"]
    assert (row.frequency, row.monetary, row.historical_clv, row.recency) == (2, 20.0, 15.0, 59.0)
    assert row.return_rate == pytest.approx(1 / 3)
    assert row.affinity_kitchen == pytest.approx(0.5)
    assert row.gap_variance == 0.0
    assert row.country == "UK"


def test_future_lines_change_nothing(spark, clean, cfg):
    before = features.customer_features(clean, cfg)
    later = F.col("invoice_date") >= F.lit(cfg.cutoff).cast("timestamp_ntz")
    changed = clean.withColumn("amount", F.when(later, 999.0).otherwise(F.col("amount")))
    for other in (changed, clean.filter(~later), clean.repartition(7)):
        after = features.customer_features(other, cfg)
        assert before.exceptAll(after).count() == 0
        assert after.exceptAll(before).count() == 0


def test_gap_variance_and_trend_match_a_plain_computation(spark, cfg):
    """Gaps inside and across months, several orders at one instant, and a returns-only customer."""
    days = [datetime(2010, 11, 3), datetime(2010, 11, 3), datetime(2010, 11, 20, 12), datetime(2011, 1, 5), datetime(2011, 3, 30, 6)]
    rows = [(str(i), "10001", "RED MUG", 1.0, d, 2.5, 9.0, "UK") for i, d in enumerate(days)]
    rows.append(("C9", "10001", "RED MUG", -1.0, datetime(2011, 1, 1), 2.5, 8.0, "UK"))
    table = by_id(features.customer_features(cleaning.clean_ledger(spark.createDataFrame(rows, SCHEMA), cfg), cfg))
    assert set(table) == {"9"}
    gaps = [(b - a).total_seconds() / 86400 for a, b in zip(days, days[1:], strict=False)]
    mean = sum(gaps) / len(gaps)
    assert table["9"].gap_variance == pytest.approx(sum((g - mean) ** 2 for g in gaps) / (len(gaps) - 1))
    bins = [int((datetime(2011, 4, 1) - d).total_seconds() / 86400 / 30) for d in days]
    assert table["9"].frequency_trend == pytest.approx(sum((2.5 - b) / 17.5 for b in bins if b < 6))
    assert table["9"].seasonal_concentration == pytest.approx(3 / 5)


def test_labels_at_the_cutoff(spark, clean, cfg):
    ids = spark.createDataFrame([("1",), ("2",)], "customer_id string")
    found = by_id(labels.customer_targets(clean, ids, cfg))
    assert (found["1"].churn, found["1"].clv_90d, found["1"].next_days) == (0, 15.0, 0.0)
    assert found["1"].next_category == "kitchen"
    assert (found["2"].churn, found["2"].next_days, found["2"].next_category) == (1, 90.0, "no_purchase")


def test_incomplete_window_is_refused(clean, cfg):
    labels.check_window(clean, cfg)
    with pytest.raises(ValueError, match="incomplete"):
        labels.check_window(clean, replace(cfg, cutoff="2011-07-01"))


def test_sequences_are_padded_at_the_end(spark, clean, cfg):
    ids = spark.createDataFrame([("1",), ("2",), ("999",)], "customer_id string")
    found = by_id(sequences.customer_sequences(clean, ids, replace(cfg, sequence_length=5)))
    assert [found[i].length for i in ("1", "2", "999")] == [2, 1, 1]
    assert all(len(found[i]["values"]) == 5 and len(found[i]["values"][0]) == 8 for i in found)
    assert all(v == 0 for step in found["1"]["values"][2:] for v in step)
    assert found["1"]["values"][0][0] == pytest.approx(math.log1p(10) / 10, rel=1e-6)
    assert found["1"]["values"][1][1] == pytest.approx(math.log1p(31) / 7, rel=1e-6)


def test_truncation_keeps_the_gap_before_the_first_kept_event(clean, cfg):
    last = sequences.last_events(clean, replace(cfg, sequence_length=1)).filter("customer_id = '1'").collect()
    assert [(r.step, r.gap) for r in last] == [(0, 31.0)]


def test_cleaning_decisions(spark, cfg):
    rows = list(ROWS)
    rows[1] = (*rows[1][:3], 500.0, *rows[1][4:])
    rows[3] = (*rows[3][:3], 60000.0, *rows[3][4:])
    raw = spark.createDataFrame([*rows, rows[0]], SCHEMA)
    audit = cleaning.cleaning_audit(raw, cfg).first()
    assert (audit.raw_rows, audit.exact_duplicate_rows, audit.quarantined_extremes) == (7, 1, 1)
    assert (audit.clean_rows, audit.return_rows, audit.identified_customers) == (5, 1, 2)
    clean = cleaning.clean_ledger(raw, cfg)
    assert clean.filter("quantity = 500").count() == 1
    assert cleaning.quarantine(raw, cfg).count() == 1
    assert cleaning.clean_ledger(raw.unionByName(raw), cfg).count() == clean.count()


def test_text_and_sign_rules(spark, cfg):
    row = (" c7 ", " 10001a ", " red \t mug ", 4.0, datetime(2011, 1, 1), 2.0, 12.0, None)
    line = cleaning.clean_ledger(spark.createDataFrame([row], SCHEMA), cfg).first()
    assert (line.invoice, line.stock_code, line.description) == ("C7", "10001A", "RED MUG")
    assert (line.quantity, line.amount, line.is_return, line.is_product) == (-4.0, -8.0, True, True)
    assert (line.customer_id, line.country) == ("12", "Unknown")


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("price", "double('inf')", "Nonfinite price"),
        ("quantity", "'bad'", "Nonfinite quantity"),
        ("invoice_date", "'soon'", "Some invoice dates cannot be read"),
        ("invoice_date", "'2020-01-01'", "Some invoice dates lie outside the configured span"),
        ("customer_id", "cast(null as double)", "without a customer"),
    ],
)
def test_bad_ledgers_are_refused(raw, cfg, column, value, message):
    with pytest.raises(ValueError, match=message):
        cleaning.check_ledger(raw.withColumn(column, F.expr(value)), cfg)


def test_missing_column_is_refused(raw, cfg):
    with pytest.raises(ValueError, match="price"):
        cleaning.check_ledger(raw.drop("price"), cfg)
    cleaning.check_ledger(raw.withColumn("extra", F.lit(1)), cfg)


def test_category_precedence(spark):
    words = ["HEART", "TEA CUP", "CHRISTMAS", "BAG", "UNKNOWN", "HEART MUG", "STRING"]
    df = spark.createDataFrame([(w,) for w in words], "d string")
    found = [r[0] for r in df.select(category_of(F.col("d"), CATEGORY_RULES)).collect()]
    assert found == ["home", "kitchen", "seasonal", "accessories", "other", "home", "accessories"]


def test_parts_need_the_exact_header(spark, raw, tmp_path):
    part = raw.toDF(*LEDGER_HEADER)
    assert combine_parts([part, part]).count() == 12
    with pytest.raises(ValueError, match="2 ledger parts"):
        combine_parts([part])
    with pytest.raises(ValueError, match="header"):
        combine_parts([part, part.select(*reversed(LEDGER_HEADER))])
    for name in ("a", "b"):
        part.write.option("header", True).csv(f"{tmp_path}/{name}")
    back = read_parts(spark, [f"{tmp_path}/a", f"{tmp_path}/b"], "csv")
    assert cleaning.typed(back).agg(F.sum("quantity")).first()[0] == 14.0


def _lines(spark, *rows):
    schema = "invoice string, stock_code string, description string, quantity string, invoice_date string, price string, customer_id double, country string"
    return spark.createDataFrame(rows, schema)


def test_missing_codes_and_white_space(spark, cfg):
    rows = _lines(
        spark,
        (None, "10001", "MUG", "2", "2011-01-01", "5", 1.0, "UK"),
        ("\tc7", "10001", " red mug ", "2", "2011-01-02", "5", 1.0, "UK"),
        ("8", None, "MUG", "1", "2011-01-03", "5", 1.0, "UK"),
    )
    got = {r.invoice: r for r in cleaning.clean_ledger(rows, cfg).collect()}
    assert got[None].is_return is False and got[None].is_product
    assert got["C7"].is_return and got["C7"].quantity == -2.0 and got["C7"].description == "RED MUG"
    assert got["8"].is_product is False


def test_a_duplicate_has_one_meaning(spark, cfg):
    rows = _lines(spark, *[("1", "10001", "MUG", q, "2011-01-01", "5", 1.0, "UK") for q in ("5", "5", "5.0")])
    assert cleaning.duplicate_count(rows).first().exact_duplicate_rows == 1
    assert cleaning.cleaning_audit(rows, cfg).first().exact_duplicate_rows == 1
    assert cleaning.clean_ledger(rows, cfg).count() == 2


def test_fractional_ids_are_refused(spark, cfg):
    rows = _lines(spark, ("1", "10001", "MUG", "5", "2011-01-01", "5", 123.5, "UK"))
    with pytest.raises(ValueError, match="whole"):
        cleaning.check_ledger(rows, cfg)
    text = rows.withColumn("customer_id", F.lit("9007199254740993"))
    assert cleaning.customer_key(text).first().customer_id == "9007199254740993"
