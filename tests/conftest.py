"""Shared session and the small ledgers the tests are about."""

from __future__ import annotations

import sys
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgerloom.config import EngineConfig  # noqa: E402
from ledgerloom.session import local_session  # noqa: E402

SCHEMA = (
    "invoice string, stock_code string, description string, quantity double, invoice_date timestamp_ntz, "
    "price double, customer_id double, country string"
)
ROWS = [
    ("1", "10001", "RED MUG", 2.0, datetime(2011, 1, 1), 5.0, 1.0, "UK"),
    ("2", "10002", "HEART CANDLE", 1.0, datetime(2011, 2, 1), 10.0, 1.0, "UK"),
    ("C3", "10001", "RED MUG", -1.0, datetime(2011, 2, 2), 5.0, 1.0, "UK"),
    ("4", "10001", "RED MUG", 1.0, datetime(2011, 3, 1), 5.0, 2.0, "FR"),
    ("5", "10001", "RED MUG", 3.0, datetime(2011, 4, 1), 5.0, 1.0, "UK"),
    ("6", "10001", "RED MUG", 1.0, datetime(2011, 7, 1), 5.0, 3.0, "UK"),
]


@pytest.fixture(scope="session")
def spark():
    return local_session("4", shuffle_partitions=4, memory="6g")


@pytest.fixture(scope="session")
def cfg():
    return replace(EngineConfig(), cutoff="2011-04-01")


@pytest.fixture(scope="session")
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def clean(raw, cfg):
    from ledgerloom.operators.cleaning import clean_ledger

    return clean_ledger(raw, cfg).persist()
