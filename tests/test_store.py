"""Snapshots that change in one step, and lookups that open only the files they need."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import configure, materialize
from ledgerloom.sources import store
from ledgerloom.sources.tables import order_lines


def tables(spark, mark, rows=400):
    people = spark.range(rows).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("customer_id"), F.lit(mark).alias("mark"))
    return {
        "segments": spark.createDataFrame([(0, mark)], "segment_id int, name string"),
        "customers": people.repartition(5),
        "predictions": people.withColumn("payload", F.concat("customer_id", "mark")).repartition(7),
        "transactions": people.limit(3),
    }


@pytest.fixture
def wide(spark):
    """Range partitions are kept apart, as on tables too large to be merged."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_failed_refresh_leaves_the_old_snapshot(spark, tmp_path):
    target = store.Store(spark, str(tmp_path / "db"))
    assert target.version() is None and target.is_empty("predictions")
    assert target.seed(tables(spark, "old")) and not target.seed(tables(spark, "new"))
    first = target.version()
    broken = tables(spark, "new")
    broken["transactions"] = broken["transactions"].withColumn("x", F.raise_error(F.lit("stopped midway")))
    with pytest.raises(Exception, match="stopped midway"):
        target.refresh(broken)
    assert target.version() == first
    for name in store.SNAPSHOT_TABLES:
        column = "name" if name == "segments" else "mark"
        assert [r[0] for r in target.read(name).select(column).distinct().collect()] == ["old"]
    reader = target.read("predictions")
    target.refresh(tables(spark, "new"))
    assert target.version() != first and target.read("predictions").first().mark == "new"
    assert reader.count() == 400 and reader.first().mark == "old"  # a reader of the old snapshot is not disturbed


def test_pointer_is_replaced_in_one_step(spark, tmp_path):
    path = str(tmp_path / "current")
    for text in ("one", "two"):
        store.replace_text(spark, path, text)
        assert spark.read.text(path).first().value == text
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.startswith(".")) == ["current"]


def test_lookup_opens_one_file(spark, tmp_path, wide):
    target = store.Store(spark, str(tmp_path / "db"))
    target.seed(tables(spark, "x"))
    files = target.read("predictions").inputFiles()
    assert len(files) >= 3
    for wanted in (["0007"], ["0399"], ["0200"]):
        found = target.lookup("predictions", wanted)
        assert len(found.inputFiles()) == 1
        assert [r.payload for r in found.collect()] == [f"{wanted[0]}x"]
    both = target.lookup("customers", ["0001", "0398", "nobody", "0001"])
    assert len(both.inputFiles()) == 2 and sorted(r.customer_id for r in both.collect()) == ["0001", "0398"]
    assert target.lookup("customers", ["nobody"]).count() == 0 and target.lookup("customers", []).count() == 0
    index = spark.read.parquet(f"{target.path('customers')}_index").orderBy("first").collect()
    assert all(a["last"] < b["first"] for a, b in zip(index, index[1:]))


def _shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_shuffle_files_go_with_the_query_that_wrote_them(spark):
    before = _shuffle_files(spark)
    counts = configure(spark).range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    materialize(counts, "counts")
    assert len(counts.collect()) == len(counts.collect()) == 7  # a frame that is read again is computed again
    assert not _shuffle_files(spark) - before


def test_orders_meet_customers_before_lines(spark, tmp_path):
    """One copy of the wide lines less, and the same rows: an order or customer that is missing drops its lines."""
    day = "timestamp_ntz'2000-01-01 00:00:00' AS o_orderdate"
    made = {
        "lineitem": "SELECT * FROM VALUES (1L, 5L, 2D, 8D, 'N'), (1L, 6L, 1D, 3D, 'R'), (2L, 5L, 1D, 1D, 'N'), (9L, 5L, 1D, 1D, 'N'), (3L, 5L, 1D, 1D, 'N') t(l_orderkey, l_partkey, l_quantity, l_extendedprice, l_returnflag)",
        "orders": f"SELECT *, {day} FROM VALUES (1L, 10L), (1L, 11L), (2L, 12L), (3L, 99L) t(o_orderkey, o_custkey)",
        "customer": "SELECT * FROM VALUES (10L, 0), (11L, 1), (12L, 7) t(c_custkey, c_nationkey)",
        "nation": "SELECT * FROM VALUES (0, 'A'), (1, 'B') t(n_nationkey, n_name)",
        "part": "SELECT * FROM VALUES (5L, 'x', 'PROMO'), (6L, 'y', 'STD') t(p_partkey, p_name, p_type)",
    }
    for name, sql in made.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    lines = order_lines(spark, str(tmp_path))
    rows = sorted((r.invoice, r.stock_code, r.customer_id, r.country) for r in lines.collect())
    assert rows == [("1", "M5", 10.0, "A"), ("1", "M5", 11.0, "B"), ("C1", "00006", 10.0, "A"), ("C1", "00006", 11.0, "B")]
    joins = [line for line in lines._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in line]
    depth = {key: next(i for i, line in enumerate(joins) if key in line) for key in ("l_orderkey", "o_custkey")}
    assert depth["l_orderkey"] < depth["o_custkey"]
