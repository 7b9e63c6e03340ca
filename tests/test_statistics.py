"""Order statistics, metrics, splits and segment measures against NumPy."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerloom.config import EngineConfig
from ledgerloom.functions.ordering import exact_quantiles, running_totals
from ledgerloom.operators import metrics, neighbours, segments, splits

CFG = EngineConfig()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all values is one number; the rest has a heavy tail."""
    rng = np.random.default_rng(1)
    values = np.concatenate([np.full(1000, 7.0), np.round(rng.lognormal(3, 2, 2000), 3)])
    return values, spark.createDataFrame(pd.DataFrame({"v": values, "g": np.arange(3000) % 3}))


def test_quantiles_are_exact(skewed):
    values, df = skewed
    probs = [0.0, 0.05, 0.25, 0.333, 0.5, 0.95, 1.0]
    found = {r.prob: r.value for r in exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12)
    grouped = {r.g: r.value for r in exact_quantiles(df, ["v"], [0.5], by=["g"]).collect()}
    for g in range(3):
        assert grouped[g] == pytest.approx(np.median(values[np.arange(3000) % 3 == g]))


def test_running_totals_are_exact(skewed):
    values, df = skewed
    counts = df.groupBy("v").agg(F.count("*").alias("n"))
    found = {r.v: (r.n_before, r.n_total) for r in running_totals(counts, "v", ["n"]).collect()}
    for v in (values.min(), 7.0, np.median(values), values.max()):
        assert found[float(v)] == ((values < v).sum(), 3000)


def test_auc_counts_ties_half(spark):
    rng = np.random.default_rng(2)
    y, p = rng.integers(0, 2, 400), np.round(rng.random(400), 1)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    pos, neg = p[y == 1], p[y == 0]
    wins = (pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()
    assert metrics.roc_auc(df, "y", "p").first().roc_auc == pytest.approx(wins / (len(pos) * len(neg)))


def test_threshold_choice(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.3), (1, 0.4), (1, 0.9)], "y int, p double")
    best = metrics.choose_threshold(df, "y", "p", 0.7).first()
    assert (best.threshold, best.f1) == (0.4, 1.0)
    cells = metrics.confusion_matrix(df, "y", "p", F.lit(best.threshold)).collect()
    assert {(r.actual, r.predicted): r.customers for r in cells} == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 2}
    assert metrics.choose_threshold(df.filter("y = 0"), "y", "p", 0.7).first().threshold == 0.0
    # Every threshold is met by its own value.
    exact = spark.createDataFrame([(1, i / 100) for i in range(5, 96)], "y int, p double")
    table = {r.threshold: r.tp for r in metrics.threshold_table(exact, "y", "p").collect()}
    assert [table[i / 100] for i in range(5, 96)] == list(range(91, 0, -1))


def test_error_summary(spark):
    df = spark.createDataFrame([("a", 0.0, 2.0), ("b", 10.0, 8.0), ("c", 20.0, 24.0)], "customer_id string, t double, q double")
    rows = metrics.error_rows(df, "t", "q")
    assert sorted(r.error for r in rows.collect()) == [-2.0, 2.0, 4.0]
    s = metrics.error_summary(rows).first()
    assert (s.mse, s.r2, s.median_absolute_error, s["count"]) == (8.0, pytest.approx(0.88), 2.0, 3)
    assert s.mae == pytest.approx(8 / 3) and s.mean_error == pytest.approx(4 / 3)
    assert s.worst_10_squared_error_share == 1.0
    perfect = metrics.error_summary(metrics.error_rows(df, "t", "t")).first()
    assert (perfect.mse, perfect.r2, perfect.worst_10_squared_error_share) == (0.0, 1.0, 0.0)
    for bad in (df.limit(0), df.withColumn("q", F.lit(float("nan"))), df.withColumn("q", F.lit(float("inf")))):
        with pytest.raises(ValueError):
            metrics.check_errors(metrics.error_rows(bad, "t", "q"))


def test_join_keys_must_be_unique(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2)], "customer_id string, x int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "customer_id string, z int")
    assert metrics.check_one_to_one(left, left.withColumnRenamed("x", "z"), "customer_id").count() == 2
    with pytest.raises(ValueError, match="unique"):
        metrics.check_one_to_one(left, right, "customer_id")


def test_split_is_stratified_disjoint_and_stable(spark):
    people = spark.range(1000).select(
        F.col("id").cast("string").alias("customer_id"), (F.col("id") % 4 == 0).cast("int").alias("churn")
    )
    split = splits.stratified_split(people, CFG).persist()
    sizes = {(r.churn, r.partition): r["count"] for r in split.groupBy("churn", "partition").count().collect()}
    assert sizes[(1, "test")] == sizes[(1, "validation")] == 38
    assert sizes[(0, "test")] == sizes[(0, "validation")] == 113
    assert splits.partition_coverage(people, split).first().violations == 0
    again = splits.stratified_split(people.repartition(5), CFG)
    assert split.exceptAll(again).count() == 0
    folds = splits.stratified_folds(split, CFG).groupBy("fold").count().collect()
    assert {r.fold for r in folds} == set(range(5)) and max(r["count"] for r in folds) - min(r["count"] for r in folds) <= 2


def test_silhouette_and_scatter(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(0, 1, (40, 2)), rng.normal(5, 1, (30, 2)), rng.normal((0, 6), 1, (20, 2))])
    label = np.repeat([0, 1, 2], [40, 30, 20])
    df = spark.createDataFrame(
        pd.DataFrame({"customer_id": [str(i) for i in range(90)], "a": x[:, 0], "b": x[:, 1], "cluster": label})
    )
    gaps = np.sqrt(((x[:, None] - x) ** 2).sum(axis=2))
    widths = []
    for i in range(90):
        inside = gaps[i, label == label[i]].sum() / ((label == label[i]).sum() - 1)
        outside = min(gaps[i, label == c].mean() for c in range(3) if c != label[i])
        widths.append((outside - inside) / max(outside, inside))
    assert segments.silhouette(df, ["a", "b"], "cluster", CFG).first().silhouette == pytest.approx(np.mean(widths))
    centre = np.array([x[label == c].mean(axis=0) for c in range(3)])
    scatter = [np.sqrt(((x[label == c] - centre[c]) ** 2).sum(axis=1)).mean() for c in range(3)]
    worst = [
        max((scatter[i] + scatter[j]) / np.linalg.norm(centre[i] - centre[j]) for j in range(3) if j != i) for i in range(3)
    ]
    assert segments.davies_bouldin(df, ["a", "b"], "cluster").first().davies_bouldin == pytest.approx(np.mean(worst))


def test_neighbours_match_brute_force_with_small_pieces(spark, monkeypatch):
    """Tiny pieces and blocks, and a third of the train rows at one point."""
    monkeypatch.setattr(neighbours, "PIVOTS", 6)
    monkeypatch.setattr(neighbours, "PIECE_ROWS", 10)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 8)
    rng = np.random.default_rng(4)
    train = np.concatenate([np.zeros((50, 3)), rng.normal(0, 2, (100, 3))])
    ask = np.concatenate([np.zeros((2, 3)), rng.normal(0, 2, (30, 3))])
    label = rng.integers(0, 2, 150)
    frame = lambda x, p: pd.DataFrame({"customer_id": [f"{p}{i:03d}" for i in range(len(x))], **dict(zip("abc", x.T, strict=True))})
    t = spark.createDataFrame(frame(train, "t").assign(churn=label))
    q = spark.createDataFrame(frame(ask, "q"))
    found = neighbours.nearest_neighbours(q, t, ["a", "b", "c"], "churn", 7).persist()
    got = {k: sorted(zip(v["distance"], v["neighbour"], strict=True)) for k, v in found.toPandas().groupby("customer_id")}
    for i, point in enumerate(ask):
        gaps = np.sqrt(((train - point) ** 2).sum(axis=1))
        want = sorted((g, f"t{j:03d}") for j, g in enumerate(gaps))[:7]
        assert [n for _, n in got[f"q{i:03d}"]] == [n for _, n in want]
    votes = {r.customer_id: r.churn_probability for r in neighbours.neighbour_vote(found).collect()}
    assert votes["q000"] == pytest.approx(label[:7].mean())


def test_rows_are_sent_to_the_cells_that_are_visited(spark, monkeypatch):
    """Queries around one of two distant groups never meet the rows of the other; blocks follow a cell's own visitors."""
    draw = np.random.default_rng(3)
    near, far = draw.normal(size=(300, 4)), draw.normal(size=(300, 4)) + 1000
    rows = [(f"t{k:04d}", k % 2, *map(float, x)) for k, x in enumerate(np.concatenate([near, far]))]
    t = spark.createDataFrame(rows, "customer_id string, churn int, a double, b double, c double, d double")
    asked = draw.normal(size=(120, 4))
    q = spark.createDataFrame([(f"q{k:04d}", *map(float, x)) for k, x in enumerate(asked)], "customer_id string, a double, b double, c double, d double")
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 50)
    monkeypatch.setattr(neighbours, "PIECE_ROWS", 40)
    report = {}
    found = neighbours.nearest_neighbours(q, t, ["a", "b", "c", "d"], "churn", 5, report=report).collect()
    got = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        got.setdefault(r.customer_id, []).append(r.neighbour)
    gaps = np.sqrt(((asked[:, None] - near[None]) ** 2).sum(2))
    for k in range(len(asked)):
        assert got[f"q{k:04d}"] == [f"t{i:04d}" for i in np.argsort(gaps[k], kind="stable")[:5]]
    assert report["pivots"] == 24 and report["visits"] <= 120 * 24
    assert report["sent"] <= 300 * 3  # at most three blocks of 50 visitors; nothing of the far group


def test_a_query_is_sent_once_to_a_piece_of_many_cells(spark, monkeypatch):
    """Many inputs, so that nearly all cells are visited: what is sent follows pieces and blocks, not cells; turns change nothing."""
    draw = np.random.default_rng(8)
    train, asked = np.round(draw.normal(0, 3, (400, 20)), 1), np.round(draw.normal(0, 3, (90, 20)), 1)
    asked[0] = train[7]
    asked[1, 3] = np.nan
    names = [f"x{i}" for i in range(20)]
    frame = lambda x, p: pd.DataFrame({"customer_id": [f"{p}{i:04d}" for i in range(len(x))], **dict(zip(names, x.T, strict=True))})
    t, q = spark.createDataFrame(frame(train, "t").assign(churn=1)), spark.createDataFrame(frame(asked, "q"))
    stored, plain = {}, neighbours.materialize

    def noted(df, name):
        out = plain(df, name)
        stored[name] = stored.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(neighbours, "materialize", noted)
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 20)
    monkeypatch.setattr(neighbours, "PIECE_ROWS", 150)
    monkeypatch.setattr(neighbours, "TURN_BLOCKS", 2, raising=False)
    monkeypatch.setattr(neighbours, "CHUNK", 16, raising=False)
    report = {}
    found = neighbours.nearest_neighbours(q, t, names, "churn", 9, report=report).toPandas()
    assert report["visits"] > 89 * report["pivots"] / 2
    assert stored["visits"] == 89  # not a row a visit
    got = {c: sorted(zip(v["distance"], v["neighbour"], strict=True)) for c, v in found.groupby("customer_id")}
    assert len(got) == 89 and "q0001" not in got
    for i in [0, *range(2, 90)]:
        want = sorted((g, f"t{j:04d}") for j, g in enumerate(neighbours._distances(asked[i : i + 1], train)[0]))[:9]
        assert got[f"q{i:04d}"] == want
