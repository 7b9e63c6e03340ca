"""Networks: gradients, padding, weighting, averaging over shards, folds in shared jobs, saving."""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ledgerloom.config import NUMERIC_FEATURES, EngineConfig
from ledgerloom.operators import anomaly, networks
from ledgerloom.operators.networks import Dense, Recurrent, Schedule

CFG = EngineConfig()


@pytest.mark.parametrize(
    "network",
    [Dense((6, 5, 4, 1), True, 0.3, 2.5), Dense((6, 5, 3, 5, 6)), Dense((6, 4, 1)), Recurrent(3, 2, 4, 0.2)],
    ids=["classifier", "autoencoder", "regressor", "recurrent"],
)
def test_gradients(network):
    draw = np.random.default_rng(3)
    x, y, length = draw.normal(size=(9, 6)), (draw.random(9) > 0.5) * 1.0, draw.integers(1, 4, 9)
    state = {k: v + 0.1 * draw.normal(size=v.shape) for k, v in network.start(1).items()}

    def learn(at):
        return network.learn({k: v.copy() for k, v in at.items()}, x, y, length, np.random.default_rng(0))

    grads = learn(state)[1]
    assert grads.keys() == {k for k in state if k not in networks.RUNNING}
    for name, g in grads.items():
        for place in np.ndindex(*state[name].shape):
            sides = []
            for move in (1e-6, -1e-6):
                moved = {k: v.copy() for k, v in state.items()}
                moved[name][place] += move
                sides.append(learn(moved)[0])
            assert (sides[0] - sides[1]) / 2e-6 == pytest.approx(g[place], abs=1e-7)


def test_padding_is_not_read():
    draw = np.random.default_rng(5)
    network, length = Recurrent(6, 3, 4), np.array([1, 3, 6, 2])
    state, x = network.start(2), draw.normal(size=(4, 18))
    other = x.reshape(4, 6, 3).copy()
    for row, n in enumerate(length):
        other[row, n:] = [1e9, np.nan, -np.inf]
    again = other.reshape(4, 18)
    assert (network.output(state, x, length) == network.output(state, again, length)).all()
    first, second = (network.learn(dict(state), v, np.full(4, 0.3), length, np.random.default_rng(0)) for v in (x, again))
    assert first[0] == second[0] and all((first[1][k] == second[1][k]).all() for k in first[1])


def test_weight_of_class_one():
    draw = np.random.default_rng(1)
    x, y = draw.normal(size=(50, 2)), np.r_[np.ones(5), np.zeros(45)]
    state = Dense((2, 3, 1), positive_weight=9.0).start(0)
    plain, heavy = (Dense((2, 3, 1), positive_weight=w).loss(state, x, y, None) for w in (1.0, 9.0))
    ones = Dense((2, 3, 1), positive_weight=1.0).loss(state, x[:5], y[:5], None)
    assert heavy == pytest.approx(plain + 8 * ones * 5 / 50)


@pytest.fixture(scope="module")
def people(spark):
    draw = np.random.default_rng(9)
    n = 900
    columns = {c: draw.gamma(2.0, 3.0, n) for c in NUMERIC_FEATURES}
    columns["monetary"] = columns["recency"] ** 2 / 9 + draw.normal(0, 0.1, n)
    risk = columns["recency"] - columns["frequency"] + draw.normal(0, 0.5, n)
    rows = [
        (f"{k:04d}", *(float(columns[c][k]) for c in NUMERIC_FEATURES), ["UK", "FR"][k % 2], int(risk[k] > 3), float(min(90, 9 * columns["recency"][k])), k % 5)
        for k in range(n)
    ]
    names = ", ".join(f"{c} double" for c in NUMERIC_FEATURES)
    return spark.createDataFrame(rows, f"customer_id string, {names}, country string, churn int, next_days double, fold int").persist()


def auc(rows):
    p, y = np.array([r.p for r in rows]), np.array([r.churn for r in rows])
    return np.mean(p[y == 1][:, None] > p[y == 0][None])


def test_churn_network_learns_stops_and_survives_saving(people, tmp_path):
    train, held = people.where("fold < 4").drop("fold"), people.where("fold = 4").drop("fold")
    model = networks.fit_churn_network(train, held, CFG, Schedule(epochs=14, rate=5e-3, patience=3))
    assert 3 <= len(model.history) <= 14 and model.history[0]["train_loss"] > model.history[-1]["train_loss"]
    assert min(h["validation_loss"] for h in model.history) < model.history[0]["validation_loss"]
    n, ones = train.count(), train.where("churn = 1").count()
    assert model.network.positive_weight == pytest.approx((n - ones) / ones)
    found = model.transform(held)
    rows = found.select("customer_id", "churn", vector_to_array("probability")[1].alias("p")).orderBy("customer_id").collect()
    assert auc(rows) > 0.93
    model.save(str(tmp_path / "net"))
    again = networks.NetworkModel.load(str(tmp_path / "net")).transform(held)
    assert again.select("customer_id", "churn", vector_to_array("probability")[1].alias("p")).orderBy("customer_id").collect() == rows


def test_shards_do_not_follow_the_cluster(spark, people, monkeypatch):
    monkeypatch.setattr(networks, "SHARD_ROWS", 200)
    rows = people.select(F.col("customer_id").alias("key"), F.lit(0).alias("group"), F.array("recency", "frequency").alias("x"), F.col("churn").cast("double").alias("y"), F.lit(0).alias("length"))
    network, states = Dense((2, 4, 1), positive_weight=1.0), []
    for parts in (2, 7):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        try:
            (lane,) = networks.train(network, rows.repartition(parts), [()], Schedule(epochs=3), 1, 2)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        states.append(networks.flat(lane.state))
    assert networks.packed(rows).count() == 5
    assert states[0] == pytest.approx(states[1], abs=1e-9)


def test_one_epoch_is_the_weighted_mean_over_shards(spark, people, monkeypatch):
    monkeypatch.setattr(networks, "SHARD_ROWS", 300)
    rows = people.select(F.col("customer_id").alias("key"), F.lit(0).alias("group"), F.array("recency", "frequency").alias("x"), F.col("churn").cast("double").alias("y"), F.lit(0).alias("length"))
    network, schedule = Dense((2, 4, 1), positive_weight=1.0), Schedule(epochs=1, passes=1)
    (lane,) = networks.train(network, rows, [()], schedule, 1, 2)
    total, n = 0.0, 0
    for r in networks.packed(rows).collect():
        x, y, length = networks._unpacked(r.asDict())
        state = network.start(1)
        zeros = tuple({k: np.zeros_like(v) for k, v in state.items()} for _ in range(2))
        networks.adam_passes(network, state, (x - lane.shift) / lane.scale, y, length, schedule, np.random.default_rng([1, 0, 1, r["shard"]]), zeros, 0)
        total, n = total + len(x) * networks.flat(state), n + len(x)
    assert networks.flat(lane.state) == pytest.approx(total / n)


def test_folds_share_jobs_and_hold_their_rows_out(people):
    rows = people.select(F.col("customer_id").alias("key"), F.col("fold").alias("group"), F.array("recency", "frequency").alias("x"), F.col("churn").cast("double").alias("y"), F.lit(0).alias("length"))
    network, schedule = Dense((2, 4, 1), positive_weight=1.0), Schedule(epochs=2, patience=9)
    together = networks.train(network, rows, [(f,) for f in range(5)], schedule, 1, 2)
    (alone,) = networks.train(network, rows, [(3,)], schedule, 1, 2)
    assert networks.flat(together[3].state) == pytest.approx(networks.flat(alone.state))
    kept = people.where("fold <> 3").agg(F.avg("recency"), F.stddev_pop("recency")).first()
    assert (together[3].shift[0], together[3].scale[0]) == pytest.approx(tuple(kept))
    changed = rows.withColumn("y", F.when(F.col("group") == 3, 1 - F.col("y")).otherwise(F.col("y")))
    (other,) = networks.train(network, changed, [(3,)], replace(schedule, epochs=1), 1, 2)
    (same,) = networks.train(network, rows, [(3,)], replace(schedule, epochs=1), 1, 2)
    assert (networks.flat(other.state) == networks.flat(same.state)).all() and other.best != same.best


def test_recurrent_network_learns_waits(spark):
    draw = np.random.default_rng(2)
    rows = []
    for k in range(600):
        length = int(draw.integers(1, 5))
        values = draw.random((4, 2))
        rows.append((f"{k:04d}", values.tolist(), length, float(90 * values[length - 1, 0])))
    frame = spark.createDataFrame(rows, "customer_id string, values array<array<double>>, length int, next_days double").persist()
    series, waits = frame.select("customer_id", "values", "length"), frame.select("customer_id", "next_days")
    model = networks.fit_timing_network(series, waits.where("customer_id < '0480'"), waits.where("customer_id >= '0480'"), CFG, Schedule(epochs=25, rate=2e-2, patience=25))
    got = model.transform(waits.where("customer_id >= '0480'").join(series, "customer_id")).collect()
    error = np.mean([abs(r.predicted_next_days - r.next_days) for r in got])
    assert len(got) == 120 and error < 0.6 * np.mean([abs(45 - r.next_days) for r in got])


def test_autoencoder_beats_the_projection_on_curved_inputs(people):
    """Inputs that lie on a curve of one parameter: a straight component cannot follow them."""
    waves = [F.sin(F.col("recency") * (0.1 + 0.03 * i) + i).alias(c) for i, c in enumerate(NUMERIC_FEATURES)]
    curved = people.select("customer_id", *waves, F.lit("UK").alias("country"), "fold")
    train, held = curved.where("fold < 4").drop("fold"), curved.where("fold = 4").drop("fold")
    narrow = replace(CFG, models=replace(CFG.models, bottleneck=2))
    net = anomaly.fit_anomaly_network(train, held, narrow, Schedule(epochs=50, passes=8, rate=1e-2, patience=50, decay=0.0))
    line = anomaly.fit_anomaly(train, held, narrow)
    error = [anomaly.anomaly_scores(train, m).agg(F.avg("anomaly_score")).first()[0] for m in (net, line)]
    assert error[0] < error[1]
    scored = np.array([r.anomaly_score for r in anomaly.anomaly_scores(held, net).collect()])
    assert net.threshold == pytest.approx(np.quantile(scored, CFG.anomaly_quantile))


def test_shards_of_a_small_table_are_dealt_to_all_cores(spark):
    rows = spark.range(200).selectExpr("id AS key", "cast(id % 9 AS int) AS group", "array(cast(id AS double)) AS x", "1d AS y", "0 AS length")
    shards = networks.packed(rows)
    assert shards.rdd.getNumPartitions() == 9 > spark.sparkContext.defaultParallelism
    assert sum(r.n for r in shards.collect()) == 200


def test_steps_work_on_the_rows_that_still_live_in_them():
    """The recurrent network against a plain loop over rows and steps; the work of a step follows its living rows."""
    draw = np.random.default_rng(9)
    network, length = Recurrent(5, 3, 4), np.array([2, 5, 0, 1, 5, 3])
    state, x = network.start(4), draw.normal(size=(6, 15))
    h, order, kept = network._forward(state, x, length)
    assert [len(step[0]) for step in kept] == [5, 4, 3, 2, 2]
    assert list(length[order]) == sorted(length, reverse=True)
    for row, steps in enumerate(length):
        a, c = np.zeros(4), np.zeros(4)
        for t in range(steps):
            z = x[row, 3 * t : 3 * t + 3] @ state["in"] + a @ state["back"] + state["bias"]
            i, f, o = (networks.sigmoid(z[k : k + 4]) for k in (0, 4, 12))
            c = f * c + i * np.tanh(z[8:12])
            a = o * np.tanh(c)
        assert h[row] == pytest.approx(a, abs=1e-14)
