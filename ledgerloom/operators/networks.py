"""Neural networks trained data-parallel: tasks learn from shards, their parameters are averaged each epoch.

Rows are dealt by a hash of their key to shards of about ``SHARD_ROWS`` rows, whatever the cluster, and each shard is packed
into one row of a stored table. An epoch is one Spark job: every task runs Adam over the minibatches of its shards, starting
from the current state, and returns the sum of the resulting states weighted by rows, so what reaches the driver is
one set of parameters a task. Optimiser moments and running statistics are part of the state and averaged too.

Several lanes are trained in the same jobs: a lane learns from all groups of rows but those it holds out, on which its loss
decides when it stops. One lane that holds out the validation rows is a plain fit; one lane a fold is a cross-validation.
Inputs are scaled by the means and deviations of a lane's own training rows, taken from sums by group.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.config import NUMERIC_FEATURES, EngineConfig
from ledgerloom.operators.preprocessing import INPUTS, preparation_stages
from ledgerloom.session import materialize, spread

SHARD_ROWS = 4096
#: Tasks a core that the shards of a small table are dealt to.
TASKS = 4
State = dict[str, np.ndarray]
#: Entries of a state that training moves without a gradient.
RUNNING = ("running_mean", "running_var")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


@dataclass(frozen=True)
class Dense:
    """A feed-forward network with ReLU between layers; the first hidden layer may be normalised and dropped out.

    ``positive_weight`` set: one output, log loss with that weight on class one. Otherwise the squared error against the
    targets, or against the inputs if there are none (an autoencoder).
    """

    widths: tuple[int, ...]
    normalised: bool = False
    dropout: float = 0.0
    positive_weight: float | None = None
    momentum: float = 0.1

    def start(self, seed: int) -> State:
        draw, state = np.random.default_rng(seed), {}
        for k, (a, b) in enumerate(zip(self.widths, self.widths[1:])):
            state[f"w{k}"] = draw.uniform(-1, 1, (a, b)) / np.sqrt(a)
            state[f"b{k}"] = draw.uniform(-1, 1, b) / np.sqrt(a)
        if self.normalised:
            width = self.widths[1]
            state |= {"gain": np.ones(width), "offset": np.zeros(width), "running_mean": np.zeros(width), "running_var": np.ones(width)}
        return state

    def _forward(self, state: State, x: np.ndarray, draw: np.random.Generator | None) -> tuple[np.ndarray, list]:
        kept, last = [], len(self.widths) - 2
        for k in range(last + 1):
            z = x @ state[f"w{k}"] + state[f"b{k}"]
            note = {"x": x}
            if k == 0 and self.normalised:
                mean, var = (z.mean(0), z.var(0)) if draw is not None else (state["running_mean"], state["running_var"])
                note |= {"mean": mean, "var": var, "rows": len(z), "unit": (z - mean) / np.sqrt(var + 1e-5)}
                z = note["unit"] * state["gain"] + state["offset"]
            if k < last:
                note["open"] = z > 0
                z = z * note["open"]
                if k == 0 and self.dropout and draw is not None:
                    note["drop"] = (draw.random(z.shape) >= self.dropout) / (1 - self.dropout)
                    z = z * note["drop"]
            kept.append(note)
            x = z
        return x, kept

    def output(self, state: State, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Predictions: the probability of class one, or the last layer."""
        z, _ = self._forward(state, x, None)
        return sigmoid(z[:, 0]) if self.positive_weight is not None else z

    def _loss(self, z: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        if self.positive_weight is None:
            miss = z - (x if y.ndim == 1 and z.shape[1] > 1 else y.reshape(z.shape))
            return float((miss**2).mean()), 2 * miss / miss.size
        z, weight = z[:, 0], np.where(y > 0, self.positive_weight, 1.0)
        loss = weight * (np.logaddexp(0, z) - y * z)
        return float(loss.mean()), (weight * (sigmoid(z) - y) / len(y))[:, None]

    def loss(self, state: State, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> float:
        return self._loss(self._forward(state, x, None)[0], x, y)[0]

    def learn(self, state: State, x: np.ndarray, y: np.ndarray, length: np.ndarray, draw: np.random.Generator) -> tuple[float, State]:
        """Loss of a minibatch and gradients; running statistics are moved in place."""
        z, kept = self._forward(state, x, draw)
        loss, g = self._loss(z, x, y)
        grads: State = {}
        for k in range(len(kept) - 1, -1, -1):
            note = kept[k]
            if "drop" in note:
                g = g * note["drop"]
            if "open" in note:
                g = g * note["open"]
            if "unit" in note:
                unit, n = note["unit"], note["rows"]
                grads["gain"], grads["offset"] = (g * unit).sum(0), g.sum(0)
                h = g * state["gain"]
                g = (h - h.mean(0) - unit * (h * unit).mean(0)) / np.sqrt(note["var"] + 1e-5)
                for name, now in (("running_mean", note["mean"]), ("running_var", note["var"] * n / max(n - 1, 1))):
                    state[name] = (1 - self.momentum) * state[name] + self.momentum * now
            grads[f"w{k}"], grads[f"b{k}"] = note["x"].T @ g, g.sum(0)
            g = g @ state[f"w{k}"].T
        return loss, grads


@dataclass(frozen=True)
class Recurrent:
    """A long short-term memory cell over padded sequences and a sigmoid head; steps from a row's length on are not read."""

    steps: int
    width: int
    hidden: int
    dropout: float = 0.0

    def start(self, seed: int) -> State:
        draw, bound = np.random.default_rng(seed), 1 / np.sqrt(self.hidden)
        shapes = {"in": (self.width, 4 * self.hidden), "back": (self.hidden, 4 * self.hidden), "bias": (4 * self.hidden,), "head": (self.hidden,), "shift": (1,)}
        return {name: draw.uniform(-bound, bound, shape) for name, shape in shapes.items()}

    def _forward(self, state: State, x: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
        """Last state of every row, the order by falling length, and what each step computed for the rows that still live in it."""
        n, order = self.hidden, np.argsort(-length, kind="stable")
        size = np.minimum(length[order], self.steps)
        last = max(int(size.max(initial=0)), 0)
        live = np.arange(last)[:, None] < size
        # Padding may hold anything, also nothing a number can be.
        x = np.where(live[..., None], x.reshape(len(x), self.steps, self.width)[order, :last].transpose(1, 0, 2), 0.0)
        # tanh(z) = 2 sigmoid(2 z) - 1, so all four gates of a step come from one exponential, here of the negated sums.
        turned = np.repeat([-1.0, -1.0, -2.0, -1.0], n)
        back = state["back"] * turned
        fed = (x.reshape(-1, self.width) @ (state["in"] * turned) + state["bias"] * turned).reshape(last, len(order), 4 * n)
        h, c, kept = np.zeros((len(order), n)), np.zeros((len(order), n)), []
        for t, m in enumerate(live.sum(1)):
            before, cell = h[:m].copy(), c[:m].copy()
            gates = before @ back
            gates += fed[t, :m]
            np.clip(gates, -60, 60, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            g = gates[:, 2 * n : 3 * n]
            g *= 2
            g -= 1
            new = gates[:, n : 2 * n] * cell + gates[:, :n] * g
            squashed = np.tanh(new)
            kept.append((x[t, :m], before, cell, gates, squashed))
            c[:m], h[:m] = new, gates[:, 3 * n :] * squashed
        out = np.empty_like(h)
        out[order] = h
        return out, order, kept

    def output(self, state: State, x: np.ndarray, length: np.ndarray) -> np.ndarray:
        h, _, _ = self._forward(state, x, length)
        return sigmoid(h @ state["head"] + state["shift"])

    def loss(self, state: State, x: np.ndarray, y: np.ndarray, length: np.ndarray) -> float:
        return float(((self.output(state, x, length) - y) ** 2).mean())

    def learn(self, state: State, x: np.ndarray, y: np.ndarray, length: np.ndarray, draw: np.random.Generator) -> tuple[float, State]:
        h, order, kept = self._forward(state, x, length)
        n = self.hidden
        drop = (draw.random(h.shape) >= self.dropout) / (1 - self.dropout) if self.dropout else 1.0
        p = sigmoid((h * drop) @ state["head"] + state["shift"])
        dz = 2 * (p - y) * p * (1 - p) / len(y)
        grads = {"head": (h * drop).T @ dz, "shift": np.array([dz.sum()]), "in": 0.0, "back": 0.0, "bias": 0.0}
        dh, dc = (np.outer(dz, state["head"]) * drop)[order], np.zeros(h.shape)
        for step, before, cell, gates, squashed in reversed(kept):
            m, (i, f, g, o) = len(step), (gates[:, k * n : (k + 1) * n] for k in range(4))
            through = dh[:m]
            inner = dc[:m] + through * o * (1 - squashed**2)
            slope = gates * (1 - gates)
            slope[:, 2 * n : 3 * n] = 1 - g * g
            slope[:, :n] *= inner * g
            slope[:, n : 2 * n] *= inner * cell
            slope[:, 2 * n : 3 * n] *= inner * i
            slope[:, 3 * n :] *= through * squashed
            grads["in"], grads["back"], grads["bias"] = grads["in"] + step.T @ slope, grads["back"] + before.T @ slope, grads["bias"] + slope.sum(0)
            dh[:m], dc[:m] = slope @ state["back"].T, inner * f
        return float(((p - y) ** 2).mean()), grads


Network = Dense | Recurrent


@dataclass(frozen=True)
class Schedule:
    epochs: int = 35
    #: Times a task goes through a shard before states are averaged.
    passes: int = 2
    batch: int = 128
    rate: float = 1e-3
    decay: float = 1e-4
    patience: int = 6
    tolerance: float = 1e-5


@dataclass
class Lane:
    """One model in training: the groups it holds out, its scaling, state, and what it has seen so far."""

    network: Network
    held: tuple[int, ...]
    shift: np.ndarray
    scale: np.ndarray
    state: State
    best: float = np.inf
    best_state: State = field(default_factory=dict)
    stale: int = 0
    history: list[dict] = field(default_factory=list)


def flat(state: State) -> np.ndarray:
    return np.concatenate([state[k].ravel() for k in sorted(state)])


def unflat(vector: np.ndarray, like: State) -> State:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = vector[at : at + like[k].size].reshape(like[k].shape)
        at += like[k].size
    return out


def adam_passes(network: Network, state: State, x, y, length, schedule: Schedule, draw: np.random.Generator, moments: tuple[State, State], steps: int) -> tuple[float, int]:
    """Passes of Adam over shuffled minibatches and the mean loss; ``state`` and ``moments`` are moved in place."""
    losses, least = [], 2 if getattr(network, "normalised", False) else 1
    for _ in range(schedule.passes):
        order = draw.permutation(len(x))
        for a in range(0, len(x), schedule.batch):
            pick = order[a : a + schedule.batch]
            if len(pick) < least:
                continue
            loss, grads = network.learn(state, x[pick], y[pick], length[pick], draw)
            losses.append(loss * len(pick))
            steps += 1
            for k, g in grads.items():
                g = g + schedule.decay * state[k]
                moments[0][k] = 0.9 * moments[0][k] + 0.1 * g
                moments[1][k] = 0.999 * moments[1][k] + 0.001 * g * g
                state[k] = state[k] - schedule.rate * (moments[0][k] / (1 - 0.9**steps)) / (np.sqrt(moments[1][k] / (1 - 0.999**steps)) + 1e-8)
    return float(np.sum(losses)) / (len(x) * schedule.passes), steps


def packed(rows: DataFrame) -> DataFrame:
    """(key, group, x, y, length) rows as one stored row a shard: group, shard, n and the arrays' bytes."""
    sizes = {r["group"]: r["count"] for r in rows.groupBy("group").count().collect()}  # a handful of groups
    shards = F.lit(1)
    for group, n in sizes.items():
        shards = F.when(F.col("group") == group, -(-n // SHARD_ROWS)).otherwise(shards)
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64(F.col("key").cast("string")), shards).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("key")
        x = table.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        y, length = (table.column(c).to_numpy().astype(np.float64) for c in ("y", "length"))
        one = {"group": table.column("group")[0], "shard": table.column("shard")[0], "n": table.num_rows, "x": x.tobytes(), "y": y.tobytes(), "length": length.tobytes()}
        return pa.Table.from_pylist([{k: v.as_py() if isinstance(v, pa.Scalar) else v for k, v in one.items()}], schema=_PACKED)

    dealt = dealt.select("key", "group", "shard", "x", F.col("y").cast("double").alias("y"), F.col("length").cast("double").alias("length"))
    stored = materialize(dealt.groupBy("group", "shard").applyInArrow(pack, "group int, shard int, n long, x binary, y binary, length binary"), "shards")
    # Scans put shards together by their bytes, which leaves those of a small table to a few tasks of unequal length.
    return spread(stored, min(sum(-(-n // SHARD_ROWS) for n in sizes.values()), TASKS * rows.sparkSession.sparkContext.defaultParallelism))


_PACKED = pa.schema([("group", pa.int32()), ("shard", pa.int32()), ("n", pa.int64()), ("x", pa.binary()), ("y", pa.binary()), ("length", pa.binary())])


def _unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    y, length = (np.frombuffer(row[k]) for k in ("y", "length"))
    return np.frombuffer(row["x"]).reshape(row["n"], -1), y, length.astype(np.int64)


def scalings(rows: DataFrame, width: int, scaled: int, helds: Sequence[tuple[int, ...]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations of the first ``scaled`` inputs over the rows each lane learns from; one row a group and input."""
    cells = rows.select("group", F.posexplode("x").alias("at", "v")).where(F.col("at") < scaled)
    sums = cells.groupBy("group", "at").agg(F.count("*").alias("n"), F.avg("v").alias("m"), F.var_pop("v").alias("s")).collect()
    out = []
    for held in helds:
        shift, scale = np.zeros(width), np.ones(width)
        for at in range(scaled):
            part = [r for r in sums if r["at"] == at and r["group"] not in held]
            n = sum(r["n"] for r in part)
            if n:
                shift[at] = sum(r["n"] * r["m"] for r in part) / n
                scale[at] = np.sqrt(sum(r["n"] * (r["s"] + (r["m"] - shift[at]) ** 2) for r in part) / n) or 1.0
        out.append((shift, scale))
    return out


def train(network: Network | Sequence[Network], rows: DataFrame, helds: Sequence[tuple[int, ...]], schedule: Schedule, seed: int, scaled: int = 0) -> list[Lane]:
    """A trained lane for each set of held-out groups; ``rows`` are (key, group, x, y, length)."""
    networks = [network] * len(helds) if isinstance(network, (Dense, Recurrent)) else list(network)
    first = networks[0]
    width = first.widths[0] if isinstance(first, Dense) else first.steps * first.width
    factors = scalings(rows, width, scaled, helds) if scaled else [(np.zeros(width), np.ones(width))] * len(helds)
    shards = packed(rows)
    lanes = [Lane(net, tuple(held), *factor, net.start(seed)) for net, held, factor in zip(networks, helds, factors)]
    zeros = [{k: np.zeros_like(v) for k, v in lane.state.items()} for lane in lanes]
    moments, steps = [(z, z) for z in zeros], [0] * len(lanes)
    for epoch in range(schedule.epochs + 1):
        open_lanes = [k for k, lane in enumerate(lanes) if lane.stale < schedule.patience]
        if not open_lanes:
            break
        found = _epoch(shards, lanes, open_lanes, moments, steps, schedule, seed, epoch)
        for k in open_lanes:
            lane, got = lanes[k], found[k]
            if epoch:
                loss = got["held_loss"] / got["held_n"] if got["held_n"] else lane.history[-1]["train_loss"]
                lane.history[-1]["validation_loss"] = loss
                if loss < lane.best - schedule.tolerance:
                    lane.best, lane.best_state, lane.stale = loss, lane.state, 0
                else:
                    lane.stale += 1
            if epoch < schedule.epochs and lane.stale < schedule.patience and got["n"]:
                lane.history.append({"epoch": epoch + 1, "train_loss": got["loss"] / got["n"], "validation_loss": None})
                size = sum(v.size for v in lane.state.values())
                parts = [got["sum"][i * size : (i + 1) * size] / got["n"] for i in range(3)]
                lane.state, moments[k] = unflat(parts[0], zeros[k]), (unflat(parts[1], zeros[k]), unflat(parts[2], zeros[k]))
                steps[k] = max(int(round(got["steps"] / got["n"])), steps[k] + 1)
    for lane in lanes:
        lane.state = lane.best_state or lane.state
        lane.history = [h for h in lane.history if h["validation_loss"] is not None]
    return lanes


def _epoch(shards: DataFrame, lanes: list[Lane], active: list[int], moments: list, steps: list[int], schedule: Schedule, seed: int, epoch: int) -> dict[int, dict]:
    """Loss of the held-out rows under each lane's state, and the weighted sum of the states after a pass over the others."""
    work = {k: (lanes[k].network, lanes[k].held, lanes[k].shift, lanes[k].scale, lanes[k].state, moments[k], steps[k]) for k in active}
    learning = epoch < schedule.epochs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, dict] = {}
        for batch in batches:
            for row in batch.to_pylist():
                raw, y, length = _unpacked(row)
                for k, (network, held, shift, scale, state, (m1, m2), done) in work.items():
                    x = (raw - shift) / scale
                    own = sums.setdefault(k, {"n": 0, "loss": 0.0, "held_n": 0, "held_loss": 0.0, "steps": 0.0, "sum": 0.0})
                    if row["group"] in held:
                        own["held_n"] += len(x)
                        own["held_loss"] += network.loss(state, x, y, length) * len(x)
                    elif learning:
                        mine, pair = dict(state), (dict(m1), dict(m2))
                        draw = np.random.default_rng([seed, epoch, row["group"] + 1, row["shard"]])
                        loss, count = adam_passes(network, mine, x, y, length, schedule, draw, pair, done)
                        own["loss"] += loss * len(x)
                        own["n"] += len(x)
                        own["steps"] += count * len(x)
                        own["sum"] = own["sum"] + len(x) * np.concatenate([flat(mine), flat(pair[0]), flat(pair[1])])
        out = [(k, v["n"], v["loss"], v["held_n"], v["held_loss"], v["steps"], np.asarray(v["sum"], float).tobytes()) for k, v in sums.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["lane", "n", "loss", "held_n", "held_loss", "steps", "sum"])

    got: dict[int, dict] = {}
    rows = shards.mapInArrow(run, "lane long, n long, loss double, held_n long, held_loss double, steps double, sum binary").collect()
    for r in rows:  # one row a task and lane
        total = got.setdefault(r["lane"], {"n": 0, "loss": 0.0, "held_n": 0, "held_loss": 0.0, "steps": 0.0, "sum": 0.0})
        for name in ("n", "loss", "held_n", "held_loss", "steps"):
            total[name] += r[name]
        if r["n"]:
            total["sum"] = total["sum"] + np.frombuffer(bytes(r["sum"]))
    empty = {"n": 0, "loss": 0.0, "held_n": 0, "held_loss": 0.0, "steps": 0.0, "sum": 0.0}
    return {k: got.get(k, dict(empty)) for k in active}


# ---- Fitted networks -------------------------------------------------------------------------------


@dataclass
class NetworkModel:
    """A trained network with its preparation; ``transform`` adds what ``output`` names."""

    network: Network
    state: State
    shift: np.ndarray
    scale: np.ndarray
    output: str
    prepared: PipelineModel | None = None
    history: list[dict] = field(default_factory=list)
    factor: float = 1.0

    def inputs(self, df: DataFrame) -> DataFrame:
        """``df`` with columns ``_x`` and ``_length``."""
        if self.prepared is None:
            return df.withColumns({"_x": F.flatten("values").cast("array<double>"), "_length": F.col("length").cast("int")})
        return self.prepared.transform(df).select(*df.columns, vector_to_array(INPUTS).alias("_x"), F.lit(0).alias("_length"))

    def transform(self, df: DataFrame) -> DataFrame:
        """``probability`` (as a vector), ``predicted_next_days`` or ``anomaly_score``, beside the columns of ``df``."""
        network, state, shift, scale, kind, factor = self.network, self.state, self.shift, self.scale, self.output, self.factor
        rows = self.inputs(df)
        plain = [c for c in df.columns if c not in ("values", "length")]
        rows = rows.select(*plain, "_x", "_length")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = (batch.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) - shift) / scale
                out = network.output(state, x, batch.column("_length").to_numpy())
                value = ((out - x) ** 2).mean(1) if kind == "anomaly_score" else out * factor
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(value)], schema=pa.schema([*list(batch.schema)[:-2], pa.field("_out", pa.float64())]))

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-2]) + ", _out double"
        done = rows.mapInArrow(run, schema)
        if kind == "probability":
            return done.withColumn("probability", array_to_vector(F.array(1 - F.col("_out"), F.col("_out")))).drop("_out")
        return done.withColumnRenamed("_out", kind)

    def save(self, folder: str) -> None:
        """The state as one JSON row, the preparation as a Spark ML artifact."""
        facts = {
            "kind": type(self.network).__name__, "network": asdict(self.network), "output": self.output, "factor": self.factor, "history": self.history,
            "shift": self.shift.tolist(), "scale": self.scale.tolist(), "state": {k: v.tolist() for k, v in self.state.items()}, "prepared": self.prepared is not None,
        }
        SparkSession.active().createDataFrame([(json.dumps(facts),)], "state string").coalesce(1).write.mode("overwrite").text(f"{folder}/state")
        if self.prepared is not None:
            self.prepared.write().overwrite().save(f"{folder}/prepared")

    @classmethod
    def load(cls, folder: str) -> NetworkModel:
        facts = json.loads(SparkSession.active().read.text(f"{folder}/state").first().value)
        made = facts["network"] | ({"widths": tuple(facts["network"]["widths"])} if facts["kind"] == "Dense" else {})
        network = {"Dense": Dense, "Recurrent": Recurrent}[facts["kind"]](**made)
        state = {k: np.array(v) for k, v in facts["state"].items()}
        prepared = PipelineModel.load(f"{folder}/prepared") if facts["prepared"] else None
        return cls(network, state, np.array(facts["shift"]), np.array(facts["scale"]), facts["output"], prepared, facts["history"], facts["factor"])


def _model(lane: Lane, output: str, prepared: PipelineModel | None, factor: float = 1.0) -> NetworkModel:
    return NetworkModel(lane.network, lane.state, lane.shift, lane.scale, output, prepared, lane.history, factor)


def _prepared_rows(parts: Sequence[DataFrame], label: str | None) -> tuple[PipelineModel, DataFrame, int]:
    """Preparation fitted on the first part, and all parts as (key, group, x, y, length)."""
    prepared = Pipeline(stages=preparation_stages(parts[0], scaled=False)).fit(parts[0])
    rows = None
    for group, part in enumerate(parts):
        target = F.col(label).cast("double") if label else F.lit(0.0)
        own = F.col("fold") if "fold" in part.columns and len(parts) == 1 else F.lit(group)
        one = prepared.transform(part).select(F.col("customer_id").alias("key"), own.cast("int").alias("group"), vector_to_array(INPUTS).alias("x"), target.alias("y"), F.lit(0).alias("length"))
        rows = one if rows is None else rows.unionByName(one)
    rows = materialize(rows, "network-rows")
    first = rows.select(F.size("x").alias("n")).first()
    return prepared, rows, first.n if first else len(NUMERIC_FEATURES)


def _positive_weight(rows: DataFrame, held: tuple[int, ...]) -> float:
    learned = rows.where(~F.col("group").isin(*held)) if held else rows
    n, positive = learned.agg(F.count("*"), F.sum("y")).first()
    return float((n - (positive or 0.0)) / max(positive or 0.0, 1.0))


def fit_churn_network(train_rows: DataFrame, validation: DataFrame, cfg: EngineConfig, schedule: Schedule = Schedule()) -> NetworkModel:
    """A normalised, dropped-out network with weighted log loss, stopped early on the validation rows."""
    prepared, rows, width = _prepared_rows([train_rows, validation], "churn")
    network = Dense((width, cfg.models.hidden, cfg.models.second_hidden, 1), True, 0.25, _positive_weight(rows, (1,)))
    (lane,) = train(network, rows, [(1,)], schedule, cfg.seed, len(NUMERIC_FEATURES))
    return _model(lane, "probability", prepared)


def fold_churn_networks(train_rows: DataFrame, cfg: EngineConfig, schedule: Schedule = Schedule(epochs=15)) -> dict[int, NetworkModel]:
    """One network a fold, each learned from the other folds; all are trained in the same jobs."""
    prepared, rows, width = _prepared_rows([train_rows], "churn")
    helds = [(f,) for f in range(cfg.cv_folds)]
    nets = [Dense((width, cfg.models.hidden, cfg.models.second_hidden, 1), True, 0.25, _positive_weight(rows, held)) for held in helds]
    lanes = train(nets, rows, helds, schedule, cfg.seed, len(NUMERIC_FEATURES))
    return {f: _model(lane, "probability", prepared) for f, lane in enumerate(lanes)}


def _sequence_rows(sequences: DataFrame, people: DataFrame, horizon: float) -> DataFrame:
    joined = people.join(sequences, "customer_id")
    target = F.least(F.greatest(F.col("next_days").cast("double"), F.lit(0.0)), F.lit(horizon)) / horizon
    rows = joined.select(F.col("customer_id").alias("key"), F.col("group").cast("int").alias("group"), F.flatten("values").cast("array<double>").alias("x"), target.alias("y"), "length")
    return materialize(rows, "network-sequences")


def _cell(sequences: DataFrame, hidden: int = 32) -> Recurrent | None:
    first = sequences.select(F.size("values").alias("steps"), F.size(F.get("values", F.lit(0))).alias("width")).first()
    return Recurrent(first.steps, first.width, hidden, 0.2) if first else None


def fit_timing_network(sequences: DataFrame, train_rows: DataFrame, validation: DataFrame, cfg: EngineConfig, schedule: Schedule = Schedule()) -> NetworkModel:
    """Waiting time up to the horizon from the purchase sequence."""
    people = train_rows.select("customer_id", "next_days", F.lit(0).alias("group")).unionByName(validation.select("customer_id", "next_days", F.lit(1).alias("group")))
    horizon = float(cfg.horizon_days)
    (lane,) = train(_cell(sequences), _sequence_rows(sequences, people, horizon), [(1,)], schedule, cfg.seed)
    return _model(lane, "predicted_next_days", None, horizon)


def fold_timing_networks(sequences: DataFrame, train_rows: DataFrame, cfg: EngineConfig, schedule: Schedule = Schedule(epochs=15)) -> dict[int, NetworkModel]:
    """One recurrent network a fold, trained in the same jobs."""
    rows = _sequence_rows(sequences, train_rows.select("customer_id", "next_days", F.col("fold").alias("group")), float(cfg.horizon_days))
    lanes = train(_cell(sequences), rows, [(f,) for f in range(cfg.cv_folds)], schedule, cfg.seed)
    return {f: _model(lane, "predicted_next_days", None, float(cfg.horizon_days)) for f, lane in enumerate(lanes)}


def fit_autoencoder(train_rows: DataFrame, validation: DataFrame, cfg: EngineConfig, schedule: Schedule = Schedule()) -> NetworkModel:
    """A network that reproduces its scaled inputs through a narrow layer."""
    prepared, rows, width = _prepared_rows([train_rows, validation], None)
    (lane,) = train(Dense((width, 16, cfg.models.bottleneck, 16, width)), rows, [(1,)], schedule, cfg.seed, len(NUMERIC_FEATURES))
    return _model(lane, "anomaly_score", prepared)
