"""Language-model scoring with a causal self-attention model over subword ids, trained and run in numpy.

Tokens of the base score are lower-case words and one end; their counts cover every training document. The model
reads the subwords of the lower-case words (a public tokenizer's file, never trained here). Its alphabet is the end,
the most frequent subwords, and one place for all others, which then share that place's probability by their counts.
An output is predicted in two steps, a group of 32 and a place within it, so a token costs 64 outputs.

A stream (end, subwords, end) is read in windows of ``WINDOW`` positions that overlap by half: a window scores the
second half of its positions and uses the first as context, so each subword is scored once. Windows are batched;
a mask hides later positions and those before the stream.

Training is data parallel and takes every window of every training document, each in one of ``ROUNDS`` rounds. Streams
are kept as a table, cut into runs of ``RUN`` windows and never shuffled; in each round every task starts from the current
weights, takes its windows in batches, as many as a buffer holds mixed at a time, and the weights are averaged over tasks
by their number of windows. What is kept and counted grows with the corpus.

The scored probability of a word is ``MIX`` of its share of the training tokens and 1 - ``MIX`` of what the model
gives its subwords; the same holds for the end.

Counts of frequent words (at least one in ``FREQUENT`` tokens, so at most that many words) are sent to every task;
all other words are joined by key. Words are keyed by a 64-bit hash.

Defined results: a null or empty text is the end alone; a row with a null id is not held out and not learned from;
rows that repeat an id are scored one by one; without training rows N is 0 and the model is the untrained one.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored
from ledgerloom.llm.text import mix, pieces, utf8, word_hashes, words

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
FOLDS, HELD = 7, 2
FREQUENT = 1_000_000
PIECE = 4 << 20

GROUP = 32
PLACES = GROUP * GROUP
END, OTHER = 0, 1
WIDTH, HIDDEN = 16, 32
WINDOW, STEP = 32, 16
ROUNDS, BATCH, LEAST_STEPS, RATE = 3, 32, 150, 1e-2
#: Windows of a row of the training table, and windows that a training task holds at a time.
RUN, BUFFER = 64, 16_384
#: Stored places outside a stream and its ends; a tokenizer has fewer subwords.
OUTSIDE, ENDING = 65_535, 65_534
#: Weight of a word's share of the training corpus in its scored probability; the model has the rest.
MIX = 0.5
SCORED_AT_ONCE = 64
#: Scores and outputs above this, which trained weights don't reach, count as this much.
BOUND = np.float32(60)

WORD, SUBWORD, STREAM = 0, 1, 2


@functools.cache
def subwords(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def read(column: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and their bounds by text; subword ids and their bounds by text; subwords of each word."""
    found = words(*utf8(column))
    h = word_hashes(found)
    kinds, first, inverse = np.unique(h, return_index=True, return_inverse=True)
    spelled = [w.decode("utf-8", "replace") for w in found.take(first)]
    coded = subwords(path).encode(spelled, num_threads=1) if spelled else []
    sizes = np.array([len(c) or 1 for c in coded], np.int64)
    flat = np.fromiter((i for c in coded for i in (c or (0,))), np.int64, int(sizes.sum()))
    start = np.cumsum(sizes) - sizes
    each = sizes[inverse]
    ends = np.cumsum(each)
    where = np.arange(int(each.sum())) - np.repeat(ends - each, each) + np.repeat(start[inverse], each)
    at = np.concatenate([[0], ends])
    return h, found.bounds, flat[where], at[found.bounds], each


def _laid(ids: np.ndarray, bounds: np.ndarray, ending: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Streams laid out one after another with -1 outside, where each starts, and its number of windows."""
    size = np.diff(bounds) + 1  # targets: the subwords and the end
    count = -(-size // STEP)
    before = WINDOW - STEP
    # Every stream has room for the context before it and for a whole last window, so windows are runs of one array.
    room = before + 1 + count * STEP
    start = np.cumsum(room) - room
    laid = np.full(int(room.sum()) + WINDOW, -1, np.int32)
    laid[np.repeat(start + before + 1 - bounds[:-1], size - 1) + np.arange(len(ids))] = ids
    laid[start + before] = ending
    laid[start + before + size] = ending
    return laid, start, count


def windows(ids: np.ndarray, bounds: np.ndarray, ending: int = -2) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Streams cut into windows: context (n, WINDOW) and target (n, STEP) with -1 outside, the text, the number in it.

    ``ids`` are alphabet places or subword ids; ``ending`` stands for the end.
    """
    laid, start, count = _laid(ids, bounds, ending)
    text = np.repeat(np.arange(len(count)), count)
    number = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    at = start[text] + number * STEP
    context = np.lib.stride_tricks.sliding_window_view(laid, WINDOW)[at]
    target = np.lib.stride_tricks.sliding_window_view(laid, STEP)[at + WINDOW - STEP + 1]
    # A last window's context may hold the final end, but only at places that no target sees.
    return context, target, text, number


def runs(ids: np.ndarray, bounds: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Streams of subword ids cut into rows of at most ``RUN`` windows: places, windows, the text, the number in it."""
    laid, start, count = _laid(ids, bounds, -2)
    places = np.where(laid >= 0, laid, np.where(laid == -2, ENDING, OUTSIDE)).astype(np.uint16)
    rows = -(-count // RUN)
    text = np.repeat(np.arange(len(count)), rows)
    number = np.arange(int(rows.sum())) - np.repeat(np.cumsum(rows) - rows, rows)
    held = np.minimum(RUN, count[text] - number * RUN)
    first = start[text] + number * RUN * STEP
    ends = first + (held - 1) * STEP + WINDOW + 1
    return [places[a:b].tobytes() for a, b in zip(first.tolist(), ends.tolist())], held, text, number


def windows_of(row: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Context and target of a row's windows, in stored places."""
    places = np.frombuffer(row, np.uint16)
    view = np.lib.stride_tricks.sliding_window_view
    return view(places, WINDOW)[:-1:STEP], view(places[WINDOW - STEP + 1 :], STEP)[::STEP]


def _shapes() -> dict[str, tuple[int, ...]]:
    d = WIDTH
    return {
        "E": (PLACES, d), "P": (WINDOW, d), "Wq": (d, d), "Wk": (d, d), "Wv": (d, d), "W1": (d, HIDDEN), "b1": (HIDDEN,), "W2": (HIDDEN, d),
        "Uh": (d, GROUP), "bh": (GROUP,), "Wg": (d, HIDDEN), "C": (GROUP, HIDDEN), "Ul": (HIDDEN, GROUP), "Bl": (GROUP, GROUP),
    }


def unpack(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in _shapes().items():
        n = int(np.prod(shape))
        out[name] = flat[at : at + n].reshape(shape)
        at += n
    return out


def initial(share: np.ndarray, seed: int = 3) -> np.ndarray:
    """Small random weights; the output biases give the alphabet's shares in the corpus."""
    draw = np.random.default_rng(seed)
    parts = {n: draw.normal(0, 0.3 if n in "EP" else 1 / np.sqrt(s[0]), s) if len(s) > 1 else np.zeros(s) for n, s in _shapes().items()}
    parts["P"] *= 0.3
    grid = np.log(np.maximum(share, 1e-9)).reshape(GROUP, GROUP)
    parts["bh"] = np.log(np.exp(grid).sum(1))
    parts["Bl"] = grid - parts["bh"][:, None]
    parts["Uh"] *= 0.1
    parts["Ul"] *= 0.1
    return np.concatenate([parts[n].reshape(-1) for n in _shapes()]).astype(np.float32)


_LATER = np.where(np.arange(WINDOW)[None] <= np.arange(STEP)[:, None] + WINDOW - STEP, 0, -1e9).astype(np.float32)


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(-1, keepdims=True)
    x -= np.log(np.exp(x) @ np.ones(x.shape[-1], x.dtype))[..., None]
    return x


def _times(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """x @ w as one product of all rows, which is faster than one for each window."""
    return (x.reshape(-1, x.shape[-1]) @ w).reshape(*x.shape[:-1], w.shape[-1])


def log_probabilities(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, keep: dict | None = None) -> np.ndarray:
    """Natural log probability of each target place (0 outside the stream). ``keep`` receives what a gradient needs."""
    tokens, goal = np.maximum(context, 0), np.maximum(target, 0)
    x = p["E"][tokens] + p["P"]
    late = x[:, WINDOW - STEP :]
    q, k, v = _times(late, p["Wq"]), _times(x, p["Wk"]), _times(x, p["Wv"])
    a = (q / np.float32(np.sqrt(WIDTH))) @ k.transpose(0, 2, 1)
    a += _LATER
    if (context < 0).any():
        a += np.where(context >= 0, 0, -1e9).astype(np.float32)[:, None]
    a -= a.max(-1, keepdims=True)
    np.exp(a, out=a)
    a /= (a @ np.ones(WINDOW, a.dtype))[..., None]
    h = late + a @ v
    r = np.maximum(_times(h, p["W1"]) + p["b1"], 0)
    m = h + _times(r, p["W2"])
    hi, lo = goal // GROUP, goal % GROUP
    lh = _log_softmax(_times(m, p["Uh"]) + p["bh"])
    g = np.maximum(_times(m, p["Wg"]) + p["C"][hi], 0)
    ll = _log_softmax(_times(g, p["Ul"]) + p["Bl"][hi])
    rows = np.arange(goal.size)
    out = (lh.reshape(-1, GROUP)[rows, hi.reshape(-1)] + ll.reshape(-1, GROUP)[rows, lo.reshape(-1)]).reshape(goal.shape)
    if keep is not None:
        keep.update(x=x, late=late, q=q, k=k, v=v, a=a, h=h, r=r, m=m, g=g, lh=lh, ll=ll, hi=hi, lo=lo, tokens=tokens)
    return np.where(target >= 0, out, 0)


class Scorer:
    """The probabilities without what a gradient needs: projections of the alphabet are looked up, not computed."""

    def __init__(self, p: dict[str, np.ndarray]) -> None:
        late = np.float32(1 / np.sqrt(WIDTH))
        self.p = p
        self.q, self.pq = p["E"] @ p["Wq"] * late, p["P"][WINDOW - STEP :] @ p["Wq"] * late
        self.kv = np.concatenate([p["E"] @ p["Wk"], p["E"] @ p["Wv"]], 1)
        self.pkv = np.concatenate([p["P"] @ p["Wk"], p["P"] @ p["Wv"]], 1)
        self.first = np.concatenate([p["Uh"], p["Wg"]], 1)
        self.open = (_LATER == 0).astype(np.float32)

    def __call__(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        p, n = self.p, len(context)
        tokens, goal = np.maximum(context, 0), np.maximum(target, 0)
        kv = self.kv[tokens]
        kv += self.pkv
        now = tokens[:, WINDOW - STEP :]
        q = self.q[now]
        q += self.pq
        a = q @ kv[:, :, :WIDTH].transpose(0, 2, 1)
        np.minimum(a, BOUND, out=a)
        np.exp(a, out=a)
        a *= self.open
        if (context < 0).any():
            a *= (context >= 0)[:, None]
        a /= (a @ np.ones(WINDOW, a.dtype))[..., None] + np.float32(1e-30)
        h = a @ kv[:, :, WIDTH:]
        h += p["E"][now]
        h += p["P"][WINDOW - STEP :]
        h = h.reshape(n * STEP, WIDTH)
        r = h @ p["W1"]
        r += p["b1"]
        np.maximum(r, 0, out=r)
        h += r @ p["W2"]
        both = h @ self.first
        goal = goal.reshape(-1)
        hi, lo = goal // np.int32(GROUP), goal & np.int32(GROUP - 1)
        rows = np.arange(n * STEP)
        lh = np.ascontiguousarray(both[:, :GROUP])
        lh += p["bh"]
        g = p["C"][hi]
        g += both[:, GROUP:]
        np.maximum(g, 0, out=g)
        ll = g @ p["Ul"]
        ll += p["Bl"][hi]
        out = np.zeros(n * STEP, np.float32)
        for x, which in ((lh, hi), (ll, lo)):
            np.minimum(x, BOUND, out=x)
            out += x[rows, which]
            np.exp(x, out=x)
            out -= np.log(x @ np.ones(GROUP, x.dtype))
        return np.where(target >= 0, out.reshape(n, STEP), 0)


def gradient(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean loss of the targets and its gradient."""
    c: dict = {}
    value = log_probabilities(p, context, target, c)
    real = (target >= 0).astype(np.float32)
    scale = real / max(1.0, float(real.sum()))
    d = {}

    def rows(z: np.ndarray) -> np.ndarray:
        return z.reshape(-1, z.shape[-1])

    def back(log_soft: np.ndarray, which: np.ndarray) -> np.ndarray:
        z = np.exp(log_soft)
        rows(z)[np.arange(which.size), which.reshape(-1)] -= 1
        z *= scale[..., None]
        return z

    dl = back(c["ll"], c["lo"])
    d["Ul"] = rows(c["g"]).T @ rows(dl)
    groups = np.zeros((c["hi"].size, GROUP), np.float32)
    groups[np.arange(c["hi"].size), c["hi"].reshape(-1)] = 1
    d["Bl"] = groups.T @ rows(dl)
    dg = _times(dl, p["Ul"].T) * (c["g"] > 0)
    d["Wg"] = rows(c["m"]).T @ rows(dg)
    d["C"] = groups.T @ rows(dg)
    dh_ = back(c["lh"], c["hi"])
    one = np.ones(c["hi"].size, dh_.dtype)
    d["Uh"], d["bh"] = rows(c["m"]).T @ rows(dh_), one @ rows(dh_)
    dm = _times(dh_, p["Uh"].T) + _times(dg, p["Wg"].T)
    d["W2"] = rows(c["r"]).T @ rows(dm)
    dr = _times(dm, p["W2"].T) * (c["r"] > 0)
    d["W1"], d["b1"] = rows(c["h"]).T @ rows(dr), one @ rows(dr)
    dh = dm + _times(dr, p["W1"].T)
    da, dv = dh @ c["v"].transpose(0, 2, 1), c["a"].transpose(0, 2, 1) @ dh
    # The sum of da * a over the keys is what dh makes of a @ v.
    da -= (dh * (c["h"] - c["late"])).sum(-1, keepdims=True)
    da *= c["a"]
    ds = da * np.float32(1 / np.sqrt(WIDTH))
    dq, dk = ds @ c["k"], ds.transpose(0, 2, 1) @ c["q"]
    d["Wq"], d["Wk"], d["Wv"] = rows(c["late"]).T @ rows(dq), rows(c["x"]).T @ rows(dk), rows(c["x"]).T @ rows(dv)
    dx = _times(dk, p["Wk"].T) + _times(dv, p["Wv"].T)
    dx[:, WINDOW - STEP :] += dh + _times(dq, p["Wq"].T)
    if (context < 0).any():
        dx *= (context >= 0)[..., None]
    d["P"] = dx.sum(0)
    cell = c["tokens"].reshape(-1, 1) * WIDTH + np.arange(WIDTH)
    d["E"] = np.bincount(cell.reshape(-1), dx.reshape(-1), PLACES * WIDTH).reshape(PLACES, WIDTH).astype(dx.dtype)
    return -float(value.sum()) / max(1.0, float(real.sum())), d


def train(flat: np.ndarray, blocks: Iterator[tuple[np.ndarray, np.ndarray]], seed: int, steps: int) -> tuple[np.ndarray, int]:
    """One worker's share of a round: batches of all windows of ``blocks``, and their number.

    A block's windows are mixed. ``steps`` is about how many batches there are; at least ``LEAST_STEPS`` are made.
    """
    draw = np.random.default_rng(seed)
    flat, step, seen = flat.copy(), 0, 0
    steps = max(LEAST_STEPS, steps)
    first, second = np.zeros_like(flat), np.zeros_like(flat)

    def learn(context: np.ndarray, target: np.ndarray) -> None:
        nonlocal step
        step += 1
        _, d = gradient(unpack(flat), context, target)
        g = np.concatenate([d[n].reshape(-1) for n in _shapes()])
        first[:] += 0.1 * (g - first)
        second[:] += 0.01 * (g * g - second)
        rate = RATE * min(1.0, 20 * step / steps) * max(0.05, 1.05 - step / steps)
        flat[:] -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)

    for context, target in blocks:
        seen += len(context)
        order = draw.permutation(len(context))
        for k in range(0, len(order), BATCH):
            learn(context[order[k : k + BATCH]], target[order[k : k + BATCH]])
    while seen and step < LEAST_STEPS:
        pick = order[np.arange(step * BATCH, (step + 1) * BATCH) % len(order)]
        learn(context[pick], target[pick])
    return flat, seen


def _read_training(path: str):
    """Counts of words and subwords, and the streams of all texts, of a map task."""
    schema = ["kind", "key", "n", "ids"]

    def rows(kind: int, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(n), pa.nulls(len(key), pa.binary())], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        subword = np.zeros(1 << 16, np.int64)
        keys, counts, held = [], [], 0
        for piece in pieces(batches, size=PIECE):
            h, _, ids, bounds, _ = read(piece.column("text"), path)
            kinds, n = np.unique(h, return_counts=True)
            keys.append(kinds)
            counts.append(n)
            held += len(kinds)
            if held > 2_000_000:
                yield rows(WORD, *_merged(keys, counts))
                keys, counts, held = [], [], 0
            subword += np.bincount(ids, minlength=len(subword))
            row, size, text, number = runs(ids, bounds)
            key = mix(piece.column("spread").to_numpy().view(np.uint64)[text] + number.astype(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), STREAM, np.int32)), pa.array(key), pa.array(size), pa.array(row, pa.binary())], schema)
        if keys:
            yield rows(WORD, *_merged(keys, counts))
        seen = np.flatnonzero(subword)
        yield rows(SUBWORD, seen, subword[seen])

    return run


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    kinds, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return kinds.view(np.int64), np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


def _places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The alphabet place of each subword, the log share of each within OTHER, and the shares of the places.

    ``counts`` holds the subwords' counts and, last, the number of ends.
    """
    ends, counts = counts[-1], counts[:-1]
    order = np.lexsort((np.arange(len(counts)), -counts))[: PLACES - 2]
    place = np.full(len(counts), OTHER, np.int64)
    place[order] = np.arange(2, len(order) + 2)
    rest = place == OTHER
    within = np.where(rest, np.log((counts + 1) / max(1, (counts[rest] + 1).sum())), 0.0)
    share = np.bincount(place, counts, PLACES) + 0.5
    share[END] += ends
    return place, within, share / share.sum()


def _blocks(batches: Iterator[pa.RecordBatch], place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of stored rows in alphabet places, about ``BUFFER`` at a time."""
    known = np.full(OUTSIDE + 1, -1, np.int32)
    known[: len(place)] = place
    known[ENDING] = END
    held, size = [], 0
    for batch in batches:
        for row in batch.column("ids"):
            held.append(windows_of(row.as_buffer()))
            size += len(held[-1][0])
            if size >= BUFFER:
                yield tuple(known[np.concatenate(x)] for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(known[np.concatenate(x)] for x in zip(*held))


def _fit(streams: DataFrame, place: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Rounds of parallel training with averaged weights."""
    flat = initial(share)
    streams = streams.withColumn("round", F.pmod(F.xxhash64("key"), F.lit(ROUNDS)))
    sizes = {r["round"]: r["n"] for r in streams.groupBy("round").agg(F.sum("n").alias("n")).collect()}
    for number in range(ROUNDS):
        rows = streams.where(F.col("round") == number).select("ids")
        start, steps = flat, sizes.get(number, 0) // (BATCH * max(1, rows.rdd.getNumPartitions()))

        def run(batches: Iterator[pa.RecordBatch], start: np.ndarray = start, number: int = number, steps: int = steps) -> Iterator[pa.RecordBatch]:
            new, seen = train(start, _blocks(batches, place), number, steps)
            if seen:
                index = np.arange(len(new), dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(index), pa.array(new.astype(np.float64) * seen), pa.array(np.full(len(new), seen, np.int64))], ["i", "v", "n"])

        got = rows.mapInArrow(run, "i int, v double, n long").groupBy("i").agg((F.sum("v") / F.sum("n")).alias("v")).toPandas()
        if len(got):
            flat = np.zeros(len(start), np.float32)
            flat[got["i"].to_numpy()] = got["v"].to_numpy()
    return flat


def score(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = documents.sparkSession
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(FOLDS))
    training = documents.where(remainder != HELD).select("text", F.xxhash64("doc_id", "text").alias("spread"))
    gathered = stored(training.mapInArrow(_read_training(tokenizer), "kind int, key long, n long, ids binary"), "gathered")
    ends = training.count()
    counts = stored(gathered.where(F.col("kind") == WORD).groupBy("key").agg(F.sum("n").alias("n")), "counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    total, distinct = total + ends, distinct + (ends > 0)
    frequent = -(-total // FREQUENT)
    # At most FREQUENT words can be that frequent: 16 MB.
    often = counts.where(F.col("n") >= max(1, frequent)).toPandas()
    order = np.argsort(often["key"].to_numpy(np.int64))
    often_keys, often_counts = often["key"].to_numpy(np.int64)[order], often["n"].to_numpy(np.int64)[order]
    got = gathered.where(F.col("kind") == SUBWORD).groupBy("key").agg(F.sum("n").alias("n")).toPandas()
    per_subword = np.zeros(subwords(tokenizer).get_piece_size() + 1, np.int64)
    per_subword[got["key"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    per_subword[-1] = ends
    place, within, share = _places(per_subword)
    weights = _fit(gathered.where(F.col("kind") == STREAM).select("key", "n", "ids"), place, share)
    shared = spark.sparkContext.broadcast((often_keys, often_counts, place, within, weights))
    norm = np.log10(total + distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, known, place, within, weights = shared.value
        scorer, task, at = Scorer(unpack(weights)), TaskContext.get().partitionId() << 33, 0
        for piece in pieces(batches, size=PIECE):
            h, bounds, ids, id_bounds, sizes = read(piece.column("text"), tokenizer)
            n = piece.num_rows
            text = np.repeat(np.arange(n), np.diff(bounds))
            signed = h.view(np.int64)
            slot = np.minimum(np.searchsorted(keys, signed), max(0, len(keys) - 1))
            hit = keys[slot] == signed if len(keys) else np.zeros(len(h), bool)
            base = np.bincount(text[hit], np.log10(known[slot[hit]] + 1.0) - norm, n) + (np.log10(ends + 1.0) - norm)
            n_known = np.bincount(text[hit], minlength=n) + (ends > 0)
            word, end = _score_words(scorer, place, within, ids, id_bounds, sizes, bounds)
            full = np.bincount(text[hit], _mixed(word[hit], known[slot[hit]], total), n) + _mixed(end, np.full(n, ends), total)
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(text[~hit], minlength=n))]), pa.int32())
            columns = {
                "doc_id": piece.column("doc_id"),
                "held_out": piece.column("held_out"),
                "row": pa.array(task + at + np.arange(n)),
                "n_tokens": pa.array(np.diff(bounds) + 1),
                "known": pa.array(n_known.astype(np.int64)),
                "base": pa.array(base),
                "score": pa.array(full),
                "rare": pa.ListArray.from_arrays(offsets, pa.array(signed[~hit])),
                "given": pa.ListArray.from_arrays(offsets, pa.array(word[~hit])),
            }
            at += n
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    kind = documents.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(remainder == HELD, F.lit(False))
    schema = f"doc_id {kind}, held_out boolean, row long, n_tokens long, known long, base double, score double, rare array<long>, given array<double>"
    scored = stored(documents.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, schema), "scored")
    words_ = scored.select("row", F.explode(F.arrays_zip("rare", "given")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.given").alias("given"))
    joined = words_.join(counts.where(F.col("n") < max(1, frequent)), "key", "left")
    corpus = F.log10(F.lit(MIX) * F.col("n") / max(1, total))
    model = F.col("given") + float(np.log10(1 - MIX))
    mixed = F.when(F.col("n").isNull(), model).otherwise(F.greatest(corpus, model) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(corpus - model))))
    rest = joined.groupBy("row").agg(
        F.sum(F.log10(F.coalesce("n", F.lit(0)) + 1.0) - float(norm)).alias("rest"), F.count("n").alias("more"), F.sum(mixed).alias("mixed")
    )
    out = scored.select("doc_id", "held_out", "row", "n_tokens", "known", "base", "score").join(rest, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("mixed", F.lit(0.0))).alias("score"),
    )


def _mixed(model: np.ndarray, count: np.ndarray, total: int) -> np.ndarray:
    """log10 of MIX * count / total + (1 - MIX) * 10^model."""
    model = model + np.log10(1 - MIX)
    with np.errstate(divide="ignore"):
        corpus = np.log10(MIX * count / max(1, total))
    high, low = np.maximum(corpus, model), np.minimum(corpus, model)
    return high + np.log10(1 + 10 ** (low - high))


def _score_words(scorer: Scorer, place: np.ndarray, within: np.ndarray, ids: np.ndarray, bounds: np.ndarray, sizes: np.ndarray, words_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the model gives each word and each text's end, as log10 probabilities."""
    context, target, _, _ = windows(place[ids], bounds, END)
    given = np.concatenate([scorer(context[k : k + SCORED_AT_ONCE], target[k : k + SCORED_AT_ONCE]) for k in range(0, len(target), SCORED_AT_ONCE)])
    given = given[target >= 0].astype(np.float64)  # the subwords of a text, then its end
    last = bounds[1:] + np.arange(len(bounds) - 1)
    end, inner = given[last], np.delete(given, last) + within[ids]
    sums = np.concatenate([[0.0], np.cumsum(inner)])
    edge = np.concatenate([[0], np.cumsum(sizes)])
    return (sums[edge[1:]] - sums[edge[:-1]]) / np.log(10), end / np.log(10)
