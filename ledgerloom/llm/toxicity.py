"""Toxicity by cumulative-link ordinal regression over sparse text features.

Features of a text are its distinct words (runs of letters, digits, apostrophes and bytes above 127, lower case) and their
beginnings of four to six characters, hashed to ``BUCKETS`` places. A feature counts by how many standard deviations its
share of toxic labelled texts stands above or below chance, less two; features within two deviations drop out. There is no
other selection: the regression, with a ridge penalty, weighs the rest.

Severity grades come from the labels: grade 0 is not toxic; toxic texts are cut at the median of their evidence (the sum of
their features above chance) into grade 1 and grade 2. One weight a feature is shared by all thresholds:
P(grade > k) = logistic(w.x - threshold_k), and the expected severity is the sum over k.

The probability from which a text is rejected is learned from labelled rows that a fit has not seen: the sample is scored in
``FOLDS`` parts by models of the other parts, and the cut is the lowest one that rejects at most ``FALSE_SHARE`` of the clean
rows, moved to the middle of the gap below the next toxic row. The model is fitted on a bounded sample of labelled rows;
scoring reads every whole text in one map pass.

Defined results: a null or empty text has no features; without usable labels (an empty table, or one class only)
every severity is 0 and nothing is rejected; a repeated label counts once with its largest grade; of rows that repeat a
labelled id the smallest text is fitted; rows with a null id are scored like others; a text without any feature is not
rejected; extra columns are ignored by ``score`` and kept by ``reject``. Very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored
from ledgerloom.llm.text import IS_BREAK, Words, mix, pieces, utf8, word_hashes, words

#: At most this many labelled rows, chosen by a hash of the id, fit the model.
LABELLED_ROWS = 6_000
BUCKETS = 1 << 20
#: (row, feature) pairs of the sample looked at together while fitting.
PAIRS = 1 << 20
BEGINNINGS = (4, 5, 6)
THRESHOLDS = 2
#: Deviations from chance by which a feature is shrunk.
SHRINK = 2
RIDGE = 1e-3
STEPS = 200
FOLDS = 3
FALSE_SHARE = 0.005

SCORES = "severity double, grade int, p_toxic double, toxic boolean, n_cues long"


@dataclass
class OrdinalModel:
    """A weight for each hashed feature, which of them count for toxicity, thresholds, and the rejecting probability."""

    weights: np.ndarray
    above: np.ndarray
    thresholds: np.ndarray
    cut: float = 0.5

    def probabilities(self, signal: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold, one row for each text."""
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - signal[:, None], -60, 60)))


def text_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and word beginning, with repeats."""
    found = words(*utf8(column), separators=IS_BREAK)
    text = np.repeat(np.arange(len(column)), found.counts)
    hashes, texts = [word_hashes(found)], [text]
    head = np.append((found.data & 0xC0) != 0x80, True)
    place, number = np.flatnonzero(head), np.cumsum(head) - 1
    for size in BEGINNINGS:
        end = place[np.minimum(number[found.starts] + size, len(place) - 1)]
        longer = end < found.ends
        hashes.append(mix(word_hashes(Words(found.data, found.starts[longer], end[longer], found.bounds)) + np.uint64(size)))
        texts.append(text[longer])
    return np.concatenate(texts), (np.concatenate(hashes) >> np.uint64(44)).astype(np.int64)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        text, bucket = text_features(piece.column("text"))
        pair = np.unique(text * BUCKETS + bucket)
        ends = np.searchsorted(pair, np.arange(piece.num_rows + 1) * BUCKETS)
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(pair % BUCKETS, pa.int32()))
        yield pa.RecordBatch.from_arrays([piece.column("toxic").cast(pa.int32()), lists], ["toxic", "features"])


def fit(documents: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> OrdinalModel | None:
    """Fit on at most ``rows`` labelled texts; None if the labels have fewer than two classes."""
    known = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    # At most ``rows`` pairs of numbers: small enough to be sent to every task.
    found = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sample = stored(found.orderBy("doc_id").select("text", "toxic").mapInArrow(_features, "toxic int, features array<int>"), "labelled")
    toxic, row, col = [], [], []
    for batch in sample.toArrow().to_batches():
        lists, before = batch.column("features"), sum(map(len, toxic))
        toxic.append(batch.column("toxic").to_numpy() > 0)
        row.append(np.repeat(np.arange(before, before + batch.num_rows, dtype=np.int32), np.diff(lists.offsets.to_numpy())))
        col.append(lists.flatten().to_numpy(zero_copy_only=False))
    toxic = np.concatenate([*toxic, np.zeros(0, bool)])
    if not toxic.any() or toxic.all():
        return None
    return fit_features(np.concatenate(row), np.concatenate(col), toxic)


def fit_features(row: np.ndarray, col: np.ndarray, toxic: np.ndarray) -> OrdinalModel:
    """Fit on (row, bucket) pairs and the rows' classes; rows are dealt to the folds in turn, class by class."""
    fold = np.empty(len(toxic), np.int64)
    for side in (toxic, ~toxic):
        fold[side] = np.arange(side.sum()) % FOLDS
    model, chance = _fit_ordinal(row, col, toxic, fold >= 0), np.zeros(len(toxic))
    for k in range(FOLDS):
        seen = fold != k
        if not toxic[seen].any() or toxic[seen].all():
            return model
        part = _fit_ordinal(row, col, toxic, seen)
        signal = sum(np.bincount(row[a : a + PAIRS], part.weights[col[a : a + PAIRS]], len(toxic)) for a in range(0, len(row), PAIRS))
        chance[~seen] = part.probabilities(np.broadcast_to(signal, len(toxic))[~seen])[:, 0]
    return OrdinalModel(model.weights, model.above, model.thresholds, learned_cut(chance, toxic))


def learned_cut(chance: np.ndarray, toxic: np.ndarray) -> float:
    """The lowest cut that is exceeded by at most ``FALSE_SHARE`` of the clean rows, halfway to the next toxic row."""
    clean = np.sort(chance[~toxic])[::-1]
    edge = clean[int(FALSE_SHARE * len(clean))]
    over = chance[toxic & (chance > edge)]
    return float((edge + over.min()) / 2) if len(over) else 0.5


def _base_thresholds(share: float) -> np.ndarray:
    above = np.clip(np.array([share, share / 2]), 1e-6, 1 - 1e-6)
    return np.log((1 - above) / above)


def _fit_ordinal(row: np.ndarray, col: np.ndarray, toxic: np.ndarray, seen: np.ndarray, steps: int = STEPS) -> OrdinalModel:
    """Fit on the rows that ``seen`` names; the pairs of the sample are gone through in pieces."""
    share, places = toxic[seen].mean(), range(0, len(row), PAIRS)
    count, of_toxic = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for a in places:
        r, c = row[a : a + PAIRS], col[a : a + PAIRS]
        count += np.bincount(c[seen[r]], minlength=BUCKETS)
        of_toxic += np.bincount(c[(seen & toxic)[r]], minlength=BUCKETS)
    deviation = (of_toxic - count * share) / np.sqrt(np.maximum(count, 1) * share * (1 - share))
    scale = np.sign(deviation) * np.maximum(np.abs(deviation) - SHRINK, 0)
    uses = [np.flatnonzero((scale[col[a : a + PAIRS]] != 0) & seen[row[a : a + PAIRS]]) + a for a in places]
    use = np.concatenate([*uses, np.zeros(0, np.int64)])
    row, col, toxic = (np.cumsum(seen) - 1)[row[use]], col[use], toxic[seen]
    n = len(toxic)
    place, col = np.unique(col, return_inverse=True)
    value = scale[place][col].astype(np.float32)
    evidence = np.bincount(row, np.maximum(value, 0), n)
    grade = toxic.astype(int) + (toxic & (evidence > 0) & (evidence >= np.median(evidence[toxic])))
    w, theta = np.zeros(len(place)), _base_thresholds(share)
    state = [np.zeros(len(w) + THRESHOLDS) for _ in range(2)]
    for step in range(1, steps + 1):
        signal = np.bincount(row, w[col] * value, n)
        above = 1 / (1 + np.exp(np.clip(theta[None] - signal[:, None], -60, 60)))
        upper = np.concatenate([np.ones((n, 1)), above], 1)[np.arange(n), grade]
        lower = np.concatenate([above, np.zeros((n, 1))], 1)[np.arange(n), grade]
        mass = np.maximum(upper - lower, 1e-9)
        slope_up, slope_low = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        g_signal = slope_low - slope_up
        g_theta = np.array([slope_up[grade == k + 1].sum() - slope_low[grade == k].sum() for k in range(THRESHOLDS)])
        g = np.concatenate([np.bincount(col, g_signal[row] * value, len(w)) / n + RIDGE * w, g_theta / n])
        for s, v, decay in ((0, g, 0.9), (1, g * g, 0.999)):
            state[s] = decay * state[s] + (1 - decay) * v
        move = 0.02 * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, theta = w - move[: len(w)], np.maximum.accumulate(theta - move[len(w) :])
    weights = np.zeros(BUCKETS, np.float32)
    weights[place] = w * scale[place]
    return OrdinalModel(weights, scale > 0, theta)


def _scores(column: pa.Array, model: OrdinalModel | None) -> dict[str, np.ndarray]:
    n = len(column)
    if model is None:
        zero = np.zeros(n)
        return {"severity": zero, "grade": zero.astype(np.int32), "p_toxic": zero, "toxic": zero > 0, "n_cues": zero.astype(np.int64)}
    text, bucket = text_features(column)
    counts = model.weights[bucket] != 0
    pair = np.unique(text[counts] * BUCKETS + bucket[counts])
    text, bucket = pair // BUCKETS, pair % BUCKETS
    signal, hits = np.bincount(text, model.weights[bucket], n), np.bincount(text[model.above[bucket]], minlength=n)
    above = model.probabilities(signal)
    grades = np.concatenate([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]], 1)
    return {"severity": above.sum(1), "grade": grades.argmax(1).astype(np.int32), "p_toxic": above[:, 0], "toxic": (above[:, 0] >= model.cut) & (hits > 0), "n_cues": hits}


def score(documents: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """(doc_id, severity, grade, p_toxic, toxic, n_cues) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            got = _scores(piece.column("text"), model)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *map(pa.array, got.values())], ["doc_id", *got])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, {SCORES}")


def reject(documents: DataFrame, model: OrdinalModel | None) -> DataFrame:
    """The rows that are not toxic, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            yield piece.filter(pa.array(~_scores(piece.column("text"), model)["toxic"]))

    return documents.mapInArrow(run, documents.schema)
