"""Language identification in two steps: the family, then one-versus-one linear support vector machines within it.

Features are hashed three-byte sequences of the lower-cased text, in which everything but letters is one separator;
their counts' square roots have unit length. The families of languages come from a table; a language that it does
not name is a family of its own. Machines (squared hinge) are fitted in numpy on a bounded sample of labelled rows;
whole texts are predicted in one map pass, and nothing but the text is an input of a prediction.

Defined results: a null text or one without a letter is ``und`` with score 0, and so is every text if no labelled
row can be learned from; with one learned language that one is predicted with score 1; ties go to the language that
comes first; rows with a null id are never learned from, are not held out and are predicted like others; rows that
repeat an id are predicted one by one.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.text import LOWER, pieces, utf8

#: Labelled rows learned from: at most so many of each language, chosen by a hash of the id, and in all.
ROWS_PER_LANGUAGE, ROWS_IN_ALL = 300, 6000
PLACES = 4096
UNKNOWN = "und"
FOLDS, HELD = 4, 2

# Languages by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy".split(),
    "romance": "fr es it pt ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr sl mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz".split(),
    "indic": "hi bn mr ne pa gu ur".split(),
    "semitic": "ar he am mt".split(),
    "sinitic": "zh yue".split(),
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}

_LETTER = np.zeros(256, bool)
_LETTER[[*range(97, 123), *range(128, 256)]] = True
_SYMBOL = np.where(_LETTER, np.arange(256), 32).astype(np.uint32)


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A unit row for each text (zero for empty ones), and whether the text has a letter."""
    data, offsets = utf8(column)
    lower = LOWER[data]
    code = _SYMBOL[lower]
    out = np.zeros((len(column), PLACES), np.float32)
    has = np.zeros(len(column), bool)
    ascii_letter = (lower >= 97) & (lower <= 122)
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        c = code[a:b]
        if len(c) >= 3:
            h = (c[:-2] * np.uint32(0x9E3779B1) + c[1:-1] * np.uint32(0x85EBCA6B)) ^ (c[2:] * np.uint32(0xC2B2AE35))
            h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            out[row] = np.sqrt(np.bincount(h >> np.uint32(20), minlength=PLACES))
            # Runs of separators say nothing of the language.
            norm = np.linalg.norm(out[row])
            out[row] /= norm if norm else 1
        has[row] = ascii_letter[a:b].any() or any(ch.isalpha() for ch in data[a:b].tobytes().decode("utf-8", "replace"))
    return out, has


@dataclass
class Machines:
    """Named classes with a linear machine for each pair of them."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    bias: np.ndarray

    def decide(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class with most wins of each row (then largest margin sum), and its smallest margin."""
        n, k = len(x), len(self.names)
        wins, total, least = np.zeros((n, k)), np.zeros((n, k)), np.full((n, k), np.inf)
        margins = x @ self.weights.T + self.bias if self.pairs else np.zeros((n, 0))
        for (i, j), m in zip(self.pairs, margins.T):
            for c, value in ((i, m), (j, -m)):
                wins[:, c] += value > 0 if c == i else value >= 0
                total[:, c] += value
                least[:, c] = np.minimum(least[:, c], value)
        best = (wins + 0.25 * np.tanh(total)).argmax(1)
        return best, least[np.arange(n), best]


@dataclass
class LanguageModel:
    families: Machines
    within: dict[str, Machines]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, margin = self.families.decide(x)
        names, score = np.empty(len(x), object), 1 / (1 + np.exp(-4 * np.minimum(margin, 20)))
        for f, name in enumerate(self.families.names):
            rows = np.flatnonzero(family == f)
            if len(rows):
                best, inner = self.within[name].decide(x[rows])
                names[rows] = np.array(self.within[name].names, object)[best]
                score[rows] *= 1 / (1 + np.exp(-4 * np.minimum(inner, 20)))
        return names, score


def machines(x: np.ndarray, labels: np.ndarray, ridge: float = 1e-4, steps: int = 250) -> Machines:
    names = sorted(set(labels.tolist()))
    pairs = list(itertools.combinations(range(len(names)), 2))
    weights, bias = np.zeros((len(pairs), x.shape[1]), np.float32), np.zeros(len(pairs), np.float32)
    for row, (i, j) in enumerate(pairs):
        pick = np.flatnonzero((labels == names[i]) | (labels == names[j]))
        weights[row], bias[row] = _fit_pair(x[pick], np.where(labels[pick] == names[i], 1.0, -1.0).astype(np.float32), ridge, steps)
    return Machines(names, pairs, weights, bias)


def _fit_pair(x: np.ndarray, y: np.ndarray, ridge: float, steps: int) -> tuple[np.ndarray, float]:
    """Squared hinge with a ridge, both classes with equal weight, by accelerated gradient steps."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = v = np.zeros(x.shape[1] + 1, np.float32)
    rate = 1 / (4 + ridge)
    for step in range(steps):
        slack = np.maximum(1 - y * (x @ v[:-1] + v[-1]), 0)
        g = -2 * share * y * slack
        gradient = np.append(x.T @ g + ridge * v[:-1], g.sum())
        ahead = v - rate * gradient
        v = ahead + step / (step + 3) * (ahead - w)
        w = ahead
    return w[:-1], float(w[-1])


def _remainder(folds: int) -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))


def fit(documents: DataFrame) -> LanguageModel | None:
    rows = documents.where(F.col("lang").isNotNull() & (_remainder(FOLDS) != HELD)).select("doc_id", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    # A row number below a constant is cut inside map tasks, so a hot language isn't gathered.
    chosen = rows.withColumn("r", F.row_number().over(order)).where(F.col("r") <= ROWS_PER_LANGUAGE).orderBy("r", "lang").limit(ROWS_IN_ALL).select("doc_id").distinct()
    # At most ROWS_IN_ALL ids.
    sample = documents.select("doc_id", "lang", "text").where("lang is not null").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x, has = features(piece.column("text"))
            keep = np.flatnonzero(has)
            rows = pa.array([r.tobytes() for r in x[keep].astype(np.float16)], pa.binary())
            yield pa.RecordBatch.from_arrays([piece.column("lang").take(pa.array(keep)), rows], ["lang", "x"])

    got = sample.mapInArrow(run, "lang string, x binary").toPandas()
    if not len(got):
        return None
    x = np.frombuffer(b"".join(got["x"]), np.float16).reshape(len(got), PLACES).astype(np.float32)
    lang = got["lang"].to_numpy(object)
    family = np.array([FAMILY_OF.get(code.lower().split("-")[0], code) for code in lang], object)
    return LanguageModel(machines(x, family), {f: machines(x[family == f], lang[family == f]) for f in sorted(set(family))})


def predict(documents: DataFrame, model: LanguageModel | None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            x, has = features(piece.column("text"))
            names, score = np.full(len(x), UNKNOWN, object), np.zeros(len(x))
            rows = np.flatnonzero(has) if model else []
            if len(rows):
                names[rows], score[rows] = model.predict(x[rows])
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(names, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    held = F.coalesce(_remainder(FOLDS) == HELD, F.lit(False))
    return documents.select("doc_id", held.alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
