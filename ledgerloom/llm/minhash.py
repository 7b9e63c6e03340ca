"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Two permutations of ``UNIVERSE`` places are drawn once: the first scatters a shingle, the second, shifted by one
place for each coordinate, ranks it. A shingle at place p has the ranks second[p], second[p + 1], ...: coordinate k
of a signature is the smallest second[p + k] over the text's shingles, so one row of neighbouring ranks gives all
coordinates at once.

Texts with equal shingle sets form a class; its smallest id speaks for it. In each band bucket every class is
paired with the smallest one (a star, linear in the bucket), pairs are verified on full sets, and links become
components. Only buckets whose classes still lie in different components are compared further: their classes are cut
into blocks of bounded size, and a task intersects the full sets of two blocks and reports the links between
different components. With 32 bands of 4 coordinates a pair at the threshold shares no bucket with a chance of 5e-6.

Defined results: null and blank texts have empty sets and are linked with nothing; rows with a null id take part in
no link, have a null component and stay; rows that repeat an id are one node; ties go to the smallest id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import components, may_contain, members_filter, spread_expr, stored
from ledgerloom.llm.text import mix, pieces, shingles, utf8, word_hashes, words

UNIVERSE = 1 << 20
BANDS, BAND_ROWS = 32, 4
PERCENT = 75
#: Classes of a block of a bucket; a task intersects two blocks, ``COLUMNS`` shingles at a time.
BLOCK, COLUMNS = 512, 8192

_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def permutations(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and a view whose row p holds the ranks of place p for every coordinate."""
    if seed not in _TABLES:
        draw = np.random.default_rng(seed)
        first = draw.permutation(UNIVERSE).astype(np.uint32)
        second = draw.permutation(UNIVERSE).astype(np.uint32)
        k = BANDS * BAND_ROWS
        _TABLES[seed] = first, np.lib.stride_tricks.sliding_window_view(np.concatenate([second, second[: k - 1]]), k)
    return _TABLES[seed]


def signature(hashes: np.ndarray) -> np.ndarray:
    first, ranks = permutations()
    places = first[(hashes >> np.uint64(44)).astype(np.int64)]
    out = np.full(BANDS * BAND_ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(places), 4096):
        np.minimum(out, ranks[places[at : at + 4096]].min(0), out=out)
    return out


def shingle_sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    found = words(*utf8(column))
    h, bounds = shingles(word_hashes(found), found.bounds)
    return [np.unique(h[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


SKETCH = "n long, f1 long, f2 long, bands array<long>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in pieces(batches):
        sets = shingle_sets(piece.column("text"))
        n = np.array([len(s) for s in sets], np.int64)
        f1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
        f2 = np.array([mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets], np.uint64)
        signs = np.stack([signature(s) for s in sets])
        wide = signs.reshape(len(sets), BANDS, BAND_ROWS).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
        for r in range(BAND_ROWS):
            key = mix(key * np.uint64(0xD6E8FEB86659FD93) + wide[:, :, r])
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * BANDS, pa.int32()), pa.array(key.reshape(-1).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), flat], ["doc_id", "n", "f1", "f2", "bands"]
        )


def sets_of(documents: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """(id, set) of the texts that may be wanted; the membership bits keep other texts out of the shuffle."""
    bits = members_filter(wanted, column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            piece = piece.filter(pa.array(may_contain(bits, piece.column("place").to_numpy())))
            if piece.num_rows:
                sets = pa.array([s.tobytes() for s in shingle_sets(piece.column("text"))], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column("id"), sets], ["id", "set"])

    rows = documents.where("doc_id is not null").selectExpr("doc_id as id", "text", f"{spread_expr('doc_id')} as place")
    kind = documents.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, set binary")


def verify(pairs: DataFrame, documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets have 100 * intersection >= percent * union."""
    pairs = stored(pairs, "pairs")
    sets = sets_of(documents, pairs.select(F.explode(F.array("a", "b")).alias("id")), "id")
    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                few, many = (x, y) if len(x) < len(y) else (y, x)
                if 100 * len(few) < percent * len(many):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                both = int((many[at] == few).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    kind = pairs.schema["a"].dataType.simpleString()
    return joined.mapInArrow(run, f"a {kind}, b {kind}").distinct()


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left with the right sets, by products of incidence blocks."""
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(np.concatenate(sets), kind="stable")
    values, row = np.concatenate(sets)[order], row[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1  # a shingle of one set is in no intersection
    row, column = row[often], column[often]
    fresh = np.ones(len(column), bool)
    fresh[1:] = column[1:] != column[:-1]
    column = np.cumsum(fresh) - 1
    out = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [at, at + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[row[a:b], column[a:b] - at] = 1
        out += part[left] @ part[right].T
    return out


def _cross_links(kind: str, percent: int):
    """Links between different components within one block of a bucket or between two."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        ids, comp, block = rows["id"].to_numpy(), rows["component"].to_numpy(), rows["block"].to_numpy()
        if (comp == comp[0]).all():
            return pd.DataFrame({"a": ids[:0], "b": ids[:0]})
        left, right = np.flatnonzero(block == rows["i"].iloc[0]), np.flatnonzero(block == rows["j"].iloc[0])
        sets = [np.frombuffer(v, np.uint64) for v in rows["set"]]
        size = np.array([len(s) for s in sets])
        both = _intersections(sets, left, right)
        x, y = np.nonzero((100 * both >= percent * (size[left][:, None] + size[right][None] - both)) & (comp[left][:, None] != comp[right][None]))
        x, y = ids[left[x]], ids[right[y]]
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)}).drop_duplicates()

    return run, f"a {kind}, b {kind}"


def near_duplicates(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    sketch = stored(documents.select("doc_id", "text").mapInArrow(_sketch, f"doc_id {kind}, {SKETCH}"), "sketch")
    usable = sketch.where("doc_id is not null and n > 0")
    classes = stored(usable.groupBy("f1", "f2", "n").agg(F.min(F.struct("doc_id", "bands")).alias("first")).select("f1", "f2", "n", "first.*"), "classes")
    bands = classes.select(F.col("doc_id").alias("id"), F.explode("bands").alias("bucket"))
    heads = bands.groupBy("bucket").agg(F.min("id").alias("a"), F.count("*").alias("size")).where("size > 1")
    star = bands.join(heads, "bucket").where("id <> a").select("a", F.col("id").alias("b")).distinct()
    same_id = usable.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    twins = usable.join(same_id, "doc_id").join(classes.select("f1", "f2", "n", F.col("doc_id").alias("head")), ["f1", "f2", "n"]).select(F.least("head", "doc_id").alias("a"), F.greatest("head", "doc_id").alias("b")).where("a <> b")
    links = stored(verify(star, documents, percent).unionByName(twins), "links")
    label = stored(components(links), "labels")
    found = stored(_across(documents, bands, label, percent), "links")
    if not found.isEmpty():
        label = stored(components(links.unionByName(found)), "labels")
    named = classes.join(label, classes["doc_id"] == label["node"], "left").select("f1", "f2", "n", F.coalesce("component", "doc_id").alias("component_id"))
    out = sketch.join(named, ["f1", "f2", "n"], "left")
    linked = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    out = out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _across(documents: DataFrame, bands: DataFrame, label: DataFrame, percent: int) -> DataFrame:
    """Links between components that share a bucket of three or more classes, as verified stars leave them."""
    placed = bands.join(label.select(F.col("node").alias("id"), "component"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    placed = stored(placed, "placed")
    split = placed.groupBy("bucket").agg(F.min("component").alias("first"), F.max("component").alias("last"), F.count("*").alias("size")).where("first <> last and size > 2")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rows = stored(placed.join(split.select("bucket", blocks.alias("blocks")), "bucket"), "open")
    sets = sets_of(documents, rows, "id")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pair = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least("block", k).alias("i"), F.greatest("block", k).alias("j")))
    rows = rows.withColumn("pair", F.explode(pair)).select("bucket", "pair.i", "pair.j", "block", "id", "component").join(sets, "id")
    run, schema = _cross_links(bands.schema["id"].dataType.simpleString(), percent)
    return rows.groupBy("bucket", "i", "j").applyInPandas(run, schema).distinct()


def deduplicate(documents: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: those of one document of each component.

    Rows of one id are one document and stay or go together; of rows that repeat an id and its text one stays. Rows with
    a null id all stay.
    """
    gone = near_duplicates(documents).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    salt = "salt" + "_" * max(map(len, documents.columns))
    rest = documents.join(gone, documents["doc_id"] == gone["gone"], "left_anti")
    same = F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id().cast("string")).otherwise(F.md5(F.coalesce("text", F.lit(""))))
    return rest.withColumn(salt, same).dropDuplicates(["doc_id", salt]).drop(salt)
