"""Embedding near-duplicates by robust-pruned flat graphs.

Only vectors with equal labels (and lengths) are compared, by cosine in double precision. Equal vectors form a class
that is searched once. Per label, spherical k-means cells are fitted on a bounded sample; every class is indexed in
its two nearest cells, so cells overlap. A cell above ``PIECE`` classes is cut by a hash into pieces. Each piece
builds a graph in which a robust prune keeps edges in different directions; a class's adjacency lists from all its
pieces are united. Every class then searches all pieces of every cell that can be the nearest of a vector in range:
such a vector lies beyond the plane between the two centres, so a cell is left out only if the class is farther from
that plane than two vectors in range can be from each other. A piece is searched greedily from its medoid, and once
in range every neighbour in range is expanded. A hit counts in its nearest cell only; its second cell only leads the
search. Hits are verified in double precision. A task reports a count for each query and a spanning forest of its
links, never all pairs.

The recall is audited against brute force for ``AUDIT`` classes chosen by hash, and the search is repeated with a
doubled beam while it is below ``RECALL``. After ``WIDENINGS`` beams the pieces are compared row by row instead, and
if even that stays below, the query fails.

Defined results: a vector that is null, zero, empty or has null or non-finite components, or whose label or id is
null, has no links; its component is its own id (null if the id is null) and it stays. Rows that repeat an id and
vector are copies of each other. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import components, stored

COSINE = 0.98
#: Rows that cells are fitted on: at most so many and so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 64 << 20
CELL, PIECE = 700, 1500
NEAR, DEGREE, ALPHA, BEAM = 48, 20, 1.2, 24
AUDIT, RECALL, WIDENINGS = 200, 0.9, 3
SLACK = 1e-4


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of unit length in double precision; scaled first, so that squares neither vanish nor overflow."""
    rows = rows / np.abs(rows).max(1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(values) -> np.ndarray:
    return np.array([np.asarray(v, np.float64) for v in values])


def build(x: np.ndarray) -> tuple[int, np.ndarray]:
    """The medoid, and padded adjacency lists (-1) of a graph in which every row can be reached from it."""
    n = len(x)
    x = x.astype(np.float32)
    sim = x @ x.T
    medoid = int((x @ x.mean(0)).argmax())
    np.fill_diagonal(sim, -2)
    k = min(NEAR, n - 1)
    if k <= 0:
        return medoid, np.full((n, 1), -1, np.int64)
    cand = np.argpartition(-sim, k - 1, axis=1)[:, :k]
    far = np.random.default_rng(n).integers(0, n, (n, 8))
    cand = np.concatenate([cand, far], 1)
    gap = np.sqrt(np.maximum(2 - 2 * np.take_along_axis(sim, cand, 1), 0))
    order = np.argsort(gap, axis=1, kind="stable")
    cand, gap = np.take_along_axis(cand, order, 1), np.take_along_axis(gap, order, 1)
    alive = cand != np.arange(n)[:, None]
    out = np.full((n, DEGREE), -1, np.int64)
    rows = np.arange(n)
    for slot in range(DEGREE):
        best = alive.argmax(1)
        some = alive[rows, best]
        if not some.any():
            break
        star = cand[rows, best]
        out[some, slot] = star[some]
        between = np.sqrt(np.maximum(2 - 2 * sim[star[:, None], cand], 0))
        alive &= some[:, None] & (ALPHA * between > gap) & (cand != star[:, None])
    return medoid, _connected(out, medoid, sim)


def _connected(adjacent: np.ndarray, medoid: int, sim: np.ndarray) -> np.ndarray:
    """Add an edge from the nearest reachable row to each part that the medoid doesn't reach."""
    n = len(adjacent)
    reached = np.zeros(n, bool)
    reached[medoid] = True
    extra: list[tuple[int, int]] = []
    frontier = np.array([medoid])
    while True:
        while len(frontier):
            to = np.unique(adjacent[frontier])
            frontier = to[(to >= 0) & ~reached[to]]
            reached[frontier] = True
        rest = np.flatnonzero(~reached)
        if not len(rest):
            break
        known = np.flatnonzero(reached)
        extra.append((int(known[sim[rest[0], known].argmax()]), int(rest[0])))
        frontier = rest[:1]
        reached[frontier] = True
    if extra:
        size = np.bincount([a for a, _ in extra], minlength=n)
        more, at = np.full((n, size.max()), -1, np.int64), np.zeros(n, np.int64)
        for a, b in extra:
            more[a, at[a]] = b
            at[a] += 1
        adjacent = np.concatenate([adjacent, more], 1)
    return adjacent


def search(queries: np.ndarray, x: np.ndarray, adjacent: np.ndarray, medoid: int, beam: int, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs with a cosine of at least ``cosine`` that greedy search meets."""
    q32, x32 = queries.astype(np.float32), x.astype(np.float32)
    n, total = len(x), len(queries)
    seen, open_ = np.zeros((total, n), bool), np.zeros((total, n), bool)
    ids = np.full((total, beam), -1, np.int64)
    sims = np.full((total, beam), -2.0, np.float32)
    fresh = np.zeros((total, beam), bool)
    ids[:, 0], sims[:, 0], fresh[:, 0], seen[:, medoid] = medoid, q32 @ x32[medoid], True, True
    open_[:, medoid] = sims[:, 0] >= cosine - SLACK
    hits = [(np.flatnonzero(open_[:, medoid]), np.full(int(open_[:, medoid].sum()), medoid))]
    live = np.arange(total)
    while len(live):
        first = fresh[live].argmax(1)
        live = live[fresh[live, first]]
        first = fresh[live].argmax(1)
        if not len(live):
            break
        node = ids[live, first]
        fresh[live, first] = False
        open_[live, node] = False
        to = adjacent[node]
        row, col = np.nonzero((to >= 0) & ~seen[live[:, None], to])
        who, what = live[row], to[row, col]
        pair = np.unique(who * n + what)
        who, what = pair // n, pair % n
        seen[who, what] = True
        value = np.einsum("ij,ij->i", q32[who], x32[what])
        near = value >= cosine - SLACK
        open_[who[near], what[near]] = True
        hits.append((who[near], what[near]))
        width = np.bincount(who, minlength=total)[live]
        new_ids, new_sims = np.full((len(live), width.max(initial=0)), -1, np.int64), np.full((len(live), width.max(initial=0)), -2.0, np.float32)
        at = np.searchsorted(live, who)
        slot = np.arange(len(who)) - np.repeat(np.cumsum(width) - width, width)
        new_ids[at, slot], new_sims[at, slot] = what, value
        all_ids, all_sims = np.concatenate([ids[live], new_ids], 1), np.concatenate([sims[live], new_sims], 1)
        all_fresh = np.concatenate([fresh[live], new_ids >= 0], 1)
        best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
        ids[live], sims[live], fresh[live] = (np.take_along_axis(v, best, 1) for v in (all_ids, all_sims, all_fresh))
    while open_.any():  # range expansion: every neighbour of a row in range, until none is new
        who, node = np.nonzero(open_)
        open_[:] = False
        for at in range(0, len(who), 50_000):
            a, b = who[at : at + 50_000], adjacent[node[at : at + 50_000]]
            row, col = np.nonzero((b >= 0) & ~seen[a[:, None], b])
            pair = np.unique(a[row] * n + b[row, col])
            u, v = pair // n, pair % n
            seen[u, v] = True
            near = np.einsum("ij,ij->i", q32[u], x32[v]) >= cosine - SLACK
            open_[u[near], v[near]] = True
            hits.append((u[near], v[near]))
    who, what = (np.concatenate([h[k] for h in hits]) for k in (0, 1))
    keep = np.concatenate([np.einsum("ij,ij->i", queries[who[k : k + 50_000]], x[what[k : k + 50_000]]) >= cosine for k in range(0, len(who), 50_000)] or [np.zeros(0, bool)])
    return who[keep], what[keep]


def scan(queries: np.ndarray, x: np.ndarray, cosine: float = COSINE) -> tuple[np.ndarray, np.ndarray]:
    """(query, row) pairs with a cosine of at least ``cosine``, all of them."""
    return np.nonzero(queries @ x.T >= cosine)


def _cells(sample: pd.DataFrame, sizes: dict) -> dict:
    """Unit centres of each (label, length) group of the sample."""
    out = {}
    for key, rows in sample.groupby(["label", "dim"]):
        x = unit(matrix(rows["v"]))
        k = int(max(1, min(-(-sizes.get(key, len(x)) // CELL), len(x) // 8)))
        centres = x[np.random.default_rng(7).choice(len(x), k, replace=False)]
        for _ in range(8):
            home = (x @ centres.T).argmax(1)
            sums = np.zeros_like(centres)
            np.add.at(sums, home, x)
            size = np.linalg.norm(sums, axis=1)
            centres = np.where(size[:, None] > 1e-9, sums / np.maximum(size, 1e-9)[:, None], centres)
        out[key] = centres
    return out


def reachable_cells(x: np.ndarray, centres: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Whether a vector with a cosine of at least ``cosine`` to the row can have its nearest centre in the cell.

    With home centre c, such a y of cell d has y (c - d) <= 0, so the row's x (c - d) is at most |x - y| |c - d|.
    """
    sim = x @ centres.T
    home = sim.argmax(1)
    apart = np.sqrt(np.maximum(2 - 2 * (centres @ centres.T), 0))
    apart += 1e-6  # centres that nearly coincide lose digits
    return sim.max(1)[:, None] - sim <= np.sqrt(max(2 - 2 * cosine, 0)) * apart[home] + 1e-9


def _assigner(centres: dict, first: dict, cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            flat, ends = batch.column("v").flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(dims)])
            cells = np.zeros((batch.num_rows, 2), np.int64)
            sought: list = [None] * batch.num_rows
            groups: dict = {}
            for row, key in enumerate(zip(labels, dims)):
                groups.setdefault(key, []).append(row)
            for key, rows in groups.items():
                if key not in centres:  # no row of the group is in the sample: one cell of its own
                    cells[rows] = -1 - zlib.crc32(repr(key).encode())
                    for r in rows:
                        sought[r] = cells[r, :1]
                    continue
                x = unit(np.stack([flat[ends[r] : ends[r + 1]] for r in rows]).astype(np.float64))
                sim = x @ centres[key].T
                for r, may in zip(rows, reachable_cells(x, centres[key], cosine)):
                    sought[r] = np.flatnonzero(may) + first[key]
                best = sim.argmax(1)
                sim[np.arange(len(rows)), best] = -3
                second = sim.argmax(1) if sim.shape[1] > 1 else best
                cells[rows] = np.stack([best, second], 1) + first[key]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells[:, 0]), pa.array(cells[:, 1]), pa.array(sought, pa.list_(pa.int64()))], [*batch.schema.names, "home", "other", "sought"])

    return run


def _build_piece(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("id")
    ids = rows["id"].to_numpy()
    _, adjacent = build(unit(matrix(rows["v"])))
    return pd.DataFrame({"id": ids, "to": [ids[a[a >= 0]] for a in adjacent]})


def _search_piece(beam: int | None, cosine: float):
    """Without a beam every row is compared."""

    def run(index: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(index) or not len(queries):
            return pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")
        index = index.sort_values("id")
        if beam is None:
            index = index[index["own"]]
            if not len(index):
                return pd.DataFrame({"id": [], "links": [], "root": []}, dtype="int64")
        ids, copies, own = index["id"].to_numpy(), index["copies"].to_numpy(), index["own"].to_numpy(bool)
        x = unit(matrix(index["v"]))
        asked = queries["asked"].to_numpy()
        if beam is None:
            return _counted(asked, ids, copies, *scan(unit(matrix(queries["x"])), x, cosine))
        lists = [np.asarray(t, np.int64) for t in index["to"]]
        at = [np.searchsorted(ids, t) for t in lists]
        at = [a[(a < len(ids)) & (ids[np.minimum(a, len(ids) - 1)] == t)] for a, t in zip(at, lists)]
        adjacent = np.full((len(ids), max(1, max(map(len, at)))), -1, np.int64)
        for row, a in enumerate(at):
            adjacent[row, : len(a)] = a
        medoid = int((x @ x.mean(0)).argmax())
        adjacent = _connected(adjacent, medoid, (x @ x.T).astype(np.float32))
        who, what = search(unit(matrix(queries["x"])), x, adjacent, medoid, beam, cosine)
        return _counted(asked, ids, copies, who[own[what]], what[own[what]])

    return run


def _counted(asked: np.ndarray, ids: np.ndarray, copies: np.ndarray, who: np.ndarray, what: np.ndarray) -> pd.DataFrame:
    """(id, links, root) of the hits of a task."""
    other = asked[who] != ids[what]
    who, what = who[other], what[other]
    links = np.bincount(who, copies[what], len(asked)).astype(np.int64)
    names, inverse = np.unique(np.concatenate([asked, ids]), return_inverse=True)
    root = _roots(len(names), inverse[who], np.searchsorted(names, ids[what]))
    count = np.zeros(len(names), np.int64)
    count[inverse[: len(asked)]] = links
    keep = (count > 0) | (root != np.arange(len(names)))
    return pd.DataFrame({"id": names[keep], "links": count[keep], "root": names[root[keep]]})


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = np.minimum(new, root)
        while (new[new] != new).any():
            new = new[new]
        if (new[a] == new[b]).all() and (new == root).all():
            return root
        root = new


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    sound = F.expr("forall(embedding, c -> c is not null and not isnan(c) and abs(c) < double('infinity')) and exists(embedding, c -> c <> 0)")
    v = F.col("embedding").cast("array<double>")
    usable = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound, F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), v.alias("v"), usable.alias("usable"))
    rows = rows.withColumn("dim", F.size("v")).withColumn("k1", F.xxhash64("v")).withColumn("k2", F.xxhash64(F.lit("second"), "v"))
    good = rows.where("usable")
    classes = stored(good.groupBy("label", "dim", "k1", "k2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"), F.first("v").alias("v")), "classes")
    sizes = {(r["label"], r["dim"]): r["count"] for r in classes.groupBy("label", "dim").count().orderBy(F.desc("count")).limit(SAMPLE_ROWS).collect()}
    widest = max((k[1] for k in sizes), default=1)
    bound = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * widest)))
    centres = _cells(classes.orderBy(F.xxhash64("id"), "id").limit(bound).select("label", "dim", "v").toPandas(), sizes)
    first, at = {}, 0
    for key, c in centres.items():
        first[key], at = at, at + len(c)
    placed = classes.select("id", "copies", "label", "dim", "v").mapInArrow(_assigner(centres, first, cosine), "id long, copies long, label string, dim int, v array<double>, home long, other long, sought array<long>")
    placed = stored(placed, "placed")
    index = placed.select("id", "copies", "v", "home", F.explode(F.array_distinct(F.array("home", "other"))).alias("cell")).withColumn("own", F.expr("cell = home")).drop("home")
    pieces = index.groupBy("cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("pieces"))
    index = index.join(pieces, "cell").withColumn("piece", F.pmod(F.xxhash64("id"), F.col("pieces")).cast("int"))
    queries = placed.select(F.col("id").alias("asked"), F.col("v").alias("x"), F.explode("sought").alias("cell"))
    # Queries of a cell are cut as well, so a task has one piece and one block of queries.
    blocks = queries.groupBy("cell").agg(F.ceil(F.count("*") / PIECE).cast("int").alias("blocks"))
    queries = queries.join(pieces, "cell").join(blocks, "cell")
    queries = queries.withColumn("block", F.pmod(F.xxhash64("asked", F.lit("block")), F.col("blocks")).cast("int"))
    queries = queries.withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))).drop("pieces", "blocks")
    sought = index.join(blocks, "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("pieces", "blocks")
    graph = index.groupBy("cell", "piece").applyInPandas(_build_piece, "id long, to array<long>")
    # At most two lists of bounded length for each class.
    graph = stored(graph.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("to"))).alias("to")), "graph")
    for beam in [*(BEAM << k for k in range(WIDENINGS)), None]:
        found = sought.join(graph, "id").groupBy("cell", "piece", "block").cogroup(queries.groupBy("cell", "piece", "block")).applyInPandas(_search_piece(beam, cosine), "id long, links long, root long")
        found = stored(found, "found")
        recall = audit(classes, found, cosine)
        if recall >= RECALL:
            break
    else:
        raise RuntimeError(f"the search found {recall:.3f} of the audited links, less than {RECALL}")
    label = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).where("a <> b"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    named = classes.drop("v").join(counts, "id", "left").join(label.withColumnRenamed("node", "id"), "id", "left")
    named = named.select("label", "dim", "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    out = good.select("vec_id", "label", "dim", "k1", "k2").join(named, ["label", "dim", "k1", "k2"]).select("vec_id", "n_links", "component_id")
    out = out.unionByName(rows.where("not usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def audit(classes: DataFrame, found: DataFrame, cosine: float = COSINE, rows: int = AUDIT) -> float:
    """Share of the links of ``rows`` classes, chosen by hash, that the search found; brute force reads all classes."""
    asked = classes.orderBy(F.xxhash64("id", F.lit("audit")), "id").limit(rows).select("id", "label", "dim", "v").toPandas()
    groups = {key: (g["id"].to_numpy(), unit(matrix(g["v"]))) for key, g in asked.groupby(["label", "dim"])}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for key, g in batch.groupby(["label", "dim"]):
                if key in groups:
                    ids, x = groups[key]
                    hit = (x @ unit(matrix(g["v"])).T >= cosine) & (ids[:, None] != g["id"].to_numpy()[None])
                    yield pd.DataFrame({"id": ids, "true": (hit * g["copies"].to_numpy()[None]).sum(1)})

    true = classes.select("id", "label", "dim", "v", "copies").mapInPandas(run, "id long, true long").groupBy("id").agg(F.sum("true").alias("true"))
    both = true.join(found.groupBy("id").agg(F.sum("links").alias("links")), "id", "left")
    links, met = both.agg(F.sum("true"), F.sum(F.least("true", F.coalesce("links", F.lit(0))))).first()
    return met / links if links else 1.0
