"""Exact k-nearest-neighbour vote as a partitioned join.

Train rows are assigned to the nearest of some pivots, whose number grows with the square root of the rows. For a query,
the triangle inequality gives an upper bound on its k-th distance (from the k smallest pivot distances of every cell) and a
lower bound on the distance to any row of a cell (from the cell's radius). Only cells that can still hold a neighbour are
visited, and cells nobody visits are sent nowhere. With many inputs nearly every query visits nearly every cell, so what a
query visits is kept as one bit a cell, and visited cells are put together to pieces of bounded size (crowded ones are cut):
a query is sent once to a piece, and a piece once to each block of its own visitors. Every task compares a bounded block
with a bounded piece and returns k rows per query, merged by rank. Queries take turns, and the merged rows of a turn are
stored, so the disk holds what is sent in one turn at a time.

Within a task, rows of both sides are sorted by their length. A slice of queries passes the train rows in chunks, those of
most similar length first; a chunk whose lengths are further away than the k-th distance found so far is left out, since no
distance is smaller than the difference of two lengths. The others are compared by one matrix product in single precision;
what lies within the k-th distance plus the largest error of that product is measured again, input by input in double
precision, and only these distances are ranked and returned.

A query with a missing input has no neighbours, and a train row with one is nobody's neighbour.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.session import materialize

#: Fewest and most pivots.
PIVOTS, MOST_PIVOTS = 16, 1024
#: Train rows of a piece, queries of a block, and blocks of a turn.
PIECE_ROWS, BLOCK_ROWS, TURN_BLOCKS = 131072, 32768, 8
#: Queries and train rows compared at once.
SLICE, CHUNK = 256, 2048
FOUND = "customer_id string, neighbour string, distance double, label int"


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of all rows of two blocks, one input after the other, so no block is held once for each input."""
    out = np.zeros((len(a), len(b)))
    for column in range(a.shape[1] if a.ndim == 2 else 0):
        out += (a[:, column, None] - b[None, :, column]) ** 2
    return np.sqrt(out, out=out)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of pairs of rows, one input after the other."""
    out = np.zeros(len(a))
    for column in range(a.shape[1]):
        out += (a[:, column] - b[:, column]) ** 2
    return np.sqrt(out, out=out)


def nearest_rows(asked: np.ndarray, there: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, distance) of the k nearest rows of each query, by distance and then by row; rows with a NaN are far from all."""
    by_length = np.argsort(length := np.sqrt((there**2).sum(1)), kind="stable")
    by_length = by_length[np.isfinite(length[by_length])]
    length, sorted_rows = length[by_length], there[by_length]
    single, squares = sorted_rows.astype(np.float32), (length**2).astype(np.float32)
    starts = np.arange(0, len(length), CHUNK)
    own = np.sqrt((asked**2).sum(1))
    queries = np.argsort(own, kind="stable")
    queries = queries[np.isfinite(own[queries])]
    error = 4 * (there.shape[1] + 8) * float(np.finfo(np.float32).eps)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries) if len(length) and k else 0, SLICE):
        part = queries[a : a + SLICE]
        x, mine = asked[part], own[part]
        x_single, n = x.astype(np.float32), len(part)
        limit = np.full(n, np.inf)
        row, at, far = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        ends = np.minimum(starts + CHUNK, len(length)) - 1
        away = np.maximum(np.maximum(length[starts] - mine[-1], mine[0] - length[ends]), 0)
        middle = np.abs(length[(starts + ends) // 2] - mine[n // 2])
        for c in np.lexsort((middle, away)):
            if away[c] > limit.max() * (1 + 1e-9):
                continue
            span = slice(starts[c], ends[c] + 1)
            # The squared distance without the query's own square, which is the same for a whole row.
            near = x_single @ single[span].T
            near *= -2
            near += squares[span]
            slack = error * (mine + length[ends[c]]) ** 2
            if not np.isfinite(limit).all() and near.shape[1] > k:
                within = np.partition(near, k - 1, axis=1)[:, k - 1].astype(np.float64) + 2 * slack
            else:
                within = np.full(n, np.inf)
            within = np.minimum(within, limit**2 * (1 + 1e-9) - mine**2 + slack)
            r, column = np.nonzero(near <= within[:, None])
            if not len(r):
                continue
            column = column + starts[c]
            row, at = np.concatenate([row, r]), np.concatenate([at, column])
            far = np.concatenate([far, _exact(x[r], sorted_rows[column])])
            # The k best of each query so far; of equal distances the first rows.
            order = np.lexsort((by_length[at], far, row))
            row, at, far = row[order], at[order], far[order]
            heads = np.searchsorted(row, np.arange(n))
            kept = np.arange(len(row)) - heads[row] < k
            row, at, far = row[kept], at[kept], far[kept]
            size = np.bincount(row, minlength=n)
            last = np.cumsum(size) - 1
            limit = np.where(size == k, far[np.maximum(last, 0)], np.inf)
        out.append((part[row], by_length[at], far))
    if not out:
        return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    return tuple(np.concatenate([o[i] for o in out]) for i in range(3))


def nearest_neighbours(
    queries: DataFrame, train: DataFrame, columns: Sequence[str], label: str, k: int, seed: int = 42, report: dict | None = None
) -> DataFrame:
    """``customer_id``, ``neighbour``, ``distance`` and the neighbour's ``label``: k rows per query.

    ``report`` is given the numbers of pivots, visits, and train rows sent.
    """
    names = list(columns)
    inputs = F.array(*[F.col(c).cast("double") for c in names]).alias("x")
    points = train.select(F.col("customer_id").alias("neighbour"), F.col(label).cast("int").alias("label"), inputs)
    order = F.md5(F.concat(F.lit(f"{seed}:pivot:"), F.col("neighbour")))
    wanted = min(MOST_PIVOTS, max(PIVOTS, isqrt(train.count())))

    def matrix(rows: pd.DataFrame) -> np.ndarray:
        out = np.empty((len(rows), len(names)))
        for i, x in enumerate(rows["x"]):
            out[i] = x
        return out

    pivots = matrix(points.orderBy(order).limit(wanted).select("x").toPandas())
    # A pivot with a missing input is near nothing.
    pivots = pivots[np.isfinite(pivots).all(1)]

    def assign(batches):
        for whole in batches:
            for start in range(0, len(whole) if len(pivots) else 0, SLICE):
                part = whole.iloc[start : start + SLICE]
                gaps = _distances(matrix(part), pivots)
                cell = gaps.argmin(axis=1)
                reach = gaps[np.arange(len(part)), cell]
                yield part.assign(cell=cell, reach=reach)[~np.isnan(reach)]

    cells = materialize(points.mapInPandas(assign, points.schema.simpleString()[7:-1] + ", cell int, reach double"), "cells")
    profile = cells.groupBy("cell").agg(F.count("*").alias("rows"), F.max("reach").alias("radius")).collect()
    nearest = F.row_number().over(W.partitionBy("cell").orderBy("reach"))
    inner = cells.select("cell", "reach").withColumn("r", nearest).filter(F.col("r") <= k).collect()
    # At most MOST_PIVOTS x k numbers describe the cells.
    radius = np.full(len(pivots), -1.0)
    rows = np.zeros(len(pivots), dtype=int)
    for row in profile:
        radius[row.cell], rows[row.cell] = row.radius, row.rows
    inner_cell = np.array([row.cell for row in inner], dtype=int)
    inner_reach = np.array([row.reach for row in inner])

    def visit(batches):
        for whole in batches:
            for start in range(0, len(whole) if len(inner_reach) else 0, SLICE):
                part = whole.iloc[start : start + SLICE]
                gaps = _distances(matrix(part), pivots)
                last = min(k, len(inner_reach)) - 1
                bound = np.partition(gaps[:, inner_cell] + inner_reach, last, axis=1)[:, last]
                lower = np.maximum(gaps - radius, 0.0)
                visited = (lower <= bound[:, None] * (1 + 1e-9)) & (radius >= 0)
                yield part.assign(cells=[bits.tobytes() for bits in np.packbits(visited, axis=1)])[visited.any(axis=1)]

    asked = queries.select("customer_id", inputs)
    visits = materialize(asked.mapInPandas(visit, asked.schema.simpleString()[7:-1] + ", cells binary"), "visits")

    def unpacked(part: pd.DataFrame) -> np.ndarray:
        bits = np.frombuffer(b"".join(part["cells"]), np.uint8).reshape(len(part), -1)
        return np.unpackbits(bits, axis=1, count=len(pivots)).astype(bool)

    def tally(batches):
        sums, n = np.zeros(len(pivots), dtype=np.int64), 0
        for part in batches:
            if len(part):
                sums, n = sums + unpacked(part).sum(axis=0), n + len(part)
        yield pd.DataFrame({"sums": [sums.tobytes()], "n": [n]})

    visitors, asking = np.zeros(len(pivots), dtype=np.int64), 0
    for row in visits.select("cells").mapInPandas(tally, "sums binary, n long").collect():  # one row a task
        visitors, asking = visitors + np.frombuffer(bytes(row["sums"]), np.int64), asking + row["n"]

    # Visited cells are put together to pieces; a crowded one is cut into several.
    first, parts, filled, piece = np.zeros(len(pivots), dtype=int), np.ones(len(pivots), dtype=int), 0, -1
    for cell in np.argsort(np.sqrt((pivots**2).sum(1)), kind="stable"):
        if not visitors[cell]:
            continue
        parts[cell] = max(1, -(-rows[cell] // PIECE_ROWS))
        if piece < 0 or parts[cell] > 1 or filled + rows[cell] > PIECE_ROWS:
            piece, filled = piece + 1, 0
        first[cell] = piece
        piece, filled = piece + parts[cell] - 1, filled + rows[cell] if parts[cell] == 1 else PIECE_ROWS
    pieces = piece + 1

    def place(batches):
        for part in batches:
            seen, own = unpacked(part) if len(part) else np.zeros((0, len(pivots)), bool), np.zeros((len(part), pieces), bool)
            for cell in np.flatnonzero(visitors):
                own[:, first[cell] : first[cell] + parts[cell]] |= seen[:, cell, None]
            yield part.drop(columns="cells").assign(pieces=[np.flatnonzero(r).astype(np.int32) for r in own])

    kind = asked.schema.simpleString()[7:-1] + ", pieces array<int>"
    placed = visits.mapInPandas(place, kind)
    turns = max(1, -(-asking // (BLOCK_ROWS * TURN_BLOCKS)))
    mine = placed.withColumn("piece", F.explode("pieces")).drop("pieces")
    blocks = np.ones(max(pieces, 1), dtype=int)
    for row in mine.groupBy("piece").count().collect():
        blocks[row["piece"]] = -(-row["count"] // (turns * BLOCK_ROWS))

    def listed(values: np.ndarray, at: str):
        return F.element_at(F.array(*[F.lit(int(v)) for v in values], F.lit(0)), F.col(at) + 1)

    cut = F.pmod(F.xxhash64("neighbour"), listed(parts, "cell")).cast("int")
    there = cells.filter(listed(visitors > 0, "cell") > 0).select("neighbour", "label", "x", (listed(first, "cell") + cut).alias("piece"))
    if report is not None:
        sizes = {r["piece"]: r["count"] for r in there.groupBy("piece").count().collect()}
        report |= {"pivots": len(pivots), "visits": int(visitors.sum()), "sent": int(sum(n * blocks[p] for p, n in sizes.items()) * turns)}

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.sort_values("neighbour", kind="stable", na_position="first")
        query, row, distance = nearest_rows(matrix(left), matrix(right), k)
        return pd.DataFrame(
            {
                "customer_id": left["customer_id"].to_numpy()[query],
                "neighbour": right["neighbour"].to_numpy()[row],
                "distance": distance,
                "label": right["label"].to_numpy()[row],
            }
        )

    rank = F.row_number().over(W.partitionBy("customer_id").orderBy("distance", "neighbour"))
    block = F.pmod(F.xxhash64("customer_id", F.lit("block")), listed(blocks, "piece")).cast("int")
    sent = there.withColumn("block", F.explode(F.sequence(F.lit(0), listed(blocks, "piece") - 1)))
    found = None
    for turn in range(turns):
        own = mine.filter(F.pmod(F.xxhash64("customer_id"), F.lit(turns)) == turn).withColumn("block", block)
        local = own.groupBy("piece", "block").cogroup(sent.groupBy("piece", "block")).applyInPandas(compare, FOUND)
        merged = materialize(local.withColumn("rank", rank).filter(F.col("rank") <= k), "neighbours")
        found = merged if found is None else found.unionByName(merged)
    return found


def neighbour_vote(neighbours: DataFrame) -> DataFrame:
    """Inverse-distance share of class one; a neighbour at distance zero outvotes all others."""
    exact = F.col("distance") == 0
    votes = neighbours.groupBy("customer_id").agg(
        F.sum(F.when(exact, F.col("label"))).alias("exact_ones"),
        F.count_if(exact).alias("exact_all"),
        F.sum(F.when(~exact, F.col("label") / F.col("distance"))).alias("near_ones"),
        F.sum(F.when(~exact, 1 / F.col("distance"))).alias("near_all"),
    )
    share = F.when(F.col("exact_all") > 0, F.col("exact_ones") / F.col("exact_all")).otherwise(
        F.col("near_ones") / F.nullif(F.col("near_all"), F.lit(0.0))
    )
    return votes.select("customer_id", share.alias("churn_probability"))
