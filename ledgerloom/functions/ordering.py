"""Global order statistics that never sort a whole column in one task.

Rows are first collapsed to (value, measures), so ties, however many, become one row. Distinct values are
then spread over buckets that are monotone in the value and roughly equal in size (edges come from a
mergeable sketch). Only the bucket totals, a table of fixed size, are summed across buckets; inside a
bucket a window does the rest. The result is exact: the sketch only decides how the work is cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Edges are searched in two steps of GROUP - 1 comparisons.
GROUP = 12
BUCKETS = GROUP * GROUP


def _bucketed(counts: DataFrame, key: Sequence[str], value: str) -> DataFrame:
    """Add a ``bucket`` that grows with ``value`` within each (low-cardinality) ``key``."""
    grid = [i / BUCKETS for i in range(1, BUCKETS)]
    edges = counts.groupBy(*key).agg(F.percentile_approx(value, grid, 20 * BUCKETS).alias("edges"))
    every = [F.get("edges", F.lit(i * GROUP - 1)) for i in range(1, GROUP)]
    edges = edges.withColumn("coarse", F.array(*every))
    if key:
        # One row per key: callers pass keys with a handful of values (a column name, a segment, a class).
        joined = counts.join(F.broadcast(edges), list(key), "left")
    else:
        found = edges.select(F.struct("edges", "coarse").alias("e")).scalar()
        joined = counts.withColumn("_e", found).withColumns({"edges": F.col("_e.edges"), "coarse": F.col("_e.coarse")})
        joined = joined.drop("_e")
    below = joined.withColumn("_c", F.size(F.filter("coarse", lambda e: e < F.col(value))))
    near = F.slice("edges", F.col("_c") * GROUP + 1, F.lit(GROUP - 1))
    bucket = F.col("_c") * GROUP + F.size(F.filter(near, lambda e: e < F.col(value)))
    return below.withColumn("bucket", bucket).drop("edges", "coarse", "_c")


def _bucket_starts(placed: DataFrame, key: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Exclusive prefix sums over at most (keys x buckets) rows, plus the totals per key."""
    totals = placed.groupBy(*key, "bucket").agg(*[F.sum(m).alias(f"{m}_here") for m in measures])
    upto = W.partitionBy(*key).orderBy("bucket")
    whole = W.partitionBy(*key)
    return totals.select(
        *key,
        "bucket",
        *[F.col(f"{m}_here") for m in measures],
        *[(F.sum(f"{m}_here").over(upto) - F.col(f"{m}_here")).alias(f"{m}_start") for m in measures],
        *[F.sum(f"{m}_here").over(whole).alias(f"{m}_total") for m in measures],
    )


def running_totals(
    counts: DataFrame, value: str, measures: Sequence[str], key: Sequence[str] = ()
) -> DataFrame:
    """``counts`` (one row per key and value) with ``<m>_before`` and ``<m>_total`` for each measure."""
    placed = _bucketed(counts, key, value)
    starts = _bucket_starts(placed, key, measures)
    inside = W.partitionBy(*key, "bucket").orderBy(value)
    # At most one row per key and bucket.
    joined = placed.join(F.broadcast(starts), [*key, "bucket"])
    before = [
        (F.col(f"{m}_start") + F.sum(m).over(inside) - F.col(m)).alias(f"{m}_before") for m in measures
    ]
    return joined.select(*counts.columns, *before, *[F.col(f"{m}_total") for m in measures])


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
) -> DataFrame:
    """Linearly interpolated quantiles in long form: by..., column, prob, value.

    ``df`` is read more than once, so pass a stored table or a cheap projection of one.
    ``by`` must be of low cardinality (segments, classes, partitions): one sketch is broadcast per group.
    """
    key = [*by, "column"]
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(*by, F.explode(cells).alias("cell")).select(*by, "cell.column", "cell.value")
    counts = long.filter("value IS NOT NULL").groupBy(*key, "value").agg(F.count("*").alias("n"))
    placed = _bucketed(counts, key, "value")
    starts = _bucket_starts(placed, key, ["n"])
    position = F.col("prob") * (F.col("n_total") - 1)
    wanted = (
        starts.withColumn("prob", F.explode(F.array(*[F.lit(float(p)) for p in probs])))
        .withColumn("position", position)
        .withColumn("rank", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))))
        .filter("n_start <= rank AND rank < n_start + n_here")
        .select(*key, "bucket", "n_start", "prob", "position", "rank")
    )
    # At most two ranks per key and probability survive, so only their buckets are ordered.
    hit = placed.join(F.broadcast(wanted), [*key, "bucket"])
    upto = F.col("n_start") + F.sum("n").over(W.partitionBy(*key, "prob", "rank").orderBy("value"))
    found = hit.withColumn("upto", upto).filter("upto - n <= rank AND rank < upto")
    low, high = F.min("value"), F.max("value")
    fraction = F.first("position") - F.floor(F.first("position"))
    return found.groupBy(*key, "prob").agg((low + (high - low) * fraction).alias("value"))


def fit_quantiles(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float]:
    """Global quantiles as plain numbers, frozen for later use: name -> (column, probability)."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    found = {(r.column, r.prob): r.value for r in exact_quantiles(df, columns, probs).collect()}
    return {name: found[(c, float(p))] for name, (c, p) in wanted.items()}


def ordered_rank(df: DataFrame, stratum: str, order_key: str, name: str = "rank") -> DataFrame:
    """1-based rank by a hexadecimal hash within a low-cardinality stratum, plus the stratum's size.

    A hash is uniform, so its first three digits cut each stratum into 4096 equal slices; the slice counts
    are the only data that crosses slices.
    """
    sliced = df.withColumn("_slice", F.substring(order_key, 1, 3))
    counts = sliced.groupBy(stratum, "_slice").agg(F.count("*").alias("_n"))
    upto = W.partitionBy(stratum).orderBy("_slice")
    starts = counts.select(
        stratum,
        "_slice",
        (F.sum("_n").over(upto) - F.col("_n")).alias("_start"),
        F.sum("_n").over(W.partitionBy(stratum)).alias("stratum_size"),
    )
    inside = W.partitionBy(stratum, "_slice").orderBy(order_key)
    return (
        sliced.join(F.broadcast(starts), [stratum, "_slice"])
        .withColumn(name, F.col("_start") + F.row_number().over(inside))
        .drop("_slice", "_start")
    )
