"""Written tables, membership bits and connected components shared by the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import configure, materialize

#: Rows of an Arrow batch handed to Python; texts are long, so batches are small.
BATCH_ROWS = 1000
#: Bits of the membership filter: 512 KB on the driver and in each task, whatever the number of members.
FILTER_BITS = 1 << 22


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    return materialize(df, name)


_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def members_filter(ids: DataFrame, column: str) -> np.ndarray:
    """A bit table of fixed size that says for an integer id whether it may be among ``ids``.

    Its size is ``FILTER_BITS``; with more members it only lets more rows through, which the later join drops.
    """
    spread = F.xxhash64(F.col(column).cast("long"))
    bit = F.pmod(spread, F.lit(FILTER_BITS))
    filled = (
        ids.where(F.col(column).isNotNull())
        .groupBy(F.floor(bit / 64).cast("int").alias("cell"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(cast({column} as long)), {FILTER_BITS}), 64) as int))")).alias("bits"))
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    got = filled.toPandas()
    out[got["cell"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out


def spread_expr(column: str) -> str:
    """SQL of the position that ``members_filter`` gives an id."""
    return f"cast(pmod(xxhash64(cast({column} as long)), {FILTER_BITS}) as int)"


def may_contain(bits: np.ndarray, position: np.ndarray) -> np.ndarray:
    cell = bits.view(np.uint64)[position >> 6]
    return (cell >> (position & 63).astype(np.uint64)) & np.uint64(1) != 0


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) of every linked node; the component is its smallest member.

    Alternates the large-star and small-star steps until the edge set stands still. A node's neighbours are
    never gathered: each step is a grouped minimum and a join, so a centre with a third of all nodes is
    pre-aggregated and its join is split. Each round is a written table; only its row count and a checksum come
    back to the driver.
    """
    edges = links.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).where("u <> v").distinct()
    edges = stored(edges, "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stored(small, "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == tuple(state):
            break
        before = tuple(state)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
