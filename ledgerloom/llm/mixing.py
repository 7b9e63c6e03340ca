"""Mixing sources to target weights by Sainte-Laguë apportionment, word by word.

Sources in code point order, null last, weigh 5, 2, 1, repeating. Together they get 150 per cent of all words; a
source's target stops at twice its size and the excess is shared again by weight. Within a source, documents are
dealt by a seeded hash into shards of about ``SHARD_WORDS`` words.

The number of words to hand out is fixed. All sources compete for them: a source offers the quotients
target / (2 k - 1), one for each word that it may hold, and the highest quotients win. Its shards compete for the words
that it has won in the same way, by their sizes. Nothing may get more than twice its size, and every word is given.

Only the quotients near the cut are ranked. From the number of parties n, the seats and the sum of the votes follow a
divisor at which no party has too much, so what it gives is sure, and one at which there is enough for all seats; what
lies between is about two quotients a party, whatever the number of words.

A shard lays its documents out in seeded order and takes its quota from the front, after as many whole rounds as the
quota holds. A hot source has more shards, not a larger one.

Defined results: null and blank texts have size 0 and nothing is taken; a null source is a source of its own; rows
that repeat an id are mixed one by one; equal quotients go to the source that comes first, then to the lower shard; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored

SHARD_WORDS = 200_000
#: Steps by which the range of ranked quotients grows where the limits of the parties leave seats over.
REACH = (1, 64, 4096)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def targets(sizes: DataFrame) -> DataFrame:
    """(source_key, place, source_size, target) of each source and the words of the whole mix; as many rows as there are sources."""
    every = Window.orderBy("no_source", "source_key")
    rows = sizes.groupBy("source_key", "no_source").agg(F.sum("size").alias("source_size")).withColumn("place", F.row_number().over(every))
    rows = rows.withColumn("weight", F.element_at(F.array(F.lit(5), F.lit(2), F.lit(1)), (F.pmod(F.col("place") - 1, F.lit(3)) + 1).cast("int")))
    rows = rows.withColumn("cap", F.col("source_size") * MOST).withColumn("total", F.sum("source_size").over(Window.partitionBy()) * SHARE)
    tight = Window.orderBy((F.col("cap") / F.col("weight")), "place")
    before = tight.rowsBetween(Window.unboundedPreceding, -1)
    after = tight.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("level", (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(after))
    # The level grows while sources are tight and falls after the first free one: the largest is the one that holds.
    rows = rows.withColumn("level", F.max("level").over(Window.partitionBy()))
    target = F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight"))
    return rows.select("source_key", "no_source", "place", "source_size", target.alias("target"), "total", F.floor(F.col("total") + 0.5).alias("seats"))


def _apportioned(parties: DataFrame, group: list[str], order: str, votes: str, total: str, most: str, seats: str, won: str) -> DataFrame:
    """``parties`` with the seats ``won`` by the highest quotients votes / (2 k - 1), k up to ``most``, of their group.

    ``total`` is the sum of the votes of a group, and its parties may hold all its ``seats`` together.
    """
    whole = Window.partitionBy(*group)
    number = F.count("*").over(whole)

    def given(weight: Column, more: int = 0) -> Column:
        """The seats of a party at the divisor total / weight."""
        plain = F.floor(F.col(votes) * weight / F.col(total) + 0.5).cast("long") + more
        return F.when(F.col(total) > 0, F.least(plain, F.col(most))).otherwise(0)

    rows = parties.withColumn("number", number).withColumn("sure", given(F.greatest(F.col(seats) - F.col("number") / 2 - 1, F.lit(0))))
    upto = [given(F.col(seats) + F.col("number") * step, 1) for step in REACH]
    enough = F.coalesce(*(F.when(F.sum(n).over(whole) >= F.col(seats), F.lit(step)) for step, n in zip(REACH, upto)))
    rows = rows.withColumn("enough", enough).withColumn("open", F.col(seats) - F.sum("sure").over(whole))
    rows = rows.withColumn("reach", F.when(F.col("enough").isNull(), F.col(most)).otherwise(given(F.col(seats) + F.col("number") * F.col("enough"), 1)))
    offered = rows.where("reach > sure").select(*group, order, "open", votes, F.explode(F.sequence(F.col("sure") + 1, F.col("reach"))).alias("k"))
    rank = Window.partitionBy(*group).orderBy(F.desc("quotient"), order, "k")
    offered = offered.withColumn("quotient", F.col(votes).cast("double") / (2 * F.col("k") - 1)).withColumn("rank", F.row_number().over(rank))
    more = offered.where("rank <= open").groupBy(*group, order).agg(F.count("*").alias("more"))
    return rows.join(more, [*group, order], "left").select(*parties.columns, (F.col("sure") + F.coalesce("more", F.lit(0))).alias(won))


def mix(documents: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row."""
    # Spark's patterns know no shorter way to say "not ASCII white space".
    count = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")
    sizes = documents.select(
        "doc_id", "source", count.alias("size"), F.coalesce("source", F.lit("")).alias("source_key"), F.col("source").isNull().alias("no_source")
    )
    sizes = stored(sizes.withColumn("source_key", F.concat(F.when(F.col("no_source"), "1").otherwise("0"), "source_key")), "sizes")
    aims = targets(sizes).withColumn("most", F.col("source_size") * MOST)
    aims = stored(_apportioned(aims, [], "place", "target", "total", "most", "seats", "source_won"), "targets")
    shards = F.greatest(F.ceil(F.col("source_size") / SHARD_WORDS), F.lit(1)).cast("long")
    aims = aims.select("source_key", "source_size", "target", "source_won", shards.alias("shards"))
    name = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string"))
    rows = sizes.join(aims, "source_key").withColumn("key", F.md5(name))
    rows = rows.withColumn("shard", F.pmod(F.conv(F.substring("key", 1, 8), 16, 10).cast("long"), F.col("shards")))
    kept = ("source_size", "source_won")
    quotas = rows.groupBy("source_key", "shard").agg(F.sum("size").alias("shard_size"), *(F.first(c).alias(c) for c in kept))
    quotas = quotas.withColumn("most", F.col("shard_size") * MOST)
    quotas = _apportioned(quotas, ["source_key"], "shard", "shard_size", "source_size", "most", "source_won", "shard_won")
    quotas = quotas.select("source_key", "shard", "shard_size", F.col("shard_won").alias("quota"))
    order = Window.partitionBy("source_key", "shard").orderBy("key", "doc_id")
    rows = rows.join(quotas, ["source_key", "shard"]).withColumn("before", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("quota") / F.col("shard_size"))).otherwise(0)
    rest = F.col("quota") - rounds * F.col("shard_size")
    taken = rounds * F.col("size") + F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return rows.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))
