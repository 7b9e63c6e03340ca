"""Threshold-scaled sketches of documents, with DataFrame functions only.

A document's shingles are its runs of ``SHINGLE_WORDS`` words as written (with fewer words, the whole sequence). A shingle
is hashed by MD5, and a fixed fraction of all hash values is retained: those whose hexadecimal digits sort below
``BELOW``. A document none of whose hashes lies below keeps its smallest one. The retained hashes, sorted and without
repeats, are the sketch; as a string, the first ``DIGITS`` digits of each, joined by commas, are the fingerprint.

Sketches of any documents compare, whatever their sizes: |A and B| / |A| over retained hashes estimates which share of A
is contained in B, and ``merged`` gives the sketch of a union from the sketches of its parts, without the texts.

``with_next`` puts the next document beside each: ids are cut into ranges at quantiles of a bounded summary, the first row
of a range is also sent to the end of the one before, and a window within a range looks one row ahead. An id that fills
several shares is dealt over as many places, where the next row is one of the same place. So no task orders the whole table; texts are shuffled once.

Defined results: a null text is empty; a text without words has an empty fingerprint, which is contained in another
empty one only; nulls come first in the order of ids; rows that repeat an id are neighbours, ordered by a hash of their
text, and equal rows are interchangeable; a single row follows itself; an empty table gives no rows; further columns are
ignored. Very long texts are hashed whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE_WORDS = 5
#: The retained fraction is the share of hexadecimal strings that sort below this one: 1/4.
BELOW = "4"
DIGITS = 10
#: Values the quantile sketch of ids keeps; 1 / ACCURACY of all rows is how far a range may be from its share.
ACCURACY = 10_000
FIRST = -(2**63)
RANGES_PER_PARTITION = 2

#: Between words: space, tab, and the other breaks up to carriage return.
WHITE = "\\t\\n\\u000B\\u000C\\r "


def hashes(text: str, width: int = SHINGLE_WORDS) -> str:
    """SQL of the retained hashes of a text column, sorted."""
    # Words, hashes and retained hashes are arguments of lambdas, so that each is computed once for a text.
    words = f"split(trim(BOTH '{WHITE}' FROM {text}), '[{WHITE}]+')"
    made = f"""transform(array({words}), w -> CASE WHEN w[0] = '' THEN array() WHEN size(w) < {width} THEN array(md5(array_join(w, ' ')))
      ELSE transform(sequence(1, size(w) - {width - 1}), i -> md5(array_join(slice(w, i, {width}), ' '))) END)[0]"""
    cut = f"""transform(array(filter(h, x -> x < '{BELOW}')), low ->
      CASE WHEN size(low) > 0 THEN array_sort(array_distinct(low)) WHEN size(h) > 0 THEN array(array_min(h)) ELSE low END)[0]"""
    return f"transform(array({made}), h -> transform({cut}, x -> substr(x, 1, {DIGITS})))[0]"


def sketch(documents: DataFrame, text: str = "text", name: str = "sketch") -> DataFrame:
    """All columns and the sketch of each row's text as a sorted array of strings."""
    return documents.withColumn(name, F.expr(hashes(f"coalesce({text}, '')")))


def fingerprint(column: str | Column) -> Column:
    return F.array_join(column, ",")


def containment(of: str | Column, other: str | Column) -> Column:
    """Which share of a sketch is found in another one; an empty sketch is contained in an empty one only."""
    size = F.size(of)
    return F.when(size == 0, F.when(F.size(other) == 0, 1.0).otherwise(0.0)).otherwise(F.size(F.array_intersect(of, other)) / size)


def resemblance(one: str | Column, other: str | Column) -> Column:
    """The estimated share of two documents' shingles that both hold; 1 for two empty sketches."""
    both = F.size(F.array_intersect(one, other))
    union = F.size(one) + F.size(other) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def merged(sketches: DataFrame, by: list[str], column: str = "sketch") -> DataFrame:
    """The sketch of the union of each group's documents.

    Hashes are grouped before they are gathered, so a large group is combined on its hash values, not in one task; what
    is gathered is the sketch of the union itself.
    """
    single = sketches.select(*by, F.explode_outer(column).alias("h")).distinct()
    low = single.groupBy(*by).agg(F.array_sort(F.collect_list(F.when(F.col("h") < BELOW, F.col("h")))).alias("low"), F.min("h").alias("least"))
    kept = F.when(F.size("low") > 0, F.col("low")).when(F.col("least").isNotNull(), F.array("least")).otherwise(F.col("low"))
    return low.select(*by, kept.alias(column))


def _ranges(documents: DataFrame, ranges: int) -> list[tuple[int, int]]:
    """(smallest id, number of shares it fills) of each range of ids, ascending; a null id counts as ``FIRST``."""
    shares = ", ".join(str(k / ranges) for k in range(ranges))
    low, cuts = documents.selectExpr(f"coalesce(doc_id, {FIRST}) as k").selectExpr("min(k)", f"percentile_approx(k, array({shares}), {ACCURACY})").first()
    edges = [] if low is None else sorted([low, *cuts[1:]])
    return [(k, edges.count(k)) for k in sorted(set(edges))]


def _at(values: list[int], index: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col(index) + 1)


def with_next(documents: DataFrame, columns: list[str], ranges: int | None = None, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """(doc_id, *columns, next): ``next`` holds the columns of the row that follows by id, of the first row after the last.

    What ``derive`` adds to the rows is made after they were shuffled and is part of ``next`` too.

    ``columns`` begin with the text, whose hash orders rows of one id. An id that fills k shares is dealt over k places,
    and all but the last of them that hold rows close to a ring, so that the next row is one of the same id there.
    """
    cuts = _ranges(documents, ranges or RANGES_PER_PARTITION * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = cuts or [(FIRST, 1)]
    starts, fills = [k for k, _ in cuts], [n for _, n in cuts]
    rows = documents.select("doc_id", *columns, F.expr(f"coalesce(doc_id, {FIRST})").alias("k"), F.xxhash64(columns[0]).alias("tie"))
    rows = rows.withColumn("range", F.size(F.filter(F.array(*[F.lit(k) for k in starts]), lambda start: start <= F.col("k"))) - 1)
    deal = F.when(F.col("k") == _at(starts, "range"), F.pmod(F.monotonically_increasing_id(), _at(fills, "range")).cast("int"))
    rows = rows.withColumn("part", F.coalesce(deal, _at(fills, "range") - 1))
    # At most as many rows as there are ranges: the first row of each, and the last of its places that holds rows.
    ends = rows.groupBy("range").agg(F.min(F.struct("k", "part", "tie")).alias("first"), F.max("part").alias("last"))
    ends = {r["range"]: r for r in ends.collect()}
    first = [ends[j]["first"] if j in ends else (FIRST, -1, 0) for j in range(len(starts))]
    last = [ends[j]["last"] if j in ends else 0 for j in range(len(starts))]
    before = [(j - 1) % len(starts) for j in range(len(starts))]
    leads = (F.col("k") == _at(starts, "range")) & (F.col("part") == _at([f[1] for f in first], "range")) & (F.col("tie") == _at([f[2] for f in first], "range"))
    own = F.struct("range", "part", F.lit(0).alias("guest"))
    guest = F.struct(_at(before, "range").alias("range"), _at([last[j] for j in before], "range").alias("part"), F.lit(1).alias("guest"))
    placed = rows.withColumn("place", F.explode(F.when(leads, F.array(own, guest)).otherwise(F.array(own)))).drop("range", "part")
    placed = derive(placed.select("doc_id", *columns, "k", "tie", "place.*").repartition("range", "part"))
    columns = [c for c in placed.columns if c not in ("doc_id", "k", "tie", "range", "part", "guest")]
    order = Window.partitionBy("range", "part").orderBy("guest", "k", "tie")
    value = F.struct(*columns)
    following = F.coalesce(F.lead(value).over(order), F.first(value).over(order))
    return placed.withColumn("next", following).where("guest = 0").select("doc_id", *columns, "next")


def edited(text: str, following: str) -> str:
    """SQL of a text whose last quarter of code points gives way to the first as many of the following text."""
    n = f"length({text}) div 4"
    return f"concat(left({text}, cast(length({text}) - {n} as int)), left({following}, cast({n} as int)))"


def fingerprints(documents: DataFrame) -> DataFrame:
    """Each row's fingerprint and that of its edited text, and how far its sketch is contained in the edited text's and the next row's."""
    plain = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    paired = with_next(plain, ["text"], derive=sketch).selectExpr("doc_id", "text", "sketch", "next.sketch as next_sketch", f"{edited('text', 'next.text')} as changed")
    both = sketch(paired, "changed", "changed_sketch")
    return both.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("changed", 256).alias("edited_sha256"),
        fingerprint("sketch").alias("fingerprint"),
        fingerprint("changed_sketch").alias("edited_fingerprint"),
        containment("sketch", "changed_sketch").alias("near_edited"),
        containment("sketch", "next_sketch").alias("near_next"),
    )
