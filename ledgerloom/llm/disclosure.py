"""Personal data by information-theoretic sanitisation, in DataFrame and SQL functions only.

Entities (email, ip, card and phone numbers) are found by pattern. The words of a document that holds an entity are
terms that may reveal it: with n documents in all, the information of an entity is IC(e) = log2(n / n_e), and a term
discloses PMI(t, e) = log2(n * n_te / (n_t * n_e)) of it, where n_te counts documents that hold both, anywhere in the
text. A document's term is removed if it discloses at least ``REMOVE_AT`` of IC(e) for any entity e of the document,
generalised to its kind if at least ``GENERALISE_AT``; all its occurrences there are, but those that overlap an entity.

Terms are runs of letters, lower case, from one letter. All counts cover all documents and whole texts, and rows that
repeat a document (same id, same text) count once.

How pairs stay few: entities with the same documents are one class, so a list of addresses in one text is one class.
A term needs n_te / n_t >= (n_e / n) ^ (1 - share), and n_te is at most n_e, so words that are too frequent for every
entity of their document are dropped inside map tasks. A term so rare that one shared document suffices is decided
without its pairs; only the rest meets the classes of its document.

The patterns mean what the plain ones say, but cannot run into quadratic time or deep recursion on long texts: a
match may only begin where the one before ended or where its run of characters begins, and repeats are possessive.
Places are running sums over the pieces between matches, never searches from the front.

Defined results: a null or empty text has no entity, empty spans and the hash of the empty string; rows that repeat
an id have the spans of their own text; an empty table gives no rows; extra columns are kept by ``sanitise``. A text of
any length is one row of its task; its words are rows of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import stored

KINDS = ("email", "ip", "card", "phone", "general", "removed")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this has no match of the kind.
HINTS = {"email": "@", "phone": "+"}
TERM = r"\p{L}[\p{L}\p{M}]*+"
GENERALISE_AT, REMOVE_AT = 0.6, 0.9
#: Words in at least this part of all (document, word) pairs go to every map task: at most its inverse.
FREQUENT = 1 / 50_000
#: Places that repeated documents are hashed to, for a first look inside map tasks.
PLACES = 65_536
#: Elements of a block of a running result, code points of a piece of a text.
BLOCK, CHUNK = 256, 4096

SPAN = "array<struct<s:int,kind:int,e:int>>"
FOUND = "array<struct<s:int,kind:int,e:int,entity:string>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running(values: Column, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``op`` (with 0 neutral) over an array, block by block: appending copies a block, not the array."""
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0))
    none = F.array().cast("array<int>")
    within = lambda block: F.aggregate(block, none, lambda done, x: F.array_append(done, op(last(done), x)))

    def joined(blocks: Column) -> Column:
        tops = F.aggregate(blocks, F.array(F.lit(0)), lambda done, block: F.array_append(done, op(last(done), last(block))))
        return _let(tops, lambda t: F.flatten(F.transform(blocks, lambda block, i: F.transform(block, lambda x: op(F.get(t, i), x)))))

    def cut(v: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(v) - 1, F.lit(0)), F.lit(BLOCK))
        return _let(F.transform(starts, lambda at: within(F.slice(v, at + 1, F.lit(BLOCK)))), joined)

    return _let(values, cut)


def _ends(text: Column, pattern: str, matches: Column) -> Column:
    """The end of every match: running lengths of the piece before it and itself."""
    gaps = F.split(text, pattern, -1)
    sizes = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda gap, m: F.length(gap) + F.length(m))
    return _running(sizes, lambda a, b: a + b)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    places = F.sequence(F.lit(1), F.length(digits))
    worth = lambda i: F.substring(turned, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
    return F.aggregate(places, F.lit(0), lambda acc, i: acc + worth(i) - F.when(worth(i) > 9, 9).otherwise(0)) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+", "")
        return F.forall(F.split(m, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.concat(F.lit("0"), F.substring(part(p), 1, 4)).cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(_digits(m)).between(14, 19), _luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(10, 15)
    return F.lit(True)


def _checks(kind: str):
    return lambda x: _valid(kind, x["m"])


def _span(code: int, kind: str):
    end = lambda x: x["e"].cast("int")
    return lambda x: F.struct(
        (end(x) - F.length(x["m"])).alias("s"), F.lit(code).alias("kind"), end(x).alias("e"), F.concat(F.lit(kind + ":"), F.lower(x["m"])).alias("entity")
    )


def entity_spans(documents: DataFrame) -> DataFrame:
    """``documents`` with ``text_`` (never null) and ``base_`` (valid spans by start, then kind, with the entity)."""
    rows = documents.withColumn("text_", F.coalesce("text", F.lit("")))
    for kind in KINDS[:4]:
        matches = F.regexp_extract_all("text_", F.lit(PATTERNS[kind]), F.lit(0))
        if kind in HINTS:
            matches = F.when(F.contains("text_", F.lit(HINTS[kind])), matches)
        rows = rows.withColumn(f"m_{kind}_", matches)
    parts = []
    for code, kind in enumerate(KINDS[:4]):
        m = F.col(f"m_{kind}_")
        pairs = F.arrays_zip(m.alias("m"), _ends(F.col("text_"), PATTERNS[kind], m).alias("e"))
        parts.append(F.when(F.size(m) > 0, F.transform(F.filter(pairs, _checks(kind)), _span(code, kind))).otherwise(F.array().cast(FOUND)))
    return rows.withColumn("base_", F.array_sort(F.concat(*parts))).drop(*(f"m_{k}_" for k in KINDS[:4]))


def document_counts(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One row n, and (term, n_t): documents in all and those that hold a term; repeated rows count once."""
    copies = stored(documents.groupBy("document_").agg(F.count("*").alias("copies")), "copies")
    repeated = copies.where("copies > 1")
    place = F.pmod(F.xxhash64("document_"), F.lit(PLACES)).alias("place_")
    # At most PLACES rows: map tasks send on only texts whose place holds a repeated document.
    places = F.broadcast(repeated.select(place).distinct())
    likely = documents.withColumn("place_", place).join(places, "place_", "left_semi").groupBy("document_").agg(F.first("text_").alias("text_"))
    twice = likely.join(repeated, "document_").select("text_", (1 - F.col("copies")).alias("times"))
    words = documents.select("text_", F.lit(1).cast("long").alias("times")).unionByName(twice)
    terms = words.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text_"), F.lit(TERM), F.lit(0)))).alias("term"), "times")
    # Counted inside map tasks, so the shuffle has a row for each term and task.
    return copies.agg(F.count("*").alias("n")), terms.groupBy("term").agg(F.sum("times").alias("n_t"))


def entity_classes(holders: DataFrame) -> DataFrame:
    """(document_, class, n_e): entities that stand in the same documents are one class."""
    pairs = stored(holders.select("document_", F.explode("base_.entity").alias("entity")).distinct(), "entities")
    one, two = F.xxhash64("document_"), F.xxhash64(F.lit("two"), "document_")
    classes = pairs.groupBy("entity").agg(F.count("*").alias("n_e"), F.bit_xor(one).alias("x"), F.bit_xor(two).alias("y"))
    return pairs.join(classes, "entity").select("document_", F.struct("n_e", "x", "y").alias("class"), "n_e").distinct()


def _most_frequent(n: Column, n_e: Column, share: float) -> Column:
    """n_t from which a term that stands only beside an entity discloses less than ``share``; a little more for rounding."""
    return n_e * F.pow(n / n_e, F.lit(1 - share)) * 1.000001


def term_places(holders: DataFrame, classes: DataFrame, total: DataFrame, counts: DataFrame) -> DataFrame:
    """(document_, term, s, e, n, n_t, least): terms that are rare enough to disclose an entity of their document.

    ``least`` is the fewest documents that an entity of the document stands in.
    """
    classes = classes.crossJoin(F.broadcast(total)).where("n_e < n")  # one row; an entity of all documents has no information
    need = classes.groupBy("document_").agg(F.max(_most_frequent(F.col("n"), F.col("n_e"), GENERALISE_AT)).alias("need"), F.min("n_e").alias("least"), F.first("n").alias("n"))
    rows = holders.join(need, "document_").withColumn("runs", F.regexp_extract_all("text_", F.lit(TERM), F.lit(0)))
    rows = rows.select("document_", "need", "least", "n", F.explode(F.arrays_zip(F.col("runs").alias("run"), _ends(F.col("text_"), TERM, F.col("runs")).alias("e"))).alias("w"))
    rows = rows.select("document_", "need", "least", "n", F.lower("w.run").alias("term"), (F.col("w.e") - F.length("w.run")).alias("s"), "w.e")
    pairs = counts.agg(F.sum("n_t").alias("pairs"))
    frequent = counts.crossJoin(F.broadcast(pairs)).where(F.col("n_t") >= F.col("pairs") * FREQUENT).select("term", F.col("n_t").alias("often"))
    rows = rows.join(F.broadcast(frequent), "term", "left").where("often is null or often <= need").drop("often")
    return rows.join(counts, "term").where("n_t <= need").drop("need")


def disclosing(places: DataFrame, classes: DataFrame) -> DataFrame:
    """(document_, term, kind): the terms of each document to remove or to generalise."""
    removed, general = (F.lit(KINDS.index(k)) for k in ("removed", "general"))
    mutual = lambda together: F.log2(F.col("n") * together / (F.col("n_t") * F.col("n_e"))) / F.log2(F.col("n") / F.col("n_e"))
    terms = stored(places.select("document_", "term", "n", "n_t", "least").distinct(), "terms").withColumn("n_e", F.col("least"))
    # One shared document is enough already for the rarest entity of the document.
    sure = terms.where(mutual(F.lit(1)) >= REMOVE_AT).select("document_", "term", removed.alias("kind"))
    rest = terms.where(mutual(F.lit(1)) < REMOVE_AT).drop("n_e", "least")
    pairs = rest.join(classes, "document_").where(F.col("n_e") < F.col("n")).where(F.col("n_t") <= _most_frequent(F.col("n"), F.col("n_e"), GENERALISE_AT))
    pairs = stored(pairs, "pairs")
    share = pairs.groupBy("class", "term").agg(F.count("*").alias("n_te"), F.first("n").alias("n"), F.first("n_t").alias("n_t"), F.first("n_e").alias("n_e"))
    share = share.withColumn("share", mutual(F.col("n_te"))).where(F.col("share") >= GENERALISE_AT)
    share = share.select("class", "term", F.when(F.col("share") >= REMOVE_AT, removed).otherwise(general).alias("kind"))
    found = pairs.select("document_", "class", "term").join(share, ["class", "term"]).groupBy("document_", "term").agg(F.max("kind").alias("kind"))
    return sure.unionByName(found)


def term_spans(places: DataFrame, kinds: DataFrame, holders: DataFrame) -> DataFrame:
    """(document_, extra_): spans of disclosing terms that overlap no entity, in order."""
    hits = places.select("document_", "term", "s", "e").join(kinds, ["document_", "term"]).select("document_", "s", "kind", "e")
    known = holders.select("document_", F.explode("base_").alias("x")).select("document_", "x.s", "x.kind", "x.e").join(hits.select("document_").distinct(), "document_", "left_semi")
    entity = F.col("kind") < 4
    forth = Window.partitionBy("document_").orderBy("s").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    back = Window.partitionBy("document_").orderBy(F.desc("s")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = hits.unionByName(known).withColumn("before", F.max(F.when(entity, F.col("e"))).over(forth)).withColumn("after", F.min(F.when(entity, F.col("s"))).over(back))
    free = rows.where(~entity & (F.coalesce("before", F.lit(0)) <= F.col("s")) & (F.coalesce("after", F.col("e")) >= F.col("e")))
    return free.groupBy("document_").agg(F.array_sort(F.collect_list(F.struct("s", "kind", "e"))).alias("extra_"))


def disclosed_spans(documents: DataFrame, texts: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows with their base spans, and (document_, extra_): the spans of terms to generalise or remove.

    ``text_`` is stored for texts with an entity only; ``texts`` keeps the column ``text`` of all rows.
    """
    key = F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text"))))
    documents = documents.withColumn("document_", key)
    rows = entity_spans(documents).withColumn("text_", F.when(F.size("base_") > 0, F.col("text_")))
    rows = stored(rows if texts else rows.drop("text"), "found")
    holders = rows.where(F.size("base_") > 0).groupBy("document_").agg(F.first("text_").alias("text_"), F.first("base_").alias("base_"))
    holders = stored(holders, "holders")
    total, counts = document_counts(documents.select("document_", F.coalesce("text", F.lit("")).alias("text_")))
    counts, classes = stored(counts, "counts"), stored(entity_classes(holders), "classes")
    places = stored(term_places(holders, classes, total, counts), "places")
    return rows, term_spans(places, disclosing(places, classes), holders)


def _plain(spans: Column) -> Column:
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))


def _written(spans: Column) -> Column:
    name = lambda x: F.element_at(F.array(*map(F.lit, KINDS)), x["kind"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x), x["s"].cast("string"), x["e"].cast("string"))), ",")


def personal_data(documents: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_terms) of every row."""
    rows, extra = disclosed_spans(documents.select("doc_id", "text"))
    rows = rows.select("doc_id", "document_", "base_").join(extra, "document_", "left")
    more = F.coalesce("extra_", F.array().cast(SPAN))
    number = lambda code: F.size(F.expr(f"filter(base_, x -> x.kind = {code})")).cast("long")
    return rows.select(
        "doc_id",
        *(number(code).alias(f"n_{kind}") for code, kind in enumerate(KINDS[:4])),
        F.sha2(_written(F.col("base_")), 256).alias("base_sha256"),
        _written(F.array_sort(F.concat(_plain(F.col("base_")), more))).alias("spans"),
        F.size(more).cast("long").alias("n_terms"),
    )


def sanitise(documents: DataFrame) -> DataFrame:
    """``documents`` with entities and disclosing terms replaced by their kind (removed terms by nothing)."""
    kept = [c for c in documents.columns if c != "text"]
    packed = documents.select("doc_id", "text", F.struct(*kept).alias("row_"))
    rows, extra = disclosed_spans(packed, texts=True)
    fields = [F.col("row_").getField(c).alias(c) if c != "text" else F.col("text") for c in documents.columns]
    clean = rows.where(F.size("base_") == 0).select(*fields)
    rows = rows.where(F.size("base_") > 0).join(extra, "document_", "left")
    rows = rows.withColumn("all_", F.array_sort(F.concat(_plain(F.col("base_")), F.coalesce("extra_", F.array().cast(SPAN)))))
    return clean.unionByName(rows.withColumn("text", _replaced(F.col("text_"), F.col("all_"))).select(*fields))


def _replaced(text: Column, spans: Column) -> Column:
    """A text with its spans, in order, replaced by their kinds; a span that begins inside an earlier one adds nothing."""
    names = F.array(*(F.lit("" if k == "removed" else f"<{k}>") for k in KINDS))

    def written(bound: Column) -> Column:
        chunks, ends = bound["chunks"], bound["ends"]

        def piece(a: Column, b: Column) -> Column:
            """Code points a to b, read from the chunks that hold them."""
            first, last = (a / CHUNK).cast("int"), ((b - 1) / CHUNK).cast("int")
            part = lambda i: F.substring(F.get(chunks, i), F.greatest(a - i * CHUNK, F.lit(0)) + 1, F.least(b - i * CHUNK, F.lit(CHUNK)) - F.greatest(a - i * CHUNK, F.lit(0)))
            return F.when(a < b, F.array_join(F.transform(F.sequence(first, last), part), "")).otherwise("")

        def step(x: Column, i: Column) -> Column:
            at = F.coalesce(F.get(ends, i - 1), F.lit(0))
            return F.when(x["s"] < at, "").otherwise(F.concat(piece(at, x["s"]), F.element_at(names, x["kind"] + 1)))

        rest = piece(F.element_at(ends, -1), bound["size"])
        return F.concat(F.array_join(F.transform(bound["spans"], step), ""), rest)

    parts = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))
    ends = _running(F.transform(spans, lambda x: x["e"]), lambda a, b: F.greatest(a, b))
    return _let(F.struct(parts.alias("chunks"), ends.alias("ends"), F.length(text).alias("size"), spans.alias("spans")), written)
