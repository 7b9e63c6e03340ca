"""The registered query of each operator, with production parameters, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import attention, automaton, conversations, decontamination, disclosure, flatgraph, language, minhash, mixing, passages, periodic, sketch, toxicity
from ledgerloom.llm.shared import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


WORDS_SQL = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

MIXING_SQL = f"""
WITH sizes AS (
  SELECT doc_id, source, {WORDS_SQL} AS size, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k FROM documents),
s1 AS (SELECT k, sum(size)::BIGINT AS source_size FROM sizes GROUP BY k),
s2 AS (SELECT *, row_number() OVER (ORDER BY k) AS place FROM s1),
s3 AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, source_size * 2 AS cap,
  (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM s2),
s4 AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
  / (sum(weight) OVER (ORDER BY cap::DOUBLE / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM s3),
s5 AS (SELECT *, max(level) OVER () AS final FROM s4),
s6 AS (SELECT k, place, source_size, least(cap::DOUBLE, final * weight) AS target FROM s5),
s7 AS (SELECT s6.*, greatest(ceil(source_size::DOUBLE / {mixing.SHARD_WORDS}), 1)::BIGINT AS shards FROM s6),
q1 AS (SELECT k, place, n, target / (2 * n - 1) AS quotient FROM (SELECT *, unnest(range(1, source_size * {mixing.MOST} + 1)) AS n FROM s7) t),
w1 AS (SELECT k, count(*) AS won FROM (SELECT *, row_number() OVER (ORDER BY quotient DESC, place, n) AS r FROM q1) t
  WHERE r <= (SELECT floor(max(total) + 0.5::DOUBLE) FROM s3) GROUP BY k),
s8 AS (SELECT s7.*, coalesce(won, 0) AS source_won FROM s7 LEFT JOIN w1 USING (k)),
r1 AS (SELECT doc_id, source, size, k, source_size, target, source_won, shards,
  md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || size::VARCHAR) AS key FROM sizes JOIN s8 USING (k)),
r2 AS (SELECT *, (('0x' || substr(key, 1, 8))::BIGINT) % shards AS shard FROM r1),
t1 AS (SELECT k, shard, sum(size)::BIGINT AS shard_size, any_value(source_won) AS source_won FROM r2 GROUP BY k, shard),
q2 AS (SELECT k, shard, source_won, n, shard_size::DOUBLE / (2 * n - 1) AS quotient
  FROM (SELECT *, unnest(range(1, shard_size * {mixing.MOST} + 1)) AS n FROM t1) t),
w2 AS (SELECT k, shard, count(*) AS won FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY quotient DESC, shard, n) AS r FROM q2) t
  WHERE r <= source_won GROUP BY k, shard),
t4 AS (SELECT t1.k, t1.shard, shard_size, coalesce(won, 0)::BIGINT AS quota FROM t1 LEFT JOIN w2 ON t1.k = w2.k AND t1.shard = w2.shard),
r3 AS (SELECT r2.*, shard_size, quota,
  (sum(size) OVER (PARTITION BY r2.k, r2.shard ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS before
  FROM r2 JOIN t4 ON r2.k = t4.k AND r2.shard = t4.shard),
r4 AS (SELECT *, CASE WHEN shard_size > 0 THEN quota // shard_size ELSE 0 END AS rounds FROM r3)
SELECT doc_id, source, size::BIGINT AS size, source_size, target,
  (rounds * size + least(greatest(quota - rounds * shard_size - before, 0), size))::BIGINT AS taken FROM r4
"""

NEAR_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN ws IS NULL OR len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n_shingles FROM s),
classes AS (SELECT min(doc_id) AS id, list_sort(sh) AS sh FROM s WHERE len(sh) > 0 GROUP BY list_sort(sh)),
x AS (SELECT id, len(sh) AS n, unnest(sh) AS g FROM classes),
p AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared FROM x a JOIN x b ON a.g = b.g AND a.id < b.id
  GROUP BY a.id, b.id),
links AS (SELECT a, b FROM p WHERE 100 * shared >= 75 * (na + nb - shared)),
e AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
comp AS (SELECT a AS id, least(a, min(b)) AS c FROM reach GROUP BY a),
member AS (SELECT s.doc_id, classes.id FROM s JOIN classes ON list_sort(s.sh) = classes.sh)
SELECT n.doc_id, n_shingles::BIGINT AS n_shingles, coalesce(c, member.id, n.doc_id) AS component_id, n.doc_id = coalesce(c, member.id, n.doc_id) AS kept
FROM n LEFT JOIN member USING (doc_id) LEFT JOIN comp ON member.id = comp.id
"""


VECTOR_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda c: c::DOUBLE) AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE vec_id IS NOT NULL AND label IS NOT NULL AND e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(e, lambda c: c <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a, least(a, min(b)) AS c FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM v LEFT JOIN n ON v.vec_id = n.a LEFT JOIN comp ON v.vec_id = comp.a
"""




def _sketch_sql(text: str, name: str, rows: str) -> str:
    width, last = sketch.SHINGLE_WORDS, sketch.SHINGLE_WORDS - 1
    return rf"""{name}_w AS (SELECT *, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS w FROM {rows}),
{name}_h AS (SELECT * EXCLUDE (w), CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < {width} THEN [md5(array_to_string(w, ' '))]
  ELSE list_transform(range(1, len(w) - {last} + 1), lambda i: md5(array_to_string(w[i:i + {last}], ' '))) END AS h FROM {name}_w),
{name} AS (SELECT * EXCLUDE (h), list_sort(list_distinct(list_transform(CASE WHEN len(list_filter(h, lambda x: x < '{sketch.BELOW}')) > 0
  THEN list_filter(h, lambda x: x < '{sketch.BELOW}') WHEN len(h) > 0 THEN [list_min(h)] ELSE h END, lambda x: x[1:{sketch.DIGITS}]))) AS {name}_sketch FROM {name}_h)"""


def _contained_sql(one: str, other: str) -> str:
    return f"CASE WHEN len({one}) = 0 THEN CASE WHEN len({other}) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END ELSE len(list_intersect({one}, {other}))::DOUBLE / len({one}) END"


SKETCH_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
{_sketch_sql("text", "own", "d")},
n AS (SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS next_text, coalesce(lead(own_sketch) OVER w, first_value(own_sketch) OVER w) AS next_sketch
  FROM own WINDOW w AS (ORDER BY doc_id NULLS FIRST)),
e AS (SELECT *, left(text, length(text) - length(text) // 4) || left(next_text, length(text) // 4) AS changed FROM n),
{_sketch_sql("changed", "new", "e")}
SELECT doc_id, length(text)::BIGINT AS n_chars, sha256(changed) AS edited_sha256, array_to_string(own_sketch, ',') AS fingerprint,
  array_to_string(new_sketch, ',') AS edited_fingerprint, {_contained_sql("own_sketch", "new_sketch")} AS near_edited, {_contained_sql("own_sketch", "next_sketch")} AS near_next FROM new
"""


@query("op1_passages")
def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages.repeated_passages(table(spark, folder, "documents"))


@query("op2_disclosure")
def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return disclosure.personal_data(table(spark, folder, "documents"))


@query("op3_attention")
def language_model(spark: SparkSession, folder: str) -> DataFrame:
    return attention.score(table(spark, folder, "documents"))


@query("op4_automaton")
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return automaton.scan(table(spark, folder, "documents"))


@query("op8_language")
def language_of(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return language.predict(documents, language.fit(documents))


@query("op5_flatgraph", VECTOR_SQL)
def near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return flatgraph.near_vectors(table(spark, folder, "embeddings"))


@query("op6_decontamination")
def benchmark_passages(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query("op7_apportionment", MIXING_SQL)
def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"))


@query("op9_minhash", NEAR_SQL)
def near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, folder, "documents"))


@query("op10_severity")
def severity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels")))


@query("op11_sketch", SKETCH_SQL)
def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return sketch.fingerprints(table(spark, folder, "documents"))


@query("op12_periodic")
def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic.digest(periodic.find_runs(periodic.with_periods(table(spark, folder, "documents"))))


@query("op13_conversations")
def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, folder, "conversations")))
