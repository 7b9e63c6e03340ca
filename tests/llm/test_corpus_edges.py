"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns for every operator and stage."""

from __future__ import annotations

import pytest

import corpus_pipeline
from ledgerloom.llm import attention, automaton, decontamination, disclosure, flatgraph, language, minhash, mixing, passages, toxicity
from ledgerloom.llm.shared import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_ string, id long, size string, n int, row_ string"
LONG = " ".join(f"word{k % 997}" for k in range(30_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 3),
    (1, "alpha beta gamma delta epsilon zeta", "en", "a", 3),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, " \t\n", "fr", None, 3),
    (5, LONG, "en", "b", 1),
    (6, LONG, "fr", None, 1),
    (None, "alpha beta gamma delta epsilon zeta", "fr", "a", 9),
    (None, None, None, None, None),
    (7, "x", "en", "c", 1),
    (8, "mail a.b@c.de and 1.2.3.4 or +1 (234) 555-0100 and password: hunter22", "en", "c", 9),
]


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return spark.createDataFrame([(*r, "t", 5, "s", 1, "r") for r in ROWS], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 0, 1), (7, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, None), (2, ""), (3, "alpha beta"), (None, "alpha beta gamma delta"), (4, "gamma delta epsilon zeta"), (4, "gamma delta epsilon zeta")], "item_id long, text string")


def by_id(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_passages(docs, empty):
    got = passages.repeated_passages(docs).collect()
    assert {(r.doc_id, r.other_id) for r in got} == {(6, 5)}
    assert any(r.first_word == 0 and r.end_word == 30_000 for r in got)
    assert passages.repeated_passages(empty).count() == 0


def test_disclosure(docs, empty):
    got = {(r.doc_id, r.spans) for r in disclosure.personal_data(docs).collect()}
    # Document 8 alone holds its entities and all of its words: every one of them discloses the whole.
    spans = "removed:0:4,email:5:13,removed:14:17,ip:18:25,removed:26:28,phone:29:46,removed:47:50,removed:51:59,removed:61:67"
    assert (8, spans) in got and (2, "") in got and (None, "") in got
    assert disclosure.personal_data(docs).count() == len(ROWS)
    clean = disclosure.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(ROWS)
    assert clean.where("doc_id = 8").first().text == " <email>  <ip>  <phone>  : 22"
    assert disclosure.personal_data(empty).count() == 0 and disclosure.sanitise(empty).count() == 0


def test_attention(docs, empty):
    got = attention.score(docs).collect()
    assert len(got) == len(ROWS)
    assert all(r.n_tokens == 1 for r in got if r.doc_id in (2, 3, 4))
    assert all(r.score < 0 and not r.held_out for r in got if r.doc_id is None)
    assert attention.score(empty).count() == 0


def test_automaton(docs, empty):
    got = {(r.doc_id, r.spans) for r in automaton.scan(docs).collect()}
    assert (8, "assign:51:69") in got and (2, "") in got and (3, "") in got
    assert automaton.scan(empty).count() == 0


def test_flatgraph(spark):
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.05], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1),
        (7, [float("nan"), 1.0], 1), (8, [1.0, None], 1), (9, [], 1), (10, [1.0, 0.0], None), (None, [1.0, 0.0], 1), (11, [1e-30, 0.0], 1), (12, [1.0, 0.0, 0.0], 1),
    ]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, label int, id int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in flatgraph.near_vectors(table).collect()}
    assert got[1] == (4, 1, True) and got[2] == (4, 1, False) and got[3] == (4, 1, False) and got[11] == (4, 1, False)
    assert all(got[k] == (0, k, True) for k in (4, 5, 6, 7, 8, 9, 10, 12)) and got[None] == (0, None, True)
    assert flatgraph.near_vectors(table.limit(0)).count() == 0


def test_decontamination(docs, empty, items):
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, items).collect()}
    assert got == {(1, 4), (None, 4)}
    assert decontamination.decontaminate(docs, items).count() == len(ROWS) - 3
    assert decontamination.contaminated(empty, items).count() == 0
    assert decontamination.contaminated(docs, items.limit(0)).count() == 0


def test_mixing(docs, empty):
    got = mixing.mix(docs).collect()
    assert len(got) == len(ROWS) and all(r.taken <= 2 * r.size for r in got)
    assert all(r.size == 0 and r.taken == 0 for r in got if r.doc_id in (2, 3, 4))
    assert mixing.mix(empty).count() == 0


def test_language(docs, empty):
    got = language.predict(docs, language.fit(docs)).collect()
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (2, 3, 4)) and len(got) == len(ROWS)
    assert all(r.lang_pred in ("en", "fr") and 0 <= r.score <= 1 for r in got if r.doc_id in (1, 5, 6, 7, 8))
    nothing = language.predict(docs, language.fit(empty)).collect()
    assert all(r.lang_pred == "und" for r in nothing)
    assert language.predict(empty, None).count() == 0


def test_minhash(docs, empty):
    got = by_id(minhash.near_duplicates(docs))
    assert (6, 997, 5, False) in got and (5, 997, 5, True) in got and (7, 1, 7, True) in got and (2, 0, 2, True) in got
    assert sum(r[0] is None for r in got) == 2 and all(r[2] is None and r[3] for r in got if r[0] is None)
    stay = minhash.deduplicate(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.where("doc_id is not null").collect()) == [1, 2, 3, 4, 5, 7, 8]
    assert stay.where("doc_id is null").count() == 2
    assert minhash.near_duplicates(empty).count() == 0 and minhash.deduplicate(empty).count() == 0


def test_toxicity(docs, empty, labels):
    model = toxicity.fit(docs, labels)
    assert toxicity.score(docs, model).count() == len(ROWS)
    assert toxicity.fit(docs, labels.limit(0)) is None and toxicity.fit(empty, labels) is None
    assert toxicity.score(docs, None).where("toxic or severity > 0").count() == 0
    kept = toxicity.reject(docs, None)
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert toxicity.score(empty, model).count() == 0


def test_stages(spark, docs, labels, items, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path))
    left = {r.doc_id for r in got.collect()}
    assert {2, 3, 4, 5, 7, 8} <= left and 6 not in left
    docs.limit(0).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    labels.limit(0).write.parquet(str(tmp_path / "none" / "labels.parquet"))
    items.limit(0).write.parquet(str(tmp_path / "none" / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).count() == 0
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name
