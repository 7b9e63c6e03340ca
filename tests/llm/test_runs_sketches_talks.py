"""Periodic runs, threshold-scaled sketches and conversation repair against brute force and on edge cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import conversations, minhash, periodic, sketch, toxicity
from ledgerloom.llm.shared import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module", autouse=True)
def session(spark):
    return prepare(spark)


# Periodic runs


def all_runs(seq, least=24, periods=3):
    out = []
    for q in range(1, len(seq) // periods + 1):
        i = 0
        while i + q < len(seq):
            start = i
            while i + q < len(seq) and seq[i] == seq[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, periods * q):
                part = seq[start : start + length]
                if not any(all(part[k] == part[k + d] for k in range(length - d)) for d in range(1, q)):
                    out.append((start, length, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_are_all_maximal_repetitions():
    draw = random.Random(1)
    for _ in range(400):
        seq = [draw.randrange(draw.choice([1, 2, 3, 20])) for _ in range(draw.randrange(140))]
        for _ in range(draw.randrange(4)):
            if len(seq) > 10:
                a, p = draw.randrange(len(seq)), draw.randrange(1, 15)
                for i in range(a + p, min(len(seq), a + draw.randrange(5, 80))):
                    seq[i] = seq[i - p]
        for least, periods in ((24, 3), (6, 2)):
            assert periodic.runs_of(np.array(seq, np.int64), least, periods) == all_runs(seq, least, periods)


def test_positions_stay_in_order_over_many_blocks():
    draw = random.Random(2)
    values = draw.sample(range(10**6), 6000)
    kept, seen = periodic.Positions(values[0]), [values[0]]
    for v in values[1:]:
        low, high = max((x for x in seen[-50:] if x < v), default=-1), min((x for x in seen[-50:] if x > v), default=-1)
        before, after = kept.insert(v)
        assert before >= low and (high < 0 or 0 <= after <= high)
        seen.append(v)
    assert list(kept) == sorted(values) and len(kept.blocks) > 4


def expected_runs(doc_id, text):
    ws = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(ws)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        ws = [ws[a + (i - a) % p] if i >= a else ws[i] for i in range(n)]
    runs = all_runs(ws)
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(w for k, w in enumerate(ws) if k not in gone)),
    )


def test_runs_of_documents(spark):
    draw = random.Random(3)
    rows = [(k, "  ".join(draw.choice("ab cd ef gh ij".split()) + str(draw.randrange(9)) for _ in range(draw.randrange(120))) + "\n") for k in range(200)]
    rows += [(200, "la " * 500), (201, "one two three\t" * 9 + "end"), (202, None), (203, ""), (None, "x y " * 20), (204, " \t\n"), (200, "la " * 500), (None, None)]
    rows += [(205, " ".join(f"w{k % 7000}" for k in range(30_000))), (206, "é ü ö " * 30)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, runs int, n_words string")
    got = periodic.digest(periodic.find_runs(periodic.with_periods(frame))).drop("n_words")
    assert sum(zlib.crc32(str(k).encode()) % 10 == 0 for k in range(200)) > 10
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected_runs(*r) for r in rows), key=str)
    flat = periodic.collapse(frame)
    assert flat.schema == frame.schema and flat.where("doc_id = 201").first().text == "one two three end" and flat.where("doc_id = 202").first().text is None
    none = frame.limit(0)
    assert periodic.digest(periodic.find_runs(periodic.with_periods(none))).count() == 0 and periodic.collapse(none).count() == 0


# Sketches


def plain_sketch(text, below=sketch.BELOW):
    ws = WORD.findall(text)
    grams = [" ".join(ws[k : k + 5]) for k in range(len(ws) - 4)] if len(ws) >= 5 else [" ".join(ws)] if ws else []
    hashed = sorted({hashlib.md5(x.encode()).hexdigest() for x in grams})
    return [x[: sketch.DIGITS] for x in ([x for x in hashed if x < below] or hashed[:1])]


def contained(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def test_fingerprints_follow_the_ring_of_ids(spark):
    draw = random.Random(4)
    text = lambda n: draw.choice(["", " ", "\t"]) + " ".join("wörd" + str(draw.randrange(400)) for _ in range(n))
    rows = [(7 * k % 211 - 50, text(draw.choice([0, 1, 4, 5, 40, 200]))) for k in range(211)] + [(900, None), (901, ""), (902, "\u000b\u000c f of off\u000c\u000b")]
    rows += [(2**62, " ".join(f"w{k}" for k in range(30_000)))]
    frame = spark.createDataFrame([(*r, "k", 1) for r in rows], "doc_id long, text string, k string, sketch int")
    ring = sorted((k, t or "") for k, t in rows)
    want = []
    for (k, t), (_, after) in zip(ring, ring[1:] + ring[:1]):
        cut = len(t) // 4
        changed = t[: len(t) - cut] + after[:cut]
        own, new = plain_sketch(t), plain_sketch(changed)
        want.append((k, len(t), sha(changed), ",".join(own), ",".join(new), contained(own, new), contained(own, plain_sketch(after))))
    assert sorted(map(tuple, sketch.fingerprints(frame).collect())) == want
    assert sketch.fingerprints(frame.limit(0)).count() == 0
    (one,) = sketch.fingerprints(frame.where("doc_id = 902")).collect()
    assert one.near_next == 1.0 and one.fingerprint


def test_next_rows_of_repeated_and_null_ids(spark):
    """A third of the rows share one id and a third have none: nothing is lost and every row's next is one of its id or the first of the next."""
    rows = [(5, f"five {k % 4}") for k in range(300)] + [(None, f"none {k % 3}") for k in range(300)] + [(k, f"single {k}") for k in range(300) if k != 5]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sketch.with_next(frame, ["text"]).select("doc_id", "text", F.col("next.text").alias("after")).collect()
    assert sorted(map(str, ((r.doc_id, r.text) for r in got))) == sorted(map(str, rows))
    after = {r.text: r.after for r in got}
    assert all(after[f"single {k}"] == f"single {k + 1}" for k in range(299) if k not in (4, 5)) and after["single 4"].startswith("five") and after["single 299"].startswith("none")
    assert sum(r.after.startswith("five") for r in got) == 300 and sum(r.after == "single 6" for r in got) == 1
    assert sum(r.after.startswith("none") for r in got) == 300 and sum(r.after == "single 0" for r in got) == 1


def test_sketches_merge_and_estimate_containment(spark):
    base = [f"t{k}" for k in range(6000)]
    frame = spark.createDataFrame([(1, " ".join(base[:3000])), (1, " ".join(base[2996:])), (2, " ".join(base)), (3, " ".join(base[1000:2000])), (4, ""), (5, "a b")], "g int, text string")
    made = sketch.sketch(frame)
    union = {r.g: r.sketch for r in sketch.merged(made, ["g"]).collect()}
    assert union[1] == union[2] and union[4] == [] and len(union[5]) == 1
    pairs = made.where("g = 3").select(F.col("sketch").alias("a")).crossJoin(made.where("g = 2").select(F.col("sketch").alias("b")))
    row = pairs.select(sketch.containment("a", "b").alias("in"), sketch.containment("b", "a").alias("of"), sketch.resemblance("a", "b").alias("like")).first()
    assert row["in"] == 1.0 and abs(row["of"] - 1 / 6) < 0.03 and abs(row["like"] - 1 / 6) < 0.03


# Conversations

LEGAL = re.compile("(s?(ua)+)?")


def damaged_rows(rows):
    out = []
    for conv, turn, role, text in rows:
        show = [" " if v is None else v for v in (conv, turn, role, text)]
        d = zlib.crc32(f"{show[0]}:{show[1]}".encode()) % 20
        role, text = "user" if d == 4 else show[2], {1: "", 2: re.sub("[.!?]", "", show[3])}.get(d, show[3])
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(d, 1)
    return out


def expected_repair(rows):
    """Counts by their definitions, and the cheapest edits among all combinations with at most one insertion a gap."""
    rows = sorted(rows, key=lambda r: ((r[1] is not None, r[1] or 0), r[2], r[3]))
    seen, faults = set(), []
    for _, _, role, text in rows:
        visible = re.sub(r"[\x20\x09-\x0D]", "", text)
        faults.append(1 if not visible else 2 if (role, text) in seen else 3 if visible[-1] not in ".!?" else 0)
        seen.add((role, text))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    choices = []
    for (_, _, role, text), fault in zip(rows, faults):
        extra = 3 * (fault == 3)
        keep = [("K", role[:1] or "?", extra, f"{role}:{text}")] + [("R", r[0], 3 + extra, f"{r}:{text}") for r in ("user", "assistant")]
        choices.append([("D", "", 4, None)] + (keep if fault not in (1, 2) else []))
    insert = [("", "", 0, None), ("I", "u", 3, "user:"), ("I", "a", 3, "assistant:")]
    best = None
    for pick in itertools.product(*choices):
        for gap in itertools.product(insert, repeat=len(rows) + 1):
            edits = [gap[0], *itertools.chain.from_iterable(zip(pick, gap[1:]))]
            if LEGAL.fullmatch("".join(e[1] for e in edits)):
                found = (sum(e[2] for e in edits), "".join(e[0] for e in edits)), "\n".join(e[3] for e in edits if e[3] is not None)
                best = found if best is None or found[0] < best[0] else best
    (cost, audit), text = best
    return gaps, faults.count(1), faults.count(2), faults.count(3), illegal, cost, audit, sha(text)


@pytest.fixture(scope="module")
def talks():
    draw = random.Random(6)
    texts = ["Yes.", "No!", "Why?\n", "half", "", " \t", "…", "Well. ", None, "Ünd."]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "Universe", "auto"]
    rows = []
    for conv in range(200):
        for k in range(draw.randrange(1, 4)):
            rows.append((conv, draw.choice([k, k, k, k + 3, None, 0]), draw.choice(roles[: draw.choice([3, 10])]), draw.choice(texts) if draw.random() < 0.5 else f"text {draw.randrange(9)}."))
    return rows + [(None, 1, "user", "hi."), (None, None, None, None)]


def test_repair_is_the_cheapest(spark, talks):
    frame = spark.createDataFrame([(*r, 1, "x") for r in talks], "conv_id long, turn long, role string, text string, copy int, fault string")
    got = {r[0]: tuple(r[1:]) for r in conversations.repair(conversations.damaged(frame)).collect()}
    left = damaged_rows(talks)
    assert got.keys() == {r[0] for r in talks} and len(left) < len(talks) + 40
    for conv in got:
        assert got[conv] == expected_repair([r for r in left if r[0] == conv]), conv
    assert any(conv not in {r[0] for r in left} for conv in got)
    empty = frame.limit(0)
    assert conversations.repair(conversations.damaged(empty)).count() == 0 and conversations.repaired_turns(empty).count() == 0


def test_repaired_turns_give_the_digest(spark, talks):
    frame = conversations.damaged(spark.createDataFrame(talks, "conv_id long, turn long, role string, text string"))
    report = {r.conv_id: (r.audit, r.repaired_sha256) for r in conversations.repair(frame).collect()}
    edits = {}
    for r in sorted(conversations.repaired_turns(frame).collect(), key=lambda r: (str(r.conv_id), r.step)):
        edits.setdefault(r.conv_id, []).append(r)
    for conv, (audit, digest) in report.items():
        rows = edits.get(conv, [])
        assert "".join(r.edit for r in rows) == audit
        assert sha("\n".join(f"{r.role}:{r.text}" for r in rows if r.edit != "D")) == digest
        assert all(r.turn is None and r.text == "" for r in rows if r.edit == "I")


def test_long_conversations_keep_few_stacks(spark):
    work = conversations.Repair(True)
    before = conversations.step.cache_info().currsize
    for k in range(60_000):
        work.turn("user" if k % 11 else "system", "text.", 0 if k % 7 else 2)
        assert len(work.live) <= 5
    assert conversations.step.cache_info().currsize < before + 500
    rows = spark.range(20_000).selectExpr("7L as conv_id", "id as turn", "if(id % 2 = 0, 'user', 'assistant') as role", "concat('turn ', id, '.') as text")
    (row,) = conversations.repair(rows).collect()
    assert row.audit == "K" * 20_000 and row.cost == 0 and row.illegal == 0
    assert row.repaired_sha256 == sha("\n".join(f"{'user' if k % 2 == 0 else 'assistant'}:turn {k}." for k in range(20_000)))


def test_tables_accept_the_grammar_only():
    for size in range(6):
        for roles in itertools.product("sua", repeat=size):
            stack = (0,)
            for x in roles:
                stack = stack and conversations.TABLES.read(stack, x)
            assert bool(stack and conversations.TABLES.read(stack, conversations.END)) == bool(LEGAL.fullmatch("".join(roles)))


@pytest.mark.parametrize("size", [1, 2, 5])
def test_next_rows_of_few_rows(spark, size):
    frame = spark.createDataFrame([(k, f"single {k}") for k in range(size)], "doc_id long, text string")
    got = sketch.with_next(frame, ["text"], ranges=16).select("text", F.col("next.text").alias("after")).collect()
    assert {r.text: r.after for r in got} == {f"single {k}": f"single {(k + 1) % size}" for k in range(size)}


# Rows that share an id, and the learned cut


def test_texts_of_one_id_stay_together(spark):
    copy, other = " ".join(f"c{k}" for k in range(40)), " ".join(f"o{k}" for k in range(40))
    frame = spark.createDataFrame([(1, copy), (2, copy), (3, other), (3, "quite different words stand here"), (3, other), (None, copy), (None, copy)], "doc_id long, text string")
    stay = sorted(((r.doc_id, r.text) for r in minhash.deduplicate(frame).collect()), key=str)
    assert stay == sorted([(1, copy), (3, other), (3, "quite different words stand here"), (None, copy), (None, copy)], key=str)


def test_toxic_cut_is_learned_from_rows_not_fitted(spark):
    draw = random.Random(8)
    common = [f"word{k}" for k in range(60)]
    rows = [(k, [draw.choice(common) for _ in range(30)] + ([f"vil{draw.choice('abcdefghij')}ain{draw.randrange(40)}"] if k % 8 == 0 else [])) for k in range(1600)]
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in rows] + [(0, "zzz"), (0, "zzz")], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 8 == 0)) for k in range(800)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    left = {r.doc_id for r in toxicity.reject(docs.where("doc_id >= 800"), model).collect()}
    toxic = {k for k in range(800, 1600) if k % 8 == 0}
    assert len(toxic - left) >= 0.9 * len(toxic) and len({k for k in range(800, 1600)} - toxic - left) <= 0.01 * 700
    assert 0 < model.cut < 0.9
    chance, side = np.array([0.9, 0.2, 0.3, 0.05, 0.04]), np.array([True, True, False, False, False])
    assert toxicity.learned_cut(chance, side) == pytest.approx(0.6)
