"""Operators against brute force on small inputs."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import regex

import corpus_pipeline
from ledgerloom.llm import attention, automaton, decontamination, disclosure, flatgraph, language, minhash, mixing, passages, toxicity
from ledgerloom.llm.shared import components, prepare

RANDOM = random.Random(5)
VOCABULARY = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru") for b in ("ten", "sor", "pil", "qua") for c in ("", "s", "er", "ing", "el")]


def text_of(n: int, draw: random.Random = RANDOM) -> list[str]:
    return [draw.choice(VOCABULARY) for _ in range(n)]


def edited(words: list[str], edits: int, draw: random.Random = RANDOM) -> list[str]:
    out = list(words)
    for _ in range(edits):
        out[draw.randrange(len(out))] = "edit" + str(draw.randrange(10**6))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    prepare(spark)
    return lambda texts: spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")


def shingle_set(text: str) -> frozenset:
    words = text.lower().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def reachable(n: int, links) -> list[int]:
    root = list(range(n))
    for _ in range(n):
        new = list(root)
        for a, b in links:
            new[a] = new[b] = min(new[a], new[b])
        if new == root:
            return root
        root = new
    return root


def test_minhash_links_every_near_pair(frame):
    draw = random.Random(2)
    texts = []
    for _ in range(12):  # groups whose members lie on both sides of the threshold
        base = text_of(60, draw)
        texts += [" ".join(edited(base, draw.randrange(4), draw)) for _ in range(12)]
    hot = text_of(90, draw)
    texts += [" ".join(edited(hot, draw.randrange(5), draw)) for _ in range(60)] + [" ".join(hot)] * 40
    passage = text_of(40, draw)
    texts += [" ".join(passage + text_of(30, draw)) for _ in range(40)]
    sets = [shingle_set(t) for t in texts]
    links = [(a, b) for a in range(len(sets)) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = reachable(len(sets), links)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(frame(texts)).collect()}
    assert got == {k + 1: (len(sets[k]), root[k] + 1, root[k] == k) for k in range(len(sets))}
    kept = {r.doc_id for r in minhash.deduplicate(frame(texts)).collect()}
    assert kept == {k + 1 for k in range(len(sets)) if root[k] == k}


def test_circulant_signatures_estimate_similarity():
    draw = np.random.default_rng(0)
    x = draw.integers(0, 2**63, 1500).astype(np.uint64)
    a, b = x[:1200], x[300:]
    share = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(share - 900 / 1500) < 0.2
    first, ranks = minhash.permutations()
    assert (ranks[5][1:] == ranks[6][:-1]).all() and len(np.unique(first)) == minhash.UNIVERSE


def test_components_of_chains_and_stars(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(7, k) for k in range(200, 260)] + [(7, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {k: 100 for k in range(100, 141)} | {k: 3 for k in (3, 7, *range(200, 260))}


def test_compact_windows_are_the_cartesian_tree():
    draw = np.random.default_rng(1)
    for _ in range(200):
        v = draw.integers(0, 40, draw.integers(1, 70)).astype(np.uint32)
        width, want = int(draw.integers(1, 9)), set()
        for c in np.flatnonzero(v):
            left = right = c
            while left > 0 and v[left - 1] > v[c]:
                left -= 1
            while right + 1 < len(v) and v[right + 1] >= v[c]:
                right += 1
            if right - left + 1 >= width:
                want.add((c, left, right))
        assert set(zip(*(x.tolist() for x in passages.compact_windows(v, width)))) == want


def test_passages_find_shared_and_edited_ones(frame):
    draw = random.Random(3)
    passage = text_of(60, draw)
    texts = [" ".join(text_of(draw.randrange(0, 80), draw) + edited(passage, draw.randrange(2), draw) + text_of(draw.randrange(0, 80), draw)) for _ in range(12)]
    texts += [" ".join(text_of(120, draw)) for _ in range(12)]
    got = passages.repeated_passages(frame(texts)).collect()
    assert {r.doc_id for r in got} | {r.other_id for r in got} == set(range(1, 13))
    for r in got:
        a, b = texts[r.doc_id - 1].split()[r.first_word : r.end_word], texts[r.other_id - 1].split()[r.other_first : r.other_end]
        x, y = shingle_set(" ".join(a)), shingle_set(" ".join(b))
        assert min(len(a), len(b)) >= 50 and len(x & y) / len(x | y) == pytest.approx(r.similarity) and r.similarity >= 0.75


PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def base_spans(text: str) -> str:
    def valid(kind, m):
        digits = re.sub("[^0-9]", "", m)
        if kind == "ip":
            return all(int(p) <= 255 for p in m.split("."))
        if kind == "card":
            worth = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(w - 9 * (w > 9) for w in worth) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    spans = sorted((m.start(), k, m.end()) for k, (kind, p) in enumerate(PATTERNS) for m in re.finditer(p, text) if valid(kind, m[0]))
    return ",".join(f"{PATTERNS[k][0]}:{s}:{e}" for s, k, e in spans)


def test_personal_data_matches_plain_patterns(frame):
    draw = random.Random(4)
    bits = ["a", "b.c", "@", "x-1", ".", "com", " ", "\n", "4111111111111111", "4111 1111-1111 1111", "1", "0255", "255", "256", ".7", "+1", "+44 (20) 7946-0958", "-", "é", "日", "%", "_", "12 34"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(25))) for _ in range(600)] + ["1" * 20_000, "a" * 20_000 + "@", "1 " * 20_000, "a.b@" * 500]
    got = {r.doc_id: (r.base_sha256, r.spans, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in disclosure.personal_data(frame(texts)).collect()}
    for k, text in enumerate(texts, 1):
        want = base_spans(text)
        plain = ",".join(s for s in got[k][1].split(",") if s.split(":")[0] not in ("general", "removed"))
        assert plain == want and got[k][0] == hashlib.sha256(want.encode()).hexdigest() and got[k][2] == (want.count(",") + 1 if want else 0), text


def test_disclosing_terms_follow_the_counts(frame):
    secret = "mail kilo@kite.example.org about zephyrine matters"
    texts = [secret, secret + " again", *(f"common matters number {k} about things" for k in range(40))]
    got = {r.doc_id: r.spans for r in disclosure.personal_data(frame(texts)).collect()}
    at = secret.index("zephyrine")
    # zephyrine: n = 42, n_te = n_t = n_e = 2, so it discloses all; matters and about occur everywhere and disclose nothing.
    assert f"removed:{at}:{at + 9}" in got[1] and f"removed:{at}:{at + 9}" in got[2]
    assert str(secret.index("matters")) + ":" not in got[1] and not got[5]


def disclosed(rows: list[tuple]) -> dict[tuple, list[tuple]]:
    """Spans of every distinct (id, text) by the definition, pair by pair."""
    docs = sorted(set(rows))
    base = {d: [(int(a), kind, int(b)) for kind, a, b in (x.split(":") for x in base_spans(d[1]).split(",") if x)] for d in docs}
    terms = {d: [(m.start(), m[0].lower(), m.end()) for m in regex.finditer(r"\p{L}[\p{L}\p{M}]*", d[1])] for d in docs}
    held = {d: {(kind, d[1][a:b].lower()) for a, kind, b in base[d]} for d in docs}
    said = {d: {t for _, t, _ in terms[d]} for d in docs}
    n, n_e, n_t = len(docs), Counter(e for d in docs for e in held[d]), Counter(t for d in docs for t in said[d])
    n_te = Counter((e, t) for d in docs for e in held[d] for t in said[d])
    share = {(e, t): math.log2(n * k / (n_t[t] * n_e[e])) / math.log2(n / n_e[e]) for (e, t), k in n_te.items() if n_e[e] < n}
    assert not any(abs(x - cut) < 1e-9 for x in share.values() for cut in (0.6, 0.9))
    out = {}
    for d in docs:
        spans = list(base[d])
        for a, t, b in terms[d]:
            most = max((share.get((e, t), 0) for e in held[d]), default=0)
            if most >= 0.6 and not any(x < b and a < y for x, _, y in base[d]):
                spans.append((a, "removed" if most >= 0.9 else "general", b))
        out[d] = sorted(spans, key=lambda x: (x[0], disclosure.KINDS.index(x[1])))
    return out


def test_disclosure_matches_the_definition(spark):
    draw = random.Random(15)
    shared = ["a@b.org", "c@d.org", "1.2.3.4", "+1 234 555 0100 99", "éa@b.org"]
    bound = {"a@b.org": ["Kim", "zeno"], "c@d.org": ["Ünal", "李"], "1.2.3.4": ["router", "Kim"]}
    rows = []
    for k in range(67):
        words = [draw.choice(["the", "of", "x", "y"] + VOCABULARY[:25]) for _ in range(draw.randrange(2, 14))]
        for entity in draw.sample(shared, draw.choice([0, 0, 1, 1, 2])):
            words.insert(draw.randrange(len(words)), entity)
            words += [w for w in bound.get(entity, []) if draw.random() < 0.7]
        if k % 9 == 0:
            words.insert(3, f"own{k}@mail.net")
            words += ["name" + "abcdefghij"[k % 10] + "q" * (k // 9), "Kim", "trio" + "abc"[k // 27]]
        rows.append((k, " ".join(words)))
    # A document repeated by a third of all rows, and one id with two texts.
    rows += [rows[9]] * 40 + [rows[18]] * 3 + [(5, "again a@b.org zeno"), (70, "list " + ", ".join(f"m{k}@list.net" for k in range(30)))]
    want = disclosed(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = disclosure.personal_data(docs).collect()
    text = Counter()
    for (k, body) in rows:
        text[(k, ",".join(f"{kind}:{a}:{b}" for a, kind, b in want[(k, body)]))] += 1
    assert Counter((r.doc_id, r.spans) for r in got) == text
    assert any(":" in r.spans and "general" in r.spans for r in got) and any("removed" in r.spans for r in got)
    clean = Counter()
    for k, body in rows:
        at, out = 0, ""
        for a, kind, b in want[(k, body)]:
            if a >= at:
                out += body[at:a] + ("" if kind == "removed" else f"<{kind}>")
            at = max(at, b)
        clean[(k, out + body[at:])] += 1
    assert Counter((r.doc_id, r.text) for r in disclosure.sanitise(docs).collect()) == clean


def test_disclosure_of_long_texts(spark):
    n = 100_000
    texts = ["\n".join(f"é{k} u{k % 7000}@x{k % 11}.org" for k in range(n // 5)), "\n".join(str(k % 90 + 10) for k in range(n)), "𝒜 " * 5000 + "a@b.org 𝒜bc" + " 10.0.0.1" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in disclosure.personal_data(docs).collect()}
    assert got[0].n_email == n // 5 and got[1].spans == "" and got[2].n_ip == 3000
    for k, text in enumerate(texts):
        assert got[k].base_sha256 == hashlib.sha256(base_spans(text).encode()).hexdigest()
    clean = {r.doc_id: r.text for r in disclosure.sanitise(docs).collect()}
    assert "@" not in clean[0] and clean[0].count("<email>") == n // 5 and clean[1] == texts[1] and clean[2].count("<ip>") == 3000


def test_automaton_matches_plain_patterns():
    rules = [
        (re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), lambda m: len(m[2]) >= 6),
        (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20), (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
        *((re.compile(r.full), lambda m: True) for r in automaton.RULES[7:]),
    ]
    draw = random.Random(6)
    bits = ["password", "SECRET", "token", "Api_Key", '"', "'", " ", ":", "=", "abc", "abcdef", "0123456789abcdef", "AKIA", "ABCDEFGH12345678", "é", "\n", "deadbeef" * 3, "-", ".", "日本", "x@y", "eyJabc", "://u", "@", "eyJ"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(30))) for _ in range(4000)] + ["token" * 3000, "f" * 50_000, "eyJ" * 5000 + " eyJa.eyJb.c"]
    got = automaton.find_spans(pa.array(texts))
    numbers = [0, 1, 2, 7, 8]
    for k, text in enumerate(texts):
        want = sorted((m.start(), numbers[r], m.end()) for r, (p, good) in enumerate(rules) for m in p.finditer(text) if good(m))
        assert [s for s in got.get(k, []) if s[1] in numbers] == want, text[:200]


def test_minimal_automaton_is_small():
    one = automaton.compile_rules(["a(b|c)*d"], anywhere=False)
    assert len(one.accepts) == 4  # start, loop, accept, dead


def test_flat_graph_finds_links(spark):
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(60, 16))
    rows = np.concatenate([c + 0.12 * draw.normal(size=(20, 16)) * draw.random((20, 1)) for c in centres] + [np.repeat(centres[:1], 30, 0)])
    label = draw.integers(0, 2, len(rows))
    table = spark.createDataFrame([(k, [float(x) for x in v], int(c)) for k, (v, c) in enumerate(zip(rows, label))], "vec_id long, embedding array<double>, label int")
    x = flatgraph.unit(rows)
    near = (x @ x.T >= 0.98) & (label[:, None] == label[None])
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in flatgraph.near_vectors(table).collect()}
    found = sum(got[k].n_links for k in range(len(rows)))
    assert 0.98 * near.sum() <= found <= near.sum()
    root = reachable(len(rows), np.argwhere(near).tolist())
    assert np.mean([got[k].component_id == root[k] for k in range(len(rows))]) > 0.98


def test_flat_graph_links_a_group_that_is_cut_into_cells(spark, monkeypatch):
    monkeypatch.setattr(flatgraph, "CELL", 60)
    draw = np.random.default_rng(5)
    hot = draw.normal(size=16) + 0.1 * draw.normal(size=(400, 16))
    rows = np.concatenate([hot, draw.normal(size=(500, 16))])
    table = spark.createDataFrame([(k, [float(c) for c in v], 1) for k, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    x = flatgraph.unit(rows)
    near = x @ x.T >= 0.98
    np.fill_diagonal(near, False)
    got = {r.vec_id: r for r in flatgraph.near_vectors(table).collect()}
    found = np.array([got[k].n_links for k in range(len(rows))])
    assert (found <= near.sum(1)).all() and found.sum() >= 0.98 * near.sum() > 10_000
    root = reachable(len(rows), np.argwhere(near).tolist())
    assert np.mean([got[k].component_id == root[k] for k in range(len(rows))]) > 0.98
    monkeypatch.setattr(flatgraph, "audit", lambda *_: 0.5)
    with pytest.raises(RuntimeError, match="audited links"):
        flatgraph.near_vectors(table)


def test_robust_prune_reaches_every_row():
    x = flatgraph.unit(np.random.default_rng(1).normal(size=(400, 12)))
    medoid, adjacent = flatgraph.build(x)
    seen, todo = {medoid}, [medoid]
    while todo:
        for t in adjacent[todo.pop()]:
            if t >= 0 and t not in seen:
                seen.add(int(t))
                todo.append(int(t))
    assert len(seen) == 400


def test_decontamination_of_edited_copies(spark, frame):
    draw = random.Random(9)
    items = [text_of(40, draw) for _ in range(6)]
    texts = [" ".join(text_of(100, draw)) for _ in range(30)]
    texts += [" ".join(text_of(50, draw) + edited(item, 8, draw) + text_of(50, draw)) for item in items]
    table = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(frame(texts), table).collect()}
    assert got == {(31 + k, k) for k in range(6)}


def test_decontamination_of_frequent_parts(spark, frame):
    draw = random.Random(19)
    item = [f"only{k}" for k in range(60)]
    part = [" ".join(text_of(30, draw) + item[:36] + text_of(30, draw)) for _ in range(30)]
    texts = [*part, " ".join(text_of(30, draw) + item), *(" ".join(text_of(90, draw)) for _ in range(69))]
    table = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = {r.doc_id: r.score for r in decontamination.contaminated(frame(texts), table).collect()}
    assert set(got) == set(range(1, 32)) and got[31] == 1 and all(0.6 <= got[k] < 0.7 for k in range(1, 31))
    assert {r.doc_id for r in decontamination.decontaminate(frame(texts), table).collect()} == set(range(32, 101))


def test_alignment_is_smith_waterman():
    draw = np.random.default_rng(2)
    for _ in range(50):
        a, b = draw.integers(1, 5, draw.integers(1, 12)).astype(np.uint64), draw.integers(1, 5, draw.integers(1, 15)).astype(np.uint64)
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontamination.align(a[None], np.array([len(a)]), b[None])[0][0] == h.max()


def test_attention_gradient():
    draw = np.random.default_rng(0)
    flat = attention.initial(draw.random(attention.PLACES)).astype(np.float64)
    context, target = draw.integers(-1, attention.PLACES, (3, attention.WINDOW)), draw.integers(-1, attention.PLACES, (3, attention.STEP))
    _, d = attention.gradient(attention.unpack(flat), context, target)
    g = np.concatenate([d[n].reshape(-1) for n in attention._shapes()])
    loss = lambda f: -attention.log_probabilities(attention.unpack(f), context, target).sum() / (target >= 0).sum()
    for k in draw.choice(np.flatnonzero(np.abs(g) > 1e-4), 10):
        step = np.zeros_like(flat)
        step[k] = 1e-4
        assert g[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-4, abs=1e-5)
    small = flat.astype(np.float32) * np.float32(0.5)
    p = attention.unpack(small)
    assert np.allclose(attention.Scorer(p)(context, target), attention.log_probabilities(p, context, target), atol=1e-3)


def test_windows_score_each_token_once():
    ids, bounds = np.arange(100, 170), np.array([0, 0, 5, 70])
    _, target, text, _ = attention.windows(ids, bounds)
    for k in range(3):
        assert target[text == k].reshape(-1)[: bounds[k + 1] - bounds[k] + 1].tolist() == [*ids[bounds[k] : bounds[k + 1]], -2]
    assert (target != -1).sum() == 73


def test_language_model_counts(frame):
    texts = [" ".join(text_of(RANDOM.randrange(40))) for _ in range(60)]
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in range(1, 61)}
    counts = Counter(w for k, t in enumerate(texts, 1) if not held[k] for w in [*t.split(), None])
    total, kinds = sum(counts.values()), len(counts)
    for r in attention.score(frame(texts)).collect():
        tokens = [*texts[r.doc_id - 1].split(), None]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(tokens), sum(counts[w] > 0 for w in tokens), total)
        assert r.base_score == pytest.approx(sum(log10((counts[w] + 1) / (total + kinds + 1)) for w in tokens))
        assert np.isfinite(r.score) and r.score < 0


def test_language_is_told_apart(spark):
    draw = random.Random(7)
    bits = {"en": ["the", "ing", "th", "er", "wh"], "de": ["der", "sch", "ung", "ver", "ei"], "fr": ["eau", "ai", "que", "ch", "elle"], "es": ["ción", "os", "ado", "ll", "rr"]}
    rows = [(k, " ".join("".join(draw.choice(bits[c]) for _ in range(3)) for _ in range(20)), c) for k, c in enumerate(list(bits) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language.predict(docs, language.fit(docs)).collect()}
    assert all(got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2) for k, _, _ in rows)
    held = [got[k].lang_pred == c for k, _, c in rows if got[k].held_out]
    assert np.mean(held) > 0.95


def test_toxicity_grades(spark):
    draw = random.Random(11)
    cues = ["vile", "rotten", "dumb"]
    rows = [(k, " ".join(text_of(40, draw) + (draw.sample(cues, draw.randrange(1, 4)) if k % 5 == 0 else []))) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 == 0)) for k in range(300)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(got[k].toxic == (k % 5 == 0) for k, _ in rows)
    number = {k: sum(c in t.split() for c in cues) for k, t in rows}
    mean = [np.mean([got[k].severity for k in number if number[k] == n]) for n in range(4)]
    assert mean == sorted(mean) and (np.diff(model.thresholds) >= 0).all()
    assert {r.doc_id for r in toxicity.reject(docs, model).collect()} == {k for k, _ in rows if k % 5}


def test_mixing_comes_near_its_targets(spark):
    draw = random.Random(12)
    rows = [(k, " ".join(["w"] * draw.randrange(1, 90)), draw.choice(["a", "a", "a", "b", "c", "d", None])) for k in range(900)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    again = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    total = sum(r.size for r in got)
    for source in ("a", "b", "c", "d", None):
        mine = [r for r in got if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(3, 0.01 * mine[0].target)
        assert all(r.taken <= 2 * r.size for r in mine) and mine[0].target <= 2 * mine[0].source_size
    assert sum({r.source: r.target for r in got}.values()) == pytest.approx(1.5 * total)


def test_mixture_gives_tiny_sources_their_target(spark):
    rows = [(k, "w " * 5000, "hot") for k in range(400)] + [(1000 + k, "w " * (3 + k % 9), f"tiny{k:02}") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.mixture(spark, docs, "").collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert len(target) == 61 and all(target[k] > 0 and abs(taken[k] - target[k]) <= 1 for k in target)


def test_query_gives_tiny_sources_their_target(spark):
    rows = [(k, "w " * 700, "hot") for k in range(900)] + [(2000 + k, "w " * (1 + k % 9), f"tiny{k:02}") for k in range(60)] + [(3000, None, "blank")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r.size
    assert len(target) == 62 and taken["blank"] == 0
    assert all(abs(taken[k] - target[k]) <= max(1, target[k] / 128) for k in target)


def sainte_lague(votes: list[float], most: list[int], seats: int) -> list[int]:
    """Seats one by one, each to the highest quotient votes / (2 k - 1) of a party that is below its limit."""
    won = [0] * len(votes)
    for _ in range(seats):
        best = max((k for k in range(len(votes)) if won[k] < most[k]), key=lambda k: (votes[k] / (2 * won[k] + 1), -k))
        won[best] += 1
    return won


def scattered(spark, seed: int):
    draw = random.Random(20 + seed)
    names = [f"s{k:02}" for k in range(draw.randrange(3, 25))]
    rows = [(k, "w " * draw.choice([0, 1, 2, 9, 40]), draw.choice(names[: draw.randrange(1, len(names) + 1)])) for k in range(150)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def assert_apportioned(got: list) -> None:
    size = {r.source: r.source_size for r in got}
    target = {r.source: r.target for r in got}
    order, words = sorted(size), int(1.5 * sum(size.values()) + 0.5)
    won = sainte_lague([target[s] for s in order], [2 * size[s] for s in order], words)
    assert sum(won) == words
    for source, part in zip(order, won):
        mine = [r for r in got if r.source == source]
        assert sum(r.taken for r in mine) == part
        shard = {r.doc_id: int(hashlib.md5(f"{mixing.SEED}:{r.doc_id}:{r.size}".encode()).hexdigest()[:8], 16) % max(1, -(-size[source] // mixing.SHARD_WORDS)) for r in mine}
        shards = sorted(set(shard.values()))
        sizes = [sum(r.size for r in mine if shard[r.doc_id] == k) for k in shards]
        assert [sum(r.taken for r in mine if shard[r.doc_id] == k) for k in shards] == sainte_lague(sizes, [2 * n for n in sizes], part)


@pytest.mark.parametrize("seed", range(2))
def test_mix_hands_out_every_word_by_the_highest_quotients(spark, monkeypatch, seed):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 60)
    assert_apportioned(mixing.mix(scattered(spark, seed)).collect())


def test_limits_leave_no_seat_over(spark):
    cases = [([999.9, 0.6, 0.6, 0.6, 0.6], [1000, 9, 9, 9, 9], 1002), ([5.0, 5.0], [10, 10], 9), ([0.4] * 30 + [88.0], [2] * 30 + [88], 100), ([0.0, 0.0], [0, 0], 0)]
    schema = "place int, votes double, total double, most long, seats long"
    for votes, most, seats in cases:
        parties = spark.createDataFrame([(k, v, sum(votes), m, seats) for k, (v, m) in enumerate(zip(votes, most))], schema)
        got = mixing._apportioned(parties, [], "place", "votes", "total", "most", "seats", "won").orderBy("place").collect()
        assert [r.won for r in got] == sainte_lague(votes, most, seats)


def test_pipeline_mixes_what_the_quotients_give(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 60)
    assert_apportioned(corpus_pipeline.mixture(spark, scattered(spark, 0), "").collect())


def test_every_window_of_every_training_text_is_learned_from():
    draw = np.random.default_rng(1)
    texts = [draw.integers(0, 900, n).astype(np.int64) for n in (0, 5, 16, 400, 3000, 40_000)]
    ids, bounds = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    rows, size, _, _ = attention.runs(ids, bounds)
    place = np.arange(1000)
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[k : k + 7], pa.binary())], ["ids"]) for k in range(0, len(rows), 7)]
    blocks = list(attention._blocks(iter(batches), place))
    want, target, _, _ = attention.windows(ids, bounds, attention.END)
    assert [len(c) for c, _ in blocks] and sum(size) == sum(len(c) for c, _ in blocks) == len(want)
    assert (np.concatenate([c for c, _ in blocks]) == want).all() and (np.concatenate([t for _, t in blocks]) == target).all()


def test_training_rows_hold_all_windows(frame, monkeypatch):
    kept = []
    fit = attention._fit
    monkeypatch.setattr(attention, "_fit", lambda streams, *rest: kept.append(streams.agg({"n": "sum"}).first()[0] if "n" in streams.columns else streams.count()) or fit(streams, *rest))
    texts = [" ".join(text_of(RANDOM.randrange(100, 900))) for _ in range(20)]
    attention.score(frame(texts)).count()
    model = attention.subwords(attention.TOKENIZER)
    want = 0
    for k, t in enumerate(texts, 1):
        if zlib.crc32(str(k).encode()) % 7 != 2:
            want += -(-(sum(len(model.encode(w)) for w in t.split()) + 1) // attention.STEP)
    assert kept == [want]


def test_passages_link_texts_that_share_more_with_each_other_than_with_the_first(frame):
    draw = random.Random(31)
    line = text_of(35, draw)
    texts = [" ".join(text_of(30, draw) + line + text_of(30, draw)) for _ in range(30)]
    pairs = []
    for _ in range(30):
        whole = text_of(13, draw) + line + text_of(13, draw)
        pairs.append((len(texts) + 1, len(texts) + 2))
        texts += [" ".join(text_of(25, draw) + whole + text_of(25, draw)) for _ in range(2)]
    found = {(r.other_id, r.doc_id) for r in passages.repeated_passages(frame(texts)).collect()}
    assert len(set(pairs) & found) >= 29


def test_passages_between_variants_of_a_first_text(frame):
    draw = random.Random(32)
    texts, pairs = [], []
    for _ in range(25):
        base = text_of(80, draw)
        changed = base[:]
        for k in (20, 60):
            changed[k] = f"new{draw.random()}"
        other = changed[:]
        other[40] = "else"
        first = base[:]
        for k in (10, 30, 50, 70):
            first[k] = f"old{draw.random()}"
        pairs.append((len(texts) + 2, len(texts) + 3))
        texts += [" ".join(first), " ".join(changed), " ".join(other)]
    found = {(r.other_id, r.doc_id) for r in passages.repeated_passages(frame(texts)).collect()}
    assert len(set(pairs) & found) >= 24


def test_passages_do_not_compare_again_what_was_refused(frame, monkeypatch):
    draw, wanted = random.Random(33), []
    texts = []
    for _ in range(10):  # forty shared words are linked by their windows and refused as a passage
        half = text_of(40, draw)
        texts += [" ".join(half + text_of(30, draw)), " ".join(text_of(30, draw) + half)]
    sequences = passages._sequences
    monkeypatch.setattr(passages, "_sequences", lambda documents, ids: wanted.append(ids.distinct().count()) or sequences(documents, ids))
    assert passages.repeated_passages(frame(texts)).count() == 0
    assert wanted[0] > 0 and wanted[1] == 0


def test_passage_regions_are_overlapping_links_on_a_diagonal():
    draw = np.random.default_rng(5)
    for _ in range(50):
        pair = np.sort(draw.integers(0, 4, 30))
        c, oc = draw.integers(0, 400, (2, 30))
        links = np.stack([draw.integers(0, 5, 30), c, c - draw.integers(0, 60, 30), c + draw.integers(0, 60, 30), oc, oc - 9, oc + 9, draw.integers(0, 2, 30)], 1)
        want = []
        for k in range(4):
            mine = sorted(links[pair == k].tolist(), key=lambda x: x[1] - x[4])
            parts = []
            for x in mine:
                if not parts or x[1] - x[4] - (parts[-1][-1][1] - parts[-1][-1][4]) > passages.DRIFT:
                    parts.append([])
                parts[-1].append(x)
            for part in parts:
                found = []
                for x in sorted(part, key=lambda x: x[2]):
                    if not found or x[2] > max(y[3] for y in found[-1]):
                        found.append([])
                    found[-1].append(x)
                for g in found:
                    if len({x[0] for x in g}) >= passages.ENOUGH and any(x[7] for x in g):
                        want.append((k, min(x[2] for x in g), max(x[3] for x in g) + 1, min(x[5] for x in g), max(x[6] for x in g) + 1))
        got, places = passages.regions(links, pair)
        assert sorted((int(k), *map(int, p)) for k, p in zip(got, places)) == sorted(want)


def test_attention_gradient_of_short_streams_sums_only_over_their_places():
    draw = np.random.default_rng(8)
    flat = attention.initial(draw.random(attention.PLACES)).astype(np.float64)
    context, target = draw.integers(0, attention.PLACES, (5, attention.WINDOW)), draw.integers(0, attention.PLACES, (5, attention.STEP))
    context[:3, : attention.WINDOW - attention.STEP] = -1
    target[1:, 9:] = -1
    _, d = attention.gradient(attention.unpack(flat), context, target)
    assert (d["P"][: attention.WINDOW - attention.STEP] != 0).any() and np.isfinite(np.concatenate([v.reshape(-1) for v in d.values()])).all()
    loss = lambda f: -attention.log_probabilities(attention.unpack(f), context, target).sum() / (target >= 0).sum()
    g = np.concatenate([d[n].reshape(-1) for n in attention._shapes()])
    for k in draw.choice(np.flatnonzero(np.abs(g) > 1e-4), 20):
        step = np.zeros_like(flat)
        step[k] = 1e-4
        assert g[k] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-4, abs=1e-5)
