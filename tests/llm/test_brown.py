import math
import random
import re
import zlib

import numpy as np
import pytest

from llm.helpers import ordered
from starbi.llm import brown


def objective(bigrams, of):
    k = of.max() + 1
    m = np.zeros((len(of), k))
    m[np.arange(len(of)), of] = 1
    t = m.T @ bigrams @ m

    def h(x):
        return sum(v * math.log(v) for v in np.ravel(x) if v > 0)
    return h(t) - h(t.sum(0)) - h(t.sum(1))


def test_exchange_ends_where_no_single_move_helps():
    rng = np.random.default_rng(1)
    bigrams = rng.poisson(0.7, (24, 24)).astype(float)
    bigrams[:8, 8:16] += 5
    of = brown.exchange(bigrams, classes=4, passes=50)
    best = objective(bigrams, of)
    for u in range(24):
        for c in range(4):
            other = of.copy()
            other[u] = c
            if other.max() == of.max():
                assert objective(bigrams, other) <= best + 1e-6


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", lowered) if w] + ["\n"]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def brute(docs, classes_of, model):
    """Counts and both scores, from the definition."""
    counts = {}
    for i, t in docs:
        if not held(i):
            for w in split(t):
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, t in docs:
        words = split(t)
        base = sum(math.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in words)
        score, before = 0.0, classes_of("\n")
        for w in words:
            c = classes_of(w)
            score += model.transition[before, c] + math.log10(
                (counts.get(w, 0) + brown.EMISSION) / model.denominator[c])
            before = c
        out.append((i, held(i), len(words), sum(w in counts for w in words), n, base, score))
    return ordered(out)


def check(got, want):
    got = ordered(r[:7] for r in got)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want):
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


@pytest.fixture(params=["arrays", "join"])
def small(request, monkeypatch):
    """Few known words, so that both ways of scoring a word are met; small chunks;
    keeps the model."""
    kept = {}
    monkeypatch.setattr(brown, "CHUNK", 500)
    if request.param == "join":
        monkeypatch.setattr(brown, "LISTED", 0)
    monkeypatch.setattr(brown, "KNOWN", 12)
    monkeypatch.setattr(brown, "UNITS", 8)
    real = brown.fit_chunks
    monkeypatch.setattr(brown, "fit_chunks", lambda chunks: kept.setdefault("lm", real(chunks)))
    return kept


def test_against_brute_force(spark, docs, crowded, no_docs, small):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    for d in (docs, crowded):
        got = [tuple(r) for r in brown.score(d).collect()]
        lm = small.pop("lm")
        model, units = lm.classes, lm.units
        check(got, brute(rows, lambda w: int(model.of[units.of(w.encode())]), model))
        for r in got:
            assert r[7] == pytest.approx(10 ** (-r[6] / r[2]))
    assert brown.score(no_docs).count() == 0
    small.clear()
    only = docs.where("doc_id is not null and crc32(cast(doc_id as string)) % 7 = 2")
    assert only.count() > 0
    for r in brown.score(only).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score)


def test_probabilities_sum_to_one(spark, docs, small):
    brown.score(docs).count()
    model = small["lm"].classes
    assert np.allclose((10 ** model.transition).sum(axis=1), 1)


def test_held_out_text_scores_above_the_base(spark):
    rng = random.Random(8)
    left, right = [[f"{p}{i}" for i in range(40)] for p in ("le", "ri")]
    texts = [" ".join(rng.choice(side) for _ in range(40)) for side in (left, right)
             for _ in range(250)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = [r for r in brown.score(docs).collect() if r.held_out]
    assert len(rows) > 40 and sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_best_classes_are_those_of_the_likelihood():
    rng = np.random.default_rng(2)
    bigrams = rng.poisson(0.6, (30, 30)).astype(float)
    of = rng.integers(0, 5, 30)
    member = np.eye(5)[of]
    table = member.T @ bigrams @ member
    counts = np.concatenate([bigrams @ member, bigrams.T @ member], axis=1)
    at, slot = np.nonzero(counts)
    got = brown.best_classes(table, of, np.diagonal(bigrams).copy(), np.bincount(at, minlength=30),
                             slot, counts[at, slot], np.arange(30))
    for u in range(30):
        values = []
        for c in range(5):
            other = of.copy()
            other[u] = c
            m = np.eye(5)[other]
            values.append(brown.likelihood(m.T @ bigrams @ m))
        assert values[got[u]] == pytest.approx(max(values), abs=1e-6)


def test_every_training_word_is_clustered(spark, monkeypatch):
    """Words of one shape, none of them a unit, that differ by their neighbours alone."""
    monkeypatch.setattr(brown, "UNITS", 4)
    rng = random.Random(9)
    odd, even = ([f"w{i:03d}xx" for i in range(k, 80, 2)] for k in (0, 1))
    text = [" ".join(w for _ in range(60) for w in
                     (rng.choice(("aa", "bb")), rng.choice(odd), rng.choice(("cc", "dd")), rng.choice(even)))
            for _ in range(40)]
    lm = brown.fit(spark.createDataFrame([(t,) for t in text], "text string"))
    of = {r["word"]: r["class"] for r in lm.words.collect()}
    assert {brown.shape(w.encode()) for w in odd + even} == {brown.shape(b"w000xx")}
    mixed = sum(min(sum(of[w] == c for w in side) for side in (odd, even)) for c in set(of.values()))
    assert mixed < 20  # as one shape unit all 40 were


def test_both_forms_choose_the_same_classes(spark, docs, monkeypatch):
    monkeypatch.setattr(brown, "UNITS", 20)
    monkeypatch.setattr(brown, "BLOCK_WORDS", 700)
    training = docs.select("text")
    found = []
    for listed in (10 ** 9, 0):
        monkeypatch.setattr(brown, "LISTED", listed)
        lm = brown.fit(training)
        found.append(({r["word"]: r["class"] for r in lm.words.collect()}, lm.likelihoods))
    assert found[0][0] == found[1][0] and found[0][1] == pytest.approx(found[1][1])
    assert len(found[0][1]) >= 2 and max(found[0][1]) > found[0][1][0]


def test_packed_lists_hold_every_neighbour(spark, docs):
    rows = [t for (t,) in docs.select("text").collect()]
    want = {}
    for t in rows:
        words = [brown.word_id(w) for w in brown.tokens(t)]
        for v, w in zip([brown.word_id(brown.END), *words], words):
            want[v, w] = want.get((v, w), 0) + 1
    ids = np.array(sorted({i for pair in want for i in pair}), np.int64)
    chunks = brown.tokenised(docs.selectExpr("CAST(NULL AS string) AS id", "text", "false AS held_out"))
    width = brown.list_width(len(ids), 100_000_000)
    lists = brown.neighbour_lists(chunks, ids, width)
    v, got, blocks = len(ids), {}, lists.collect()
    assert len(blocks) > 3
    for r in blocks:
        for word, slot, n in zip(*brown._unpack(r["lists"])):
            word += r["block"] * width
            key = (ids[word], ids[slot]) if slot < v else (ids[slot - v], ids[word], "after")
            got[key] = got.get(key, 0) + n
    assert {k: n for k, n in got.items() if len(k) == 2} == want
    assert {k[:2]: n for k, n in got.items() if len(k) == 3} == want
