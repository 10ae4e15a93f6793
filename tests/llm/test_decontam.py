import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from starbi.llm import decontam
from llm.helpers import ordered, prose


def split(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute(docs, items, size=13):
    grams = []
    for item, text in items:
        w = split(text)
        if w:
            n = min(size, len(w))
            grams += [(item, w[i:i + n]) for i in range(len(w) - n + 1)]
    out = []
    for i, text in docs:
        w, hit, found = split(text), set(), set()
        for item, g in grams:
            for p in range(len(w) - len(g) + 1):
                if w[p:p + len(g)] == g:
                    hit |= set(range(p, p + len(g)))
                    found.add(item)
        listed = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((i, len(w), len(hit), len({x for x in found if x is not None}),
                    hashlib.sha256(listed.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return ordered(out)


def rows_of(result):
    return ordered(result.drop("h").collect())


@pytest.mark.parametrize("limit", [decontam.BROADCAST_ROWS, 0])
def test_against_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "BROADCAST_ROWS", limit)
    rng = random.Random(11)
    items = [(i, prose(rng, n)) for i, n in enumerate([5, 13, 14, 30, 60, 1])]
    items += [(6, "the the the the the the the the the the the the the the"), (7, items[1][1]),
              (8, None), (9, "..."), (7, items[2][1])]
    docs = []
    for i in range(40):
        words = prose(rng, rng.choice([3, 40, 90])).split()
        if i % 2:
            planted = split(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(planted) - 13))
            piece = planted[a:a + rng.choice([4, 12, 13, 20])]
            at = rng.randint(0, len(words))
            words[at:at] = [w.upper() if i % 4 == 1 and w.isascii() else w for w in piece]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(words)))
    docs += [(50, "the " * 40), docs[3], docs[3], (3, "another"), (60, None), (61, ""),
             (62, ". - ,"), (None, items[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(decontam.verdicts(d, b)) == brute(docs, items)


def test_awkward_cases(spark, docs, crowded, no_docs):
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    items = [(0, texts[12][1]), (None, texts[10][1]), (2, None), (3, texts[12][1])]
    b = spark.createDataFrame(items, "item_id long, text string")
    want = brute([t for t in texts if len(t[1] or "") < 20_000], items)
    short = F.coalesce(F.length("text"), F.lit(0)) < 20_000
    assert rows_of(decontam.verdicts(docs.where(short), b)) == want
    assert len(rows_of(decontam.verdicts(crowded, b.withColumn("win", F.lit(1))))) == len(texts)
    assert rows_of(decontam.verdicts(no_docs, b)) == []
    none = rows_of(decontam.verdicts(docs, b.limit(0)))
    assert len(none) == len(texts) and all(r[2] == 0 and not r[5] for r in none)
    kept = decontam.decontaminate(crowded, b)
    assert kept.columns == crowded.columns
    bad = [r for r in decontam.verdicts(docs, b).collect() if r.contaminated]
    assert kept.count() == len(texts) - len(bad) and bad


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "a x x b a"), (2, "b x x x x x a"), (3, "a a")],
                                 "doc_id long, text string")
    terms = spark.createDataFrame([("a",), ("b",)], "term string")
    index = decontam.positional_index(docs, terms)
    pairs = spark.createDataFrame([("a", "b"), ("a", "a")], "a string, b string")
    got = {(r.id, r.a, r.b, r.pos_a, r.pos_b)
           for r in decontam.proximity_matches(index, pairs, 3).collect()}
    assert got == {(1, "a", "b", 0, 3), (1, "a", "b", 4, 3), (3, "a", "a", 0, 1)}
