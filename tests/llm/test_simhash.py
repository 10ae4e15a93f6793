import random

import pytest
import xxhash
from pyspark.sql import functions as F

from starbi.llm import simhash
from starbi.llm.components import components
from llm.helpers import awkward_texts, ordered, prose


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in nodes:
        for b in nodes:
            if linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_fingerprint():
    for t in awkward_texts():
        if t is None or len(t) < 20_000:
            assert simhash.fingerprint(t) == brute_fingerprint(t)


def test_exploded_and_written_sides_are_not_broadcast(spark, monkeypatch):
    # Spark takes an explode's rows for as many as went in, a table for its files' bytes
    plans, write = [], simhash.stored

    def seen(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, label)
    monkeypatch.setattr(simhash, "stored", seen)
    monkeypatch.setattr("starbi.llm.components.stored", seen)
    fps = spark.range(100).selectExpr("xxhash64(id) as fp")
    linked = simhash.links(fps)
    plans.append(linked._jdf.queryExecution().executedPlan().toString())
    components(linked, "test-edges")
    assert sum("SortMergeJoin" in p for p in plans) >= 3
    assert not any("Broadcast" in p for p in plans)


@pytest.mark.parametrize("bucket", [0, 2, simhash.BUCKET])
def test_links_connect_as_brute_force_does(spark, bucket):
    rng = random.Random(bucket)
    fps = set()
    for _ in range(25):  # crowds round a centre, and lonely ones
        centre = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 40])):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    got = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket)
    pairs = {(r.u, r.v) for r in got.collect()}
    mask = (1 << 64) - 1

    def near(a, b):
        return ((a ^ b) & mask).bit_count() <= 2
    if bucket:  # direct links are true ones; shared neighbours too
        assert all(near(a, b) for a, b in pairs)
    want = brute_components(signed, near)
    have = brute_components(signed, lambda a, b: (a, b) in pairs or (b, a) in pairs)
    assert want == have


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(2, 1), (2, 1)], [(i, i + 1) for i in range(60)],
    [(0, i) for i in range(1, 40)] + [(100, i) for i in range(90, 99)] + [(98, 39)]])
def test_components(spark, edges):
    got = components(spark.createDataFrame(edges, "u long, v long"), "test").collect()
    nodes = {n for e in edges for n in e if e[0] != e[1]}
    want = brute_components(nodes, lambda a, b: (a, b) in set(edges))
    assert {r.node: r.root for r in got} == want and len(got) == len(want)


def brute_rows(docs):
    rows = [(r.doc_id, simhash.fingerprint(r.text)) for r in docs]
    n = range(len(rows))
    of = brute_components(list(n), lambda a, b: (rows[a][1] ^ rows[b][1]).bit_count() <= 2
                          or rows[a][0] is not None and rows[a][0] == rows[b][0])
    least = {}
    for i in n:
        ids = [rows[j][0] for j in n if of[j] == of[i] and rows[j][0] is not None]
        least[i] = min(ids, default=None)
    return ordered((rows[i][0], f"{rows[i][1]:016x}", least[i]) for i in n)


def test_query_rows_and_awkward_cases(docs, crowded, no_docs):
    want = brute_rows(docs.collect())
    for d in (docs, crowded):
        assert ordered(simhash.near_duplicates(d).collect()) == want
    assert simhash.near_duplicates(no_docs).count() == 0


def test_groups_of_copies_and_near_copies(spark):
    rng = random.Random(9)
    base = prose(rng, 400)
    texts = [base] * 30 + [base.replace(base.split()[i], "zz", 1) for i in range(60)]
    texts += [prose(rng, 50) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert ordered(simhash.near_duplicates(docs, bucket=4).collect()) == brute_rows(docs.collect())
    one = simhash.near_duplicates(docs.where(F.col("doc_id") < 30)).select("component_id").distinct()
    assert [r[0] for r in one.collect()] == [0]
