import hashlib
import random

from llm.helpers import ordered, prose
from pyspark.sql import functions as F

from starbi.llm import ctph


def test_rolling_hash_is_the_sequential_one():
    rng = random.Random(1)
    data = bytes(rng.randrange(256) for _ in range(300))
    window, h1, h2, h3, want = [0] * 7, 0, 0, 0, []
    for i, c in enumerate(data):
        h2 = (h2 - h1 + 7 * c) & 0xFFFFFFFF
        h1 = (h1 + c - window[i % 7]) & 0xFFFFFFFF
        window[i % 7] = c
        h3 = ((h3 << 5) ^ c) & 0xFFFFFFFF
        want.append((h1 + h2 + h3) & 0xFFFFFFFF)
    got = ctph.rolling(ctph.np.frombuffer(data, ctph.np.uint8))
    assert got.tolist() == want


def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 70))) for _ in range(2))
        assert ctph.common_subsequence(a, b) == slow_lcs(a, b)


def test_signature_lengths_and_block_choice():
    rng = random.Random(3)
    for n in (0, 1, 5, 50, 500, 5_000, 60_000):
        text = prose(rng, n)
        block, s1, s2 = ctph.fingerprint(text).split(":")
        assert len(s1) <= 64 and len(s2) <= len(s1)
        rolled = ctph.rolling(ctph.np.frombuffer(text.encode(), ctph.np.uint8))
        ends = lambda b: sum(int(r) % b == b - 1 for r in rolled)
        assert ends(int(block)) < 64
        assert int(block) == 3 or ends(int(block) // 2) >= 64
    assert ctph.fingerprint("") == ctph.fingerprint(None) == "3::"
    assert ctph.fingerprint("a" * 100_000).count(":") == 2


def test_likeness():
    rng = random.Random(4)
    for _ in range(30):
        a, b = prose(rng, 400), prose(rng, 400)
        words = a.split()
        words[200] = "changed"
        fa = ctph.fingerprint(a)
        assert ctph.likeness(fa, fa) == 1
        assert ctph.likeness(fa, ctph.fingerprint(" ".join(words))) > 0.8
        assert ctph.likeness(fa, ctph.fingerprint(b)) < 0.2
    assert ctph.likeness("3::", "3::") == 1
    assert ctph.likeness("3::", ctph.fingerprint("something")) == 0


def brute(docs):
    rows = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0), r[2], r[1] or ""))
    out = []
    for i, (key, text, _) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        f, e, n = map(ctph.fingerprint, (text, edited, after))
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e,
                    ctph.likeness(f, e), ctph.likeness(f, n)))
    return ordered(out)


def test_against_brute_force(spark, docs, crowded, no_docs):
    hashed = docs.select("doc_id", "text", F.xxhash64("text")).collect()
    want = brute([tuple(r) for r in hashed])
    for d in (docs, crowded.repartition(3)):
        assert ordered(ctph.against_next(d).collect()) == want
    assert ctph.against_next(no_docs).count() == 0
    one = ctph.against_next(docs.where("doc_id = 12")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_columns(spark, docs):
    a = ctph.fingerprint_column(spark, docs["text"])
    rows = docs.select("text", a.alias("f")).select(
        "text", "f", ctph.likeness_column(spark, F.col("f"), F.col("f")).alias("l"))
    assert all(r.f == ctph.fingerprint(r.text) and r.l == 1 for r in rows.collect())
