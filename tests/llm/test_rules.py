import re
import time
from collections import Counter

from pyspark.sql import functions as F

from llm.helpers import awkward_texts, ordered
from starbi.llm import rules
from starbi.llm.rules import Rule

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    runs = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(runs)
    repeat = {i + k for i, run in enumerate(runs) if often[run] > 1 for k in range(3)}
    stops = sum(w.lower().strip(rules.EDGES) in rules.STOP_WORDS for w in words)
    n, symbols, chars = len(words), sum(c in rules.SYMBOLS for c in text), sum(map(len, words))
    again = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(repeat) > 50 * n
    kept = not failed and 2 * n <= chars <= 14 * n and 100 * symbols <= 30 * n \
        and 100 * again <= 50 * len(lines) and 100 * stops >= 6 * n
    return n, chars, symbols, again, len(repeat), failed, kept


GOOD = " ".join(f"the river{i} of stones{i} was long{i} and cold{i}" for i in range(12))
TEXTS = [GOOD, GOOD + "\n" + GOOD, GOOD.replace(" ", " $% "), "x" * 400 + " " + GOOD,
         GOOD.replace("the ", "thx ").replace("of ", "ofx ").replace("was", "wax").replace("and", "ant"),
         "\n".join(["same line of the text"] * 20 + [GOOD]), "a\na\r\na \n a\na\n\n\n",
         "a b c a b c", "a b c d a b c", "a a a a", "a b a b a", "x y z", "  lead and trail \x0b",
         "<|im_start|> # * $ % & | < >", " no-break blank　is part of a word"]


def test_against_brute_force(spark, docs, crowded, no_docs):
    more = [(100 + i, t, None, None, None) for i, t in enumerate(TEXTS + awkward_texts())]
    rows = docs.unionByName(spark.createDataFrame(more, docs.schema))
    want = ordered((r.doc_id, *brute(r.text)) for r in rows.collect())
    got = rules.judge(rows).select("doc_id", *COUNTS, "base_failed", "kept")
    assert ordered(got.collect()) == want
    assert {r.kept for r in got.collect()} == {True, False}
    assert ordered(rules.judge(crowded).collect()) == ordered(rules.judge(docs).collect())
    assert rules.judge(no_docs).count() == 0


def test_one_repeated_word_of_a_long_text_costs_no_more(spark):
    n = 400_000
    rows = spark.createDataFrame([(1, "the " * n), (2, "\n".join(map(str, range(n))))],
                                 "doc_id long, text string")
    t0 = time.perf_counter()
    got = {r.doc_id: r for r in rules.judge(rows).collect()}
    assert time.perf_counter() - t0 < 60
    assert got[1].n_repeat_words == n and got[1].base_failed
    assert got[2].n_repeat_words == 0 and got[2].n_dup_lines == 0 and got[2].n_lines == n


def test_other_tables_of_rules(spark):
    rows = spark.createDataFrame([(1, GOOD), (2, GOOD.replace("stones", "$"))],
                                 "doc_id long, text string")
    strict = (Rule("no symbols", "n_symbols", "n_words", 1, None, 0),)
    assert {r.doc_id: r.kept for r in rules.judge(rows, strict).collect()} == {1: True, 2: False}
    assert all(r.kept for r in rules.judge(rows, ()).collect())


def test_no_python_worker_and_no_shuffle(docs):
    plan = rules.judge(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan and "Pandas" not in plan


def test_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    judged = rules.judge(spark.read.parquet(f"{sf}/documents.parquet"))
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = {(r.quality, r.kept): r.n for r in judged.where(~F.col("base_failed")).join(labels, "doc_id")
           .groupBy("quality", "kept").agg(F.count("*").alias("n")).collect()}
    assert got.get((1, False), 0) == 0 and got.get((0, True), 0) == 0
