import random
import zlib

from pyspark.sql import functions as F

from starbi.llm import quality
from llm.helpers import awkward_texts, prose


def labelled(spark, n=260):
    rng = random.Random(4)
    rows = []
    for i in range(n):
        good = i % 3 > 0
        words = prose(rng, 40).split()
        if not good:
            words = [rng.choice([w + "%%%", w.upper() + "!!"]) for w in words]
        rows.append((i, " ".join(words), int(good)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")


def test_held_out_accuracy_and_columns(spark):
    docs, labels = labelled(spark)
    rows = quality.classify(docs, labels).join(labels, "doc_id").collect()
    assert len(rows) == 260
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [r.predicted == r.quality for r in rows if r.held_out]
    assert len(held) > 30 and sum(held) / len(held) > 0.95


def test_held_out_labels_teach_nothing(spark):
    docs, labels = labelled(spark)
    wrong = labels.withColumn("quality", F.when(
        F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col("quality"))
        .otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in quality.classify(docs, wrong).collect()}
    assert a == b


def test_scores_are_the_models_softmax(spark):
    docs, labels = labelled(spark, 60)
    model = quality.train(docs, labels)
    share, bias = model.margins()
    for r in docs.select("text", quality.score_column(model, spark, docs["text"]).alias("s")).collect():
        at, n = quality.bag(r.text)
        hidden = (n / n.sum()) @ model.vectors[at]
        p = quality.np.exp(hidden @ model.layer + model.bias)
        assert abs(r.s - p[1] / p.sum()) < 1e-9


def slow_features(text):
    """Sizes of the feature groups, counted one by one."""
    words = (text or "").encode().split()
    words = [w.decode() for w in words]
    grams = sum(max(0, len(w) + 2 - n + 1) for w in words for n in (3, 4, 5))
    runs = [sum(len(set(words[i:i + n])) == 1 for i in range(len(words) - n + 1)) for n in (2, 3, 4, 5)]
    return grams + len(words), runs


def test_features():
    for t in [*awkward_texts(), "a a a a a", "b\tb \n b c", "日本 日本"]:
        total, runs = slow_features(t)
        at = quality.features(t)
        assert [int((at == k).sum()) for k in range(4)] == runs
        assert int((at >= 4).sum()) == total
        assert at.max(initial=0) < quality.BUCKETS


def test_long_texts_are_read_whole(monkeypatch):
    text = " ".join(f"w{i % 7}x{i % 11}" for i in range(3000))
    whole = sorted(quality.features(text).tolist())
    monkeypatch.setattr(quality, "BLOCK", 1000)
    assert sorted(quality.features(text).tolist()) == whole


def test_awkward_cases(spark, docs, crowded, no_docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(14)] + [(2, None), (None, 1), (3, 0),
                                                                       (3, 1), (999, 1), (5, 7)],
                                   "doc_id long, quality int")
    a = sorted((repr(tuple(r)) for r in quality.classify(docs, labels).collect()))
    assert len(a) == docs.count()
    assert a == sorted(repr(tuple(r)) for r in quality.classify(crowded, labels).collect())
    assert quality.classify(no_docs, labels).count() == 0
    none = quality.classify(docs, labels.limit(0)).collect()
    assert {r.score for r in none} == {0.5} and {r.predicted for r in none} == {1}


def test_copies_of_an_id_train_once(spark, monkeypatch):
    docs, labels = labelled(spark, 60)
    taken = []
    real = quality.Model.fit
    monkeypatch.setattr(quality.Model, "fit", lambda self, bags, *a, **k: (
        taken.append(len(bags)), real(self, bags, *a, **k))[1])
    once = quality.train(docs, labels).margins()
    copies = docs.where("doc_id = 1").crossJoin(spark.range(200)).select("doc_id", "text")
    many = quality.train(docs.union(copies), labels).margins()
    assert taken[0] == taken[1] <= 60
    assert (once[0] == many[0]).all() and once[1] == many[1]
