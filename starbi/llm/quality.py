"""Quality classifier: supervised subword embeddings.

A text is a bag of hashed features: its words (split at ASCII white space), the
character n-grams (3 to 5) of each word with one white space at either side,
and the word n-grams (2 to 5) that repeat one word, which share a bucket for
each n.  Each feature has a learned vector; a document is the mean of its
features' vectors, and a softmax layer on the mean gives the class
probabilities.  Vectors and layer are trained together by numpy stochastic
gradient descent on labelled documents.

Training sample.  ``sample_rows`` labelled rows (the smallest by a hash of the
id, so the same rows on every run and machine) are chosen from the label table
alone; their texts become sparse bags on the executors.  Of rows that share an
id, one trains (the smallest by a hash of the text, then by the text), so at most
``sample_rows`` bags of at most ``BUCKETS`` entries reach the driver.  The
labels are the only thing learned from; labels, language, source and id are
never inputs of a score.

Scoring.  Softmax over a mean is linear in the features before its last step,
so each feature's share of the class margin is computed once, summed over the
whole text and divided by the number of features.

Cases: a null or empty text has no features and gets the layer's bias alone; a
null id has no crc32 and counts as not held out (it can't match a label);
null labels are left out; a document with two different labels trains with
both; without any training rows every score is 0.5; repeated rows get equal
scores; an empty table gives an empty table; only the id and text columns are
read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import crc_remainder, workers_see_package

BUCKETS = 1 << 16
DIM = 8
EPOCHS = 8
RATE = 0.5
#: bound of the labelled rows that the model is fitted on
SAMPLE_ROWS = 4000
HELD_OUT_MODULUS = 5
THRESHOLD = 0.3
#: texts are read in blocks of so many characters, cut at white space
BLOCK = 1 << 20
#: buckets of the word n-grams (n = 2 to 5) that repeat one word, whatever the word
REPEATS = 4
#: odd multipliers of the hashes
_ODD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
_POWERS = np.cumprod(np.full(256, 0x9E3779B97F4A7C15, np.uint64))


def _bucket(hashed: np.ndarray) -> np.ndarray:
    """The upper bits of a 32-bit mix, as bucket numbers above the repeats'."""
    hashed = (hashed ^ (hashed >> np.uint32(15))) * _ODD[1]
    return REPEATS + (hashed >> np.uint32(8)) % np.uint32(BUCKETS - REPEATS)


def _blocks(text: str):
    at = 0
    while len(text) - at > BLOCK:
        cut = max(text.rfind(" ", at, at + BLOCK), text.rfind("\n", at, at + BLOCK))
        end = cut if cut > at else at + BLOCK
        yield text[at:end]
        at = end
    yield text[at:]


def _block_features(text: str) -> np.ndarray:
    points = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    points = np.where(blank, np.uint32(32), points)
    n, found = len(points), []
    # character n-grams that hold white space at their ends only
    hashed, inside = points[:n - 1] * _ODD[0], np.zeros(n - 1, bool)
    for k in range(1, 5):
        m = n - k
        hashed = hashed[:m] + points[k:] * _ODD[k]
        if k > 1:
            inside = inside[:m] | blank[k - 1:n - 1]
            found.append(_bucket(hashed + np.uint32(k))[~inside])
    # whole words, hashed by their characters' places
    word = np.flatnonzero(~blank)
    if len(word):
        first = np.flatnonzero(np.diff(word, prepend=-2) > 1)
        sizes = np.diff(first, append=len(word))
        place = np.arange(len(word)) - np.repeat(first, sizes)
        hashes = np.add.reduceat(points[word] * _POWERS[place & 255], first)
        found.append(_bucket((hashes ^ (hashes >> np.uint64(32))).astype(np.uint32)))
        same = hashes[1:] == hashes[:-1]
        for order in range(REPEATS):  # n-grams of one word: runs of equal neighbours
            found.append(np.full(int(same.sum()), order, np.uint32))
            same = same[1:] & same[:-1]
    return np.concatenate(found)


def features(text: str | None) -> np.ndarray:
    """Bucket numbers of all features of a text, repeats included."""
    parts = [_block_features(b) for b in _blocks(text)] if text else []
    return np.concatenate(parts) if parts else np.zeros(0, np.uint32)


def bag(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    total = np.bincount(features(text), minlength=BUCKETS).astype(np.int32)
    at = np.flatnonzero(total).astype(np.int32)
    return at, total[at]


class Model:
    """Embedding rows per bucket, and a softmax layer over their mean."""

    def __init__(self, classes: int = 2, dim: int = DIM, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.vectors = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
        self.layer, self.bias = np.zeros((dim, classes)), np.zeros(classes)
        self.classes, self.seed = classes, seed

    def fit(self, bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int],
            epochs: int = EPOCHS, rate: float = RATE) -> Model:
        """One step per document; the rate falls linearly to zero."""
        rng, step, steps = np.random.default_rng(self.seed), 0, epochs * len(bags)
        for _ in range(epochs):
            for i in rng.permutation(len(bags)):
                now = rate * (1 - step / steps)
                step += 1
                at, counts = bags[i]
                share = counts / max(1, counts.sum())
                hidden = share @ self.vectors[at]
                p = hidden @ self.layer + self.bias
                p = np.exp(p - p.max())
                p /= p.sum()
                p[labels[i]] -= 1  # gradient of the loss by the logits
                back = self.layer @ p
                self.layer -= now * np.outer(hidden, p)
                self.bias -= now * 0.1 * p
                # per-feature shares are tiny: rows move by the mean's gradient
                self.vectors[at] -= now * 10 * share[:, None] * back
        return self

    def margins(self) -> tuple[np.ndarray, float]:
        """For two classes: each bucket's share of logit 1 - logit 0; the bias."""
        w = self.layer[:, 1] - self.layer[:, 0]
        return (self.vectors @ w).astype(np.float64), float(self.bias[1] - self.bias[0])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
          id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS,
          held_out_modulus: int = HELD_OUT_MODULUS) -> Model:
    """Fit a two-class model on labelled rows whose crc32 remainder is not 0."""
    workers_see_package(docs.sparkSession)
    chosen = (labels.where(crc_remainder(id_col, held_out_modulus) != 0)
              .where(F.col(label_col).isin(0, 1))
              .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
              .distinct()
              .orderBy(F.xxhash64("_id"), "_id", "_label").limit(sample_rows))

    @F.pandas_udf("at binary, n binary")
    def bags(texts: pd.Series) -> pd.DataFrame:
        # packed: 16-bit bucket numbers and 32-bit counts
        return pd.DataFrame([(at.astype(np.uint16).tobytes(), n.tobytes())
                             for at, n in map(bag, texts)], columns=["at", "n"])

    # at most sample_rows ids: a side of bounded size
    text = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    # copies of an id collapse in each task before the shuffle; nulls only if there is no text
    one = F.min(F.struct(F.col("_text").isNull().alias("none"), F.xxhash64("_text").alias("h"),
                         F.col("_text").alias("text"))).alias("_one")
    rows = (text.join(F.broadcast(chosen), "_id").groupBy("_id", "_label").agg(one)
            .select("_id", "_label", bags(F.col("_one.text")).alias("b"))
            .select("_id", "_label", "b.at", "b.n").toArrow())
    order = sorted(range(len(rows)), key=lambda i: tuple(
        rows[c][i].as_py() for c in ("_id", "_label", "at", "n")))
    packed = [(np.frombuffer(rows["at"][i].as_buffer(), np.uint16),
               np.frombuffer(rows["n"][i].as_buffer(), np.int32)) for i in order]
    labels = rows["_label"].to_pylist()
    return Model().fit(packed, [labels[i] for i in order]) if packed else Model()


def score_column(model: Model, spark, text: Column) -> Column:
    """double: probability of class 1 of a text column."""
    workers_see_package(spark)
    margins, bias = model.margins()
    shared = spark.sparkContext.broadcast(margins)  # BUCKETS doubles: half a megabyte

    # one text at a time becomes a Python string, never a whole batch of them
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        share, out = shared.value, np.empty(len(texts))
        for i, t in enumerate(texts):
            at = features(t.as_py())
            out[i] = bias + (share[at].mean() if len(at) else 0.0)
        return pa.array(1 / (1 + np.exp(-np.clip(out, -500, 500))))
    return score(text)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             threshold: float = THRESHOLD, **training) -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **training)
    modulus = training.get("held_out_modulus", HELD_OUT_MODULUS)
    score = score_column(model, docs.sparkSession, F.col(text_col))
    rows = docs.select(
        F.col(id_col), F.coalesce(crc_remainder(id_col, modulus) == 0, F.lit(False))
        .alias("held_out"), score.alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
