"""Hard negatives: per anchor and positive, the best rows of other labels whose
score lies in a window below the positive's.

Vectors become integers, so scores are exact inner products.  Beside each vector
the mean and the deviation of every segment of ``FINEST`` entries are stored.  Two
vectors' inner product over a segment of m entries is m times the product of the
means, plus or minus at most m times the product of the deviations; summed over
segments this bounds their score.  Longer segments' means and deviations follow
from the stored ones, so a pair is first bounded by few long segments, then by
more and shorter ones, and scored only if it is still open.

Anchors go through in blocks of at most ``BLOCK`` rows (a proven size, which is
all that is broadcast); each block is held against all rows by two scans without
a shuffle of vectors.  A task takes its rows in tiles and keeps, per anchor, the
best positives so far, whose last score closes further pairs; a few rows per task
and anchor are shuffled to their final rank.  The second scan does the same for
negatives in the windows that the positives set.  The number of scans grows with
the anchors (they are a share of the rows), the memory of a task does not.
Bounds decide only which pairs are scored: no partner is capped or missed.

Cases: rows whose id, label or vector is null, whose vector is empty, holds a null
or non-finite entry, or is not of the most frequent length take no part.  Rows are
told apart by a row number: of repeated rows each is an anchor by itself and the
others are its other rows; ties go to the smaller id, then to the smaller row
number, which only tells apart rows of one id.  Anchors without positives, and
positives without negatives in the window (a negative score has none), give no
rows.  Entries beyond 2**26 units are held there.  An empty table gives an empty
table; only the id, label and vector columns are read.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbi.llm.common import stored, workers_see_package
from starbi.llm.whitening import grid_points
from starbi.session import checkpoint_dir, remove_at_exit

SCALE = 256
EDGE = float(1 << 26)
#: entries of a segment: stored, and the levels from long to short
FINEST = 4
LEVELS = (16, 8, 4)
#: anchors of a block, and the sides of a tile inside a task
BLOCK = 32_768
TILE = (512, 4_096)
#: a level that closes fewer pairs than this share is the last before scoring
WORTH = 0.05
_NONE = -(1 << 62)


def segment_summary(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of every segment of ``FINEST`` entries (the vector is
    filled up with zeros to whole segments of the longest level)."""
    parts = padded(x).reshape(len(x), -1, FINEST)
    mean = parts.mean(axis=2)
    return mean, np.sqrt(((parts - mean[:, :, None]) ** 2).mean(axis=2))


def padded(x: np.ndarray) -> np.ndarray:
    """Zeros at the end change no inner product."""
    return np.pad(x, ((0, 0), (0, -x.shape[1] % LEVELS[0]))).astype(float)


def levels(mean: np.ndarray, deviation: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, means and deviations times the root of the segment's length, so
    that their products are those of the bound."""
    out = []
    for length in LEVELS:
        shape = (len(mean), -1, length // FINEST)
        inner = mean.reshape(shape)
        m = inner.mean(axis=2)
        spread = (deviation.reshape(shape) ** 2 + (inner - m[:, :, None]) ** 2).mean(axis=2)
        out.append((m * math.sqrt(length), np.sqrt(spread * length)))
    return out


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:  # every partial sum is a whole number that a double holds
        return np.rint(a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Best:
    """The ``k`` best (score falling, then id, then row) per slot."""

    def __init__(self, slots: int, k: int) -> None:
        self.k = k
        self.score = np.full((slots, k), _NONE)
        self.vid = np.full((slots, k), np.iinfo(np.int64).max)
        self.rid = np.full((slots, k), np.iinfo(np.int64).max)

    def offer(self, slot: np.ndarray, score: np.ndarray, vid: np.ndarray, rid: np.ndarray) -> None:
        s, v, r = self.score[slot, -1], self.vid[slot, -1], self.rid[slot, -1]
        better = (score > s) | (score == s) & ((vid < v) | (vid == v) & (rid < r))
        if not better.any():
            return
        slot = slot[better]
        have = np.unique(slot)
        slot = np.concatenate([slot, np.repeat(have, self.k)])
        score = np.concatenate([score[better], self.score[have].ravel()])
        vid = np.concatenate([vid[better], self.vid[have].ravel()])
        rid = np.concatenate([rid[better], self.rid[have].ravel()])
        order = np.lexsort((rid, vid, -score, slot))
        slot, score, vid, rid = slot[order], score[order], vid[order], rid[order]
        start = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        place = np.arange(len(slot)) - np.repeat(start, np.diff(np.r_[start, len(slot)]))
        first = place < self.k
        at = slot[first], place[first]
        self.score[at], self.vid[at], self.rid[at] = score[first], vid[first], rid[first]

    def rows(self) -> dict[str, np.ndarray]:
        slot, place = np.nonzero(self.score > _NONE)
        return {"slot": slot, "score": self.score[slot, place], "vid": self.vid[slot, place],
                "rid": self.rid[slot, place]}


class Vectors:
    """Rows of the prepared table as arrays."""

    def __init__(self, table: pa.Table | pa.RecordBatch) -> None:
        def matrix(name: str) -> np.ndarray:
            column = table.column(name)
            if isinstance(column, pa.ChunkedArray):
                column = column.combine_chunks()
            flat = column.flatten().to_numpy(zero_copy_only=False)
            return flat.reshape(len(table), -1) if len(table) else flat.reshape(0, 1)
        self.rid, self.vid, self.label = (table.column(c).to_numpy(zero_copy_only=False)
                                          if isinstance(table, pa.RecordBatch)
                                          else table.column(c).to_numpy()
                                          for c in ("rid", "vec_id", "label"))
        self.x, self.mean, self.deviation = matrix("x"), matrix("mean"), matrix("deviation")
        self.levels = levels(self.mean, self.deviation)


def open_pairs(a: Vectors, at: np.ndarray, b: Vectors, rows: np.ndarray, least: np.ndarray,
               most: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Of anchors ``at`` and ``rows``, those with a pair whose bounds leave room for
    a score of at least ``least`` (and at most ``most``) of the anchor."""
    for (ma, da), (mb, db) in zip(a.levels, b.levels):
        if not len(at) or not len(rows):
            break
        middle, radius = ma[at] @ mb[rows].T, da[at] @ db[rows].T
        # the products above are rounded: a little more room
        radius += 1e-9 * (1 + np.abs(middle).max(initial=0) + radius.max(initial=0))
        possible = middle + radius >= least[at, None]
        if most is not None:
            possible &= middle - radius <= most[at, None]
        share = possible.mean()
        at, rows = at[possible.any(axis=1)], rows[possible.any(axis=0)]
        if share > 1 - WORTH:
            break
    return at, rows


def _tiles(n_anchors: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for i in range(0, len(n_anchors), TILE[0]):
        for j in range(0, len(rows), TILE[1]):
            yield n_anchors[i:i + TILE[0]], rows[j:j + TILE[1]]


def find_positives(a: Vectors, b: Vectors, best: Best) -> None:
    """Offers the rows of ``b`` to the anchors of the same label."""
    for label in np.intersect1d(a.label, b.label):
        for at, rows in _tiles(np.flatnonzero(a.label == label), np.flatnonzero(b.label == label)):
            least = best.score[:, -1].astype(float)
            at, rows = open_pairs(a, at, b, rows, least)
            s = scores(a.x[at], b.x[rows])
            i, j = np.nonzero((s >= best.score[at, -1][:, None])
                              & (a.rid[at][:, None] != b.rid[rows][None, :]))
            best.offer(at[i], s[i, j], b.vid[rows[j]], b.rid[rows[j]])


def find_negatives(a: Vectors, b: Vectors, low: np.ndarray, high: np.ndarray, best: Best) -> None:
    """Offers the rows of ``b`` to the windows ``low .. high`` (one column per
    positive; empty where low > high) of the anchors of other labels."""
    width = low.shape[1]
    wanted = (low <= high).any(axis=1)
    for label in np.unique(a.label):
        for at, rows in _tiles(np.flatnonzero((a.label == label) & wanted),
                               np.flatnonzero(b.label != label)):
            need = np.maximum(low, best.score[:, -1].reshape(-1, width))
            live = low <= high
            least = np.where(live, need, np.iinfo(np.int64).max).min(axis=1).astype(float)
            most = np.where(live, high, _NONE).max(axis=1).astype(float)
            at, rows = open_pairs(a, at, b, rows, least, most)
            s = scores(a.x[at], b.x[rows])
            for k in range(width):
                i, j = np.nonzero((s >= need[at, k][:, None]) & (s <= high[at, k][:, None]))
                best.offer(at[i] * width + k, s[i, j], b.vid[rows[j]], b.rid[rows[j]])


def prepare(embeddings: DataFrame, id_col: str = "vec_id", label_col: str = "label",
            vec_col: str = "embedding") -> DataFrame:
    """The rows that take part, numbered, with their integers and segment
    summaries, written to the shared folder."""
    workers_see_package(embeddings.sparkSession)
    points, _ = grid_points(embeddings.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()),
                            id_col, vec_col, SCALE, 0, EDGE, label=F.col(label_col).cast("long"))
    numbered = points.select(F.monotonically_increasing_id().alias("rid"),
                             F.col("vec_id").cast("long").alias("vec_id"), "label",
                             F.col("x").cast("array<int>").alias("x"))

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), -1)
                mean, deviation = segment_summary(x)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(mean)), pa.array(list(deviation))],
                    names=[*batch.schema.names, "mean", "deviation"])

    return stored(numbered.mapInArrow(
        summaries, "rid long, vec_id long, label long, x array<int>, mean array<double>, "
                   "deviation array<double>"), "negatives-rows")


_FOUND = "slot long, score long, vid long, rid long"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The final ``k`` of what tasks found per slot."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vid", "rid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(rows: DataFrame, anchors: DataFrame, positives: int, negatives: int,
           low: int, high: int) -> DataFrame:
    """One block of anchors against all rows."""
    spark = rows.sparkSession
    a = Vectors(anchors.toArrow())  # at most BLOCK rows
    count = len(a.rid)
    shared = spark.sparkContext.broadcast(a)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(count, positives)
        for batch in batches:
            if len(batch):
                find_positives(shared.value, Vectors(batch), best)
        yield pa.RecordBatch.from_pydict(best.rows())

    # at most ``positives`` rows per anchor of the block
    top = _ranked(rows.mapInArrow(first, _FOUND), positives).toArrow().to_pydict()
    slot, place = np.array(top["slot"], int), np.array(top["rank"], int) - 1
    p_id = np.zeros((count, positives), np.int64)
    p_score = np.full((count, positives), -1)
    p_id[slot, place], p_score[slot, place] = top["vid"], top["score"]
    # low * p <= 100 * s <= high * p in whole numbers; a negative p leaves nothing
    least, most = -((-low * p_score) // 100), (high * p_score) // 100
    most = np.where(p_score < 0, least - 1, most)
    windows = spark.sparkContext.broadcast((least, most))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(count * positives, negatives)
        for batch in batches:
            if len(batch):
                find_negatives(shared.value, Vectors(batch), *windows.value, best)
        yield pa.RecordBatch.from_pydict(best.rows())

    names = spark.sparkContext.broadcast((a.vid, p_id, p_score))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vid, ids, points = names.value
        for batch in batches:
            anchor, k = np.divmod(batch.column("slot").to_numpy(), positives)
            yield pa.RecordBatch.from_arrays(
                [pa.array(vid[anchor]), pa.array(ids[anchor, k]), batch.column("rank"),
                 batch.column("vid"), pa.array(points[anchor, k]), batch.column("score")],
                names=_RESULT_NAMES)

    return _ranked(rows.mapInArrow(second, _FOUND), negatives).mapInArrow(named, _RESULT)


_RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
           "negative_score long")
_RESULT_NAMES = [c.split()[0] for c in _RESULT.split(", ")]


def mine(embeddings: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3,
         low: int = 50, high: int = 95, id_col: str = "vec_id", label_col: str = "label",
         vec_col: str = "embedding", block: int = BLOCK) -> DataFrame:
    """The ``negatives`` best rows of other labels per anchor and each of its
    ``positives`` best other rows of its label, with
    low * positive_score <= 100 * negative_score <= high * positive_score.

    ``is_anchor`` is a condition on the column ``vec_id``."""
    spark = embeddings.sparkSession
    rows = prepare(embeddings, id_col, label_col, vec_col)
    anchors = rows.where(is_anchor)
    total = anchors.count()
    # by a hash of the row number, twice as many blocks as would just do: none overflows
    blocks = 1 if total <= block else math.ceil(2 * total / block)
    folder = f"{checkpoint_dir(spark).rstrip('/')}/llm-negatives-{uuid.uuid4().hex}"
    remove_at_exit(spark, folder)
    paths = []
    for k in range(blocks if total else 0):
        mine_ = anchors.where(F.pmod(F.xxhash64("rid"), F.lit(blocks)) == k)
        paths.append(f"{folder}/{k}")
        _block(rows, mine_, positives, negatives, low, high).write.parquet(paths[-1])
    if not paths:
        return spark.createDataFrame([], _RESULT)
    return spark.read.schema(_RESULT).parquet(*paths)
