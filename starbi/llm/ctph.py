"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last 7 bytes (sum, weighted sum and shifted xor, as in
spamsum) ends a chunk wherever it is block - 1 modulo the block size; each
chunk, and what follows the last boundary, becomes one of 64 characters by a
hash of its bytes.  Block sizes are 3 * 2^k; the smallest with at most
``CHUNKS`` - 1 boundaries in the whole text is taken, and a second signature
has twice that block size: ``block:signature:signature of twice the block``.

Likeness.  Signatures are compared at equal block sizes only, so two
fingerprints are compatible if their block sizes are equal or one is double the
other.  The edit distance counts insertions and deletions (a change is one of
each): likeness = 1 - distance / (sum of the lengths), the best over the
compatible pairs; 0 if the signatures share no run of 7 characters (of half the
shorter one, if that is less), 1 for equal fingerprints.

Cases: a null text is the empty text (fingerprint ``3::``), like itself and
unlike any other; texts of any length are fingerprinted whole; equal texts have
equal fingerprints; an empty table gives an empty table; only the id and text
columns are read, so further columns cannot clash.  Order of the documents in
``against_next``: descending id, null ids last, rows of one id by text hash and
text; the last row's next is the first; a single row is its own next.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbi.llm.common import shuffle_partitions, stored, workers_see_package

WINDOW = 7
SMALLEST = 3
CHUNKS = 64
RUN = 7
#: fixed values: the base64 alphabet
_ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def rolling(data: np.ndarray) -> np.ndarray:
    """The rolling hash after each byte (uint32), a function of the last 7."""
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint32), data.astype(np.uint32)])
    n = len(data)
    total, weighted, shifted = (np.zeros(n, np.uint32) for _ in range(3))
    for back in range(WINDOW):
        byte = padded[WINDOW - 1 - back:WINDOW - 1 - back + n]
        total += byte
        weighted += byte * np.uint32(WINDOW - back)
        shifted ^= byte << np.uint32(5 * back)
    return total + weighted + shifted


def _signature(data: bytes, ends: np.ndarray) -> str:
    cuts = [0, *(ends + 1).tolist()]
    chunks = [data[a:b] for a, b in zip(cuts, cuts[1:])]
    if cuts[-1] < len(data):
        chunks.append(data[cuts[-1]:])
    return "".join([_ALPHABET[zlib.crc32(c) & 63] for c in chunks])


def fingerprint(text: str | None) -> str:
    data = (text or "").encode("utf-8")
    rolled = rolling(np.frombuffer(data, np.uint8))

    def ends_at(block: int, among: np.ndarray | None = None) -> np.ndarray:
        # a boundary at twice the block is one at the block too
        hashes = rolled if among is None else rolled[among]
        found = np.flatnonzero(hashes % np.uint32(block) == np.uint32(block - 1))
        return found if among is None else among[found]

    block = SMALLEST
    while block * CHUNKS * 4 < len(data):
        block *= 2
    ends = ends_at(block)
    while block > SMALLEST and len(ends) < CHUNKS:  # too coarse a start, if so
        finer = ends_at(block // 2)
        if len(finer) >= CHUNKS:
            break
        block, ends = block // 2, finer
    while len(ends) >= CHUNKS:
        block *= 2
        ends = ends_at(block, ends)
    return f"{block}:{_signature(data, ends)}:{_signature(data, ends_at(2 * block, ends))}"


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, a row of the table per step
    held in the bits of one integer."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _likeness_of(a: str, b: str) -> float:
    if a == b:
        return 1.0
    run = max(1, min(RUN, min(len(a), len(b)) // 2))
    if not a or not b or {a[i:i + run] for i in range(len(a) - run + 1)}.isdisjoint(
            b[i:i + run] for i in range(len(b) - run + 1)):
        return 0.0
    return 2 * common_subsequence(a, b) / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1 for two fingerprints."""
    if a == b:
        return 1.0
    (block_a, a1, a2), (block_b, b1, b2) = a.split(":"), b.split(":")
    size_a, size_b = int(block_a), int(block_b)
    best = 0.0
    for x, s in ((size_a, a1), (2 * size_a, a2)):
        for y, t in ((size_b, b1), (2 * size_b, b2)):
            if x == y and s and t:
                best = max(best, _likeness_of(s, t))
    # unequal fingerprints never count as equal texts
    return min(best, 0.99)


def fingerprint_column(spark, text: Column) -> Column:
    """string: the fingerprint of a text column."""
    workers_see_package(spark)

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t) for t in texts], dtype=object)
    return of(text)


def likeness_column(spark, a: Column, b: Column) -> Column:
    """double: the likeness of two fingerprint columns (null if one is null)."""
    workers_see_package(spark)

    @F.pandas_udf("double")
    def of(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else likeness(x, y)
                          for x, y in zip(left, right)], dtype=float)
    return of(a, b)


def compare(text: str, mark: str, following: str, mark_following: str) -> tuple:
    """n_chars, digest and fingerprint of the edited text, and both likenesses."""
    third = len(text) // 3
    edited = text[:len(text) - third] + following[:third]
    mark_edited = fingerprint(edited)
    return (len(text), hashlib.sha256(edited.encode("utf-8")).hexdigest(), mark, mark_edited,
            likeness(mark, mark_edited), likeness(mark, mark_following))


_RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_COLUMNS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
            "near_next"]


def _along(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One sorted range: a result row for each row that has a next row in the
    range, and the first and last rows' texts to tie ranges together."""
    before, first = None, None
    for batch in batches:
        out = []
        for pid, key, text in zip(batch["pid"], batch["id"], batch["text"]):
            text = text or ""
            now = (pid, key, text, fingerprint(text))
            if before is None:
                first = now
            else:
                out.append((before[0], before[1], *compare(*before[2:], *now[2:]), None, None))
            before = now
        yield pd.DataFrame(out, columns=["pid", "id", *_COLUMNS, "edge", "text"], dtype=object)
    if before is not None:
        blank = [None] * len(_COLUMNS)
        yield pd.DataFrame([(first[0], first[1], *blank, "first", first[2]),
                            (before[0], before[1], *blank, "last", before[2])],
                           columns=["pid", "id", *_COLUMNS, "edge", "text"], dtype=object)


def against_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text (the last third of its
    characters replaced by the first as many of the next document) and the
    likeness to the edited text's and to the next document's fingerprint.

    The texts are moved once, into ranges of the order; a task walks its range
    from row to row.  Only each range's first and last text are written, to give
    the last row its next: two texts per range.
    """
    spark = docs.sparkSession
    workers_see_package(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    order = [F.col("id").desc_nulls_last(), F.col("h"), F.col("text").asc_nulls_first()]
    ranged = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                          F.xxhash64(F.col(text_col)).alias("h"))
              .repartitionByRange(shuffle_partitions(spark), F.col("id").desc_nulls_last(), "h")
              .withColumn("pid", F.spark_partition_id()).sortWithinPartitions(*order)
              # ids as text: pandas would turn numbers with nulls into floats
              .select("pid", F.col("id").cast("string").alias("id"), "text"))
    walked = stored(ranged.mapInPandas(
        _along, f"pid int, id string, {_RESULT}, edge string, text string")
        .withColumn("id", F.col("id").cast(kind)), "ctph-rows")
    inner = walked.where("edge is null").select("id", *_COLUMNS)
    # ranges in order: one row per range, its next range's first text
    lasts = walked.where("edge = 'last'").select("pid", "id", "text")
    firsts = walked.where("edge = 'first'").select("pid", F.col("text").alias("following"))
    pids = firsts.select("pid")
    follows = pids.select("pid", F.coalesce(
        F.lead("pid").over(Window.orderBy("pid")),
        F.min("pid").over(Window.partitionBy())).alias("next_pid"))
    tied = (lasts.join(follows, "pid")
            .join(firsts.withColumnRenamed("pid", "next_pid"), "next_pid")
            .select("id", "text", "following"))

    @F.pandas_udf(_RESULT)
    def ends(text: pd.Series, following: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([compare(t, fingerprint(t), f, fingerprint(f))
                             for t, f in zip(text, following)], columns=_COLUMNS)
    outer = tied.select("id", ends("text", "following").alias("r")).select("id", "r.*")
    return inner.union(outer).withColumnRenamed("id", id_col)
