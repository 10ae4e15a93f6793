"""SimHash near-dedup by multi-index hashing.

Fingerprint.  Words of the text (A-Z lower-cased, split at ASCII white space),
shingles of ``SHINGLE`` words joined by one space with repeats (fewer words:
the whole sequence; none: fingerprint 0), XXH64 with seed 42 of each; a bit is
1 if it is set in over half of the hashes.

Links.  Two fingerprints link at ``distance`` (2) or fewer differing bits.
Only distinct fingerprints are compared.  They are cut into two 32-bit
segments: of a linked pair, either the high segments differ in at most one bit
or the low segments are equal.  So each fingerprint looks up the 33 values of
the Hamming ball of radius 1 round its high segment in the table of high
segments, and its low segment in the table of low segments, and the fetched
pairs are verified on all 64 bits.  A bucket of more than ``BUCKET``
fingerprints is not paired within itself.  Every fingerprint in or beside such
a bucket instead emits the 65 values at distance 0 or 1 of itself: two
fingerprints are within two bits exactly if they share such a value, so tying
all that share a value to the smallest of them loses no link and never makes
all pairs.

Cases: null and empty texts have no words, fingerprint zero, and are linked
like any others; rows with the same id are one document with several
fingerprints' links; rows without an id get a fingerprint and the component's
smallest id (null if no row of the component has one); repeated rows are
repeated; an empty table gives an empty table.  Only the id and text columns
are read, so further columns cannot clash.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import ASCII_LOWER, by_shuffle, stored, workers_see_package
from starbi.llm.components import components

SHINGLE = 3
DISTANCE = 2
SEED = 42
#: larger buckets go the way of shared neighbours (exact as well)
BUCKET = 32
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BLOCK = 1 << 14


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    words = _WORD.findall((text or "").translate(ASCII_LOWER))
    if not words:
        return 0
    joined = " ".join(words).encode("utf-8")
    # byte offsets of the words in the joined text
    starts = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20) + 1
    starts = [0, *starts.tolist(), len(joined) + 1]
    size = min(shingle, len(words))
    total, hashed, one = len(words) - size + 1, np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for i in range(0, total, _BLOCK):
        upto = min(total, i + _BLOCK)
        h = np.array([one(joined[a:b - 1], SEED)
                      for a, b in zip(starts[i:upto], starts[i + size:upto + size])], np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        hashed += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits((2 * hashed > total).astype(np.uint8), bitorder="little")
    return int(on.view(np.uint64)[0])


def fingerprint_column(text: Column, shingle: int = SHINGLE) -> Column:
    """long: the fingerprint's bits of a text column."""
    # one text at a time becomes a Python string, never a whole batch of them
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        return pa.array(np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
                        .view(np.int64))
    return of(text)


def links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """(u, v): links between the distinct fingerprints of column ``fp``, enough
    of them that all within two bits of each other are connected, and none else."""
    high, low = F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    table = stored(fps.select("fp").distinct(), "simhash-fps")
    kinds = table.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("part"), high.alias("value")),
        F.struct(F.lit(1).alias("part"), low.alias("value")))).alias("k"))
    segments = kinds.select("fp", "k.part", "k.value")
    ball = F.concat(F.array(F.lit(0).cast("long")),
                    *[F.array(*[F.lit(1 << b).cast("long") for b in range(32)])])
    probes = (table.select("fp", F.lit(0).alias("part"), high.alias("value"),
                           F.explode(ball).alias("flip"))
              .select("fp", "part", F.col("value").bitwiseXOR(F.col("flip")).alias("value"))
              .union(segments.where("part = 1").select("fp", "part", "value")))
    sizes = segments.groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    # probes that meet a bucket, with the bucket's size
    met = stored(by_shuffle(probes).join(sizes.where("n > 1 or part = 0"), ["part", "value"]),
                 "simhash-met")
    small = by_shuffle(segments).join(sizes.where(F.col("n") <= bucket).select("part", "value"),
                                      ["part", "value"]).select("part", "value", F.col("fp").alias("other"))
    pairs = (by_shuffle(met.where(F.col("n") <= bucket)).join(small, ["part", "value"])
             .where("fp < other")
             .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("other"))) <= DISTANCE)
             .select(F.col("fp").alias("u"), F.col("other").alias("v")))
    # fingerprints in or beside a large bucket: tie all that share a neighbour
    near = F.concat(F.array(F.col("fp")),
                    *[F.array(*[F.col("fp").bitwiseXOR(F.lit(1 << b if b < 63 else -(1 << 63))
                                                       .cast("long")) for b in range(64)])])
    crowd = (met.where(F.col("n") > bucket).select("fp").distinct()
             .select("fp", F.explode(near).alias("centre")))
    least = crowd.groupBy("centre").agg(F.min("fp").alias("v"), F.count(F.lit(1)).alias("n"))
    tied = (by_shuffle(crowd).join(least.where("n > 1").select("centre", "v"), "centre")
            .where("fp <> v").select(F.col("fp").alias("u"), "v"))
    return pairs.union(tied)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, bucket: int = BUCKET,
                    row_col: str | None = None) -> DataFrame:
    """(id, fingerprint, component_id) of every row: ``fingerprint`` as 16
    lower-case hex digits, ``component_id`` the smallest id reachable by links.
    With ``row_col``, that column of the rows too, and ``component``: a
    fingerprint that names the component, also where no row of it has an id."""
    workers_see_package(docs.sparkSession)
    rows = stored(docs.select(F.col(id_col).alias("id"),
                              fingerprint_column(F.col(text_col), shingle).alias("fp"),
                              *([F.col(row_col).alias("row")] if row_col else [])),
                  "simhash-rows")
    # equal fingerprints are one node; rows that share an id tie their fingerprints
    first = rows.groupBy("fp").agg(F.min("id").alias("least"))
    ids = rows.groupBy("id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")) \
        .where("id is not null and a <> b").select("id", "a")
    same_id = (rows.join(ids, "id").where("fp <> a")
               .select(F.col("fp").alias("u"), F.col("a").alias("v")))
    roots = stored(components(links(first, bucket).union(same_id), "simhash-edges"),
                   "simhash-roots")
    grouped = (first.join(roots, first.fp == roots.node, "inner")
               .select("fp", "least", "root"))
    smallest = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = grouped.join(smallest, "root").select("fp", "component_id", "root")
    named = (first.join(linked, "fp", "left")
             .select("fp", F.coalesce("component_id", "least").alias("component_id"),
                     F.coalesce("root", "fp").alias("component")))
    return (rows.join(named, "fp")
            .select(F.col("id").alias(id_col),
                    F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
                    *([F.col("row").alias(row_col), "component"] if row_col else [])))
