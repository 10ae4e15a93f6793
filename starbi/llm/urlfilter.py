"""URL filter: path rules, and an exact block list kept as a Bloom filter cascade
(DataFrame operations only).

Cascade.  The universe is every distinct key of the corpus; some of its keys are
listed.  Level 1 is a Bloom filter of the listed keys; level 2 one of the keys
that are not listed but pass level 1; level 3 one of the listed keys that pass
level 2; and so on until nobody passes wrongly.  A key's answer is the parity of
the first level that it fails, which is exact for every key of the universe.
The levels' bits become array literals of the filter expression, so judging a
page is a projection: no join, no shuffle.

The bits of all levels together are bounded by ``MAX_BITS``.  A longer list (tens of
millions of keys) is split by a hash of the key into as many shards as that takes;
each has its own cascade, and judges the pages of its keys by a projection of its own
scan.

Cases: a null url, or one without ``://``, has an empty host and path and fits no
rule; the empty host is a key like any other; repeated rows are repeated; an
empty table, or an empty list, gives no blocked page; null keys are not listed;
``filter_urls`` reads only the id and url columns, so further columns cannot clash.
"""

from __future__ import annotations

import json
import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import ascii_lower, stored

BITS_PER_KEY = 8
HASHES = 4
#: bound of the literals: 8 MB
MAX_BITS = 1 << 26
#: (host, path, verdict); a rule holds for its host and all subdomains
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_column(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls."""
    longest_first = sorted(rules, key=lambda r: -len(r[0] + r[1]))
    fits = [((host == h) | host.endswith(f".{h}")) & path.startswith(p)
            for h, p, _ in longest_first]
    return tuple(F.coalesce(F.lit(None).cast("string"),
                            *[F.when(f, F.lit(r[0] + r[1] if k == 0 else r[2]))
                              for f, r in zip(fits, longest_first)]) for k in (0, 1))


class BloomCascade:
    """Levels of (number of bits, words of 64 bits)."""

    def __init__(self, levels: list[tuple[int, list[int]]]):
        self.levels = levels

    @staticmethod
    def _places(key: Column, level: int, bits: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits)) for j in range(HASHES)]

    @classmethod
    def _passes(cls, key: Column, level: int, bits: int, words: list[int]) -> Column:
        # from_json of a literal is folded to one array literal
        table = F.from_json(F.lit(json.dumps(words)), "array<bigint>")
        found = F.lit(True)
        for place in cls._places(key, level, bits):
            word = F.get(table, F.floor(place / 64).cast("int"))
            found = found & (F.getbit(word, F.pmod(place, F.lit(64)).cast("int")) == 1)
        return found

    @classmethod
    def build(cls, universe: DataFrame, max_bits: int = MAX_BITS) -> BloomCascade | None:
        """From distinct keys with a flag (columns key, listed); None if the
        levels would take more than ``max_bits``."""
        universe = stored(universe.select("key", "listed"), "cascade-keys")
        levels, used = [], 0
        encode, against = universe.where("listed"), universe.where("not listed")
        while True:
            n = encode.count()
            if n == 0:
                return cls(levels)
            level = len(levels)
            bits = 64 * max(1, math.ceil(n * BITS_PER_KEY / 64))
            used += bits
            if used > max_bits:
                return None
            at = encode.select(F.explode(F.array(*cls._places(F.col("key"), level, bits))).alias("p"))
            # at most bits / 64 rows
            rows = (at.groupBy(F.floor(F.col("p") / 64).alias("w"))
                    .agg(F.bit_or(F.expr("shiftleft(1L, cast(p % 64 as int))")).alias("b")).toArrow())
            words = [0] * (bits // 64)
            for w, b in zip(rows["w"].to_pylist(), rows["b"].to_pylist()):
                words[w] = b
            levels.append((bits, words))
            wrong = stored(against.where(cls._passes(F.col("key"), level, bits, words)),
                           "cascade-level")
            encode, against = wrong, encode

    def contains(self, key: Column) -> Column:
        """Whether a key of the universe is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            bits, words = self.levels[level]
            answer = F.when(self._passes(key, level, bits, words), answer) \
                .otherwise(F.lit(level % 2 == 1))
        return F.coalesce(answer, F.lit(False))


def shard_of(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)).cast("int")


def cascades(universe: DataFrame, max_bits: int = MAX_BITS) -> list[BloomCascade]:
    """One cascade per shard of the keys, as few as keep each within ``max_bits``."""
    universe = stored(universe.select("key", "listed"), "cascade-universe")
    shards = 1
    while True:
        built = []
        for i in range(shards):
            cascade = BloomCascade.build(universe.where(shard_of(F.col("key"), shards) == i), max_bits)
            if cascade is None:
                break
            built.append(cascade)
        if len(built) == shards:
            return built
        if max_bits < 64 * HASHES:
            raise ValueError(f"{max_bits} bits hold no cascade")
        shards *= 2


def filter_urls(pages: DataFrame, listed: DataFrame, rules=RULES, id_col: str = "page_id",
                url_col: str = "url", max_bits: int = MAX_BITS) -> DataFrame:
    """(id, host, path, rule, verdict, listed) of every row.  ``listed`` has the
    blocked hosts (column host); a rule that fits decides, else the list does."""
    rows = pages.select(F.col(id_col), host(F.col(url_col)).alias("host"),
                        path(F.col(url_col)).alias("path"))
    blocked = listed.select(F.col("host").alias("key")).where("key is not null").distinct() \
        .withColumn("found", F.lit(True))
    universe = (rows.groupBy(F.col("host").alias("key")).agg(F.lit(1).alias("one"))
                .join(blocked, "key", "left")
                .select("key", F.coalesce("found", F.lit(False)).alias("listed")))
    shards = cascades(universe, max_bits)
    parts = [(rows if len(shards) == 1 else rows.where(shard_of(F.col("host"), len(shards)) == i))
             .withColumn("listed", cascade.contains(F.col("host"))) for i, cascade in enumerate(shards)]
    rows = reduce(lambda a, b: a.unionByName(b), parts)
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    return rows.select(id_col, "host", "path", rule.alias("rule"), F.coalesce(
        verdict, F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow")))
        .alias("verdict"), "listed")


def suspect_hosts(pages: DataFrame, words: tuple[str, ...], share: int, rules=RULES,
                  url_col: str = "url") -> DataFrame:
    """A block list from the pages themselves (column host): hosts of whose pages at
    least ``share`` percent are blocked by a rule, and hosts with one of ``words`` as a
    part of a label."""
    h, p = host(F.col(url_col)), path(F.col(url_col))
    _, verdict = rule_column(h, p, rules)
    per = pages.select(h.alias("host"), verdict.eqNullSafe("block").cast("long").alias("bad")) \
        .groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("bad"))
    named = F.col("host").rlike(f"(^|[.-])({'|'.join(words)})([.-]|$)")
    return per.where((100 * F.col("bad") >= share * F.col("n")) | named).select("host")
