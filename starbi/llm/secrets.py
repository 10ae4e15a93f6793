"""Secret scans: fixed patterns, and dictionary-primed zstandard novelty.

Base kinds, each leftmost and non-overlapping over the whole text, matches that
fail their length dropped afterwards: ``assign`` (a password, secret, token or
key being given a value of 6 or more characters), ``access`` (AKIA ids of 20 or
more), ``hex`` (24 or more hexadecimal digits).

Kind ``novel``: a candidate is a run of 16 or more key characters with letters
and digits in a sensitive context that touches no base span.  The context is
sensitive if a sensitive word stands in the 48 characters before, if only dots,
blanks or line breaks part the run from one in a sensitive context (the parts of
a token, the lines of a key), and everywhere between BEGIN ... PRIVATE KEY and
END; there, a shorter run right after a reported one is reported with it.  A zstandard dictionary is primed with code identifiers and with the
text around the candidate (512 characters to each side, the candidate and all
its copies left out); the candidate's marginal bytes are its compressed size under that
dictionary less the size of an empty input.  Words, numbers and paths that the
surroundings or the identifiers already hold cost a few bytes; a candidate whose
marginal bytes reach ``NOVELTY`` of its length is reported.  So is one whose
marginal bytes reach ``NOVELTY`` of its compressed size without any dictionary,
if that size is what random characters of its alphabet (hexadecimal, base32, ...)
need: a small alphabet shortens a random string, its surroundings do not.

Spans are (kind, start, end) in code points, end exclusive, ordered by start and
then kind as listed.  Cases: a null text is scanned as the empty text and stays
null when redacted; texts of any length are scanned whole; overlapping spans of
different kinds are all reported and redacted as one; repeated rows give equal
results; empty tables give empty tables; null ids pass through.  Only the id
and text columns are read; ``redact`` keeps every column.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left

import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import workers_see_package

KINDS = ("assign", "access", "hex", "novel")
#: marginal bytes per character from which a candidate counts as incompressible
NOVELTY = 0.75
#: share of its alphabet's entropy that a random string's compressed size reaches
RANDOM = 0.95
AROUND = 512
MASK = "[SECRET]"
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                     r"""([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
# runs are maximal, so asking for the length inside the pattern drops the same matches
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_CONTEXT = re.compile(r"key|auth|bearer|credential|private|pass|pwd|secret|token|session|signature",
                      re.IGNORECASE | re.ASCII)
_REACH = 48
_JOINT = re.compile(r"[.\x20\t\r\n]+")
_KEY_BEGIN = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
_KEY_END = "-----END"
_TAIL = re.compile(r"[A-Za-z0-9+/_=-]+")
#: identifiers that often stand beside keys in code
IDENTIFIERS = (
    "public private static final const var let def function return import from class string int "
    "null none true false self this config settings environ getenv client server request response "
    "header headers authorization bearer basic content-type application/json charset utf-8 "
    "username password passwd secret token access_token refresh_token api_key apikey client_id "
    "client_secret private_key public_key session_id signature credential credentials "
    "AWS_ACCESS_KEY_ID AWS_SECRET_ACCESS_KEY example localhost http:// https:// www. .com .org "
    "0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 00000000 xxxxxxxx 12345678"
)


def marginal_bytes(candidate: str, around: str) -> int:
    """Compressed bytes that a candidate adds to its surroundings."""
    primed = zstandard.ZstdCompressionDict((IDENTIFIERS + "\n" + around).encode("utf-8"),
                                           dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    packer = zstandard.ZstdCompressor(level=19, dict_data=primed, write_content_size=False)
    return len(packer.compress(candidate.encode("utf-8"))) - len(packer.compress(b""))


def _without(before: str, run: str, text: str, a: int, b: int) -> tuple[str, str]:
    """The text to each side of text[a:b] without further copies of ``run``.  The
    windows reach one run further, so that a copy at their ends goes too."""
    wide = len(run) - 1
    start = max(0, a - AROUND)
    left = text[max(0, start - wide):a].replace(run, "")
    return left[-len(before):] if before else "", text[b:b + AROUND + wide].replace(run, "")[:AROUND]


_DIGITS, _UPPER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: from the smallest: hexadecimal in one case and both, base32, one case with digits, both
ALPHABETS = tuple(map(frozenset, (
    _DIGITS + "ABCDEF", _DIGITS + "abcdef", _DIGITS + "ABCDEFabcdef", _UPPER + "234567=",
    _UPPER.lower() + "234567=", _DIGITS + _UPPER, _DIGITS + _UPPER.lower(),
    _DIGITS + _UPPER + _UPPER.lower(), _DIGITS + _UPPER + _UPPER.lower() + "+/_=-")))


def is_novel(candidate: str, around: str) -> bool:
    """Whether neither surroundings nor identifiers explain a candidate."""
    marginal = marginal_bytes(candidate, around)
    if marginal >= NOVELTY * len(candidate):
        return True
    letters = set(candidate)
    size = next(len(x) for x in ALPHABETS if letters <= x)
    random = RANDOM * len(candidate) * math.log2(size) / 8
    if marginal < NOVELTY * random:
        return False
    packer = zstandard.ZstdCompressor(level=19, write_content_size=False)
    alone = len(packer.compress(candidate.encode("utf-8"))) - len(packer.compress(b""))
    return alone >= random and marginal >= NOVELTY * alone


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base kinds, ordered."""
    found = []
    if ":" in text or "=" in text:  # every assignment has one
        found += [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text)]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


class Regions:
    """The union of some spans, to ask in logarithmic time whether one touches it."""

    def __init__(self, spans: list[tuple]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for a, b, *_ in sorted(spans):
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(b, self.ends[-1])
            else:
                self.starts.append(a)
                self.ends.append(b)

    def touch(self, a: int, b: int) -> bool:
        i = bisect_left(self.starts, b)  # the first that begins at or after the end
        return i > 0 and self.ends[i - 1] > a


def _private_keys(text: str) -> list[tuple[int, int]]:
    """(start, end) of what stands between BEGIN ... PRIVATE KEY and END."""
    found, m = [], _KEY_BEGIN.search(text)
    while m:
        end = text.find(_KEY_END, m.end())
        if end < 0:
            break
        found.append((m.end(), end))
        m = _KEY_BEGIN.search(text, end)
    return found


def _tails(text: str, keys: list[tuple[int, int]], found: list[tuple[int, int, str]],
           taken: Regions) -> list[tuple[int, int, str]]:
    """Runs in private keys that are too short to be candidates, right after found spans."""
    ends, tails = {e for _, e, _ in found}, []
    for s, e in keys:
        last = None
        for m in _TAIL.finditer(text, s, e):
            a, b = m.span()
            if b in ends:
                last = b
            elif last is not None and b - a < 16 and not text[last:a].strip("\\ \t\r\n") \
                    and not (text[a - 1] == "\\" and m.group() in ("n", "r")) \
                    and not taken.touch(a, b):
                tails.append((a, b, "novel"))
                last = b
    return tails


def novel_spans(text: str, taken: list[tuple[int, int, str]],
                copies: bool = True) -> list[tuple[int, int, str]]:
    """(start, end, "novel") of incompressible candidates that touch no taken span.
    With ``copies`` a candidate's copies count as its surroundings; a scan leaves
    them out, so that a repeated secret is found at each place."""
    found, last = [], None
    keys = _private_keys(text) if "PRIVATE KEY" in text else []
    in_keys, base = Regions(keys), Regions(taken)
    for m in _CANDIDATE.finditer(text):
        run = m.group()
        a, b = m.span()
        if not (_CONTEXT.search(text[max(0, a - _REACH):a])
                or last is not None and _JOINT.fullmatch(text, last, a)
                or in_keys.touch(a, b)):
            continue
        last = b
        if not (any(c.isdigit() for c in run) and any(c.isalpha() for c in run)):
            continue
        if base.touch(a, b):
            continue
        before, after = text[max(0, a - AROUND):a], text[b:b + AROUND]
        if not copies:
            before, after = _without(before, run, text, a, b)
        around = before + after
        if is_novel(run, around):
            found.append((a, b, "novel"))
    return sorted(found + _tails(text, keys, found, base))


def scan_text(text: str | None) -> list[tuple[int, int, str]]:
    """All spans of one text, base and novel, ordered by start and kind."""
    base = base_spans(text or "")
    return sorted(base + novel_spans(text or "", base, copies=False), key=lambda s: (s[0], KINDS.index(s[2])))


def redact_text(text: str | None, mask: str = MASK) -> str | None:
    """``text`` with each union of overlapping spans replaced by ``mask``."""
    spans = scan_text(text)
    if not spans:
        return text
    out, at, end = [], 0, 0
    for a, b, _ in spans:
        if a >= end:
            out += [text[at:a], mask]
        at = end = max(end, b)
    return "".join(out) + text[at:]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans) of every row; spans: array<struct<start, end, kind>>."""
    workers_see_package(docs.sparkSession)

    @F.pandas_udf("array<struct<start long, end long, kind string>>")
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[{"start": a, "end": b, "kind": k} for a, b, k in scan_text(t)]
                          for t in texts], dtype=object)
    return docs.select(F.col(id_col), spans(F.col(text_col)).alias("spans"))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text."""
    found = scan(docs, id_col, text_col)

    def of(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(id_col, *[of(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined(base), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """Every row with its secrets masked; ``length_col``, if there is one,
    follows the text where that changed."""
    workers_see_package(docs.sparkSession)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([redact_text(t) for t in texts], dtype=object)
    clean = docs.withColumn("__llm_masked", masked(F.col(text_col)))
    changed = ~F.col("__llm_masked").eqNullSafe(F.col(text_col))
    return clean.select(*[
        F.col("__llm_masked").alias(c) if c == text_col else
        F.when(changed, F.char_length("__llm_masked")).otherwise(F.col(c))
        .cast(docs.schema[c].dataType).alias(c) if c == length_col else F.col(f"`{c}`")
        for c in docs.columns])
