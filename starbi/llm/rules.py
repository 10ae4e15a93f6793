"""Quality rules: a table of thresholds compiled into one projection.

:func:`text_counts` describes a text by integer counts and :data:`RULES` bounds
ratios of them; :func:`compiled` turns such a table into one boolean column and
:func:`judge` adds counts, the base verdict and the table's verdict.  Everything
is a Spark column of built-in functions in one projection over the scan: no user
function, no shuffle, and a text is held by one task only, whatever its length.
The ratios compare integers (``per * count <= most * other``), so a verdict
never hangs on the rounding of a quotient.

Words are maximal runs without the blanks x20 and x09-x0D.  A line counts if it
holds a word, and is a duplicate if it equals an earlier line of the text.  A
word repeats if it lies in a run of three words that stands twice or more in the
text, overlapping or not, the first included.  Repeated runs are found by sorting
the runs of a text with their positions (n log n in its words) and comparing
neighbours, so also a text that is one repeated word costs no more.

Cases: a null text has no words and no characters, is base-failed like the empty
text, and is not kept; rows are judged one by one, so repeated rows and ids and
null ids come back as they are; an empty table gives an empty table; only the id
and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: the characters x20 and x09-x0D
BLANKS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
#: taken off both ends of a word before it is looked up among the stop words
EDGES = ".,;:!?()[]\"'"
RUN = 3

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on",
    "or", "that", "the", "this", "to", "was", "with",
    "auf", "das", "der", "des", "die", "ein", "eine", "für", "ist", "mit", "nicht", "sich", "und",
    "von", "zu",
    "au", "dans", "de", "du", "en", "est", "et", "la", "le", "les", "pour", "que", "qui", "sur",
    "un", "une",
    "con", "del", "el", "es", "las", "los", "no", "para", "por", "se", "una", "y")


class Rule(NamedTuple):
    """``least * of <= per * count`` and ``per * count <= most * of``; a bound of
    None is open."""
    name: str
    count: str
    of: str
    per: int
    least: int | None
    most: int | None


#: Thresholds beside the base rules.  Lengths and the stop-word share follow published web-text
#: rule sets; all of them leave room for short lines and for languages with long words.
RULES = (
    Rule("mean word length", "word_chars", "n_words", 1, 2, 14),
    Rule("symbols per word", "n_symbols", "n_words", 100, None, 30),
    Rule("duplicate lines", "n_dup_lines", "n_lines", 100, None, 50),
    Rule("stop words", "n_stop_words", "n_words", 100, 6, None),
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once per row, however often ``body``
    names it (a column named twice, or inside a lambda, may be evaluated again)."""
    return F.get(F.transform(F.array(value), body), 0)


def split_words(text: Column) -> Column:
    """The words of a text; none for the empty text."""
    return let(F.btrim(text, F.lit(BLANKS)), lambda t: F.when(
        t != "", F.split(t, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>")))


def repeated_words(words: Column) -> Column:
    """How many of ``words`` lie in a run of three that occurs twice or more."""
    last = F.size(words) - RUN
    runs = F.transform(F.slice(words, 1, F.greatest(last + 1, F.lit(0))), lambda w, i: F.struct(
        F.concat_ws(" ", w, *[F.get(words, i + k) for k in range(1, RUN)]).alias("run"),
        i.alias("at")))

    def places(ordered: Column) -> Column:
        marked = F.transform(ordered, lambda x, j: F.when(
            x["run"].eqNullSafe(F.get(ordered, j - 1)["run"])
            | x["run"].eqNullSafe(F.get(ordered, j + 1)["run"]), x["at"]))
        return F.array_sort(F.array_compact(marked))

    def covered(at: Column) -> Column:
        own = F.transform(at, lambda p, k: F.least(
            F.lit(RUN), F.coalesce(F.get(at, k + 1) - p, F.lit(RUN))))
        return F.aggregate(own, F.lit(0), lambda a, b: a + b)

    return let(F.sort_array(runs), lambda ordered: let(places(ordered), covered))


def text_counts(text: Column) -> Column:
    """Struct of the counts that rules can name, all long."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    by_line = let(lines, lambda x: F.struct(
        F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("again")))

    def of_words(w: Column) -> Column:
        stops = F.filter(w, lambda x: F.btrim(F.lower(x), F.lit(EDGES)).isin(*STOP_WORDS))
        return F.struct(F.size(w).alias("n"), F.size(stops).alias("stops"),
                        repeated_words(w).alias("repeat"))

    def counts(w: Column, x: Column) -> Column:
        named = {
            "n_words": w["n"],
            "word_chars": F.length(F.translate(text, BLANKS, "")),
            "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
            "n_lines": x["n"],
            "n_dup_lines": x["again"],
            "n_repeat_words": w["repeat"],
            "n_stop_words": w["stops"],
            "n_chars": F.length(text),
        }
        return F.struct(*[c.cast("long").alias(n) for n, c in named.items()])

    return let(let(split_words(text), of_words), lambda w: let(by_line, lambda x: counts(w, x)))


def compiled(rules: tuple[Rule, ...], count: Callable[[str], Column]) -> Column:
    """The rules as one boolean column: true where all of them hold."""
    parts = []
    for r in rules:
        if r.least is not None:
            parts.append(F.lit(r.least) * count(r.of) <= r.per * count(r.count))
        if r.most is not None:
            parts.append(r.per * count(r.count) <= F.lit(r.most) * count(r.of))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Counts and verdicts per row: ``base_failed`` (fewer than 50 words, or more
    than half of them repeated) and ``kept`` (neither that nor outside a rule)."""
    counted = docs.select(F.col(id_col).alias("doc_id"),
                          text_counts(F.col(text_col)).alias("c"))

    def count(name: str) -> Column:
        return F.col("c")[name]

    failed = (count("n_words") < 50) | (100 * count("n_repeat_words") > 50 * count("n_words"))
    shown = [count(n).alias(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                         "n_repeat_words")]
    more = [count(n).alias(n) for n in ("n_lines", "n_stop_words")]
    return counted.select("doc_id", *shown, failed.alias("base_failed"),
                          (~failed & compiled(rules, count)).alias("kept"), *more)
