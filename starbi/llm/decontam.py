"""Benchmark decontamination by a distributed positional inverted index
(DataFrame operations only).

Index.  Words are maximal runs of letters and digits of ASCII and of any
character beyond it, A-Z lower-cased.  ``positional_index`` stores a posting
(term, document, position) for every occurrence of a test term in the training
documents, clustered by term.

Phrase search.  A benchmark item is cut into windows of ``WINDOW`` words (an
item of fewer words, but not none, is one window).  The index says how often
each term of a window occurs; the postings of its ``RAREST`` rarest terms,
moved back by their offsets, are intersected on (document, start).  What
remains is compared word by word with the document's text, and every exact
match is kept.  ``proximity_matches`` finds pairs of terms within a distance
in the same index.

Verdict.  ``n_hit`` counts the document words inside the union of all matches;
a document is contaminated if n_hit > 0 and 20 * n_hit >= n_words.

Cases: a null or empty text has no words and is never hit; an item without
words has no windows; equal items or item rows count once by their id; a
document is known by its id and its text's hash, so rows that share an id but
not a text are judged apart and repeated rows get equal results; null ids are
kept; empty tables on either side give n_hit 0 or no rows; only the named
columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbi.llm.common import ascii_lower, read_table, stored

WINDOW = 13
RAREST = 2
#: a table of benchmark terms or windows of at most this many rows may be
#: broadcast; a larger one is joined by a shuffle
BROADCAST_ROWS = 200_000
#: the term of the posting at a document's end (no word holds it)
END = "\n"
#: a word before lower-casing: the class of the lower-cased word and A-Z
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _text(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def _raw_words(col: str) -> Column:
    return F.regexp_extract_all(_text(col), F.lit(_WORDS), F.lit(0))


def _lower(word: Column) -> Column:
    """``ascii_lower`` of a word: Spark's quick ``lower`` where all bytes are ASCII."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)) \
        .otherwise(ascii_lower(word))


def words(col: str) -> Column:
    return F.transform(_raw_words(col), _lower)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, h, text: a document's key is its id and its text's hash."""
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(_text(text_col)).alias("h"),
                       F.col(text_col).alias("text"))


def _same(a: DataFrame, b: DataFrame) -> Column:
    return a["id"].eqNullSafe(b["id"]) & (a["h"] == b["h"])


def _bounded(df: DataFrame) -> DataFrame:
    """A broadcast hint for a written table whose rows were counted and are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def positional_index(docs: DataFrame, terms: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Stored postings (term, id, h, pos) of the words in ``terms`` (column
    term, distinct) over all documents; files are sorted by term.  Each row's
    end is a posting too, of the term ``END`` at the number of its words."""
    terms = stored(terms.union(docs.sparkSession.createDataFrame([(END,)], "term string")),
                   "decontam-terms")
    rows = (_keyed(docs, id_col, text_col)
            .select("id", "h", F.posexplode(F.concat(_raw_words("text"), F.array(F.lit(END))))
                    .alias("pos", "word")))
    postings = (rows.select("id", "h", "pos", _lower(F.col("word")).alias("term"))
                .join(_bounded(terms), "term").select("term", "id", "h", "pos"))
    return stored(postings.sortWithinPartitions("term"), "decontam-index")


def windows(items: DataFrame, size: int = WINDOW, id_col: str = "item_id",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Stored (win, words) of the distinct windows and (win, item) of their items."""
    of = items.select(F.col(id_col).alias("item"), words(text_col).alias("w")).where("size(w) > 0")
    each = (of.select("item", "w", F.explode(F.sequence(
        F.lit(1), F.greatest(F.size("w") - (size - 1), F.lit(1)))).alias("at"))
        .select("item", F.slice("w", F.col("at"), F.least(F.lit(size), F.size("w"))).alias("words"))
        .distinct())
    each = stored(each, "decontam-items")
    wins = stored(each.select("words").distinct()
                  .select(F.monotonically_increasing_id().alias("win"), "words"),
                  "decontam-windows")
    return wins, stored(each.join(wins, "words").select("win", "item"), "decontam-window-items")


def candidates(index: DataFrame, wins: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(id, h, win, start) at which the ``rarest`` terms of a window all stand
    at their offsets."""
    seen = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    places = wins.select("win", F.posexplode("words").alias("offset", "term"))
    counted = places.join(seen, "term", "left")
    # a window with a term that never occurs has no match; else its rarest places
    w = Window.partitionBy("win")
    slots = (counted.withColumn("least", F.min(F.coalesce("n", F.lit(0))).over(w))
             .where("least > 0")
             .withColumn("slot", F.row_number().over(w.orderBy("n", "offset")) - 1)
             .where(F.col("slot") < rarest)
             .withColumn("slots", F.count(F.lit(1)).over(w)))
    slots = stored(slots.select("win", "term", "offset", "slot", "slots"), "decontam-slots")
    starts = (index.join(_bounded(slots), "term")
              .select("id", "h", "win", (F.col("pos") - F.col("offset")).alias("start"),
                      "slot", "slots").where("start >= 0"))
    met = starts.groupBy("id", "h", "win", "start", "slots").agg(
        F.bit_or(F.expr("shiftleft(1, slot)")).alias("met"))
    return met.where("met = shiftleft(1, slots) - 1").select("id", "h", "win", "start")


def phrase_matches(docs: DataFrame, index: DataFrame, wins: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Stored (id, h, win, start, len): every exact occurrence of a window in the
    documents, of which ``index`` holds the postings of all the windows' terms."""
    found = stored(candidates(index, wins), "decontam-candidates")
    per_doc = (found.join(wins, "win")
               .groupBy("id", "h").agg(F.collect_list(F.struct("win", "start", "words")).alias("c")))
    d = _keyed(docs, id_col, text_col)
    # explode(array(x)) keeps the optimizer from cutting the text into words
    # once for every candidate
    rows = (d.join(per_doc, _same(d, per_doc))
            .select(per_doc["id"], per_doc["h"], "c",
                    F.explode(F.array(words("text"))).alias("w")))
    exact = F.filter("c", lambda c: F.slice(F.col("w"), c["start"] + 1, F.size(c["words"]))
                     == c["words"])
    hits = rows.select("id", "h", F.explode(exact).alias("m")).select(
        "id", "h", "m.win", "m.start", F.size("m.words").alias("len")).distinct()
    return stored(hits, "decontam-matches")


def proximity_matches(index: DataFrame, pairs: DataFrame, within: int) -> DataFrame:
    """(id, h, a, b, pos_a, pos_b): postings of the terms ``a`` and ``b`` of a
    pair at most ``within`` words apart.  Positions meet by blocks of that width."""
    block = F.floor(F.col("pos") / within)
    left = (index.join(pairs.select("a", "b"), index.term == F.col("a"))
            .select("id", "h", "a", "b", F.col("pos").alias("pos_a"),
                    F.explode(F.array(block - 1, block, block + 1)).alias("block")))
    right = (index.join(pairs.select("a", "b"), index.term == F.col("b"))
             .select("id", "h", "a", "b", F.col("pos").alias("pos_b"), block.alias("block")))
    on = (_same(left, right) & (left["a"] == right["a"]) & (left["b"] == right["b"])
          & (left["block"] == right["block"]))
    return (left.join(right, on)
            .where((F.abs(F.col("pos_a") - F.col("pos_b")) <= within)
                   & ((left["a"] != left["b"]) | (F.col("pos_a") < F.col("pos_b"))))
            .select(left["id"], left["h"], left["a"], left["b"], "pos_a", "pos_b").distinct())


def verdicts(docs: DataFrame, items: DataFrame, size: int = WINDOW, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """(id, h, n_words, n_hit, n_items, items_sha256, contaminated) of every row."""
    wins, of_items = windows(items, size)
    terms = wins.select(F.explode("words").alias("term")).distinct()
    index = positional_index(docs, terms, id_col, text_col)
    hits = phrase_matches(docs, index, wins, id_col, text_col)
    # union of the match intervals: what each adds beyond all that began before
    spans = hits.select("id", "h", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    before = (Window.partitionBy("id", "h").orderBy("start", "end")
              .rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), F.col("end") - F.greatest(
        F.col("start"), F.coalesce(F.max("end").over(before), F.col("start"))))
    n_hit = spans.select("id", "h", added.alias("new")).groupBy("id", "h").agg(
        F.sum("new").alias("n_hit"))
    found = (hits.select("id", "h", "win").distinct().join(of_items, "win")
             .groupBy("id", "h").agg(F.collect_set(F.col("item").cast("string")).alias("items")))
    stats = n_hit.join(found.withColumnsRenamed({"id": "id2", "h": "h2"}),
                       F.col("id").eqNullSafe(F.col("id2")) & (F.col("h") == F.col("h2")), "left") \
        .select("id", "h", "n_hit", "items")
    d = index.where(F.col("term") == END).select("id", "h", F.col("pos").cast("long").alias("n_words"))
    items_col = F.coalesce("items", F.array().cast("array<string>"))
    hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return (d.join(stats, _same(d, stats), "left")
            .select(d["id"].alias(id_col), d["h"], "n_words", hit.alias("n_hit"),
                    F.size(items_col).cast("long").alias("n_items"),
                    F.sha2(F.array_join(F.array_sort(items_col), ","), 256).alias("items_sha256"),
                    ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated")))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (all columns) that are not contaminated."""
    bad = (verdicts(docs, items, id_col=id_col, text_col=text_col).where("contaminated")
           .select(F.col(id_col).alias("__llm_id"), F.col("h").alias("__llm_h")))
    bad = stored(bad, "decontam-bad")
    return docs.join(bad, docs[id_col].eqNullSafe(bad["__llm_id"])
                     & (F.xxhash64(F.coalesce(docs[text_col], F.lit(""))) == bad["__llm_h"]),
                     "left_anti")
