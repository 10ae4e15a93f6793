"""LM scoring by Brown class-based bigrams.

    P(w | v) = P(class(w) | class(v)) * P(w | class(w))

Tokens: words of the text (A-Z lower-cased, split at ASCII white space) and one
end per document, which is also what stands before the first word.

Counts.  Every training token is counted: one row per distinct word, and every
distinct word bigram, written to the shared folder.  For its class a word goes by
a 64-bit hash; words of equal hash (of 12 million words, two in a run of 250,000)
would share a class and, where words are held as arrays, a count.

Start.  ``UNITS`` of the most frequent words are units of their own, every other
word belongs to one of ``SHAPES`` shape units, a function of its last characters
alone.  Units start in ``CLASSES`` classes; passes over the units in order of
frequency move each to the class that gives the highest likelihood of the class
bigrams, until a pass moves none or ``PASSES`` are done.

Exchange clustering.  From the classes of their units, passes over all training
words follow.  Every word's neighbours are counted and written once, as packed
lists of (neighbour, count).  A pass sums them by class: every word but the
``UNITS`` moves to its best class against the class bigrams of the pass's start,
all at once; then the ``UNITS`` are moved one by one as above, the other words
standing by their classes.  The passes end when none moves or one raises the
likelihood by less than ``GAIN`` of its size.  Where a pass does not raise it, the
better classes stay and from then on half as many words move (``HALVINGS`` times at
most).  The class of every training word is a row of the word table.  Unseen words
have the class that holds most training tokens of their shape (words that are units
of their own aside).

Up to ``LISTED`` distinct words, their hashes and units go to the tasks as arrays
(10 bytes a word, of a counted number): a pass reads the lists and shuffles
nothing.  Beyond it the units are a table that each pass joins with the bigrams.
Both forms choose the same classes.

Smoothing.  Class transitions have ``TRANSITION`` added to each count; a class's
words have ``EMISSION`` added to each count and to one more place, which is for
all unseen words of that class.  The log10 probability of a text is the sum
over its tokens, and perplexity is 10 ** (-score / n_tokens).

Scale.  Texts are split into words once and stored as chunks of documents with
their words and token codes, which every later step reads.  Up to ``LISTED`` words
the tasks that score hold all words' hashes, counts and classes; beyond it they hold
those of the ``KNOWN`` most frequent words, and the other words of a document are
joined with the word table.  Both ways give the same sums.

Cases: null and empty texts have one token, the end; a null id has no crc32 and
its row trains; repeated rows count and score once each; without training tokens
every count is 0 and both scores are finite; an empty table gives an empty
table; only the id and text columns are read, so further columns cannot clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbi.llm.common import crc_remainder, stored, workers_see_package

HELD_OUT_MODULUS = 7
HELD_OUT_REMAINDER = 2
UNITS = 1000
SHAPES = 64
CLASSES = 64
PASSES = 8
#: the passes over all words end with one that raises the likelihood by less than this share
GAIN = 0.002
#: and the words that move at once are halved at most so often
HALVINGS = 3
KNOWN = 40_000
#: distinct words whose hashes and units are held as arrays (10 bytes each); more are joined
LISTED = 12_000_000
#: words, and entries before merging, of a stored block of neighbour lists
BLOCK_WORDS = 50_000
BLOCK_ENTRIES = 1_500_000
#: counts up to here have their gains in a table
SMALL = 16
TRANSITION = 0.1
EMISSION = 0.5
#: tokens of a stored chunk of documents, about
CHUNK = 1_000_000
#: entries of words' neighbour counts that are compared with all classes at once
SLICE = 20_000
#: the end token: no word holds white space
END = b"\n"


def tokens(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes (of which ``lower`` and ``split`` know ASCII only),
    then the end."""
    words = (text or "").encode("utf-8").lower().split()
    words.append(END)
    return words


def shape(word: bytes) -> int:
    """The shape unit of a word that is no unit of its own."""
    return zlib.crc32(word[-2:] + bytes((min(len(word), 8) // 3,))) % SHAPES


def word_id(word: bytes) -> int:
    """The 64-bit hash that stands for a word in the bigram table."""
    return int(word_ids([word])[0])


def word_ids(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)).view(np.int64)


@dataclass
class Chunk:
    """Some documents as token codes: their ids and marks, the words by code, the
    codes of all their tokens, and how many tokens each has."""

    ids: list[str | None]
    held: np.ndarray
    words: list[bytes]
    codes: np.ndarray
    sizes: np.ndarray

    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def before(self, of: np.ndarray) -> np.ndarray:
        """What stands before each token, ``of`` giving a number for every token; the
        end stands before a document's first."""
        out = np.concatenate([of[:1], of[:-1]])
        out[self.starts()] = of[self.sizes[0] - 1]  # every document ends with the end
        return out

    def training(self) -> np.ndarray:
        return np.repeat(~self.held, self.sizes)

    def hashes(self) -> np.ndarray:
        return word_ids(self.words)


_CHUNK = "ids array<string>, held array<boolean>, words binary, codes binary"


def tokenised(rows: DataFrame) -> DataFrame:
    """The texts of ``rows`` (id string, text, held_out), read once and stored as
    chunks of about ``CHUNK`` tokens, which all later steps read."""
    workers_see_package(rows.sparkSession)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code: dict[bytes, int] = {}
        ids, held, sizes, codes, size = [], [], [], [], 0

        def chunk() -> pa.RecordBatch:
            words = zstandard.ZstdCompressor(level=1).compress(b" ".join(code))
            packed = _pack(np.concatenate(codes), np.array(sizes, np.int32))
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.string())), pa.array([held], pa.list_(pa.bool_())),
                 pa.array([words], pa.binary()), pa.array([packed], pa.binary())],
                names=["ids", "held", "words", "codes"])

        for batch in batches:
            for name, text, out in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "held_out"))):
                words = tokens(text)
                # a new word gets the next code
                codes.append(np.array([code.setdefault(w, len(code)) for w in words], np.int32))
                ids.append(name)
                held.append(out)
                sizes.append(len(words))
                size += len(words)
                if size >= CHUNK:
                    yield chunk()
                    code.clear()
                    ids, held, sizes, codes, size = [], [], [], [], 0
        if ids:
            yield chunk()

    return stored(rows.select("id", "text", "held_out").mapInArrow(pack, _CHUNK), "brown-chunks")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(len(batch)):
            ids, held, words, packed = (batch.column(c)[i] for c in ("ids", "held", "words", "codes"))
            codes, sizes = _unpack(packed.as_py())
            raw = zstandard.ZstdDecompressor().decompress(words.as_py())
            yield Chunk(ids.as_py(), np.array(held.as_py(), bool), raw.split(b" "), codes, sizes)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training words (word, id, n) of each chunk."""
    for c in _chunks(batches):
        n = np.bincount(c.codes[c.training()], minlength=len(c.words))
        have = np.flatnonzero(n)
        words = [c.words[i] for i in have]
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("utf-8") for w in words], pa.string()),
             pa.array(word_ids(words)),
             pa.array(n[have].astype(np.int64))], names=["word", "id", "n"])


class Units:
    """Numbers of units: shapes first, then END and the most frequent words."""

    def __init__(self, frequent: list[bytes]):
        self.own = {w: SHAPES + i for i, w in enumerate(
            [END, *(w for w in frequent if w != END)])}
        self.size = SHAPES + len(self.own)

    def of(self, word: bytes) -> int:
        unit = self.own.get(word)
        return shape(word) if unit is None else unit


def exchange(bigrams: np.ndarray, classes: int = CLASSES, passes: int = PASSES,
             start: np.ndarray | None = None, fixed: int = 0) -> np.ndarray:
    """The class of each unit, from a dense table of unit bigram counts; from
    given classes, the first ``fixed`` units staying where they are.

    Maximises sum N(c,d) log N(c,d) - sum left(c) log left(c) - sum right(d) log
    right(d), which is the log likelihood up to a constant.
    """
    units = len(bigrams)
    classes = max(1, min(classes, units))
    left, right = bigrams.sum(axis=1), bigrams.sum(axis=0)
    order = np.argsort(-left, kind="stable")
    of = np.empty(units, np.int64)
    of[order] = np.arange(units) % classes
    if start is not None:
        of[:] = start
        order = order[order >= fixed]
    member = np.zeros((units, classes))
    member[np.arange(units), of] = 1
    out, into = bigrams @ member, member.T @ bigrams  # unit -> class, class -> unit
    table = member.T @ out
    lefts, rights = table.sum(axis=1), table.sum(axis=0)

    def h(x):
        return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)

    for _ in range(passes):
        moved = 0
        for u in order:
            a, self_n = of[u], bigrams[u, u]
            row, col = out[u].copy(), into[:, u].copy()  # u's counts to and from classes
            row[a] -= self_n
            col[a] -= self_n
            # the table without u
            table[a] -= row
            table[:, a] -= col
            table[a, a] -= self_n
            lefts[a] -= left[u]
            rights[a] -= right[u]
            # gain of putting u into each class c: rows c and columns c change
            by_row = (h(table + row) - h(table)).sum(axis=1)
            by_col = (h(table + col[:, None]) - h(table)).sum(axis=0)
            d = np.diagonal(table)
            both = (h(d + row + col + self_n) - h(d + row) - h(d + col) + h(d))
            gain = by_row + by_col + both
            gain -= h(lefts + left[u]) - h(lefts) + h(rights + right[u]) - h(rights)
            best = int(np.argmax(gain))
            if gain[best] <= gain[a] + 1e-9:
                best = a
            table[best] += row
            table[:, best] += col
            table[best, best] += self_n
            lefts[best] += left[u]
            rights[best] += right[u]
            if best != a:
                moved += 1
                of[u] = best
                out[:, a] -= bigrams[:, u]
                out[:, best] += bigrams[:, u]
                into[a] -= bigrams[u]
                into[best] += bigrams[u]
        if not moved:
            break
    return of


def count_bigrams(chunks: DataFrame, units: Units) -> np.ndarray:
    """Dense unit bigram counts of training tokens; at most (units)^2 rows reach the
    driver."""
    shared = chunks.sparkSession.sparkContext.broadcast(units)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = shared.value
        total = np.zeros(units.size * units.size, np.int64)
        for c in _chunks(batches):
            of = np.fromiter(map(units.of, c.words), np.int64, len(c.words))[c.codes]
            cell = (c.before(of) * units.size + of)[c.training()]
            total += np.bincount(cell, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": at, "n": total[at]})

    cells = (chunks.mapInArrow(count, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    table = np.zeros(units.size * units.size)
    table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return table.reshape(units.size, units.size)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training word bigrams (v, w, n), v before w, of each chunk."""
    for c in _chunks(batches):
        ids, v = c.hashes(), len(c.words)
        of = c.codes.astype(np.int64)
        key, n = np.unique((c.before(of) * v + of)[c.training()], return_counts=True)
        yield pa.RecordBatch.from_pydict({"v": ids[key // v], "w": ids[key % v], "n": n})


def count_pairs(chunks: DataFrame) -> DataFrame:
    """The stored word bigrams (v, w, n) of all training tokens."""
    return stored(chunks.mapInArrow(_pairs, "v long, w long, n long")
                  .groupBy("v", "w").agg(F.sum("n").alias("n")), "brown-pairs")


def neighbours(pairs: DataFrame, units: DataFrame, size: int) -> DataFrame:
    """(id, unit, self, slot, n) of every word, stored: its counts before each unit
    (slots 0 to size - 1) and after each unit (the next ``size`` slots), and how
    often it follows itself."""
    other = units.select(F.col("id").alias("other"), F.col("unit").alias("u"))
    own = F.when(F.col("v") == F.col("w"), F.col("n")).otherwise(0)
    sides = pairs.select(F.col("v").alias("id"), F.col("w").alias("other"), F.lit(0).alias("from"),
                         "n", own.alias("self")) \
        .union(pairs.select("w", "v", F.lit(size), "n", F.lit(0).cast("long")))
    slots = (sides.join(other, "other")
             .groupBy("id", (F.col("from") + F.col("u")).alias("slot"))
             .agg(F.sum("n").alias("n"), F.sum("self").alias("self")))
    words = slots.groupBy("id").agg(F.sum("self").alias("self"),
                                    F.collect_list(F.struct("slot", "n")).alias("s"))
    return stored(words.join(units, "id").select(
        "id", "unit", "self", F.col("s.slot").alias("slot"), F.col("s.n").alias("n")),
        "brown-neighbours")


def _entries(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    """(id, unit, self, sizes of the words' lists, slots, counts) of a batch."""
    slot, n = batch.column("slot"), batch.column("n")
    return (*(batch.column(c).to_numpy() for c in ("id", "unit", "self")),
            np.diff(slot.offsets.to_numpy()), slot.flatten().to_numpy(), n.flatten().to_numpy())


def unit_table(around: DataFrame, size: int) -> np.ndarray:
    """Unit bigram counts: at most size^2 rows reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            _, unit, _, sizes, slot, n = _entries(batch)
            before = slot < size  # the word stands before its neighbour
            np.add.at(total, np.repeat(unit.astype(np.int64), sizes)[before] * size + slot[before],
                      n[before])
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"cell": at, "n": total[at]})

    cells = (around.mapInArrow(add, "cell long, n long")
             .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())
    table = np.zeros(size * size)
    table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
    return table.reshape(size, size)


def _h(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def likelihood(table: np.ndarray) -> float:
    """Of class bigram counts, up to a constant."""
    return float(_h(table).sum() - _h(table.sum(axis=0)).sum() - _h(table.sum(axis=1)).sum())


def class_gains(table: np.ndarray, of: np.ndarray, self_n: np.ndarray, sizes: np.ndarray,
                slot: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The likelihood (up to a constant of the word) of each word in each class, the
    word taken out of its own class ``of`` first.

    Per word ``sizes`` entries (slot, n), by slot: its counts before class ``slot``
    and, from the number of classes on, after class ``slot - classes``.  An entry
    changes one row or column of ``table``; the changes by counts up to ``SMALL`` are
    read off tables, and only the cells of the word's own class are worked out."""
    k, words = len(table), len(of)
    each = np.arange(words)
    at = np.repeat(each, sizes)
    dense = np.zeros((words, 2 * k))
    dense[at, slot] = n
    left, right = dense[:, :k].sum(axis=1), dense[:, k:].sum(axis=1)
    dense[each, of] -= self_n
    dense[each, k + of] -= self_n
    n = dense[at, slot]
    row, col = dense[:, :k], dense[:, k:]  # counts to and from classes
    gain = np.zeros((words, k))
    cells = np.concatenate([table.T, table])  # a slot's cells with every class
    steps = _h(cells[None] + np.arange(SMALL + 1)[:, None, None]) - _h(cells)
    small = n <= SMALL
    change = np.empty((len(n), k))
    change[small] = steps[n[small].astype(np.int64), slot[small]]
    # larger counts, and the word's own class as neighbour, whose cells lose the word too
    d, mine = slot % k, of[at]
    home = d == mine
    others = np.concatenate([col, row], axis=1).reshape(words, 2, k)  # by side
    odd = np.flatnonzero(~small | home)
    if len(odd):
        base = cells[slot[odd]]
        inner = np.flatnonzero(home[odd])
        base[inner] -= others[at[odd[inner]], slot[odd[inner]] // k]
        base[inner, d[odd[inner]]] -= self_n[at[odd[inner]]]
        change[odd] = _h(base + n[odd, None]) - _h(base)
    # a cell with the word's own class already holds the word's count
    base = cells[slot, mine] - n
    base[home] -= others[at[home], slot[home] // k, mine[home]] + self_n[at[home]]
    change[np.arange(len(n)), mine] = _h(base + n) - _h(base)
    if len(n):
        have = sizes > 0
        gain[have] = np.add.reduceat(change, (np.cumsum(sizes) - sizes)[have], axis=0)
    # the diagonal is in a row and in a column; it adds up unless one of them is empty
    w, c = np.nonzero((row > 0) & (col > 0) | (self_n > 0)[:, None])
    x, r, l, own = np.diagonal(table)[c].copy(), row[w, c], col[w, c], self_n[w]
    here = c == of[w]
    x[here] -= (r + l + own)[here]
    gain[w, c] += _h(x + r + l + own) - _h(x + r) - _h(x + l) + _h(x)
    for total, part in ((table.sum(axis=1), left), (table.sum(axis=0), right)):
        sizes_, which = np.unique(part, return_inverse=True)
        gain -= (_h(total + sizes_[:, None]) - _h(total))[which]
        own_total = total[of]
        gain[each, of] += (_h(own_total + part) - _h(own_total)) - (_h(own_total) - _h(own_total - part))
    return gain


def best_classes(table: np.ndarray, of: np.ndarray, self_n: np.ndarray, sizes: np.ndarray,
                 slot: np.ndarray, n: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Each word's best class if it alone moves; its own unless another is better.
    Words that find several classes equally good (as empty ones are) take one by
    their id, so that unlike words do not all move as one."""
    k = len(table)
    each = np.arange(len(of))
    gain = class_gains(table, of, self_n, sizes, slot, n)
    tied = gain >= gain.max(axis=1, keepdims=True) - 1e-9
    best = np.where(tied, (np.arange(k) - ids[:, None]) % k, k).argmin(axis=1)
    return np.where(gain[each, best] > gain[each, of] + 1e-9, best, of)


def chosen_units(table: np.ndarray, of: np.ndarray, ids: np.ndarray, unit: np.ndarray,
                 self_n: np.ndarray, sizes: np.ndarray, slot: np.ndarray, n: np.ndarray, share: int,
                 turn: int) -> np.ndarray:
    """The units of words after those that are no units of their own, or every
    ``share``-th of them by id, have chosen their classes; slots are units."""
    k, size = len(table), len(of)
    best, ends = unit.copy(), np.cumsum(sizes)
    may = (unit < k) & ((ids >> 8) % share == turn % share)
    slot = of[slot % size] + k * (slot // size)
    a = 0
    while a < len(unit):
        start = ends[a] - sizes[a]
        b = max(a + 1, int(np.searchsorted(ends, start + SLICE, "right")))
        picked = a + np.flatnonzero(may[a:b])
        if len(picked):
            cells = np.repeat(np.arange(b - a), sizes[a:b]) * 2 * k + slot[start:ends[b - 1]]
            counts = np.bincount(cells, n[start:ends[b - 1]], (b - a) * 2 * k)
            counts = counts.reshape(b - a, 2 * k)[picked - a]
            at, where = np.nonzero(counts)
            best[picked] = best_classes(
                table, unit[picked].astype(np.int64), self_n[picked],
                np.bincount(at, minlength=len(picked)), where, counts[at, where], ids[picked])
        a = b
    return best


def move_words(around: DataFrame, table: np.ndarray, of: np.ndarray, share: int,
               turn: int) -> DataFrame:
    """The stored (id, unit, moved) after every word that is no unit of its own,
    or every ``share``-th of them by id, has chosen its class; ``table`` has the
    class bigrams, ``of`` the classes of the units."""
    shared = around.sparkSession.sparkContext.broadcast((table, of))

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, unit, own, sizes, slot, n = _entries(batch)
            best = chosen_units(*shared.value, ids, unit, own, sizes, slot, n, share, turn)
            yield pa.RecordBatch.from_pydict({"id": ids, "unit": best, "moved": best != unit})
    return stored(around.mapInArrow(move, "id long, unit int, moved boolean"), "brown-units")


class JoinedWords:
    """Units of words as a table (id, unit); each pass joins the stored bigrams with
    it and stores the words' neighbours by unit."""

    def __init__(self, chunks: DataFrame):
        self.pairs = count_pairs(chunks)

    def around(self, units: DataFrame, size: int) -> tuple[np.ndarray, DataFrame]:
        near = neighbours(self.pairs, units, size)
        return unit_table(near, size), near

    def move(self, units: DataFrame, near: DataFrame, table: np.ndarray, of: np.ndarray, share: int,
             turn: int) -> tuple[DataFrame, bool]:
        moved = move_words(near, table, of, share, turn)
        return moved.drop("moved"), not moved.where("moved").isEmpty()

    def classified(self, counts: DataFrame, units: DataFrame, begin, of: np.ndarray) -> DataFrame:
        of_word = F.get(F.array(*[F.lit(int(c)) for c in of]), F.col("unit"))
        shapes = counts.select("word", "id").mapInPandas(
            lambda batches: (b[["word", "shape"]] for b in begin(batches)),
            "word string, shape int")
        return counts.join(units, "id").join(shapes, "word").select(
            "word", "id", "n", of_word.alias("class"), "shape")


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers, byte planes apart, compressed."""
    planes = [np.ascontiguousarray(a.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes() for a in arrays]
    sizes = np.array([len(arrays), *map(len, arrays)], "<i4").tobytes()
    return sizes + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(blob: bytes) -> list[np.ndarray]:
    count = int.from_bytes(blob[:4], "little")
    sizes = np.frombuffer(blob, "<i4", count, 4)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(
        blob[4 + 4 * count:], max_output_size=4 * int(sizes.sum()) or 1), np.uint8)
    out, at = [], 0
    for n in sizes:
        out.append(np.ascontiguousarray(raw[at:at + 4 * n].reshape(4, n).T).view("<i4").reshape(-1))
        at += 4 * n
    return out


def _merged(word: np.ndarray, slot: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries by word and slot, equal ones added up."""
    order = np.lexsort((slot, word))
    word, slot, n = word[order], slot[order], n[order]
    first = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (slot[1:] != slot[:-1])]) \
        if len(word) else np.zeros(0, np.int64)
    return word[first], slot[first], np.add.reduceat(n, first) if len(first) else n


def list_width(words: int, tokens_: int) -> int:
    """Words of a block of neighbour lists."""
    blocks = max(1, -(-words // BLOCK_WORDS), -(-2 * tokens_ // BLOCK_ENTRIES))
    return max(1, -(-words // blocks))


def neighbour_lists(chunks: DataFrame, ids: np.ndarray, width: int) -> DataFrame:
    """(block, lists): every training word's neighbours, written once.  Words go by
    their place among the sorted hashes ``ids``; ``width`` of them make a block.  An
    entry is (word, slot, n): how often the word stands before word ``slot`` or, from
    ``len(ids)`` on, after word ``slot - len(ids)``.  Chunks send their counts packed
    per block; a block's parts are merged."""
    v = len(ids)
    shared = chunks.sparkSession.sparkContext.broadcast(ids)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = shared.value
        for c in _chunks(batches):
            # words of held-out documents may have no place; they are not looked at
            of = np.minimum(np.searchsorted(ids, c.hashes()), v - 1)[c.codes]
            chosen = c.training()
            key, n = np.unique((c.before(of) * v + of)[chosen], return_counts=True)
            left, right = key // v, key % v
            turned = np.argsort(right, kind="stable")
            out: dict[str, list] = {"block": [], "part": []}
            for word, slot, times in ((left, right, n), (right[turned], left[turned] + v, n[turned])):
                cuts = np.searchsorted(word, np.arange(0, v + width, width))
                for i in np.flatnonzero(np.diff(cuts)):
                    a, b = cuts[i], cuts[i + 1]
                    out["block"].append(i)
                    out["part"].append(_pack(word[a:b] - i * width, slot[a:b], times[a:b]))
            yield pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int32()),
                                              pa.array(out["part"], pa.binary())],
                                             names=["block", "part"])

    def merge(rows: pa.Table) -> pa.Table:
        parts = [_unpack(b) for b in rows.column("part").to_pylist()]
        packed = _pack(*_merged(*[np.concatenate(x) for x in zip(*parts)]))
        return pa.table({"block": rows.column("block")[:1], "lists": pa.array([packed], pa.binary())})

    return stored(chunks.mapInArrow(count, "block int, part binary").groupBy("block")
                  .applyInArrow(merge, "block int, lists binary"), "brown-lists")


class ListedWords:
    """Units of words as an array beside their sorted hashes; the neighbour lists
    are written once, and a pass over them shuffles nothing."""

    def __init__(self, chunks: DataFrame, ids: np.ndarray, tokens_: int):
        self.ids, self.width = ids, list_width(len(ids), tokens_)
        self.lists = neighbour_lists(chunks, ids, self.width)

    def around(self, units: np.ndarray, size: int) -> tuple[np.ndarray, None]:
        spark, v, width = self.lists.sparkSession, len(self.ids), self.width
        shared = spark.sparkContext.broadcast(units)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size * size, np.int64)
            for batch in batches:
                for block, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    word, slot, n = _unpack(lists)
                    before = slot < v  # each bigram once: as its first word's entry
                    cell = shared.value[word[before] + block * width].astype(np.int64) * size \
                        + shared.value[slot[before]]
                    total += np.bincount(cell, n[before], size * size).astype(np.int64)
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"cell": at, "n": total[at]})

        cells = (self.lists.mapInArrow(add, "cell long, n long")
                 .groupBy("cell").agg(F.sum("n").alias("n")).toArrow())  # at most size^2 rows
        shared.unpersist()
        table = np.zeros(size * size)
        table[cells["cell"].to_numpy()] = cells["n"].to_numpy()
        return table.reshape(size, size), None

    def move(self, units: np.ndarray, near: None, table: np.ndarray, of: np.ndarray, share: int,
             turn: int) -> tuple[np.ndarray, bool]:
        spark, v, width = self.lists.sparkSession, len(self.ids), self.width
        shared = spark.sparkContext.broadcast((units, self.ids, table, of))

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            units, ids, table, of = shared.value
            size = len(of)
            for batch in batches:
                out: dict[str, list] = {"block": [], "units": []}
                for block, lists in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    first = block * width
                    word, slot, n = _unpack(lists)
                    mine = units[first:first + width]
                    after = slot >= v
                    by_unit = units[slot - v * after].astype(np.int64) + size * after
                    own = np.zeros(len(mine))
                    itself = slot == word + first
                    own[word[itself]] = n[itself]
                    best = chosen_units(table, of, ids[first:first + width], mine, own,
                                        np.bincount(word, minlength=len(mine)), by_unit, n, share, turn)
                    out["block"].append(block)
                    out["units"].append(best.astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out["block"], pa.int32()),
                                                  pa.array(out["units"], pa.binary())],
                                                 names=["block", "units"])

        got = self.lists.mapInArrow(choose, "block int, units binary").toArrow()  # 2 bytes a word
        shared.unpersist()
        moved = units.copy()
        for block, packed in zip(got["block"].to_pylist(), got["units"].to_pylist()):
            best = np.frombuffer(packed, "<u2")
            moved[block * width:block * width + len(best)] = best
        return moved, bool((moved != units).any())

    def classified(self, counts: DataFrame, units: np.ndarray, begin, of: np.ndarray) -> DataFrame:
        shared = counts.sparkSession.sparkContext.broadcast((self.ids, of[units].astype(np.int32)))

        def give(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            ids, classes = shared.value
            for batch in batches:
                batch["class"] = classes[np.searchsorted(ids, batch["id"].to_numpy())]
                batch["shape"] = next(begin(iter([batch])))["shape"]
                yield batch[["word", "id", "n", "class", "shape"]]
        return counts.mapInPandas(give, "word string, id long, n long, class int, shape int")


def exchange_words(words: JoinedWords | ListedWords, units, of: np.ndarray) -> tuple:
    """The units of every word, the classes of the units, the class bigrams, and the
    likelihood after each pass, from given units and classes.  Unit c stands for the
    words of class c that are no units of their own; the units after these are single
    words."""
    best, value, share, turn, values = None, -np.inf, 1, 0, []
    classes = int(of.max()) + 1
    while True:
        bigrams, near = words.around(units, len(of))
        now = exchange(bigrams, classes, start=of if best is None else best[1], fixed=classes)
        member = np.eye(classes)[now]
        table = member.T @ bigrams @ member
        reached = likelihood(table)
        values.append(reached)
        rise = reached - value
        if rise > 0:
            best, value = (units, now, table, near), reached
        if rise <= 0:
            share *= 2
        if share > 1 << HALVINGS or 0 <= rise < GAIN * abs(value):
            break
        units, any_moved = words.move(best[0], best[3], best[2], best[1], share, turn)
        turn += 1
        if not any_moved and share == 1:
            break
    return (*best[:3], values)


class BrownModel:
    """Classes of the units (shapes first, then one unit per class, which is that
    of its training words), log10 transitions and emission denominators."""

    def __init__(self, bigrams: np.ndarray, shapes: np.ndarray, types: np.ndarray,
                 amounts: np.ndarray):
        """shapes: classes of unseen words; types, amounts: distinct training words
        and training tokens per class."""
        self.of = np.concatenate([shapes, np.arange(len(bigrams))])
        moves = bigrams + TRANSITION
        self.transition = np.log10(moves / moves.sum(axis=1, keepdims=True))
        self.denominator = amounts + EMISSION * (types + 1)


class WordUnits:
    """Units of single words by the word table, to look into a model.  The first
    call reads the whole table; scoring joins it instead."""

    def __init__(self, words: DataFrame):
        self.words, self.found = words, None

    def of(self, word: bytes) -> int:
        if self.found is None:
            self.found = {r["word"].encode("utf-8"): r["class"]
                          for r in self.words.select("word", "class").collect()}
        c = self.found.get(word)
        return shape(word) if c is None else SHAPES + c


@dataclass
class LanguageModel:
    """A fitted model: the word table (word, n, class), its totals, the class model,
    and up to ``LISTED`` words their sorted hashes, counts and classes."""

    words: DataFrame
    tokens: int
    types: int
    units: WordUnits
    end: int
    classes: BrownModel
    #: the likelihood of the class bigrams after each pass over all words
    likelihoods: list[float]
    arrays: tuple[np.ndarray, ...] | None = None


def fit(training: DataFrame) -> LanguageModel:
    """From all rows of ``training`` (column text)."""
    return fit_chunks(tokenised(training.select(
        F.lit(None).cast("string").alias("id"), "text", F.lit(False).alias("held_out"))))


def fit_chunks(chunks: DataFrame) -> LanguageModel:
    """From the documents of the chunks that are not held out."""
    spark = chunks.sparkSession
    counts = stored(chunks.mapInArrow(_count_words, "word string, id long, n long")
                    .groupBy("word").agg(F.first("id").alias("id"), F.sum("n").alias("n")),
                    "brown-counts")
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(KNOWN).select("word").toArrow()  # bounded
    units = Units([w.encode("utf-8") for w in top["word"].to_pylist()[:UNITS]])
    of = exchange(count_bigrams(chunks, units))
    size = int(of.max()) + 1
    shared = spark.sparkContext.broadcast((units, of))

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        units, of = shared.value
        for batch in batches:
            at = np.array([units.of(w.encode("utf-8")) for w in batch["word"]], np.int64)
            yield pd.DataFrame({"id": batch["id"], "word": batch["word"], "shape": np.minimum(at, SHAPES),
                                "unit": np.where(at < SHAPES, of[at], at - SHAPES + size)})

    start = np.concatenate([np.arange(size), of[SHAPES:]])
    # words of equal hash are one
    begun = (counts.select("word", "id").mapInPandas(begin, "id long, word string, shape int, unit int")
             .groupBy("id").agg(F.max("unit").alias("unit")))
    if v <= LISTED:  # a bounded number of words: arrays
        held = begun.toArrow()
        ids, unit = held["id"].to_numpy(), held["unit"].to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, unit = ids[order], unit[order].astype(np.uint16)
        del held, order
        form = ListedWords(chunks, ids, n) if v else None
    else:
        unit = stored(begun, "brown-start")
        form = JoinedWords(chunks)
    if v:
        placed, of_unit, bigrams, values = exchange_words(form, unit, start)
    else:
        placed, of_unit, bigrams, values = unit, start, np.zeros((size, size)), []
    words = stored(form.classified(counts, placed, begin, of_unit), "brown-words") if v else \
        counts.select("*", F.lit(0).alias("class"), F.lit(0).alias("shape"))
    types, amounts = np.zeros(size), np.zeros(size)
    shapes, most = of[:SHAPES].copy(), np.zeros(SHAPES)
    for r in words.groupBy("class", "shape").agg(
            F.count(F.lit(1)).alias("types"), F.sum("n").alias("n")) \
            .orderBy("class", "shape").collect():  # at most classes * (SHAPES + 1) rows
        types[r["class"]] += r["types"]
        amounts[r["class"]] += r["n"]
        if r["shape"] < SHAPES and r["n"] > most[r["shape"]]:
            shapes[r["shape"]], most[r["shape"]] = r["class"], r["n"]
    end = int(of_unit[size])  # END is the first of the single words
    classes = BrownModel(bigrams, shapes, types, amounts)
    lm = LanguageModel(words.select("word", "n", "class"), n, v, WordUnits(words), end, classes, values)
    if v <= LISTED:
        rows = words.groupBy("id").agg(F.sum("n").alias("n"), F.min("class").alias("class")).toArrow()
        order = np.argsort(rows["id"].to_numpy(), kind="stable")
        lm.arrays = tuple(rows[c].to_numpy()[order].astype(t) for c, t in (
            ("id", np.int64), ("n", np.int64), ("class", np.int16)))
    return lm


def _sums(values: np.ndarray, c: Chunk) -> np.ndarray:
    """Per document (each has a token)."""
    return np.add.reduceat(values, c.starts())


_SCORED = "id string, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def log_probabilities(chunks: DataFrame, lm: LanguageModel) -> DataFrame:
    """(id, held_out, n_tokens, n_known, base_score, score) of every document."""
    return _score_by_arrays(chunks, lm) if lm.arrays is not None else _score_by_join(chunks, lm)


def _score_by_arrays(chunks: DataFrame, lm: LanguageModel) -> DataFrame:
    """Counts and classes of all training words go to the tasks (18 bytes a word, of
    at most ``LISTED``).  A word is looked up by its 64-bit hash."""
    shared = chunks.sparkSession.sparkContext.broadcast(
        (*lm.arrays, lm.classes, lm.end, lm.tokens + lm.types + 1))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, class_of, brown, end, below = shared.value
        for c in _chunks(batches):
            mine = c.hashes()
            at = np.searchsorted(ids, mine)
            n, of = np.zeros(len(mine), np.int64), np.zeros(len(mine), np.int64)
            found = np.zeros(len(mine), bool)
            if len(ids):
                at = np.minimum(at, len(ids) - 1)
                found = ids[at] == mine
                n[found], of[found] = counts[at[found]], class_of[at[found]]
            for i in np.flatnonzero(~found):
                of[i] = end if c.words[i] == END else brown.of[shape(c.words[i])]
            base = np.log10((n + 1) / below)
            emit = np.log10((n + EMISSION) / brown.denominator[of])
            classes = of[c.codes]
            moves = brown.transition[c.before(classes), classes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c.ids, pa.string()), pa.array(c.held), pa.array(c.sizes.astype(np.int64)),
                 pa.array(_sums((n > 0)[c.codes].astype(np.int64), c)), pa.array(_sums(base[c.codes], c)),
                 pa.array(_sums(moves + emit[c.codes], c))],
                names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return chunks.mapInArrow(local, _SCORED)


def _score_by_join(chunks: DataFrame, lm: LanguageModel) -> DataFrame:
    """The most frequent words' counts and classes (``KNOWN``) go to the tasks; other
    words are joined with the word table, and what hangs on their classes is summed
    when those are known."""
    spark = chunks.sparkSession
    top = lm.words.orderBy(F.desc("n"), "word").limit(KNOWN).toArrow()  # bounded
    code = {w.encode("utf-8"): i for i, w in enumerate(top["word"].to_pylist())}
    known = top["n"].to_numpy().astype(np.float64)
    known_class = top["class"].to_numpy().astype(np.int64)
    base = np.log10((known + 1) / (lm.tokens + lm.types + 1))
    emit = np.log10((known + EMISSION) / lm.classes.denominator[known_class])
    classes = len(lm.classes.transition)
    shared = spark.sparkContext.broadcast((code, known_class, lm.end, lm.classes, base, emit))

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        code, known_class, end, brown, base, emit = shared.value
        for c in _chunks(batches):
            place = np.fromiter((code.get(w, -1) for w in c.words), np.int64, len(c.words))
            out = []
            for name, held, start, size in zip(c.ids, c.held.tolist(), c.starts(), c.sizes):
                codes = c.codes[start:start + size]
                at = place[codes]
                here = at[at >= 0]
                # a word that is not known: number of classes + its number in the text
                rare, number, times = np.unique(codes[at < 0], return_inverse=True, return_counts=True)
                of = np.empty(size, np.int64)
                of[at >= 0] = known_class[here]
                of[at < 0] = classes + number
                words = [c.words[i] for i in rare]
                before = np.concatenate([of[-1:], of[:-1]])  # the end
                both = (of < classes) & (before < classes)
                moves = float(brown.transition[before[both], of[both]].sum())
                there = np.stack([before[~both], of[~both]]).astype(np.int32)
                out.append((name, held, int(size), len(here), float(base[here].sum()),
                            moves + float(emit[here].sum()), there.tobytes(),
                            [w.decode("utf-8") for w in words], times.tolist(),
                            [end if w == END else int(brown.of[shape(w)]) for w in words]))
            yield pd.DataFrame(out, columns=["id", "held_out", "n_tokens", "__known", "__base",
                                             "__score", "__moves", "__words", "__times", "__classes"])

    def as_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.string()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                            ("__known", pa.int64()), ("__base", pa.float64()), ("__score", pa.float64()),
                            ("__moves", pa.binary()), ("__words", pa.list_(pa.string())),
                            ("__times", pa.list_(pa.int64())), ("__classes", pa.list_(pa.int32()))])
        for frame in local(batches):
            yield pa.RecordBatch.from_pandas(frame, schema, preserve_index=False)

    partial = stored(chunks.mapInArrow(
        as_arrow, "id string, held_out boolean, n_tokens long, __known long, __base double, __score double, "
                  "__moves binary, __words array<string>, __times array<long>, __classes array<int>")
        .withColumn("__row", F.monotonically_increasing_id()), "brown-partial")
    rare = partial.select("__row", F.posexplode(F.arrays_zip("__words", "__times", "__classes"))
                          .alias("at", "r")).select("__row", "at", F.col("r.__words").alias("word"),
                                                    F.col("r.__times").alias("times"),
                                                    F.col("r.__classes").alias("unseen"))
    rare = rare.join(lm.words, "word", "left").select(
        "__row", "at", "times", F.coalesce("n", F.lit(0)).alias("c"),
        F.coalesce("class", "unseen").alias("class"))
    below = F.get(F.array(*[F.lit(float(x)) for x in lm.classes.denominator]), F.col("class"))
    c = F.col("c")
    found = rare.groupBy("__row").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("known2"),
        F.sum(F.col("times") * F.log10((c + 1) / F.lit(float(lm.tokens + lm.types + 1)))).alias("base2"),
        F.sum(F.col("times") * F.log10((c + EMISSION) / below)).alias("score2"),
        F.transform(F.array_sort(F.collect_list(F.struct("at", "class"))), lambda x: x["class"])
        .alias("classes2"))

    @F.pandas_udf("double")
    def moved(pairs: pd.Series, found: pd.Series) -> pd.Series:
        transition, first = shared.value[3].transition, np.arange(classes)
        out = np.zeros(len(pairs))
        for i, (packed, late) in enumerate(zip(pairs, found)):
            if packed:
                of = np.concatenate([first, late])
                before, at = of[np.frombuffer(packed, np.int32).reshape(2, -1)]
                out[i] = transition[before, at].sum()
        return pd.Series(out)
    whole = partial.drop("__words", "__times", "__classes").join(found, "__row", "left")

    def added(name):
        return F.col(f"__{name}") + F.coalesce(f"{name}2", F.lit(0))
    return whole.select("id", "held_out", "n_tokens", added("known").alias("n_known"),
                        added("base").alias("base_score"),
                        (added("score") + moved("__moves", "classes2")).alias("score"))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          modulus: int = HELD_OUT_MODULUS, remainder: int = HELD_OUT_REMAINDER) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity)
    of every row, learning from the rows that are not held out."""
    held = F.coalesce(crc_remainder(id_col, modulus) == remainder, F.lit(False))
    # the id as text: pandas would turn numbers with nulls into floats
    rows = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"),
                       held.alias("held_out"))
    chunks = tokenised(rows)
    lm = fit_chunks(chunks)
    return log_probabilities(chunks, lm).select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", "n_tokens",
        "n_known", F.lit(lm.tokens).cast("long").alias("train_tokens"),
        "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"))
