"""Byte-level BPE encoding and decoding.

Encoding.  ``MergeTransducer`` turns a rank file into a finite-state
transducer that reads one byte at a time and emits tokens.  The nondeterministic
machine keeps every boundary at which the current token may have begun; two
tokens may stand side by side exactly if encoding their joined bytes gives the
two tokens back, and this local rule fixes one last token for every prefix of
the input.  The subset construction is done lazily: a deterministic state is
the set of live boundaries with the last token before each, and a
transition is computed when it is first taken.  Tokens common to all chains
are emitted at once, so the lookahead never passes the longest vocabulary
entry that may still end.  The table of states is bounded; a full table is
dropped and grows again, which changes no result.

Decoding.  Token bytes are joined in blocks of ids and passed through
``Utf8Stream``, which holds back an unfinished character at the end of a
block and gives it out once its bytes have come.

Cases: a null text is encoded as the empty text (no ids; digest of the empty
string); texts of any length are encoded whole; repeated rows give repeated
results; an empty table gives an empty table; only the id and text columns are
read, so further columns cannot clash; a null id is passed through.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from starbi.llm.common import workers_see_package

#: bounds of what one Python worker keeps; they change speed only
MAX_MOVES = 1_000_000
MAX_PAIRS = 300_000
MAX_WORDS = 250_000
#: the same where rows leave with their ids, in workers that other stages share
ROW_MOVES = 250_000
ROW_WORDS = 40_000
MEMO_CHARS = 48
SLICE_ROWS = 128
#: Places where a text may be cut before the pre-tokenizer pattern is applied,
#: for patterns of public_tokenizers.PATTERN's shape: white space before a word
#: keeps its last space for the word, and no match holds white space elsewhere.
#: (White space is the Unicode property; ``re`` alone would add U+001C..U+001F.)
WORD_CUTS = (r" ?[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+(?![\S\x1c-\x1f])|[^\S\x1c-\x1f]+")
DECODE_BLOCK = 1 << 16
TOKEN_BITS = 22
LIVE = -1


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """Lines ``base64(token) rank`` to a dictionary."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class MergeTransducer:
    """Lazily determinised transducer for one rank table (see the module text).

    The vocabulary is a trie.  A state is the tuple of live boundaries, the
    farthest first: (trie node of the bytes read since the boundary, last token
    before it).  The nearest boundary is the position just reached, so a state's
    last entry is the one token that ends there, and a transition need only
    yield the next state.
    """

    def __init__(self, ranks: dict[bytes, int], max_moves: int = MAX_MOVES):
        if max(ranks.values(), default=0) >= (1 << TOKEN_BITS):
            raise ValueError("ranks of more than 22 bits")
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.width = [len(self.tokens.get(i, b"")) for i in range(max(ranks.values(), default=-1) + 1)]
        self.max_moves = max_moves
        self._child: dict[int, int] = {}  # node * 256 + byte -> node
        self._token, self._depth, self._inner = [-1], [0], [True]
        for data, token in ranks.items():
            node = 0
            for byte in data:
                self._inner[node] = True
                step = node << 8 | byte
                node = self._child.get(step, -1)
                if node < 0:
                    node = self._child[step] = len(self._token)
                    self._token.append(-1)
                    self._depth.append(self._depth[step >> 8] + 1)
                    self._inner.append(False)
            self._token[node] = token
        # after every so many bytes, what all live boundaries share is emitted
        self.lookahead = 4 * max(self.width, default=1)
        self._pairs: dict[int, bool] = {}
        self._split: dict[int, tuple[int, ...] | None] = {}
        self._reset()

    def _reset(self) -> None:
        # A state is the dictionary of its transitions: byte -> next state;
        # under LIVE it holds its tuple of live boundaries.
        self._start = {LIVE: (0, -1)}
        self._states = {(0, -1): self._start}
        self._count = 0  # transitions

    def merged(self, data: bytes, below: int = 1 << 60) -> list[int]:
        """Rank-ordered merging of a short byte string by the merges that rank
        ``below`` a limit: the definition that the pair rule is compiled from."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(a + b, 1 << 60), i)
                          for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank >= below:
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, ...] | None:
        """The two tokens that the last merge of ``token`` joined."""
        if token not in self._split:
            data = self.tokens[token]
            self._split[token] = tuple(self.merged(data, below=token)) if len(data) > 1 else None
        return self._split[token]

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether ``right`` may stand after ``left`` (-1: at the start).

        Going back in time from the finished pair, the fragments that touch at
        the boundary are undone in descending rank.  The pair falls if, while
        two fragments touch, their join ranks before the merge that ends one of
        them; of equal ranks the leftmost merge comes first.
        """
        if left < 0:
            return self.merged(self.tokens[right]) == [right]
        x, y, until = left, right, 1 << 60
        while True:
            if self.ranks.get(self.tokens[x] + self.tokens[y], 1 << 60) < until:
                return False
            a, b = self._halves(x), self._halves(y)
            if a is None and b is None:
                return True
            if b is None or a is not None and x > y:
                until, x = x, a[1]
            else:
                until, y = y + 1, b[0]

    def _move(self, state: dict, byte: int) -> dict:
        """The transition of ``state`` on ``byte``: live boundaries whose bytes
        still begin a token stay, and the token that ends here opens a new one."""
        live, key, ending = state[LIVE], [], -1
        for k in range(0, len(live), 2):
            node = self._child.get(live[k] << 8 | byte, -1)
            if node < 0:
                continue
            token = self._token[node]
            if ending < 0 <= token:
                pair = live[k + 1] << TOKEN_BITS | token
                ok = self._pairs.get(pair)
                if ok is None:
                    if len(self._pairs) >= MAX_PAIRS:
                        self._pairs.clear()
                    ok = self._pairs[pair] = self._may_follow(live[k + 1], token)
                if ok:
                    ending = token
            if self._inner[node]:
                key += node, live[k + 1]
        if ending < 0:
            raise ValueError(f"no token ends at byte {byte:#x}: the vocabulary lacks a byte")
        key += 0, ending
        key = tuple(key)
        following = self._states.get(key)
        if following is None:
            following = self._states[key] = {LIVE: key}
        state[byte] = following
        self._count += 1
        return following

    def _chain(self, ends: list[dict], at: int) -> list[int]:
        """Tokens that lead to position ``at``, from the state after each prefix."""
        out, width = [], self.width
        while at:
            token = ends[at - 1][LIVE][-1]
            out.append(token)
            at -= width[token]
        out.reverse()
        return out

    def _decided(self, ends: list[dict], state: dict) -> list[int]:
        """The tokens that the chains to all live boundaries share."""
        chains = [self._chain(ends, len(ends) - self._depth[node]) for node in state[LIVE][::2]]
        shared = 0
        while shared < min(map(len, chains)) and len({c[shared] for c in chains}) == 1:
            shared += 1
        return chains[0][:shared]

    def encode(self, data: bytes) -> list[int]:
        """The ids of one pre-token, read byte by byte."""
        if self._count > self.max_moves:
            self._reset()
        out: list[int] = []
        ends: list[dict] = []
        state, move, put = self._start, self._move, ends.append
        for i in range(0, len(data), self.lookahead):
            for byte in data[i:i + self.lookahead]:
                state = state.get(byte) or move(state, byte)
                put(state)
            if i + self.lookahead < len(data):
                tokens = self._decided(ends, state)
                out += tokens
                del ends[:sum(self.width[t] for t in tokens)]
        return out + self._chain(ends, len(ends)) if out else self._chain(ends, len(ends))


class Utf8Stream:
    """Incremental UTF-8 decoding: the state is the unfinished character at
    the end of what has come so far (0 to 3 bytes).  Malformed bytes become
    U+FFFD, as in decoding everything at once."""

    def __init__(self):
        self.state = b""

    @staticmethod
    def _unfinished(data: bytes) -> int:
        """Length of the character at the end of ``data`` that lacks bytes."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte < 0x80:
                return 0
            if byte >= 0xC0:
                need = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> str:
        data = self.state + data
        cut = len(data) - self._unfinished(data)
        self.state = data[cut:]
        return data[:cut].decode("utf-8", errors="replace")

    def close(self) -> str:
        rest, self.state = self.state, b""
        return rest.decode("utf-8", errors="replace")


class Codec:
    """Pre-tokenizer pattern + transducer + decoder.  ``cuts``: a pattern of
    ``re`` whose matches the pre-tokenizer pattern may be applied to one by one
    (``WORD_CUTS``); without it, it is applied to whole texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cuts: str | None = None):
        self.machine = MergeTransducer(ranks)
        self._pieces = regex.compile(pattern).findall
        self._find = re.compile(cuts).findall if cuts else self._pieces
        self._cut = bool(cuts)
        size = max(ranks.values(), default=-1) + 1
        self._bytes = [self.machine.tokens.get(i, b"") for i in range(size)]
        self._decimal = [str(i) for i in range(size)]
        # ids of words seen lately, in two generations: a full one ages, and
        # words that come again move to the young one
        self.max_words: int | None = None
        self._memo: dict[str, tuple[int, ...]] = {}
        self._aged: dict[str, tuple[int, ...]] = {}

    def _piece(self, piece: str) -> tuple[int, ...]:
        ids = self._memo.get(piece) or self._aged.get(piece) \
            or tuple(self.machine.encode(piece.encode("utf-8")))
        if len(piece) <= MEMO_CHARS:
            self._memo[piece] = ids
        return ids

    def _word(self, word: str) -> tuple[int, ...]:
        ids = self._aged.get(word)
        if ids is None:
            pieces = self._pieces(word) if self._cut else (word,)
            if len(pieces) == 1:
                return self._piece(word)
            ids = tuple(chain.from_iterable(map(self._piece, pieces)))
        if len(word) <= MEMO_CHARS:
            self._memo[word] = ids
        return ids

    def encode(self, text: str | None) -> list[int]:
        if len(self._memo) >= (self.max_words or MAX_WORDS):
            self._memo, self._aged = {}, self._memo
        known, word = self._memo.get, self._word
        out: list[int] = []
        for w in self._find(text or ""):
            out += known(w) or word(w)
        return out

    def decode_stream(self, ids):
        """Text of a sequence of ids, block by block."""
        stream, token = Utf8Stream(), self._bytes.__getitem__
        for i in range(0, len(ids), DECODE_BLOCK):
            yield stream.feed(b"".join(map(token, ids[i:i + DECODE_BLOCK])))
        yield stream.close()

    def digests(self, ids: list[int]) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the comma-joined ids and of the decoded bytes."""
        listed, decoded, decimal = hashlib.sha256(), hashlib.sha256(), self._decimal.__getitem__
        for i in range(0, len(ids), DECODE_BLOCK):
            listed.update(("," if i else "").encode()
                          + ",".join(map(decimal, ids[i:i + DECODE_BLOCK])).encode())
        for piece in self.decode_stream(ids):
            decoded.update(piece.encode("utf-8"))
        return len(ids), listed.hexdigest(), decoded.hexdigest()


_CODECS: dict[tuple, Codec] = {}


def _codec(data: bytes, *patterns) -> Codec:
    """One codec per Python worker and vocabulary; kept for later batches."""
    key = (hashlib.sha1(data).hexdigest(), *patterns)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(parse_ranks(data), *patterns)
    return _CODECS[key]


class Tokenizer:
    """Column functions for a vocabulary file.  The file (under a megabyte,
    checked) is read on the driver and sent to the workers once."""

    MAX_FILE = 64 << 20

    def __init__(self, spark: SparkSession, path: str, pattern: str, cuts: str | None = None):
        workers_see_package(spark)
        with open(path, "rb") as f:
            data = f.read(self.MAX_FILE + 1)
        if len(data) > self.MAX_FILE:
            raise ValueError(f"{path}: a vocabulary of more than {self.MAX_FILE} bytes")
        self.patterns, self.data = (pattern, cuts), spark.sparkContext.broadcast(data)

    def encode(self, text: Column) -> Column:
        """array<int>: the ids of a text column."""
        data, patterns = self.data, self.patterns

        @F.pandas_udf("array<int>")
        def ids(texts: pd.Series) -> pd.Series:
            codec = _codec(data.value, *patterns)
            return pd.Series([codec.encode(t) for t in texts], dtype=object)
        return ids(text)

    def decode(self, ids: Column) -> Column:
        """string: the text of an id column (null: null)."""
        data, patterns = self.data, self.patterns

        @F.pandas_udf("string")
        def text(rows: pd.Series) -> pd.Series:
            codec = _codec(data.value, *patterns)
            return pd.Series([None if r is None else "".join(codec.decode_stream(list(r)))
                              for r in rows], dtype=object)
        return text(ids)

    def round_trip(self, text: Column) -> Column:
        """struct: number of ids, SHA-256 of the comma-joined ids, SHA-256 of
        the bytes that decoding the ids gives."""
        data, patterns = self.data, self.patterns

        @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
        def digests(texts: pd.Series) -> pd.DataFrame:
            codec = _codec(data.value, *patterns)
            return pd.DataFrame([codec.digests(codec.encode(t)) for t in texts],
                                columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        return digests(text)

    def encode_rows(self, rows: DataFrame, text_col: str = "text") -> DataFrame:
        """The columns of ``rows`` but the text, and ids, n_tokens, ids_sha256,
        decoded_sha256.  A few rows' ids at a time leave the worker, so it never
        holds those of a whole batch."""
        data, patterns = self.data, self.patterns
        keep = [c for c in rows.columns if c != text_col]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            codec = _codec(data.value, *patterns)
            codec.max_words, codec.machine.max_moves = ROW_WORDS, ROW_MOVES
            for batch in batches:
                for i in range(0, len(batch), SLICE_ROWS):
                    part = batch.slice(i, SLICE_ROWS)
                    ids, digests = [], []
                    for text in part[text_col]:
                        found = codec.encode(text.as_py())
                        ids.append(np.array(found, np.int32))
                        digests.append(codec.digests(found))
                    n, listed, decoded = zip(*digests)
                    yield pa.RecordBatch.from_arrays(
                        [*(part[c] for c in keep), pa.array(ids, pa.list_(pa.int32())),
                         pa.array(n, pa.int64()), pa.array(listed), pa.array(decoded)],
                        [*keep, "ids", "n_tokens", "ids_sha256", "decoded_sha256"])
        schema = rows.select(*keep).schema.add("ids", ArrayType(IntegerType())).add("n_tokens", "long") \
            .add("ids_sha256", "string").add("decoded_sha256", "string")
        return rows.mapInArrow(run, schema)


def round_trip_digests(docs: DataFrame, path: str, pattern: str, cuts: str | None = None,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row: one pass, no shuffle."""
    tokenizer = Tokenizer(docs.sparkSession, path, pattern, cuts)
    row = docs.select(F.col(id_col), tokenizer.round_trip(F.col(text_col)).alias("_r"))
    return row.select(id_col, "_r.n_tokens", "_r.ids_sha256", "_r.decoded_sha256")
