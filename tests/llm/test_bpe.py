import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from starbi.llm import bpe
from llm.helpers import awkward_texts, ordered

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.parse_ranks(open(PATH, "rb").read())
TIKTOKEN = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
CODEC = bpe.Codec(RANKS, P.PATTERN)
CUT = bpe.Codec(RANKS, P.PATTERN, bpe.WORD_CUTS)
SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2003\u2028\u2029\u202f\u205f\u3000\u200b\ufeff"


@settings(max_examples=200, deadline=None)
@given(st.text())
def test_any_text_as_tiktoken_and_back(text):
    ids = CODEC.encode(text)
    assert ids == TIKTOKEN.encode_ordinary(text)
    assert "".join(CODEC.decode_stream(ids)) == text
    assert CUT.encode(text) == ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=SPACES + "'stremlvd1aZé½²日!_"))
def test_words_cut_at_white_space(text):
    assert CUT.encode(text) == TIKTOKEN.encode_ordinary(text)


def test_transducer_equals_rank_ordered_merging():
    rng, vocabulary = random.Random(2), list(RANKS)
    machine = bpe.MergeTransducer(RANKS, max_moves=2000)  # drops its table now and then
    for _ in range(1500):
        data = b"".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 6)))
        assert machine.encode(data) == machine.merged(data)


def test_pair_rule_equals_its_definition():
    rng, m = random.Random(3), CODEC.machine
    for _ in range(3000):
        a, b = rng.randrange(len(RANKS)), rng.randrange(len(RANKS))
        assert m._may_follow(a, b) == (m.merged(m.tokens[a] + m.tokens[b]) == [a, b])


@pytest.mark.parametrize("text", ["a" * 40_000, " " * 9_000, "=" * 5000 + "\n" * 900, "日" * 6000])
def test_long_runs_are_emitted_after_bounded_lookahead(text):
    assert CODEC.encode(text) == TIKTOKEN.encode_ordinary(text)


def test_small_memory_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_WORDS", 3)
    monkeypatch.setattr(bpe, "MAX_PAIRS", 5)
    small = bpe.Codec(RANKS, P.PATTERN, bpe.WORD_CUTS)
    for t in awkward_texts():
        assert small.encode(t) == TIKTOKEN.encode_ordinary(t or "")


def test_utf8_stream_at_every_cut():
    data = "aé日😀�".encode() + b"\xe6\x97\xff\xf0\x9f" + "z".encode()
    for size in range(1, 6):
        s = bpe.Utf8Stream()
        parts = [s.feed(data[i:i + size]) for i in range(0, len(data), size)] + [s.close()]
        assert "".join(parts) == data.decode("utf-8", errors="replace")


def expected(i, text):
    ids = TIKTOKEN.encode_ordinary(text or "")
    return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def test_query_rows_and_awkward_cases(docs, crowded, no_docs):
    want = ordered(expected(r.doc_id, r.text) for r in docs.collect())
    for d in (docs, crowded):
        assert ordered(bpe.round_trip_digests(d, PATH, P.PATTERN).collect()) == want
        cut = bpe.round_trip_digests(d, PATH, P.PATTERN, bpe.WORD_CUTS)
        assert ordered(cut.collect()) == want
    assert bpe.round_trip_digests(no_docs, PATH, P.PATTERN).count() == 0


def test_columns_encode_and_decode(spark, docs):
    t = bpe.Tokenizer(spark, PATH, P.PATTERN)
    rows = docs.select("text", t.encode(docs["text"]).alias("ids"))
    for r in rows.select("text", "ids", t.decode(rows["ids"]).alias("back")).collect():
        assert r.ids == TIKTOKEN.encode_ordinary(r.text or "")
        assert r.back == (r.text or "")


def test_encoded_rows(spark, docs, crowded, no_docs):
    t = bpe.Tokenizer(spark, PATH, P.PATTERN, bpe.WORD_CUTS)
    for d in (docs.select("doc_id", "source", "text"), crowded.select("doc_id", "e", "text")):
        got = t.encode_rows(d)
        assert got.columns[:2] == d.columns[:2] and "text" not in got.columns
        want = sorted(repr((expected(r.doc_id, r.text), TIKTOKEN.encode_ordinary(r.text or "")))
                      for r in d.collect())
        assert sorted(repr(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256), r.ids))
                      for r in got.collect()) == want
    assert t.encode_rows(no_docs).count() == 0


def test_large_ids_stay_exact(spark):
    """Beside a null, and beyond what a float holds."""
    from starbi.llm import brown, ctph
    docs = spark.createDataFrame([(2**60 + 1, "a b"), (None, "c"), (2**60 + 3, None)],
                                 "doc_id long, text string").coalesce(1)
    t = bpe.Tokenizer(spark, PATH, P.PATTERN)
    for rows in (t.encode_rows(docs), ctph.against_next(docs), brown.score(docs)):
        assert {r.doc_id for r in rows.collect()} == {2**60 + 1, None, 2**60 + 3}
