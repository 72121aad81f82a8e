import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from boxoffice.llm import bpe, token_counts as tc
from boxoffice.llm.common import pick, vocabulary_path

RANKS = tc.read_ranks(vocabulary_path("byte_bpe_50k.tiktoken"))
PEER = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ENCODER = bpe.encoder(vocabulary_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
DECODER = bpe.Decoder(RANKS)
MATCHER = tc.matcher(vocabulary_path("byte_bpe_50k.tiktoken"))
TEXTS = [None, "", " ", "\n\n  \t x", "Hello world's 1234 tests!!!", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa",
         "naïve café 日本語 🙂🙂", "=" * 300 + " " * 300 + "\n" * 70, "x\x1cy\x85z w ", "<|endoftext|>",
         "".join(random.Random(3).choice("abcdefghij klmnop") for _ in range(20_000)), "ab" * 4000]


def greedy(word):
    data, n, longest = b" " + word, 0, max(map(len, RANKS))
    while data:
        size = next(k for k in range(min(longest, len(data)), 0, -1) if data[:k] in RANKS)
        data, n = data[size:], n + 1
    return n


@pytest.mark.parametrize("text", TEXTS)
def test_encoder_equals_the_library(text):
    assert ENCODER.encode(text).tolist() == PEER.encode_ordinary(text or "")


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_encoder_on_any_text(text):
    ids = ENCODER.encode(text).tolist()
    assert ids == PEER.encode_ordinary(text)
    assert DECODER.decode(np.array(ids, dtype=np.int32)) == text


@settings(max_examples=1000, deadline=None)
@given(st.text(alphabet="aé1. .  \n\t\u00a0\x1c'", max_size=30))
def test_encoder_on_white_space(text):
    assert ENCODER.encode(text).tolist() == PEER.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab nt", max_size=80))
def test_encoder_on_repetitive_text(text):
    assert ENCODER.encode(text).tolist() == PEER.encode_ordinary(text)


def test_alphabetic_words_are_one_piece():
    letters = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha())
    assert ENCODER.pieces(" " + letters) == [" " + letters]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED_EDGES", 50)
    monkeypatch.setattr(bpe, "REMEMBERED_PIECES", 3)
    monkeypatch.setattr(bpe, "REMEMBERED_WORDS", 2)
    monkeypatch.setattr(bpe, "EMIT_STEP", 5)
    own = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    for text in TEXTS:
        assert own.encode(text).tolist() == PEER.encode_ordinary(text or "")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aé1. .  \n\u00a0'bt", max_size=30) | st.sampled_from(TEXTS), max_size=8), st.integers(1, 60))
def test_texts_of_a_batch(texts, size):
    before, bpe.BATCH_BYTES = bpe.BATCH_BYTES, size
    ids, n = ENCODER.encode_texts(pa.array(["cut off", *texts], pa.string())[1:])
    bpe.BATCH_BYTES = before
    want = [PEER.encode_ordinary(t or "") for t in texts]
    assert n.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]


def test_words_of_a_batch_are_encoded_once_and_side_by_side(monkeypatch):
    own, rng = bpe.Encoder(RANKS, public_tokenizers.PATTERN), random.Random(5)
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 12))) + rng.choice(["", "", ",", ".\nX"]) for _ in range(300)]
    texts = [" ".join(["start", *rng.choices(words, k=400)]) for _ in range(50)]
    pieces, steps = [], []
    monkeypatch.setattr(own, "encode_pieces", lambda x, f=own.encode_pieces: pieces.extend(x) or f(x))
    monkeypatch.setattr(own.transducer, "follow", lambda at, f=own.transducer.follow: steps.append(len(at)) or f(at))
    ids, n = own.encode_texts(pa.array(texts))
    assert ids.tolist() == [i for t in texts for i in PEER.encode_ordinary(t)] and len(n) == 50
    assert len(pieces) < 1200 < 50 * 400 and len(steps) <= 32  # no more than the longest piece has bytes
    assert not own.transducer.edges


def test_edge_table():
    rng, table, want = np.random.default_rng(2), bpe.EdgeTable(8), {}
    for _ in range(30):
        at = np.unique(rng.integers(0, 1 << 30, 100) << 8 | rng.integers(0, 4, 100))
        new = at[table.get(at) < 0]
        assert set(new.tolist()) == set(at.tolist()) - want.keys()
        table.put(new, new >> 3)
        want |= {k: k >> 3 for k in new.tolist()}
    assert table.size == len(want) and table.get(np.array(list(want))).tolist() == list(want.values())
    assert (table.get(np.array([1 << 45, 7])) < 0).all()


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40), st.integers(1, 7))
def test_stream_decodes_like_one_call(data, step):
    stream = bpe.Utf8Stream()
    got = "".join(stream.feed(data[i:i + step]) for i in range(0, len(data), step)) + stream.close()
    assert got == data.decode("utf-8", "replace")


def test_encoding_report(spark, make, clash):
    df = clash(make(list(enumerate(TEXTS)) + [(None, "again"), (4, TEXTS[4])]))
    rows = bpe.encoding_report(bpe.encode_documents(pick(df, "doc_id", "text"))).collect()
    assert len(rows) == len(TEXTS) + 2
    for r in rows:
        text = ("again" if r.doc_id is None else TEXTS[r.doc_id]) or ""
        ids = PEER.encode_ordinary(text)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_documents(make([])).count() == 0
    odd = df.toDF(*df.columns[:-1], "IDS")
    assert bpe.encode_documents(odd).columns == [*df.columns[:-1], "IDS_in", "ids"]


def test_a_batch_is_encoded_once_for_its_ids_and_its_decoding(monkeypatch):
    own, runs = bpe.Encoder(RANKS, public_tokenizers.PATTERN), []
    monkeypatch.setattr(own, "encode_batch", lambda x, f=own.encode_batch: runs.append(len(x)) or f(x))
    for texts in (["a b", None, "c"], ["a b", None, "c"], ["a b", "", "c"], ["a b"], ["a b"], [], []):
        got = own.encode_array(pa.array(texts, pa.string())).to_pylist()
        assert got == [PEER.encode_ordinary(t or "") for t in texts]
    assert runs == [3, 3, 1]


def test_decoding_null_and_empty_arrays(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, ENCODER.encode("naïve").tolist())], "doc_id long, ids array<int>")
    got = {r.doc_id: r.text for r in df.select("doc_id", bpe.decoded_text(df.ids).alias("text")).collect()}
    assert got == {1: "", 2: "", 3: "naïve"}


def test_corpus_encodes_like_the_library(spark):
    from boxoffice.llm.queries import QUERIES
    from tests.conftest import SF_SMALL

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = QUERIES["op5_byte_bpe"](spark, SF_SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = PEER.encode_ordinary(texts[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


@pytest.mark.parametrize("text", TEXTS)
def test_counts_equal_greedy_pieces(text):
    words = (text or "").encode().split()
    assert MATCHER.of_text(text) == (len(words), sum(map(greedy, words)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=6), max_size=30), st.binary(max_size=30))
def test_counts_for_any_vocabulary(pieces, data):
    vocabulary = {bytes([b]) for b in range(256)} | set(pieces)
    rest, n = data, 0
    while rest:
        size = next(k for k in range(len(rest), 0, -1) if rest[:k] in vocabulary)
        rest, n = rest[size:], n + 1
    assert tc.LongestMatch(sorted(vocabulary)).count(data) == n


def test_token_counts_query(spark, make, clash):
    df = clash(make(list(enumerate(TEXTS)) + [(None, "two words")]))
    rows = tc.count_tokens(pick(df, "doc_id", "text")).collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        words = (("two words" if r.doc_id is None else TEXTS[r.doc_id]) or "").encode().split()
        assert (r.n_words, r.n_tokens) == (len(words), int(np.sum([greedy(w) for w in words])))
    assert tc.count_tokens(make([])).count() == 0
