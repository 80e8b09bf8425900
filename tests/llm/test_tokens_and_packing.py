"""Chunked BPE and lexical packing against the tokenizer libraries."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import chunked_bpe, lexical_packing
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
ODD = " \n\t  a b é'sre ll\x1c\x85 　中日¼²٣1 2!?#́😀Ωß.,"


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return chunked_bpe.Encoder(chunked_bpe.read_ranks(open(RANKS, "rb").read()), P.PATTERN, cache_words=50)


def ids_of(data):
    return np.frombuffer(data, "<i4").tolist()


def test_encoder_against_library(encoder, library):
    r = random.Random(1)
    for _ in range(500):
        texts = ["".join(r.choice(ODD) for _ in range(r.randrange(30))) for _ in range(4)]
        assert [ids_of(x) for x in encoder.encode_many(texts)] == [library.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_encoder_any_text(encoder, library, text):
    assert ids_of(encoder.encode(text)) == library.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 500, "ab" * 300 + "c" * 200, "é" * 400, " " * 1000 + "x", "Zz" * 3000, "\n" * 99 + "a", ""])
def test_long_runs(encoder, library, text):
    assert ids_of(encoder.encode(text)) == library.encode_ordinary(text)


def test_chunks_nulls_and_repeats(spark, library):
    r = random.Random(4)
    rows = [(i, "".join(r.choice(ODD) for _ in range(r.randrange(900)))) for i in range(80)]
    rows += [(None, None), (5, ""), (7, "a" * 700), (7, "a" * 700), (None, "hello world " * 100), (None, "hello world " * 100),
             (3, " " * 400 + "x" * 100), (3, "\t\n" * 200 + "x")]
    df = spark.createDataFrame([(i, t, [1], "clash") for i, t in rows], "doc_id bigint, text string, ids array<int>, digest string").repartition(3)
    out = chunked_bpe.encode(df, RANKS, P.PATTERN, chunk_chars=100, overlap=30)
    want = sorted((repr((i, library.encode_ordinary(t or ""))) for i, t in rows))
    assert sorted(repr((x.doc_id, list(x.ids))) for x in out.collect()) == want
    back = chunked_bpe.decode(out, RANKS).collect()
    assert sorted(repr((x.doc_id, bytes(x.bytes).decode())) for x in back) == sorted(repr((i, t or "")) for i, t in rows)
    assert chunked_bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_decode_odd_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "doc_id bigint, ids array<int>")
    got = {x.doc_id: x.bytes for x in chunked_bpe.decode(df, RANKS).collect()}
    assert got[1] is None and got[2] == b"" and len(got[3]) > 0
    with pytest.raises(Exception, match="vocabulary"):
        chunked_bpe.decode(spark.createDataFrame([(1, [99_999])], "doc_id bigint, ids array<int>"), RANKS).collect()


def test_op1_on_whole_table(spark, library):
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op1_chunked_bpe"](spark, SF).collect()
    assert len(got) == len(docs)
    for x in got:
        ids = library.encode_ordinary(docs[x.doc_id])
        assert x.n_tokens == len(ids)
        assert x.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert x.decoded_sha256 == hashlib.sha256(docs[x.doc_id].encode()).hexdigest()


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(WORDS)


def check_pieces(rows, docs, window, encode):
    """Each id in one piece; sequences gapless; no padding at all."""
    by, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for x in rows:
        by[x.doc_id].append(x)
        sequences[x.sequence_id].append(x)
    for i, text in docs.items():
        ids, at = np.array([*encode(text), 1], "<u4"), 0
        for x in sorted(by[i], key=lambda x: x.start):
            assert x.start == at and x.doc_tokens == len(ids)
            assert zlib.crc32(ids[at:at + x.length].tobytes()) == (x.ids_crc32 if "ids_crc32" in x else zlib.crc32(bytes(x.token_ids)))
            at += x.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for x in sorted(parts, key=lambda x: x.offset):
            assert x.offset == at
            at += x.length
        assert at <= window and at & (at - 1) == 0
    return sequences


def test_op5_on_whole_table(spark, word_library):
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op5_lexical_packing"](spark, SF).collect()
    check_pieces(rows, docs, 2048, lambda t: word_library.encode(t, add_special_tokens=False).ids)


def test_packing_joins_neighbours(spark, word_library):
    r = random.Random(9)
    topics = [[f"{a}{b}" for a in ("ba", "ko", "ti", "mu") for b in s] for s in (("lor", "nim", "sat"), ("gex", "pud", "wiv"), ("zon", "fey", "jat"))]
    docs = {i: " ".join(r.choice(topics[i % 3]) for _ in range(20)) for i in range(60)}
    docs |= {100: "", 101: "word " * 500, 102: "a <|endoftext|> b<|startoftext|>"}
    rows = [(i, t, 5) for i, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, start int").coalesce(1)
    out = lexical_packing.pack(df, WORDS, window=256).collect()
    sequences = check_pieces(out, docs, 256, lambda t: word_library.encode(t, add_special_tokens=False).ids)
    pairs = [x.doc_id % 3 == x.seed_id % 3 for s in sequences.values() for x in s if x.doc_id != x.seed_id and x.doc_id < 60 and x.seed_id < 60]
    assert sum(pairs) > 0.6 * len(pairs)  # a third by chance


def test_packing_edge_rows(spark):
    df = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (1, None)], "doc_id bigint, text string")
    out = lexical_packing.pack(df, WORDS, window=8).collect()
    assert sum(x.length for x in out) == 3 + 3 + 1 + 1
    assert lexical_packing.pack(df.limit(0), WORDS).count() == 0
