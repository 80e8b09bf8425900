"""Directly addressable token files against the tokenizer library."""

import random
import tempfile
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import addressable_codes, word_tokens
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
WORDS = P.path("word_bpe_49k.json")
ALPHABET = [*" \n\t a b é'sre ll\x1c\x85 　中日¼²٣1 2!?#́😀Ωß.,", *"ΣΟİẞ.,'t", "<|endoftext|>", "Å", "The", "can't", "..",
            "Ab.", "b,", "x" * 70, "$" * 66, "\x00", "\x7f", "12a", "a\rb", "ab!!", "éenê***"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


@pytest.mark.parametrize("as_text", [False, True])
def test_word_tokens_against_library(as_text):
    library = Tokenizer.from_file(WORDS)
    library.encode_special_tokens = as_text
    coder = word_tokens.WordTokens(open(WORDS, "rb").read(), special_as_text=as_text)
    r = random.Random(1)
    for _ in range(400):
        texts = ["".join(r.choice(ALPHABET) for _ in range(r.randrange(40))) for _ in range(4)]
        got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts, b"\x07\0\0\0")]
        assert got == [[*e.ids, 7] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert coder.encode([], b"") == [] and coder.encode([None, ""], b"") == [b"", b""]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=4))
def test_word_tokens_any_text(library, texts):
    coder = word_tokens.word_tokens(open(WORDS, "rb").read())
    got = [np.frombuffer(x, "<u4").tolist() for x in coder.encode(texts)]
    assert got == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=2000), st.randoms())
def test_levels(ids, r):
    held = addressable_codes.Levels(*addressable_codes.encode_levels(np.array(ids, np.uint32)))
    at = [r.randrange(len(ids)) for _ in range(50)]
    assert held.get(at).tolist() == [ids[k] for k in at]
    a, z = sorted((r.randrange(len(ids) + 1), r.randrange(len(ids) + 1)))
    assert held.slice(a, z).tolist() == ids[a:z]


def test_files_of_odd_rows(spark, library):
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(ALPHABET) for _ in range(r.randrange(60)))) for i in range(-20, 60)]
    rows += [(None, None), (None, "b"), (5, ""), (7, "word " * 5000), (9, "twin"), (9, "twin"), (2**62, "far")]
    df = spark.createDataFrame([(i, t, [1], 3) for i, t in rows], "doc_id bigint, text string, ids array<int>, shard int").repartition(5)
    path = tempfile.mkdtemp() + "/files"
    addressable_codes.write(df, path, WORDS, end_id=2, segment_ids=700)
    got = addressable_codes.read(spark, path).collect()
    encode = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 2]
    ids_of = lambda x: np.frombuffer(bytes(x.ids), "<u4").tolist()
    assert sorted(repr((x.doc_id, ids_of(x))) for x in got) == sorted(repr((i, encode(t))) for i, t in rows)
    got.sort(key=lambda x: x.start)
    assert [x.doc_id for x in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    flat = []
    for x in got:
        assert x.start == len(flat)
        flat += ids_of(x)
    ask = [r.randrange(-5, len(flat) + 5) for _ in range(500)] + [None, 0, len(flat) - 1, len(flat)]
    asked = spark.createDataFrame([(p,) for p in ask], "position bigint")
    found = {x.position: x.token_id for x in addressable_codes.access(spark, path, asked).collect()}
    assert found == {p: flat[p] for p in ask if p is not None and 0 <= p < len(flat)}


def test_empty_table(spark):
    path = tempfile.mkdtemp() + "/files"
    addressable_codes.write(spark.createDataFrame([], "doc_id int, text string"), path, WORDS)
    assert addressable_codes.read(spark, path).count() == 0
    assert addressable_codes.access(spark, path, spark.range(3).select("id"), "id").count() == 0


def test_op12_on_whole_table(spark, library):
    docs = sorted((d.doc_id, d.text or "") for d in spark.read.parquet(f"{SF}/documents.parquet").collect())
    got = {x.doc_id: x for x in QUERIES["op12_addressable_codes"](spark, SF).collect()}
    assert len(got) == len(docs)
    at = 0
    for i, text in docs:
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)
