"""Periodic runs against a direct search for every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import periodic_runs
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def direct(words, least=12):
    """All runs, period by period."""
    found = {}
    n = len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def rows_of(words):
    return sorted((int(a), int(b), int(c)) for a, b, c in periodic_runs.find_runs(np.array(words, np.int64), np.zeros(len(words), np.int64)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 1), max_size=90))
def test_binary_words(words):
    assert rows_of(words) == [(s, n, q) for s, n, q in direct(words)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=14), st.integers(1, 7)), max_size=8))
def test_joined_powers(parts):
    words = [w for block, times in parts for w in block * times][:260]
    assert rows_of(words) == direct(words)


def test_every_short_binary_block():
    for size in range(1, 10):
        for code in range(1 << size):
            block = [code >> k & 1 for k in range(size)]
            for tail in (0, 1, size - 1):
                words = [1, *(block * (2 + 12 // size)), *block[:tail], 0]
                assert rows_of(words) == direct(words)


def test_nested_and_long():
    fib = [0]
    prev = [1]
    while len(fib) < 400:
        prev, fib = fib, fib + prev
    assert rows_of(fib) == direct(fib)
    r = random.Random(2)
    for _ in range(40):
        block = [r.randrange(4) for _ in range(r.randrange(1, 60))]
        words = [r.randrange(4) for _ in range(r.randrange(50))]
        words += block * r.randrange(2, 6) + block[:r.randrange(len(block))] + [r.randrange(4) for _ in range(r.randrange(50))]
        words[r.randrange(len(words))] = 9
        assert rows_of(words) == direct(words)


def test_many_documents_at_once():
    r = random.Random(5)
    docs = [[r.randrange(2) for _ in range(r.randrange(40))] for _ in range(50)] + [[0] * 30, [0] * 30]
    flat = np.array([w for d in docs for w in d])
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    starts = np.cumsum([0, *map(len, docs)])
    got = sorted(map(tuple, periodic_runs.find_runs(flat, of).tolist()))
    assert got == sorted((s + starts[k], n, q) for k, d in enumerate(docs) for s, n, q in direct(d))


def test_edge_rows(spark):
    loop = "a b c " * 5
    rows = [(None, None), (1, ""), (1, " \t\n "), (2, loop), (2, loop), (None, loop + " x\x0by\x1cz"), (3, "w " * 20_000)]
    df = spark.createDataFrame([(i, t, [0], "clash") for i, t in rows], "doc_id bigint, text string, runs array<int>, collapsed string")
    got = {(x.doc_id, x.n_words, x.collapsed, tuple(map(tuple, x.runs))) for x in periodic_runs.runs(df).collect()}
    assert got == {(None, 0, "", ()), (1, 0, "", ()), (2, 15, "a b c", ((0, 15, 3),)), (None, 17, "a b c x y\x1cz", ((0, 15, 3),)),
                   (3, 20_000, "w", ((0, 20_000, 1),))}
    assert periodic_runs.runs(df).count() == len(rows)
    assert periodic_runs.runs(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.runs(df, least=5)


def test_op11_on_whole_table(spark):
    docs = {d.doc_id: d.text or "" for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {x.doc_id: x for x in QUERIES["op11_periodic_runs"](spark, SF).collect()}
    assert got.keys() == docs.keys()
    for i, text in docs.items():
        words = [w.decode() for w in text.encode().split()]
        n, h = len(words), zlib.crc32(str(i).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (k - a) % p] for k in range(a, n)]
        runs = direct(words) if n < 1500 else rows_of([hash(w) % 2**31 for w in words])
        x = got[i]
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert x.n_runs == len(runs)
        assert x.runs_sha256 == sha("".join(f"{s},{m},{q}\n" for s, m, q in sorted(runs, key=lambda r: (r[0], r[2]))))
        assert x.collapsed_sha256 == sha(" ".join(collapsed(words, runs)))
        best = min(((-m, s, q) for s, m, q in runs), default=None)
        want = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
        assert (x.start, x.length, x.period, x.exponent_milli) == want
