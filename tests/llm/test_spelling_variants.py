"""Spelling variants against a direct search for words one edit apart."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quarry.llm import spelling_variants
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def direct(counts):
    """word -> (n, n_near, form, form_n, root), by keys with one place open."""
    groups = defaultdict(set)
    for w in counts:
        groups[w].add(w)
        for k in range(len(w)):
            groups[w[:k] + w[k + 1:]].add(w)  # any two words at one edit share such a key
    near = defaultdict(set)
    for some in groups.values():
        for a in some:
            near[a] |= {b for b in some if one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (n, len(near[w]), form[w], form[w] and counts[form[w]], root(w)) for w, n in counts.items()}


def told(df):
    rows = df.collect()
    out = {x.word: (x.n, x.n_near, x.form, x.form_n, x.root) for x in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("filter_bytes", [32 << 20, 600, 64])
def test_random_words(spark, filter_bytes):
    r = random.Random(filter_bytes)
    words = {"".join(r.choice("abcéß") for _ in range(r.randrange(1, 8))) for _ in range(900)}
    words |= {"a" * 70, "a" * 71, "a" * 69 + "b", "a" * 64, "a" * 65, "a" * 66, "b" + "a" * 70, "ÿ", "À", "日本", "日木", "日"}
    counts = {w: r.choice([3, 3, 5, 6, 12, 30, 61, 200]) for w in words}
    df = spark.createDataFrame([(w, n, "clash") for w, n in counts.items()], "word string, n int, root string").repartition(3)
    assert told(spelling_variants.group(df, filter_bytes=filter_bytes)) == direct(counts)


def test_passes():
    plans = spelling_variants.passes_of({5: 1000, 6: 10, 7: 3000, 65: 1}, 3000)
    seen = Counter((n, p) for plan in plans for n, (parts, _, mine) in plan.items() for p in mine)
    assert set(seen.values()) == {1} and len(plans) == 6
    assert all(sum(blocks * 8 * len(mine) for _, blocks, mine in plan.values()) <= 3008 for plan in plans)
    assert sorted(seen) == [(5, 0), (6, 0), (7, 0), (7, 1), (7, 2), (65, 0)]


def test_edited_hashes():
    group = ["abcde", "aabbb", "zéçdz"]
    words = spelling_variants.Letters(group)
    whole = lambda w: spelling_variants.Letters([w]).whole[0]
    row, place, h = words.deletions()
    assert [(r, w) for r, w in zip(row, h)] == [(r, whole(group[r][:p] + group[r][p + 1:])) for r, p in zip(row, place)]
    letters = np.array([ord(c) for c in "abcdezéç"], np.uint32)
    for p in range(5):
        row, to, h = words.replacements(p, letters)
        assert h.tolist() == [whole(group[r][:p] + chr(letters[t]) + group[r][p + 1:]) for r, t in zip(row, to)]


def test_edge_rows(spark):
    rows = [(None, None), (1, ""), (2, "Apples apples APPLES"), (None, "apples applés Ápples Ápples Ápples ápples"), (2, "1234 ab--cd"), (3, "apple" * 3 + "× apple,apple'apple")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n int")
    vocab = spelling_variants.vocabulary(spelling_variants.occurrences(df))
    assert {(x.word, x.n) for x in vocab.collect()} == {("apples", 4), ("Ápples", 3), ("apple", 3)}  # ×, ÷ and À to ÿ are letters here
    assert told(spelling_variants.group(vocab)) == direct({"apples": 4, "Ápples": 3, "apple": 3})
    assert spelling_variants.group(vocab.limit(0)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants.group(vocab, factor=1)


def test_long_chain(spark):
    """Counts that double along a chain of edits lead to one root."""
    letters = "abcdefghijklmnop"
    counts = {letters[:k] + "z" * (16 - k): 3 * 2 ** k for k in range(17)}
    df = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    got = told(spelling_variants.group(df))
    assert got == direct(counts) and {x[4] for x in got.values()} == {letters}


def test_op13_on_whole_table(spark):
    counts = Counter()
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", d.text or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{d.doc_id}:{w}".encode())
            if h % 97 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    got = told(QUERIES["op13_spelling_variants"](spark, SF))
    assert got == direct(counts) and any(x[2] for x in got.values())
