"""Order MinHash, components and sentence spans against brute force."""

import collections
import functools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import order_minhash, sentence_spans
from quarry.llm.components import components
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance_in_a_band():
    r = random.Random(2)
    for _ in range(1500):
        a = [r.randrange(4) for _ in range(r.randrange(14))]
        b = list(a) if r.random() < 0.6 else [r.randrange(4) for _ in range(r.randrange(14))]
        for _ in range(r.randrange(4)):
            b.insert(r.randrange(len(b) + 1), 9) if r.random() < 0.5 or not b else b.pop(r.randrange(len(b)))
        d = levenshtein(a, b)
        for most in (0, 1, 2, 5, 20):
            got = order_minhash.edit_distance(a, b, most)
            assert got == d if d <= most else got > most


def test_sketch_is_sensitive_to_order_and_repeats():
    s = order_minhash.Sketcher()
    a, b = [f"a{i}" for i in range(150)], [f"b{i}" for i in range(150)]
    # the same shingles in another order: a set sketch would hardly change
    k, of = len(s.seeds), lambda words: s.sketch(words)[0]
    assert (of(a + b) == of(b + a)).sum() < 20 < k
    assert (of(a) == of(a)).all() and not (of(a) == of(b)).any()
    once = [f"w{i}" for i in range(60)]
    assert not (of(once) == of(once * 4)).all()
    assert [len(x) for x in s.sketch(["a"])] == [k, order_minhash.BINS // 8] and [len(x) for x in s.sketch([])] == [0, 0]
    short = order_minhash.SHORT
    assert [len(of(a[:n])) // k for n in (short - 1, short, short * 5 // 4, short * 5 // 4 + 1)] == [1, 2, 2, 1]


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_components(spark, shape):
    r = random.Random(3)
    links = {"path": [(i, i + 1) for i in range(40)], "star": [(0, i) for i in range(1, 400)],
             "random": [(r.randrange(200), r.randrange(200)) for _ in range(120)]}[shape]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {x.node: x.label for x in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for x in got} and set(got) == {x for p in links for x in p}


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_classes(docs, similarity=0.8):
    """All pairs whose words align, joined; the least id names a class."""
    words = {i: order_minhash.words_of(t or "") for i, t in docs.items()}
    label = {i: i for i in docs}
    ids = sorted(docs)
    for x in range(len(ids)):
        for y in range(x + 1, len(ids)):
            a, b = words[ids[x]], words[ids[y]]
            if a == b or (a and b and order_minhash.alike(a, b, similarity)):
                low, high = sorted((label[ids[x]], label[ids[y]]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def test_classes_against_all_pairs(spark):
    r = random.Random(7)
    vocabulary = [f"w{i}" for i in range(3000)]
    docs, base = {}, {}
    for i in range(0, 240, 4):  # a text, a copy in other signs, a near copy and another text
        t = [r.choice(vocabulary) for _ in range(r.randrange(30, 200))]
        near = list(t)
        for _ in range(max(1, len(t) // 25)):
            near[r.randrange(len(near))] = "changed"
        docs |= {i: " ".join(t), i + 1: "  ".join(t).upper() + "!", i + 2: " ".join(near),
                 i + 3: " ".join(r.choice(vocabulary) for _ in range(60))}
    docs |= {900: "", 901: None, 902: "one two", 903: "One two.", 904: "...", 905: "x" * 100_000}
    rows = [(i, t, "clash", 1) for i, t in docs.items()]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, node string, class_id int").repartition(5)
    got = {x.doc_id: x for x in order_minhash.classes(df).collect()}
    assert {i: x.class_id for i, x in got.items()} == brute_classes(docs)
    sizes = collections.Counter(x.class_id for x in got.values())
    assert all(x.class_size == sizes[x.class_id] and x.kept == (x.doc_id == x.class_id) for x in got.values())


def edited(r, words, similarity, evenly=False):
    """A copy with as many substituted words as ``similarity`` allows, at
    scattered or at evenly spaced places."""
    out, n = list(words), int((1 - similarity) * len(words) + 1e-9)
    for i in [k * len(words) // n + 2 for k in range(n)] if evenly else r.sample(range(len(words)), n):
        out[min(i, len(words) - 1)] = f"e{r.randrange(10**9)}"
    return out


@pytest.mark.parametrize("evenly", [False, True])
def test_recall_of_sketches_at_the_least_similarity(evenly):
    r, k = random.Random(21), order_minhash.SKETCHES
    maker, hits = order_minhash.Sketcher(k), 0
    for _ in range(400):
        a = [f"w{r.randrange(5000)}" for _ in range(200)]
        b = edited(r, a, 0.8, evenly)
        assert order_minhash.alike(a, b)
        hits += bool((maker.sketch(a)[0] == maker.sketch(b)[0]).any())
    assert hits >= 0.99 * 400


@pytest.mark.parametrize("size", [5, 6, 8, 10, 12, 15, 20, 23, 24, 25, 29, 30, 31, 36])
def test_recall_of_short_texts(size):
    """Sketches and word signatures together, on pairs as unlike as a link may be."""
    r, maker, hits = random.Random(size), order_minhash.Sketcher(order_minhash.SKETCHES), 0
    for k in range(300):
        a = [f"w{r.randrange(5000)}" for _ in range(size)]
        b = edited(r, a, 0.8, k % 2)
        if k % 3 == 0:  # deletions in place of substitutions
            b = [w for w in b if w[0] == "w"]
        assert order_minhash.alike(a, b)
        (h, sign), (g, other) = maker.sketch(a), maker.sketch(b)
        share = order_minhash._shares(sign[None, :], np.array([len(a)]), other, len(b), 0.8)
        hits += bool(set(h.tolist()) & set(g.tolist()) and share[0] >= order_minhash.LEAST_ALIKE)
    assert hits >= 0.99 * 300


def test_short_texts_against_all_pairs(spark):
    r, docs = random.Random(31), {}
    for size in range(1, 41):
        for _ in range(3):
            words = [f"w{r.randrange(3000)}" for _ in range(size)]
            docs |= {len(docs) + k: " ".join(w) for k, w in enumerate([words, edited(r, words, 0.8), edited(r, words, 0.8, True)])}
    got = order_minhash.classes(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(3)).collect()
    assert {x.doc_id: x.class_id for x in got} == brute_classes(docs)


def test_shared_sketches(spark):
    """Rows of single sketches go, whatever the partitions' edges."""
    r = random.Random(32)
    rows = [(h, bytes([r.randrange(5)])) for h in range(300) for _ in range(r.randrange(1, 4))] + [(7, f"n{i % 3000}".encode()) for i in range(9000)]
    df = spark.createDataFrame(rows, "h bigint, node binary").repartition(5)
    got = [(x.h, bytes(x.node)) for x in order_minhash.shared(df).collect()]
    of = collections.defaultdict(set)
    for h, n in rows:
        of[h].add(n)
    want = {(h, n) for h, nodes in of.items() for n in nodes if len(nodes) > 1}
    assert len(got) == len(set(got)) and want <= set(got) <= set(rows) and len(got) < len(want) + 20


def test_scattered_edits_against_all_pairs(spark):
    r, docs = random.Random(22), {}
    for i in range(0, 160, 2):
        t = [f"w{r.randrange(3000)}" for _ in range(r.randrange(120, 250))]
        docs |= {i: " ".join(t), i + 1: " ".join(edited(r, t, r.choice([0.8, 0.81, 0.82, 0.84, 0.87])))}
    got = order_minhash.classes(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(3)).collect()
    assert {x.doc_id: x.class_id for x in got} == brute_classes(docs)


def test_bucket_of_unlike_nodes_over_many_partitions(spark):
    """Near copies far apart in a bucket that most leaders pass through."""
    r, rows = random.Random(23), []
    for i in range(150):
        words = [f"w{r.randrange(10**6)}" for _ in range(100)]
        twin = edited(r, words, 0.95)
        for k, w in enumerate((words, twin)):
            rows.append((f"{k}{i:04}".encode(), len(w), order_minhash.Sketcher(1).sketch(w)[1].tolist(), [7]))
    nodes = spark.createDataFrame(rows, "node binary, size int, sign array<bigint>, sketch array<bigint>")
    got = {(bytes(x.a).decode(), bytes(x.b).decode()) for x in order_minhash.candidates(nodes, run_rows=30).collect()}
    assert {(f"0{i:04}", f"1{i:04}") for i in range(150)} <= got


def test_failed_leader_does_not_part_near_copies(spark):
    """Two near copies that meet in one bucket alone, whose least node
    resembles both firmly but aligns with neither."""
    r, docs, maker = random.Random(24), {}, order_minhash.Sketcher(1)
    digest = lambda words: order_minhash.xxhash.xxh3_128_digest(" ".join(words))
    while len(docs) < 60:
        a = [f"w{r.randrange(5000)}" for _ in range(200)]
        b = edited(r, a, 0.77)
        trio = (a, b, edited(r, b, 0.94))
        if (digest(a) == min(map(digest, trio)) and len({int(maker.sketch(w)[0][0]) for w in trio}) == 1
                and not order_minhash.alike(a, b) and not order_minhash.alike(a, trio[2])):
            docs |= {len(docs) + k: " ".join(w) for k, w in enumerate(trio)}
    df = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(3)
    assert {x.doc_id: x.class_id for x in order_minhash.classes(df, sketches=1).collect()} == brute_classes(docs)


def test_pair_meets_in_one_bucket_only(spark):
    """Nodes that share ten buckets are paired once, and not within a class."""
    n, words = 30, [f"w{i}" for i in range(100)]
    sign = order_minhash.Sketcher(1).sketch(words)[1].tolist()
    name = lambda i: f"n{i:03}".encode()
    rows = spark.createDataFrame([(h, name(i), len(words), sign) for h in range(10) for i in range(n)], "h bigint, node binary, size int, sign array<bigint>")
    own = spark.createDataFrame([(name(i), name(i)) for i in range(n)], "node binary, label binary")
    one = spark.createDataFrame([(name(i), name(i % 2)) for i in range(n)], "node binary, label binary")
    every, some = rows.select("h", "node"), rows.filter(F.col("node") == F.lit(name(7))).select("h", "node")
    met = lambda failed, labels: [(bytes(x.a), bytes(x.b)) for x in order_minhash._led_again(rows, failed, labels, 0.8, 2.0).collect()]
    got = met(every, own)
    assert len(got) == len(set(got)) == n * (n - 1) // 2
    got = met(some, own)
    assert len(got) == len(set(got)) == n - 1
    assert len(met(every, one)) == n * n // 4 and len(met(some, one)) == n // 2


def test_pairs_without_enough_common_words_are_not_made(spark):
    """Texts whose signatures resemble each other by a passage: of all that
    share a bucket, only those with enough words in common are paired."""
    r, maker, docs = random.Random(34), order_minhash.Sketcher(1), []
    for _ in range(40):  # 100 of 140 words in common
        docs.append([f"p{i}" for i in range(100)] + [f"w{r.randrange(10**6)}" for _ in range(40)])
    docs.append(edited(r, docs[7], 0.9))
    name = lambda i: f"n{i:03}".encode()
    rows = spark.createDataFrame([(h, name(i), len(w), maker.sketch(w)[1].tolist()) for h in range(3) for i, w in enumerate(docs)],
                                 "h bigint, node binary, size int, sign array<bigint>")
    labels = spark.createDataFrame([(name(i), name(i)) for i in range(len(docs))], "node binary, label binary")
    told = spark.createDataFrame([(name(i), " ".join(w)) for i, w in enumerate(docs)], "node binary, text string")
    failed = rows.select("h", "node")
    assert order_minhash._led_again(rows, failed, labels, 0.8).count() > 200
    for block_words in (order_minhash.BLOCK_WORDS, 1000):
        got = order_minhash._led_again(rows, failed, labels, 0.8, block_words, lambda members: order_minhash._bags(told)).collect()
        assert [(bytes(x.a), bytes(x.b)) for x in got] == [(name(7), name(40))]


def test_texts_of_a_common_passage_are_told_apart():
    """Half of the words in common is under the least share of a link."""
    r, maker, below = random.Random(33), order_minhash.Sketcher(1), 0
    for _ in range(300):
        a = [f"w{r.randrange(10**6)}" for _ in range(300)]
        b = a[:150] + [f"w{r.randrange(10**6)}" for _ in range(150)]
        x, y = maker.sketch(a)[1], maker.sketch(b)[1]
        below += bool(order_minhash._shares(x[None, :], np.array([300]), y, 300, 0.8)[0] < order_minhash.LEAST_ALIKE)
    assert below > 295


def test_group_of_near_copies(spark):
    """A thousand near copies of one text, and clean texts that share a passage."""
    r = random.Random(11)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    passage = " ".join(f"p{i}" for i in range(55))
    rows = []
    for i in range(1000):
        t = list(base)
        for _ in range(4):
            t[r.randrange(len(t))] = f"e{r.randrange(10**6)}"
        rows.append((i, " ".join(t)))
    rows += [(i, passage + " " + " ".join(f"c{r.randrange(10**6)}" for _ in range(250))) for i in range(1000, 1200)]
    got = order_minhash.classes(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect()
    assert {x.class_id for x in got if x.doc_id < 1000} == {0}
    assert all(x.class_id == x.doc_id for x in got if x.doc_id >= 1000)
    assert sum(x.kept for x in got) == 201


def test_classes_odd_rows(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "a b c d e f"), (5, "other words here now"), (None, None)],
                               "doc_id bigint, text string")
    got = order_minhash.classes(df).collect()
    assert len(got) == 5 and sum(x.kept for x in got) == 3
    assert {x.class_id for x in got if x.class_size == 3} == {5}
    assert order_minhash.classes(df.limit(0)).count() == 0


def test_op3_on_whole_table(spark):
    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {x.doc_id: x.class_id for x in QUERIES["op3_order_minhash"](spark, SF).collect()}
    assert got == brute_classes(docs)


@functools.cache
def word_mark(w):
    return int(sentence_spans.Words([w]).mark[0])


def brute_clauses(t):
    """(first word, last word) of each clause of ``t``, and its words."""
    found = list(re.finditer(r"\S+", t))
    n, window = len(found), sentence_spans.WINDOW
    stop = [k == n - 1 or m.group()[-1] in ".!?…。！？" or "\n" in t[m.end():found[k + 1].start()] for k, m in enumerate(found)]
    ends = {k for k in range(n) if stop[k]}
    for k in range(n - window + 1):
        ends.add(min(range(k, k + window), key=lambda j: (not stop[j], word_mark(found[j].group()) >> 1, -j)))
    ends = sorted(ends)
    return list(zip([0, *(e + 1 for e in ends)], ends)), found, stop


def brute_spans(docs, size=3, least=12):
    """Texts with later occurrences of sentence runs removed, by plain strings."""
    seen, left = set(), {}
    for i in sorted(docs, key=lambda x: (x is not None, x)):
        t = docs[i] or ""
        clauses, found, stop = brute_clauses(t)
        gone = []
        for k, (a, _) in enumerate(clauses):
            enough = [z for _, z in clauses[k + size - 1:] if z - a + 1 >= least
                      and (sum(stop[a:z + 1]) >= size or z - a + 1 > sentence_spans.LONG_WORDS)]
            if enough:
                run = tuple(m.group().lower() for m in found[a:enough[0] + 1])
                if run in seen:
                    gone.append((found[a].start(), found[enough[0] + 1].start() if enough[0] + 1 < len(found) else len(t)))
                seen.add(run)
        keep = [True] * len(t)
        for a, z in gone:
            keep[a:z] = [False] * (z - a)
        left[i] = "".join(c for c, ok in zip(t, keep) if ok)
    return left


@pytest.mark.parametrize("words", [51, 60, 80])
def test_passages_in_the_middle_of_sentences(words):
    """Passages at random word positions of other texts share a run, and most
    of their words go; the same clauses come out whatever texts are beside."""
    r = random.Random(words)
    stop = lambda: r.choice(["", "", "", "", "", "", ".", ".", ",", "!"])
    made = lambda n: [f"w{int(r.expovariate(0.01))}{stop()}" for _ in range(n)]
    caught, share = 0, 0.0
    for _ in range(300):
        passage, pair = made(words), []
        for _ in range(2):
            d = made(150)
            at = r.randrange(1, 149)
            pair.append(" ".join(d[:at] + passage + d[at:]))
        found = [sentence_spans.runs(["beside this."] * k + [t], 3, 12) for k, t in enumerate(pair)]
        common = set(found[0][3].tolist()) & set(found[1][3].tolist())
        spans = [(a, z) for a, z, h in zip(*(c.tolist() for c in found[1][1:4])) if h in common]
        caught += bool(common)
        share += sum(len(pair[1][a:z].split()) for a, z in sentence_spans.union(spans)) / words
    assert caught >= 297 + 3 * (words >= 6 * sentence_spans.WINDOW)
    assert share / 300 > 0.8


def test_spans_against_brute_force(spark):
    r = random.Random(5)
    pool = [" ".join(f"w{r.randrange(40)}" for _ in range(r.randrange(1, 12))) + r.choice([".", "!", "?", ""]) for _ in range(60)]
    docs = {i: r.choice([" ", "\n"]).join(r.choice(pool) for _ in range(r.randrange(1, 30))) for i in range(150)}
    docs |= {200: None, 201: "", 202: "é. " * 50, 203: "word " * 3000, 204: "  İ Ab\u3000c.\t\nD" * 9, 205: "İ ab c.\n\nD" * 9 + "\x1c"}
    docs |= {k: " ".join(f"W{r.randrange(9)}" for _ in range(60)) for k in range(206, 240)}
    df = spark.createDataFrame([(i, t, 1, "clash") for i, t in docs.items()], "doc_id bigint, text string, begin int, spans string").repartition(4)
    got = sentence_spans.dedup(df).collect()
    want = brute_spans(docs)
    assert {x.doc_id: x.text for x in got} == want
    assert all(x.removed_chars == len(docs[x.doc_id] or "") - len(x.text) for x in got)


def test_passage_in_many_documents(spark):
    r = random.Random(8)
    fresh = lambda n: " ".join(f"u{r.randrange(10**9)}" for _ in range(n))
    passage = ". ".join(f"Q{k} " + " ".join(f"p{k}x{j}" for j in range(12)) for k in range(5)) + "."
    one_sentence = " ".join(f"long{k}" for k in range(70))
    docs = {i: f"{fresh(30)}. {passage} {fresh(25)}." for i in range(400)}
    docs |= {i: f"{fresh(30)} {one_sentence} {fresh(25)}." for i in range(400, 420)}
    docs |= {i: ". ".join(fresh(9) for _ in range(8)) for i in range(420, 440)}
    got = {x.doc_id: x for x in sentence_spans.dedup(spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")).collect()}
    assert got[0].text == docs[0] and all("p2x5" not in got[i].text for i in range(1, 400))
    assert all(got[i].removed_chars > 100 for i in range(401, 420))
    assert all(got[i].text == docs[i] for i in range(420, 440))


def test_one_sentence_is_no_run():
    line = " ".join(f"x{k}" for k in range(16)) + ".\n"
    found = [sentence_spans.runs([f"Alone here. {line}Other {k} end."], 3, 12) for k in "ab"]
    assert all(len(f[0]) for f in found)
    assert sentence_spans.runs([line], 3, 12)[0].tolist() == []


def test_spans_odd_rows(spark):
    text = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen."
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (4, "short")], "doc_id bigint, text string")
    got = sorted(((x.doc_id, x.text) for x in sentence_spans.dedup(df).collect()), key=repr)
    assert got == sorted([(None, text), (3, ""), (3, ""), (4, "short")], key=repr)
    assert sentence_spans.dedup(df.limit(0)).count() == 0


def test_texts_of_one_id_are_told_apart(spark):
    """Two texts under a null id whose 32-bit hashes are equal share no cuts."""
    seen, pair = {}, None
    for i in range(400_000):
        t = f"Row number {i} stands here alone. It says {i * 7919 % 1_000_003} things. None of it comes twice."
        h = hash32(t)
        if h in seen:
            pair = seen[h], t
            break
        seen[h] = t
    assert pair is not None
    hashes = [r[0] for r in spark.createDataFrame([(t,) for t in pair], "text string").select(F.hash("text")).collect()]
    assert hashes[0] == hashes[1]
    rows = [(None, pair[0]), (None, pair[0] + " "), (None, pair[1])]
    got = {x.text: x.removed_chars for x in sentence_spans.dedup(spark.createDataFrame(rows, "doc_id bigint, text string"), least_words=5).collect()}
    assert got[pair[1]] == 0 and sum(got.values()) > 0


def hash32(text):
    """Spark's 32-bit hash of a string: Murmur3, seed 42, its tail byte by byte."""
    mask = 0xFFFFFFFF
    def mix(h, k):
        k = k * 0xCC9E2D51 & mask
        k = (k << 15 | k >> 17) & mask
        h ^= k * 0x1B873593 & mask
        h = (h << 13 | h >> 19) & mask
        return (h * 5 + 0xE6546B64) & mask
    raw, h = text.encode(), 42
    whole = len(raw) // 4 * 4
    for k in range(0, whole, 4):
        h = mix(h, int.from_bytes(raw[k:k + 4], "little"))
    for c in raw[whole:]:
        h = mix(h, (c - 256 if c > 127 else c) & mask)
    h ^= len(raw)
    h = (h ^ h >> 16) * 0x85EBCA6B & mask
    h = (h ^ h >> 13) * 0xC2B2AE35 & mask
    return h ^ h >> 16
