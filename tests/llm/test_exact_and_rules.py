"""Digest index, host rules, secret scan and snapshot collapse on small cases."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from quarry.llm import digest_index, host_rules, secret_scan, snapshots
from quarry.session import scratch_path

SF = "/root/testdata/sf0.001"
BLANKS = re.compile(r"[\x20\x09-\x0D]")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, _salt string, digest int"


def docs_of(spark, rows):
    """Rows of (doc_id, text, source) with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, "en", s, 1, "x", "y", 3) for i, t, s in rows], DOCS)


CASES = [(1, "a b", "s"), (2, "ab", "s"), (3, "a\tb ", "s"), (4, None, "s"), (5, "", None), (6, " \n", None),
         (7, "x", "s"), (7, "x", "s"), (None, "x y", "s"), (None, None, None), (8, "é" * 70_000, "s"), (9, "é" * 70_000 + " ", "s")]


def brute_digests(rows):
    groups = {}
    for i, t, _ in rows:
        t = t or ""
        groups.setdefault(BLANKS.sub("", t), []).append((-len(t), i is None, i if i is not None else 0, i))
    out = []
    for i, t, _ in rows:
        k = BLANKS.sub("", t or "")
        out.append((i, min(groups[k])[3], len(groups[k]), hashlib.sha256(k.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_digest_index_against_brute_force(spark):
    index = digest_index.DigestIndex(spark, scratch_path(spark, "t"), buckets=4)
    got = index.ingest(docs_of(spark, CASES)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=repr) == brute_digests(CASES)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


def test_digest_index_is_persistent(spark):
    path = scratch_path(spark, "t")
    digest_index.DigestIndex(spark, path, buckets=4).ingest(docs_of(spark, CASES))
    again = digest_index.DigestIndex(spark, path, buckets=4)  # opened anew
    got = again.ingest(docs_of(spark, [(100, "a  b", "s"), (101, "new", "s"), (102, "n ew", "s")])).collect()
    assert {(r.doc_id, r.keep_id, r.kept, r.known) for r in got} == {(100, 3, False, True), (101, 102, False, False), (102, 102, True, False)}
    n = again.rows().count()
    assert n == len({BLANKS.sub("", t or "") for _, t, _ in CASES}) + 1
    assert again.compact(scratch_path(spark, "t")).rows().count() == n


def test_batch_that_comes_again(spark):
    """A batch whose result was lost, before or after its append, is not known to itself."""
    path = scratch_path(spark, "t")
    index = digest_index.DigestIndex(spark, path, buckets=4)
    index.ingest(docs_of(spark, [(1, "old", "s")]))
    batch = [(10, "old", "s"), (11, "a", "s"), (12, " a", "s"), (13, "b", "s"), (14, None, "s")]
    told = lambda df: sorted((r.doc_id, r.keep_id, r.group_size, r.kept, r.known) for r in df.collect())
    first = told(index.ingest(docs_of(spark, batch)))
    assert first == [(10, 1, 1, False, True), (11, 12, 2, False, False), (12, 12, 2, True, False), (13, 13, 1, True, False), (14, 14, 1, True, False)]
    again = digest_index.DigestIndex(spark, path, buckets=4)
    assert told(again.ingest(docs_of(spark, batch[::-1]))) == first and again.rows().count() == 4
    # an append that came half way
    half = digest_index.DigestIndex(spark, scratch_path(spark, "t"), buckets=4)
    half.append(again.rows().filter("keep_id IN (1, 12)").withColumn("batch", F.when(F.col("keep_id") == 12, "x").otherwise("w")))
    assert told(half.ingest(docs_of(spark, batch), batch_id="x")) == first and half.rows().count() == 4
    # under another name it is another batch
    assert not any(r[3] for r in told(half.ingest(docs_of(spark, batch), batch_id="y")))
    half.close()
    assert not spark.catalog.tableExists(half.name)


def test_digest_index_hot_group(spark):
    rows = [(i, "same text", "s") for i in range(3000)] + [(i, f"t {i}", "s") for i in range(3000, 3050)]
    got = digest_index.DigestIndex(spark, scratch_path(spark, "t"), buckets=4).ingest(docs_of(spark, rows))
    assert got.filter("kept").count() == 51 and got.filter("group_size = 3000 AND keep_id = 0").count() == 3000


def test_empty_tables(spark):
    empty = docs_of(spark, []).limit(0)
    assert digest_index.DigestIndex(spark, scratch_path(spark, "t"), buckets=2).ingest(empty).count() == 0
    assert host_rules.judge(empty).count() == 0
    assert secret_scan.scan(empty).count() == 0
    turns = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert snapshots.render(turns).count() == 0 and snapshots.collapse(turns).count() == 0


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if re.search(r"[^\x20\x09-\x0D]", x):
            dup += x in seen
            seen.add(x)
    tri = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    hit = {i + k for i, t in enumerate(tri) if tri.count(t) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(hit)


def test_measures_against_brute_force():
    r = random.Random(5)
    for _ in range(400):
        t = "".join(r.choice(["a", "b", " ", " ", "\n", "\t", "é", "#", "\x0b", " ", " ", "ab "]) for _ in range(r.randrange(60)))
        assert host_rules.measures(t)[:5] == brute_measures(t), repr(t)
    assert host_rules.repeat_words([b"x"] * 100_000) == 100_000


def test_host_rules(spark):
    clean = " ".join(f"word{i}" for i in range(60))
    signs = clean + " #" * 10
    rows = [(i, signs, "bad") for i in range(40)] + [(i, clean, "bad") for i in range(40, 50)]
    rows += [(i, clean, "good") for i in range(50, 99)] + [(99, signs, "good"), (100, signs, None), (101, "few words", "good"), (102, None, "good"),
             (None, clean, "good"), (50, clean, "good")]
    got = {(r.doc_id, r.host): r for r in host_rules.judge(docs_of(spark, rows)).collect()}
    assert not any(got[i, "bad"].kept for i in range(40)) and all(got[i, "bad"].kept for i in range(40, 50))
    assert got[99, "good"].kept and got[100, None].kept and got[None, "good"].kept  # a failure that its host doesn't share
    assert got[0, "bad"].host_failed == "many_symbols"
    assert got[101, "good"].base_failed and got[102, "good"].base_failed and not got[102, "good"].kept
    assert host_rules.judge(docs_of(spark, rows)).count() == len(rows)


def test_hosts_clearly_above_the_others(spark):
    """A bad host with a third of all rows, below a rate of a half in every
    soft rule; a host of base failures; good hosts with a few failures."""
    clean = " ".join(f"w{k}" for k in range(60))
    symbols = clean + " ####" * 3
    short = "too short"
    rows, n = [], 0
    for h in range(12):
        for k in range(40):
            rows.append((n := n + 1, symbols if k < h % 3 + 1 else clean, f"good{h}"))
    for k in range(300):
        rows.append((n := n + 1, symbols if k % 20 < 9 else clean, "bad"))
    for k in range(100):
        rows.append((n := n + 1, short if k < 90 else symbols if k < 95 else clean, "short"))
    got = host_rules.judge(docs_of(spark, rows)).collect()
    kept = {r.doc_id: r.kept for r in got}
    assert len(got) == len(rows) and {i for i, _, _ in rows} == set(kept)
    assert all(kept[i] == (t == clean if h in ("bad", "short") else True) for i, t, h in rows)
    assert {r.host_failed for r in got if not r.kept and not r.base_failed} == {"many_symbols"}


def test_base_spans():
    r = random.Random(3)
    assert secret_scan.base_spans('x PASSWORD = "abcdefgh" y') == [(2, 22, "assign")]
    assert secret_scan.base_spans("token=secret: abcdefgh") == []  # the short match takes "token=secret"
    assert secret_scan.base_spans("ſecret=abcdefgh") == []  # letters in either case are ASCII
    assert secret_scan.base_spans("AKIAAAAAAAAAAAAA é AKIA1") == [(0, 16, "access")]
    assign = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    for _ in range(2000):
        t = "".join(r.choice(["token", "API_key", "=", ":", " ", '"', "abcdefgh", "é", "AKIA", "ABCDEF123456", "0123456789abcdef", "f", "\n"]) for _ in range(12))
        want = [(*m.span(), "assign") for m in assign.finditer(t) if len(m[2]) >= 8]
        want += [(*m.span(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
        want += [(*m.span(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        assert secret_scan.base_spans(t) == want, repr(t)


def test_guess_cost_order():
    cost = secret_scan.guess_bits
    assert cost("") == 0
    assert cost("password") < cost("Passw0rd") < cost("xkqzvbwj")
    assert cost("aaaaaaaaaaaa") < cost("asdfghjkl") < cost("aqmzpwlxo")
    assert cost("1987-05-12") < cost("8291370465")
    assert cost("abcxyzabcxyzabcxyz") < 2 * cost("abcxyz")
    assert cost("password123") < secret_scan.SECRET_BITS < cost("h7Kq9ZtR2mXw8")
    for v in ("a", "é€", "p" * 5000, "Pass-2024-" * 300):  # any span's cost is at most that of its parts
        assert cost(v + v) <= 2 * cost(v) + 1 + 1e-9


def test_guess_cost_is_the_minimum():
    """The dynamic program against all segmentations into single steps."""
    words = {"abc": 2.5, "cab": 1.5, "bca": 0.5}
    r = random.Random(1)
    for _ in range(200):
        v = "".join(r.choice("abc") for _ in range(r.randrange(1, 8)))
        n, per = len(v), secret_scan._class_bits("z")[0] if not set(v) <= set("abcdef") else 4.0
        best = float("inf")
        for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, n), k) for k in range(n)):
            parts = [v[a:b] for a, b in zip((0, *cuts), (*cuts, n))]
            if all(len(p) < 3 or p in words for p in parts) and all(p in words or len(p) == 1 for p in parts):
                total, before = 0.0, False
                for k, p in enumerate(parts):
                    if len(p) >= 3:
                        total, before = total + words[p] + (k > 0), False
                    else:
                        total, before = total + per + (k > 0 and not before), True
                best = min(best, total)
        assert secret_scan.guess_bits(v, words) <= best + 1e-9


def test_short_random_values_and_quoted_passphrases():
    r = random.Random(4)
    found = lambda t: [t[a:b] for a, b, _ in secret_scan.guess_spans(t)]
    assert found("pwd: xK9mQ2vT") == ["xK9mQ2vT"]
    assert found("postgres://user:Xk9#mQ2!@host/db") == ["Xk9#mQ2!"]
    assert found('passphrase="four random words here"') == ["four random words here"]
    alphabet, hits = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", 0
    for _ in range(1000):
        hits += bool(found("pwd: " + "".join(r.choice(alphabet) for _ in range(8))))
    assert hits >= 970
    for v in ("password1", "Passw0rd", "different", "Elephant", "elephant7", "Summer2024!", "1987-05-12", "20240131", "qwertyuiop", "123456789",
              "asdfghjkl;", "aaaaaaaaaaaa", "changeme2024", "letmein123"):
        assert not found(f"pwd: {v} ."), v
    assert not found('token: "not required here"') and not found('auth: "none"')


def test_scan_and_redact(spark):
    long = "x" * 200_000 + ' pwd: "h7Kq9ZtR2mXw8" ' + "y" * 10
    rows = [(1, 'token = "9f3c07b2e85d41a6c0d97e12b4f86a35"', "s"), (2, None, "s"), (3, long, "s"), (3, long, "s"), (None, "clean", None)]
    got = sorted(((r.doc_id, [(s.kind, s.start, s.end) for s in r.spans]) for r in secret_scan.scan(docs_of(spark, rows)).collect()), key=repr)
    assert len(got) == 5
    assert (3, [("guess", 200_007, 200_020)]) in got and (None, []) in got and (2, []) in got
    assert [k for k, _, _ in dict(got)[1]] == ["assign", "hex", "guess"]
    out = secret_scan.redact(docs_of(spark, rows), length_col="n_chars").collect()
    assert {r.doc_id: r.text for r in out}[1] == '[SECRET]"' and {r.doc_id: r.n_chars for r in out}[1] == 9
    assert {r.doc_id: r.text for r in out}[2] is None and out[0].asDict().keys() == docs_of(spark, rows).first().asDict().keys()


def brute_maximal(convs):
    whole = {}
    for c, turns in convs.items():
        whole.setdefault(tuple(turns), []).append(c)
    return {min(ids, key=lambda x: (x is None, x)): (len(t), len(ids)) for t, ids in whole.items()
            if not any(len(o) > len(t) and o[:len(t)] == t for o in whole)}


def test_snapshots_against_brute_force(spark):
    r = random.Random(2)
    convs = {c: [(r.choice(["user", None]), r.choice(["a", "b", None, ""])) for _ in range(r.randrange(1, 5))] for c in range(300)}
    convs[None] = [("user", "only null id")]
    rows = [(c, k, role, text, "clash") for c, t in convs.items() for k, (role, text) in enumerate(t)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, n_turns string").repartition(3)
    got = {x.conv_id: (x.n_turns, x.copies) for x in snapshots.render(df).collect()}
    assert got == brute_maximal(convs)
    assert snapshots.collapse(df).count() == len(convs)


@pytest.mark.parametrize("copies", [1, 3])
def test_snapshots_render(spark, copies):
    rows = [(c, k, "user" if k % 2 == 0 else "assistant", f"t{k}") for c in range(copies) for k in range(3)] + [(9, 0, "user", "t0"), (9, 0, "user", "t0")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {x.conv_id: x for x in snapshots.render(df).collect()}
    assert got[0].text == "<|im_start|>user\nt0<|im_end|>\n<|im_start|>assistant\nt1<|im_end|>\n<|im_start|>user\nt2<|im_end|>\n"
    assert got[0].copies == copies and got[9].n_turns == 2 and len(got) == 2
