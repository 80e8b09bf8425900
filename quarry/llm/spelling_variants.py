"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

Every word's deletions, and its replacements by a later letter, are probed
against blocked Bloom filters of the vocabulary, one filter (or several parts)
for each word length; so each unordered pair of near words is met once.  Only
probes that pass are written out as strings and joined with the vocabulary,
which removes the false ones.

The filters of one pass hold at most ``filter_bytes`` and are broadcast; a
larger vocabulary takes more passes, each over the words whose edits can fall
into its filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_path, id_text, salted, ship_package, slices, written

#: The letters of a word, and those that are lowered.
LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BITS = 24  # filter bits for each word
CHUNK = 1 << 13  # 64-bit blocks that one row of a built filter carries
LONGEST = 64  # longer words share a filter
_BASE = np.uint64(0x9E3779B97F4A7C15)


def occurrences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5) -> DataFrame:
    """``doc_id, word``: each maximal run of ``min_length`` letters or more,
    A to Z lowered.  Null texts have none."""
    runs = id_text(df, id_col, text_col).select("doc_id", F.explode(F.regexp_extract_all(
        "text", F.lit(f"{LETTERS}{{{int(min_length)},}}"), F.lit(0))).alias("run"))
    ascii_only = F.octet_length("run") == F.char_length("run")
    return runs.select("doc_id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("word"))


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``word, n``: the words of ``min_length`` code points and ``min_count``
    occurrences at least, over all rows of ``word``."""
    return (words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Letters:
    """Words of one length as letter numbers, with sums that give the hash of
    an edited word in constant time."""

    def __init__(self, words: list[str]):
        self.words, self.size = words, len(words[0])
        self.code = np.array(words, f"<U{self.size}").view(np.uint32).reshape(len(words), self.size)
        self.power = np.cumprod(np.full(self.size, _BASE))  # one odd factor for each place
        self.hashed = mixed(self.code + np.uint64(1))
        self.whole = (self.hashed * self.power).sum(axis=1)

    def deletions(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, place, hash`` of all distinct deletions."""
        here = self.hashed * self.power
        before = np.cumsum(here, axis=1) - here
        moved = self.hashed[:, 1:] * self.power[:-1]  # letters one place nearer the start
        after = np.zeros_like(before)
        after[:, :-1] = np.cumsum(moved[:, ::-1], axis=1)[:, ::-1]
        distinct = np.ones(self.code.shape, bool)  # of equal neighbours the first
        distinct[:, 1:] = self.code[:, 1:] != self.code[:, :-1]
        row, place = np.nonzero(distinct)
        return row, place, (before + after)[row, place]

    def replacements(self, place: int, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``row, letter, hash``: every later letter at one place."""
        row, to = np.nonzero(letters[None, :] > self.code[:, place, None])
        change = mixed(letters + np.uint64(1))[to] - self.hashed[row, place]
        return row, to, self.whole[row] + change * self.power[place]


class Filters:
    """Blocked Bloom filters by (length, part): a word sets four bits of one
    64-bit block."""

    def __init__(self, plan: dict[int, tuple[int, int, set[int]]], bits: dict[tuple[int, int], np.ndarray] | None = None):
        self.plan, self.bits = plan, bits  # plan: length -> (parts, blocks of a part, parts of this pass)

    @staticmethod
    def place(h: np.ndarray, size: int, parts: int, blocks: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``part, block, mask`` of word hashes."""
        h = mixed(h ^ np.uint64(size))
        part = (h >> np.uint64(40)) % np.uint64(parts)
        again = mixed(h)
        block = (again >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
        mask = np.zeros(len(h), np.uint64)
        for k in range(4):
            mask |= np.uint64(1) << ((again >> np.uint64(6 * k)) & np.uint64(63))
        return part.astype(np.int64), block.astype(np.int64), mask

    def may_hold(self, h: np.ndarray, size: int) -> np.ndarray:
        key = min(size, LONGEST + 1)
        out = np.zeros(len(h), bool)
        if key not in self.plan:
            return out
        parts, blocks, mine = self.plan[key]
        part, block, mask = self.place(h, size, parts, blocks)
        for p in mine:
            of = np.flatnonzero(part == p) if parts > 1 else slice(None)
            out[of] = self.bits[key, p][block[of]] & mask[of] == mask[of]
        return out


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[list[str], np.ndarray]]:
    """The words of a batch (first column) by length, with their rows."""
    words = batch.column(0).to_pylist()
    size = np.array([len(w) for w in words], np.int64)
    for n in np.unique(size).tolist():
        rows = np.flatnonzero(size == n)
        yield [words[k] for k in rows.tolist()], rows


def passes_of(counts: dict[int, int], filter_bytes: int) -> list[dict[int, tuple[int, int, set[int]]]]:
    """Plans of the passes: lengths, cut into parts where one is too large,
    put together up to ``filter_bytes``."""
    out: list[dict[int, tuple[int, int, set[int]]]] = [{}]
    room = filter_bytes
    for key, n in sorted(counts.items()):
        parts = max(1, -(-n * BITS // 8 // filter_bytes))
        blocks = max(1, -(-n * BITS // 64 // parts))
        for p in range(parts):
            if blocks * 8 > room and out[-1]:
                out.append({})
                room = filter_bytes
            room -= blocks * 8
            out[-1].setdefault(key, (parts, blocks, set()))[2].add(p)
    return out


def build(words: DataFrame, plan: dict[int, tuple[int, int, set[int]]]) -> Filters:
    """The filters of one pass: blocks are set in tasks and collected as rows
    of ``CHUNK`` blocks, so what comes to the driver is the filters' size."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for group, _ in by_length(b):
                size = len(group[0])
                key = min(size, LONGEST + 1)
                parts, blocks, mine = plan[key]
                part, block, mask = Filters.place(Letters(group).whole, size, parts, blocks)
                here = np.isin(part, list(mine))
                part, block, mask = part[here], block[here], mask[here]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), key)), pa.array(part), pa.array(block // CHUNK),
                                                  pa.array(block % CHUNK), pa.array(mask.view(np.int64))],
                                                 names=["length", "part", "chunk", "block", "mask"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for b in batches:
            *key, block, mask = (b.column(k).to_numpy() for k in range(5))
            mask = mask.view(np.uint64)
            one = np.stack(key, axis=1)
            for k in np.unique(one, axis=0):
                of = (one == k).all(axis=1)
                np.bitwise_or.at(held.setdefault(tuple(k.tolist()), np.zeros(CHUNK, np.uint64)), block[of], mask[of])
        if held:
            keys = list(zip(*held))
            yield pa.RecordBatch.from_arrays([*(pa.array(k, pa.int64()) for k in keys), pa.array([x.tobytes() for x in held.values()], pa.binary())],
                                             names=["length", "part", "chunk", "bits"])

    rows = (words.filter(F.least(F.char_length("word"), F.lit(LONGEST + 1)).isin(list(plan)))
            .select("word").mapInArrow(place, "length bigint, part bigint, chunk bigint, block bigint, mask bigint"))
    made = rows.repartition("length", "part", "chunk").mapInArrow(join, "length bigint, part bigint, chunk bigint, bits binary")
    bits = {(n, p): np.zeros(-(-blocks // CHUNK) * CHUNK, np.uint64) for n, (_, blocks, mine) in plan.items() for p in mine}
    for r in made.collect():  # filter_bytes at most
        bits[r.length, r.part][r.chunk * CHUNK:(r.chunk + 1) * CHUNK] |= np.frombuffer(r.bits, np.uint64)
    return Filters(plan, bits)


def probed(words: DataFrame, filters: Filters, alphabet: str) -> DataFrame:
    """``word, n, near``: edits of each word that its filter may hold."""
    spark = words.sparkSession
    sent = spark.sparkContext.broadcast(filters)
    letters = np.array([ord(c) for c in alphabet], np.uint32)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = sent.value
        for b in slices(batches, 4096):
            rows: list[np.ndarray] = []
            edits: list[str] = []
            for group, of in by_length(b):
                words = Letters(group)
                if words.size > 1:
                    row, place, h = words.deletions()
                    hit = held.may_hold(h, words.size - 1)
                    rows.append(of[row[hit]])
                    edits += [group[r][:p] + group[r][p + 1:] for r, p in zip(row[hit].tolist(), place[hit].tolist())]
                if min(words.size, LONGEST + 1) in held.plan:
                    for p in range(words.size):
                        row, to, h = words.replacements(p, letters)
                        hit = held.may_hold(h, words.size)
                        rows.append(of[row[hit]])
                        edits += [group[r][:p] + alphabet[t] + group[r][p + 1:] for r, t in zip(row[hit].tolist(), to[hit].tolist())]
            at = pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(edits, pa.string())],
                                             names=["word", "n", "near"])

    lengths = sorted({k for n in filters.plan for k in (n, n + 1)})
    return (words.filter(F.least(F.char_length("word"), F.lit(LONGEST + 2)).isin(lengths) | (F.char_length("word") > LONGEST))
            .select("word", "n").mapInArrow(each, "word string, n bigint, near string"))


def near_pairs(words: DataFrame, filter_bytes: int = 32 << 20) -> DataFrame:
    """``word, n, near, near_n``: all ordered pairs of distinct words of
    ``words`` (``word, n``; a written table, read several times) that differ by
    one inserted, deleted or replaced code point."""
    ship_package(words.sparkSession)
    size = F.least(F.char_length("word"), F.lit(LONGEST + 1))
    counts = {r[0]: r[1] for r in words.groupBy(size).count().collect()}  # at most LONGEST + 1 rows
    # at most the letters that words are made of
    alphabet = "".join(sorted(r[0] for r in words.select(F.explode(F.split("word", "")).alias("c")).distinct().collect() if r[0]))
    found = None
    for plan in passes_of(counts, filter_bytes):
        if plan:
            some = probed(words, build(words, plan), alphabet)
            found = some if found is None else found.union(some)
    if found is None:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")).limit(0)
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = found.join(known, "near")
    one, two = (F.struct(F.col(a).alias("word"), F.col(b).alias("n"), F.col(c).alias("near"), F.col(d).alias("near_n"))
                for a, b, c, d in (("word", "n", "near", "near_n"), ("near", "near_n", "word", "n")))
    return both.select(F.inline(F.array(one, two)))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: the end of each chain of forms (no
    chain may come back).  Pointers double in each round; a root that many
    words point to is looked up once for each of their sub-groups."""
    spark = forms.sparkSession
    old: list[str] = []
    here = written(forms.select("word", F.col("form").alias("root")), "variant-roots", old)
    while True:
        rows = here.withColumn("_salt", salted("word"))
        onward = here.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        known = rows.select("root", "_salt").distinct().join(onward, "root")
        moved = rows.join(known, ["root", "_salt"], "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved"))
        after = written(moved, "variant-roots", old)
        going = after.filter("_moved").limit(1).count()
        here = after.drop("_moved")
        for path in old[:-1]:
            drop_path(spark, path)
        del old[:-1]
        if not going:
            return here


def group(words: DataFrame, filter_bytes: int = 32 << 20, factor: int = 2) -> DataFrame:
    """Spelling variants of a vocabulary: ``word, n, n_near, form, form_n, root``.

    ``words`` has ``word`` (distinct, not null) and ``n``; other columns are
    left out.  ``n_near`` counts the words at one edit.  ``form`` is the near
    word of largest ``n`` (ties: the smallest in code-point order) if that is
    ``factor`` times the word's own or more, else null.  ``root`` is the last
    word that the forms lead to, the word itself if it has none.  An empty
    vocabulary gives no rows; words of any length are taken whole.  With
    ``factor`` 2 or more counts grow along a chain, so it ends.
    """
    if factor < 2:
        raise ValueError("factor must be 2 or more, so that chains of forms end")
    kept = written(words.select("word", F.col("n").cast("bigint").alias("n")), "variant-words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))
    told = near_pairs(kept, filter_bytes).groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("b"))
    strong = -F.col("b.m") >= factor * F.col("n")
    told = written(told.select("word", "n_near", F.when(strong, F.col("b.w")).alias("form"), F.when(strong, -F.col("b.m")).alias("form_n")),
                   "variant-forms")
    return (kept.join(told, "word", "left").join(roots(told.filter("form IS NOT NULL")), "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form", "form_n",
                    F.coalesce("root", "word").alias("root")))
