"""Near-duplicate documents by Order MinHash, verified by banded alignment.

Each sketch samples the two least occurrence-labelled three-word shingles under
its hash and keeps their order in the text.  Documents that share sketches are
candidates; a pair is linked if its words align at an edit similarity of 0.8.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, drop_path, id_text, known_groups, salted, ship_package, slices, texts, written
from quarry.llm.components import components, forest_roots

#: So many sketches that a pair at the least similarity shares one: an edit in
#: every fifth word leaves a shingle share of 0.25, and 1 - (1 - 0.25 ** 2) ** 96
#: is 0.998; edits at random places leave more.
SHINGLE, SKETCHES, SIMILARITY = 3, 96, 0.8
#: Words up to which a text has no shingles of three words but single words: in
#: a shorter text few edits leave no shingle whole.  Texts of up to a fourth
#: more words have sketches of both kinds, so any two that can be linked share
#: a kind.
SHORT = 24
#: Bins of the word signature, a byte of four cells each; the share of equal cells from which a node joins
#: a leader, and that below which a pair is passed over (a true share of 0.67,
#: the least of a link, comes out below it by chance once in ten thousand).
#: Texts that share a passage alone come out below it as well.
BINS, FIRM, LEAST_ALIKE = 64, 0.62, 0.49
#: Cells and bigints of a signature: a bit for each cell that is filled, and one of its least hash.
CELLS, SIGN = 4 * BINS, BINS // 8
#: Rows of a bucket that one task holds, and pairs until a task gives them out.
RUN_ROWS, PAIR_ROWS = 20_000, 20_000
#: Words of a block of texts that meet another, and the bits of a word's hash
#: in a bag: a table of so many marks stays in the cache.
BLOCK_WORDS, BAG_BITS = 250_000, (1 << 20) - 1
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    """Lower-case words; a text of signs alone is split at blanks."""
    return _WORD.findall(text.lower()) or text.split()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _labelled(values: np.ndarray) -> np.ndarray:
    """Hash of each value and how often it occurred before."""
    order = np.argsort(values, kind="stable")
    ranked = values[order]
    again = np.flatnonzero(ranked[1:] == ranked[:-1]) + 1
    if not len(again):
        return _mixed(values)
    place = np.arange(len(values))
    first = place.copy()
    first[again] = 0
    ranked += (place - np.maximum.accumulate(first)).astype(np.uint64) * _MIX
    out = np.empty_like(values)
    out[order] = ranked
    return _mixed(out)


class _Hashes(dict):
    """Hash of a word, as eight bytes, made when first asked for."""

    def __missing__(self, word: str) -> bytes:
        self[word] = h = xxhash.xxh3_64_digest(word)
        return h


class Sketcher:
    """Order MinHash sketches; hashes of recurring words are kept, bounded."""

    def __init__(self, sketches: int = 24, cache_words: int = 300_000):
        self.seeds = _mixed(np.arange(1, sketches + 1, dtype=np.uint64) * _MIX)
        self.cache_words, self.known = cache_words, _Hashes()

    def word_hashes(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) >= self.cache_words:
            known.clear()
        return np.frombuffer(b"".join(map(known.__getitem__, words)), ">u8").astype(np.uint64)

    def sketch(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sketches (one 64-bit value for each hash and kind of shingle) and
        the packed word signature; none for no words."""
        if not words:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        with np.errstate(over="ignore"):
            w = self.word_hashes(words)
            kinds = [1] * (len(words) <= SHORT / SIMILARITY) + [SHINGLE] * (len(words) >= SHORT)
            return np.concatenate([self.sampled(w, size) for size in kinds]), self.signature(w)

    def sampled(self, w: np.ndarray, size: int) -> np.ndarray:
        """The two least occurrence-labelled shingles of ``size`` words under
        each hash, in text order, as one number."""
        n = len(w) - size + 1
        shingles = np.zeros(n, np.uint64)
        for k in range(size):
            shingles = _mixed(shingles * _MIX + w[k:n + k])
        labelled = (_labelled(shingles) >> np.uint64(32)).astype(np.uint32)  # 32 bits order them well enough, at half the cost
        out = np.empty(len(self.seeds), np.uint64)
        block = max((1 << 16) // n, 1)  # sketches at a time, so that they stay in the cache
        for j in range(0, len(self.seeds), block):
            seeds = self.seeds[j:j + block]
            h = labelled ^ (seeds >> np.uint64(32)).astype(np.uint32)[:, None]
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(16)
            h *= np.uint32(0x85EBCA6B)
            first = last = h.argmin(axis=1)
            if n > 1:  # the two least, in text order
                h[np.arange(len(seeds)), first] = ~np.uint32(0)
                second = h.argmin(axis=1)
                first, last = np.minimum(first, second), np.maximum(first, second)
            out[j:j + block] = _mixed(_mixed(seeds ^ shingles[first]) * _MIX + shingles[last] + np.uint64(size))
        return out.view(np.int64)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """For each of ``CELLS`` cells of the occurrence-labelled words, whether
        it is filled, and one bit of its least hash, packed: these estimate
        the Jaccard similarity of the word bags (``_shares``), which two texts
        of edit similarity 0.8 have at 0.67 or more."""
        ranked = np.sort(_labelled(hashes))[::-1]
        cells = (ranked & np.uint64(CELLS - 1)).astype(np.int64)
        out = np.zeros(2 * CELLS, np.uint8)
        out[cells] = 1
        out[CELLS + cells] = (ranked >> np.uint64(32)) & np.uint64(1)  # the last of a cell, its least, stays
        return np.packbits(out).view(np.int64)


def edit_distance(a: list, b: list, most: int) -> int:
    """Levenshtein distance of two sequences if at most ``most``, else more.

    Bit-parallel in a band of ``2 * most + 1`` diagonals: bit p of column j
    stands for row ``j - most + p``.  The distance is followed down the band's
    lowest diagonal and then along the last row.
    """
    if len(a) > len(b):
        a, b = b, a
    n, m = len(a), len(b)
    if m - n > most:
        return most + 1
    if not n:
        return m
    places: dict = {}
    for row, x in enumerate(a, 1):
        places[x] = places.get(x, 0) | 1 << (row + most)
    full = (1 << (2 * most + 1)) - 1
    top = 1 << (2 * most)
    up, down = full >> most << most, 0
    turn = max(n - most, 0)
    dist = min(most, n)
    limit = most + m - turn
    for j, x in enumerate(b, 1):
        same = (places.get(x, 0) >> j) & full
        diag = ((((same & up) + up) ^ up) | same | down) & full
        right = (down | ~(diag | up)) & full
        left = diag & up
        if j <= turn:
            if not diag & top:
                dist += 1
                if dist > limit:
                    return most + 1
        else:
            bit = 1 << (n - j + most)
            if right & bit:
                dist += 1
            elif left & bit:
                dist -= 1
        below = diag >> 1
        up = (left | ~(below | right)) & full
        down = below & right
    return dist


def alike(a: list, b: list, similarity: float = SIMILARITY) -> bool:
    """Edit similarity, 1 - distance / longer length, is ``similarity`` or more."""
    longer = max(len(a), len(b))
    most = int((1 - similarity) * longer + 1e-9)
    if longer - min(len(a), len(b)) > most or longer - (Counter(a) & Counter(b)).total() > most:
        return False  # each word that the other lacks costs an edit
    return edit_distance(a, b, most) <= most


def sketch_rows(df: DataFrame, id_col: str, text_col: str, sketches: int) -> DataFrame:
    """``doc_id, text_hash, node, size, sign, sketch``: size is in words, node a
    digest of the words, so texts that differ in case, blanks and signs alone
    are one node.  Within a task a node's sketches are given once, so a node
    with a third of all rows has a few rows of them only."""
    ship_package(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, told = Sketcher(sketches), set()
        lists = lambda rows: pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), pa.array(np.concatenate(rows), pa.int64()))
        none = np.empty(0, np.int64), np.empty(0, np.int64)
        for b in slices(batches):
            nodes, sizes, rows = [], [], []
            for t in texts(b.column(2)):
                words = words_of(t)
                node = xxhash.xxh3_128_digest(" ".join(words))
                sizes.append(len(words))
                nodes.append(node)
                rows.append(none if node in told else maker.sketch(words))
                told.add(node)
            if rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()),
                                                  lists([r[1] for r in rows]), lists([r[0] for r in rows])],
                                                 names=["doc_id", "text_hash", "node", "size", "sign", "sketch"])

    src = id_text(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return src.mapInArrow(each, "doc_id bigint, text_hash bigint, node binary, size int, sign array<bigint>, sketch array<bigint>")


def _shares(held: np.ndarray, sizes: np.ndarray, sign: np.ndarray, size: int, similarity: float) -> np.ndarray:
    """Share of equal cells of each held signature with one signature, or with
    its own; 0 where the lengths differ too much.  Cells that differ have equal
    bits half the time, so each that is seen to differ counts twice."""
    held, sign, half = held.view(np.uint64), sign.view(np.uint64), SIGN // 2
    count = lambda bits: np.bitwise_count(bits).sum(axis=-1, dtype=np.int64)
    both = held[..., :half] & sign[..., :half]
    equal = count(both) - 2 * count(both & (held[..., half:] ^ sign[..., half:]))
    share = equal / np.maximum(count(held[..., :half] | sign[..., :half]), 1)
    share[np.minimum(sizes, size) < similarity * np.maximum(sizes, size) - 1] = 0
    return share


def _signs(batch: pa.RecordBatch, column: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, SIGN)


def _plain_runs(batch: pa.RecordBatch, run: int | None, similarity: float, firm: float) -> tuple[pa.RecordBatch, pa.RecordBatch]:
    """Pairs of the runs of ``h`` in ``batch`` that have two nodes, or whose
    nodes all firmly resemble the first; and the rows of the other runs.  The
    last run, which may go on, and one that goes on from ``run`` (None: the
    partition's first) are among the others."""
    h, node, size, sign = batch.column(0).to_numpy(), batch.column(1), batch.column(2).to_numpy(), _signs(batch, 3)
    label = batch.column(4).to_numpy()
    starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    counts = np.diff(np.append(starts, len(h)))
    head = np.repeat(starts, counts)
    share = _shares(sign[head], size[head], sign, size, similarity)
    follows = head != np.arange(len(h))
    plain = (counts == 2) | np.logical_and.reduceat((share >= firm) | ~follows, starts)
    plain[-1] = False
    plain[0] &= run is not None and h[0] != run
    rows = np.repeat(plain, counts)
    at = np.flatnonzero(rows & follows & ((share >= firm) | (share >= LEAST_ALIKE) & (label != label[head])))
    k = len(at)
    pairs = pa.RecordBatch.from_arrays(
        [node.take(pa.array(head[at])), node.take(pa.array(at)), pa.array((CELLS * share[at]).astype(np.int32)),
         pa.array(h[at], mask=share[at] < firm), pa.nulls(k, pa.int32()), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.int64()),
         pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.int32())], names=["a", "b", "shared", "h", "size", "sign", "label", "before", "block"])
    return pairs, batch.filter(pa.array(~rows))


def _leaders(similarity: float, firm: float = FIRM):
    """Pass over rows ``h, node, size, sign, label, before`` sorted by (h, node): within a
    run of one h, a node whose word signature and length firmly resemble an
    earlier leader's is paired with the best such alone; any other is paired
    with the leaders of other labels that it may resemble, and becomes one.  A pair's ``h`` is
    set where b has this leader alone.  Leaders that have an earlier bucket in
    ``before`` in common with the node have met it there.  Leaders of runs at a partition's edges
    are returned too, with the partition as ``block``, as the run may go on in
    the next.

    Runs inside a batch that have two nodes, or all of whose nodes firmly
    resemble the first, have no other leader to choose from: these are paired
    in one step for the whole batch, the others node by node."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "shared", "h", "size", "sign", "label", "before", "block"]
        block, run, first = TaskContext.get().partitionId(), None, True
        nodes: list[bytes] = []
        held, sizes, labels = np.empty((16, SIGN), np.int64), np.empty(16, np.int64), np.empty(16, np.int64)
        earlier: list[set[int]] = []
        a, b, shared, alone = [], [], [], []

        def pair_rows() -> pa.RecordBatch:
            k = len(a)
            out = pa.RecordBatch.from_arrays(
                [pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(shared, pa.int32()), pa.array(alone, pa.int64()),
                 pa.nulls(k, pa.int32()), pa.nulls(k, pa.list_(pa.int64())), pa.nulls(k, pa.int64()), pa.nulls(k, pa.list_(pa.int64())),
                 pa.nulls(k, pa.int32())], names=names)
            for x in (a, b, shared, alone):
                x.clear()
            return out

        def edge_rows() -> pa.RecordBatch:
            k = len(nodes)
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.nulls(k, pa.binary()), pa.nulls(k, pa.int32()), pa.array([run] * k, pa.int64()),
                 pa.array(sizes[:k], pa.int32()), pa.array([held[i].tolist() for i in range(k)], pa.list_(pa.int64())),
                 pa.array(labels[:k], pa.int64()), pa.array([sorted(x) for x in earlier], pa.list_(pa.int64())),
                 pa.array([block] * k, pa.int32())], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            plain, slow = _plain_runs(batch, run, similarity, firm)
            if plain.num_rows:
                yield plain
            for h, node, size, label, before, sign in zip(*(slow.column(c).to_pylist() for c in (0, 1, 2, 4, 5)), _signs(slow, 3)):
                if h != run:
                    if run is not None and first:
                        yield edge_rows()
                        first = False
                    run, nodes, earlier = h, [], []
                k, before = len(nodes), set(before or ())
                if k:
                    share = _shares(held[:k], sizes[:k], sign, size, similarity)
                    best = int(share.argmax())
                    chosen = [best] if share[best] >= firm else np.flatnonzero((share >= LEAST_ALIKE) & (labels[:k] != label))
                    for i in chosen:
                        if share[best] < firm and not before.isdisjoint(earlier[i]):
                            continue
                        a.append(nodes[i]), b.append(node), shared.append(int(CELLS * share[i])), alone.append(h if share[best] >= firm else None)
                    if share[best] >= firm:
                        continue
                if k == len(held):
                    held, sizes, labels = (np.concatenate([x, np.empty_like(x)]) for x in (held, sizes, labels))
                held[k], sizes[k], labels[k] = sign, size, label
                nodes.append(node), earlier.append(before)
                if len(a) > PAIR_ROWS:
                    yield pair_rows()
            if a:
                yield pair_rows()
        if run is not None:
            yield edge_rows()

    return each


def _across(left: DataFrame, right: DataFrame, similarity: float) -> DataFrame:
    """``a, b, shared``, a < b: each row of ``left`` with each of ``right`` of
    the same block pair (h, i, j) and another label that it may resemble; both
    have ``h, i, j, node, size, sign, label, before``.  Rows that have a bucket
    in ``before`` in common have met there.  A block pair's left rows are held
    by one task."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, signs, sizes, labels, earlier, table = None, [], [], [], [], [], None
        a, b, shared = [], [], []

        def pair_rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(shared, pa.int32())],
                                             names=["a", "b", "shared"])
            for x in (a, b, shared):
                x.clear()
            return out

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in range(8)), _signs(batch, 8))
            for h, i, j, side, node, size, label, before, sign in rows:
                if (h, i, j) != at:
                    at, nodes, signs, sizes, labels, earlier, table = (h, i, j), [], [], [], [], [], None
                if not side:
                    nodes.append(node), signs.append(sign.copy()), sizes.append(size), labels.append(label)
                    earlier.append(set(before or ()))
                    continue
                if not nodes:
                    continue
                if table is None:
                    table, known = (np.array(signs), np.array(sizes, np.int64)), np.array(labels, np.int64)
                share = _shares(*table, sign, size, similarity)
                for k in np.flatnonzero((share >= LEAST_ALIKE) & (known != label)):
                    if nodes[k] != node and earlier[k].isdisjoint(before or ()):
                        a.append(min(nodes[k], node)), b.append(max(nodes[k], node)), shared.append(int(CELLS * share[k]))
                if len(a) > PAIR_ROWS:
                    yield pair_rows()
            yield pair_rows()

    cols = ["h", "i", "j", "side", "node", "size", "label", "before", "sign"]
    both = left.withColumn("side", F.lit(0)).select(*cols).unionByName(right.withColumn("side", F.lit(1)).select(*cols))
    return (both.repartition("h", "i", "j").sortWithinPartitions("h", "i", "j", "side")
            .mapInArrow(each, "a binary, b binary, shared int"))


def _block_pairs(edge: DataFrame, similarity: float) -> DataFrame:
    """Pairs of leaders of one run in different blocks: each block's leaders
    meet those of every later block.  A block's leaders have met already."""
    blocks = edge.select("h", "block").distinct()
    meet = cut(blocks.withColumnRenamed("block", "i").join(blocks.withColumnRenamed("block", "j"), "h").filter("i < j"))
    left = edge.withColumnRenamed("block", "i").join(meet, ["h", "i"])
    right = edge.withColumnRenamed("block", "j").join(meet, ["h", "j"])
    return cut(_across(left, right, similarity))


def shared(drawn: DataFrame) -> DataFrame:
    """``h, node``, each once, where ``h`` occurs with several nodes.

    Rows are sorted by (h, node) over all partitions, so a sketch that a third
    of the nodes share is spread over many tasks; in its partition a row's
    neighbours tell.  The first and last sketch of a partition stay, as they
    may go on in the next."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, first = None, True  # the rows of the last sketch so far
        for b in batches:
            if held is not None:
                b = pa.Table.from_batches([held, b]).combine_chunks().to_batches()[0]
            h = b.column(0).to_numpy()
            node = b.column(1)
            new = np.ones(len(h), bool)  # not the row before once more
            new[1:] = (h[1:] != h[:-1]) | pc.not_equal(node.slice(1), node.slice(0, len(h) - 1)).to_numpy(zero_copy_only=False)
            b, h = b.filter(pa.array(new)), h[new]
            starts = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(starts, len(h)))
            keep = np.repeat(size > 1, size)
            if first:
                keep[:size[0]] = True
            last = int(starts[-1])
            if last:
                first = False
                yield b.slice(0, last).filter(pa.array(keep[:last]))
            elif len(h) > RUN_ROWS:  # one sketch over many batches: all but its last row can go on
                last = len(h) - 1
                yield b.slice(0, last)
                first = True
            held = b.slice(last)
        if held is not None:
            yield held

    return (drawn.repartitionByRange("h", "node").sortWithinPartitions("h", "node").select("h", "node")
            .mapInArrow(each, "h bigint, node binary"))


def buckets(drawn: DataFrame, nodes: DataFrame) -> DataFrame:
    """``h, node, size, sign`` for each sketch that several nodes share, from
    ``drawn`` (``h, node``) and ``nodes`` (``node, size, sign``)."""
    ship_package(nodes.sparkSession)
    old: list[str] = []
    rows = written(shared(drawn), "near-shared", old)
    made = written(rows.join(nodes.select("node", "size", "sign"), "node").select("h", "node", "size", "sign"), "near-buckets")
    drop_path(nodes.sparkSession, old[0])
    return made


def _passed(rows: DataFrame, similarity: float, firm: float = FIRM, run_rows: int = RUN_ROWS) -> DataFrame:
    """``a, b, shared, h`` of the passes over ``rows`` (``h, node, size, sign``
    and, where known, ``label``, a number of the node's class, and ``before``,
    see ``_before``).  About ``run_rows`` rows
    are a partition; the leaders of a run that spans several are passed again,
    and where that hardly lessens them, block by block.  ``h`` is the bucket
    in which a is b's only leader, else null."""
    found, left = [], rows.count()
    step = _leaders(similarity, firm)
    for name, plain in (("label", F.xxhash64("node")), ("before", F.lit(None).cast("array<bigint>"))):
        rows = rows if name in rows.columns else rows.withColumn(name, plain)
    while left:
        parts = max(left // run_rows, 1)
        dealt = rows.repartitionByRange(parts, "h", "node") if parts > 1 else rows.coalesce(1)
        out = written(dealt.sortWithinPartitions("h", "node").select("h", "node", "size", "sign", "label", "before")
                      .mapInArrow(step, "a binary, b binary, shared int, h bigint, size int, sign array<bigint>, label bigint, "
                                        "before array<bigint>, block int"), "near-out")
        found.append(out.filter("b IS NOT NULL").select("a", "b", "shared", "h"))
        if parts == 1:
            break
        edge = out.filter("b IS NULL").select("h", F.col("a").alias("node"), "size", "sign", "label", "before", "block")
        now = edge.count()
        if now > 0.8 * left:
            found.append(_block_pairs(edge, similarity).withColumn("h", F.lit(None).cast("bigint")))
            break
        rows, left = edge.drop("block"), now
    if not found:
        return rows.sparkSession.createDataFrame([], "a binary, b binary, shared int, h bigint")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs


def _single(pairs: DataFrame) -> DataFrame:
    return written(pairs.groupBy("a", "b").agg(F.max("shared").alias("shared")), "near-pairs")


def candidates(rows: DataFrame, similarity: float = SIMILARITY, run_rows: int = RUN_ROWS) -> DataFrame:
    """``a, b, shared``: pairs of ``node`` that share a sketch, a < b, and how
    many cells of their word signatures; linear in the number of nodes where
    they resemble each other.  ``rows`` are those of ``sketch_rows``, written."""
    return _single(_passed(buckets(rows.select(F.explode("sketch").alias("h"), "node"), signed(rows)), similarity, run_rows=run_rows))


def signed(rows: DataFrame) -> DataFrame:
    """``node, size, sign`` of each node that has words."""
    return rows.filter(F.size("sign") > 0).groupBy("node").agg(F.first("size").alias("size"), F.first("sign").alias("sign"))


def _few(keys: DataFrame, most: int = 100_000) -> DataFrame | None:
    """``keys`` (under 100 bytes a row) for broadcast, if at most ``most`` rows."""
    return F.broadcast(keys) if keys.limit(most + 1).count() <= most else None


def _led_again(rows: DataFrame, failed: DataFrame, labels: DataFrame, similarity: float, block_words: float = BLOCK_WORDS,
               bags_of: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``a, b, shared``, each pair once: the nodes ``failed`` (``h, node``) with
    all nodes of their buckets that they may resemble.  Nodes that ``labels``
    (``node, label``) has in one class need not meet.

    Buckets whose failed nodes are linked by other buckets are one group, and
    a node is in a group once, in however many of its buckets.  A group meets
    in blocks of about ``block_words`` words.  ``bags_of`` gives the word bags
    (``_bags``) of the groups' nodes: then only pairs with enough words in
    common are made."""
    spark, old = rows.sparkSession, []
    heads = failed.groupBy("h").agg(F.min("node").alias("a"))
    links = failed.join(heads, "h").filter("a <> node").select("a", F.col("node").alias("b")).distinct()
    joined = components(links).select("node", F.col("label").alias("g"))
    group = F.coalesce("g", "node").alias("g")
    leads = written(failed.select("node").distinct().join(joined, "node", "left").select("node", group, F.lit(True).alias("lead")), "near-leads", old)
    placed = written(heads.withColumnRenamed("a", "node").join(joined, "node", "left").select("h", group), "near-groups", old)
    few = _few(placed)
    members = rows.join(placed if few is None else few, "h").groupBy("g", "node").agg(F.first("size").alias("size"), F.first("sign").alias("sign"))
    members = (members.join(labels, "node", "left").join(leads, ["g", "node"], "left")
               .select("g", "node", "size", "sign", F.xxhash64(F.coalesce("label", "node")).alias("label"), F.coalesce("lead", F.lit(False)).alias("lead"))
               .withColumn("_salt", salted("node")))
    members = written(members, "near-members", old)
    count = {"nl": F.sum(F.col("lead").cast("int")), "wl": F.sum(F.when(F.col("lead"), F.col("size")).otherwise(0)),
             "nr": F.count(F.lit(1)), "wr": F.sum("size")}
    blocks = lambda words, n: F.greatest(F.least(F.ceil(F.col(words) / block_words), F.col(n)), F.lit(1)).cast("int")
    groups = known_groups(members, ["g"], count, {n: F.sum(n) for n in count})
    sized = members.join(groups.select("g", "_salt", blocks("wl", "nl").alias("ni"), blocks("wr", "nr").alias("nj")), ["g", "_salt"])
    if bags_of is None:
        sized = sized.withColumn("bag", F.lit(None).cast("array<int>"))
    else:
        sized = sized.join(bags_of(members), "node")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = sized.filter("lead").withColumn("i", place("ni")).withColumn("j", each("nj"))
    right = sized.withColumn("j", place("nj")).withColumn("i", each("ni"))
    pairs = written(_met(left, right, similarity, bags_of is not None), "near-met")
    for path in old:
        drop_path(spark, path)
    return pairs


def _bags(node_texts: DataFrame) -> DataFrame:
    """``node, bag``: hashes of the occurrence-labelled words of each text."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(1)
        for b in slices(batches):
            with np.errstate(over="ignore"):
                bags = [(_labelled(maker.word_hashes(words_of(t))) & np.uint64(BAG_BITS)).astype(np.int32) for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bags, pa.list_(pa.int32()))], names=["node", "bag"])

    return node_texts.select("node", "text").mapInArrow(each, "node binary, bag array<int>")


def _met(left: DataFrame, right: DataFrame, similarity: float, exact: bool) -> DataFrame:
    """``a, b, shared``, a < b: each row of ``left`` with each of ``right`` of
    the same blocks (g, i, j) and another label that it may resemble; both have
    ``node, size, sign, label, lead, bag``.  With ``exact`` a pair's bags have
    as many hashes in common as the similarity asks for: each word that the
    other lacks costs an edit, and hashes that are equal by chance only add
    pairs.  The left rows of two blocks are held by one task."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, nodes, signs, sizes, labels, bags, table = None, [], [], [], [], [], None
        a, b, shared = [], [], []
        known_words = np.zeros(BAG_BITS + 1, bool)

        def pair_rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(shared, pa.int32())],
                                             names=["a", "b", "shared"])
            for x in (a, b, shared):
                x.clear()
            return out

        for batch in slices(batches):
            ends, words = batch.column(9).offsets.to_numpy(), batch.column(9).values.to_numpy(zero_copy_only=False)
            rows = zip(*(batch.column(c).to_pylist() for c in range(8)), _signs(batch, 8), ends, ends[1:])
            for g, i, j, side, node, size, label, lead, sign, start, end in rows:
                if (g, i, j) != at:
                    at, nodes, signs, sizes, labels, bags, table = (g, i, j), [], [], [], [], [], None
                bag = words[start:end].astype(np.intp)
                if not side:
                    nodes.append(node), signs.append(sign.copy()), sizes.append(size), labels.append(label), bags.append(bag)
                    continue
                if not nodes:
                    continue
                if table is None:
                    table, known = (np.array(signs), np.array(sizes, np.int64)), np.array(labels, np.int64)
                share = _shares(*table, sign, size, similarity)
                known_words[bag] = True
                for k in np.flatnonzero((share >= LEAST_ALIKE) & (known != label)):
                    if lead and nodes[k] > node:
                        continue  # two that lead meet both ways
                    alike_cells = int(CELLS * share[k])
                    if exact:
                        longer, common = max(size, sizes[k]), int(np.count_nonzero(known_words[bags[k]]))
                        if longer - common > int((1 - similarity) * longer + 1e-9):
                            continue
                        alike_cells = CELLS * common // max(size + sizes[k] - common, 1)
                    a.append(min(nodes[k], node)), b.append(max(nodes[k], node)), shared.append(alike_cells)
                known_words[bag] = False
                if len(a) > PAIR_ROWS:
                    yield pair_rows()
            yield pair_rows()

    cols = ["g", "i", "j", "side", "node", "size", "label", "lead", "sign", "bag"]
    both = left.withColumn("side", F.lit(0)).select(*cols).unionByName(right.withColumn("side", F.lit(1)).select(*cols))
    return (both.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j", "side")
            .mapInArrow(each, "a binary, b binary, shared int"))


def verified(pairs: DataFrame, node_texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The pairs ``a, b`` whose words align; ``node_texts`` has ``node, text``.

    A leader's text is sent once to each (node, salt) of its pairs."""
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_words = None, []
        for b in slices(batches):
            keep = []
            for x, y in zip(texts(b.column(2)), texts(b.column(3))):
                if x is not last and x != last:
                    last, last_words = x, words_of(x)
                keep.append(alike(last_words, words_of(y), similarity))
            yield pa.RecordBatch.from_arrays(b.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    rows = pairs.select("a", "b").withColumn("_salt", salted("b"))
    leaders = rows.select("a", "_salt").distinct().join(node_texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    both = (rows.join(node_texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
            .join(leaders, ["a", "_salt"]).select("a", "b", "text_a", "text_b"))
    return written(both.mapInArrow(each, "a binary, b binary"), "near-links")


def classes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
            sketches: int = SKETCHES) -> DataFrame:
    """One row per input row: ``doc_id, text_hash, class_id`` (the smallest
    doc_id of its class), ``class_size`` (rows) and ``kept``, true for one row
    of each class.

    A class is a connected component of links: equal words, or candidates
    whose words align at ``similarity`` or more.  First every document's best
    candidate is aligned, then the best candidate of each two classes, then
    all candidates that lie in different classes still; so a group of
    thousands of near copies costs about one alignment each.  A node that is
    not of its only leader's class after that meets all nodes of the bucket
    itself that have enough words in common with it.

    A null text is empty; texts without a word are copies of each other.
    Texts of up to ``SHORT`` words are sketched by single words.  A null doc_id
    sorts after all others; identical rows are one document repeated,
    of which one can be kept.  An empty table gives an empty result.
    """
    spark, big = df.sparkSession, []
    rows = written(sketch_rows(df, id_col, text_col, sketches), "near-sketches", big)
    docs = (rows.groupBy("doc_id", "text_hash", "node").agg(F.count(F.lit(1)).alias("copies"))
            .withColumn("_salt", salted("doc_id", "text_hash")))
    docs = written(docs, "near-docs")
    order = F.struct(F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"), F.col("text_hash").alias("t"))
    heads = (docs.groupBy("node").agg(F.min(order).alias("head")))
    nodes = written(signed(rows), "near-nodes")
    bucket_rows = buckets(rows.select(F.explode("sketch").alias("h"), "node"), nodes)
    drop_path(spark, big[0])
    passed = _passed(bucket_rows, similarity)
    pairs = _single(passed)
    source = id_text(df, id_col, text_col).select(F.struct(F.col("doc_id").alias("i"), F.xxhash64("text").alias("t")).alias("_key"), "text")

    def texts_of(asked: DataFrame, most: int = 100_000) -> DataFrame:
        wanted = cut(heads.join(asked, "node").select("node", F.struct("head.i", "head.t").alias("_key")))
        few = _few(wanted, most)  # then no text but those asked for is shuffled
        found = source.join(wanted.hint("shuffle_hash") if few is None else few, "_key")
        return written(found.groupBy("node").agg(F.first("text").alias("text")), "near-texts")

    asked = written(_ends(pairs), "near-asked")
    node_texts = texts_of(asked, 5_000)  # small and large inputs are shuffled alike
    best = pairs.groupBy("b").agg(F.max(F.struct("shared", "a")).alias("top")).select(F.col("top.a").alias("a"), "b")
    roots = forest_roots(verified(best, node_texts, similarity))  # a document's best candidate: at most one parent
    labels = written(asked.join(roots, "node", "left").select("node", F.coalesce("label", "node").alias("label")), "near-labels")
    tried = written(best, "near-tried")
    labels = _merged(pairs, tried, labels, node_texts, similarity)
    failed = written(_apart(passed.filter("h IS NOT NULL"), labels, "h").select("h", F.col("b").alias("node")).distinct(), "near-failed")
    if failed.limit(1).count():
        found = []  # the texts of the failed nodes' buckets

        def bags_of(members: DataFrame) -> DataFrame:
            met = written(members.select("node").distinct(), "near-met-nodes")
            more = texts_of(met.join(asked, "node", "left_anti"))
            found.append(node_texts.join(met, "node", "left_semi").unionByName(more))
            return _bags(found[0])

        tried = written(tried.unionByName(pairs.select("a", "b")).distinct(), "near-tried")  # or of one class
        pairs = _led_again(bucket_rows, failed, labels, similarity, bags_of=bags_of)
        new = written(_ends(pairs).join(labels, "node", "left_anti"), "near-asked")
        labels = written(labels.unionByName(new.select("node", F.col("node").alias("label"))), "near-labels")
        labels = _merged(pairs, tried, labels, found[0], similarity)
    named = heads.join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))
    placed = docs.join(_spread(docs, named), ["node", "_salt"]).withColumn("_salt", salted("doc_id", "text_hash"))
    groups = known_groups(placed, ["label"], {"head": F.min(order), "n": F.sum("copies")},
                          {"head": F.min("head"), "class_size": F.sum("n")})
    return (placed.join(groups, ["label", "_salt"])
            .select("doc_id", "text_hash", F.col("head.i").alias("class_id"), "class_size",
                    F.col("head").eqNullSafe(order).alias("first"),
                    F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
            .select("doc_id", "text_hash", "class_id", "class_size", (F.col("first") & (F.col("copy") == 1)).alias("kept")))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()


def _merged(pairs: DataFrame, tried: DataFrame, labels: DataFrame, node_texts: DataFrame, similarity: float) -> DataFrame:
    """``labels`` after the alignment of all ``pairs`` of different classes but
    those ``tried`` before: the best pair of each two classes, then the rest."""
    for last in (False, True):
        apart = _apart(pairs.join(tried, ["a", "b"], "left_anti"), labels)
        if not last:
            top = F.max(F.struct("shared", "a", "b", "la", "lb")).alias("top")
            apart = apart.groupBy(F.least("la", "lb"), F.greatest("la", "lb")).agg(top).select("top.*")
        apart = written(apart, "near-apart")
        if not last:
            tried = written(tried.unionByName(apart.select("a", "b")), "near-tried")
        links = verified(apart, node_texts, similarity)
        if links.limit(1).count():  # classes that are linked become one
            joined = components(apart.join(links, ["a", "b"]).select(F.col("la").alias("a"), F.col("lb").alias("b")).distinct())
            joined = joined.select(F.col("node").alias("label"), F.col("label").alias("joined"))
            labels = written(labels.join(joined, "label", "left").select("node", F.coalesce("joined", "label").alias("label")), "near-labels")
    return labels


def _apart(pairs: DataFrame, labels: DataFrame, keep: str = "shared") -> DataFrame:
    """Pairs with the class of each end, ``la`` and ``lb``, where they differ;
    the class of a leader is sent to each (leader, salt) of its pairs."""
    rows = (pairs.join(labels.select(F.col("node").alias("b"), F.col("label").alias("lb")), "b", "left").withColumn("_salt", salted("b")))
    ends = rows.select("a", "_salt").distinct().join(labels.select(F.col("node").alias("a"), F.col("label").alias("la")), "a", "left")
    return (rows.join(ends, ["a", "_salt"]).select("a", "b", keep, F.coalesce("la", "a").alias("la"), F.coalesce("lb", "b").alias("lb"))
            .filter("la <> lb"))


def _spread(docs: DataFrame, named: DataFrame) -> DataFrame:
    """``node, _salt, label`` for each (node, _salt) that occurs in ``docs``."""
    return docs.select("node", "_salt").distinct().join(named, "node")
