"""Lexical retrieval packing: each window is a seed document followed by its
nearest unused neighbours, found by BM25.

Documents are tokenised once into a written table.  Its scan splits are the
shards of the inverted index, so nothing is shuffled; only the document
frequencies (at most one number for each token of the vocabulary) are global.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_size, id_text, ship_package
from quarry.llm.word_tokens import word_tokens
from quarry.session import scratch_path

PIECES = ("doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
          "offset bigint, seed_id bigint, token_ids binary")
K1, B = 1.2, 0.75


def tokenise(df: DataFrame, tokenizer_path: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: little-endian 32-bit token ids with ``end_id`` last."""
    spark = df.sparkSession
    ship_package(spark)
    with open(tokenizer_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_tokens(vocabulary.value)
        for b in by_size(batches, 1, 1 << 23, 8192):
            yield pa.RecordBatch.from_arrays([b.column(0), coder.column(b.column(1), end)], names=["doc_id", "ids"])

    return id_text(df, id_col, text_col).mapInArrow(each, "doc_id bigint, ids binary")


def document_frequency(tokens: DataFrame) -> DataFrame:
    """``term, df, docs, size``: documents that hold each token; the row of
    term -1 has the number of documents and of tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, np.int64)
        docs = size = 0
        here = np.zeros(1 << 16, bool)
        for b in batches:
            for ids in b.column(0).to_pylist():
                ids = np.frombuffer(ids, "<u4")
                if len(ids) and ids.max() >= len(seen):
                    more = int(ids.max()) + (1 << 16) - len(seen)
                    seen, here = np.concatenate([seen, np.zeros(more, np.int64)]), np.concatenate([here, np.zeros(more, bool)])
                here[ids] = True
                terms = np.flatnonzero(here)
                seen[terms] += 1
                here[terms] = False
                docs += 1
                size += len(ids)
        terms = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array([*terms, -1], pa.int64()), pa.array([*seen[terms], docs], pa.int64()),
                                          pa.array([0] * len(terms) + [size], pa.int64())], names=["term", "df", "size"])

    return (tokens.select("ids").mapInArrow(count, "term bigint, df bigint, size bigint")
            .groupBy("term").agg(F.sum("df").alias("df"), F.sum("size").alias("size")))


class ShardIndex:
    """BM25 inverted index of one shard's document tails."""

    def __init__(self, tails: list[np.ndarray], idf: np.ndarray, mean: float, query_terms: int):
        self.size = len(tails)
        per = [np.unique(t, return_counts=True) for t in tails]
        terms = np.concatenate([p[0] for p in per]).astype(np.int64)
        tf = np.concatenate([p[1] for p in per]).astype(np.float32)
        sizes = np.array([len(p[0]) for p in per])
        doc = np.repeat(np.arange(self.size, dtype=np.int32), sizes)
        length = np.array([len(t) for t in tails], np.float32)
        weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[doc] / mean))
        order = np.argsort(terms, kind="stable")
        self.doc, self.weight = doc[order], weight[order]
        at = np.searchsorted(terms[order], np.arange(len(idf) + 1))
        self.start, self.end = at[:-1], at[1:]
        # a seed's query: its rarest terms, the most telling ones
        self.query = [p[0][np.argsort(-idf[p[0]], kind="stable")[:query_terms]].astype(np.int64) for p in per]

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """Unused documents that share a query term, best first."""
        q = self.query[seed]
        spans = [slice(a, z) for a, z in zip(self.start[q], self.end[q]) if z - a > 1]
        if not spans:
            return np.empty(0, np.int64)
        score = np.bincount(np.concatenate([self.doc[s] for s in spans]),
                            np.concatenate([self.weight[s] for s in spans]), self.size)
        score *= unused
        near = np.flatnonzero(score)
        return near[np.argsort(-score[near], kind="stable")]


class Packer:
    """Fills windows of ``window`` tokens, one shard after the other; the open
    window goes on into the next shard, and the last one is cut at powers of
    two, so that no sequence needs padding."""

    def __init__(self, window: int, first_id: int):
        self.window, self.sequence = window, first_id
        self.rows: list[tuple] = []
        self.open: list[tuple] = []  # (doc, start, ids, doc_tokens) of the open window
        self.room = window
        self.seed = None

    def _close(self) -> None:
        at = 0
        for doc, start, ids, total in self.open:
            self.rows.append((doc, start, len(ids), total, self.sequence, at, self.seed, ids.tobytes()))
            at += len(ids)
        self.sequence, self.open, self.room, self.seed = self.sequence + 1, [], self.window, None

    def place(self, doc, start: int, ids: np.ndarray, total: int) -> bool:
        """Add a document's rest; true if it was cut by, or filled, the window
        (a cut one's remainder opens the next)."""
        closed = False
        while len(ids):
            if not self.open:
                self.seed = doc
            part = ids[:self.room]
            self.open.append((doc, start, part, total))
            self.room -= len(part)
            start, ids = start + len(part), ids[len(part):]
            if not self.room:
                self._close()
                closed = True
        return closed

    def shard(self, docs: list[tuple], idf: np.ndarray, mean: float, query_terms: int) -> None:
        tails = []
        for doc, ids in docs:
            whole = len(ids) // self.window * self.window
            for at in range(0, whole, self.window):  # full windows of a long document stand alone
                self.rows.append((doc, at, self.window, len(ids), self.sequence, 0, doc, ids[at:at + self.window].tobytes()))
                self.sequence += 1
            if whole < len(ids):
                tails.append((doc, whole, ids[whole:], len(ids)))
        if not tails:
            return
        index = ShardIndex([t[2] for t in tails], idf, mean, query_terms)
        sizes = np.array([len(t[2]) for t in tails])
        unused = np.ones(len(tails), bool)
        next_seed = 0
        seed = None
        while True:
            if seed is None:
                while next_seed < len(tails) and not unused[next_seed]:
                    next_seed += 1
                if next_seed == len(tails):
                    return
                seed = next_seed
                unused[seed] = False
                if self.place(*tails[seed]) and not self.open:
                    seed = None
                    continue
            near = index.neighbours(seed, unused)
            cut = None
            for k in near:  # whole neighbours first, nearest first
                if sizes[k] <= self.room:
                    unused[k] = False
                    if self.place(*tails[k]):
                        break
                elif cut is None:
                    cut = k
            if not self.open:
                seed = None
            elif cut is not None:  # the nearest that is too long fills the rest and seeds the next window
                unused[cut] = False
                self.place(*tails[cut])
                seed = cut if self.open else None
            else:
                seed = None  # no neighbour is left: the next document goes on in this window

    def finish(self) -> None:
        """Cut what is open at powers of two."""
        parts, self.open, self.room = self.open, [], self.window
        left = sum(len(p[2]) for p in parts)
        size = self.window
        while left:
            while size > left:
                size //= 2
            self.room = size
            while parts and self.room:
                doc, start, ids, total = parts.pop(0)
                if not self.open:
                    self.seed = doc
                part, rest = ids[:self.room], ids[self.room:]
                self.open.append((doc, start, part, total))
                self.room -= len(part)
                if len(rest):
                    parts.insert(0, (doc, start + len(part), rest, total))
            self._close()
            left -= size


def pack_tokens(tokens: DataFrame, window: int = 2048, shard_docs: int = 2048, shard_tokens: int = 4_000_000,
                query_terms: int = 32) -> DataFrame:
    """Pack ``doc_id, ids`` (as ``tokenise`` gives them; read twice, so a
    written table) into ``PIECES`` rows."""
    if window & (window - 1):
        raise ValueError("window must be a power of two")
    spark = tokens.sparkSession
    ship_package(spark)
    stats = {r["term"]: (r["df"], r["size"]) for r in document_frequency(tokens).collect()}  # at most the vocabulary
    docs, size = stats.pop(-1, (0, 0))
    df = np.zeros(max(stats, default=-1) + 1, np.float64)
    for term, (n, _) in stats.items():
        df[term] = n
    known = spark.sparkContext.broadcast((np.log1p((docs - df + 0.5) / (df + 0.5)).astype(np.float32), size / max(docs, 1)))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idf, mean = known.value
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        names = [f.split()[0] for f in PIECES.split(", ")]

        def out() -> Iterator[pa.RecordBatch]:
            rows, packer.rows = packer.rows, []
            for at in range(0, len(rows), 2048):
                cols = list(zip(*rows[at:at + 2048]))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:-1]), pa.array(cols[-1], pa.binary())],
                                                 names=names)

        shard, held = [], 0
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard.append((doc, np.frombuffer(ids, "<u4")))
                held += len(ids) // 4
                if len(shard) >= shard_docs or held >= shard_tokens:
                    packer.shard(shard, idf, mean, query_terms)
                    shard, held = [], 0
                    yield from out()
        packer.shard(shard, idf, mean, query_terms)
        packer.finish()
        yield from out()

    return tokens.select("doc_id", "ids").mapInArrow(each, PIECES)


def pack(df: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048, id_col: str = "doc_id",
         text_col: str = "text", shard_docs: int = 2048, query_terms: int = 32) -> DataFrame:
    """Pack all documents into sequences of at most ``window`` tokens.

    One row per piece: ``doc_id``, ``start`` (tokens of the document before
    it), ``length``, ``doc_tokens``, ``sequence_id``, ``offset`` in the
    sequence, ``seed_id`` (the sequence's seed document) and ``token_ids``
    (little-endian 32-bit).  Sequences are full but for at most
    ``log2(window)`` of each task, whose sizes are powers of two.

    A null or empty text is the end id alone.  Repeated rows and ids are
    packed row by row, null ids are kept; an empty table gives no pieces.  A
    text longer than a window fills windows of its own, and its rest is packed
    with neighbours.  A shard holds ``shard_docs`` documents of one scan
    split; a seed asks with its ``query_terms`` rarest tokens.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "packing-tokens")
    tokenise(df, tokenizer_path, end_id, id_col, text_col).write.option("compression", "zstd").parquet(path)
    return pack_tokens(spark.read.parquet(path), window, shard_docs, query_terms=query_terms)
