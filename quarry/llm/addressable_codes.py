"""Token files with direct access: variable-byte codes split into levels.

An id is cut into 8-bit chunks, lowest first.  Level k holds the k-th chunk of
every id that has one, a bitmap that says which of them go on at level k + 1,
and a rank directory (ones before every 512th bit).  The place of an id's next
chunk is the rank of its bit, so any token is read with one step per level and
no block is decoded.

Documents are range-partitioned by id and sorted, tokenised and coded in one
pass; a row of the written table is a segment of whole documents.  A small
directory table holds how many ids lie before each shard (sorted partition).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quarry.llm.common import by_size, id_text, ship_package
from quarry.llm.word_tokens import binary, parts_of, word_tokens

SEGMENT = ("shard int, segment int, before bigint, n_ids bigint, doc_ids array<bigint>, ends array<bigint>, "
           "chunks array<binary>, more array<binary>, ranks array<binary>")
BLOCK = 512  # bits between two entries of a rank directory
CELL = 1 << 20  # global positions that a segment look-up takes together


def encode_levels(ids: np.ndarray) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """``chunks, more, ranks`` of each level, for unsigned 32-bit ids."""
    chunks, more, ranks = [], [], []
    left = ids.astype(np.uint32)
    while True:
        chunks.append((left & 0xFF).astype(np.uint8).tobytes())
        left = left >> 8
        bits = left > 0
        if not bits.any():
            return chunks, more, ranks
        packed = np.packbits(np.append(bits, np.zeros(-len(bits) % BLOCK, bool)), bitorder="little")
        ones = np.bitwise_count(packed.view("<u8")).astype(np.int64).reshape(-1, BLOCK // 64).sum(axis=1)
        more.append(packed.tobytes())
        ranks.append((np.cumsum(ones) - ones).astype("<u4").tobytes())
        left = left[bits]


class Levels:
    """Reads ids of one segment."""

    def __init__(self, chunks: list[bytes], more: list[bytes], ranks: list[bytes]):
        self.chunks = [np.frombuffer(x, np.uint8) for x in chunks]
        self.more = [np.frombuffer(x, "<u8") for x in more]
        self.ranks = [np.frombuffer(x, "<u4") for x in ranks]

    def _rank(self, level: int, at: np.ndarray) -> np.ndarray:
        """Ones before the bits ``at``."""
        bits, per = self.more[level], BLOCK // 64
        out = self.ranks[level][at // BLOCK].astype(np.int64)
        word, mask = at >> 6, (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        for k in range(per):
            here = at // BLOCK * per + k
            ones = np.where(here < word, bits[here], np.where(here == word, bits[here] & mask, np.uint64(0)))
            out += np.bitwise_count(ones)
        return out

    def get(self, at: np.ndarray) -> np.ndarray:
        """The ids at any positions, by rank alone."""
        at = np.asarray(at, np.int64)
        out = self.chunks[0][at].astype(np.uint32)
        who = np.arange(len(at))
        for level in range(len(self.more)):
            on = (self.more[level][at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            who, at = who[on], self._rank(level, at[on])
            out[who] |= self.chunks[level + 1][at].astype(np.uint32) << np.uint32(8 * (level + 1))
        return out

    def slice(self, start: int, end: int) -> np.ndarray:
        """The ids of one range: a rank for its start at each level."""
        out = self.chunks[0][start:end].astype(np.uint32)
        who = np.arange(end - start)
        for level in range(len(self.more)):
            if not len(who):
                break
            raw = self.more[level].view(np.uint8)
            on = np.unpackbits(raw[start // 8:-(-end // 8)], bitorder="little")[start % 8:][:end - start].astype(bool)
            who = who[on]
            start = int(self._rank(level, np.array([start]))[0])
            end = start + len(who)
            out[who] |= self.chunks[level + 1][start:end].astype(np.uint32) << np.uint32(8 * (level + 1))
        return out


def write(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text",
          segment_ids: int = 1 << 20) -> None:
    """Encode all texts and write the token files under ``path`` (of any file
    system Spark writes to): ``segments`` and ``directory``.

    Documents lie in ascending id order, null ids first; rows of one id follow
    each other by text hash, and equal rows all stay.  A null or empty text is
    ``end_id`` alone.  Only the two named columns are read, so other columns
    never clash.  A segment takes whole documents until it holds
    ``segment_ids``; a longer document is a segment of its own.  An empty table
    writes empty tables.
    """
    spark = df.sparkSession
    ship_package(spark)
    with open(tokenizer_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = word_tokens(vocabulary.value), TaskContext.get().partitionId()
        segment = before = held = 0
        docs: list[pa.Array] = []
        parts: list[np.ndarray] = []
        ends: list[np.ndarray] = []

        def row() -> pa.RecordBatch:
            nonlocal segment, before, held, docs, parts, ends
            levels = encode_levels(np.concatenate(parts))
            one = [pa.array([x], k) for x, k in ((shard, pa.int32()), (segment, pa.int32()), (before, pa.int64()), (held, pa.int64()))]
            named = pa.concat_arrays(docs)
            one += [pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named),
                    pa.array([np.concatenate(ends)], pa.list_(pa.int64())),
                    *(pa.array([x], pa.list_(pa.binary())) for x in levels)]
            segment, before, held, docs, parts, ends = segment + 1, before + held, 0, [], [], []
            return pa.RecordBatch.from_arrays(one, names=[c.split()[0] for c in SEGMENT.split(", ")])

        for b in by_size(batches, 1, 1 << 23, 8192):
            bounds, raw = parts_of(coder.column(b.column(1), end))
            bounds, ids = bounds.astype(np.int64) // 4, raw.view("<u4")
            at = 0
            while at < b.num_rows:  # the documents that still fit, one at least in an empty segment
                fit = int(np.searchsorted(bounds, bounds[at] + segment_ids - held, "right")) - 1
                till = max(fit, at + (not held))
                if till > at:
                    docs.append(b.column(0).slice(at, till - at))
                    parts.append(ids[bounds[at]:bounds[till]])
                    ends.append(bounds[at + 1:till + 1] - bounds[at] + held)
                    held += int(bounds[till] - bounds[at])
                    at = till
                if at < b.num_rows:
                    yield row()
        if held:
            yield row()

    rows = id_text(df, id_col, text_col)
    # the last key tells equal rows apart, so that even they are dealt out
    keys = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    rows = rows.select("*", keys[1].alias("_h"), keys[2].alias("_n"))
    order = [keys[0], F.col("_h"), F.col("_n")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(each, SEGMENT).write.parquet(f"{path}/segments")
    shards = spark.read.parquet(f"{path}/segments").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    shards.select("shard", F.coalesce(F.sum("n_ids").over(upto), F.lit(0)).alias("first")).write.parquet(f"{path}/directory")


def segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``first``, the ids of all segments before."""
    found = spark.read.schema(SEGMENT).parquet(f"{path}/segments")
    return (found.join(spark.read.schema("shard int, first bigint").parquet(f"{path}/directory"), "shard")
            .withColumn("first", F.col("first") + F.col("before")))


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, ids``: every document's ids (little-endian 32-bit) and
    how many ids of other documents lie before it."""
    ship_package(spark)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                first, named, ends, *levels = (b.column(i)[k] for i in range(6))
                bounds = np.append(0, ends.values.to_numpy())
                held = Levels(*(x.as_py() for x in levels))
                at = 0
                while at < len(named.values):  # about 4 MB of ids a batch
                    till = max(int(np.searchsorted(bounds, bounds[at] + (1 << 20), "right")) - 1, at + 1)
                    ids = held.slice(int(bounds[at]), int(bounds[till]))
                    yield pa.RecordBatch.from_arrays(
                        [named.values.slice(at, till - at), pa.array(bounds[at:till] + first.as_py()),
                         binary((bounds[at:till + 1] - bounds[at]) * 4, ids.view(np.uint8))], names=["doc_id", "start", "ids"])
                    at = till

    return (segments(spark, path).select("first", "doc_ids", "ends", "chunks", "more", "ranks")
            .mapInArrow(each, "doc_id bigint, start bigint, ids binary"))


def access(spark: SparkSession, path: str, positions: DataFrame, position_col: str = "position") -> DataFrame:
    """``position, token_id``: the token at each distinct global position, read
    by rank without decoding what lies around it.  Null positions and those
    outside the files give no row."""
    ship_package(spark)
    held = segments(spark, path)
    cells = held.select("shard", "segment", "first", "n_ids", F.explode(F.expr(
        f"sequence(first div {CELL}, (first + n_ids - 1) div {CELL})")).alias("cell"))
    asked = positions.select(F.col(position_col).cast("bigint").alias("position")).filter("position >= 0").distinct()
    asked = (asked.withColumn("cell", F.expr(f"position div {CELL}")).join(cells, "cell")
             .filter("position >= first AND position < first + n_ids")
             .groupBy("shard", "segment").agg(F.collect_list(F.expr("position - first")).alias("at")))  # at most a segment's ids

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                first, at, *levels = (b.column(i)[k] for i in range(5))
                at = at.values.to_numpy()
                found = Levels(*(x.as_py() for x in levels)).get(at)
                yield pa.RecordBatch.from_arrays([pa.array(at + first.as_py()), pa.array(found.astype(np.int64))], names=["position", "token_id"])

    return (held.join(asked, ["shard", "segment"]).select("first", "at", "chunks", "more", "ranks")
            .mapInArrow(each, "position bigint, token_id bigint"))
