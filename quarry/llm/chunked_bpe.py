"""Byte-level BPE: overlapping-chunk encoding, and decoding to raw bytes.

Long texts are dealt out as overlapping chunks that are pre-tokenised in
parallel; neighbours are stitched at the first pre-token boundary that both
found, and each chunk then encodes its own piece between two such points.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_size, cut, id_text, ship_package, slices, texts
from quarry.llm.merges import NEVER as _NEVER
from quarry.llm.merges import PairMerges

#: The pattern whose pre-tokens can be stitched, and split at blanks: fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: No pre-token can begin or end differently for characters this far behind it.
LOOKAHEAD = 4
#: A blank between two other characters: pre-tokens never cross into such a blank.
_RESYNC = re.compile(r"(?<=\S) (?=\S)")
_BLANK_RUN = re.compile(r"\s | \s")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a vocabulary file: a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


class Encoder:
    """Encodes texts by merge ranks, each match of ``pattern`` separately.

    Ids of words that recur are kept in two generations of at most
    ``cache_words`` entries each, so memory stays bounded.  Words that are new
    in a batch are merged together, a round of merges for all at a time.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, cache_words: int = 120_000):
        self.ranks, self.cache_words = ranks, cache_words
        self.matches = regex.compile(pattern)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}  # other pre-tokens
        self.by_words = pattern == PATTERN
        self.marks = {c: ranks[c.encode()].to_bytes(4, "little") for c in ".,"}
        self.byte_ids = np.array([ranks[bytes([k])] for k in range(256)], np.int64)
        self.pairs = PairMerges({(ranks[t[:k]], ranks[t[k:]]): (r, r) for t, r in ranks.items()
                                 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks})
        every = np.arange(256)
        self.byte_pairs = self.pairs.rank(self.byte_ids[np.repeat(every, 256)], self.byte_ids[np.tile(every, 256)])

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each pre-token, as little-endian 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        by_length: dict[int, list[int]] = {}
        for k, p in enumerate(pieces):
            rank = self.ranks.get(p)
            if rank is not None:
                out[k] = rank.to_bytes(4, "little")
            elif len(p) > 48:
                out[k] = np.array(self.merge(p), "<i4").tobytes()
            else:
                by_length.setdefault(len(p), []).append(k)
        for length, rows in by_length.items():
            data = np.frombuffer(b"".join(pieces[k] for k in rows), np.uint8).reshape(-1, length).astype(np.int64)
            for k, ids in zip(rows, self.pairs.run(self.byte_ids[data], self.byte_pairs[data[:, :-1] << 8 | data[:, 1:]])):
                out[k] = ids
        return out

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: lowest rank first, leftmost among equals."""
        rank = self.ranks.get(piece)
        if rank is not None:
            return [rank]
        if len(piece) > 128:
            return self._merge_long(piece)
        get = self.ranks.get
        cuts = list(range(len(piece) + 1))
        pairs = [get(piece[i:i + 2], _NEVER) for i in range(len(piece) - 1)]
        while pairs:
            least = min(pairs)
            if least == _NEVER:
                break
            i = pairs.index(least)
            del cuts[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = get(piece[cuts[i]:cuts[i + 2]], _NEVER)
            if i:
                pairs[i - 1] = get(piece[cuts[i - 1]:cuts[i + 1]], _NEVER)
        return [self.ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:])]

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same by a heap: a pre-token may be as long as a text."""
        n, get = len(piece), self.ranks.get
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # by start of a part; 0: merged away
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, z = heapq.heappop(heap)
            mid = end[i]
            if not mid or mid >= n or not end[mid] or end[mid] != z:
                continue  # one of the two parts has been merged since
            end[i], end[mid] = z, 0
            if z < n:
                before[z] = i
                if (r := get(piece[i:end[z]])) is not None:
                    heapq.heappush(heap, (r, i, end[z]))
            if before[i] >= 0 and (r := get(piece[before[i]:z])) is not None:
                heapq.heappush(heap, (r, before[i], z))
        return [self.ranks[piece[i:end[i]]] for i in range(n) if end[i]]

    def _prepare(self, parts: list[str]) -> None:
        """Merge the short pre-tokens of many texts together."""
        if len(self.signs) >= self.cache_words // 4:
            self.signs.clear()
        new = list({t for p in parts for t in self.matches.findall(p) if len(t) <= 32}.difference(self.signs))
        self.signs.update(zip(new, self.merge_many([t.encode("utf-8", "surrogatepass") for t in new])))

    def _general(self, part: str) -> bytes:
        """Ids of any text, by the pattern."""
        out = []
        for token in self.matches.findall(part):
            ids = self.signs.get(token)
            if ids is None:
                ids = np.array(self.merge(token.encode("utf-8", "surrogatepass")), "<i4").tobytes()
                if len(token) <= 32 and len(self.signs) < self.cache_words // 2:
                    self.signs[token] = ids
            out.append(ids)
        return b"".join(out)

    def _learn(self, new: set[str]) -> None:
        """Put the ids of a blank and each word into the young generation:
        words of letters (and one stop or comma) by merging them together."""
        young, old = self.young, self.old
        plain, stopped, odd = set(), [], []
        for w in new:
            ids = old.get(w)
            if ids is not None:
                young[w] = ids
            elif w.isalpha():
                plain.add(w)
            elif w[-1:] in self.marks and w[:-1].isalpha():
                stopped.append(w)
                if w[:-1] not in young:
                    plain.add(w[:-1])
            else:
                odd.append(w)
        self._prepare([" " + w for w in odd])
        for w in odd:
            young[w] = self._general(" " + w)
        words = list(plain)
        young.update(zip(words, self.merge_many([b" " + w.encode() for w in words])))
        for w in stopped:
            young[w] = young[w[:-1]] + self.marks[w[-1]]

    def encode_many(self, rows: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if not self.by_words:
            return list(map(self._general, rows))
        if len(self.young) >= self.cache_words:
            self.old, self.young = self.young, {}
        split = [_RESYNC.split(t) if _BLANK_RUN.search(t) else t.split(" ") for t in rows]
        firsts = [words.pop(0) for words in split]
        new = set().union(*split).difference(self.young)
        if new:
            self._learn(new)
        self._prepare(firsts)
        get = self.young.__getitem__
        return [self._general(first) + b"".join(map(get, words)) for first, words in zip(firsts, split)]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def boundaries(self, text: str) -> np.ndarray:
        """Ends of the pre-tokens of ``text``, with 0, in code points."""
        return np.array([0, *(m.end() for m in self.matches.finditer(text))], np.int64)


_LOADED: dict[tuple[int, str], Encoder] = {}


def _encoder(data: bytes, pattern: str) -> Encoder:
    key = hash(data), pattern
    if key not in _LOADED:
        _LOADED[key] = Encoder(read_ranks(data), pattern)
    return _LOADED[key]


def _lists(rows: list[bytes]) -> pa.Array:
    """An Arrow list<int> column from rows of little-endian 32-bit ids."""
    ends = np.cumsum([0, *map(len, rows)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(rows), "<i4")))


def encode(df: DataFrame, ranks_path: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text",
           chunk_chars: int = 32_768, overlap: int = 2_048) -> DataFrame:
    """One row per input row: ``doc_id`` and ``ids`` (array of int).

    The vocabulary file is read on the driver and broadcast (its size is that
    of the file, whatever the data).  Texts beyond ``chunk_chars + overlap``
    code points are encoded in chunks (for another pattern than ``PATTERN``,
    whole); one whose neighbouring chunks share no
    boundary in the overlap (a pre-token longer than that) is encoded whole.
    A null or empty text has no ids.  Null and repeated ids, and repeated
    rows, give a row each; an empty table gives an empty result.
    """
    spark = df.sparkSession
    ship_package(spark)
    with open(ranks_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    if not LOOKAHEAD < overlap <= chunk_chars:
        raise ValueError("overlap must be above the look-ahead and at most chunk_chars")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocabulary.value, pattern)
        for b in by_size(batches, 1):
            rows = coder.encode_many(texts(b.column(1)))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _lists(rows)], names=[*b.schema.names[:-1], "ids"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 8):
            for k, (i, h, t) in enumerate(zip(*(b.column(c).to_pylist() for c in range(3)))):
                starts = range(0, max(len(t) - overlap, 1), chunk_chars)
                parts = [t[s:s + chunk_chars + overlap] for s in starts]
                for at in range(0, len(parts), 64):
                    some = parts[at:at + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([i] * len(some), pa.int64()), pa.array([h] * len(some), pa.binary()),
                         pa.array(range(at, at + len(some)), pa.int32()), pa.array([len(parts)] * len(some), pa.int32()),
                         pa.array(some, pa.string())], names=["doc_id", "digest", "chunk", "n_chunks", "part"])

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocabulary.value, pattern)
        for b in slices(batches, 64):
            head, tail = [], []
            for t in texts(b.column(4)):
                ends = coder.boundaries(t)
                ends = ends[ends <= len(t) - LOOKAHEAD]
                head.append(ends[ends < overlap].tolist())
                # a piece must not end in blanks: what follows them decides how they split
                tail.append([int(e) - chunk_chars for e in ends[ends >= chunk_chars] if not t[e - 1].isspace()])
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(head, pa.list_(pa.int32())),
                                              pa.array(tail, pa.list_(pa.int32()))],
                                             names=["doc_id", "digest", "chunk", "head", "tail"])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _encoder(vocabulary.value, pattern)
        for b in by_size(batches, 4):
            rows = coder.encode_many([t[a:z] for t, a, z in zip(texts(b.column(4)), b.column(5).to_pylist(), b.column(6).to_pylist())])
            yield pa.RecordBatch.from_arrays([*b.columns[:4], _lists(rows)], names=["doc_id", "digest", "chunk", "copies", "ids"])

    src = id_text(df, id_col, text_col)
    is_long = (F.length("text") > chunk_chars + overlap) & F.lit(pattern == PATTERN)
    short = src.filter(~is_long).mapInArrow(whole, "doc_id bigint, ids array<int>")

    long = src.filter(is_long).select("doc_id", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    key = ["doc_id", "digest"]
    dealt = (long.mapInArrow(chunks, "doc_id bigint, digest binary, chunk int, n_chunks int, part string")
             .groupBy(*key, "chunk").agg(F.first("n_chunks").alias("n_chunks"), F.first("part").alias("part"),
                                         F.count(F.lit(1)).alias("copies")))
    dealt = cut(dealt)
    found = cut(dealt.select(*key, "chunk", "n_chunks", "part")
                .mapInArrow(edges, "doc_id bigint, digest binary, chunk int, head array<int>, tail array<int>"))
    # a null doc_id must meet its own neighbours, so the key is one non-null struct
    named = found.withColumn("_key", F.struct(*key))
    after = named.select("_key", (F.col("chunk") - 1).alias("chunk"), F.col("head").alias("next_head"))
    meets = (named.join(after, ["_key", "chunk"])
             .select("_key", "chunk", F.array_min(F.array_intersect("tail", "next_head")).alias("meet")))
    meets = cut(meets)
    apart = meets.filter("meet IS NULL").select("_key").distinct()
    begins = meets.select("_key", (F.col("chunk") + 1).alias("chunk"), F.col("meet").alias("begin"))
    ends = meets.select("_key", "chunk", (F.col("meet") + chunk_chars).alias("end"))
    stitched = (dealt.withColumn("_key", F.struct(*key)).join(apart, "_key", "left_anti")
                .join(begins, ["_key", "chunk"], "left").join(ends, ["_key", "chunk"], "left")
                .select(*key, "chunk", "copies", "part", F.coalesce("begin", F.lit(0)).alias("begin"),
                        F.coalesce("end", F.length("part")).alias("end"))
                .mapInArrow(pieces, "doc_id bigint, digest binary, chunk int, copies bigint, ids array<int>")
                .groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("chunk", "ids"))).alias("parts"),
                                   F.first("copies").alias("copies"))
                .select("doc_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"),
                        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"))
                .select("doc_id", "ids"))
    rest = (long.withColumn("_key", F.struct(*key)).join(apart, "_key", "left_semi")
            .select("doc_id", "text").mapInArrow(whole, "doc_id bigint, ids array<int>"))
    return short.unionByName(stitched).unionByName(rest)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """``df`` with ``ids_col`` replaced by ``bytes_col``: the tokens' raw bytes
    joined (null ids: null).  Bytes need not be whole characters; text is
    recovered by decoding the joined bytes as UTF-8.  An id that the
    vocabulary lacks raises."""
    spark = df.sparkSession
    ship_package(spark)
    with open(ranks_path, "rb") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())
    names = [c for c in df.columns if c not in (ids_col, bytes_col)]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = read_ranks(vocabulary.value)
        size = max(ranks.values()) + 1
        length, start = np.full(size, -1, np.int64), np.zeros(size, np.int64)
        data, at = [], 0
        for token, i in ranks.items():
            length[i], start[i] = len(token), at
            data.append(token)
            at += len(token)
        store = np.frombuffer(b"".join(data), np.uint8)
        for b in slices(batches, 128):
            out = []
            for ids in b.column(len(names)):
                if not ids.is_valid:
                    out.append(None)
                    continue
                ids = ids.values.to_numpy(zero_copy_only=False).astype(np.int64)
                if len(ids) and (ids.min() < 0 or ids.max() >= size or (length[ids] < 0).any()):
                    raise ValueError("an id that the vocabulary lacks")
                n = length[ids]
                ends = np.concatenate([[0], np.cumsum(n)])
                out.append(store[np.repeat(start[ids] - ends[:-1], n) + np.arange(ends[-1])].tobytes())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(out, pa.binary())], names=[*names, bytes_col])

    src = df.select(*names, ids_col)
    schema = src.drop(ids_col).schema.add(bytes_col, "binary")
    return src.mapInArrow(join, schema)
