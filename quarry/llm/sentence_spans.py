"""Substring dedup by sliding sentence spans: every run of several
consecutive sentences is hashed, runs are joined over all documents, and the
sentences of all but a run's first occurrence are removed.

A passage may begin and end in the middle of sentences, so sentences are cut
into clauses of at most ``WINDOW`` words, at words that the words around them
choose (winnowing, sentence ends first): the same words are cut alike wherever
they stand.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_size, drop_path, id_text, ship_package, slices, texts, written
from quarry.session import scratch_path

SPAN_ROWS = "doc_id bigint, tag bigint, tag2 bigint, begin int, end int, h bigint, check int"
#: A clause has at most so many words.
WINDOW = 10
#: A run of fewer whole sentences than asked for has more words than this.
LONG_WORDS = 16
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
_STOPS = np.array(sorted(map(ord, ".!?…。！？")), np.uint32)
_BLANK = np.array([chr(c).isspace() for c in range(0x3001)] + [False])  # none above U+3000


def tagged(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, tag, tag2, text``: the tags are 128 bits of the text (two
    independent seeds), so that documents of one id, null included, are told
    apart."""
    return id_text(df, id_col, text_col).select("doc_id", F.xxhash64("text").alias("tag"), F.xxhash64(F.lit(1), F.col("text")).alias("tag2"), "text")


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each 64-bit number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _lower(text: str) -> str:
    """Lower case, as many characters as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le" if sys.byteorder == "little" else "utf-32-be"), np.uint32)


class Words:
    """The words (between blanks) of several texts, as arrays: ``begin`` and
    ``end`` in the texts joined by one character each, ``text`` (its number),
    ``mark``, 64 bits of its letters in lower case, ``last`` (of its text) and
    ``stop`` (it ends a sentence, line or text)."""

    def __init__(self, each: list[str]):
        self.sizes = np.array([len(t) for t in each], np.int64)
        self.at = np.cumsum(self.sizes + 1) - self.sizes - 1
        joined = "\n".join(each)
        letters = _points(_lower(joined))
        blank = _BLANK[np.minimum(letters, len(_BLANK) - 1)]
        edge = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        self.begin, self.end = edge[::2], edge[1::2]
        self.text = np.searchsorted(self.at, self.begin, "right") - 1
        size = self.end - self.begin
        first = np.cumsum(size) - size
        inside = np.flatnonzero(~blank)
        place = (np.arange(len(inside)) - np.repeat(first, size)).astype(np.uint64)
        sums = _mixed(letters[inside] + (place + np.uint64(1)) * _MIX)
        self.mark = _mixed(np.add.reduceat(sums, first) + size.astype(np.uint64)) if len(first) else np.empty(0, np.uint64)
        lines = np.flatnonzero(letters == 10)
        self.stop = np.isin(letters[np.maximum(self.end - 1, 0)], _STOPS)
        self.stop |= np.searchsorted(lines, self.end) < np.searchsorted(lines, np.append(self.begin[1:], len(letters)))
        self.last = np.append(self.text[1:] != self.text[:-1], True)[:len(self.text)]
        self.stop |= self.last


def chosen(words: Words, window: int = WINDOW) -> np.ndarray:
    """True for each word whose mark is the least (the last such one) of some
    ``window`` consecutive words of its text, where words that end a sentence
    go before all others; so of any ``window`` words in a row one is chosen,
    and by those words alone."""
    n = len(words.mark) - window + 1
    picked = np.zeros(len(words.mark), bool)
    if n < 1:
        return picked
    mark = (words.mark >> np.uint64(1)) | (np.uint64(1 << 63) * ~words.stop)
    least, at = mark[:n].copy(), np.arange(n)
    for k in range(1, window):
        now = mark[k:n + k]
        less = now <= least
        least = np.where(less, now, least)
        at[less] = np.flatnonzero(less) + k
    picked[at[words.text[:n] == words.text[window - 1:]]] = True
    return picked


def runs(each: list[str], size: int, least_words: int) -> tuple[np.ndarray, ...]:
    """text number, begin, end, hash and check of the runs of the texts ``each``.

    Clauses end at a word with a stop before a blank, at a line's end, at a
    text's end and at the chosen words.  From each clause goes the shortest
    run that has ``size`` clauses and ``least_words`` words, and ``size`` ends
    of sentences or more than ``LONG_WORDS`` words; so a single sentence of up
    to ``LONG_WORDS`` words is no run, however it is cut.  A run reaches to
    the word after it, blanks included; hash and check are 96 bits of its
    words in lower case.
    """
    w = Words(each)
    if not len(w.mark):
        none = np.empty(0, np.int64)
        return none, none.astype(np.int32), none.astype(np.int32), none, none.astype(np.int32)
    ends = np.flatnonzero(w.stop | chosen(w))
    starts = np.append(0, ends[:-1] + 1)
    k = np.arange(len(ends))
    stops = np.append(np.flatnonzero(w.stop[ends]), np.full(size, len(ends)))
    sentence = stops[np.minimum(np.searchsorted(stops, k) + size - 1, len(stops) - 1)]
    to = np.maximum(k + size - 1, np.searchsorted(ends, starts + least_words - 1))
    to = np.maximum(to, np.minimum(sentence, np.searchsorted(ends, starts + LONG_WORDS)))
    ok = to < len(ends)
    ok[ok] = w.text[starts[ok]] == w.text[starts[to[ok]]]
    first, final = starts[ok], ends[to[ok]]
    text = w.text[first]
    begin = w.begin[first] - w.at[text]
    after = np.where(w.last[final], w.at[text] + w.sizes[text], w.begin[np.minimum(final + 1, len(w.mark) - 1)]) - w.at[text]
    # a run's hash is its part of a sum with the powers of an odd base, shifted to power zero
    power = np.full(len(w.mark), np.uint64(_BASE))
    power[0] = 1
    power = np.multiply.accumulate(power)
    shift = np.full(len(w.mark), np.uint64(_INVERSE))
    shift[0] = 1
    shift = np.multiply.accumulate(shift)[first]
    found = []
    for marks in (w.mark, _mixed(w.mark + _MIX)):
        total = np.append(np.uint64(0), np.cumsum(marks * power, dtype=np.uint64))
        found.append(_mixed((total[final + 1] - total[first]) * shift + (final - first).astype(np.uint64)))
    return (text, begin.astype(np.int32), after.astype(np.int32), found[0].view(np.int64),
            (found[1] >> np.uint64(32)).astype(np.uint32).view(np.int32))


def span_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, least_words: int = 12) -> DataFrame:
    """``SPAN_ROWS``: one row for each run, see ``runs``."""
    ship_package(df.sparkSession)
    names = [f.split()[0] for f in SPAN_ROWS.split(", ")]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, 3, 1 << 20, 512):
            at, *cols = runs(texts(b.column(3)), size, least_words)
            if len(at):
                at = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays([*(b.column(k).take(at) for k in range(3)), *map(pa.array, cols)], names=names)

    return tagged(df, id_col, text_col).mapInArrow(each, SPAN_ROWS)


def repeated(spans: DataFrame, hot_share: int = 1000, old: list[str] | None = None) -> DataFrame:
    """``doc_id, tag, tag2, begin, end`` of the spans that occur before, in a
    document of smaller id or earlier in the same one.

    ``spans`` is read twice, so it should be a written table.  Only hashes are
    counted first; the rest works on the runs that occur again.  Runs that
    hold more than one in ``hot_share`` of all spans (fewer than ``hot_share``
    runs can) are joined by broadcast, all others by a shuffle on the hash.
    The folders ``old`` go once the runs that occur again are written.
    """
    place = F.struct("doc_id", "tag", "tag2", "begin", "check")
    counts = written(spans.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "span-counts")
    share = max(spans.count() // hot_share, 1)
    hot = F.broadcast(counts.filter(F.col("n") > share).select("h"))
    again = written(spans.join(hot, "h", "left_anti").join(counts.filter(F.col("n") <= share).select("h"), "h", "left_semi")
                    .withColumn("hot", F.lit(False))
                    .unionByName(spans.join(hot, "h", "left_semi").withColumn("hot", F.lit(True))), "span-again")
    for path in old or ():
        drop_path(spans.sparkSession, path)
    first = lambda rows: rows.groupBy("h").agg(F.min(place).alias("first"))
    later = ~place.eqNullSafe(F.col("first")) & (F.col("check") == F.col("first.check"))
    few, many = again.filter("NOT hot"), again.filter("hot")
    return (few.join(first(few), "h").unionByName(many.join(F.broadcast(first(many)), "h"))
            .filter(later).select("doc_id", "tag", "tag2", "begin", "end"))


def union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Disjoint intervals in order that cover the same characters."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(z, out[-1][1])
        else:
            out.append((a, z))
    return out


def dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, least_words: int = 12) -> DataFrame:
    """One row per input row: ``doc_id``, the ``text`` that is left,
    ``removed`` (the cut intervals of the old text, in code points, end
    exclusive) and ``removed_chars``.

    From every sentence, or clause of one (see ``runs``), a run of at least
    ``size`` of them and ``least_words`` words is hashed.  A run that occurs
    more than once stays where it occurs first (smallest doc_id, a null one
    before all, then position); its sentences go everywhere else.  A passage
    of ``6 * WINDOW`` words that stands in the middle of other sentences
    always holds a common run (``size`` 3, ``least_words`` up to 20); what
    lies before its first and after its last common clause stays.  Rows with
    the same id and text are one document.  A null text is empty; texts of fewer
    sentences have no run and stay whole.  An empty table gives an empty
    result.  Only the two named columns are read, so others never clash;
    texts of any length are treated whole.
    """
    spark = df.sparkSession
    ship_package(spark)
    path = scratch_path(spark, "sentence-spans")
    span_rows(df, id_col, text_col, size, least_words).write.option("compression", "zstd").parquet(path)
    found = repeated(spark.read.parquet(path), old=[path])
    key = F.struct("doc_id", "tag", "tag2").alias("_key")
    cuts = found.groupBy("doc_id", "tag", "tag2").agg(F.collect_set(F.struct("begin", "end")).alias("spans")).select(key, "spans")
    docs = tagged(df, id_col, text_col).select(key, "text")
    cut_type = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            left, removed, chars = [], [], []
            for t, spans in zip(texts(b.column(1)), b.column(2).to_pylist()):
                gone = union([(s["begin"], s["end"]) for s in spans or ()])
                ends = [0, *(z for _, z in gone)]
                left.append("".join([*(t[z:a] for z, (a, _) in zip(ends, gone)), t[ends[-1]:]]) if gone else t)
                removed.append([{"begin": a, "end": z} for a, z in gone])
                chars.append(sum(z - a for a, z in gone))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(left, pa.string()), pa.array(removed, cut_type),
                                              pa.array(chars, pa.int64())], names=["doc_id", "text", "removed", "removed_chars"])

    return (docs.join(cuts.hint("shuffle_hash"), "_key", "left").select(F.col("_key.doc_id").alias("doc_id"), "text", "spans")
            .mapInArrow(apply, "doc_id bigint, text string, removed array<struct<begin:int,end:int>>, removed_chars bigint"))
