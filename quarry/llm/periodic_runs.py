"""Periodic runs of words by a dictionary of basic factors.

The factor of length L at a place is named by a number, equal factors alike;
names of length 2L come from pairs of names of length L, for powers of two.
For each L, occurrences of a factor whose next one lies within twice L are
linked; links of one small distance form arithmetic progressions.  A run of
period q with L <= q < 2L holds a factor and its copy q words on.  Between two
occurrences within 2L there are at most three distances over L/2, and all
others are the factor's own period p; so the differences of the elements of a
progression and of its next three propose every period of that size, one
proposal for each multiple of p.  A progression of two or more proposes p.

Each proposal is extended to both sides by descending the names' lengths, and
equal stretches are put together under their least period.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import by_size, ship_package

RESULT = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
SHORTEST = 4  # length of the first factors, for all periods below twice it
LEAST = 12  # words of the shortest run


def factor_names(words: np.ndarray, doc: np.ndarray) -> list[np.ndarray]:
    """Names of the factors of 1, 2, 4, … words at every place, until no
    factor occurs twice in a document.  A factor that occurs once there (or
    leaves its document) has a negative name of its own: no longer factor
    that begins with it can recur."""
    n = len(words)
    own = -1 - np.arange(n)
    if not n:
        return [own]
    names = [recurring(np.arange(n), words.astype(np.int64), doc, own)]
    length = 1
    while True:
        last = names[-1]
        at = np.flatnonzero(last[:max(n - length, 0)] >= 0)
        at = at[(last[at + length] >= 0) & (doc[at] == doc[at + length])]
        if not len(at):
            return names
        names.append(recurring(at, last[at] * (n + 1) + last[at + length], doc, own))
        length *= 2
        if not (names[-1] >= 0).any():
            return names


def recurring(at: np.ndarray, key: np.ndarray, doc: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Numbers, from 0 on, for the (document, key) pairs that occur twice or
    more among the places ``at``; all other places keep ``own``."""
    out = own.copy()
    order = np.lexsort((key, doc[at]))
    key, of = key[order], doc[at][order]
    same = (key[1:] == key[:-1]) & (of[1:] == of[:-1])
    number = np.cumsum(np.append(True, ~same)) - 1
    again = np.append(False, same) | np.append(same, False)
    out[at[order[again]]] = number[again]
    return out


def progressions(names: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``first, last, gap, chain``: the progressions of all names, in order of
    name and place.  Occurrences at one distance ``gap <= length / 2`` belong
    together; one alone has gap 0.  Progressions of one chain follow each
    other at distances below ``2 * length``."""
    at = np.flatnonzero(names >= 0)
    at = at[np.argsort(names[at], kind="stable")]
    if not len(at):
        return at, at, at, at
    step = np.diff(at)
    linked = (names[at[1:]] == names[at[:-1]]) & (step < 2 * length)
    near = linked & (2 * step <= length)  # then the step is the factor's own period
    head = np.append(True, ~near)
    heads = np.flatnonzero(head)
    tails = np.append(heads[1:], len(at)) - 1
    gap = np.where(tails > heads, step[np.minimum(heads, len(step) - 1)] if len(step) else 0, 0)
    chain = np.cumsum(np.append(True, ~linked))[heads]
    return at[heads], at[tails], gap, chain


def proposals(names: np.ndarray, length: int, low: int) -> tuple[np.ndarray, np.ndarray]:
    """``at, period``: places whose factor recurs ``period`` words on, for all
    periods from ``low`` to below ``2 * length``."""
    first, last, gap, chain = progressions(names, length)
    own = np.flatnonzero(gap >= low)
    found = [(first[own], gap[own])]
    for ahead in (1, 2, 3):
        a = np.flatnonzero(chain[ahead:] == chain[:-ahead]) if len(chain) > ahead else np.empty(0, np.int64)
        b = a + ahead
        p = np.maximum(gap[a], gap[b])  # of one factor, so equal unless one stands alone
        between = first[b] - last[a]
        keep = between < 2 * length
        a, b, p, between = a[keep], b[keep], p[keep], between[keep]
        per = np.maximum(p, 1)
        left, right = (last[a] - first[a]) // per, (last[b] - first[b]) // per
        many = np.minimum(left + right, (2 * length - 1 - between) // per) + 1
        pair = np.repeat(np.arange(len(a)), many)
        t = np.arange(len(pair)) - np.repeat(np.cumsum(many) - many, many)
        period = between[pair] + t * p[pair]
        at = last[a][pair] - np.minimum(t, left[pair]) * p[pair]
        keep = period >= low
        found.append((at[keep], period[keep]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def extend(names: list[np.ndarray], at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``start, end`` of the longest stretch around ``at`` in which words that
    are ``period`` apart are equal."""
    n = len(names[0])
    left, right = at.copy(), at.copy()
    for level in range(len(names) - 1, -1, -1):
        name, size = names[level], 1 << level
        for side in (0, 1):
            # a size may fit once more often than halving says: at the top any number of times
            todo = np.arange(len(at))
            while len(todo):
                a = right[todo] if side else left[todo] - size
                b = a + period[todo]
                ok = (a >= 0) & (b + size <= n)
                ok[ok] = name[a[ok]] == name[b[ok]]
                todo = todo[ok]
                if side:
                    right[todo] += size
                else:
                    left[todo] -= size
                if level < len(names) - 1:
                    break
    return left, right + period


def find_runs(words: np.ndarray, doc: np.ndarray, least: int = LEAST) -> np.ndarray:
    """``start, length, period`` rows of all runs of several documents laid
    one after another (``doc`` is sorted), in order of start and period.

    A run is a stretch whose words ``period`` apart are equal, that can't be
    lengthened, and that has ``max(least, 2 * period)`` words or more;
    ``least`` is 12 or more.
    """
    names = factor_names(words, doc)
    found = []
    for level in range(SHORTEST.bit_length() - 1, len(names)):
        length = 1 << level
        at, period = proposals(names[level], length, 1 if length == SHORTEST else length)
        start, end = extend(names, at, period)
        ok = end - start >= np.maximum(least, 2 * period)
        found.append(np.stack([start[ok], end[ok] - start[ok], period[ok]], axis=1))
    if not found:
        return np.empty((0, 3), np.int64)
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    new = np.ones(len(rows), bool)  # one stretch: its least period
    new[1:] = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """One row for each document: ``doc_id, n_words, runs, collapsed``.

    Words are separated by blanks (space, tab to carriage return).  ``runs``
    are in order of start and period; ``collapsed`` has the words that no run
    holds after its first ``period`` words, joined by single blanks.  A null or
    blank text has no words, no runs and an empty ``collapsed``; null and
    repeated ids are kept row by row, and an empty table gives no rows.  Only
    the two named columns are read, so other columns never clash.  Runs that
    overlap or share a start are all returned; of several periods of one
    stretch the least counts.  A text is treated whole, in memory that grows
    with its words times the levels of factors.
    """
    if least < LEAST:
        raise ValueError(f"least must be {LEAST} or more")
    ship_package(df.sparkSession)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in by_size(batches, 1, 1 << 22, 4096):
            split = [t.split() for t in b.column(1).to_pylist()]
            size = np.array([len(w) for w in split])
            flat = [w for words in split for w in words]
            doc = np.repeat(np.arange(len(split)), size)
            words = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy()
            rows = find_runs(words, doc, least)
            before = np.cumsum(size) - size
            of = doc[rows[:, 0]] if len(rows) else np.empty(0, np.int64)
            order = np.argsort(of, kind="stable")
            rows, of = rows[order], of[order]
            change = np.zeros(len(flat) + 1, np.int64)  # +1 where words begin to go, -1 where they end
            np.add.at(change, rows[:, 0] + rows[:, 2], 1)
            np.add.at(change, rows[:, 0] + rows[:, 1], -1)
            gone = np.cumsum(change)[:-1] > 0
            for k in np.unique(of).tolist():
                split[k] = [w for w, g in zip(split[k], gone[before[k]:before[k] + size[k]].tolist()) if not g]
            struct = pa.StructArray.from_arrays([pa.array(rows[:, 0] - before[of]), pa.array(rows[:, 1]), pa.array(rows[:, 2])],
                                                names=["start", "length", "period"])
            bounds = np.searchsorted(of, np.arange(len(split) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(bounds), struct).cast(kind),
                 pa.array([b" ".join(w) for w in split], pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    rows = df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(each, RESULT)
