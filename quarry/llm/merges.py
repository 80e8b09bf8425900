"""Byte-pair merges of many words at once."""

from __future__ import annotations

import numpy as np

NEVER = 1 << 60


class PairMerges:
    """Merge rules: a pair of adjoining part ids, its rank and its new id."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.ranks = np.array([r for r, _ in pairs.values()], np.int64)[order]
        self.new = np.zeros(int(self.ranks.max(initial=-1)) + 1, np.int64)
        self.new[self.ranks] = np.array([n for _, n in pairs.values()], np.int64)[order]

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NEVER`` for one that doesn't merge."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NEVER)

    def run(self, ids: np.ndarray, pair: np.ndarray | None = None) -> list[bytes]:
        """Merge each row of ``ids`` (words of one length): always the pair of
        lowest rank, the leftmost among equals.  A round merges one pair in
        every row that has one.  Returns little-endian 32-bit ids; ``pair``
        may give the ranks of the first round."""
        out: list[bytes] = [b""] * len(ids)
        if pair is None:
            pair = self.rank(ids[:, :-1], ids[:, 1:])
        row = np.arange(len(ids))
        while len(row):
            if not pair.shape[1]:
                for k, line in zip(row.tolist(), ids.astype("<i4")):
                    out[k] = line.tobytes()
                break
            every = np.arange(len(row))
            at = pair.argmin(axis=1)
            least = pair[every, at]
            done = least == NEVER
            if done.any():
                for k, line in zip(row[done].tolist(), ids[done].astype("<i4")):
                    out[k] = line.tobytes()
                go = ~done
                row, ids, pair, at, least = row[go], ids[go], pair[go], at[go], least[go]
                every = np.arange(len(row))
            n = ids.shape[1] - 1
            ids[every, at] = self.new[least]
            right = np.ones(ids.shape, bool)
            right[every, at + 1] = False
            ids = ids[right].reshape(len(row), n)  # without the right part
            gone = np.ones(pair.shape, bool)
            gone[every, at] = False
            pair = pair[gone].reshape(len(row), n - 1)
            for place in (at - 1, at):  # the merged part's pairs, to its left and right
                ok = np.flatnonzero((place >= 0) & (place < n - 1))
                c = place[ok]
                pair[ok, c] = self.rank(ids[ok, c], ids[ok, c + 1])
        return out
