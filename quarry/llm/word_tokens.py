"""Token ids of whole text columns by a ``tokenizers`` file of words.

The tokenizer splits at blanks first, so a batch of texts is split once by
Arrow, its distinct words are merged all together in flat arrays, and the ids
are put together by array arithmetic.  No Python object is made for a word.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

NEVER = np.int32(2**31 - 1)
LONGEST = 64  # bytes of a piece that is merged here; the library takes longer ones


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level
    vocabulary: itself where printable, else one from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def lowered(text: str) -> str:
    """Normalised as the tokenizer does: form C, lower case (it lowers a
    capital sigma alike everywhere)."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def parts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bounds (from 0) and bytes of a string or binary column without nulls."""
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32, len(column) + 1, column.offset * 4)
    raw = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
    return bounds - bounds[0], raw


def binary(bounds: np.ndarray, data: np.ndarray) -> pa.Array:
    """The binary column with these bounds and bytes."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class FlatMerges:
    """Merge rules in a hash table: a pair of part ids, its rank, its new id."""

    BITS = 19

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(self.BITS, (len(pairs) * 4).bit_length())
        self.keys = np.full((1 << self.bits) + 64, -1, np.int64)
        self.ranks = np.full(len(self.keys), NEVER, np.int32)
        self.new = np.zeros(max((r for r, _ in pairs.values()), default=-1) + 1, np.int32)
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        for key, at, (r, n) in zip(keys.tolist(), self._slot(keys).tolist(), pairs.values()):
            while self.keys[at] >= 0:  # the next free slot; probes end at a free one
                at += 1
            self.keys[at], self.ranks[at] = key, r
            self.new[r] = n
        if self.keys[-1] >= 0:
            raise ValueError("merge table is full")

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys ^ keys >> 25).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``NEVER`` for one that doesn't merge."""
        key = a.astype(np.int64) << 32 | b
        at = self._slot(key)
        found = self.keys[at]
        rank = np.where(found == key, self.ranks[at], NEVER)
        todo = np.flatnonzero((found != key) & (found >= 0))
        while len(todo):
            at[todo] += 1
            found = self.keys[at[todo]]
            hit = found == key[todo]
            rank[todo[hit]] = self.ranks[at[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return rank

    def run(self, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces of ``size`` symbols that lie one after another in
        ``ids``: in each always the pair of lowest rank, the leftmost among
        equals.  A round merges one pair in every piece that has one; finished
        pieces leave.  Returns the ids and the sizes, in order."""
        count = np.ones(len(size), np.int64)
        done: list[tuple[np.ndarray, np.ndarray]] = []  # (piece of each id, ids)
        piece = np.arange(len(size))
        rank = np.full(len(ids), NEVER, np.int32)
        last = np.cumsum(size) - 1
        inner = np.ones(len(ids), bool)
        inner[last] = False
        at = np.flatnonzero(inner)
        rank[at] = self.rank(ids[at], ids[at + 1])
        while len(piece):
            start = np.cumsum(size) - size
            least = np.minimum.reduceat(rank, start)
            ended = least >= NEVER
            if ended.any():
                of = np.repeat(ended, size)
                done.append((np.repeat(piece[ended], size[ended]), ids[of]))
                count[piece[ended]] = size[ended]
                go = ~of
                ids, rank, piece, size, least = ids[go], rank[go], piece[~ended], size[~ended], least[~ended]
                if not len(piece):
                    break
                start = np.cumsum(size) - size
            # the leftmost place of the least rank
            hits = np.flatnonzero(rank == np.repeat(least, size))
            of = np.searchsorted(start, hits, "right") - 1
            first = np.ones(len(hits), bool)
            first[1:] = of[1:] != of[:-1]
            at = hits[first]
            ids[at] = self.new[least]
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            rank[at] = rank[at + 1]  # of the pair that begins with the right part; set anew below
            ids, rank = ids[keep], rank[keep]
            at = at - np.arange(len(at))  # one symbol less for each piece before
            size = size - 1
            start = start - np.arange(len(start))
            end = start + size
            left = at[at > start]
            rank[left - 1] = self.rank(ids[left - 1], ids[left])
            right = at[at + 1 < end]
            rank[right] = self.rank(ids[right], ids[right + 1])
            rank[end - 1] = NEVER
        if not done:
            return ids, count
        of, out = np.concatenate([d[0] for d in done]), np.concatenate([d[1] for d in done])
        return out[np.argsort(of, kind="stable")], count


class WordTokens:
    """Ids of texts by a ``tokenizers`` file: normal form C, lower case, white
    space dropped, byte-level BPE with word ends.

    A word between blanks is cut into runs of letters, single digits and runs
    of other signs, as the tokenizer does.  Words with an apostrophe, other
    white space, non-ASCII characters that are no letters, or runs of over 64
    bytes are given to the library.  So is a whole text that holds a special
    token's string (its id comes back), unless ``special_as_text``.
    """

    def __init__(self, data: bytes, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        file = json.loads(data)
        self.tokenizer = Tokenizer.from_str(data.decode())
        self.tokenizer.encode_special_tokens = special_as_text
        self.special = [] if special_as_text else [t["content"] for t in file["added_tokens"] if t["special"]]
        model = file["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"] or ""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.pairs = FlatMerges({(vocab[a], vocab[b]): (r, vocab[a + b]) for r, (a, b) in enumerate(merges)})
        self.first = np.array([vocab[c] for c in byte_symbols()], np.int32)
        self.last = np.array([vocab[c + end] for c in byte_symbols()], np.int32)
        kind = np.full(256, 2, np.int8)  # 0: letter, 1: digit, 2: other sign
        kind[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 0
        kind[48:58] = 1
        self.kind = kind

    def _library(self, rows: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(rows, add_special_tokens=False)]

    def _pieces(self, pieces: pa.Array) -> pa.Array:
        """Ids of distinct pieces, none of them empty."""
        bounds, raw = parts_of(pieces)
        if not len(raw):
            return pieces
        ids = self.first[raw]
        ids[bounds[1:] - 1] = self.last[raw[bounds[1:] - 1]]
        flat, count = self.pairs.run(ids, np.diff(bounds))
        return binary(np.append(0, np.cumsum(count)) * 4, flat.astype("<u4"))

    def _words(self, words: pa.Array) -> pa.Array:
        """Ids of each distinct word."""
        odd = pc.match_substring_regex(words, r"['\x00-\x20\x7f]")
        foreign = pc.invert(pc.string_is_ascii(words))
        if pc.any(foreign).as_py():
            some = parts_of(words.filter(foreign))[1].tobytes().decode()
            signs = "".join(c for c in set(some) if not c.isascii() and not c.isalpha())
            if signs:
                odd = pc.or_(odd, pc.match_substring_regex(words, f"[{re.escape(signs)}]"))
        odd = odd.to_numpy(zero_copy_only=False)
        mine = pc.replace_with_mask(words, pa.array(odd), pa.scalar("")) if odd.any() else words
        bounds, raw = parts_of(mine)
        length = np.diff(bounds)
        kind = self.kind[raw]
        head = np.ones(len(raw), bool)  # does a piece begin here
        head[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 1)
        head[bounds[:-1][length > 0]] = True
        heads = np.flatnonzero(head)
        size = np.diff(np.append(heads, len(raw)))
        of = np.repeat(np.arange(len(mine)), length)[heads]  # word of each piece
        if len(size) and size.max() > LONGEST:
            odd[of[size > LONGEST]] = True
            gone = odd[of]
            raw, of, size = raw[np.repeat(~gone, size)], of[~gone], size[~gone]
        pieces = binary(np.append(0, np.cumsum(size)), raw).dictionary_encode()
        ids = self._pieces(pieces.dictionary).take(pieces.indices)
        bounds, data = parts_of(ids)
        made = binary(bounds[np.searchsorted(of, np.arange(len(words) + 1))], data)
        if odd.any():
            made = pc.replace_with_mask(made, pa.array(odd), pa.array(self._library(words.filter(pa.array(odd)).to_pylist()), pa.binary()))
        return made

    def column(self, rows: pa.Array, end: bytes = b"") -> pa.Array:
        """Little-endian 32-bit ids of each text (null: empty), then ``end``,
        as a binary column."""
        rows = pc.fill_null(rows.cast(pa.string()), "")
        whole = np.zeros(len(rows), bool)  # texts for the library
        for s in self.special:
            whole |= pc.match_substring(rows, s).to_numpy(zero_copy_only=False)
        low = pc.ascii_lower(rows)
        foreign = pc.invert(pc.string_is_ascii(rows))
        if pc.any(foreign).as_py():
            low = pc.replace_with_mask(low, foreign, pa.array([lowered(t) for t in rows.filter(foreign).to_pylist()], pa.string()))
        if whole.any():
            low = pc.replace_with_mask(low, pa.array(whole), pa.scalar(""))
        split = pc.split_pattern(pc.replace_substring(low, "\n", " "), " ")
        ends = split.offsets.to_numpy()
        found = split.values.slice(int(ends[0]), int(ends[-1] - ends[0])).dictionary_encode()
        ends, at = ends - ends[0], found.indices.to_numpy()
        ids = self._words(found.dictionary)
        if end:  # one more word after each text
            at = np.insert(at, ends[1:], len(ids))
            ids = pa.concat_arrays([ids, pa.array([end], pa.binary())])
            ends = ends + np.arange(len(ends))
        bounds, data = parts_of(ids.take(pa.array(at)))
        made = binary(bounds[ends], data)
        if whole.any():
            picked = pa.array(whole)
            made = pc.replace_with_mask(made, picked, pa.array([x + end for x in self._library(rows.filter(picked).to_pylist())], pa.binary()))
        return made

    def encode(self, rows: list[str], end: bytes = b"") -> list[bytes]:
        return self.column(pa.array(rows, pa.string()), end).to_pylist() if rows else []


_LOADED: dict[tuple[bytes, bool], WordTokens] = {}


def word_tokens(data: bytes, special_as_text: bool = False) -> WordTokens:
    """One encoder for each process and file."""
    key = (hashlib.sha256(data).digest(), special_as_text)
    if key not in _LOADED:
        _LOADED[key] = WordTokens(data, special_as_text)
    return _LOADED[key]
