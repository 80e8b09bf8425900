"""Secret scan: fixed patterns, and guess costs of credential values.

The cost of a value is the smallest sum, over all segmentations into words,
dates, repeats, keyboard walks and brute-force spans, of the parts' costs in
bits; values in a credential context that cost enough are taken for secrets.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from quarry.llm.common import id_text, ship_package, slices, texts

#: Patterns and least lengths of the base kinds: fixed values.
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "guess")

#: Contexts whose value the guess cost decides, wider than the base ones.
CONTEXT = re.compile(
    r"""(?<![A-Za-z])(?ai:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"""
    r"""|client[_-]?secret|auth(?:orization)?|credentials?)["']?[\x20\t]*(?:[:=]|=>)[\x20\t]*(?ai:bearer[\x20]+|basic[\x20]+)?"""
    r"""(?:"([^"\r\n]{6,})"|'([^'\r\n]{6,})'|([^\s"',;<>]{6,}))""")
#: A value in a url: scheme://user:value@host
URL_VALUE = re.compile(r"://[^\s/:@]+:([^\s/@]{6,})@")
CONTEXT_HINTS = ("pass", "pwd", "secret", "token", "key", "auth", "credential")
BASE_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Common words of passwords, most usual first (rank = guesses): fixed values.
COMMON_WORDS = """
password admin user root test guest login welcome master default secret token key pass letmein qwerty abc dragon
monkey shadow sunshine princess football baseball superman batman iloveyou love trustno access hello hunter ranger
michael jordan jennifer thomas robert daniel george charlie andrew joshua matthew soccer hockey killer pepper ginger
summer winter spring autumn monday friday january december example sample changeme change temp dummy none null true
false unknown company server system oracle mysql database public private demo local host dev prod staging api web app
mail office home house money happy lucky flower cheese banana orange computer internet google the and for you not
value string insert your here enter placeholder required optional hidden redacted
""".split()
#: Rows of a keyboard: fixed values.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("013457@$!", "oieastasi")
DATE = re.compile(r"(?:(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])"
                  r"|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d|(?:19|20)\d\d)")
DATE_BITS = {4: math.log2(120), 8: math.log2(120 * 365), 10: math.log2(120 * 365 * 4)}
#: Bits of a letter of a word that is not listed, and of a whole such word among blanks.
LETTER_BITS, WORD_BITS = 4.17, 12.9
#: Least cost, in bits, of a value that is taken for a secret: eight random
#: characters of a case and digits have 41.4, of both cases and digits 47.6;
#: nine letters of an unlisted word have 37.5, eight and a last digit 37.7.
SECRET_BITS = 38.0

_PLACE = {c: (r, i) for r, row in enumerate(KEY_ROWS) for i, c in enumerate(row)}
_RANK = {w: math.log2(k + 2) for k, w in enumerate(COMMON_WORDS)}
_LONGEST = max(map(len, COMMON_WORDS))


def _near(a: str, b: str) -> bool:
    """Neighbours on one keyboard row, or on two adjoining rows."""
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


_CAPITALISED = re.compile(r"(?<![A-Za-z])[A-Z](?=[a-z]{3})")
_WORDLIKE = re.compile(r"(?<![A-Za-z])(?:[A-Z]?[a-z]{5,}|[A-Z]{6,})(?![A-Za-z])")
_LAST_DIGITS = re.compile(r"(?<=[A-Za-z])[0-9]+\Z")
_AMONG_BLANKS = re.compile(r"(?<!\S)[^\W\d_]{3,}(?!\S)")


def _class_bits(value: str) -> list[float]:
    """Bits of each character by brute force: the size of the union of the
    value's classes (letters in both cases count twice; the capital of a
    capitalised word does not make a second case); a blank costs one bit."""
    digits = any(c.isdigit() and c.isascii() for c in value)
    if all(c in "0123456789abcdefABCDEF-" for c in value) and not value.isdigit():
        return [4.0] * len(value)
    letters = any(c.isalpha() and c.isascii() for c in value)
    signs = any(c.isascii() and not c.isalnum() and not c.isspace() for c in value)
    cased = _CAPITALISED.sub("x", value)
    size = 26 * letters * (2 if cased != cased.lower() and cased != cased.upper() else 1) + 10 * digits + 33 * signs
    each = LETTER_BITS if size == 26 else math.log2(size) if size else 0.0
    return [1.0 if c.isspace() else each if c.isascii() else 7.0 for c in value]


def guess_bits(value: str, words: dict[str, float] | None = None) -> float:
    """Cost of the cheapest segmentation of ``value``, in bits; time and space
    are linear in its length (times the longest word).

    Words cost their rank, with a bit each for capitals and for substituted
    characters; an unlisted one of six letters or more ``LETTER_BITS`` each,
    and one among blanks at most ``WORD_BITS``; digits at the end ten each; a date its number of days and separators; a repeat its unit
    and a count; a keyboard walk its start and turns; other characters the
    size of the value's classes.  Each new segment after the first adds a bit.
    """
    ranks = _RANK if words is None else words
    longest = _LONGEST if words is None else max(map(len, words), default=0)
    n, low = len(value), value.lower()
    low = low if len(low) == n else value
    plain = low.translate(LEET)
    brute = _class_bits(value)
    spans = {m.end(): (m.start(), (m.end() - m.start()) * LETTER_BITS) for m in _WORDLIKE.finditer(value)}
    spans |= {m.end(): (m.start(), (m.end() - m.start()) * math.log2(10)) for m in _LAST_DIGITS.finditer(value)}
    if " " in value or "\t" in value:
        spans |= {m.end(): (m.start(), min(WORD_BITS, (m.end() - m.start()) * LETTER_BITS)) for m in _AMONG_BLANKS.finditer(value)}
    best = [0.0] + [math.inf] * n  # cheapest way to each place
    spent = [math.inf] * (n + 1)  # the same, ending in a brute-force span
    run = walk = turns = 0  # length of the run of one character, of the keyboard walk, its changes of direction or case
    heading = 0
    for j in range(1, n + 1):
        run = run + 1 if j > 1 and low[j - 1] == low[j - 2] else 1
        if j > 1 and _near(low[j - 2], low[j - 1]):
            step = 16 * (_PLACE[low[j - 1]][0] - _PLACE[low[j - 2]][0]) + _PLACE[low[j - 1]][1] - _PLACE[low[j - 2]][1]
            turns = (turns + (step != heading) if walk > 1 else 0) + (value[j - 1].isupper() != value[j - 2].isupper())
            walk, heading = walk + 1, step
        else:
            walk, turns, heading = 1, 0, 0
        spent[j] = min(spent[j - 1], best[j - 1] + (j > 1)) + brute[j - 1]
        ways = [spent[j]]
        if j in spans:
            i, bits = spans[j]
            ways.append(best[i] + bits + (i > 0))
        for size in range(3, min(longest, j) + 1):
            i = j - size
            for form, extra in ((low[i:j], 0.0), (plain[i:j], 1.0)):
                if form in ranks:
                    ways.append(best[i] + ranks[form] + extra + (value[i:j] != low[i:j]) + (i > 0))
        for size in (4, 8, 10):
            if j >= size and DATE.fullmatch(value, j - size, j):
                ways.append(best[j - size] + DATE_BITS[size] + (j > size))
        if run >= 3:
            ways.append(best[j - run] + brute[j - 1] + math.log2(run) + (j > run))
        if walk >= 4:
            ways.append(best[j - walk] + math.log2(47) + math.log2(walk) + 2.0 * (turns + 1) + (j > walk))
        for unit in (2, 3, 4, 5, 6):  # a repeated unit ends here: price its last copy as a reference
            if j >= 2 * unit and low[j - unit:j] == low[j - 2 * unit:j - unit]:
                ways.append(best[j - unit] + 1.0 + math.log2(unit))
        best[j] = min(ways)
    return best[n]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds, leftmost non-overlapping by kind."""
    out = []
    low = text.lower()
    if any(h in low for h in BASE_HINTS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m.group(1)) >= 8]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return out


def guess_spans(text: str, least_bits: float = SECRET_BITS) -> list[tuple[int, int, str]]:
    """(start, end, "guess") of context values that cost ``least_bits``."""
    low = text.lower()
    found = []
    if any(h in low for h in CONTEXT_HINTS):
        found += [m.span(m.lastindex) for m in CONTEXT.finditer(text)]
    if "://" in text:
        found += [m.span(1) for m in URL_VALUE.finditer(text)]
    return [(a, b, "guess") for a, b in sorted(set(found)) if guess_bits(text[a:b]) >= least_bits]


def ordered(spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find(text: str, least_bits: float = SECRET_BITS) -> list[tuple[int, int, str]]:
    """All spans of one text, by start and kind."""
    return ordered(base_spans(text) + guess_spans(text, least_bits))


SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_bits: float = SECRET_BITS) -> DataFrame:
    """One row per input row: ``doc_id`` and ``spans``, an array of (kind,
    start, end) in code points, end exclusive, by start and kind.

    Kinds ``assign``, ``access`` and ``hex`` are the base patterns, ``guess``
    a credential value that is costly to guess.  A null text is empty and has
    no spans.  Null and repeated ids are scanned row by row; no row is
    dropped, and an empty table gives an empty result.
    """
    ship_package(df.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            spans = [[{"kind": k, "start": a, "end": z} for a, z, k in find(t, least_bits)] for t in texts(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, SPANS)], names=["doc_id", "spans"])

    return id_text(df, id_col, text_col).mapInArrow(each, "doc_id bigint, spans array<struct<kind:string,start:int,end:int>>")


def mask(text: str, spans: list[tuple[int, int, str]], sign: str = "[SECRET]") -> str:
    """``text`` with ``sign`` in place of each run of overlapping spans."""
    out, at = [], 0
    for a, z, _ in sorted(spans):
        if a >= at:
            out += [text[at:a], sign]
        at = max(at, z)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text_col: str = "text", length_col: str | None = None, least_bits: float = SECRET_BITS) -> DataFrame:
    """``df`` with every span of ``text_col`` masked; all columns and rows
    stay.  ``length_col``, if given and present, is set to the new length in
    code points where the text changed.  A null text stays null.
    """
    ship_package(df.sparkSession)
    names = df.columns
    at = names.index(text_col)
    size = names.index(length_col) if length_col in names else None

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            cols, old = list(b.columns), b.column(at).to_pylist()
            new = [t if t is None or not (s := find(t, least_bits)) else mask(t, s) for t in old]
            cols[at] = pa.array(new, b.schema.field(at).type)
            if size is not None:
                cols[size] = pa.array([n if x is y else len(y) for x, y, n in zip(old, new, cols[size].to_pylist())],
                                      b.schema.field(size).type)
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)

    return df.mapInArrow(each, df.schema)
