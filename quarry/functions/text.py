"""Text expressions: cleaning, tokens, regex tests, tag decoding."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Fixed values that must equal the reference's (cleaning patterns, LF regexes).
# Python's ``\s`` and ``str.split`` take Unicode blanks; Java's ``\s`` is ASCII.
BLANK = r"\s\p{Z}\x1c-\x1f\x{85}"
BR_PATTERN = rf"<br[{BLANK}]*/?>"
YEAR_PATTERN = r"^(19|20)\d{2}[.,]?$"
ORG_SUFFIX_PATTERN = r"^(Inc|Inc\.|Corp|Corp\.|Ltd|Ltd\.)$"
# Python's ``[^\w\s']`` with Unicode ``\w`` = letters, digits, underscore;
# Java's ``\w`` is ASCII-only, so the classes are spelled out.
NON_WORD_PATTERN = rf"[^\p{{L}}\p{{N}}_{BLANK}']"
WHITESPACE = rf"[{BLANK}]+"


def strip_br(text) -> Column:
    """``<br>``, ``<br/>``, ``<br />`` → one space."""
    return F.regexp_replace(_c(text), BR_PATTERN, " ")


def strip_punct(text) -> Column:
    """Delete everything but letters, digits, underscore, whitespace, apostrophe."""
    return F.regexp_replace(_c(text), NON_WORD_PATTERN, "")


def clean_text(text) -> Column:
    """strip_br → strip_punct → lower (the review cleaning step)."""
    return F.lower(strip_punct(strip_br(text)))


def tokens(text) -> Column:
    """Whitespace tokens (``str.split()``: no empty tokens)."""
    t = F.trim(F.regexp_replace(_c(text), WHITESPACE, " "))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def any_word_in(text, words: Iterable[str]) -> Column:
    """Any whitespace token of ``text`` is in ``words``."""
    return F.arrays_overlap(tokens(text), F.array(*[F.lit(w) for w in sorted(set(words))]))


def count_char(text, ch: str) -> Column:
    """Occurrences of one character."""
    t = _c(text)
    return F.length(t) - F.length(F.replace(t, F.lit(ch), F.lit("")))


def any_token_matches(tok_array, pattern: str, ignore_case: bool = False) -> Column:
    """Any token matches the (anchored) regex."""
    pat = ("(?i)" if ignore_case else "") + pattern
    return F.exists(_c(tok_array), lambda t: t.rlike(pat))


def tag_decode(tag_ids, tag_names: Sequence[str]) -> Column:
    """Tag id → tag name by 0-based index into the dictionary."""
    names = F.array(*[F.lit(n) for n in tag_names])
    return F.transform(_c(tag_ids), lambda i: F.element_at(names, i + 1))


def any_tag_in(tag_names_col, wanted: Iterable[str]) -> Column:
    """Any decoded tag is in ``wanted`` (e.g. {B-ORG, I-ORG})."""
    return F.arrays_overlap(_c(tag_names_col), F.array(*[F.lit(w) for w in sorted(set(wanted))]))


def any_tag_contains(tag_names_col, fragment: str) -> Column:
    """Any decoded tag contains ``fragment`` (``"ORG" in tag``)."""
    return F.exists(_c(tag_names_col), lambda t: t.contains(fragment))
