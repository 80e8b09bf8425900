"""Date, number, padding and map helpers as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def month_start(ts) -> Column:
    """First day of the month of ``ts``."""
    return F.trunc(_c(ts), "month")


def next_month_start(ts) -> Column:
    """First day of the following month (December rolls over)."""
    return F.add_months(F.trunc(_c(ts), "month"), 1)


def month_bounds(year, month) -> tuple[Column, Column]:
    """``[make_date(y, m, 1), add_months(..., 1))`` from column inputs."""
    start = F.make_date(_c(year), _c(month), F.lit(1))
    return start, F.add_months(start, 1)


def zero_pad(x, width: int) -> Column:
    """``{x:0{width}d}`` — left pad with zeros (no truncation of longer values)."""
    s = _c(x).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def round_half_up(x, places: int) -> Column:
    return F.round(_c(x), places)


def round_half_even(x, places: int) -> Column:
    """Python's ``round`` (banker's rounding)."""
    return F.bround(_c(x), places)


# Python's literals: digits may be grouped by single underscores.
_DIGITS = r"[0-9](?:_?[0-9])*"
_PAD = r"[\s\p{Z}\x1c-\x1f\x{85}]*"
INT_PATTERN = rf"^{_PAD}[+-]?{_DIGITS}{_PAD}$"
FLOAT_PATTERN = (rf"(?i)^{_PAD}[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
                 rf"|inf(?:inity)?|nan){_PAD}$")


def is_int(s) -> Column:
    """String parses as an integer, as ``int(s)``: no bound, blanks around it."""
    return F.coalesce(_c(s).rlike(INT_PATTERN), F.lit(False))


def is_float(s) -> Column:
    """String parses as a float, as ``float(s)``: neither type suffixes nor
    hexadecimal, which Java's parser takes."""
    return F.coalesce(_c(s).rlike(FLOAT_PATTERN), F.lit(False))


def add(a, b) -> Column:
    return _c(a) + _c(b)


def sum_list(arr) -> Column:
    """Σ of an array column."""
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def factorial(n) -> Column:
    """n! as a double, exact up to 22 and infinite above 170; null for n < 0
    (the reference prints a message there)."""
    n = _c(n).cast("int")
    product = F.aggregate(F.sequence(F.lit(1), n), F.lit(1.0), lambda acc, x: acc * x.cast("double"))
    return F.when(n == 0, 1.0).when(n > 0, product)


def factorial_exact(n) -> Column:
    """n! as decimal(38,0), the widest decimal, which holds 33!; null for
    n < 0, and an error beyond 33."""
    n, whole = _c(n).cast("int"), "decimal(38,0)"
    product = F.aggregate(F.sequence(F.lit(1), n), F.lit(1).cast(whole), lambda acc, x: (acc * x.cast("decimal(2,0)")).cast(whole))
    return (F.when(n == 0, F.lit(1).cast(whole)).when((n > 0) & (n <= 33), product)
            .when(n > 33, F.raise_error(F.concat(F.lit("factorial beyond decimal(38,0): "), n.cast("string"))).cast(whole)))


def min_threshold(x, minimum) -> Column:
    """Value if ≥ minimum else null (the reference re-prompts instead)."""
    v = _c(x)
    return F.when(v >= F.lit(minimum), v)


def dict_get_default(m, key: str, default) -> Column:
    """``d.get(key, default)`` on a map column."""
    return F.coalesce(F.element_at(_c(m), F.lit(key)), F.lit(default))


def dict_merge(*maps) -> Column:
    """Right-biased merge of map columns: later maps win on shared keys.

    Entries are concatenated in order and reduced with ``map_from_entries``
    over the last occurrence of each key.
    """
    entries = F.concat(*[F.map_entries(_c(m)) for m in maps])
    keys = F.transform(entries, lambda e: e["key"])
    # keep entry i when its key does not occur again later in the list
    last = F.filter(entries, lambda e, i: F.array_position(F.reverse(keys), e["key"]) == F.size(keys) - i)
    return F.map_from_entries(last)
