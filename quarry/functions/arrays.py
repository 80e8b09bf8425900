"""Array / vector expressions: normalisation, softmax, argmax, probability maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def normalize(arr, mean: Sequence[float] | Column, std: Sequence[float] | Column) -> Column:
    """(x − mean) / std element-wise; mean/std are literal lists or array columns
    (a single-element list is broadcast to every position)."""
    a = _c(arr)
    if not isinstance(mean, Column) and len(mean) == 1 and not isinstance(std, Column) and len(std) == 1:
        return F.transform(a, lambda x: (x.cast("double") - F.lit(mean[0])) / F.lit(std[0]))
    m = mean if isinstance(mean, Column) else F.array(*[F.lit(float(v)) for v in mean])
    s = std if isinstance(std, Column) else F.array(*[F.lit(float(v)) for v in std])
    return F.transform(a, lambda x, i: (x.cast("double") - F.element_at(m, i + 1)) / F.element_at(s, i + 1))


def softmax(arr) -> Column:
    """exp(x − max) / Σ exp(x − max): stable softmax over an array column."""
    a = F.transform(_c(arr), lambda x: x.cast("double"))
    mx = F.array_max(a)
    ex = F.transform(a, lambda x: F.exp(x - mx))
    total = F.aggregate(ex, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(ex, lambda x: x / total)


def argmax(arr) -> Column:
    """0-based index of the first maximum."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def prob_map(names: Sequence[str], probs) -> Column:
    """Class name → probability."""
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), _c(probs))


def _every(a: Column, step: int, first: int) -> Column:
    return F.filter(a, lambda x, i: i % F.lit(step) == F.lit(first))


def class_scores(vec, n_classes: int) -> Column:
    """Score of class c = the largest element whose 0-based position is c
    modulo ``n_classes``; every element counts, and no sum is rounded."""
    a = F.transform(_c(vec), lambda x: x.cast("double"))
    return F.array(*[F.array_max(_every(a, n_classes, k)) for k in range(n_classes)])


def class_scores_sql(vec: str, n_classes: int) -> str:
    """SQL twin of ``class_scores``."""
    return "[" + ", ".join(f"CAST(list_max({vec}[{k + 1}:len({vec}):{n_classes}]) AS DOUBLE)" for k in range(n_classes)) + "]"
