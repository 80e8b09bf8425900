"""Weak supervision: labelling functions, their analysis and vote aggregation.

A labelling function (LF) is a named builder of an integer ``Column``
(−1 = abstain).  Applying a list of LFs is one ``select`` — the label matrix
is the DataFrame ``(id, lf_1, …, lf_k)`` — and every statistic below is one
aggregate pass over it, so no Python worker is involved unless an LF is
explicitly written in Python (``python_lf``, Arrow-batched).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as tx
from quarry.session import checkpoint_dir

ABSTAIN = -1


@dataclass(frozen=True)
class LabelingFunction:
    name: str
    build: Callable[[], Column]

    def column(self) -> Column:
        return self.build().cast("int").alias(self.name)


LF_REGISTRY: dict[str, LabelingFunction] = {}


def labeling_function(name: str | None = None, register: bool = True):
    """Decorator: a zero-argument function returning a vote ``Column``."""
    def deco(fn: Callable[[], Column]) -> LabelingFunction:
        lf = LabelingFunction(name or fn.__name__, fn)
        if register:
            LF_REGISTRY[lf.name] = lf
        return lf
    return deco


def python_lf(name: str, fn: Callable[[str], int], column: str = "text") -> LabelingFunction:
    """An LF written as a plain Python function of one string.

    Runs as an Arrow-batched pandas UDF (the slow path; prefer Column LFs).
    The package is shipped to the Python workers, since ``fn`` may refer to it.
    """
    from pyspark.sql import SparkSession

    from quarry.session import ship_package
    active = SparkSession.getActiveSession()
    if active is not None:
        ship_package(active)

    @F.pandas_udf(T.IntegerType())
    def _apply(s: pd.Series) -> pd.Series:
        return s.map(lambda v: ABSTAIN if v is None else int(fn(v))).astype("int32")

    return LabelingFunction(name, lambda: _apply(F.col(column)))


def vote_if(cond: Column, label: int) -> Column:
    return F.when(cond, F.lit(label)).otherwise(F.lit(ABSTAIN))


# ------------------------------------------------------------------ reference LFs
# Fixed values that must equal the reference's: label codes and word sets.
ORGANIZATION, MISC = 0, 1
NEG, POS = 0, 1
POSITIVE_WORDS = ["great", "excellent", "amazing", "wonderful", "best", "fantastic"]
NEGATIVE_WORDS = ["bad", "terrible", "awful", "worst", "boring", "poor"]


def lf_years(tokens: str = "tokens") -> LabelingFunction:
    """MISC when a token is a year (``^(19|20)\\d{2}[.,]?$``)."""
    return LabelingFunction("lf_years", lambda: vote_if(tx.any_token_matches(tokens, tx.YEAR_PATTERN), MISC))


def lf_org_suffix(tokens: str = "tokens") -> LabelingFunction:
    """ORGANIZATION when a token is a company suffix (case-insensitive)."""
    return LabelingFunction("lf_org_sup", lambda: vote_if(
        tx.any_token_matches(tokens, tx.ORG_SUFFIX_PATTERN, ignore_case=True), ORGANIZATION))


def lf_token_regex(name: str, pattern: str, label: int, tokens: str = "tokens", ignore_case: bool = False) -> LabelingFunction:
    return LabelingFunction(name, lambda: vote_if(tx.any_token_matches(tokens, pattern, ignore_case), label))


def lf_words(name: str, words: Sequence[str], label: int, text_col: str = "clean",
             tokens_col: str | None = None) -> LabelingFunction:
    """``label`` when any whitespace token of ``text_col`` is in ``words``
    (or of the already-split ``tokens_col``, so several LFs share one split)."""
    if tokens_col is not None:
        wanted = F.array(*[F.lit(w) for w in sorted(set(words))])
        return LabelingFunction(name, lambda: vote_if(F.arrays_overlap(F.col(tokens_col), wanted), label))
    return LabelingFunction(name, lambda: vote_if(tx.any_word_in(text_col, words), label))


def lf_positive(text_col: str = "clean", tokens_col: str | None = None) -> LabelingFunction:
    return lf_words("lf_positive", POSITIVE_WORDS, POS, text_col, tokens_col)


def lf_negative(text_col: str = "clean", tokens_col: str | None = None) -> LabelingFunction:
    return lf_words("lf_negative", NEGATIVE_WORDS, NEG, text_col, tokens_col)


def lf_exclaim(text_col: str = "text", more_than: int = 2) -> LabelingFunction:
    """POS when the text has more than two ``!`` (use the raw text: cleaning deletes ``!``)."""
    return LabelingFunction("lf_exclaim", lambda: vote_if(tx.count_char(text_col, "!") > more_than, POS))


# ------------------------------------------------------------------ apply / masks

def apply_lfs(df: DataFrame, lfs: Sequence[LabelingFunction], id_col: str = "id",
              keep: Sequence[str] = ()) -> DataFrame:
    """The label matrix: one vote column per LF next to the row id."""
    return df.select(id_col, *keep, *[lf.column() for lf in lfs])


def any_vote(lf_cols: Sequence[str]) -> Column:
    """At least one LF voted (votes are −1 or a class id ≥ 0)."""
    return F.greatest(*[F.col(c) for c in lf_cols]) > ABSTAIN if len(lf_cols) > 1 else F.col(lf_cols[0]) > ABSTAIN


def active_rows(L: DataFrame, lf_cols: Sequence[str], id_col: str = "id") -> DataFrame:
    """Long form ``(lf, id, vote)`` of the non-abstain votes."""
    stacked = F.explode(F.array(*[F.struct(F.lit(c).alias("lf"), F.col(c).alias("vote")) for c in lf_cols]))
    return (L.select(id_col, stacked.alias("_v")).select("_v.lf", id_col, "_v.vote")
            .filter(F.col("vote") != ABSTAIN))


# ------------------------------------------------------------------ analysis

def lf_coverage_accuracy(L: DataFrame, pairs: Sequence[tuple[str, str]], places: int = 4) -> DataFrame:
    """Per LF: share of non-abstain rows, and accuracy on its active rows
    against its own truth column (0.0 when it never votes)."""
    aggs = []
    for lf, truth in pairs:
        active = F.col(lf) != ABSTAIN
        aggs += [F.avg(active.cast("double")).alias(f"{lf}__cov"),
                 F.avg(F.when(active, (F.col(lf) == F.col(truth)).cast("double"))).alias(f"{lf}__acc")]
    row = L.agg(*aggs)
    return row.select(F.explode(F.array(*[F.struct(
        F.lit(lf).alias("lf"),
        F.round(F.coalesce(F.col(f"{lf}__cov"), F.lit(0.0)), places).alias("coverage"),
        F.round(F.coalesce(F.col(f"{lf}__acc"), F.lit(0.0)), places).alias("accuracy"))
        for lf, _ in pairs])).alias("r")).select("r.*")


def lf_summary(L: DataFrame, lf_cols: Sequence[str], truth: str | None = None) -> DataFrame:
    """Polarity, coverage, overlaps, conflicts (and correct / incorrect /
    empirical accuracy when ``truth`` is given) for every LF, in one pass.

    overlap  = this LF and at least one other LF voted;
    conflict = this LF voted and at least one other LF voted differently.
    Rows with a null truth are left out of correct / incorrect.
    """
    aggs = []
    for c in lf_cols:
        others = [o for o in lf_cols if o != c]
        me = F.col(c)
        voted = me != ABSTAIN
        other_voted = F.lit(False)
        other_differs = F.lit(False)
        for o in others:
            other_voted = other_voted | (F.col(o) != ABSTAIN)
            other_differs = other_differs | ((F.col(o) != ABSTAIN) & (F.col(o) != me))
        aggs += [
            F.array_sort(F.collect_set(F.when(voted, me))).alias(f"{c}__pol"),
            F.avg(voted.cast("double")).alias(f"{c}__cov"),
            F.avg((voted & other_voted).cast("double")).alias(f"{c}__ovl"),
            F.avg((voted & other_differs).cast("double")).alias(f"{c}__cfl"),
        ]
        if truth is not None:
            known = F.col(truth).isNotNull()
            aggs += [F.count(F.when(voted & known & (me == F.col(truth)), 1)).alias(f"{c}__ok"),
                     F.count(F.when(voted & known & (me != F.col(truth)), 1)).alias(f"{c}__bad")]
    row = L.agg(*aggs)
    fields = []
    for j, c in enumerate(lf_cols):
        f = [F.lit(c).alias("lf"), F.lit(j).alias("j"), F.col(f"{c}__pol").alias("polarity"),
             F.col(f"{c}__cov").alias("coverage"), F.col(f"{c}__ovl").alias("overlaps"),
             F.col(f"{c}__cfl").alias("conflicts")]
        if truth is not None:
            ok, bad = F.col(f"{c}__ok"), F.col(f"{c}__bad")
            f += [ok.alias("correct"), bad.alias("incorrect"),
                  F.when(ok + bad > 0, ok / (ok + bad)).alias("emp_acc")]
        fields.append(F.struct(*f))
    return row.select(F.explode(F.array(*fields)).alias("r")).select("r.*")


# ------------------------------------------------------------------ aggregation

def majority_vote(lf_cols: Sequence[str], cardinality: int = 2) -> Column:
    """Most frequent non-abstain vote; ties and all-abstain give −1."""
    votes = F.array(*[F.col(c) for c in lf_cols])

    def count_of(k: int) -> Column:
        return F.size(F.filter(votes, lambda v: v == F.lit(k)))

    counts = F.array(*[count_of(k) for k in range(cardinality)])
    top = F.array_max(counts)
    n_top = F.size(F.filter(counts, lambda x: x == top))
    return (F.when((top == 0) | (n_top > 1), F.lit(ABSTAIN))
            .otherwise(F.array_position(counts, top) - 1).cast("int"))


def voter_quality(L: DataFrame, pred: str, truth: str, mask: Column, places: int = 4) -> DataFrame:
    """Accuracy over the rows the mask keeps (a tie −1 equals an abstain
    truth −1 and counts as correct, as in the reference), coverage over all
    rows, and ``accuracy_decided`` without tie predictions."""
    m = mask
    return L.agg(
        F.round(F.coalesce(F.avg(F.when(m, (F.col(pred) == F.col(truth)).cast("double"))), F.lit(0.0)), places).alias("accuracy"),
        F.round(F.avg(m.cast("double")), places).alias("coverage"),
        F.round(F.coalesce(F.avg(F.when(m & (F.col(pred) != ABSTAIN), (F.col(pred) == F.col(truth)).cast("double"))),
                           F.lit(0.0)), places).alias("accuracy_decided"),
        F.count(F.when(m, 1)).alias("n_labelled"),
    )


# ------------------------------------------------------------------ label model

def _posterior(lf_cols: Sequence[str], prior: Sequence[float], cond: Sequence[Sequence[Sequence[float]]]) -> Column:
    """P(class | votes) of a row as an array: the E step, in one expression.
    ``cond[j][y][o]`` is the probability that LF ``j`` gives outcome ``o``
    (0: abstains, then the classes) on a row of class ``y``."""
    logs = [reduce(lambda a, b: a + b, [F.lit(math.log(prior[y]))] + [
        F.element_at(F.array(*[F.lit(math.log(x)) for x in cond[j][y]]), F.col(c) + 2) for j, c in enumerate(lf_cols)])
        for y in range(len(prior))]
    table = F.array(*logs)
    top = F.array_max(table)
    odds = F.transform(table, lambda x: F.exp(x - top))
    return F.transform(odds, lambda x: x / F.aggregate(odds, F.lit(0.0), lambda a, b: a + b))


def _estimates(patterns: DataFrame, lf_cols: Sequence[str], k: int) -> tuple[list[float], list[list[list[float]]]]:
    """Class prior and each LF's outcome shares by class, both with one added
    row of each kind: the M step, one aggregate over ``patterns`` (``votes``,
    ``_n``, ``_post``).  Only its ``len(lf_cols) * (k + 1)`` sums are collected."""
    outcome = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), (F.col(c) + 1).alias("o")) for j, c in enumerate(lf_cols)]))
    sums = (patterns.select("_n", "_post", outcome.alias("v")).groupBy("v.j", "v.o")
            .agg(*[F.sum(F.col("_n") * F.col("_post")[y]).alias(f"y{y}") for y in range(k)])).collect()
    cond = [[[1.0] * (k + 1) for _ in range(k)] for _ in lf_cols]
    prior = [1.0] * k
    for r in sorted(sums, key=lambda r: (r["j"], r["o"])):
        for y in range(k):
            cond[r["j"]][y][r["o"]] += r[f"y{y}"]
            prior[y] += r[f"y{y}"] if r["j"] == 0 else 0.0
    whole = sum(prior)
    return [x / whole for x in prior], [[[x / sum(row) for x in row] for row in lf] for lf in cond]


def label_model(L: DataFrame, lf_cols: Sequence[str], cardinality: int = 2, n_epochs: int = 100,
                seed: int | None = None, tolerance: float = 1e-7) -> DataFrame:
    """Probabilistic labels from LF votes (fit + predict_proba + predict).

    Expectation maximisation over a naive-Bayes model of the votes, as Spark
    aggregates: the distinct vote patterns are counted and written once,
    however many they are, and every step is one aggregate over them.  Only
    the model's parameters reach the driver.  It begins from the share of each
    class among a row's votes (each class given ``1 / cardinality`` vote more),
    and ends after ``n_epochs`` steps or once no parameter moves by
    ``tolerance``.  The posteriors are then an expression of each row's votes:
    nothing is joined.  The fit is the same whatever ``seed``.  A null vote abstains; a vote outside the classes
    raises; equal posteriors give no label.  Not bit-equal to other solvers.
    """
    k = cardinality
    L = L.withColumns({c: F.coalesce(F.col(c), F.lit(ABSTAIN)).cast("int") for c in lf_cols})
    inside = reduce(lambda a, b: a & b, [F.col(c).between(ABSTAIN, k - 1) for c in lf_cols])
    counted = L.groupBy(*lf_cols).agg(F.count(F.lit(1)).alias("_n"))
    patterns = counted.withColumn("_n", F.when(inside, F.col("_n")).otherwise(F.raise_error(F.lit("votes outside -1..cardinality-1"))))
    checkpoint_dir(L.sparkSession)
    patterns = patterns.checkpoint()
    votes = [reduce(lambda a, b: a + b, [(F.col(c) == y).cast("double") for c in lf_cols]) + 1.0 / k for y in range(k)]
    post = F.array(*[v / reduce(lambda a, b: a + b, votes) for v in votes])
    before: list[float] = []
    for _ in range(n_epochs):
        prior, cond = _estimates(patterns.withColumn("_post", post), lf_cols, k)
        post = _posterior(lf_cols, prior, cond)
        now = [*prior, *(x for lf in cond for row in lf for x in row)]
        if before and max(abs(a - b) for a, b in zip(now, before)) < tolerance:
            break
        before = now
    top = F.array_max("probs")
    n_top = F.size(F.filter("probs", lambda p: p == top))
    return (L.withColumn("probs", post)
            .withColumn("pred", F.when(n_top > 1, F.lit(ABSTAIN)).otherwise(F.array_position("probs", top) - 1).cast("int")))
