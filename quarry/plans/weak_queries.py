"""Weak supervision queries."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as tx
from quarry.operators import weak
from quarry.plans.registry import query
from quarry.plans.sqlviews import SQL_TOKENS, register_view, with_views
from quarry.sources.text import TAG_NAMES, reviews, sentences

REVIEW_LFS = ["lf_positive", "lf_negative", "lf_exclaim", "lf_the", "lf_der"]
NER_LFS = ["lf_years", "lf_org_sup", "lf_num", "lf_cap"]
NER_PAIRS = [("lf_years", "y_misc"), ("lf_org_sup", "y_org"), ("lf_num", "y_misc"), ("lf_cap", "y_org")]


def _sql_list(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in sorted(set(words))) + "]"


_CLEAN_SQL = r"lower(regexp_replace(regexp_replace(text, '<br\s*/?>', ' ', 'g'), '[^\p{L}\p{N}_\s'']', '', 'g'))"
register_view("rev_L", f"""
SELECT id, label,
  CASE WHEN list_has_any(tok, {_sql_list(weak.POSITIVE_WORDS)}) THEN 1 ELSE -1 END AS lf_positive,
  CASE WHEN list_has_any(tok, {_sql_list(weak.NEGATIVE_WORDS)}) THEN 0 ELSE -1 END AS lf_negative,
  CASE WHEN length(text) - length(replace(text, '!', '')) > 2 THEN 1 ELSE -1 END AS lf_exclaim,
  CASE WHEN list_has_any(tok, ['the']) THEN 1 ELSE -1 END AS lf_the,
  CASE WHEN list_has_any(tok, ['der']) THEN 0 ELSE -1 END AS lf_der
FROM (SELECT id, text, label, {SQL_TOKENS.format(t=_CLEAN_SQL)} AS tok FROM reviews)""", ["reviews"])

register_view("ner_L", r"""
SELECT id, split,
  CASE WHEN list_bool_or(list_transform(tokens, lambda t: regexp_matches(t, '^(19|20)\d{2}[.,]?$'))) THEN 1 ELSE -1 END AS lf_years,
  CASE WHEN list_bool_or(list_transform(tokens, lambda t: regexp_matches(t, '(?i)^(Inc|Inc[.]|Corp|Corp[.]|Ltd|Ltd[.])$'))) THEN 0 ELSE -1 END AS lf_org_sup,
  CASE WHEN list_bool_or(list_transform(tokens, lambda t: regexp_matches(t, '^[0-9]+$'))) THEN 1 ELSE -1 END AS lf_num,
  CASE WHEN list_bool_or(list_transform(tokens, lambda t: regexp_matches(t, '(?i)^(the|and|der)$'))) THEN 0 ELSE -1 END AS lf_cap,
  CASE WHEN list_has_any(ner_tags, [3, 4]) THEN 0 ELSE -1 END AS y_org,
  CASE WHEN list_has_any(ner_tags, [7, 8]) THEN 1 ELSE -1 END AS y_misc,
  CASE WHEN list_has_any(ner_tags, [3, 4]) THEN 0 WHEN list_has_any(ner_tags, [7, 8]) THEN 1 ELSE -1 END AS y_true
FROM sentences""", ["sentences"])


def review_matrix(spark: SparkSession, sf: str) -> DataFrame:
    r = reviews(spark, sf).withColumn("tok", tx.tokens(tx.clean_text("text")))   # split once, shared by the word LFs
    lfs = [weak.lf_positive(tokens_col="tok"), weak.lf_negative(tokens_col="tok"), weak.lf_exclaim(),
           weak.lf_words("lf_the", ["the"], weak.POS, tokens_col="tok"),
           weak.lf_words("lf_der", ["der"], weak.NEG, tokens_col="tok")]
    return weak.apply_lfs(r, lfs, keep=["label"])


def ner_truth(s: DataFrame) -> DataFrame:
    """Per sentence: y_org / y_misc (entity present, else −1) and the
    priority label y_true (ORG before MISC before ABSTAIN)."""
    names = tx.tag_decode("ner_tags", TAG_NAMES)
    has_org_set = tx.any_tag_in(names, ["B-ORG", "I-ORG"])
    has_misc_set = tx.any_tag_in(names, ["B-MISC", "I-MISC"])
    return s.select(
        "*",
        F.when(has_org_set, weak.ORGANIZATION).otherwise(weak.ABSTAIN).alias("y_org"),
        F.when(has_misc_set, weak.MISC).otherwise(weak.ABSTAIN).alias("y_misc"),
        F.when(tx.any_tag_contains(names, "ORG"), weak.ORGANIZATION)
         .when(tx.any_tag_contains(names, "MISC"), weak.MISC)
         .otherwise(weak.ABSTAIN).alias("y_true"),
    )


def ner_matrix(spark: SparkSession, sf: str) -> DataFrame:
    s = ner_truth(sentences(spark, sf))
    lfs = [weak.lf_years(), weak.lf_org_suffix(),
           weak.lf_token_regex("lf_num", r"^[0-9]+$", weak.MISC),
           weak.lf_token_regex("lf_cap", r"^(the|and|der)$", weak.ORGANIZATION, ignore_case=True)]
    return weak.apply_lfs(s, lfs, keep=["split", "y_org", "y_misc", "y_true"])


@query("lf_years", with_views("SELECT id, lf_years FROM ner_L", "ner_L"))
def q_lf_years(spark: SparkSession, sf: str) -> DataFrame:
    return weak.apply_lfs(sentences(spark, sf), [weak.lf_years()])


@query("lf_org_suffix", with_views("SELECT id, lf_org_sup FROM ner_L", "ner_L"))
def q_lf_org(spark: SparkSession, sf: str) -> DataFrame:
    return weak.apply_lfs(sentences(spark, sf), [weak.lf_org_suffix()])


@query("lf_positive", with_views("SELECT id, lf_positive, lf_negative FROM rev_L", "rev_L"))
def q_lf_positive(spark: SparkSession, sf: str) -> DataFrame:
    return review_matrix(spark, sf).select("id", "lf_positive", "lf_negative")


@query("lf_negative", with_views("SELECT id, lf_negative FROM rev_L", "rev_L"))
def q_lf_negative(spark: SparkSession, sf: str) -> DataFrame:
    return review_matrix(spark, sf).select("id", "lf_negative")


@query("lf_exclaim", with_views("SELECT id, lf_exclaim FROM rev_L", "rev_L"))
def q_lf_exclaim(spark: SparkSession, sf: str) -> DataFrame:
    return review_matrix(spark, sf).select("id", "lf_exclaim")


@query("apply_lfs", with_views(f"SELECT id, label, {', '.join(REVIEW_LFS)} FROM rev_L", "rev_L"))
def q_apply_lfs(spark: SparkSession, sf: str) -> DataFrame:
    return review_matrix(spark, sf)


@query("mask_any_vote", with_views(f"SELECT id FROM rev_L WHERE greatest({', '.join(REVIEW_LFS)}) > -1", "rev_L"))
def q_mask_any_vote(spark: SparkSession, sf: str) -> DataFrame:
    L = review_matrix(spark, sf)
    return L.filter(weak.any_vote(REVIEW_LFS)).select("id")


@query("active_rows", with_views(" UNION ALL ".join(
    f"SELECT '{c}' AS lf, id, {c} AS vote FROM rev_L WHERE {c} <> -1" for c in REVIEW_LFS), "rev_L"))
def q_active_rows(spark: SparkSession, sf: str) -> DataFrame:
    return weak.active_rows(review_matrix(spark, sf), REVIEW_LFS)


@query("ner_truth_per_entity", with_views("SELECT id, y_org, y_misc FROM ner_L", "ner_L"))
def q_truth_entity(spark: SparkSession, sf: str) -> DataFrame:
    return ner_truth(sentences(spark, sf)).select("id", "y_org", "y_misc")


@query("ner_truth_priority", with_views("SELECT id, y_true FROM ner_L", "ner_L"))
def q_truth_priority(spark: SparkSession, sf: str) -> DataFrame:
    return ner_truth(sentences(spark, sf)).select("id", "y_true")


@query("fn_priority_case", with_views("SELECT id, y_true FROM ner_L", "ner_L"))
def q_priority_case(spark: SparkSession, sf: str) -> DataFrame:
    return q_truth_priority(spark, sf)


_COV_SQL = " UNION ALL ".join(
    f"SELECT '{lf}' AS lf, round(avg(CASE WHEN {lf} <> -1 THEN 1.0 ELSE 0.0 END), 4) AS coverage, "
    f"round(coalesce(avg(CASE WHEN {lf} <> -1 THEN CASE WHEN {lf} = {y} THEN 1.0 ELSE 0.0 END END), 0.0), 4) AS accuracy FROM ner_L"
    for lf, y in NER_PAIRS)


@query("lf_coverage", with_views(f"SELECT lf, coverage FROM ({_COV_SQL})", "ner_L"))
def q_lf_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return weak.lf_coverage_accuracy(ner_matrix(spark, sf), NER_PAIRS).select("lf", "coverage")


@query("lf_accuracy", with_views(f"SELECT lf, accuracy FROM ({_COV_SQL})", "ner_L"))
def q_lf_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return weak.lf_coverage_accuracy(ner_matrix(spark, sf), NER_PAIRS).select("lf", "accuracy")


def _summary_sql() -> str:
    parts = []
    for j, c in enumerate(REVIEW_LFS):
        others = [o for o in REVIEW_LFS if o != c]
        ov = " OR ".join(f"{o} <> -1" for o in others)
        cf = " OR ".join(f"({o} <> -1 AND {o} <> {c})" for o in others)
        parts.append(f"""
SELECT '{c}' AS lf, {j} AS j,
  array_to_string(list_sort(list_distinct(list_filter(list({c}), lambda v: v <> -1))), ',') AS polarity,
  round(avg(CASE WHEN {c} <> -1 THEN 1.0 ELSE 0.0 END), 6) AS coverage,
  round(avg(CASE WHEN {c} <> -1 AND ({ov}) THEN 1.0 ELSE 0.0 END), 6) AS "overlaps",
  round(avg(CASE WHEN {c} <> -1 AND ({cf}) THEN 1.0 ELSE 0.0 END), 6) AS conflicts,
  count(*) FILTER (WHERE {c} <> -1 AND label IS NOT NULL AND {c} = label) AS correct,
  count(*) FILTER (WHERE {c} <> -1 AND label IS NOT NULL AND {c} <> label) AS incorrect
FROM rev_L""")
    body = " UNION ALL ".join(parts)
    return with_views(f"""
SELECT lf, j, polarity, coverage, "overlaps", conflicts, correct, incorrect,
       round(CASE WHEN correct + incorrect > 0 THEN correct / (correct + incorrect) END, 6) AS emp_acc
FROM ({body})""", "rev_L")


@query("lf_summary", _summary_sql())
def q_lf_summary(spark: SparkSession, sf: str) -> DataFrame:
    s = weak.lf_summary(review_matrix(spark, sf), REVIEW_LFS, truth="label")
    return s.select("lf", "j", F.array_join(F.col("polarity").cast("array<string>"), ",").alias("polarity"),
                    *[F.round(c, 6).alias(c) for c in ["coverage", "overlaps", "conflicts"]],
                    "correct", "incorrect", F.round("emp_acc", 6).alias("emp_acc"))


def _mv_sql(cols, src: str) -> str:
    arr = "[" + ", ".join(cols) + "]"
    c0 = f"len(list_filter({arr}, lambda v: v = 0))"
    c1 = f"len(list_filter({arr}, lambda v: v = 1))"
    return f"CASE WHEN {c0} > {c1} THEN 0 WHEN {c1} > {c0} THEN 1 ELSE -1 END"


@query("majority_vote", with_views(f"SELECT id, {_mv_sql(REVIEW_LFS, 'rev_L')} AS pred FROM rev_L", "rev_L"))
def q_majority_vote(spark: SparkSession, sf: str) -> DataFrame:
    L = review_matrix(spark, sf)
    return L.select("id", weak.majority_vote(REVIEW_LFS).alias("pred"))


@query("voter_quality", with_views(f"""
SELECT round(coalesce(avg(CASE WHEN m THEN CASE WHEN pred = y_true THEN 1.0 ELSE 0.0 END END), 0.0), 4) AS accuracy,
       round(avg(CASE WHEN m THEN 1.0 ELSE 0.0 END), 4) AS coverage,
       round(coalesce(avg(CASE WHEN m AND pred <> -1 THEN CASE WHEN pred = y_true THEN 1.0 ELSE 0.0 END END), 0.0), 4) AS accuracy_decided,
       count(*) FILTER (WHERE m) AS n_labelled
FROM (SELECT *, greatest({', '.join(NER_LFS)}) > -1 AS m, {_mv_sql(NER_LFS, 'ner_L')} AS pred FROM ner_L)""", "ner_L"))
def q_voter_quality(spark: SparkSession, sf: str) -> DataFrame:
    L = ner_matrix(spark, sf).withColumn("pred", weak.majority_vote(NER_LFS))
    return weak.voter_quality(L, "pred", "y_true", weak.any_vote(NER_LFS))


LABEL_STEPS = 10


def _label_model_sql(cols: list[str], steps: int) -> str:
    """The steps of the EM unrolled: each reads the patterns and the last step's sums."""
    classes, outcomes = (0, 1), (0, 1, 2)
    votes = {y: " + ".join(f"({c} = {y})::INT" for c in cols) for y in classes}
    ctes = [f"pat AS MATERIALIZED (SELECT {', '.join(cols)}, count(*)::DOUBLE AS n FROM rev_L GROUP BY ALL)",
            f"e0 AS MATERIALIZED (SELECT *, (0.5 + {votes[0]})::DOUBLE / (1.0 + {votes[0]} + {votes[1]})::DOUBLE AS q0, "
            f"(0.5 + {votes[1]})::DOUBLE / (1.0 + {votes[0]} + {votes[1]})::DOUBLE AS q1 FROM pat)"]
    def score(y: int) -> str:
        parts = [f"ln(a{y} / (a0 + a1))"]
        for j, c in enumerate(cols):
            whole = " + ".join(f"s{j}_{o}_{y}" for o in outcomes)
            parts.append(f"ln(CASE {c} " + " ".join(f"WHEN {o - 1} THEN s{j}_{o}_{y}" for o in outcomes) + f" END / ({whole}))")
        return " + ".join(parts)
    for t in range(steps):
        sums = [f"1.0::DOUBLE + sum(n * q{y}) AS a{y}" for y in classes]
        sums += [f"1.0::DOUBLE + coalesce(sum(n * q{y}) FILTER ({c} = {o - 1}), 0.0::DOUBLE) AS s{j}_{o}_{y}"
                 for j, c in enumerate(cols) for o in outcomes for y in classes]
        ctes.append(f"m{t} AS MATERIALIZED (SELECT {', '.join(sums)} FROM e{t})")
        source = "pat" if t < steps - 1 else "rev_L"
        ctes.append(f"l{t} AS MATERIALIZED (SELECT {source}.*, {score(0)} AS l0, {score(1)} AS l1 FROM {source}, m{t})")
        ctes.append(f"e{t + 1} AS MATERIALIZED (SELECT * EXCLUDE (l0, l1), exp(l0 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS q0, "
                    f"exp(l1 - greatest(l0, l1)) / (exp(l0 - greatest(l0, l1)) + exp(l1 - greatest(l0, l1))) AS q1 FROM l{t})")
    return with_views(f"""SELECT * FROM (WITH {", ".join(ctes)}
SELECT id, label, CASE WHEN q0 > q1 THEN 0 WHEN q1 > q0 THEN 1 ELSE -1 END AS pred, round(q1, 6) AS p_pos FROM e{steps})""", "rev_L")


@query("label_model", _label_model_sql(REVIEW_LFS, LABEL_STEPS))
def q_label_model(spark: SparkSession, sf: str) -> DataFrame:
    out = weak.label_model(review_matrix(spark, sf), REVIEW_LFS, cardinality=2, n_epochs=LABEL_STEPS, tolerance=0.0)
    return out.select("id", "label", "pred", F.round(F.col("probs")[1], 6).alias("p_pos"))


@query("udf_labeling_function", with_views("SELECT id, lf_exclaim AS lf_exclaim_py FROM rev_L", "rev_L"))
def q_udf_lf(spark: SparkSession, sf: str) -> DataFrame:
    """An LF written as plain Python (Arrow-batched pandas UDF)."""
    lf = weak.python_lf("lf_exclaim_py", lambda s: weak.POS if s.count("!") > 2 else weak.ABSTAIN)
    return weak.apply_lfs(reviews(spark, sf), [lf])


_PY_BR = re.compile(r"<br\s*/?>")
_PY_PUNCT = re.compile(r"[^\w\s']")


def clean_text_py(s: str) -> str:
    """The review cleaning as a per-row Python function (re module)."""
    return _PY_PUNCT.sub("", _PY_BR.sub(" ", s)).lower()


@query("udf_row_apply", r"""
SELECT page_id, lower(regexp_replace(regexp_replace(html, '<br\s*/?>', ' ', 'g'), '[^\p{L}\p{N}_\s'']', '', 'g')) AS text FROM pages""")
def q_udf_row_apply(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.session import ship_package
    from quarry.sources.tables import table
    ship_package(spark)   # the UDF calls clean_text_py from this package

    @F.pandas_udf(T.StringType())
    def clean(s: pd.Series) -> pd.Series:
        return s.map(lambda v: None if v is None else clean_text_py(v))

    p = table(spark, sf, "pages", "page_id", "html")
    return p.select("page_id", clean("html").alias("text"))
