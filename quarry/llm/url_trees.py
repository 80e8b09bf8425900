"""URL filter: fixed host rules, and gradient-boosted trees on lexical
features for the urls that no rule covers (native)."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, known_groups, salted

#: (verdict, host and path prefix): fixed values.
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/"))

FEATURES = ("url_chars", "host_chars", "host_labels", "host_hyphens", "path_depth", "path_chars", "digit_ratio",
            "entropy", "n_params", "param_chars", "odd_ratio", "suffix_rate", "suffix_weight", "site_rate", "site_weight")


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a url; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null if none fits)."""
    rule = verdict = F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):  # a longer rule replaces a shorter one
        h, p = r[:r.index("/")], r[r.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits."""
    n = F.length(text).cast("double")
    share = lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n
    return F.when(n > 0, F.aggregate(F.array_distinct(F.split(text, "")), F.lit(0.0),
                                     lambda acc, c: F.when(c == "", acc).otherwise(acc - share(c) * F.log2(share(c))))
                  ).otherwise(F.lit(0.0))


def lexical(df: DataFrame) -> DataFrame:
    """Lexical features of ``url, host, path``; ``suffix`` is the host's last
    label, ``site`` its last three labels."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    length = F.length(url).cast("double")
    ratio = lambda drop: F.when(length > 0, (length - F.length(F.regexp_replace(url, drop, ""))) / length).otherwise(0.0)
    return df.withColumns({
        "url_chars": length, "host_chars": F.length("host").cast("double"),
        "host_labels": F.size(F.split("host", r"\.")).cast("double"),
        "host_hyphens": (F.length("host") - F.length(F.replace(F.col("host"), F.lit("-"), F.lit("")))).cast("double"),
        "path_depth": F.size(F.filter(F.split("path", "/"), lambda x: x != "")).cast("double"),
        "path_chars": F.length("path").cast("double"), "digit_ratio": ratio("[0-9]"), "entropy": _entropy(url),
        "n_params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "param_chars": F.length(query).cast("double"), "odd_ratio": ratio("[^A-Za-z0-9/.:]"),
        "suffix": F.element_at(F.split("host", r"\."), -1),
        "site": F.array_join(F.slice(F.reverse(F.split("host", r"\.")), 1, 3), "."),
    })


def _with_rates(rows: DataFrame, key: str, blocked: float, weight: float = 20.0) -> DataFrame:
    """``rows`` with the share of blocked among the labelled urls of ``key``,
    shrunk towards the share of all, and the log of their number."""
    is_label = F.col("label").isNotNull().cast("bigint")
    groups = known_groups(rows, [key], {"n": F.sum(is_label), "x": F.sum(F.coalesce("label", F.lit(0.0)))},
                          {"n": F.sum("n"), "x": F.sum("x")})
    groups = groups.select(key, "_salt", ((F.col("x") + weight * blocked) / (F.col("n") + weight)).alias(f"{key}_rate"),
                           F.log1p("n").alias(f"{key}_weight"))
    return rows.join(groups, [key, "_salt"])


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, label_col: str | None = None,
          max_train_rows: int = 50_000, trees: int = 20, depth: int = 4, threshold: float = 0.5, seed: int = 7) -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict`` and
    ``block_score`` (the trees' probability of block; null with no model).

    Trees are trained on labelled urls: those of ``label_col`` ("allow" or
    "block", others unlabelled) or, without it, those that a rule judges.  At
    most ``max_train_rows`` of them, those of the smallest hash, are used to
    fit; suffix and site statistics count every labelled url, and every url
    is scored.  ``rules`` is a short list: each is an expression.

    A null url, or one without ``://``, has an empty host and path and gets
    the trees' verdict.  If all labels agree that label is the verdict where
    no rule fits, and "allow" if there are none.  Repeated rows and ids are
    judged row by row; an empty table gives an empty result.
    """
    label = F.col(label_col) if label_col else F.lit(None).cast("string")
    src = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).cast("string").alias("url"), label.alias("given"))
    host, path = host_path(F.col("url"))
    src = src.withColumn("host", host).withColumn("path", path)
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    src = src.withColumn("rule", rule).withColumn("ruled", verdict)
    known = F.col("given") if label_col else F.col("ruled")
    src = src.withColumn("label", F.when(known == "block", 1.0).when(known == "allow", 0.0))
    src = src.withColumn("_salt", salted("url", "page_id"))
    counts = src.agg(F.count("label").alias("n"), F.sum("label").alias("x")).first()
    n, x = counts["n"], counts["x"] or 0.0
    if not 0 < x < n:  # nothing to learn
        fixed = "block" if n and x == n else "allow"
        return src.select("page_id", "host", "path", "rule", F.coalesce("ruled", F.lit(fixed)).alias("verdict"),
                          F.lit(None).cast("double").alias("block_score"))
    rows = lexical(src)
    for key in ("suffix", "site"):
        rows = _with_rates(rows, key, x / n)
    rows = cut(rows.select("page_id", "url", "host", "path", "rule", "ruled", "label", *FEATURES))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep").transform(rows)
    order = [F.xxhash64("url", F.lit(seed)), F.col("url"), F.col("page_id")]
    train = cut(rows.filter("label IS NOT NULL").orderBy(*order).limit(max_train_rows).select("features", "label"))
    model = GBTClassifier(maxIter=trees, maxDepth=depth, seed=seed).fit(train)
    score = vector_to_array(F.col("probability"))[1]
    return (model.transform(rows)
            .select("page_id", "host", "path", "rule",
                    F.coalesce("ruled", F.when(score >= threshold, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                    score.alias("block_score")))
