"""Quality rules with host-level verdicts.

Each document is measured once; all rule failures are aggregated by host, a
host's failure rate is shrunk towards the other hosts' by an empirical beta
prior, and the verdicts on hosts clearly above it are joined back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut, known_groups, salted, ship_package, slices, texts
from quarry.sources.tables import with_scalars

#: Symbols that rules count: fixed values.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"

#: Rules on which a document's own failure counts only if its host fails them
#: as a habit: name -> SQL condition on the measures.
SOFT_RULES = {
    "many_symbols": "n_words > 0 AND 10 * n_symbols > n_words",
    "dup_lines": "n_lines > 0 AND 10 * n_dup_lines > 3 * n_lines",
    "repeats": "n_words > 0 AND 100 * n_repeat_words > 20 * n_words",
    "word_length": "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 15 * n_words)",
}
BASE_RULE = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

#: Name of the failure of the base rule or of any other rule, for hosts.
ANY = "_any"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def repeat_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    a = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    key, kinds = a[:n], len(ids)
    for k in range(1, window):  # ranked again at each step, so that no product overflows
        key = key * kinds + a[k:n + k]
        if k + 1 < window and kinds > 1 << 20:
            key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(key, kind="stable")
    s = key[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(window):
        covered[k:n + k] |= twice
    return int(covered.sum())


def measures(text: str) -> tuple[int, ...]:
    """The ``MEASURES`` of one whole text; words are runs of non-blanks."""
    words = text.encode("utf-8", "surrogatepass").split()  # splits at the six ASCII blanks
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), repeat_words(words), len(lines))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches):
        cols = list(zip(*map(measures, texts(b.column(3))))) or [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([*b.columns[:3], *(pa.array(c, pa.int64()) for c in cols)],
                                         names=["doc_id", "host", "text_hash", *MEASURES])


def measure(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """``doc_id, host, text_hash`` and the measures, one row per input row."""
    ship_package(df.sparkSession)
    src = df.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(host_col).cast("string").alias("host"),
                    F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("text_hash"),
                    F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_measure, "doc_id bigint, host string, text_hash bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))


def host_verdicts(measured: DataFrame, threshold: float = 0.5, rules: dict[str, str] | None = None) -> DataFrame:
    """One row per (host, _salt): the host's shrunk failure rate of each rule,
    and of any rule with the base rule (``ANY``), and ``bad_<rule>``.

    The prior of a rule is the beta distribution whose mean and variance are
    those of the other hosts' raw rates (method of moments; its weight is
    between 1 and 1000 documents, and 1 where the variance is none).  A host is
    bad if its rate, less two standard deviations of its own, lies above the
    prior's mean by two of the prior's, or if it is ``threshold`` or more.  A
    host is not in its own prior, so a bad one does not raise its own cut; a
    host alone has its own rate for a mean.
    """
    rules = SOFT_RULES if rules is None else rules
    rules = rules | {ANY: " OR ".join(f"({c})" for c in (BASE_RULE, *rules.values()))}
    rows = measured.filter(F.col("host").isNotNull())
    rows = rows.select("host", "_salt", *[F.expr(f"int({c})").alias(r) for r, c in rules.items()])
    hosts = known_groups(rows, ["host"], {"n": F.count(F.lit(1)), **{r: F.sum(r) for r in rules}},
                         {"n_host": F.sum("n"), **{f"n_{r}": F.sum(r) for r in rules}})
    hosts = cut(hosts)
    rates = (hosts.groupBy("host").agg(*[F.first(F.col(f"n_{r}") / F.col("n_host")).alias(r) for r in rules]))
    sums = rates.agg(F.count(F.lit(1)).alias("hosts"), *[f(F.col(r)).alias(f"{r}_{n}") for r in rules
                                                         for n, f in (("s", F.sum), ("q", lambda x: F.sum(x * x)))])
    out = with_scalars(hosts, sums)
    for r in rules:
        x, others = F.col(f"n_{r}") / F.col("n_host"), F.greatest(F.col("hosts") - 1, F.lit(1))
        alone = F.col("hosts") == 1
        m = F.when(alone, x).otherwise(F.greatest((F.col(f"{r}_s") - x) / others, F.lit(0.0)))
        v = F.when(alone, 0.0).otherwise((F.col(f"{r}_q") - x * x) / others - F.col(f"{r}_m") ** 2)
        out = out.withColumn(f"{r}_m", m).withColumn(f"{r}_v", v)
        m, v = F.col(f"{r}_m"), F.when(F.col(f"{r}_v") > 1e-12, F.col(f"{r}_v")).otherwise(0.0)
        weight = F.when(v > 0, F.least(F.greatest(m * (1 - m) / v - 1, F.lit(1.0)), F.lit(1000.0))).otherwise(F.lit(1.0))
        out = out.withColumn(f"rate_{r}", (F.col(f"n_{r}") + m * weight) / (F.col("n_host") + weight))
        rate = F.col(f"rate_{r}")
        own = F.sqrt(F.greatest(rate * (1 - rate), F.lit(0.0)) / (F.col("n_host") + weight + 1))
        out = out.withColumn(f"bad_{r}", (rate >= threshold) | (rate - 2 * own > m + 2 * F.sqrt(v)))
    return out.select("host", "_salt", "n_host", *[f"rate_{r}" for r in rules], *[f"bad_{r}" for r in rules])


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          threshold: float = 0.5, rules: dict[str, str] | None = None) -> DataFrame:
    """One row per input row: ``doc_id, host, text_hash``, the measures, ``base_failed``,
    ``host_failed`` (the soft rules that the document fails and that its host
    fails clearly more often than the others, or where the host fails all
    rules together so; comma-joined) and ``kept``.

    A document goes if it fails the base rule, or a soft rule of
    ``host_failed``; see ``host_verdicts``.  A document that fails no rule
    stays, whatever its host.  A null text has no words (base rule); a
    null host has no verdict.  Repeated rows and ids are judged one by one; an
    empty table gives an empty result.
    """
    rules = SOFT_RULES if rules is None else rules
    rows = cut(measure(df, id_col, text_col, host_col).withColumn("_salt", salted("doc_id", "text_hash")))
    hosts = host_verdicts(rows, threshold, rules)
    out = rows.join(hosts, ["host", "_salt"], "left")
    base = F.expr(BASE_RULE)
    both = [F.when(F.expr(c) & F.coalesce(F.col(f"bad_{r}") | F.col(f"bad_{ANY}"), F.lit(False)), F.lit(r)) for r, c in rules.items()]
    failed = F.concat_ws(",", *both)
    return out.select("doc_id", "host", "text_hash", *MEASURES, base.alias("base_failed"), failed.alias("host_failed"),
                      (~base & (failed == "")).alias("kept"))

