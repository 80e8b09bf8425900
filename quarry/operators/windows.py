"""Window-style operators that stay parallel when one group is huge.

A plain ``row_number().over(partitionBy(g).orderBy(k))`` sends every row of
group ``g`` to one task.  The operators here split each group into buckets
of the ordering key, number rows inside a bucket, and add the bucket's
offset (a cumulative count over the small (group, bucket) count table).
The result is the exact same numbering, computed by many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.sources.tables import null_safe_join, with_scalars

KEY_SPACE = 2 ** 31
LCG_A, LCG_C = 1103515245, 12345


def rank_key(id_col: str | Column, seed: int = 0) -> Column:
    """Seeded pseudo-random order key in [0, 2^31), a bijection of ``id mod 2^31``
    (a null id counts as 0).

    The seed is mixed in before two multiplicative rounds with xor-shifts, so
    different seeds give unrelated orders.  Integer arithmetic below 2^62, so
    any SQL engine can reproduce it (``rank_key_sql``), and it does not depend
    on partitioning (unlike ``rand(seed)``).
    """
    i = F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("long"), F.lit(0).cast("long"))
    space, a = F.lit(KEY_SPACE), F.lit(LCG_A)
    h = F.pmod(F.pmod(i, space).bitwiseXOR(F.lit(_seed_mask(seed)).cast("long")) * a + F.lit(LCG_C), space)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 13)) * a + F.lit(LCG_C), space)
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 16)) * a + F.lit(LCG_C), space)
    return h.bitwiseXOR(F.shiftright(h, 15))


def _seed_mask(seed: int) -> int:
    return (seed * 0x9E3779B1 + 0x7F4A7C15) % KEY_SPACE


def rank_key_sql(id_col: str, seed: int = 0) -> str:
    """SQL twin of ``rank_key`` for non-negative ids."""
    h = f"((xor(coalesce({id_col}, 0) % {KEY_SPACE}, {_seed_mask(seed)}) * {LCG_A} + {LCG_C}) % {KEY_SPACE})"
    for shift in (13, 16):
        h = f"((xor({h}, {h} >> {shift}) * {LCG_A} + {LCG_C}) % {KEY_SPACE})"
    return f"xor({h}, {h} >> 15)"


#: Equal-width ranges of the order key that rows are numbered in.  A bucket
#: holds 1/16,384 of a group: 6M rows of a group of 10^11.
N_BUCKETS = 16_384


def rank_within(df: DataFrame, groups: Sequence[str], key: str, tiebreak: Sequence[str] = (),
                n_buckets: int | None = None, key_space: int = KEY_SPACE, name: str = "rank") -> DataFrame:
    """Exact 1-based ``row_number`` per group ordered by ``key`` (then ``tiebreak``).

    ``key`` must be a non-negative integer below ``key_space``; buckets are
    equal-width ranges of it, so a uniform key (``rank_key``) gives even
    buckets.  Only the (group, bucket) count table — at most
    ``groups × n_buckets`` rows — is windowed as a whole.  Null groups are a
    group of their own.
    """
    n_buckets = max(1, min(n_buckets or N_BUCKETS, key_space))
    width = max(1, -(-key_space // n_buckets))
    b = df.withColumn("_bucket", F.floor(F.col(key) / F.lit(width)).cast("int"))
    return _number_buckets(b, groups, key, tiebreak, name)


def smallest(df: DataFrame, groups: Sequence[str], key: str, tiebreak: Sequence[str], sizes: DataFrame | None,
             take: Column, name: str = "taken", n_buckets: int = N_BUCKETS, key_space: int = KEY_SPACE) -> DataFrame:
    """``df`` with ``name``: whether the row is among the ``take`` smallest of
    its group by ``key`` (then ``tiebreak``).

    Rows are counted per (group, bucket of the key); only the one bucket of a
    group that the cut falls into is numbered, all others are decided by their
    bucket.  ``take`` may use ``_n`` (rows of the group) and the columns of
    ``sizes`` (one row per group, or one row for no groups).
    """
    g = list(groups)
    width = max(1, -(-key_space // max(1, min(n_buckets, key_space))))
    b = df.withColumn("_bucket", F.floor(F.col(key) / F.lit(width)).cast("int"))
    counts = b.groupBy(*g, "_bucket").agg(F.count(F.lit(1)).alias("_c"))
    order = Window.partitionBy(*g).orderBy("_bucket")
    counts = (counts.withColumn("_upto", F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(*g))))
    if sizes is not None:
        counts = null_safe_join(counts, sizes, g) if g else with_scalars(counts, sizes)
    # one row per group: the bucket that the cut falls into and what is left to take there
    edge = (counts.withColumn("_take", take.cast("long")).filter((F.col("_upto") >= F.col("_take")) & (F.col("_upto") - F.col("_c") < F.col("_take")))
            .select(*g, F.col("_bucket").alias("_edge"), (F.col("_take") - F.col("_upto") + F.col("_c")).alias("_left")))
    whole = counts.groupBy(*g).agg(F.first(take.cast("long")).alias("_take"), F.first("_n").alias("_n"))
    edge = (null_safe_join(whole, edge, g, "left") if g else whole.join(edge, F.lit(True), "left"))
    edge = edge.select(*g, F.when(F.col("_take") <= 0, -1).when(F.col("_take") >= F.col("_n"), KEY_SPACE)
                       .otherwise(F.col("_edge")).alias("_edge"), F.coalesce("_left", F.lit(0)).alias("_left"))
    j = null_safe_join(b, edge, g) if g else with_scalars(b, edge)
    at_edge = F.col("_bucket") == F.col("_edge")
    in_bucket = Window.partitionBy(*g, "_bucket").orderBy(F.col(key), *[F.col(t) for t in tiebreak])
    inside = j.filter(at_edge).withColumn("_rn", F.row_number().over(in_bucket)).withColumn(name, F.col("_rn") <= F.col("_left")).drop("_rn")
    others = j.filter(~at_edge).withColumn(name, F.col("_bucket") < F.col("_edge"))
    return others.unionByName(inside).drop("_bucket", "_edge", "_left")


#: Rows that a quantile bucket holds, about.
ROWS_PER_BUCKET = 10_000_000


def quantile_bucket(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET, name: str = "_bucket",
                    n_buckets: int | None = None) -> DataFrame:
    """``df`` with ``name``: equal-depth ranges of ``key`` (a number or a
    timestamp; nulls come first), about one for ``rows_per_bucket`` rows
    (or ``n_buckets`` of them), cut at approximate quantiles and applied by binary search.  Where many
    rows lie close together the ranges are narrow; equal keys share one."""
    from pyspark.ml.feature import Bucketizer
    as_double = F.col(key).cast("double")
    n = n_buckets or -(-df.count() // rows_per_bucket)
    cuts = None
    if n > 1:
        cuts = df.agg(F.percentile_approx(as_double, [i / n for i in range(1, n)], 10 * n).alias("q")).first()["q"]
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [float("-inf"), *sorted(set(map(float, cuts))), float("inf")]
    keyed = df.withColumn("_kd", F.coalesce(as_double, F.lit(float("-inf"))))
    return (Bucketizer(splits=splits, inputCol="_kd", outputCol="_bd").transform(keyed)
            .withColumn(name, F.col("_bd").cast("int")).drop("_kd", "_bd"))


def rank_within_quantiles(df: DataFrame, groups: Sequence[str], key: str, tiebreak: Sequence[str] = (),
                          rows_per_bucket: int = ROWS_PER_BUCKET, name: str = "rank", n_buckets: int | None = None) -> DataFrame:
    """``rank_within`` for any numeric ordering key, however it is spread:
    rows are numbered inside ``quantile_bucket`` ranges, whose number follows
    the rows; ranks stay exact because a bucket is a contiguous key range."""
    return _number_buckets(quantile_bucket(df, key, rows_per_bucket, n_buckets=n_buckets), groups, key, tiebreak, name)


def _number_buckets(b: DataFrame, groups: Sequence[str], key: str, tiebreak: Sequence[str], name: str) -> DataFrame:
    gcols = list(groups)
    counts = b.groupBy(*gcols, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    w_off = Window.partitionBy(*gcols).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*gcols, "_bucket", F.coalesce(F.sum("_n").over(w_off), F.lit(0)).alias("_off"))
    w_in = Window.partitionBy(*gcols, "_bucket").orderBy(F.col(key), *[F.col(t) for t in tiebreak])
    numbered = b.withColumn("_rn", F.row_number().over(w_in))
    out = null_safe_join(numbered, offsets, [*gcols, "_bucket"])
    return out.withColumn(name, (F.col("_off") + F.col("_rn")).cast("long")).drop("_bucket", "_rn", "_off")


def per_class_sequence(df: DataFrame, label: str, id_col: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Running number per class in id order, starting at 0 (per-class file counters).
    Ids may be clustered, so buckets are cut at quantiles of the id."""
    out = rank_within_quantiles(df, [label], id_col, [id_col], rows_per_bucket, name="_seq")
    return out.withColumn("seq", F.col("_seq") - 1).drop("_seq")


def best_so_far(df: DataFrame, groups: Sequence[str], order: Sequence[str], value: str, bucket: Column | None = None,
                start: float = 0.0, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Rows whose ``value`` strictly beats every earlier value of its group
    (and ``start``): the save-the-best-checkpoint rule.

    A parallel prefix max: the running max inside each (group, bucket) plus
    the max of all earlier buckets of the group, taken from the small
    per-bucket max table.  Without ``bucket`` these are quantile ranges of
    the first ``order`` column over all rows, so an hour that holds a third of
    them is cut into a third of the ranges.  A given ``bucket`` must be
    monotone in ``order`` (e.g. the day of a timestamp).
    """
    g = list(groups)
    b = quantile_bucket(df, order[0], rows_per_bucket, "_b") if bucket is None else df.withColumn("_b", bucket)
    bmax = b.groupBy(*g, "_b").agg(F.max(value).alias("_bmax"))
    w_prev_b = Window.partitionBy(*g).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = bmax.select(*g, "_b", F.max("_bmax").over(w_prev_b).alias("_carry"))
    w_in = Window.partitionBy(*g, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = b.withColumn("_local", F.max(value).over(w_in))
    j = null_safe_join(local, carry, [*g, "_b"])
    prev = F.greatest(F.coalesce("_carry", F.lit(start)), F.coalesce("_local", F.lit(start)), F.lit(start))
    return (j.withColumn("prev_best", prev).withColumn("is_best", F.col(value) > F.col("prev_best"))
            .drop("_b", "_carry", "_local"))
