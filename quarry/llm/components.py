"""Connected components by label propagation over DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_path, salted, written


def components(links: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node, label`` for every node of ``links`` (``a, b``); nodes are linked
    in some way if and only if their labels (the least node) are equal.

    Each round takes the least label among a node's neighbours and then that
    label's own label.  A node with very many links is dealt over salts: its
    label is sent once to each (node, salt) that occurs.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    spark, fixed, old = links.sparkSession, [], []
    both = written(both.withColumn("_salt", salted("b")), "links", fixed)
    senders = written(both.select("a", "_salt").distinct(), "senders", fixed)
    labels = written(both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("node"), F.least("a", "low").alias("label")), "labels", old)
    for _ in range(max_rounds):
        told = senders.join(labels, senders["a"] == labels["node"]).select("a", "_salt", "label")
        near = both.join(told, ["a", "_salt"]).groupBy("b").agg(F.min("label").alias("near"))
        step = (labels.join(near, labels["node"] == near["b"], "left")
                .select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")))
        step = written(step, "labels", old)
        # the label's own label: one row for each label, sent to its nodes by salt
        held = step.withColumn("_salt", salted("node"))
        wanted = held.select(F.col("label").alias("l"), "_salt").distinct()
        jump = wanted.join(step.select(F.col("node").alias("l"), F.col("label").alias("up")), "l")
        moved = (held.join(jump, (held["label"] == jump["l"]) & (held["_salt"] == jump["_salt"]), "left")
                 .select("node", "was", F.coalesce(F.least("label", "up"), "label").alias("label")))
        moved = written(moved, "labels", old)
        labels = moved.select("node", "label")
        while len(old) > 1:
            drop_path(spark, old.pop(0))
        if not moved.filter("was <> label").limit(1).count():
            for path in fixed:
                drop_path(spark, path)
            return labels
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def forest_roots(parents: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``node, label`` for ``parents`` (``a, b``: each b once, a < b): the root
    above every b, by pointer jumping; one join a round, and as many rounds as
    the logarithm of the depth."""
    spark, old = parents.sparkSession, []
    rows = written(parents.select(F.col("b").alias("node"), F.col("a").alias("label")), "roots", old)
    for _ in range(max_rounds):
        above = rows.select(F.col("node").alias("up"), F.col("label").alias("top"))
        rows = written(rows.join(above, rows["label"] == above["up"], "left")
                       .select("node", F.coalesce("top", "label").alias("label"), F.col("top").isNotNull().alias("moved")), "roots", old)
        while len(old) > 1:
            drop_path(spark, old.pop(0))
        if not rows.filter("moved").limit(1).count():
            return rows.select("node", "label")
        rows = rows.drop("moved")
    raise RuntimeError(f"a forest deeper than 2^{max_rounds}")
