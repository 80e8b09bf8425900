"""Random forests whose trees the executors grow and keep.

Spark's own fit sends dense class counts of every open node through a shuffle
and holds all trees on the driver, which deep trees outgrow.  Here a node with
at most ``LOCAL_ROWS`` rows goes to one task, which grows the rest of its
subtree; only larger nodes near the roots are split by histograms of all
tasks.  Subtrees are rows of a written table, and prediction brings the rows
to the subtrees.  The driver holds the bin borders and the nodes near the roots.

The method is that of ``RandomForestClassifier``: at most 32 bins a feature,
Poisson bags, √features drawn at each node, the Gini gain, sibling leaves of
one class pruned, votes by the classes' shares in the leaves.  Borders are
quantiles of all rows; the draws depend on the seed and the order of the rows
in ``train``.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import delete_path, scratch_path, ship_package

MAX_BINS = 32
LOCAL_ROWS = 200_000      # rows of a node that one task finishes
DRIVER_NODES = 250_000    # nodes that Spark's own fit may bring to the driver
PASS_NODES = 2_000        # nodes near the roots that one pass counts
WAVE_ROWS = 8_000_000     # copies of rows (one for each tree) that are dealt at once, or 8 of each row
CELLS = 2_000_000         # class counts that a task holds at once while it splits
ONE = 1 << 40             # a tree's vote in whole numbers, so that sums do not depend on their order


class Tree(NamedTuple):
    """Nodes by number; the children of ``i`` are ``left[i]`` and ``left[i] + 1``.
    ``feature`` is -1 where a row stops."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray


def too_deep(estimator, train: DataFrame) -> bool:
    """Spark's own fit may bring more nodes to the driver than it should hold."""
    if not isinstance(estimator, RandomForestClassifier):
        return False
    trees, full = estimator.getNumTrees(), 2 ** (estimator.getMaxDepth() + 1)
    return trees * full > DRIVER_NODES and trees * min(full, 2 * train.count()) > DRIVER_NODES


# ------------------------------------------------------------------ one subtree

def walk(tree: Tree, bins: np.ndarray) -> np.ndarray:
    """The node at which each row stops."""
    at, rows = np.zeros(len(bins), np.int32), np.arange(len(bins))
    while True:
        rows = rows[tree.feature[at[rows]] >= 0]
        if not len(rows):
            return at
        k = at[rows]
        at[rows] = tree.left[k] + (bins[rows, tree.feature[k]] > tree.cut[k])


def drawn(rng: np.random.Generator, nodes: int, width: int, m: int) -> np.ndarray:
    """``m`` of ``width`` features for each node, ascending."""
    if m >= width:
        return np.tile(np.arange(width), (nodes, 1))
    return np.sort(rng.random((nodes, width), np.float32).argpartition(m - 1, axis=1)[:, :m], axis=1)


def best_splits(hist: np.ndarray, counts: np.ndarray, ends: np.ndarray | bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of nodes' class counts ``(node, feature, bin, class)``: position of the
    best feature, its bin, the gain times the node's weight (0: none) and the
    left child's class counts.  ``ends``: the bins that may be a left child's last."""
    left = hist.cumsum(axis=2)[:, :, :-1]
    weight, squares = counts.sum(axis=1), (counts * counts).sum(axis=1)
    lw, lsq = left.sum(axis=3), np.einsum("nfbk,nfbk->nfb", left, left)
    rw = weight[:, None, None] - lw
    rsq = squares[:, None, None] - 2 * np.einsum("nfbk,nk->nfb", left, counts) + lsq
    score = np.where((lw > 0) & (rw > 0) & ends, lsq / np.maximum(lw, 1) + rsq / np.maximum(rw, 1), -1.0).reshape(len(hist), -1)
    best = score.argmax(axis=1)
    each, (f, b) = np.arange(len(hist)), np.divmod(best, left.shape[2])
    gain = score[each, best] - squares / weight
    return f, b, np.where(gain > 1e-9 * weight, gain, 0.0), left[each, f, b]


def _by_bin(bins, y, w, rows, start, size, chosen, counts, n_bins):
    """Best splits of nodes by class counts of all bins; a node's rows are
    ``rows[start:start + size]``."""
    n, m, k = len(start), chosen.shape[1], counts.shape[1]
    hist, last = np.zeros(n * m * n_bins * k), np.cumsum(size)
    for r in range(0, int(last[-1]), 50_000):
        i = np.arange(r, min(r + 50_000, last[-1]))
        g = np.searchsorted(last, i, side="right")
        some = rows[start[g] + i - (last - size)[g]]
        cell = ((g[:, None] * m + np.arange(m)) * n_bins + bins[some[:, None], chosen[g]]) * k + y[some, None]
        hist += np.bincount(cell.ravel(), np.repeat(w[some], m), len(hist))
    return best_splits(hist.reshape(n, m, n_bins, k), counts)


def _by_row(bins, y, w, rows, start, size, chosen, counts, most):
    """The same for nodes with at most ``most`` rows: the rows in order of each
    feature stand for the bins, of which few are used."""
    n, m, k = len(start), chosen.shape[1], counts.shape[1]
    there = np.arange(most) < size[:, None]
    some = rows[np.where(there, start[:, None] + np.arange(most), 0)]
    b = np.where(there[:, None], bins[some[:, None], chosen[:, :, None]], 255)
    order = b.argsort(axis=2, kind="stable")
    b = np.take_along_axis(b, order, 2)
    hist = np.zeros((n, m, most, k))
    pick = lambda v: np.take_along_axis(np.broadcast_to(v[:, None], order.shape), order, 2)[..., None]
    np.put_along_axis(hist, pick(y[some]), pick(np.where(there, w[some], 0)), 3)
    ends = (b[:, :, 1:] != b[:, :, :-1]) & (b[:, :, 1:] < 255)
    f, at, gain, left = best_splits(hist, counts, ends)
    return f, b[np.arange(n), f, at], gain, left


def grow(bins: np.ndarray, y: np.ndarray, w: np.ndarray, k: int, depth: int, m: int,
         rng: np.random.Generator, n_bins: int = MAX_BINS) -> tuple[Tree, np.ndarray, np.ndarray]:
    """A whole subtree, level by level: the pruned tree, the class counts of
    its nodes and the gain of each feature."""
    width = bins.shape[1]
    feature, cut, left, gains, level = [], [], [], [], []
    counts = [np.bincount(y, w, k)[None, :]]
    rows, node, first = np.arange(len(bins)), np.zeros(len(bins), np.int64), 0
    while True:
        c = counts[-1]
        n = len(c)
        f_, c_, g_, l_ = np.full(n, -1, np.int16), np.zeros(n, np.uint8), np.zeros(n), np.zeros((n, k))
        open_ = np.flatnonzero(c.max(axis=1) < c.sum(axis=1)) if len(counts) <= depth else np.zeros(0, np.int64)
        if len(open_):
            place = np.full(n, -1)
            place[open_] = np.arange(len(open_))
            kept = place[node] >= 0
            rows, node = rows[kept], node[kept]
            order = np.argsort(node, kind="stable")
            rows, node = rows[order], node[order]
            chosen, at = drawn(rng, len(open_), width, m), place[node]
            start = np.searchsorted(at, np.arange(len(open_) + 1))
            size = np.diff(start)
            for most, least in ((n_bins, n_bins // 2), *((p, p // 2) for p in (16, 8, 4, 2) if p < n_bins)):
                those = np.flatnonzero((size > least) & ((size <= most) | (most == n_bins)) & (size > 1 if most == 2 else True))
                step = max(1, CELLS // (m * most * k))
                for a in range(0, len(those), step):
                    g = those[a:a + step]
                    o = open_[g]
                    of = _by_bin if most == n_bins else _by_row
                    f, c_[o], g_[o], l_[o] = of(bins, y, w, rows, start[g], size[g], chosen[g], c[o], most)
                    f_[o] = np.where(g_[o] > 0, chosen[g, f], -1)
        split = np.flatnonzero(f_ >= 0)
        child = np.zeros(n, np.int32)
        child[split] = first + n + 2 * np.arange(len(split))
        feature.append(f_), cut.append(c_), left.append(child), gains.append(g_), level.append(first)
        if not len(split):
            break
        counts.append(np.stack([l_[split], c[split] - l_[split]], axis=1).reshape(-1, k))
        kept = f_[node] >= 0
        rows, node = rows[kept], node[kept]
        node = child[node] - first - n + (bins[rows, f_[node]] > c_[node])
        first += n
    feature, cut, left, gains, counts = map(np.concatenate, (feature, cut, left, gains, counts))
    said = counts.argmax(axis=1)
    for a in reversed(level):  # leaves of one class under one node become that node
        i = a + np.flatnonzero(feature[a:a + _level_size(level, a, len(feature))] >= 0)
        x = left[i]
        feature[i[(feature[x] < 0) & (feature[x + 1] < 0) & (said[x] == said[x + 1])]] = -1
    keep = np.zeros(len(feature), bool)
    keep[0] = True
    for a in level:
        i = a + np.flatnonzero(keep[a:a + _level_size(level, a, len(feature))])
        x = left[i[feature[i] >= 0]]
        keep[x] = keep[x + 1] = True
    number = np.cumsum(keep) - 1
    inner = feature >= 0
    left = np.where(inner, number[np.where(inner, left, 0)], 0).astype(np.int32)
    gain = np.bincount(feature[inner & keep], gains[inner & keep], width)
    return Tree(feature[keep], cut[keep], left[keep]), counts[keep], gain


def _level_size(level: list[int], a: int, total: int) -> int:
    i = level.index(a)
    return (level[i + 1] if i + 1 < len(level) else total) - a


# ------------------------------------------------------------------ tables of trees

MODEL = "tree int, node int, feature binary, cut binary, left binary, sizes binary, classes binary, counts binary, gain array<double>"


def _row(tree: int, node: int, t: Tree, counts: np.ndarray, gain: np.ndarray) -> dict:
    """A subtree as a row; of the class counts only those of leaves, without zeros."""
    c = counts[t.feature < 0]
    leaf, cls = np.nonzero(c)
    return {"tree": tree, "node": node, "feature": t.feature.tobytes(), "cut": t.cut.tobytes(), "left": t.left.tobytes(),
            "sizes": np.bincount(leaf, minlength=len(c)).astype(np.uint16).tobytes(), "classes": cls.astype(np.uint16).tobytes(),
            "counts": c[leaf, cls].astype(np.int64).tobytes(), "gain": gain.tolist()}


def _votes(row: dict, k: int) -> tuple[Tree, np.ndarray]:
    """The subtree of a row and each node's votes (0 at inner nodes)."""
    t = Tree(np.frombuffer(row["feature"], np.int16), np.frombuffer(row["cut"], np.uint8), np.frombuffer(row["left"], np.int32))
    sizes = np.frombuffer(row["sizes"], np.uint16)
    c = np.zeros((len(sizes), k))
    c[np.repeat(np.arange(len(sizes)), sizes), np.frombuffer(row["classes"], np.uint16)] = np.frombuffer(row["counts"], np.int64)
    votes = np.zeros((len(t.feature), k), np.int64)
    votes[t.feature < 0] = np.rint(c / c.sum(axis=1, keepdims=True) * ONE)
    return t, votes


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def bags(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bag: Poisson(1) draws that depend on
    the row's number, the tree and the seed."""
    with np.errstate(over="ignore"):
        x = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree * 0xD1B54A32D192ED03 + seed * 0x8CB92BA72F3D8DD7) % 2 ** 64)
        for _ in range(2):
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
    below = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(16)])
    return np.searchsorted(below, (x >> np.uint64(11)) / 2.0 ** 53, side="right").astype(np.uint8)


def _weights(batch: pa.RecordBatch, tree: int, n_trees: int, seed: int) -> np.ndarray:
    rows = batch.column("row").to_numpy()
    return bags(rows, tree, seed) if n_trees > 1 else np.ones(len(rows), np.uint8)


def _border_udf(borders: list[np.ndarray]) -> Callable[[Column], Column]:
    """The bins of an array of features, a byte for each."""
    @F.arrow_udf("binary")
    def bins(x: pa.Array) -> pa.Array:
        if x.null_count:
            raise ValueError("a row has no features")
        values = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(borders))
        out = np.empty(values.shape, np.uint8)
        for i, at in enumerate(borders):
            out[:, i] = np.searchsorted(at, values[:, i])
        return pa.array([r.tobytes() for r in out], pa.binary())
    return bins


def find_borders(rows: DataFrame, width: int) -> list[np.ndarray]:
    """At most 31 borders a feature; ``x`` is left of a border if it is no larger.
    Midpoints if the feature has up to 32 values, else quantiles of all rows."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list = [np.zeros(0)] * width
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for i in range(width):
                if len(seen[i]) <= MAX_BINS:
                    seen[i] = np.unique(np.concatenate([seen[i], np.unique(x[:, i])]))[:MAX_BINS + 1]
        yield pa.RecordBatch.from_pydict({"pos": pa.array(range(width), pa.int32()), "seen": pa.array([s.tolist() for s in seen], pa.list_(pa.float64()))})

    seen = rows.select("x").mapInArrow(values, "pos int, seen array<double>").groupBy("pos").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen")))), 1, MAX_BINS + 1).alias("seen"))
    few = {r["pos"]: np.array(r["seen"]) for r in seen.collect()}
    shares = [i / MAX_BINS for i in range(1, MAX_BINS)]
    many = [i for i in range(width) if len(few[i]) > MAX_BINS]
    cut = rows.agg(*[F.percentile_approx(F.col("x")[i], shares, 1000).alias(f"q{i}") for i in many]).first() if many else {}
    return [np.unique(cut[f"q{i}"]) if i in set(many) else (few[i][1:] + few[i][:-1]) / 2 for i in range(width)]


# ------------------------------------------------------------------ fit

class DeepForestClassifier(Estimator):
    """A forest with the settings of a ``RandomForestClassifier``."""

    def __init__(self, like: RandomForestClassifier | None = None):
        super().__init__()
        if like is not None:
            self.settings = {"trees": like.getNumTrees(), "depth": like.getMaxDepth(), "seed": like.getSeed(),
                             "features": like.getFeaturesCol(), "label": like.getLabelCol()}

    def _fit(self, dataset: DataFrame) -> DeepForestModel:
        s, spark = self.settings, dataset.sparkSession
        ship_package(spark)
        rows = dataset.select(vector_to_array(s["features"]).alias("x"), F.col(s["label"]).cast("double").alias("y"))
        bad = F.col("y").isNull() | F.isnan("y") | (F.col("y") < 0) | (F.col("y") != F.floor("y")) | F.col("x").isNull()
        n, classes, width, least, wrong = rows.agg(F.count(F.lit(1)), F.max("y"), F.max(F.size("x")), F.min(F.size("x")), F.count_if(bad)).first()
        if not n or wrong or width != least:
            raise ValueError(f"of {n} rows {wrong} have no features or no class from 0; features: {least} to {width}")
        k, m = int(classes) + 1, math.ceil(math.sqrt(width)) if s["trees"] > 1 else width
        borders = find_borders(rows, width)
        at = scratch_path(spark, "forest-rows")
        rows.select(_border_udf(borders)("x").alias("bins"), F.col("y").cast("int").alias("y")).withColumn(
            "row", F.monotonically_increasing_id()).write.parquet(at)
        binned = spark.read.parquet(at)
        shape = (width, k, m, s["depth"], s["trees"], s["seed"])
        tops, leaves, gains, depths = _grow_tops(binned, n, shape)
        path = scratch_path(spark, "forest")
        if leaves:
            spark.createDataFrame(leaves, MODEL).write.mode("append").parquet(path)
        for trees in _waves(s["trees"], n):
            some = {t: (tops[t], depths[t]) for t in trees}
            parts = min(4096, max(1, sum(len(d) for _, d in some.values())))
            (binned.mapInArrow(_dealt(some, shape), "tree int, node int, rows binary").repartition(parts, "tree", "node")
             .groupBy("tree", "node").applyInArrow(_grown({t: d for t, (_, d) in some.items()}, shape), MODEL)
             .write.mode("append").parquet(path))
        delete_path(spark, at)
        return DeepForestModel(borders, tops, gains, k, s, path)


def _waves(trees: int, rows: int) -> list[range]:
    each = max(8, WAVE_ROWS // max(1, rows))
    return [range(a, min(a + each, trees)) for a in range(0, trees, each)]


def _grow_tops(binned: DataFrame, n: int, shape: tuple) -> tuple[dict[int, Tree], list[dict], np.ndarray, dict[int, dict[int, int]]]:
    """The nodes near the roots with more than ``LOCAL_ROWS`` rows, level by
    level: trees, rows of their leaves, gains by tree and feature, and the open
    nodes of each tree with their depths."""
    width, k, m, depth, n_trees, seed = shape
    nodes = {t: [[-1, 0, 0]] for t in range(n_trees)}
    open_ = {t: {0: 0} for t in range(n_trees)}
    leaves, gains = [], np.zeros((n_trees, width))
    todo = [(t, 0, 0) for t in range(n_trees)] if n > LOCAL_ROWS else []

    def trees() -> dict[int, Tree]:
        return {t: Tree(*(np.array(x, kind) for x, kind in zip(zip(*v), (np.int16, np.uint8, np.int32)))) for t, v in nodes.items()}

    while todo:
        found = []
        for a in range(0, len(todo), PASS_NODES):
            some = [(t, i) for t, i, _ in todo[a:a + PASS_NODES]]
            hists = binned.mapInArrow(_counted(trees(), some, shape), "tree int, node int, hist binary")
            found += hists.repartition("tree", "node").groupBy("tree", "node").applyInArrow(
                _best(shape), "tree int, node int, feature int, cut int, gain double, here array<double>, left array<double>").collect()
        deep, todo = {(t, i): d for t, i, d in todo}, []
        for r in found:
            t, i, d = r["tree"], r["node"], deep[r["tree"], r["node"]]
            if r["gain"] <= 0 or d >= depth:
                del open_[t][i]
                leaves.append(_row(t, i, Tree(np.array([-1], np.int16), np.zeros(1, np.uint8), np.zeros(1, np.int32)), np.array([r["here"]]), np.zeros(width)))
                continue
            child = len(nodes[t])
            nodes[t][i] = [r["feature"], r["cut"], child]
            gains[t, r["feature"]] += r["gain"]
            del open_[t][i]
            for j, counts in ((child, np.array(r["left"])), (child + 1, np.array(r["here"]) - np.array(r["left"]))):
                nodes[t].append([-1, 0, 0])
                open_[t][j] = d + 1
                if counts.sum() > LOCAL_ROWS:
                    todo.append((t, j, d + 1))
    return trees(), leaves, gains, open_


def _chosen(seed: int, tree: int, node: int, width: int, m: int) -> np.ndarray:
    return drawn(np.random.default_rng([seed % 2 ** 63, tree, node, 1]), 1, width, m)[0]


def _counted(tops: dict[int, Tree], some: list[tuple[int, int]], shape: tuple):
    """Class counts of the nodes ``some`` by drawn feature and bin, a row for each task and node."""
    width, k, m, _, n_trees, seed = shape

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hist: dict = {}
        of: dict = {}
        for t, i in some:
            of.setdefault(t, []).append((i, _chosen(seed, t, i, width, m)))
        for b in batches:
            bins, y = _matrix(b.column("bins"), width), b.column("y").to_numpy()
            for t, those in of.items():
                w, at = _weights(b, t, n_trees, seed), walk(tops[t], bins)
                for i, chosen in those:
                    r = np.flatnonzero((at == i) & (w > 0))
                    if len(r):
                        cell = (np.arange(m) * MAX_BINS + bins[r[:, None], chosen]) * k + y[r, None]
                        hist[t, i] = hist.get((t, i), 0) + np.bincount(cell.ravel(), np.repeat(w[r], m), m * MAX_BINS * k)
        for (t, i), h in hist.items():
            yield pa.RecordBatch.from_pydict({"tree": pa.array([t], pa.int32()), "node": pa.array([i], pa.int32()), "hist": pa.array([h.tobytes()], pa.binary())})
    return count


def _best(shape: tuple):
    width, k, m, _, _, seed = shape

    def best(table: pa.Table) -> pa.Table:
        t, i = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        hist = np.zeros(m * MAX_BINS * k)
        for h in table.column("hist"):
            hist += np.frombuffer(h.as_py())
        hist = hist.reshape(1, m, MAX_BINS, k)
        here = hist[:, 0].sum(axis=1)
        f, b, gain, left = best_splits(hist, here)
        return pa.table({"tree": pa.array([t], pa.int32()), "node": pa.array([i], pa.int32()), "feature": pa.array([int(_chosen(seed, t, i, width, m)[f[0]])], pa.int32()),
                         "cut": pa.array([int(b[0])], pa.int32()), "gain": pa.array(gain), "here": pa.array([here[0].tolist()], pa.list_(pa.float64())),
                         "left": pa.array([left[0].tolist()], pa.list_(pa.float64()))})
    return best


def _packed(found: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    t, i, rows = zip(*found) if found else ((), (), ())
    return pa.RecordBatch.from_pydict({"tree": pa.array(t, pa.int32()), "node": pa.array(i, pa.int32()), "rows": pa.array(rows, pa.binary())})


def _dealt(some: dict[int, tuple[Tree, dict[int, int]]], shape: tuple):
    """The rows of each open node's bag, packed: bins, classes, weights."""
    width, _, _, _, n_trees, seed = shape

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins, y = _matrix(b.column("bins"), width), b.column("y").to_numpy().astype(np.uint16)
            for t, (top, open_) in some.items():
                w, at = _weights(b, t, n_trees, seed), walk(top, bins)
                found = []
                for i in np.unique(at):
                    r = np.flatnonzero((at == i) & (w > 0))
                    if int(i) in open_ and len(r):
                        found.append((t, int(i), bins[r].tobytes() + y[r].tobytes() + w[r].tobytes()))
                if found:
                    yield _packed(found)
    return deal


def _grown(depths: dict[int, dict[int, int]], shape: tuple):
    width, k, m, depth, _, seed = shape

    def grown(table: pa.Table) -> pa.Table:
        t, i = table.column("tree")[0].as_py(), table.column("node")[0].as_py()
        bins, y, w = [], [], []
        for x in table.column("rows"):
            raw = x.as_py()
            n = len(raw) // (width + 3)
            bins.append(np.frombuffer(raw, np.uint8, n * width).reshape(n, width))
            y.append(np.frombuffer(raw, np.uint16, n, n * width))
            w.append(np.frombuffer(raw, np.uint8, n, n * (width + 2)))
        made = grow(np.concatenate(bins), np.concatenate(y).astype(np.int64), np.concatenate(w).astype(float), k, depth - depths[t][i], m,
                    np.random.default_rng([seed % 2 ** 63, t, i]))
        row = _row(t, i, *made)
        kinds = {"tree": pa.int32(), "node": pa.int32(), "gain": pa.list_(pa.float64())}
        return pa.table({c: pa.array([v], kinds.get(c, pa.binary())) for c, v in row.items()})
    return grown


# ------------------------------------------------------------------ model

class DeepForestModel(Model, MLWritable, MLReadable):
    """Adds ``rawPrediction``, ``probability`` and ``prediction``."""

    def __init__(self, borders: list[np.ndarray] | None = None, tops: dict[int, Tree] | None = None, gains: np.ndarray | None = None,
                 k: int = 0, settings: dict | None = None, path: str = ""):
        super().__init__()
        self.borders, self.tops, self.gains, self.numClasses, self.settings, self.path = borders, tops, gains, k, settings, path

    @property
    def featureImportances(self) -> DenseVector:
        """Each tree's gains by feature as shares, summed over the trees, as shares."""
        spark = SparkSession.getActiveSession()
        by_tree = spark.read.parquet(self.path).select("tree", F.posexplode("gain").alias("pos", "gain")).groupBy("tree", "pos").agg(F.sum("gain").alias("gain"))
        gains = self.gains.copy()
        for r in by_tree.filter("gain > 0").collect():  # a number for each tree and feature
            gains[r["tree"], r["pos"]] += r["gain"]
        total = gains.sum(axis=1, keepdims=True)
        shares = (gains / np.where(total > 0, total, 1)).sum(axis=0)
        return Vectors.dense(shares / (shares.sum() or 1))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spark, k, width = dataset.sparkSession, self.numClasses, len(self.borders)
        ship_package(spark)
        binned = dataset.withColumn("_bins", _border_udf(self.borders)(vector_to_array(self.settings["features"])))
        at = scratch_path(spark, "forest-keys")
        binned.select(F.col("_bins").alias("bins")).distinct().write.parquet(at)  # rows of the same bins have the same votes
        keys, model, to = spark.read.parquet(at), spark.read.parquet(self.path), scratch_path(spark, "forest-votes")
        columns = [c for c in model.columns if c not in ("tree", "node", "gain")]
        cols = [f"v{i}" for i in range(k)]
        for trees in _waves(self.settings["trees"], keys.count()):
            some = {t: self.tops[t] for t in trees}
            rows = keys.mapInArrow(_routed(some, width), "tree int, node int, rows binary")
            subtrees = model.filter(F.col("tree").between(trees[0], trees[-1])).drop("gain")
            both = subtrees.withColumn("rows", F.lit(None).cast("binary")).unionByName(rows, allowMissingColumns=True)
            parts = min(4096, max(1, sum(int((t.feature < 0).sum()) for t in some.values()) // 8))
            (both.repartition(parts, "tree", "node").sortWithinPartitions("tree", "node", F.col("rows").isNotNull())
             .mapInArrow(_voted(k, width, columns), ", ".join(["_bins binary", *[f"{c} bigint" for c in cols]]))
             .write.mode("append").parquet(to))
        delete_path(spark, at)
        votes = spark.read.parquet(to).groupBy("_bins").agg(*[F.sum(c).alias(c) for c in cols])
        array = F.array(*[F.col(c) / F.lit(float(ONE)) for c in cols])
        votes = votes.select("_bins", array.alias("_votes"))
        total = F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        votes = votes.select("_bins", array_to_vector("_votes").alias("rawPrediction"),
                             array_to_vector(F.transform("_votes", lambda x: x / total)).alias("probability"),
                             (F.array_position("_votes", F.array_max("_votes")) - 1).cast("double").alias("prediction"))
        return binned.join(votes, "_bins", "left").drop("_bins")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader()


def _routed(tops: dict[int, Tree], width: int):
    """The rows of each node at which a tree's top ends, packed."""
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = _matrix(b.column("bins"), width)
            for t, top in tops.items():
                at = walk(top, bins)
                yield _packed([(t, int(i), bins[at == i].tobytes()) for i in np.unique(at)])
    return route


def _voted(k: int, width: int, columns: list[str]):
    """Votes of a task's subtrees, each before its rows; blocks of the same rows are summed."""
    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[bytes, np.ndarray] = {}
        held, key, subtree = 0, None, None

        def out() -> Iterator[pa.RecordBatch]:
            for raw, v in sums.items():
                bins = [raw[i:i + width] for i in range(0, len(raw), width)]
                yield pa.RecordBatch.from_pydict({"_bins": pa.array(bins, pa.binary()), **{f"v{i}": pa.array(v[:, i], pa.int64()) for i in range(k)}})

        for b in batches:
            trees, nodes, rows = b.column("tree").to_pylist(), b.column("node").to_pylist(), b.column("rows")
            for j, here in enumerate(zip(trees, nodes)):
                raw = rows[j].as_py()
                if raw is None:
                    key, subtree = here, _votes({c: b.column(c)[j].as_py() for c in columns}, k)
                elif key == here:  # else the tree's bag had no rows
                    v = subtree[1][walk(subtree[0], np.frombuffer(raw, np.uint8).reshape(-1, width))]
                    if raw in sums:
                        sums[raw] += v
                    else:
                        sums[raw], held = v, held + len(v)
                    if held > 300_000:
                        yield from out()
                        sums, held = {}, 0
        yield from out()
    return vote


class _ForestWriter(MLWriter):
    def __init__(self, model: DeepForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        tops = {t: [x.tolist() for x in v] for t, v in m.tops.items()}
        told = {"borders": [b.tolist() for b in m.borders], "tops": tops, "gains": m.gains.tolist(), "classes": m.numClasses, "settings": m.settings}
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"forest": json.dumps(told)})
        spark.read.parquet(m.path).write.mode("overwrite").parquet(f"{path.rstrip('/')}/trees")


class _ForestReader(MLReader):
    def load(self, path: str) -> DeepForestModel:
        d = json.loads(DefaultParamsReader.loadMetadata(path, self.sparkSession)["forest"])
        tops = {int(t): Tree(*(np.array(x, kind) for x, kind in zip(v, (np.int16, np.uint8, np.int32)))) for t, v in d["tops"].items()}
        return DeepForestModel([np.array(b) for b in d["borders"]], tops, np.array(d["gains"]), d["classes"], d["settings"], f"{path.rstrip('/')}/trees")
