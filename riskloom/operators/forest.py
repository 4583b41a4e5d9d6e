"""Random forests of a whole grid, all trees and folds in one pass a level (O-33, O-35, O-36).

The method is that of Spark ML's ``RandomForestClassifier``: at most
``MAX_BINS`` bins a feature at equal steps of weight, Poisson(1) bags, a
random subset of the square root of the features a node, the split of largest
Gini gain, siblings of one class merged at the end.  What is random follows
from the seed and the tree (for bags also the row's bucket, block and place;
for subsets the node).  So a forest of ten trees is the first ten of a forest
of twenty, and a tree of depth 5 the top of one of depth 10: the grid's
forests of a fold are grown together, each level once.

A task counts rows by (tree, node, feature of the subset, bin, class); counts
are added in a shuffle by tree, where the best splits are found as well, so
only splits reach the driver.  Memory of a task: the counts of one level.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier

from riskloom.operators.blocks import Blocks, Part, aucs, opened
from riskloom.session import scratch_path

MAX_BINS = 32
#: Levels above which counts per node would not fit a task.
DEEPEST = 12
#: Bin code (doubled) above every bin: all rows go left.
_LEFT = 255
_CELLS = 2 * MAX_BINS


def _poisson_steps() -> np.ndarray:
    terms = [math.exp(-1.0) / math.factorial(k) for k in range(12)]
    return np.minimum(np.floor(np.cumsum(terms) * 2.0**32), 2.0**32 - 1).astype(np.uint32)


_STEPS = _poisson_steps()


def bag(seed: int, bucket: int, number: int, tree: int, n: int) -> np.ndarray:
    """How often each row of a block is in a tree's bag."""
    u = np.random.PCG64([seed & 0xFFFFFFFF, bucket, number, tree]).random_raw((n + 1) // 2).view(np.uint32)[:n]
    out = np.zeros(n, np.uint8)
    for step in _STEPS:
        out += u >= step
    return out


def subsets(seed: int, trees: int, level: int, d: int, k: int) -> np.ndarray:
    """(tree, node, k) features that a split may use."""
    return np.stack([np.random.Generator(np.random.PCG64([seed & 0xFFFFFFFF, 1 << 30, t, level])).random((1 << level, d)).argsort(axis=1)[:, :k] for t in range(trees)]).astype(np.int16)


def thresholds(part: Part) -> list[np.ndarray]:
    """Split values of each feature: midpoints at about equal steps of weight (Spark's ``findSplitsForContinuousFeature``)."""
    out = []
    for values, counts in part.points:
        if len(values) <= MAX_BINS:
            out.append((values[:-1] + values[1:]) / 2)
            continue
        step = counts.sum() / MAX_BINS
        held, current, target = [], counts[0], step
        for i in range(1, len(values)):
            previous, current = current, current + counts[i]
            if abs(previous - target) < abs(current - target):
                held.append((values[i - 1] + values[i]) / 2)
                target += step
        out.append(np.array(held[: MAX_BINS - 1]))
    return out


def _codes(b, cuts: list) -> np.ndarray:
    """Doubled bin numbers of a block, feature after feature."""
    out = np.empty((len(cuts), len(b.y)), np.uint8)
    for j, cut in enumerate(cuts):
        c = b.columns[j]
        if isinstance(c, tuple):
            out[j] = (2 * np.searchsorted(cut, c[1])).astype(np.uint8).take(c[0])
        else:
            out[j] = 2 * np.searchsorted(cut, c)
    return out.ravel()


def _down(codes: np.ndarray, n: int, rows: np.ndarray, at: np.ndarray, feature: np.ndarray, bound: np.ndarray) -> np.ndarray:
    """Nodes of the next level."""
    return 2 * at + (codes.take(feature.take(at) * n + rows) > bound.take(at))


class Forest:
    """Trees of one fold while they grow, as complete levels: a node without a split sends all to its left child."""

    def __init__(self, part: Part, trees: int):
        self.cuts, self.trees = thresholds(part), trees
        self.feature, self.bound, self.gain, self.stats, self.open = [], [], [], [], np.ones((trees, 1), bool)

    def state(self) -> tuple:
        return self.cuts, self.feature, self.bound, self.open

    def grow(self, found: list) -> None:
        """Add a level; ``found`` has (feature, bin, gain, left, total) of each tree's nodes."""
        feature, bins, gain, left, total = (np.stack([f[i] for f in found]) for i in range(5))
        if not self.stats:
            self.stats.append(total)
        split = self.open & (gain > 0)
        here = self.stats[-1]
        self.feature.append(np.where(split, feature, 0).astype(np.int64))
        self.bound.append(np.where(split, 2 * bins, _LEFT).astype(np.uint8))
        self.gain.append(np.where(split, gain, -1.0))
        below = np.zeros((self.trees, 2 * split.shape[1], 2))
        below[:, 0::2] = np.where(split[..., None], left, here)
        below[:, 1::2] = np.where(split[..., None], here - left, 0.0)
        self.stats.append(below)
        self.open = np.repeat(split, 2, axis=1) & (below.min(axis=2) > 0)  # a pure node is a leaf

    def leaves(self, depth: int) -> list[np.ndarray]:
        """Per level whether a node is a leaf of the tree cut at ``depth``, siblings of one class merged."""
        out = [np.ones(self.stats[depth].shape[:2], bool)]
        for level in reversed(range(depth)):
            low, vote = out[0], self.stats[level + 1].argmax(axis=2)
            same = low[:, 0::2] & low[:, 1::2] & (vote[:, 0::2] == vote[:, 1::2])
            out.insert(0, (self.gain[level] <= 0) | same)
        return out

    def shares(self, depth: int) -> np.ndarray:
        """(tree, node at ``depth``): share of positives in the leaf that the node lies in."""
        leaf, out, done = self.leaves(depth), None, None
        for level in range(depth + 1):
            s = self.stats[level]
            own = s[..., 1] / np.maximum(s.sum(axis=2), 1.0)
            if out is None:
                out, done = own, leaf[0]
            else:
                out, done = np.where(np.repeat(done, 2, axis=1), np.repeat(out, 2, axis=1), own), np.repeat(done, 2, axis=1) | leaf[level]
        return out

    def nodes(self, trees: int, depth: int) -> list[tuple]:
        """Rows of Spark's node table: trees in preorder."""
        leaf, rows = self.leaves(depth), []
        for t in range(trees):
            count = 0

            def walk(level, at):
                nonlocal count
                mine, count = count, count + 1
                s = self.stats[level][t, at]
                n = s.sum()
                impurity = 1.0 - float(((s / n) ** 2).sum()) if n else 0.0
                place = len(rows)
                rows.append(None)
                children, split, gain = (-1, -1), (-1, [], -1), -1.0
                if not leaf[level][t, at]:
                    f, b = int(self.feature[level][t, at]), int(self.bound[level][t, at]) // 2
                    split, gain = (f, [float(self.cuts[f][b])], -1), float(self.gain[level][t, at])
                    children = walk(level + 1, 2 * at), walk(level + 1, 2 * at + 1)
                rows[place] = (t, (mine, float(s.argmax()), impurity, [float(x) for x in s], int(n), gain, *children, split))
                return mine

            walk(0, 0)
        return rows


def _best(counts: np.ndarray) -> tuple:
    """(place in the subset, bin, gain, left, total) per node of counts (k, nodes, bins, class)."""
    k, nodes = counts.shape[:2]
    counts = counts.astype(float)
    left, total = counts.cumsum(axis=2)[:, :, :-1], counts[0].sum(axis=1)
    right = total[None, :, None] - left

    def gini(c):
        n = c.sum(axis=-1)
        return n, 1.0 - ((c / np.maximum(n, 1.0)[..., None]) ** 2).sum(axis=-1)

    (n, g), (nl, gl), (nr, gr) = gini(total), gini(left), gini(right)
    n = np.maximum(n, 1.0)[None, :, None]
    gain = np.where((nl > 0) & (nr > 0), g[None, :, None] - nl / n * gl - nr / n * gr, -1.0)
    flat = gain.transpose(1, 0, 2).reshape(nodes, -1)
    at = flat.argmax(axis=1)
    place, bins, node = at // (MAX_BINS - 1), at % (MAX_BINS - 1), np.arange(nodes)
    return place, bins, flat[node, at], left[place, node, bins], total


def _counts(states: dict, picks: np.ndarray, level: int, seed: int):
    """Counts of the open nodes of a level by (fold's place, tree); ``states`` maps a left-out fold to its forest's state."""
    trees, nodes, k = picks.shape

    def task(raw):
        held = {f: np.zeros((trees, k, nodes * _CELLS), np.int64) for f in states}
        for b in opened(raw):
            n, users = len(b.y), [f for f in states if f != b.fold]
            codes = {f: _codes(b, states[f][0]) for f in users}
            for t in range(trees if users else 0):
                often = bag(seed, b.bucket, b.number, t, n)
                bagged = np.flatnonzero(often)
                for f in users:
                    _, feature, bound, is_open = states[f]
                    if not is_open[t].any():
                        continue
                    rows, at = bagged, np.zeros(len(bagged), np.int64)
                    for v in range(level):
                        at = _down(codes[f], n, rows, at, feature[v][t], bound[v][t])
                    if not is_open[t].all():
                        kept = is_open[t].take(at)
                        rows, at = rows[kept], at[kept]
                    weights, cell = often.take(rows).astype(float), at * _CELLS + b.y.take(rows)
                    for j in range(k):
                        place = picks[t, :, j].astype(np.int64).take(at) * n + rows
                        held[f][t, j] += np.bincount(cell + codes[f].take(place), weights=weights, minlength=nodes * _CELLS).astype(np.int64)
        for i, f in enumerate(states):
            for t in range(trees):
                yield i * trees + t, held[f][t].astype(np.uint32) if held[f][t].max() < 1 << 32 else held[f][t]
    return task


def _add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a.astype(np.int64) + b


def fit(blocks: Blocks, folds: list, trees: int, depth: int, seed: int) -> dict:
    """Forests of ``trees`` trees grown to ``depth``, one per left-out fold (None: all rows)."""
    forests = {f: Forest(blocks.without(f), trees) for f in folds}
    d = len(next(iter(forests.values())).cuts)
    k = d if trees == 1 else math.ceil(math.sqrt(d))
    for level in range(depth):
        picks = subsets(seed, trees, level, d, k)
        nodes = 1 << level
        task = _counts({f: x.state() for f, x in forests.items()}, picks, level, seed)
        summed = blocks.narrow(blocks.cores).mapPartitions(task).reduceByKey(_add, min(blocks.cores, len(folds) * trees), partitionFunc=int)
        best = dict(summed.mapValues(lambda c, k=k, nodes=nodes: _best(c.reshape(k, nodes, MAX_BINS, 2))).collect())
        for i, x in enumerate(forests.values()):
            found = []
            for t in range(trees):
                place, *rest = best[i * trees + t]
                found.append((picks[t, np.arange(nodes), place], *rest))
            x.grow(found)
    return forests


def fold_aucs(blocks: Blocks, forests: dict, points: list[tuple]) -> dict:
    """AUC of each (left-out fold, trees, depth) over that fold's rows."""
    depths = sorted({d for _, d in points})
    states = {f: (x.cuts, x.feature, x.bound, {d: x.shares(d) for d in depths}) for f, x in forests.items()}

    def scorer(b, names):
        wanted = [(t, d) for f, t, d in names if f == b.fold]
        if not wanted:
            return
        cuts, feature, bound, shares = states[b.fold]
        n = len(b.y)
        codes, rows, sums = _codes(b, cuts), np.arange(n), {d: np.zeros(n) for d in depths}
        for t in range(max(t for t, _ in wanted)):
            at = np.zeros(n, np.int64)
            for level in range(max(d for _, d in wanted) + 1):
                if level in sums:
                    sums[level] += shares[level][t].take(at)
                if level < len(feature):
                    at = _down(codes, n, rows, at, feature[level][t], bound[level][t])
            for d in depths:
                if (t + 1, d) in wanted:
                    yield (b.fold, t + 1, d), sums[d] / (t + 1)

    return aucs(blocks, [(f, *p) for f in forests for p in points], scorer)


_NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, gain: double, "
          "leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, numCategories: int>>")


def model(spark, est: RandomForestClassifier, forest: Forest, trees: int, depth: int) -> RandomForestClassificationModel:
    """Spark's model of the trees, with the parameters of its estimator, read from a saved model's node table."""
    context = spark.sparkContext
    ml, gateway = context._jvm.org.apache.spark, context._gateway
    zeros = gateway.new_array(gateway.jvm.double, 2)
    empty = gateway.new_array(ml.ml.classification.DecisionTreeClassificationModel, trees)
    d = len(forest.cuts)
    for t in range(trees):
        empty[t] = ml.ml.classification.DecisionTreeClassificationModel(ml.ml.tree.LeafNode(0.0, 0.0, ml.mllib.tree.impurity.GiniCalculator(zeros, 0)), d, 2)
    shell = RandomForestClassificationModel(ml.ml.classification.RandomForestClassificationModel(est.uid, empty, d, 2))
    shell._resetUid(est.uid)
    shell._set(**{p.name: v for p, v in est._paramMap.items()})
    shell._transfer_params_to_java()
    path = scratch_path(spark, "forest")
    shell.write().save(path)
    spark.createDataFrame(forest.nodes(trees, depth), _NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)
