"""Training rows in blocks: what the tuning of every grid point reads (O-34 .. O-36).

A fit of one grid point on one fold is a dozen passes over the rows, and a
grid has dozens of them.  Here all fits of a grid go forward together: one
pass gives every fit what it asks for, so a grid takes as many passes as its
slowest fit.  For that the rows lie in blocks: of one training bucket and one
fold, at most ``BLOCK`` rows, column by column.  A column with few distinct
values in a block is kept as codes of one or two bytes and its values, others
as they are; nothing is rounded.  Blocks are persisted once (memory, then
disk) and read by as many tasks as the caller says.

A task works on one block at a time and gives sums per bucket, which are
added in the buckets' order, so results do not depend on tasks or cores.
"""

from __future__ import annotations

import itertools
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 65_536
#: Points that stand for the values of a column in a bucket and fold where it has more distinct ones.
POINTS = 256
#: Score ranges of the first count of an AUC, rounds of counting, and the share of AUC that an uncut range may decide.
RANGES, ROUNDS, UNCUT = 4096, 3, 1e-5


@dataclass
class Block:
    number: int
    fold: int
    y: np.ndarray
    odd: int
    columns: list
    bucket: int = -1

    def values(self, j: int) -> np.ndarray:
        c = self.columns[j]
        return c[1].take(c[0]) if isinstance(c, tuple) else c

    def matrix(self) -> np.ndarray:
        """One row per column, in double."""
        out = np.empty((len(self.columns), len(self.y)))
        for j in range(len(out)):
            out[j] = self.values(j)
        return out

    def counts(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct values of a column, ascending, and how often each stands there."""
        c = self.columns[j]
        return (c[1], np.bincount(c[0], minlength=len(c[1])).astype(float)) if isinstance(c, tuple) else _distinct(c, np.ones(len(c)))


@dataclass
class Part:
    """What is known of the rows of a bucket or of some folds: number, positives, odd labels, moments and values per column."""
    n: int
    pos: int
    odd: int
    mean: np.ndarray
    m2: np.ndarray
    points: list

    def std(self) -> np.ndarray:
        return np.sqrt(self.m2 / (self.n - 1)) if self.n > 1 else np.zeros_like(self.m2)


def _distinct(values: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, at = np.unique(values, return_inverse=True)
    return found, np.bincount(at, weights=weights, minlength=len(found))


def _fewer(values: np.ndarray, weights: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most ``most`` points at equal steps of weight that stand for the values; all of them where they are few."""
    if len(values) <= most:
        return values, weights
    total = weights.sum()
    at = np.searchsorted(np.cumsum(weights), (np.arange(most) + 0.5) * (total / most))
    return _distinct(values[np.minimum(at, len(values) - 1)], np.full(most, total / most))


def merged(parts: list[Part], most: int | None = None) -> Part | None:
    """One part of several, added in their order."""
    parts = [p for p in parts if p.n]
    if not parts:
        return None
    n, mean, m2 = 0, np.zeros_like(parts[0].mean), np.zeros_like(parts[0].m2)
    for p in parts:
        delta, both = p.mean - mean, n + p.n
        mean, m2, n = mean + delta * (p.n / both), m2 + p.m2 + delta * delta * (n / both * p.n), both
    points = []
    for j in range(len(mean)):
        pts = _distinct(np.concatenate([p.points[j][0] for p in parts]), np.concatenate([p.points[j][1] for p in parts]))
        points.append(pts if most is None else _fewer(*pts, most))
    return Part(n, sum(p.pos for p in parts), sum(p.odd for p in parts), mean, m2, points)


def _column(c: np.ndarray):
    coded = pa.array(c).dictionary_encode()
    if 4 * len(coded.dictionary) > len(c):
        return np.ascontiguousarray(c)
    values = coded.dictionary.to_numpy()
    order = np.argsort(values, kind="stable")
    rank = np.empty(len(values), np.uint8 if len(values) <= 256 else np.uint16)
    rank[order] = np.arange(len(values))
    return rank.take(coded.indices.to_numpy()), values[order]


def _pack(batches):
    """Arrow batches of (x, y, f) of one bucket -> its blocks, cut where a fold has ``BLOCK`` rows."""
    number, held = itertools.count(), {}

    def block(fold, x, y):
        made = Block(next(number), fold, (y == 1).astype(np.uint8), int(((y != 0) & (y != 1)).sum()), [_column(x[:, j]) for j in range(x.shape[1])])
        return pa.RecordBatch.from_pydict({"block": pa.array([pickle.dumps(made, protocol=5)], pa.binary())})

    for batch in batches:
        if not batch.num_rows:
            continue
        x, y, f = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False), batch.column(2)
        if x.null_count or f.null_count:
            raise ValueError("null features or folds in the training rows")
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        if not np.isfinite(x).all() or np.isnan(y).any():
            raise ValueError("features must be finite and labels not null in the training rows")
        f = f.to_numpy(zero_copy_only=False)
        for fold in np.unique(f):
            xs, ys, n = held.setdefault(int(fold), ([], [], 0))
            mine = f == fold
            xs.append(x[mine])
            ys.append(y[mine])
            n += len(ys[-1])
            if n >= BLOCK:
                x_all, y_all = np.concatenate(xs), np.concatenate(ys)
                while n >= BLOCK:
                    yield block(int(fold), x_all[:BLOCK], y_all[:BLOCK])
                    x_all, y_all, n = x_all[BLOCK:], y_all[BLOCK:], n - BLOCK
                xs, ys = [x_all.copy()], [y_all.copy()]
            held[int(fold)] = (xs, ys, n)
    for fold in sorted(held):
        xs, ys, n = held[fold]
        if n:
            yield block(fold, np.concatenate(xs), np.concatenate(ys))


def _numbered(bucket: int, rows):
    """Blocks with their bucket: the partition of the dealt rows, which a task that reads several of them cannot tell later."""
    return ((bucket, bytes(r[0])) for r in rows)


def opened(raw):
    """The blocks of a task, one at a time."""
    for bucket, data in raw:
        b = pickle.loads(data)
        b.bucket = bucket
        yield b


def _summarise(raw):
    for bucket, blocks in itertools.groupby(opened(raw), key=lambda b: b.bucket):
        parts: dict[int, Part] = {}
        for b in blocks:
            d, n = len(b.columns), len(b.y)
            points = [b.counts(j) for j in range(d)]
            mean = np.array([w @ v / n for v, w in points])
            m2 = np.array([w @ (v - m) ** 2 for (v, w), m in zip(points, mean)])
            one = Part(n, int(b.y.sum()), b.odd, mean, m2, [_fewer(*p, 4 * POINTS) for p in points])
            parts[b.fold] = merged([parts[b.fold], one], 4 * POINTS) if b.fold in parts else one
        for fold, p in parts.items():
            yield bucket, fold, Part(p.n, p.pos, p.odd, p.mean, p.m2, [_fewer(*x, POINTS) for x in p.points])


class Blocks:
    """The blocks of a training set, persisted until ``release``, with what is known of each fold."""

    def __init__(self, data: DataFrame, label: str, fold: str, tasks: int, cores: int | None = None, features: str = "features"):
        rows = data.select(vector_to_array(F.col(features)).alias("x"), F.col(label).cast("double").alias("y"), F.col(fold).cast("int").alias("f"))
        self.rdd = rows.mapInArrow(_pack, "block binary").rdd.mapPartitionsWithIndex(_numbered).persist(StorageLevel.MEMORY_AND_DISK)
        self.tasks, self.cores = tasks, min(cores or tasks, tasks)
        try:
            parts = sorted(self.run(_summarise), key=lambda p: p[:2])
        except BaseException:
            self.release()
            raise
        self.folds = {f: merged([p for _, g, p in parts if g == f]) for f in sorted({f for _, f, _ in parts})}

    def narrow(self, tasks: int):
        """The blocks in no more than ``tasks`` partitions (buckets stay whole)."""
        return self.rdd.coalesce(tasks) if tasks < self.rdd.getNumPartitions() else self.rdd

    def run(self, task) -> list:
        """What ``task`` yields over the blocks of each task."""
        return self.narrow(self.tasks).mapPartitions(task).collect()

    def without(self, fold: int | None) -> Part | None:
        """The rows of all folds but one."""
        return merged([p for f, p in self.folds.items() if f != fold])

    def complete(self, folds: int) -> bool:
        """Whether all folds have rows, all labels are 0 or 1 and both are there without any one fold."""
        rest = [self.without(f) for f in range(folds)]
        return sorted(self.folds) == list(range(folds)) and all(p and not p.odd and 0 < p.pos < p.n for p in rest)

    def release(self) -> None:
        self.rdd.unpersist()


def _counter(scorer, edges: dict):
    """Per name: rows of each range by label, least and largest score of each range."""
    def count(raw):
        found = {}
        for b in opened(raw):
            for name, s in scorer(b, edges):
                e = edges[name]
                if name not in found:
                    found[name] = np.zeros(2 * (len(e) + 1), np.int64), np.full(len(e) + 1, np.inf), np.full(len(e) + 1, -np.inf)
                held, low, high = found[name]
                at = np.searchsorted(e, s, side="right")
                held += np.bincount(at * 2 + b.y, minlength=len(held))
                np.minimum.at(low, at, s)
                np.maximum.at(high, at, s)
        yield from found.items()
    return count


def aucs(blocks: Blocks, names: list, scorer) -> dict:
    """Area under ROC of each name over the rows that ``scorer(block, names)`` gives scores between 0 and 1 for.

    Rows are counted in score ranges, each counting as a tie.  Ranges with
    different scores that could decide more than ``UNCUT`` of the area are
    cut between their least and largest score and counted again.
    """
    edges, out = {name: np.arange(1, RANGES) / RANGES for name in names}, {}
    for left in reversed(range(ROUNDS)):
        sums: dict = {}
        for name, (held, low, high) in blocks.run(_counter(scorer, edges)):
            h, lo, hi = sums.get(name, (0, np.inf, -np.inf))
            sums[name] = h + held, np.minimum(lo, low), np.maximum(hi, high)
        again = {}
        for name, (held, low, high) in sums.items():
            neg, pos = held[0::2].astype(object), held[1::2].astype(object)
            n, p = int(neg.sum()), int(pos.sum())
            if not n or not p:  # as Spark's evaluator has it
                out[name] = 0.0 if not p else 1.0
                continue
            below = np.concatenate([[0], np.cumsum(neg)[:-1]])
            out[name] = int((pos * (2 * below + neg)).sum()) / (2 * n * p)
            heavy = np.flatnonzero((held[0::2] / n * (held[1::2] / p) / 2 > UNCUT) & (low < high))
            if left and len(heavy):
                cuts = max(2, RANGES // len(heavy))
                again[name] = np.unique(np.concatenate([edges[name], *[np.linspace(low[i], high[i], cuts + 1)[1:] for i in heavy]]))
        if not again:
            break
        edges = again
    return out
