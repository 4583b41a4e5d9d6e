"""Logistic fits of a whole grid in one pass a step (O-32, O-34, O-36).

The objective, the scaling, the start and the optimisers are those of Spark
ML's ``LogisticRegression`` (binomial, intercept, standardised): L-BFGS with
a strong Wolfe search, OWL-QN with a backtracking one where there is an L1
part, ten corrections, the same limits of iterations.  Each fit is a
generator that asks for loss and gradient at a point; a round collects the
points of all fits and answers them by one pass over the blocks.
"""

from __future__ import annotations

import math
from itertools import groupby

import numpy as np
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import Vectors

from riskloom.operators.blocks import Blocks, aucs, opened

#: Rows whose margins are worked out at once.
STRETCH = 8192


class _NoStep(Exception):
    """No step can be found from the present history."""


def _direction(grad, steps, deltas):
    d, a, rho = grad.copy(), [], []
    for s, y in zip(steps, deltas):
        rho.append(s @ y)
        a.append(s @ d / rho[-1] if rho[-1] else math.nan)
        if math.isnan(a[-1]):
            raise _NoStep
        d -= a[-1] * y
    if steps:
        sy = steps[0] @ deltas[0]
        if sy < 0 or math.isnan(sy):
            raise _NoStep
        d *= sy / (deltas[0] @ deltas[0])
    for s, y, ai, r in reversed(list(zip(steps, deltas, a, rho))):
        d += (ai - y @ d / r) * s
    return -d


def _wolfe(phi, init):
    """Step that meets the strong Wolfe conditions (as in Breeze, N&W 3.5 and 3.6)."""
    f0, d0 = yield from phi(0.0)
    if d0 > 0:
        raise _NoStep

    def cubic(lo, hi):
        d1 = lo[2] + hi[2] - 3 * (lo[1] - hi[1]) / (lo[0] - hi[0])
        inside = d1 * d1 - lo[2] * hi[2]
        d2 = math.sqrt(inside) if inside >= 0 else math.nan
        width = hi[0] - lo[0]
        t = hi[0] - width * (hi[2] + d2 - d1) / (hi[2] - lo[2] + 2 * d2)
        least, most = lo[0] + 0.1 * width, lo[0] + 0.9 * width
        return least if t < least else most if t > most else t

    def zoom(lo, hi):
        for _ in range(10):
            t = cubic(hi, lo) if lo[0] > hi[0] else cubic(lo, hi)
            c = (t, *(yield from phi(t)))
            if c[1] > f0 + 1e-4 * t * d0 or c[1] >= lo[1]:
                hi = c
            else:
                if abs(c[2]) <= 0.9 * abs(d0):
                    return t
                if c[2] * (hi[0] - lo[0]) >= 0:
                    hi = lo
                lo = c
        raise _NoStep

    t, low = init, (0.0, f0, d0)
    for i in range(10):
        c = (t, *(yield from phi(t)))
        if not math.isfinite(c[1]):
            t /= 2.0
            continue
        if c[1] > f0 + 1e-4 * t * d0 or (c[1] >= low[1] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[2]) <= 0.9 * abs(d0):
            return t
        if c[2] >= 0:
            return (yield from zoom(c, low))
        low, t = c, t * 1.5
    raise _NoStep


def _backtrack(phi, init, smooth, shrink):
    """Step of Breeze's backtracking search, which takes the loss without its L1 part for that of its first state."""
    f0, d0 = yield from phi(0.0)
    t, f, d = init, smooth, (yield from phi(init))[1]
    for _ in range(19):
        if f > f0 + t * d0 * 1e-4:
            t *= shrink
        elif d < 0.9 * d0:
            t *= 2.1
        elif d > -0.9 * d0:
            t *= shrink
        else:
            break
        if not 1e-10 <= t <= 1e10:
            raise _NoStep
        f, d = yield from phi(t)
    return t


def descend(x, l1, most: int, tol: float, memory: int = 10):
    """Generator of the points where loss and gradient are wanted; returns the last iterate."""
    known = {}

    def at(p):
        key = p.tobytes()
        if key not in known:
            known[key] = yield p
        return known[key]

    def adjusted(p, f, g):
        if l1 is None:
            return f, g
        still = np.where(g - l1 > 0, g - l1, np.where(g + l1 < 0, g + l1, 0.0))
        return f + np.abs(l1 * p).sum(), np.where(l1 == 0, g, np.where(p != 0, g + np.sign(p) * l1, still))

    f, g = yield from at(x)
    fa, ga = adjusted(x, f, g)
    first, steps, deltas, failed, done, recent = fa, [], [], False, 0, [math.inf]
    while done < most and not (len(recent) > 1 and abs(fa - max(recent)) <= tol * first) and np.linalg.norm(ga) > max(tol * fa, 1e-8):
        try:
            d = _direction(ga, steps, deltas)
            if l1 is not None:
                d = np.where(d * ga < 0, d, 0.0)

            def step(t):
                moved = x + d * t
                return moved if l1 is None else np.where(np.sign(moved) == np.where(x != 0, np.sign(x), np.sign(-ga)), moved, 0.0)

            def phi(t):
                p = step(t)
                v, s = adjusted(p, *(yield from at(p)))
                return v, s @ d

            if l1 is None:
                t = yield from _wolfe(phi, 1.0 / np.linalg.norm(d) if done == 0 else 1.0)
                if t * np.linalg.norm(g) < 1e-10:
                    raise _NoStep
            else:
                t = yield from _backtrack(phi, 0.5 / np.linalg.norm(g) if done == 0 else 1.0, f, 0.1 if done == 0 else 0.5)
        except _NoStep:
            if failed:
                break
            failed, steps, deltas = True, [], []
            continue
        new = step(t)
        f_new, g_new = yield from at(new)
        steps, deltas = [new - x, *steps][:memory], [g_new - g, *deltas][:memory]
        x, f, g, failed, done = new, f_new, g_new, False, done + 1
        fa, ga = adjusted(x, f, g)
        recent = [*recent, f][-20:]
        known.clear()
        known[x.tobytes()] = (f, g)
    return x


def _losses(weights: np.ndarray, offsets: np.ndarray, folds: list):
    """Per bucket and fit: sum of losses, of residuals and of residuals times features, over rows outside the fit's fold."""
    def task(raw):
        for bucket, blocks in groupby(opened(raw), key=lambda b: b.bucket):
            out = np.zeros((len(folds), len(weights) + 2))
            for b in blocks:
                mine = np.flatnonzero([f != b.fold for f in folds])
                if not len(mine):
                    continue
                x, w, o, y = b.matrix(), weights[:, mine].T.copy(), offsets[mine][:, None], b.y.astype(float)
                for s in range(0, len(y), STRETCH):
                    xs, ys = x[:, s : s + STRETCH], y[s : s + STRETCH]
                    m = w @ xs + o
                    e = np.exp(-np.abs(m))
                    loss = np.log(1.0 + e).sum(1) + np.maximum(m, 0.0).sum(1) - m @ ys
                    r = np.where(m >= 0, 1.0, e) / (1.0 + e) - ys
                    out[mine, 0] += loss
                    out[mine, 1] += r.sum(1)
                    out[mine, 2:] += r @ xs.T
            yield bucket, out
    return task


def fit(blocks: Blocks, wanted: list[tuple], most: int, tol: float) -> list[tuple[np.ndarray, float]]:
    """(coefficients, intercept) of each wanted (fold left out or None, regParam, elasticNetParam)."""
    parts = {f: blocks.without(f) for f in {w[0] for w in wanted}}
    inverse, centre, runs = {}, {}, []
    for f, p in parts.items():
        std = p.std()
        inverse[f] = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
        centre[f] = inverse[f] * p.mean
    for f, reg, net in wanted:
        p, d = parts[f], len(centre[f])
        l1 = np.r_[np.full(d, net * reg), 0.0] if net * reg else None
        runs.append(descend(np.r_[np.zeros(d), math.log(p.pos / (p.n - p.pos))], l1, most, tol))
    points, out = {i: next(r) for i, r in enumerate(runs)}, [None] * len(runs)
    while points:
        ask = list(points)
        folds = [wanted[i][0] for i in ask]
        weights = np.stack([points[i][:-1] * inverse[f] for i, f in zip(ask, folds)], axis=1)
        offsets = np.array([points[i][-1] - points[i][:-1] @ centre[f] for i, f in zip(ask, folds)])
        sums = sum(s for _, s in sorted(blocks.run(_losses(weights, offsets, folds)), key=lambda x: x[0]))
        for i, f, s in zip(ask, folds, sums):
            n, x, l2 = parts[f].n, points[i], wanted[i][1] * (1.0 - wanted[i][2])
            grad = np.r_[(s[2:] * inverse[f] - s[1] * centre[f]) / n + l2 * x[:-1], s[1] / n]
            try:
                points[i] = runs[i].send((s[0] / n + 0.5 * l2 * (x[:-1] @ x[:-1]), grad))
            except StopIteration as e:
                x = e.value
                out[i] = (x[:-1] * inverse[f], float(x[-1] - x[:-1] @ centre[f]))
                del points[i]
    return out


def fold_aucs(blocks: Blocks, fits: dict) -> dict:
    """AUC over the fold left out of each fit; ``fits`` maps (fold, any) to (coefficients, intercept)."""
    def scorer(b, names):
        mine = [k for k in names if k[0] == b.fold]
        if not mine:
            return
        w, o = np.stack([fits[k][0] for k in mine]), np.array([fits[k][1] for k in mine])[:, None]
        m = w @ b.matrix() + o
        yield from zip(mine, 0.5 + 0.5 * m / (1.0 + np.abs(m)))  # in the order of the margins

    return aucs(blocks, list(fits), scorer)


def model(spark, est: LogisticRegression, coefficients: np.ndarray, intercept: float) -> LogisticRegressionModel:
    """Spark's model of the numbers, with the parameters of its estimator."""
    context = spark.sparkContext
    found = LogisticRegressionModel(context._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        est.uid, _py2java(context, Vectors.dense(coefficients)), float(intercept)))
    found._resetUid(est.uid)
    found._set(**{p.name: v for p, v in est._paramMap.items()})
    found._transfer_params_to_java()
    return found
