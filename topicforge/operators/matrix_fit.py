"""Logistic regression of many labels at once, as one matrix of weights.

The loss of a multi-label classifier is a sum over labels, so the labels can share every pass over the
rows: a pass reads each sparse row once, gets the margins of all labels from one gather of weight rows and
adds to one gradient matrix.  Each label has its own limited-memory BFGS direction and its own step, so a
label follows the path it would follow alone, and a label that is done stays where it is while the others
go on.

A task sums its rows' gradient and gives it out in blocks of features; blocks are summed over tasks by a
shuffle on the block, so only the sums, of the size of the weights, reach the driver.  Rows are read by about
as many tasks as there are cores, so what a pass shuffles does not grow with the rows.  Weights, gradient
and the history of directions, (2 * HISTORY + 6) * features * labels doubles, must fit in the driver;
``num_features`` bounds them whatever the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HISTORY = 6
#: Features of a block, and non-zero entries that a pass takes at a time.
BLOCK, SLICE = 512, 1 << 15
#: Tasks of a pass where the session has fewer cores (or does not know them yet).
LEAST_TASKS = 16


@dataclass
class MatrixFit:
    """weights (features x labels), intercepts, and the mean loss of each label after each pass."""

    weights: np.ndarray
    intercepts: np.ndarray
    losses: list[np.ndarray]


def _few_tasks(feats: DataFrame) -> DataFrame:
    """The same rows in no more partitions than the session has cores: every task of a pass gives out a whole
    gradient, whatever the number of its rows."""
    return feats.coalesce(max(feats.sparkSession.sparkContext.defaultParallelism, LEAST_TASKS))


def _gradient(feats: DataFrame, features: str, targets: str, u: np.ndarray | None, size: int, width: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Over all rows: (features + 1) x labels gradient sums, the intercept last; loss sums; number of rows.
    Without weights: the sums of squares of the features in place of the first column, the sums of the
    targets in place of the losses."""
    sc = feats.sparkSession.sparkContext
    given = sc.broadcast(u)
    block, most = BLOCK, SLICE

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = given.value
        grad, loss, n = np.zeros((size + 1, width)), np.zeros(width), 0

        def add(idx: np.ndarray, val: np.ndarray, lens: np.ndarray, y: np.ndarray) -> None:
            row = np.repeat(np.arange(len(lens)), lens)
            order = np.argsort(idx, kind="stable")
            seen, at = np.unique(idx[order], return_index=True)
            if w is None:
                loss[:] += y.sum(0)
                if len(idx):
                    grad[seen, 0] += np.add.reduceat(val[order] ** 2, at)
                return
            z = np.tile(w[-1], (len(lens), 1))
            full = np.flatnonzero(lens)
            if len(idx):
                starts = (np.cumsum(lens) - lens)[full]
                z[full] += np.add.reduceat(val[:, None] * w[idx], starts, axis=0)
            tail = np.exp(-np.abs(z))
            loss[:] += (np.maximum(z, 0) - z * y + np.log1p(tail)).sum(0)
            miss = np.where(z >= 0, 1, tail) / (1 + tail) - y
            grad[-1] += miss.sum(0)
            if len(idx):
                grad[seen] += np.add.reduceat(val[order][:, None] * miss[row[order]], at, axis=0)

        for b in batches:
            x = b.column(0)
            # A dense vector (type 1) has no indices: every place is one.
            kinds, ind, vals = (x.field(k) for k in ("type", "indices", "values"))
            lens = np.diff(vals.offsets.to_numpy()).astype(np.int64)
            val = vals.flatten().to_numpy(zero_copy_only=False)
            if bool((kinds.to_numpy(zero_copy_only=False) == 1).any()):
                idx = np.concatenate([np.asarray(i.as_py() if k.as_py() == 0 else range(m), dtype=np.int64) for k, i, m in zip(kinds, ind, lens)])
            else:
                idx = ind.flatten().to_numpy(zero_copy_only=False)
            y = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            n += len(lens)
            ends = np.cumsum(lens)
            first = 0
            while first < len(lens):
                begin = int(ends[first] - lens[first])
                last = max(first + 1, int(np.searchsorted(ends, begin + most, side="right")))
                part = slice(begin, int(ends[last - 1]))
                add(idx[part], val[part], lens[first:last], y[first:last])
                first = last
        yield _blocks([(-1, np.append(loss, n))])
        for k in range(0, size + 1, block):
            if grad[k:k + block].any():
                yield _blocks([(k // block, grad[k:k + block])])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for b in batches:
            for k, raw in zip(b.column(0).to_pylist(), b.column(1)):
                part = np.frombuffer(raw.as_buffer(), dtype="<f8")
                if k == now:
                    total += part
                    continue
                if now is not None:
                    yield _blocks([(now, total)])
                now, total = k, part.copy()
        if now is not None:
            yield _blocks([(now, total)])

    def _blocks(parts: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int64()), pa.array([p.astype("<f8").tobytes() for _, p in parts], pa.binary())],
                                          ["block", "part"])

    schema = "block bigint, part binary"
    parts = _few_tasks(feats).select(features, F.col(targets).cast("array<double>").alias("_y")).mapInArrow(rows, schema)
    whole = parts.repartition("block").sortWithinPartitions("block").mapInArrow(sums, schema).collect()
    given.unpersist()
    grad, loss, n = np.zeros((size + 1, width)), np.zeros(width), 0.0
    for r in whole:
        part = np.frombuffer(bytes(r["part"]), dtype="<f8")
        if r["block"] < 0:
            loss, n = part[:-1].copy(), float(part[-1])
        else:
            grad[r["block"] * block:(r["block"] + 1) * block] = part.reshape(-1, width)
    return grad, loss, n


def _directions(grad: np.ndarray, s: list[np.ndarray], y: list[np.ndarray], held: list[np.ndarray]) -> np.ndarray:
    """Minus the inverse Hessian's estimate times the gradient, each label by its own history; ``held``
    says for which labels a pair of the history is filled."""
    dot = lambda a, b: np.einsum("ij,ij->j", a, b)
    q, alphas = grad.copy(), []
    scale = np.ones(grad.shape[1])
    for a, b, has in zip(s, y, held):
        sy = np.where(has, dot(a, b), 1.0)
        alpha = np.where(has, dot(a, q) / sy, 0.0)
        q -= alpha * b
        alphas.append((alpha, sy))
    for a, b, has in list(zip(s, y, held))[:1]:
        scale = np.where(has, dot(a, b) / np.where(has, dot(b, b), 1.0), 1.0)
    q *= scale
    for a, b, has, (alpha, sy) in reversed(list(zip(s, y, held, alphas))):
        beta = np.where(has, dot(b, q) / sy, 0.0)
        q += np.where(has, alpha - beta, 0.0) * a
    return -q


def fit_matrix(feats: DataFrame, features: str, targets: str, num_features: int, width: int, max_passes: int = 60,
               reg: float = 0.0, tol: float = 1e-10) -> MatrixFit:
    """Fit ``width`` logistic regressions of the vector column ``features`` to the array column ``targets``
    (labels 0 or 1, or soft targets between).  Minimises, for each label, the mean cross-entropy plus
    ``reg`` / 2 times the squared weights; the intercept is free.  Features are scaled to unit second
    moment while fitting.  A label whose targets are all 0 or all 1 gets no weights and the log odds of its
    share, half a row added to both sides; without rows everything is 0.  ``feats`` is read once a pass:
    persist it."""
    squares, sums, n = _gradient(feats, features, targets, None, num_features, width)
    if not n:
        return MatrixFit(np.zeros((num_features, width)), np.zeros(width), [])
    scale = np.sqrt(squares[:, :1] / n)
    scale[scale == 0] = 1.0
    scale[-1] = 1.0
    fixed = (sums <= 0) | (sums >= n)
    u = np.zeros((num_features + 1, width))
    u[-1] = np.log((sums + 0.5) / (n - sums + 0.5))
    ridge = reg / scale ** 2
    ridge[-1] = 0.0

    def look(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        grad, loss, _ = _gradient(feats, features, targets, at / scale, num_features, width)
        return loss / n + 0.5 * (ridge * at ** 2).sum(0), grad / scale / n + ridge * at

    value, grad = look(u)
    losses, active = [value], ~fixed
    s, y, held = [], [], []
    step = 1.0 / np.maximum(1.0, np.sqrt((grad ** 2).sum(0)))
    way = -grad
    for _ in range(max_passes):
        if not active.any():
            break
        slope = (way * grad).sum(0)
        at = u + np.where(active, step, 0.0) * way
        new_value, new_grad = look(at)
        took = active & (new_value <= value + 1e-4 * step * slope)
        moved, turned = np.where(took, at - u, 0.0), np.where(took, new_grad - grad, 0.0)
        curved = took & ((moved * turned).sum(0) > 1e-12)
        # A pair enters the history of the labels that took their step; the others keep theirs.
        if curved.any():
            if len(s) < HISTORY:
                for x, like in ((s, u), (y, u), (held, curved)):
                    x.append(np.zeros_like(like))
            for k in range(len(s) - 1, 0, -1):
                for x in (s, y, held):
                    x[k][..., curved] = x[k - 1][..., curved]
            s[0][:, curved], y[0][:, curved], held[0][curved] = moved[:, curved], turned[:, curved], True
        gain = np.where(took, value - new_value, np.inf)
        size = np.sqrt((new_grad ** 2).sum(0))
        u = np.where(took, at, u)
        value, grad = np.where(took, new_value, value), np.where(took, new_grad, grad)
        losses.append(value)
        stuck = active & ~took & (step < 1e-8)
        active = active & ~stuck & ~(took & ((gain <= tol * np.maximum(1.0, np.abs(value))) | (size <= tol)))
        fresh = _directions(grad, s, y, held)
        bad = (fresh * grad).sum(0) >= 0
        fresh[:, bad] = -grad[:, bad]
        way = np.where(took, fresh, way)
        step = np.where(took, 1.0, step * 0.5)
    weights = u / scale
    return MatrixFit(weights[:-1], weights[-1], losses)


def scorer(fit: MatrixFit, features: str, raw: str) -> LogisticRegressionModel:
    """The fit as Spark's own linear model, which gives the margins of all labels in ``raw`` from one look at
    each row.  A last margin, always 0, stands for no label: Spark wants two at least."""
    d, k = fit.weights.shape
    matrix = np.concatenate([fit.weights, np.zeros((d, 1))], axis=1)
    sc = _context()
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        "matrix_fit", _py2java(sc, DenseMatrix(k + 1, d, matrix.ravel())), _py2java(sc, Vectors.dense([*fit.intercepts, 0.0])), k + 1, True)
    return LogisticRegressionModel(made).setFeaturesCol(features).setRawPredictionCol(raw).setProbabilityCol("").setPredictionCol("")


def _context():
    from pyspark import SparkContext

    return SparkContext._active_spark_context
