"""Linear support vector machines, one against the rest, all classes in common passes.

MLlib trains one classifier per class, and each step of each of them is a job of its own: thousands
of jobs, whose fixed cost is nearly all of the time on tables of ordinary size. Here a job sums the
loss and gradient of every class that still takes steps. Objective, starting point, steps and ends
are those of MLlib's ``LinearSVC``, and what comes back is MLlib's own model.
"""

from __future__ import annotations

from collections.abc import Generator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC, LinearSVCModel, OneVsRest, OneVsRestModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEMORY = 10             # corrections kept
SEARCHES = 20           # tries for the length of a step
REMEMBERED = 20         # values that have to be as one to end the steps

Steps = Generator[np.ndarray, tuple[float, np.ndarray], np.ndarray]


class SearchFailed(Exception):
    pass


def _direction(history: list, grad: np.ndarray) -> np.ndarray:
    """Two-loop recursion, without the parts that do not descend."""
    way, alphas = grad.copy(), []
    for s, y in reversed(history):
        alphas.append(s @ way / (s @ y))
        way -= alphas[-1] * y
    if history:
        s, y = history[-1]
        if not s @ y >= 0:
            raise SearchFailed
        way *= (s @ y) / (y @ y)
    for (s, y), a in zip(history, reversed(alphas)):
        way += s * (a - y @ way / (s @ y))
    return np.where(-way * grad < 0, -way, 0.0)


def minimise(size: int, most: int, least: float) -> Steps:
    """Quasi-Newton steps that stay in an orthant; yields points and is sent value and gradient.

    Ends after ``most`` steps, or where the value has settled or the gradient vanished, to ``least``.
    """
    x = np.zeros(size)
    value, grad = yield x
    first, seen, history, failed, done = value, [np.inf], [], False, 0
    while True:
        ended = abs(value - max(seen)) <= least * abs(first)
        if done >= most or ended or np.linalg.norm(grad) <= max(least * abs(value), 1e-8):
            return x
        try:
            way = _direction(history, grad)
            orthant = np.where(x == 0, np.sign(-grad), np.sign(x))
            shrink, steep = (0.1 if done < 1 else 0.5), grad @ way
            # the search begins with the first length shortened, as MLlib's does
            length = shrink * (0.5 / np.linalg.norm(grad) if done < 1 else 1.0)
            for tried in range(1, SEARCHES + 1):
                to = x + way * length
                to = np.where(np.sign(to) == orthant, to, 0.0)
                new_value, new_grad = yield to
                along = new_grad @ way
                if new_value > value + length * steep * 1e-4:
                    length *= shrink
                elif along < 0.9 * steep:
                    length *= 2.1
                elif along > -0.9 * steep:
                    length *= shrink
                else:
                    break
                if tried >= SEARCHES or not 1e-10 <= length <= 1e10:
                    raise SearchFailed
        except SearchFailed:
            if failed:
                return x
            failed, history = True, []
            continue
        failed, done = False, done + 1
        history = [*history, (to - x, new_grad - grad)][-MEMORY:]
        x, value, grad = to, new_value, new_grad
        seen = [*seen, value][-REMEMBERED:]


def _blocks(rows: DataFrame) -> DataFrame:
    """Batches of (label, vector) as one row each of binary numbers."""
    # the functions for tasks are inner ones, so that workers need not have this package
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                y = batch.column(0).to_numpy(zero_copy_only=False).astype("<f8")
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype("<f8")
                if np.isnan(x).any() or np.isnan(y).any():
                    raise ValueError("labels and vectors must not hold NaN or null")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v.tobytes()], pa.binary()) for v in (y, x)], ["y", "x"])
    return rows.mapInArrow(run, "y binary, x binary")


def _losses(classes: np.ndarray, weights: np.ndarray, mean: np.ndarray, scale: np.ndarray):
    """For the rows of a task, the sum of the hinge losses and of their gradients per class."""
    def run(rows):
        d = len(mean)
        out = np.zeros((len(classes), d + 2))
        for block in rows:
            x = (np.frombuffer(block.x, "<f8").reshape(-1, d) - mean) * scale
            sign = np.where(np.frombuffer(block.y, "<f8")[:, None] == classes[None, :], 1.0, -1.0)
            lack = 1.0 - sign * (x @ weights[:, :d].T + weights[:, d])
            pull = np.where(lack > 0, -sign, 0.0)
            out[:, 0] += np.maximum(lack, 0.0).sum(axis=0)
            out[:, 1:d + 1] += pull.T @ x
            out[:, d + 1] += pull.sum(axis=0)
        yield out
    return run


class SharedOneVsRest(OneVsRest):
    """``OneVsRest`` of a ``LinearSVC``, the classes trained side by side."""

    def _fit(self, dataset: DataFrame) -> OneVsRestModel:
        svm = self.getClassifier()
        plain = (isinstance(svm, LinearSVC) and svm.getFitIntercept() and svm.getStandardization()
                 and not (self.isDefined(self.weightCol) and self.getWeightCol()))
        if not plain:
            return super()._fit(dataset)
        label, vector = F.col(self.getLabelCol()).cast("double"), F.col(self.getFeaturesCol())
        # what makes the vectors is run once, not in every pass
        blocks = _blocks(dataset.select(label, vector_to_array(vector))).persist()
        try:
            n, top, stats = dataset.agg(
                F.count(F.lit(1)), F.max(label),
                Summarizer.metrics("mean", "std").summary(vector)).first()
            mean, std = stats["mean"].toArray(), stats["std"].toArray()
            scale = np.divide(1.0, std, out=np.zeros_like(std), where=std != 0)
            found = self._train(blocks.rdd, n, int(top) + 1, mean, scale, svm)
        finally:
            blocks.unpersist()
        models = []
        for w in found:
            weights = w[:-1] * scale
            made = LinearSVCModel(JavaWrapper._new_java_obj(
                "org.apache.spark.ml.classification.LinearSVCModel", svm.uid,
                Vectors.dense(weights), float(w[-1] - weights @ mean)))
            models.append(svm._copyValues(made))
        return self._copyValues(OneVsRestModel(models=models))

    @staticmethod
    def _train(rows, n: int, classes: int, mean: np.ndarray, scale: np.ndarray, svm: LinearSVC
               ) -> list[np.ndarray]:
        d, reg = len(mean), svm.getRegParam()
        steps = [minimise(d + 1, svm.getMaxIter(), svm.getTol()) for _ in range(classes)]
        points, ended = {k: next(s) for k, s in enumerate(steps)}, {}
        while points:
            of, weights = np.array(list(points), float), np.array(list(points.values()))
            sums = rows.mapPartitions(_losses(of, weights, mean, scale)).treeReduce(np.add) / n
            for (k, w), found in zip(list(points.items()), sums):
                grad = found[1:].copy()
                grad[:d] += reg * w[:d]
                try:
                    points[k] = steps[k].send((found[0] + reg / 2 * (w[:d] @ w[:d]), grad))
                except StopIteration as end:
                    ended[k] = end.value
                    del points[k]
        return [ended[k] for k in range(classes)]
