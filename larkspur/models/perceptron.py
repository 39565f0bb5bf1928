"""Mistake-driven perceptron by iterative parameter mixing.

Every epoch, each part runs over its rows from the shared weights and emits one
weight vector; Spark averages them and only that average reaches the driver.
Rows are dealt into parts and ordered by a seeded hash, so a recomputed part
repeats its epoch exactly, and SQL can follow it row by row.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.models.bayes import arg_max, linear_score
from larkspur.operators.sampling import seeded_hash
from larkspur.session import cut_lineage

#: Rows looked at together: few behind a mistake, twice as many behind rows without one.
LEAST, MOST = 8, 256


def _pass(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, int]:
    """One run over the rows: w moves by y x at every mistake."""
    mistakes, start, chunk = 0, 0, LEAST
    while start < len(x):
        stop = min(start + chunk, len(x))
        wrong = y[start:stop] * (x[start:stop] @ w) <= 0
        first = int(wrong.argmax())
        if not wrong[first]:
            start, chunk = stop, min(2 * chunk, MOST)
            continue
        at = start + first
        w = w + y[at] * x[at]
        mistakes += 1
        start, chunk = at + 1, LEAST
    return w, mistakes


def _epoch(train: DataFrame, weights: np.ndarray, classes: int) -> tuple[np.ndarray, float]:
    """Averaged weights after one pass of every part, and the mistake rate; a part's rows are together and in order."""
    def run(batches):
        part, local, rows, mistakes = None, weights.copy(), 0, 0

        def done():
            return pd.DataFrame({"w": [local.ravel().tolist()], "n": [rows], "mistakes": [mistakes]})

        for pdf in batches:
            for number, own in pdf.groupby("part", sort=False):
                if rows and number != part:
                    yield done()
                    local, rows, mistakes = weights.copy(), 0, 0
                part = number
                x = np.column_stack([np.stack(own["x"].to_numpy()), np.ones(len(own))])
                labels = own["y"].to_numpy()
                for k in range(len(local)):
                    signs = np.where(labels == (k if classes > 2 else 1), 1.0, -1.0)
                    local[k], wrong = _pass(x, signs, local[k])
                    mistakes += wrong
                rows += len(own)
        if rows:
            yield done()

    parts = train.mapInPandas(run, "w array<double>, n bigint, mistakes bigint")
    cells = parts.select("n", "mistakes", F.posexplode("w").alias("i", "v"))
    rows = cells.groupBy("i").agg(
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("v"),
        (F.sum("mistakes") / F.sum("n")).alias("rate")).orderBy("i").collect()
    return np.array([r["v"] for r in rows]).reshape(weights.shape), rows[0]["rate"]


@dataclass(frozen=True)
class Perceptron:
    features: list[str]
    weights: list[list[float]]
    epochs: int
    classes: int

    @staticmethod
    def fit(train: DataFrame, features: Sequence[str], label: str, key: str, partitions: int, classes: int = 2,
            max_iter: int = 1000, tolerance: float = 1e-3, patience: int = 5) -> "Perceptron":
        """``partitions`` parts are mixed in every epoch; the weights depend on
        their number, so it is given and not left to the cluster. Stop when the mistake rate has not improved by ``tolerance`` for
        ``patience`` epochs. Labels are 0 … classes - 1; more than two classes
        are learnt one against the rest in the same pass."""
        order = seeded_hash(key)
        part = F.pmod(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint"), F.lit(partitions))
        ready = train.select(
            F.array(*[F.col(f).cast("double") for f in features]).alias("x"),
            F.col(label).cast("int").alias("y"), part.alias("part"), order.alias("h"))
        ordered = ready.repartition(partitions, "part").sortWithinPartitions("part", "h").select("part", "x", "y")
        rows = cut_lineage(ordered).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            weights = np.zeros((classes if classes > 2 else 1, len(features) + 1))
            best, stale, epoch, kept = float("inf"), 0, 0, weights
            while epoch < max_iter and stale < patience:
                before = weights
                weights, rate = _epoch(rows, weights, classes)
                epoch += 1
                stale = 0 if rate < best - tolerance else stale + 1
                if rate < best:
                    best, kept = rate, weights
                if rate == 0:
                    kept = before
                    break
            return Perceptron(list(features), kept.tolist(), epoch, classes)
        finally:
            rows.unpersist()

    def scores(self) -> dict[int, Column]:
        if self.classes > 2:
            return {k: linear_score(self.features, w[:-1], w[-1]) for k, w in enumerate(self.weights)}
        w = self.weights[0]
        return {0: F.lit(0.0), 1: linear_score(self.features, w[:-1], w[-1])}

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        return df.withColumn(output, arg_max(self.scores()))
