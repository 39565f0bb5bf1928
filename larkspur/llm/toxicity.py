"""Toxicity by a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

A text's features are the distinct n-grams of its letters, hashed to slots. Each
present feature counts as its log-count ratio between toxic and other training
texts; a logistic model on these scaled features decides.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.words import text_buffer
from larkspur.session import cut_lineage

SLOTS_LOG2 = 20
ORDERS = (3, 4, 5)
TRAIN_ROWS = 16_000
MIN_TEXTS = 3
MIN_Z = 3.0
TASKS = 32
PENALTY = 1e-3
STEPS = 200

#: Letters stay (ASCII ones in lower case), every other ASCII byte is a blank.
_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = _LETTERS[65:91] = np.arange(97, 123)


def features(text: bytes | np.ndarray) -> np.ndarray:
    """Distinct slots of the n-grams of a text's letters; runs of other characters are one blank."""
    raw = _LETTERS[np.frombuffer(text, np.uint8) if isinstance(text, bytes) else text]
    blank = raw == 32
    keep = np.ones(len(raw), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    raw = np.concatenate(([32], raw[keep], [32])).astype(np.uint64)
    found = []
    value = raw.copy()
    for order in range(2, max(ORDERS) + 1):
        if len(raw) < order:
            break
        value = value[:-1] * np.uint64(257) + raw[order - 1:]
        if order in ORDERS:
            found.append((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOTS_LOG2))
    return np.unique(np.concatenate(found).astype(np.int32)) if found else np.zeros(0, np.int32)


def _slot_counts(batches):
    """Scan: (toxic, text) to the number of texts of each class that have a slot, per task."""
    total = np.zeros((2, 1 << SLOTS_LOG2), np.int64)
    for batch in batches:
        toxic = batch.column(0).to_pylist()
        buffer, offsets = text_buffer(batch.column(1))
        for i, label in enumerate(toxic):
            total[label, features(buffer[offsets[i]:offsets[i + 1]])] += 1
    for label in (0, 1):
        slots = np.flatnonzero(total[label]).astype(np.int32)
        for low in range(0, len(slots), 1 << 16):
            part = slots[low:low + (1 << 16)]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(part), label, np.int32)), pa.array(part), pa.array(total[label, part])],
                names=["toxic", "slot", "n"])


class Model:
    """A bias and one weight per kept slot (log-count ratio times coefficient)."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: np.ndarray) -> float:
        total = self.bias + float(self.weights[features(text)].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def _logistic(rows: DataFrame, ratios: np.ndarray) -> tuple[np.ndarray, float]:
    """Coefficients and bias of a ridge logistic model on scaled features, by accelerated gradient steps.

    ``rows`` has (toxic, slots). Each step sends the coefficients to the tasks
    that hold the rows and sums their gradients; the driver holds vectors only.
    """
    context, width = rows.sparkSession.sparkContext, len(ratios)
    scale = context.broadcast(ratios.astype(np.float32))

    def opened(part):
        part = list(part)
        if part:
            found = [np.frombuffer(r["slots"], np.int32) for r in part]
            columns = np.concatenate(found)
            whose = np.repeat(np.arange(len(part), dtype=np.int32), [len(f) for f in found])
            yield np.array([r["toxic"] for r in part], float), whose, columns, scale.value[columns]

    table = rows.rdd
    data = table.coalesce(max(1, min(table.getNumPartitions(), TASKS))).mapPartitions(opened).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        count, toxic, norm = data.map(lambda d: np.array([len(d[0]), d[0].sum(), float((d[3] * d[3]).sum(dtype=float))])).reduce(np.add)
        share = toxic / count
        rate = 1.0 / (0.25 * (norm / count + 1.0) + PENALTY)
        weigh = np.sqrt([0.5 / max(1 - share, 1e-9), 0.5 / max(share, 1e-9)])
        weigh /= weigh[0] * (1 - share) + weigh[1] * share
        now = before = np.zeros(width + 1)
        momentum = 1.0
        for _ in range(STEPS):
            ahead = context.broadcast(now)

            def slope(d, ahead=ahead):
                toxic, whose, columns, values = d
                margin = np.bincount(whose, values * ahead.value[columns], len(toxic)) + ahead.value[-1]
                error = weigh[toxic.astype(int)] * (1 / (1 + np.exp(-np.clip(margin, -500, 500))) - toxic) / count
                return np.append(np.bincount(columns, values * error[whose], width), error.sum())

            gradient = data.map(slope).reduce(np.add)
            ahead.unpersist()
            gradient[:-1] += PENALTY * now[:-1]
            new = now - rate * gradient
            after = (1 + np.sqrt(1 + 4 * momentum * momentum)) / 2
            now, before, momentum = new + (momentum - 1) / after * (new - before), new, after
        return before[:-1], float(before[-1])
    finally:
        data.unpersist()


def fit(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_id_col: str = "doc_id", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """A model from at most ``train_rows`` labelled texts, those of the least hashed ids.

    It keeps every feature whose shares differ between the classes by ``MIN_Z``
    standard errors. Of an id's texts the one of least hash is taken, so
    the bound is one on rows.

    Ids with several labels are toxic if any label is; null ids, labels and
    texts are not learned from. Without both classes every score is the share
    of toxic labels (0.5 without any). The sample's ids are broadcast: their
    number is bounded by ``train_rows``.
    """
    picked = labels.select(F.col(label_id_col).alias("_id"), F.col(label_col).cast("int").alias("toxic")) \
        .where("_id is not null and toxic in (0, 1)").groupBy("_id").agg(F.max("toxic").alias("toxic")) \
        .orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    sample = cut_lineage(
        documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).where("text is not null")
        .join(F.broadcast(picked), "_id").groupBy("_id").agg(F.first("toxic").alias("toxic"), F.min_by("text", F.xxhash64("text")).alias("text"))
        .repartition(TASKS, "_id").select("toxic", "text"))
    n = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = n.get(0, 0), n.get(1, 0)
    weights = np.zeros(1 << SLOTS_LOG2, np.float32)
    if not n0 or not n1:
        share = n1 / (n0 + n1) if n0 + n1 else 0.5
        return Model(weights, float(np.clip(np.log(max(share, 1e-9) / max(1 - share, 1e-9)), -20, 20)))
    counts = sample.mapInArrow(_slot_counts, "toxic int, slot int, n long").groupBy("slot").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("on"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("off"))
    share = (F.col("on") + F.col("off")) / F.lit(n0 + n1)
    z = F.abs(F.col("on") / n1 - F.col("off") / n0) / F.sqrt(share * (1.0000001 - share) * F.lit(1 / n0 + 1 / n1))
    kept: pd.DataFrame = counts.where((F.col("on") + F.col("off") >= MIN_TEXTS) & (z >= MIN_Z)) \
        .toPandas().sort_values("slot")
    ratios = np.log((kept["on"].to_numpy(float) + 1) / (n1 + 2)) - np.log((kept["off"].to_numpy(float) + 1) / (n0 + 2))
    slots = kept["slot"].to_numpy(np.int32)
    place = np.full(1 << SLOTS_LOG2, -1, np.int32)
    place[slots] = np.arange(len(slots))

    def rows_of(batches):
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(1))
            found = [place[features(buffer[a:b])] for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([f[f >= 0].tobytes() for f in found], pa.binary())], names=["toxic", "slots"])

    coefficient, bias = _logistic(cut_lineage(sample.mapInArrow(rows_of, "toxic int, slots binary")), ratios)
    weights[slots] = coefficient * ratios
    return Model(weights, bias)


def score(documents: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``documents`` with _toxicity, 0 to 1, which replaces a column of that name; a null text scores as an empty one."""
    documents = documents.drop("_toxicity")
    shared = documents.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def judge(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(np.frombuffer((t or "").encode("utf-8", "replace"), np.uint8)) for t in texts],
                         dtype=float)

    return documents.select("*", judge(F.col(text_col).cast("string")).alias("_toxicity"))
