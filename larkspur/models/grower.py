"""Growing trees from histograms: single trees, forests and second-order boosting.

Rows are cut into bins once and kept in columnar chunks. A cell is a node's
sums over one bin of one feature: rows, weight (or second derivative) and
weighted targets (or first derivative). Splits need cells only, so tasks send
sums and never meet a tree.

A forest's rows keep their node in every tree. Nodes of many rows are split
level by level from summed cells; a node of at most ``LOCAL`` rows has its rows
brought to one task, which grows everything below it. Boosting sums the cells
of one level of one tree at a time.

Bootstrap weights and the features a node may use follow from hashes of row,
tree and node, and sums of whole numbers are exact, so the same trees can be
found by SQL.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut_lineage, ensure_checkpoint_dir, spread

MAX_BINS = 64
CHUNK_ROWS = 8192
#: Chunks a task holds at a time, as a rule, if its rows carry a node for each of so many trees.
TASK_CHUNKS, TASK_TREES = 16, 50
LOCAL = 1 << 15
#: Distinct rows up to which boosting goes on in one task; rows merged at a time; levels of a forest between two writings of its rows' nodes.
BOOST_ROWS = 1 << 19
MERGE_ROWS = 1 << 18
LEVELS_KEPT = 5
CELL_BYTES = 1 << 28
BATCH_BYTES = 1 << 26
PRIME = 2147483647
SLACK = 1e-12

#: Cumulative Poisson(1) probabilities: a row enters a bootstrap as often as its draw passes one of them.
POISSON = (0.36787944117144233, 0.7357588823428847, 0.9196986029286058, 0.9810118431238462, 0.9963401531726563, 0.9994058151824183)


@dataclass(frozen=True)
class Rule:
    """When a node is split: depth left, weight of each side, and a gain over its own score.

    A node's score is the sum over targets of G^2 / (H + ridge). ``subset`` is
    how many features a node may choose from, all if None.
    """

    depth: int
    least: float = 1.0
    ridge: float = 0.0
    subset: int | None = None


# --- bins ------------------------------------------------------------------------------
def fit_bins(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Cut points per feature: between all values of a feature with few of them, else approximate quantiles.

    All features are counted in one pass; values are then listed for those with
    few, and quantiles taken of the others. What reaches the driver is at most a
    few hundred numbers a feature.
    """
    wide = df.select(*[F.when(~F.isnan(F.col(f).cast("double")), F.col(f).cast("double")).alias(f"x{i}") for i, f in enumerate(features)])
    steps = [j / max_bins for j in range(1, max_bins)]
    if not features:
        return []
    most = 2 * max_bins

    def distinct(batches):
        """A feature's values, or one more than ``most`` of them."""
        held = [np.zeros(0)] * len(features)
        for batch in batches:
            for i, known in enumerate(held):
                if len(known) <= most:
                    new = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                    held[i] = np.union1d(known, new)[:most + 1]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, v in enumerate(held) for _ in v], pa.int32()), pa.array(np.concatenate(held))], names=["i", "x"])

    tall = wide.mapInArrow(distinct, "i int, x double").groupBy("i").agg(F.collect_set("x").alias("x"))
    values = {r["i"]: r["x"] for r in tall.select("i", F.slice("x", 1, most + 1).alias("x")).collect()}
    many = sorted(i for i, v in values.items() if len(v) > most)
    values = {i: v for i, v in values.items() if len(v) <= most}
    found = wide.agg(*[F.percentile_approx(f"x{i}", steps, 10_000).alias(f"x{i}") for i in many]).first() if many else None
    guess = {i: found[f"x{i}"] for i in many}
    cuts = []
    for i in range(len(features)):
        known = np.unique(values.get(i, []))
        if len(known) > max_bins:
            cuts.append(np.unique(np.quantile(known, steps, method="inverted_cdf")))
        elif i in values or i not in guess:
            cuts.append((known[:-1] + known[1:]) / 2)
        else:
            cuts.append(np.unique(np.array(guess[i])))
    return cuts


def binned(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of every cell of (n, p): the number of cuts below it; unknown values are in the last bin."""
    out = np.empty(x.shape, np.uint8)
    for j, c in enumerate(cuts):
        out[:, j] = np.where(np.isnan(x[:, j]), len(c), np.searchsorted(c, x[:, j], "left"))
    return out


_CHUNK = "chunk long, n int, bins binary, hashes binary, target binary, weight binary"


def row_hash(key: Column) -> Column:
    """A number below PRIME for each key, the same in SQL."""
    return F.pmod(F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(":42"))), 1, 8), 16, 10).cast("bigint"), F.lit(PRIME))


def chunks(df: DataFrame, features: Sequence[str], label: str, cuts: list[np.ndarray], key: str | None = None,
           weight: str | None = None, trees: int = TASK_TREES) -> DataFrame:
    """Rows as binned columnar chunks, written once. Rows without a label are left out; hashes and weights are empty without a column for them."""
    width = len(features)
    known = df.where(F.col(label).isNotNull())
    hashed = row_hash(F.col(key)) if key else F.lit(0).cast("bigint")
    table = known.select(hashed.alias("_h"), F.col(label).cast("double").alias("_y"),
                         (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("_w"),
                         *[F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)])

    def cut(batches):
        for number, batch in enumerate(batches):
            columns = [c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns[1:]]
            x = binned(np.stack(columns[2:], axis=1) if width else np.zeros((len(batch), 0)), cuts)
            hashes = batch.column(0).to_numpy()
            for low in range(0, len(batch), CHUNK_ROWS):
                to = slice(low, low + CHUNK_ROWS)
                yield pa.RecordBatch.from_arrays([
                    pa.array([number], pa.int64()), pa.array([len(x[to])], pa.int32()), pa.array([x[to].tobytes()], pa.binary()),
                    pa.array([hashes[to].tobytes() if key else b""], pa.binary()), pa.array([columns[0][to].tobytes()], pa.binary()),
                    pa.array([columns[1][to].tobytes() if weight else b""], pa.binary())],
                    names=["chunk", "n", "bins", "hashes", "target", "weight"])

    made = cut_lineage(table.mapInArrow(cut, _CHUNK))
    return spread(made, -(-made.count() * trees // (TASK_CHUNKS * TASK_TREES)))


def _chunk(row, width: int):
    n = row["n"]
    return (np.frombuffer(row["bins"], np.uint8).reshape(n, width), np.frombuffer(row["hashes"] or bytes(8 * n), np.int64),
            np.frombuffer(row["target"], float), _weight(row, n))


def _weight(row, n: int) -> np.ndarray:
    return np.frombuffer(row["weight"], float) if row["weight"] else np.ones(n)


# --- hashes ---------------------------------------------------------------------------
def bootstrap(hashes: np.ndarray, tree: int) -> np.ndarray:
    """How often each row enters the tree's bootstrap."""
    draw = (hashes * pow(16807, tree + 1, PRIME) + pow(48271, tree + 1, PRIME)) % PRIME / PRIME
    return np.searchsorted(np.array(POISSON), draw, "right").astype(float)


def allowed(tree: int, nodes: np.ndarray, width: int, subset: int | None) -> np.ndarray:
    """(nodes, width): whether a node may split by a feature. Nodes are numbered as in a heap, the root 1."""
    if subset is None or subset >= width:
        return np.ones((len(nodes), width), bool)
    s = ((tree + 1) * 48271 + nodes * 69621) % PRIME
    value = (s[:, None] * (s[:, None] + np.arange(1, width + 1)) % PRIME) * 16807 % PRIME
    order = np.argsort(value, axis=1, kind="stable")
    out = np.zeros((len(nodes), width), bool)
    np.put_along_axis(out, order[:, :subset], True, axis=1)
    return out


# --- splits -----------------------------------------------------------------------------
class Best:
    """Per node: score and place of its best cut, -1 where there is none, and the sums at or below it."""

    def __init__(self, totals: np.ndarray, ridge: float):
        self.own = _score(totals[:, 2:], totals[:, 1], ridge)
        self.score = self.own + SLACK * np.abs(self.own)
        self.feature, self.cut = np.full(len(totals), -1), np.full(len(totals), -1)
        self.below = totals.copy()

    def nodes(self, heap: np.ndarray, made: int, totals: np.ndarray, ridge: float, rate: float = 1.0) -> dict:
        """A level's columns of a ``Tree``; ``made`` is the number of nodes so far, this level's included."""
        split = self.feature >= 0
        left = np.full(len(heap), -1)
        left[split] = made + 2 * np.arange(split.sum())
        value = rate * (totals[:, 2:] / np.maximum(totals[:, 1:2] + ridge, 1e-300))
        return dict(zip(TREE_FIELDS, (heap, self.feature, self.cut, left, totals[:, 0], totals[:, 1], value,
                                      np.where(split, self.score - self.own, 0.0))))


def _score(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    out, below = np.zeros(len(h)), h + ridge
    for k in range(g.shape[1]):
        out += np.divide(g[:, k] * g[:, k], below, out=np.zeros(len(h)), where=below > 0)
    return out


def _consider(best: Best, feature: int, node: np.ndarray, cut: np.ndarray, sums: np.ndarray, totals: np.ndarray, open_: np.ndarray,
              rule: Rule) -> None:
    """Improve ``best`` by one feature's cells, sorted by (node, bin): sums (cells, 2 + K) of rows, weight and targets."""
    if not len(node):
        return
    first = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
    upto = np.cumsum(sums, axis=0)
    size = np.diff(np.r_[first, len(node)])
    upto -= np.repeat(upto[first] - sums[first], size, axis=0)
    rest = totals[node] - upto
    fits = open_[node] & (upto[:, 1] >= rule.least) & (rest[:, 1] >= rule.least) & (rest[:, 0] > 0)
    score = np.where(fits, _score(upto[:, 2:], upto[:, 1], rule.ridge) + _score(rest[:, 2:], rest[:, 1], rule.ridge), -np.inf)
    top = np.maximum.reduceat(score, first)
    at = np.flatnonzero(score == np.repeat(top, size))
    whose = node[at]
    at = at[np.r_[True, whose[1:] != whose[:-1]]]
    whose = node[at]
    better = score[at] > best.score[whose]
    best.score[whose[better]] = score[at[better]]
    best.feature[whose[better]], best.cut[whose[better]] = feature, cut[at[better]]
    best.below[whose[better]] = upto[at[better]]


def best_splits(bins: np.ndarray, node: np.ndarray, stats: np.ndarray, totals: np.ndarray, may: np.ndarray, rule: Rule,
                widths: Sequence[int]) -> Best:
    """Best cut of every node over rows: bins (n, p), node (n), stats (n, 2 + K), number of bins per feature."""
    count = len(totals)
    best = Best(totals, rule.ridge)
    # without weights rows and weight are the same sums
    alike = np.array_equal(stats[:, 0], stats[:, 1])
    wanted = [0, *range(2 if alike else 1, stats.shape[1])]
    columns, values = np.ascontiguousarray(bins.T), [np.ascontiguousarray(stats[:, k]) for k in wanted]
    every = may.all()
    for f, width in enumerate(widths):
        open_ = may[:, f]
        if width < 2 or not open_.any():
            continue
        # rows of nodes that may use the feature
        here = slice(None) if every else np.flatnonzero(open_[node])
        own, bin_ = node[here], columns[f][here]
        if not len(own):
            continue
        key = own * width + bin_
        if count * width <= 4 * len(key):
            rows = np.bincount(key, values[0][here], count * width)
            cells = np.flatnonzero(rows)
            found = [rows[cells], *[np.bincount(key, v[here], count * width)[cells] for v in values[1:]]]
        else:
            # by bin, then by node: numbers of one and two bytes are sorted by their digits
            order = np.argsort(bin_, kind="stable")
            order = order[np.argsort(own[order].astype(np.uint16) if count <= 1 << 16 else own[order], kind="stable")]
            ranked = key[order]
            start = np.flatnonzero(np.r_[True, ranked[1:] != ranked[:-1]])
            cells, found = ranked[start], [np.add.reduceat(v[here][order], start) for v in values]
        sums = np.stack(found[:1] * alike + found, axis=1)
        _consider(best, f, cells // width, cells % width, sums, totals, open_, rule)
    return best


def _settled(node: np.ndarray, stats: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Nodes that no cut improves: they have one row, or weights of one class only."""
    out = np.bincount(node, minlength=len(totals)) <= 1
    if ((stats[:, 2:] == 0) | (stats[:, 2:] == stats[:, 1:2])).all():
        out |= ((totals[:, 2:] == 0) | (totals[:, 2:] == totals[:, 1:2])).all(axis=1)
    return out


def _sums(node: np.ndarray, stats: np.ndarray, count: int) -> np.ndarray:
    return np.stack([np.bincount(node, stats[:, k], count) for k in range(stats.shape[1])], axis=1)


# --- trees ------------------------------------------------------------------------------
@dataclass
class Tree:
    """Nodes in arrays. A leaf has feature -1; others send values at or below ``cut`` to ``left``, the rest to ``left + 1``."""

    heap: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    rows: np.ndarray
    weight: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    def bytes(self) -> int:
        return sum(getattr(self, name).nbytes for name in TREE_FIELDS)


TREE_FIELDS = ("heap", "feature", "cut", "left", "rows", "weight", "value", "gain")


def grow(bins: np.ndarray, stats: np.ndarray, rule: Rule, widths: Sequence[int], tree: int = 0, root: int = 1, rate: float = 1.0) -> Tree:
    """A whole tree over rows of one task, level by level; values are mean targets per class."""
    depth = rule.depth - (root.bit_length() - 1)
    level_heap, node = np.array([root]), np.zeros(len(bins), np.int64)
    out = {name: [] for name in TREE_FIELDS}
    made = 1
    while True:
        count = len(level_heap)
        totals = _sums(node, stats, count)
        best = Best(totals, rule.ridge)
        if depth > 0 and len(node):
            may = allowed(tree, level_heap, bins.shape[1], rule.subset)
            done = _settled(node, stats, totals)
            if done.any():
                keep = ~done[node]
                bins, stats, node = bins[keep], stats[keep], node[keep]
            best = best_splits(bins, node, stats, totals, may, rule, widths)
        split = best.feature >= 0
        for name, value in best.nodes(level_heap, made, totals, rule.ridge, rate).items():
            out[name].append(value)
        if not split.any():
            return Tree(*[np.concatenate(out[name]) for name in TREE_FIELDS])
        made += 2 * int(split.sum())
        keep = split[node]
        bins, stats, node = bins[keep], stats[keep], node[keep]
        number = np.cumsum(split) - 1
        goes = bins[np.arange(len(bins)), best.feature[node]] > best.cut[node]
        node = 2 * number[node] + goes
        level_heap = np.stack([2 * level_heap[split], 2 * level_heap[split] + 1], axis=1).ravel()
        depth -= 1


def stats_of(target: np.ndarray, weight: np.ndarray, times: np.ndarray, classes: int) -> np.ndarray:
    """(n, 2 + K): rows, weight, and weighted target, or weight per class for more than two classes."""
    total = weight * times
    if classes <= 2:
        return np.stack([times, total, total * target], axis=1)
    return np.concatenate([np.stack([times, total], axis=1), total[:, None] * (target[:, None] == np.arange(classes))], axis=1)


def leaf_of(tree: Tree, feature_of: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Leaf of each of ``n`` rows; ``feature_of(rows, nodes)`` says which go right."""
    node = np.zeros(n, np.int64)
    live = np.flatnonzero(tree.feature[node] >= 0)
    while len(live):
        node[live] = tree.left[node[live]] + feature_of(live, node[live])
        live = live[tree.feature[node[live]] >= 0]
    return node


# --- forests ------------------------------------------------------------------------------
_GROWN = "tree int, " + ", ".join(f"{name} binary" for name in TREE_FIELDS)
_KINDS = {"heap": np.int64, "feature": np.int64, "cut": np.int64, "left": np.int64, "rows": float, "weight": float, "value": float, "gain": float}


def _packed(tree: int, t: Tree) -> pa.RecordBatch:
    arrays = [pa.array([np.ascontiguousarray(getattr(t, n), _KINDS[n]).tobytes()], pa.binary()) for n in TREE_FIELDS]
    return pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *arrays], names=["tree", *TREE_FIELDS])


def unpacked(row) -> Tree:
    parts = {n: np.frombuffer(row[n], _KINDS[n]) for n in TREE_FIELDS}
    parts["value"] = parts["value"].reshape(len(parts["heap"]), -1)
    return Tree(**parts)


def _move(bins: np.ndarray, heaps: np.ndarray, splits: dict[int, tuple[int, int]]) -> np.ndarray:
    """Nodes of rows after one level: those in split nodes go to a child."""
    if not splits:
        return heaps
    known, heaps = np.array(sorted(splits)), heaps.astype(np.int64)
    at = np.searchsorted(known, heaps).clip(max=len(known) - 1)
    hit = known[at] == heaps
    feature, cut = (np.array([splits[int(k)][i] for k in known]) for i in (0, 1))
    goes = bins[np.arange(len(bins)), feature[at]] > cut[at]
    return np.where(hit, 2 * heaps + goes, heaps)


def grow_forest(table: DataFrame, width: int, rule: Rule, trees: int, bootstrapped: bool = True, classes: int = 2,
                widths: Sequence[int] = (), local: int | None = None) -> DataFrame:
    """(tree, arrays) of all trees over ``chunks``.

    Large nodes are split by level from summed cells; what reaches the driver
    are their splits, of which there are at most rows / LOCAL a tree and
    level. Trees go in groups whose cells fit ``CELL_BYTES``. Each smaller
    node's rows meet in one task.
    """
    local = LOCAL if local is None else local
    widths = list(widths) or [MAX_BINS + 1] * width
    bins = max([1, *widths])
    outputs = 1 if classes <= 2 else classes
    # a node has cells of the features it may use
    slots = width if rule.subset is None else min(rule.subset, width)
    cell = max(1, slots) * bins * (2 + outputs) * 8

    def times(hashes, tree):
        return bootstrap(hashes, tree) if bootstrapped else np.ones(len(hashes))

    splits: dict[int, dict[int, tuple[int, int]]] = {t: {} for t in range(trees)}
    # nodes by tree, each with the children of the level above
    active = {t: [1] for t in range(trees)}
    state = table.select("*", F.lit(b"").alias("nodes"))

    # heap numbers of a level's nodes take as few bytes as they need
    kinds = {np.dtype(k).itemsize: k for k in (np.uint8, np.uint16, np.uint32, np.int64)}
    # large nodes that cannot be split: their sums are their leaves
    ends: dict[int, dict[int, tuple]] = {t: {} for t in range(trees)}

    def nodes_of(row, x, since=()):
        """Nodes of a chunk's rows: as written last, then moved by the levels since."""
        n = len(x)
        heaps = np.frombuffer(row["nodes"], kinds[len(row["nodes"]) // (trees * n)]).reshape(trees, n) if row["nodes"] else np.ones((trees, n), np.uint8)
        if not since:
            return heaps
        out = np.empty((trees, n), np.int64)
        for t in range(trees):
            out[t] = heaps[t]
            for level in since:
                out[t] = _move(x, out[t], level[t])
        return out

    since: list[dict] = []
    total = table.agg(F.sum("n")).first()[0] or 0
    level = 0
    while total > local and level <= rule.depth and any(active.values()):
        found: dict[int, dict[int, tuple]] = {t: {} for t in range(trees)}
        queue = [(t, n) for t, nodes in active.items() for n in nodes]
        step = max(1, CELL_BYTES // cell)
        for low in range(0, len(queue), step):
            wanted: dict[int, list[int]] = {}
            for t, n in queue[low:low + step]:
                wanted.setdefault(t, []).append(n)

            def cells(batches, wanted=wanted, since=tuple(since)):
                open_ = {t: np.array(sorted(nodes)) for t, nodes in wanted.items()}
                may = {t: np.nonzero(allowed(t, known, width, rule.subset))[1].reshape(len(known), slots) for t, known in open_.items()}
                held = {t: np.zeros((2 + outputs, slots, len(known) * bins)) for t, known in open_.items()}
                for batch in batches:
                    for i in range(len(batch)):
                        row = batch.slice(i, 1).to_pylist()[0]
                        x, hashes, target, weight = _chunk(row, width)
                        heaps = nodes_of(row, x, since)
                        columns = np.ascontiguousarray(x.T)
                        for t, known in open_.items():
                            at = np.searchsorted(known, heaps[t]).clip(max=len(known) - 1)
                            often = times(hashes, t)
                            here = np.flatnonzero((known[at] == heaps[t]) & (often > 0))
                            stats = stats_of(target[here], weight[here], often[here], classes)
                            # without weights rows and weight are the same sums
                            alike = np.array_equal(stats[:, 0], stats[:, 1])
                            sums = [np.ascontiguousarray(stats[:, k]) for k in range(2 + outputs)]
                            at = at[here]
                            base = at * bins
                            for f in range(slots):
                                key = base + (columns[f][here] if slots == width else x[here, may[t][at, f]])
                                for k in range(2 + outputs):
                                    if k != 1 or not alike:
                                        new = np.bincount(key, sums[k], len(known) * bins)
                                    held[t][k, f] += new
                for t, sums in held.items():
                    for i, n in enumerate(open_[t].tolist()):
                        node = np.ascontiguousarray(sums[:, :, i * bins:(i + 1) * bins].transpose(1, 2, 0))
                        if node[:, :, 0].any():
                            yield pa.RecordBatch.from_arrays([pa.array([t], pa.int32()), pa.array([n], pa.int64()), pa.array([node.tobytes()], pa.binary())],
                                                             names=["tree", "node", "cells"])

            def choose(key, rows):
                t, n = key[0].as_py(), key[1].as_py()
                sums = np.sum([np.frombuffer(c, float).reshape(slots, bins, 2 + outputs) for c in rows["cells"].to_pylist()], axis=0)
                totals = sums[0].sum(axis=0)[None]
                may = allowed(t, np.array([n]), width, rule.subset)
                best = Best(totals, rule.ridge)
                for at, f in enumerate(np.flatnonzero(may[0])) if n.bit_length() <= rule.depth else ():
                    cut = np.flatnonzero(sums[at, :, 0])
                    _consider(best, int(f), np.zeros(len(cut), int), cut, sums[at, cut], totals, np.ones(1, bool), rule)
                f, c = int(best.feature[0]), int(best.cut[0])
                value = totals[0, 2:] / max(totals[0, 1] + rule.ridge, 1e-300)
                return pa.table({"tree": pa.array([t], pa.int32()), "node": [n], "feature": [f], "cut": [c], "gain": [float(best.score[0] - best.own[0]) if f >= 0 else 0.0],
                                 "rows": [float(totals[0, 0])], "weight": [float(totals[0, 1])], "below": [float(best.below[0, 0])], "value": [value.tolist()]})

            chosen = state.mapInArrow(cells, "tree int, node long, cells binary").groupBy("tree", "node").applyInArrow(
                choose, "tree int, node long, feature long, cut long, gain double, rows double, weight double, below double, value array<double>")
            for r in chosen.collect():
                found[r["tree"]][r["node"]] = r
        for t, nodes in found.items():
            active[t] = []
            for n, r in nodes.items():
                if r["rows"] <= local:
                    continue
                if r["feature"] < 0:
                    ends[t][n] = (r["rows"], r["weight"], r["value"])
                    continue
                splits[t][n] = (r["feature"], r["cut"], r["gain"], r["rows"], r["weight"], r["value"])
                active[t] += [child for child, size in ((2 * n, r["below"]), (2 * n + 1, r["rows"] - r["below"])) if size > local]
        here = {t: {n: s[:2] for n, s in splits[t].items() if n.bit_length() == level + 1} for t in range(trees)}

        if any(here.values()):
            since.append(here)
        if len(since) == LEVELS_KEPT:
            kind = next(k for size, k in sorted(kinds.items()) if level + 2 <= 8 * size)

            def moved(batches, kind=kind, since=tuple(since)):
                for batch in batches:
                    for i in range(len(batch)):
                        row = batch.slice(i, 1).to_pylist()[0]
                        row["nodes"] = nodes_of(row, _chunk(row, width)[0], since).astype(kind).tobytes()
                        yield pa.RecordBatch.from_pylist([row], schema=batch.schema)

            state = cut_lineage(state.mapInArrow(moved, _CHUNK + ", nodes binary"))
            since = []
        level += 1

    def deal(batches, since=tuple(since)):
        """Rows of each tree and small node, as often as they are in the bootstrap; weights only where there are any."""
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                x, hashes, target, weight = _chunk(row, width)
                heaps, plain = nodes_of(row, x, since), bool((weight == 1).all())
                out = {name: [] for name in ("tree", "node", "bins", "times", "target", "weight")}
                for t in range(trees):
                    often = times(hashes, t).astype(np.uint8)
                    taken = np.flatnonzero((often > 0) & ~np.isin(heaps[t], list(ends[t])))
                    taken = taken[np.argsort(heaps[t][taken], kind="stable")]
                    edges = np.flatnonzero(np.r_[True, np.diff(heaps[t][taken].astype(np.int64)) != 0]) if len(taken) else []
                    for a, b in zip(edges, [*edges[1:], len(taken)]):
                        here = taken[a:b]
                        for name, value in zip(out, (t, int(heaps[t][here[0]]), x[here].tobytes(), often[here].tobytes(),
                                                     target[here].tobytes(), b"" if plain else weight[here].tobytes())):
                            out[name].append(value)
                kinds_ = (pa.int32(), pa.int64(), *[pa.binary()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds_)], names=list(out))

    def below(key, rows):
        rows = rows.to_pydict()
        x = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(-1, width)
        often = np.frombuffer(b"".join(rows["times"]), np.uint8).astype(float)
        target = np.frombuffer(b"".join(rows["target"]), float)
        weight = np.concatenate([np.frombuffer(w, float) if w else np.ones(len(n)) for w, n in zip(rows["weight"], rows["times"])])
        grown = grow(x, stats_of(target, weight, often, classes), rule, widths, key[0].as_py(), key[1].as_py())
        return pa.Table.from_batches([_packed(key[0].as_py(), grown)])

    def whole(key, rows):
        """A tree from its large nodes and what was grown below them."""
        t = key[0].as_py()
        parts = [unpacked(r) for r in rows.to_pylist()]
        if not splits[t]:
            return pa.Table.from_batches([_packed(t, parts[0])])
        roots = {int(p.heap[0]): p for p in parts}
        large = sorted(splits[t])
        # large nodes first, then an empty place per part's root, then what lies below the roots
        order = [1]
        for n in large:
            order += [2 * n, 2 * n + 1]
        place = {n: i for i, n in enumerate(order)}
        size = len(order) + sum(len(p.heap) - 1 for p in parts)
        out = Tree(*[np.zeros((size, parts[0].value.shape[1]) if n == "value" else size, _KINDS[n]) for n in TREE_FIELDS])
        out.feature[:], out.left[:], out.cut[:] = -1, -1, -1
        for n, i in place.items():
            out.heap[i] = n
        for n in large:
            i = place[n]
            out.feature[i], out.cut[i], out.gain[i], out.rows[i], out.weight[i], out.value[i] = splits[t][n]
            out.left[i] = place[2 * n]
        start = len(order)
        for n, p in sorted(roots.items()):
            i, more = place[n], len(p.heap) - 1
            for name in TREE_FIELDS:
                source, goal = getattr(p, name), getattr(out, name)
                if name == "left":
                    source = np.where(source >= 0, source + start - 1, -1)
                goal[i], goal[start:start + more] = source[0], source[1:]
            start += more
        return pa.Table.from_batches([_packed(t, out)])

    # small in bytes but long to grow: not to be merged into a few tasks; a task holds one node at a time
    tasks = max(3 * table.sparkSession.sparkContext.defaultParallelism, trees * -(-total // (8 * local)))
    dealt = state.mapInArrow(deal, "tree int, node long, bins binary, times binary, target binary, weight binary").repartition(tasks, "tree", "node")
    grown = dealt.groupBy("tree", "node").applyInArrow(below, _GROWN)
    closed = [(t, Tree(*[np.array([v]) for v in (n, -1, -1, -1, rows, weight, value, 0.0)]))
              for t in range(trees) for n, (rows, weight, value) in ends[t].items()]
    if closed:
        grown = grown.unionByName(table.sparkSession.createDataFrame(
            [tuple(_packed(t, leaf).to_pylist()[0].values()) for t, leaf in closed], _GROWN))
    return cut_lineage(grown.groupBy("tree").applyInArrow(whole, _GROWN))


# --- boosting ----------------------------------------------------------------------------
@dataclass(frozen=True)
class Loss:
    """First and second derivative of a loss, downhill: (target, margin, weight) to (g, h)."""

    slopes: Callable
    start: Callable


def _squared(y, m, w):
    return w * (y - m), w


def _logistic(y, m, w):
    p = 1 / (1 + np.exp(-np.clip(m, -500, 500)))
    return w * (y - p), w * p * (1 - p)


SQUARED = Loss(_squared, lambda mean: mean)
LOGISTIC = Loss(_logistic, lambda mean: 0.0)
KEEP_EVERY = 10


_MERGED = "n int, bins binary, times binary, target binary, weight binary"


def _words(x: np.ndarray) -> np.ndarray:
    """Rows of bins as rows of 64-bit words."""
    out = np.zeros((len(x), max(8, -(-x.shape[1] // 8) * 8)), np.uint8)
    out[:, :x.shape[1]] = x
    return out.view(np.uint64)


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows that puts equal ones together, and where each run of them begins."""
    words = _words(x)
    order = np.lexsort(words.T)
    ranked = words[order]
    return order, np.flatnonzero(np.r_[True, (ranked[1:] != ranked[:-1]).any(axis=1)][:len(x)])


def merged(x: np.ndarray, times: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, ...]:
    """Rows of the same bins as one: numbers and weights added, targets averaged by weight.

    Both losses' derivatives are linear in the target and the weight, so the sums over
    cells stay the same.
    """
    if not len(x):
        return x, times, target, weight
    order, first = _runs(x)
    total, sums = (np.add.reduceat(v[order], first) for v in (weight, weight * target))
    return x[order[first]], np.add.reduceat(times[order], first), np.divide(sums, total, out=np.zeros(len(first)), where=total != 0), total


def _opened(row, width: int):
    """Bins, numbers of rows, targets and weights of a chunk, merged or not."""
    n = row["n"]
    target = np.frombuffer(row["target"], float)
    times = np.frombuffer(row["times"], float) if "times" in row else np.ones(n)
    return np.frombuffer(row["bins"], np.uint8).reshape(n, width), times, target, _weight(row, n)


def _batch(parts, **more) -> pa.RecordBatch:
    x, *rest = parts
    arrays = [pa.array([v], pa.int32()) for v in (*more.values(), len(x))] + [pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in (x, *rest)]
    return pa.RecordBatch.from_arrays(arrays, names=[*more, "n", "bins", "times", "target", "weight"])


def merged_chunks(table: DataFrame, width: int, rows: float) -> tuple[DataFrame, float]:
    """Chunks of ``table`` whose rows of the same bins are one, and their rows; the table itself where few are alike.

    Features of few bins have few combinations however many rows there are.
    """
    def joined(held):
        return merged(*[np.concatenate(column) for column in zip(*held)])

    def in_tasks(batches):
        held, size = [], 0
        for batch in batches:
            for row in batch.to_pylist():
                held.append(_opened(row, width))
                size += row["n"]
                if size >= MERGE_ROWS:
                    held = [joined(held)]
                    size = len(held[0][0])
                    if size > MERGE_ROWS // 2:
                        yield _batch(held[0])
                        held, size = [], 0
        if held:
            yield _batch(joined(held))

    found = cut_lineage(table.select("n", "bins", "target", "weight").mapInArrow(in_tasks, _MERGED))
    left = found.agg(F.sum("n")).first()[0] or 0
    if left <= BOOST_ROWS:
        return found, left
    if left > rows / 2:
        return table, rows
    buckets = int(-(-4 * left // MERGE_ROWS))

    def dealt(batches):
        for batch in batches:
            for row in batch.to_pylist():
                parts = _opened(row, width)
                words = _words(parts[0])
                bucket = ((words * np.arange(1, 2 * words.shape[1], 2, np.uint64) * np.uint64(11400714819323198485)).sum(axis=1) >> np.uint64(32)) % buckets
                for b in np.unique(bucket):
                    yield _batch([v[bucket == b] for v in parts], bucket=int(b))

    def together(rows):
        whole = joined([_opened(row, width) for row in rows.to_pylist()])
        return pa.Table.from_batches([_batch([v[low:low + CHUNK_ROWS] for v in whole]) for low in range(0, len(whole[0]), CHUNK_ROWS)])

    found = cut_lineage(found.mapInArrow(dealt, "bucket int, " + _MERGED).groupBy("bucket").applyInArrow(together, _MERGED))
    return found, found.agg(F.sum("n")).first()[0] or 0


def boost_rows(x: np.ndarray, times: np.ndarray, target: np.ndarray, weight: np.ndarray, rule: Rule, rounds: int, rate: float, loss: Loss,
               start: float, widths: Sequence[int]) -> list[Tree]:
    """All trees over rows of one task."""
    margin, trees = np.full(len(x), start), []
    for _ in range(rounds):
        g, h = loss.slopes(target, margin, weight)
        tree = grow(x, np.stack([times, h, g], axis=1), rule, widths, rate=rate)
        trees.append(tree)
        margin = margin + tree.value[_walk(tree.feature, tree.cut, tree.left, x), 0]
    return trees


def _walk(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Leaf of each row of bins."""
    return leaf_of(Tree(None, feature, cut, left, None, None, None, None), lambda rows, nodes: x[rows, feature[nodes]] > cut[nodes], len(x))


def boost(table: DataFrame, width: int, rule: Rule, rounds: int, rate: float, loss: Loss, bins: int = MAX_BINS + 1,
          widths: Sequence[int] = ()) -> tuple[float, list[Tree]]:
    """(start, trees) of second-order boosting over ``chunks``.

    Rows of the same bins are merged first; if at most ``BOOST_ROWS`` are left, one task
    grows all trees over them. Otherwise a level of a tree is one job: a feature's cells of all tasks, at most 2^depth
    nodes of them each, are summed in one task, and only its best cut of each
    node reaches the driver. Margins are written every ``KEEP_EVERY`` rounds; between,
    tasks add the few trees since.
    """
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    sums = table.select("n", "target", "weight").rdd.map(lambda r: np.array([
        r["n"], np.frombuffer(r["target"], float) @ _weight(r, r["n"]), _weight(r, r["n"]).sum()]))
    rows, y, w = sums.fold(np.zeros(3), np.add)
    start = float(loss.start(y / w if w else 0.0))

    alike, rows = merged_chunks(table, width, rows)
    if rows <= BOOST_ROWS:
        def at_once(batches):
            held = [_opened(row, width) for batch in batches for row in batch.to_pylist()]
            whole = merged(*[np.concatenate(column) for column in zip(*held)]) if held else (np.zeros((0, width), np.uint8), *[np.zeros(0)] * 3)
            for number, tree in enumerate(boost_rows(*whole, rule, rounds, rate, loss, start, list(widths) or [bins] * width)):
                yield _packed(number, tree)

        return start, [unpacked(r) for r in alike.coalesce(1).mapInArrow(at_once, _GROWN).collect()]
    table = alike

    def opened(row):
        x, times, target, weight = _opened(row.asDict(), width)
        return x, times, target, weight, np.full(len(x), start)

    parts = max(1, min(table.rdd.getNumPartitions(), int(-(-rows // CHUNK_ROWS))))
    state = table.rdd.map(opened).coalesce(parts).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[Tree] = []
    recent: list[Tree] = []

    def value_of(tree: Tree, x: np.ndarray) -> np.ndarray:
        leaf = leaf_of(tree, lambda rows, nodes: x[rows, tree.feature[nodes]] > tree.cut[nodes], len(x))
        return tree.value[leaf, 0]

    def level_cells(done: list[Tree], levels: list[tuple[np.ndarray, np.ndarray]], count: int):
        """Per task and feature: cells (3, count * bins) and totals (3, count) of the deepest nodes of the tree being grown."""
        def run(task, rows):
            cells = np.zeros((3, width, count * bins))
            for x, times, target, weight, margin in rows:
                for t in done:
                    margin = margin + value_of(t, x)
                node = np.zeros(len(x), np.int64)
                for feature, cut in levels:
                    split = feature >= 0
                    number = np.cumsum(split) - 1
                    live = np.flatnonzero((node >= 0) & split[node])
                    now = node[live]
                    after = np.full(len(x), -1)
                    after[live] = 2 * number[now] + (x[live, feature[now]] > cut[now])
                    node = after
                here = np.flatnonzero(node >= 0)
                g, h = loss.slopes(target[here], margin[here], weight[here])
                base = node[here] * bins
                for f in range(width):
                    key = base + x[here, f]
                    for k, v in enumerate((times[here], h, g)):
                        cells[k, f] += np.bincount(key, v, count * bins)
            totals = cells[:, 0].reshape(3, count, bins).sum(axis=2)
            for f in range(width):
                yield f, (task, cells[:, f], totals)
        return run

    def feature_split(count: int):
        """Of one feature's cells: totals, and per node whether there is a cut, its score, its place and the sums below."""
        def run(item):
            f, parts = item[0], sorted(item[1], key=lambda part: part[0])
            sums, totals = (np.sum([part[i] for part in parts], axis=0) for i in (1, 2))
            best = Best(totals.T, rule.ridge)
            cells = np.flatnonzero(sums[0])
            _consider(best, f, cells // bins, cells % bins, sums[:, cells].T, totals.T, np.ones(count, bool), rule)
            return f, totals.T, best.feature >= 0, best.score, best.cut, best.below
        return run

    for number in range(rounds):
        levels: list[tuple[np.ndarray, np.ndarray]] = []
        heap, out, made, totals = np.array([1]), {name: [] for name in TREE_FIELDS}, 1, None
        while True:
            count = len(heap)
            found = []
            if len(levels) < rule.depth:
                found = sorted(state.mapPartitionsWithIndex(level_cells(list(recent), list(levels), count)).groupByKey(min(width, 1 + parts // 4)).map(
                    feature_split(count)).collect(), key=lambda one: one[0])
                totals = found[0][1]
            best = Best(totals, rule.ridge)
            for f, _, has, score, cut, below in found:
                better = has & (score > best.score)
                best.feature[better], best.score[better] = f, score[better]
                best.cut[better], best.below[better] = cut[better], below[better]
            split = best.feature >= 0
            for name, value in best.nodes(heap, made, totals, rule.ridge, rate).items():
                out[name].append(value)
            if not split.any():
                break
            made += 2 * int(split.sum())
            levels.append((best.feature, best.cut))
            heap = np.stack([2 * heap[split], 2 * heap[split] + 1], axis=1).ravel()
            # the last level needs no sums of its own: they are those beside its parents' cuts
            totals = np.stack([best.below[split], totals[split] - best.below[split]], axis=1).reshape(-1, 3)
        tree = Tree(*[np.concatenate(out[name]) for name in TREE_FIELDS])
        trees.append(tree)
        recent.append(tree)
        if len(recent) == KEEP_EVERY and number + 1 < rounds:
            kept, recent = recent, []

            def added(row, kept=kept):
                x, times, target, weight, margin = row
                for t in kept:
                    margin = margin + value_of(t, x)
                return x, times, target, weight, margin

            after = state.map(added).persist(StorageLevel.MEMORY_AND_DISK)
            after.checkpoint()
            after.count()
            state.unpersist()
            state = after
    state.unpersist()
    return start, trees


_WALKED = "tree int, feature binary, cut binary, left binary, value binary"


def _walked(batches):
    """What a prediction needs of trees, in small integers."""
    for batch in batches:
        for row in batch.to_pylist():
            t = unpacked(row)
            parts = [t.feature.astype(np.int16), t.cut.astype(np.int16), t.left.astype(np.int32), t.value]
            yield pa.RecordBatch.from_arrays([pa.array([row["tree"]], pa.int32()), *[pa.array([p.tobytes()], pa.binary()) for p in parts]],
                                             names=["tree", "feature", "cut", "left", "value"])


def _leaf_sums(shared):
    def total(*columns: pd.Series) -> pd.Series:
        cuts, trees = shared.value
        x = binned(np.stack([c.to_numpy(float) for c in columns], axis=1), cuts)
        # rows of the same bins end in the same leaves
        order, first = _runs(x)
        x, number = x[order[first]], np.empty(len(x), np.int64)
        number[order] = np.cumsum(np.bincount(first, minlength=len(order))) - 1
        result = np.zeros((len(x), 1))
        for feature, cut, left, value in trees:
            result = result + value[_walk(feature, cut, left, x)]
        return pd.Series(list(result[number]), dtype=object)
    return total


# --- models -----------------------------------------------------------------------------
@dataclass
class TreeModel:
    """Trees over named features. ``combine`` turns the sums of leaf values into a prediction.

    ``trees`` is a table, one row a tree. Prediction broadcasts trees in
    batches of at most ``BATCH_BYTES`` or one tree, which its depth bounds.
    """

    features: list[str]
    cuts: list[np.ndarray]
    trees: DataFrame
    start: float = 0.0
    classes: int = 0
    kind: str = "mean"
    _batches: list = field(default_factory=list, repr=False)
    _count: int = 0

    @property
    def model(self) -> "TreeModel":
        return self

    def batches(self) -> list:
        """Broadcast batches of trees; the driver holds one at a time."""
        if not self._batches:
            sizes = self.trees.select("tree", (F.octet_length("heap") + F.octet_length("value")).alias("size")).orderBy("tree").collect()
            self._count = len(sizes)
            groups, group, held = [], [], 0
            for r in sizes:
                if group and held + r["size"] > BATCH_BYTES:
                    groups.append(group)
                    group, held = [], 0
                group.append(r["tree"])
                held += r["size"]
            groups += [group] if group else []
            for g in groups:
                rows = self.trees.where(F.col("tree").isin(g)).mapInArrow(_walked, _WALKED).orderBy("tree").collect()
                small = []
                for r in rows:
                    feature, cut, left = (np.frombuffer(r[n], k) for n, k in (("feature", np.int16), ("cut", np.int16), ("left", np.int32)))
                    small.append((feature, cut, left, np.frombuffer(r["value"]).reshape(len(left), -1)))
                self._batches.append(self.trees.sparkSession.sparkContext.broadcast((self.cuts, small)))
        return self._batches

    def sums(self) -> list[Column]:
        """Per batch a column of summed leaf values, an array."""
        columns = [F.col(f).cast("double") for f in self.features]
        return [F.pandas_udf(_leaf_sums(shared), "array<double>")(*columns) for shared in self.batches()]

    def with_raw(self, df: DataFrame) -> DataFrame:
        """``df`` with ``_raw``: mean (forests) or start plus sum (boosting) of the trees' leaf values, an array.

        Each batch is a pass of its own over rows written between, so that a
        task holds one batch.
        """
        first, *more = self.sums()
        out = df.withColumn("_raw", first)
        for part in more:
            out = cut_lineage(out).withColumn("_part", part) \
                .withColumn("_raw", F.zip_with("_raw", "_part", lambda a, b: a + b)).drop("_part")
        if self.kind == "mean":
            return out.withColumn("_raw", F.transform("_raw", lambda v: v / F.lit(float(self._count))))
        return out.withColumn("_raw", F.transform("_raw", lambda v: v + F.lit(self.start)))

    def transform(self, df: DataFrame, output: str = "prediction") -> DataFrame:
        """``df`` with a prediction and, for classes, ``probability`` as an array."""
        raw = self.with_raw(df)
        one = F.get("_raw", F.lit(0))
        if not self.classes:
            return raw.withColumn(output, one).drop("_raw")
        if self.kind == "sum":
            one = F.lit(1.0) / (F.lit(1.0) + F.exp(-one))
        chances = F.col("_raw") if self.classes > 2 else F.array(F.lit(1.0) - one, one)
        out = raw.withColumn("probability", chances)
        best = F.array_position("probability", F.array_max("probability")) - 1
        return out.withColumn(output, best.cast("double")).drop("_raw")

    @property
    def featureImportances(self) -> np.ndarray:
        """Shares of the gain per feature, each tree counting alike, as boosting does over all trees together."""
        width, mean = len(self.features), self.kind == "mean"

        def gains(batches):
            for batch in batches:
                total = np.zeros(width)
                for row in batch.to_pylist():
                    t = unpacked(row)
                    g = np.bincount(t.feature[t.feature >= 0], t.gain[t.feature >= 0], width)
                    total += g / g.sum() if mean and g.sum() > 0 else g
                yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["g"])

        rows = self.trees.mapInArrow(gains, "g array<double>").collect()
        total = np.sum([r["g"] for r in rows], axis=0) if rows else np.zeros(width)
        return total / total.sum() if total.sum() > 0 else total


def trees_table(spark, trees: list[Tree]) -> DataFrame:
    """Small trees as a table."""
    batches = [_packed(i, t) for i, t in enumerate(trees)]
    rows = [tuple(b.to_pylist()[0].values()) for b in batches]
    return spark.createDataFrame(rows, _GROWN)


def node_report(model: TreeModel) -> DataFrame:
    """(tree, node, feature, threshold, rows, weight, value) of every node; node 1 is the root, 2n and 2n + 1 its children."""
    names, cuts = model.features, model.cuts

    def nodes(batches):
        for batch in batches:
            for row in batch.to_pylist():
                t = unpacked(row)
                split = t.feature >= 0
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(t.heap), row["tree"], np.int32)), pa.array(t.heap.astype(np.int64)),
                    pa.array([names[f] if f >= 0 else None for f in t.feature.tolist()], pa.string()),
                    pa.array([float(cuts[f][c]) if f >= 0 else None for f, c in zip(t.feature.tolist(), t.cut.tolist())], pa.float64()),
                    pa.array(t.rows.astype(np.int64)), pa.array(t.weight), pa.array(t.value[:, 0]), pa.array(split)],
                    names=["tree", "node", "feature", "threshold", "n_rows", "weight", "value", "is_split"])

    return model.trees.mapInArrow(
        nodes, "tree int, node long, feature string, threshold double, n_rows long, weight double, value double, is_split boolean")


def fit_forest(train: DataFrame, features: Sequence[str], label: str, rule: Rule, trees: int, classes: int = 0, key: str | None = None,
               weight: str | None = None, max_bins: int = MAX_BINS, local: int | None = None, bootstrapped: bool = True) -> TreeModel:
    """A forest, or with one tree and no bootstrap a single tree. ``key`` identifies rows to the bootstrap."""
    features = list(features)
    cuts = fit_bins(train, features, max_bins)
    table = chunks(train, features, label, cuts, key if bootstrapped else None, weight, trees)
    grown = grow_forest(table, len(features), rule, trees, bootstrapped, max(classes, 2), [len(c) + 1 for c in cuts], local)
    return TreeModel(features, cuts, grown, classes=classes)


def fit_boosting(train: DataFrame, features: Sequence[str], label: str, rule: Rule, rounds: int, rate: float, classes: int = 0,
                 weight: str | None = None, max_bins: int = MAX_BINS) -> TreeModel:
    """Second-order boosting of the squared loss, or of the logistic loss for two classes."""
    features = list(features)
    cuts = fit_bins(train, features, max_bins)
    table = chunks(train, features, label, cuts, None, weight, 1)
    start, grown = boost(table, len(features), rule, rounds, rate, LOGISTIC if classes else SQUARED, max([1, *[len(c) + 1 for c in cuts]]),
                         [len(c) + 1 for c in cuts])
    return TreeModel(features, cuts, trees_table(train.sparkSession, grown), start, classes, "sum")
