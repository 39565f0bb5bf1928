"""SimHash near-duplicates by a binary trie self-join.

Distinct fingerprints form a trie. Two nodes of equal depth are visited
together with the number of bits in which their paths differ; a pair beyond the
budget is left, so no leaf below it is compared.

Roots of the traversal: of ``budget + c`` blocks of bits, two fingerprints in
reach agree in at least ``c``. For each choice of ``c`` blocks the trie is built
with those blocks in front and only nodes with equal fronts are paired, which
deals the traversal out over the cluster. Fronts with too many fingerprints are
dealt by pairs of nodes further down. ``c`` grows with the number of
fingerprints, so that a front keeps a bounded share; the result is the same.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.components import components
from larkspur.llm.words import text_buffer
from larkspur.session import cut_lineage

SHINGLE = 4
SEED = 42
BUDGET = 4
FRONT = 1000
NODE = 8000
FRONTIER = 1 << 18
LEAVES = 48

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_U = np.uint64


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit i is set if over half of the shingles' XXH64 have it; no words give zero."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = max(len(words) - shingle + 1, 1)
    begin, end = starts[:count].tolist(), ends[min(shingle, len(words)) - 1:].tolist()
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for low in range(0, count, 1 << 15):
        part = min(count - low, 1 << 15)
        hashes = np.fromiter((digest(joined[a:b], seed) for a, b in zip(begin[low:low + part], end[low:low + part])),
                             ">u8", part)
        total += np.unpackbits(hashes.view(np.uint8)).reshape(part, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > count).tobytes(), "big", signed=True)


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 seed: int = SEED) -> DataFrame:
    """(id, key, fingerprint) of every row; a null text has no words. ``key`` is the text's hash."""

    def run(batches):
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(2))
            values = [fingerprint(buffer[a:b].tobytes(), shingle, seed) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(values, pa.int64())], names=["id", "key", "fingerprint"])

    text = F.col(text_col).cast("string")
    return documents.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text")) \
        .mapInArrow(run, "id long, key long, fingerprint long")


def _fronts(budget: int, clean: int) -> list[tuple[list[tuple[int, int]], int]]:
    """For each choice of clean blocks: the blocks (offset, width) in their new order, and the front's width."""
    count = budget + clean
    widths = [64 // count + (i < 64 % count) for i in range(count)]
    offsets = np.cumsum([0, *widths])[:-1].tolist()
    blocks = list(zip(offsets, widths))
    out = []
    for chosen in combinations(range(count), clean):
        order = [blocks[i] for i in chosen] + [blocks[i] for i in range(count) if i not in chosen]
        out.append((order, sum(blocks[i][1] for i in chosen)))
    return out


def _permuted(order: list[tuple[int, int]]):
    """The fingerprint with its blocks in ``order``, as a column; ``offset`` counts from the highest bit."""
    out, at = F.lit(0).cast("long"), 64
    for offset, width in order:
        at -= width
        field = F.shiftrightunsigned("fingerprint", 64 - offset - width).bitwiseAND(F.lit((1 << width) - 1))
        out = out.bitwiseOR(F.shiftleft(field, at))
    return out


class _Forest:
    """Components of the fingerprints of one task, and where runs of one component end."""

    def __init__(self, size: int):
        self.of = np.arange(size)
        self.links: list[np.ndarray] = []
        self.mark()

    def mark(self) -> None:
        change = np.flatnonzero(self.of[1:] != self.of[:-1]) + 1
        ends = np.append(change, len(self.of))
        self.run_end = np.repeat(ends, np.diff(np.concatenate(([0], ends))))

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        changed = False
        while True:
            x, y = self.of[a], self.of[b]
            open_ = x != y
            if not open_.any():
                break
            changed = True
            high, low = np.maximum(x, y)[open_], np.minimum(x, y)[open_]
            parent = np.arange(len(self.of))
            np.minimum.at(parent, high, low)
            while True:
                shorter = parent[parent]
                if (shorter == parent).all():
                    break
                parent = shorter
            self.of = parent[self.of]
        if changed:
            self.mark()

    def joined(self, alo, ahi, blo, bhi) -> np.ndarray:
        return (self.run_end[alo] >= ahi) & (self.run_end[blo] >= bhi) & (self.of[alo] == self.of[blo])


def _leaf_pairs(alo, ahi, blo, bhi):
    wide = bhi - blo
    sizes = (ahi - alo) * wide
    whose = np.repeat(np.arange(len(sizes)), sizes)
    rank = np.arange(len(whose)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return alo[whose] + rank // wide[whose], blo[whose] + rank % wide[whose]


def trie_links(values: np.ndarray, pairs: np.ndarray, depth: int, budget: int = BUDGET) -> np.ndarray:
    """Component of each value, linked at ``budget`` or fewer differing bits.

    ``values`` ascend inside each range; ``pairs`` has rows (a start, a end,
    b start, b end) of ranges whose first ``depth`` bits count as visited, the
    same range twice for a node with itself. Node pairs inside one component
    are left, so a dense family costs no pair of its members.
    """
    forest = _Forest(len(values))
    ones: dict[int, np.ndarray] = {}

    def visit(limit: int) -> None:
        start = np.bitwise_count((values[pairs[:, 0]] ^ values[pairs[:, 2]]) >> _U(64 - depth)).astype(np.int64) \
            if depth else np.zeros(len(pairs), np.int64)
        stack = [(depth, *(pairs[i:i + FRONTIER].T), start[i:i + FRONTIER]) for i in range(0, len(pairs), FRONTIER)]
        while stack:
            at, alo, ahi, blo, bhi, errors = stack.pop()
            live = (errors <= limit) & ~((alo == blo) & (ahi - alo < 2)) & ~forest.joined(alo, ahi, blo, bhi)
            small = ((ahi - alo) * (bhi - blo) <= LEAVES) | (at == 64)
            near = live & small
            if near.any():
                a, b = _leaf_pairs(alo[near], ahi[near], blo[near], bhi[near])
                close = np.bitwise_count(values[a] ^ values[b]) <= limit
                forest.link(a[close], b[close])
            live &= ~small
            if not live.any():
                continue
            alo, ahi, blo, bhi, errors = alo[live], ahi[live], blo[live], bhi[live], errors[live]
            if at not in ones:
                bit = (values >> _U(63 - at)) & _U(1)
                ones[at] = np.concatenate(([0], np.cumsum(bit.astype(np.int64))))
            c = ones[at]
            amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
            own = (alo == blo) & (ahi == bhi)
            down = [(alo, amid, blo, bmid, errors), (amid, ahi, bmid, bhi, errors), (alo, amid, bmid, bhi, errors + 1),
                    tuple(x[~own] for x in (amid, ahi, blo, bmid, errors + 1))]
            alo, ahi, blo, bhi, errors = (np.concatenate(x) for x in zip(*down))
            full = (ahi > alo) & (bhi > blo) & (errors <= limit)
            alo, ahi, blo, bhi, errors = (x[full] for x in (alo, ahi, blo, bhi, errors))
            for i in range(0, len(alo), FRONTIER):
                own = slice(i, i + FRONTIER)
                stack.append((at + 1, alo[own], ahi[own], blo[own], bhi[own], errors[own]))

    if len(pairs):
        for limit in sorted({1, budget}) if budget > 1 else [budget]:
            visit(limit)
    return forest.of


def _local_links(table: pa.Table, budget: int) -> pa.Table:
    """A bucket of fronts: links (a, b) that connect what is in reach, one fewer than members of a component."""
    original = table.column("fingerprint").to_numpy()
    value = table.column("value").to_numpy().view(_U)
    depth = int(table.column("depth")[0].as_py())
    part, side = table.column("part").to_numpy(), table.column("side").to_numpy()
    order = np.lexsort((value, side, part))
    original, value, part, side = original[order], value[order], part[order], side[order]
    opens = np.flatnonzero(np.concatenate(([True], (part[1:] != part[:-1]) | (side[1:] != side[:-1]))))
    ends = np.append(opens[1:], len(part))
    alone = side[opens] == 0
    left, right = np.flatnonzero(side[opens] == 1), np.flatnonzero(side[opens] == 2)
    _, i, j = np.intersect1d(part[opens[left]], part[opens[right]], assume_unique=True, return_indices=True)
    left, right = left[i], right[j]
    pairs = np.concatenate((
        np.stack((opens[alone], ends[alone], opens[alone], ends[alone]), 1),
        np.stack((opens[left], ends[left], opens[right], ends[right]), 1)))
    root = trie_links(value, pairs, depth, budget)
    linked = np.flatnonzero(root != np.arange(len(root)))
    return pa.table({"a": original[linked], "b": original[root[linked]]})


def links(distinct: DataFrame, budget: int = BUDGET, clean: int | None = None) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs of fingerprints within ``budget`` bits.

    ``distinct`` has one row per fingerprint and should be checkpointed.
    """
    count = distinct.count()
    if clean is None:
        clean = 1
        while clean < 8 and count >> _fronts(budget, clean)[0][1] > FRONT:
            clean += 1
    edges = None
    choices = _fronts(budget, clean)
    copies = F.explode(F.array(*[
        F.struct(F.lit(i).alias("choice"), F.lit(width).alias("depth"), _permuted(order).alias("value"))
        for i, (order, width) in enumerate(choices)]))
    rows = distinct.select("fingerprint", copies.alias("_c")).select("fingerprint", "_c.*") \
        .withColumn("front", F.call_function("shiftrightunsigned", F.col("value"), (64 - F.col("depth")).cast("int")))
    sizes = rows.groupBy("choice", "depth", "front").agg(F.count("*").alias("n")).where("n > 1").withColumn(
        "split", F.least(F.lit(12), F.ceil(F.log2(F.greatest(F.col("n") / NODE, F.lit(1.0))))).cast("int"))
    below = (64 - F.col("depth") - F.col("split")).cast("int")
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("split")) - 1
    rows = rows.join(sizes.drop("n"), ["choice", "depth", "front"]).withColumn(
        "node", F.call_function("shiftrightunsigned", F.col("value"), below).bitwiseAND(mask))
    nodes = rows.select("choice", "front", "node").distinct()
    u, v = nodes.alias("u"), nodes.alias("v")
    met = u.join(v, (F.col("u.choice") == F.col("v.choice")) & (F.col("u.front") == F.col("v.front"))
                 & (F.col("u.node") <= F.col("v.node"))
                 & (F.bit_count(F.col("u.node").bitwiseXOR(F.col("v.node"))) <= budget)) \
        .select("u.choice", "u.front", F.col("u.node").alias("low"), F.col("v.node").alias("high"))
    part = F.xxhash64("choice", "front", "low", "high").alias("part")
    ends = F.when(F.col("low") == F.col("high"), F.array(F.struct(F.col("low").alias("node"), F.lit(0).alias("side")))) \
        .otherwise(F.array(F.struct(F.col("low").alias("node"), F.lit(1).alias("side")),
                           F.struct(F.col("high").alias("node"), F.lit(2).alias("side"))))
    wanted = met.select("choice", "front", part, F.explode(ends).alias("_e")).select("choice", "front", "part", "_e.*")
    buckets = max(16, count * len(choices) // (4 * NODE))
    dealt = rows.join(wanted, ["choice", "front", "node"]).select(
        "fingerprint", "value", "depth", "part", "side", F.pmod("part", F.lit(buckets)).alias("bucket"))
    edges = dealt.groupBy("bucket", "depth").applyInArrow(
        lambda table: _local_links(table, budget), "a long, b long")
    return edges


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    seed: int = SEED, budget: int = BUDGET) -> DataFrame:
    """One row per document: id, key, fingerprint, root, component (the smallest id reachable over links).

    ``root`` is the smallest fingerprint reachable, the same for a whole group.

    Null texts and texts without words have fingerprint zero and link like any
    other. Null ids are never a component's id unless it has no other. Equal
    fingerprints are one node, so copies cost nothing beyond their row. An
    empty table gives no rows.
    """
    marked = cut_lineage(fingerprints(documents, id_col, text_col, shingle, seed))
    nodes = cut_lineage(marked.groupBy("fingerprint").agg(F.min("id").alias("least")))
    roots = components(links(nodes, budget))
    members = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root"))
    least = members.groupBy("root").agg(F.min("least").alias("component"))
    named = members.join(least, "root").select("fingerprint", "root", "component")
    return marked.join(named, "fingerprint").select("id", "key", "fingerprint", "root", "component")


def representatives(grouped: DataFrame) -> DataFrame:
    """(id, key) of one document of each group: the smallest id, null last, and of its texts the smallest key."""
    first = grouped.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("_none"), "id", "key")).alias("_first"))
    return first.select("_first.id", "_first.key")
