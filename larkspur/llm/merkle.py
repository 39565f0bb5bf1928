"""Merkle manifests of datasets whose parents keep SHA-256 midstates.

A parent is the hash of its children's digests as hex text. Such a text is one
block of SHA-256, so the state before a child's slot is eight words. Every
parent keeps the state before each of its slots; folding a replaced child
resumes the state before its slot with the replacement and the right siblings,
and never reads what is left of it.

Trees are cut into chunks of ``FAN ** HEIGHT`` consecutive nodes. A chunk is
hashed in one task, and its root is a node of the next round. On the way back
every chunk learns the steps from its root upwards, so that its leaves are
folded where they lie.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

FAN = 3
HEIGHT = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
EMPTY = hashlib.sha256(b"").hexdigest()

_U = np.uint32


def _primes(count: int) -> list[int]:
    found: list[int] = []
    n = 2
    while len(found) < count:
        if all(n % p for p in found):
            found.append(n)
        n += 1
    return found


def _cube_root(n: int) -> int:
    low, high = 0, 1 << (n.bit_length() // 3 + 1)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle ** 3 <= n else (low, middle - 1)
    return low


#: SHA-256 starts from square roots of primes and adds cube roots of primes, 32 bits behind the point.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], _U)
_ROUND = np.array([_cube_root(p << 96) & 0xFFFFFFFF for p in _primes(64)], _U)


def _turn(x: np.ndarray, by: int) -> np.ndarray:
    return (x >> _U(by)) | (x << _U(32 - by))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (n, 8) after one more block (n, 16) of big-endian words each."""
    w = [np.ascontiguousarray(block[:, i]) for i in range(16)]
    a, b, c, d, e, f, g, h = first = [np.ascontiguousarray(state[:, i]) for i in range(8)]
    for i in range(64):
        if i >= 16:
            x, y = w[(i - 15) % 16], w[(i - 2) % 16]
            w[i % 16] = w[i % 16] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> _U(3))) + w[(i - 7) % 16] \
                + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> _U(10)))
        up = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + (g ^ (e & (f ^ g))) + _ROUND[i] + w[i % 16]
        down = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = up + down, a, b, c, d + up, e, f, g
    return np.stack([x + y for x, y in zip((a, b, c, d, e, f, g, h), first)], axis=1)


_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def hex_text(digests: np.ndarray) -> np.ndarray:
    """Digests (n, 32) as the 64 characters of their hex texts."""
    out = np.empty((*digests.shape[:-1], 64), np.uint8)
    out[..., 0::2], out[..., 1::2] = _HEX[digests >> 4], _HEX[digests & 15]
    return out


def _block(digests: np.ndarray) -> np.ndarray:
    return hex_text(digests).view(">u4").astype(_U)


def _ends() -> np.ndarray:
    """The closing block of a message of k blocks, k up to FAN."""
    out = np.zeros((FAN + 1, 16), _U)
    out[:, 0] = 0x80000000
    out[:, 15] = np.arange(FAN + 1) * 512
    return out


_END = _ends()


def _digest(state: np.ndarray, width: np.ndarray) -> np.ndarray:
    return compress(state, _END[width]).astype(">u4").view(np.uint8)


def height(width: int) -> int:
    """Levels above ``width`` nodes until one remains."""
    levels = 0
    while width > 1:
        width, levels = -(-width // FAN), levels + 1
    return levels


#: One step from a node to its parent: the state before its slot, and its siblings from left to right.
STEP = np.dtype([("slot", "u1"), ("width", "u1"), ("state", _U, 8), ("siblings", "u1", (FAN - 1, 32))])


@dataclass
class Chunk:
    """Digests of every level, the leaves first, and the states of every parent's slots."""

    levels: list[np.ndarray]
    states: list[np.ndarray]

    @staticmethod
    def build(leaves: np.ndarray, levels: int) -> "Chunk":
        found, kept = [leaves], []
        for _ in range(levels):
            now = found[-1]
            parents = -(-len(now) // FAN)
            blocks = _block(now)
            state = np.broadcast_to(START, (parents, 8)).copy()
            before = np.zeros((parents, FAN, 8), _U)
            for slot in range(FAN):
                before[:, slot] = state
                have = -(-(len(now) - slot) // FAN) if len(now) > slot else 0
                if have:
                    state[:have] = compress(state[:have], blocks[slot::FAN])
            width = np.full(parents, FAN)
            width[-1] = len(now) - FAN * (parents - 1)
            found.append(_digest(state, width))
            kept.append(before)
        return Chunk(found, kept)

    @staticmethod
    def read(count: int, levels: int, digests: bytes, states: bytes) -> "Chunk":
        nodes, kept = np.frombuffer(digests, np.uint8).reshape(-1, 32), np.frombuffer(states, _U).reshape(-1, FAN, 8)
        found, before, at, below = [], [], 0, 0
        for level in range(levels + 1):
            found.append(nodes[at:at + count])
            at += count
            count = -(-count // FAN)
            if level < levels:
                before.append(kept[below:below + count])
                below += count
        return Chunk(found, before)

    def steps(self) -> np.ndarray:
        """STEP records (leaves, levels) from every leaf to the chunk's root."""
        count = len(self.levels[0])
        out = np.zeros((count, len(self.states)), STEP)
        at = np.arange(count)
        for level, before in enumerate(self.states):
            nodes, parent, slot = self.levels[level], at // FAN, at % FAN
            step = out[:, level]
            step["slot"], step["width"] = slot, np.minimum(FAN, len(nodes) - FAN * parent)
            step["state"] = before[parent, slot]
            for place in range(FAN - 1):
                other = FAN * parent + place + (place >= slot)
                there = place < step["width"] - 1
                step["siblings"][there, place] = nodes[other[there]]
            at = parent
        return out


def fold(leaves: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """Roots (n, 32) over leaves (n, 32): each step resumes a state with the new child and its right siblings."""
    now = leaves
    for level in range(steps.shape[1]):
        step = steps[:, level]
        state = compress(step["state"], _block(now))
        for place in range(FAN - 1):
            right = np.flatnonzero((place >= step["slot"]) & (place < step["width"] - 1))
            if len(right):
                state[right] = compress(state[right], _block(step["siblings"][right, place]))
        now = _digest(state, step["width"])
    return now


def proofs(steps: np.ndarray) -> list[str]:
    """Hash of every leaf's siblings as hex text, level by level, left to right."""
    if not steps.shape[1]:
        return [EMPTY] * len(steps)
    texts = hex_text(steps["siblings"])
    there = np.arange(FAN - 1) < (steps["width"] - 1)[..., None]
    return [hashlib.sha256(texts[i][there[i]].tobytes()).hexdigest() for i in range(len(steps))]


def _one(value: np.ndarray) -> bytes:
    return np.ascontiguousarray(value).tobytes()


_CHUNKS = "tree string, chunk long, width long, ids array<long>, changed binary, digests binary, states binary, root binary"


def _own_levels(width: int) -> int:
    return HEIGHT if width > FAN ** HEIGHT else height(width)


def _hash_chunk(key, table):
    """All nodes of a chunk to its row: digests of every level and the retained states."""
    table = table.sort_by("position")
    width = table["width"][0].as_py()
    leaves = np.frombuffer(b"".join(table["digest"].to_pylist()), np.uint8).reshape(-1, 32)
    changed = b"".join(table["changed"].to_pylist()) if "changed" in table.column_names else b""
    ids = table["id"].to_pylist() if "id" in table.column_names else []
    chunk = Chunk.build(leaves, _own_levels(width))
    return pa.table({
        "tree": pa.array([key[0].as_py()], pa.string()), "chunk": pa.array([key[1].as_py()], pa.int64()),
        "width": pa.array([width], pa.int64()), "ids": pa.array([ids], pa.list_(pa.int64())), "changed": pa.array([changed], pa.binary()),
        "digests": pa.array([b"".join(map(_one, chunk.levels))], pa.binary()),
        "states": pa.array([b"".join(map(_one, chunk.states))], pa.binary()),
        "root": pa.array([_one(chunk.levels[-1][0])], pa.binary())})


def build(nodes: DataFrame) -> list[DataFrame]:
    """Chunk tables, one a round, over nodes (tree, position, width, digest, and id and changed of leaves).

    ``width`` is the number of nodes of the tree. The last round of a tree is
    the one in which it is a single chunk; that chunk's root is the tree's.
    """
    size = FAN ** HEIGHT
    widest = nodes.agg(F.max("width")).first()[0] or 0
    rounds = []
    while True:
        chunk = F.floor(F.col("position") / size).cast("long").alias("chunk")
        columns = [c for c in ("position", "width", "digest", "id", "changed") if c in nodes.columns]
        rounds.append(cut_lineage(nodes.select("tree", chunk, *columns).groupBy("tree", "chunk").applyInArrow(_hash_chunk, _CHUNKS)))
        if widest <= size:
            return rounds
        widest = -(-widest // size)
        nodes = rounds[-1].where(F.col("width") > size).select(
            "tree", F.col("chunk").alias("position"), F.ceil(F.col("width") / size).cast("long").alias("width"), F.col("root").alias("digest"))


def roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, root) of every tree."""
    done = [r.where(F.col("width") <= FAN ** HEIGHT).select("tree", "root") for r in rounds]
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _chunk_of(row: dict) -> tuple[Chunk, int]:
    size = FAN ** HEIGHT
    count = min(size, row["width"] - size * row["chunk"])
    return Chunk.read(count, _own_levels(row["width"]), row["digests"], row["states"]), count


def _upward(own: np.ndarray, above: bytes | None) -> np.ndarray:
    more = np.frombuffer(above or b"", STEP)
    return np.concatenate([own, np.broadcast_to(more, (len(own), len(more)))], axis=1)


def _node_steps(batches):
    """Scan of chunks with the steps above them: the steps of each of their nodes."""
    for batch in batches:
        for row in batch.to_pylist():
            chunk, count = _chunk_of(row)
            steps = _upward(chunk.steps(), row["above"])
            first = row["chunk"] * FAN ** HEIGHT
            yield pa.RecordBatch.from_arrays([
                pa.array([row["tree"]] * count, pa.string()), pa.array(np.arange(first, first + count)),
                pa.array([_one(s) for s in steps], pa.binary())], names=["tree", "chunk", "above"])


def above(rounds: list[DataFrame], over: DataFrame | None = None) -> list[DataFrame]:
    """``rounds`` with ``above``: the steps from each chunk's root to the root of all.

    ``over`` has (tree, above) for the trees' own roots; without it they are
    the end.
    """
    out, steps = [], None
    for table in reversed(rounds):
        last = table.where(F.col("width") <= FAN ** HEIGHT)
        known = last.withColumn("above", F.lit(None).cast("binary")) if over is None else last.join(over, "tree")
        if steps is not None:
            inner = table.where(F.col("width") > FAN ** HEIGHT).join(steps, ["tree", "chunk"])
            known = known.unionByName(inner.select(known.columns))
        out.insert(0, known)
        if len(out) < len(rounds):
            steps = cut_lineage(known.select("tree", "chunk", "width", "digests", "states", "above").mapInArrow(
                _node_steps, "tree string, chunk long, above binary"))
    return out


def positions(rows: DataFrame, tree: str, *order: Column) -> DataFrame:
    """``rows`` with position and width, the place of a row in its tree and the tree's size.

    Rows are range-partitioned by tree and order, so a tree of any size is
    spread; a partition's first place comes from the counts of those before it.
    """
    ordered = cut_lineage(rows.repartitionByRange(F.col(tree), *order).sortWithinPartitions(F.col(tree), *order))
    numbered = ordered.withColumn("_row", F.monotonically_increasing_id())
    part = F.call_function("shiftright", F.col("_row"), F.lit(33))
    counts = numbered.groupBy(F.col(tree).alias("_tree"), part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_row").alias("_first"))
    whole = Window.partitionBy("_tree")
    places = counts.select(
        "_tree", "_part", (F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
                           - F.col("_first")).alias("_from"), F.sum("_n").over(whole).alias("width"))
    return numbered.withColumn("_own", part).join(places, (F.col(tree) == F.col("_tree")) & (F.col("_own") == F.col("_part"))) \
        .select(*rows.columns, (F.col("_from") + F.col("_row")).alias("position"), "width")


def record(values: list[Column]) -> Column:
    """Leaf digest (32 bytes): each value with its UTF-8 byte count, ``-`` for null."""
    def part(value):
        text = value.cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))
    return F.unhex(F.sha2(F.concat(*[part(v) for v in values]), 256))


@dataclass(frozen=True)
class Manifest:
    """Chunk rounds of the trees of all sources and of the tree over their roots; (tree, subroot)."""

    sources: list[DataFrame]
    top: list[DataFrame]
    subroots: DataFrame


def manifest(documents: DataFrame, changed: Column | None = None, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
             source_col: str = "source", text_col: str = "text") -> Manifest:
    """A tree per source over its documents by id, and one over the sources' roots.

    ``changed`` is the text a document has now, as an expression; the tree is
    over ``text_col``, and the leaf of the changed text waits beside it for
    ``verify``. Null sources are one tree, the first; null ids come first in
    a tree; equal ids are ordered by leaf, and repeated rows are leaves of
    their own. Columns besides ``fields`` are not read. An empty table has no
    trees.
    """
    values = {f: F.col(f"`{f}`") for f in fields}
    leaf = record(list(values.values()))
    after = leaf if changed is None else F.when(
        changed.eqNullSafe(values[text_col]), leaf).otherwise(record(list((values | {text_col: changed}).values())))
    tree = F.when(values[source_col].isNull(), F.lit("")).otherwise(F.concat(F.lit("+"), values[source_col].cast("string")))
    rows = cut_lineage(documents.select(tree.alias("tree"), values[id_col].cast("long").alias("id"),
                                        leaf.alias("digest"), after.alias("changed")))
    rows = rows.withColumn("_tie", F.monotonically_increasing_id())
    leaves = positions(rows, "tree", F.col("id").asc_nulls_first(), F.col("digest"), F.col("_tie"))
    sources = build(leaves.drop("_tie"))
    subroots = cut_lineage(roots(sources))
    ranked = positions(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest")),
                       "tree", F.col("name"))
    ranked = cut_lineage(ranked)
    return Manifest(sources, build(ranked.select("tree", "position", "width", "digest")),
                    ranked.select(F.col("name").alias("tree"), "position", F.col("digest").alias("subroot")))


_VERIFIED = "id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _verified(batches):
    """Scan of chunks with the steps above them: every leaf folded to the root with what it holds now."""
    for batch in batches:
        for row in batch.to_pylist():
            chunk, count = _chunk_of(row)
            steps = _upward(chunk.steps(), row["above"])
            root = row["top_root"].hex()
            folded = [r.tobytes().hex() for r in fold(np.frombuffer(row["changed"], np.uint8).reshape(-1, 32), steps)]
            yield pa.RecordBatch.from_arrays([
                pa.array(row["ids"], pa.int64()), pa.array([d.tobytes().hex() for d in chunk.levels[0]]),
                pa.array([row["subroot"].hex()] * count), pa.array([root] * count), pa.array(proofs(steps)),
                pa.array(folded), pa.array([f == root for f in folded], pa.bool_())],
                names=["id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])


def verify(tree: Manifest) -> DataFrame:
    """One row per document: id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Leaf, roots and proof are the manifest's; ``folded_root`` is what the
    document's present leaf folds to, and ``verified`` says whether it is the root.
    """
    top = above(tree.top)[0]
    steps = top.select("tree", "chunk", "width", "digests", "states", "above").mapInArrow(
        _node_steps, "tree string, chunk long, above binary").select(F.col("chunk").alias("position"), "above")
    over = cut_lineage(tree.subroots.join(steps, "position").select("tree", "subroot", "above"))
    chunks = above(tree.sources, over.select("tree", "above"))[0]
    one = roots(tree.top).first()
    root = F.lit(None if one is None else bytes(one["root"])).cast("binary").alias("top_root")
    return chunks.join(over.select("tree", "subroot"), "tree") \
        .select("chunk", "width", "ids", "changed", "digests", "states", "above", "subroot", root) \
        .mapInArrow(_verified, _VERIFIED)
