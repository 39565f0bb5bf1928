"""Substring deduplication by level-wise doubling.

Windows start short. Those whose words repeat in another document are extended
to twice the length (the last step overlaps and stops at the length asked for);
a long window is a candidate only if both its halves repeat. A level with no
candidates ends the search.

Each scan task packs its windows into chunks. A chunk sends every distinct hash
once, so a passage in a third of all documents costs one entry per chunk, and
buckets of hashes stay even. Buckets answer to chunks, never to single windows.
"""

from __future__ import annotations

import hashlib
import math
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm import bitmap
from larkspur.llm.words import blank_separated, join_hashes, slices, split, text_buffer, windows, word_hashes
from larkspur.session import cut_lineage

LENGTH = 13
CHUNK = 2_000_000
BUCKET_BYTES = 4_000_000

_NULL_ID = np.iinfo(np.int64).max
_PIECE = "bucket long, chunk long, kind int, a binary, b binary, c binary, d binary, e binary"
_ROW = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("kind", pa.int32()),
                  *((x, pa.binary()) for x in "abcde")])
_DOCS, _EXTRA, _ASK, _ANSWER = 0, 1, 2, 3


def _row(bucket, chunk, kind, *parts):
    parts = [p if isinstance(p, bytes) else np.ascontiguousarray(p).tobytes() for p in parts]
    return (int(bucket), int(chunk), kind, *parts, *[b""] * (5 - len(parts)))


def _batch(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_ROW), _ROW)], schema=_ROW)


def _gaps(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending positions as their steps, in the narrowest type that holds them."""
    steps = np.diff(at, prepend=0)
    wide = steps.max(initial=0) > 65535
    return steps.astype(np.uint32 if wide else np.uint16), np.array([4 if wide else 2], np.uint8)


def _positions(steps: bytes, width: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(steps, np.uint32 if width[0] == 4 else np.uint16), dtype=np.int64)


def _pack(chunk: int, at: np.ndarray, hashes: np.ndarray, doc: np.ndarray, order: np.ndarray, buckets: int,
          narrow: bool):
    """Rows that ask the buckets about a chunk's distinct hashes, and one with the other places of each.

    ``at`` ascends. A hash is known to repeat if documents of two ids in the
    chunk have it. Narrow asks carry 32 bits beside the bucket: enough for a
    first sieve, whose survivors are asked about again.
    """
    by_hash = np.argsort(hashes, kind="stable")
    ordered = hashes[by_hash]
    opens = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else np.zeros(0, int)
    sizes = np.diff(np.append(opens, len(ordered)))
    ids = order[doc[by_hash]]
    low = np.minimum.reduceat(ids, opens) if len(opens) else ids
    high = np.maximum.reduceat(ids, opens) if len(opens) else ids
    first = by_hash[opens]
    rest = np.ones(len(ordered), bool)
    rest[opens] = False
    others = by_hash[rest]
    theirs = np.repeat(first, sizes)[rest]
    in_order = np.argsort(others, kind="stable")
    yield _row(chunk % buckets, chunk, _EXTRA, at[others[in_order]].astype(np.uint32), at[theirs[in_order]].astype(np.uint32))
    keep = np.argsort(first, kind="stable")
    first, low, high = first[keep], low[keep], high[keep]
    value = hashes[first]
    bucket = ((value >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
    deal = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[deal], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edges)):
        own = deal[edges[b]:edges[b + 1]]
        steps, width = _gaps(at[first[own]])
        if narrow:
            yield _row(b, chunk, _ASK, value[own].astype(np.uint32), np.packbits(high[own] > low[own]), steps, width)
        else:
            yield _row(b, chunk, _ASK, value[own], low[own], steps, width, high[own])


def _seed_windows(length: int, buckets: int, narrow: bool):
    """Scan: (id, key, text) to chunks of windows of the first length."""
    alphabet = blank_separated()

    def run(batches):
        part, numbers = TaskContext.get().partitionId(), count()
        held = {"at": [], "hash": [], "doc": [], "ids": [], "keys": [], "counts": [], "words": 0, "docs": 0}

        def flush():
            chunk = (part << 32) + next(numbers)
            order = np.concatenate(held["ids"])
            counts = np.concatenate(held["counts"])
            yield _row(chunk % buckets, chunk, _DOCS, order, np.concatenate(held["keys"]), counts.astype(np.uint32))
            yield from _pack(chunk, np.concatenate(held["at"]), np.concatenate(held["hash"]),
                             np.concatenate(held["doc"]), order, buckets, narrow)
            for name in ("at", "hash", "doc", "ids", "keys", "counts"):
                held[name] = []
            held["words"] = held["docs"] = 0

        for batch in batches:
            buffer, offsets = text_buffer(batch.column(2))
            ids = batch.column(0).fill_null(_NULL_ID).to_numpy(zero_copy_only=False)
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            for low, high in slices(offsets):
                words = split(buffer, offsets, (low, high), alphabet)
                at, hashes = windows(words, length, word_hashes(words))
                held["at"].append(at + held["words"])
                held["hash"].append(hashes)
                held["doc"].append((words.doc[at] + held["docs"]).astype(np.int32))
                held["ids"].append(ids[low:high])
                held["keys"].append(keys[low:high])
                held["counts"].append(words.counts)
                held["words"] += len(words.starts)
                held["docs"] += high - low
                if held["words"] >= CHUNK:
                    yield _batch(list(flush()))
        if held["docs"]:
            yield _batch(list(flush()))

    return run


def _pieces(table: pa.Table):
    for row in table.to_pylist():
        yield row


def _answer(narrow: bool):
    """A bucket: which asked hashes repeat in the corpus, told to each chunk."""

    def run(table: pa.Table) -> pa.Table:
        asks, out = [], []
        for row in _pieces(table):
            if row["kind"] == _ASK:
                asks.append(row)
            else:
                out.append(tuple(row[n] for n in _ROW.names))
        if asks:
            kind = np.uint32 if narrow else np.uint64
            values = np.concatenate([np.frombuffer(r["a"], kind) for r in asks])
            sizes = [len(r["a"]) // kind().itemsize for r in asks]
            names, group, found = np.unique(values, return_inverse=True, return_counts=True)
            if narrow:
                many = np.concatenate([np.unpackbits(np.frombuffer(r["b"], np.uint8), count=n) for r, n in zip(asks, sizes)])
                repeats = np.bincount(group, many, len(names)) + (found > 1) > 0
                wanted = repeats[group]
            else:
                order = np.concatenate([np.frombuffer(r["b"], np.int64) for r in asks])
                low = np.full(len(names), _NULL_ID)
                np.minimum.at(low, group, order)
                least = low[group]
                high = np.concatenate([np.frombuffer(r["e"], np.int64) for r in asks])
                wanted = high > least
            start = 0
            for row, n in zip(asks, sizes):
                own = wanted[start:start + n]
                if own.any():
                    at = _positions(row["c"], row["d"])[own]
                    steps, width = _gaps(at)
                    if narrow:
                        bucket = np.uint64(row["bucket"]) << np.uint64(32)
                        told = values[start:start + n][own].astype(np.uint64) | bucket
                    else:
                        told = least[start:start + n][own]
                    out.append(_row(row["bucket"], row["chunk"], _ANSWER, told, steps, width))
                start += n
        return pa.Table.from_batches([_batch(out)])

    return run


def _gathered(table: pa.Table):
    """A chunk's documents and its repeating windows: places in order, with what was told of each."""
    at, told, extra, docs = [np.zeros(0, np.int64)], None, None, None
    values = []
    for row in _pieces(table):
        if row["kind"] == _DOCS:
            docs = (np.frombuffer(row["a"], np.int64), np.frombuffer(row["b"], np.int64),
                    np.frombuffer(row["c"], np.uint32).astype(np.int64))
        elif row["kind"] == _EXTRA:
            extra = (np.frombuffer(row["a"], np.uint32).astype(np.int64),
                     np.frombuffer(row["b"], np.uint32).astype(np.int64))
        else:
            at.append(_positions(row["b"], row["c"]))
            values.append(row["a"])
    at = np.concatenate(at)
    told = np.frombuffer(b"".join(values), np.int64)
    by_place = np.argsort(at)
    at, told = at[by_place], told[by_place]
    if extra is not None and len(at):
        there = np.minimum(np.searchsorted(at, extra[1]), len(at) - 1)
        known = at[there] == extra[1]
        at = np.concatenate((at, extra[0][known]))
        told = np.concatenate((told, told[there[known]]))
        by_place = np.argsort(at, kind="stable")
        at, told = at[by_place], told[by_place]
    return docs, at, told


def _extend(length: int, longer: int, buckets: int, narrow: bool):
    """A chunk: windows whose two halves repeat become windows of ``longer`` words."""

    def run(table: pa.Table) -> pa.Table:
        docs, at, told = _gathered(table)
        order, keys, counts = docs
        chunk = table.column("chunk")[0].as_py()
        step = longer - length
        first = np.cumsum(counts) - counts
        doc = np.searchsorted(first + counts, at, "right")
        there = np.minimum(np.searchsorted(at, at + step), max(len(at) - 1, 0))
        pairs = np.flatnonzero((at[there] == at + step) & (doc[there] == doc)) if len(at) else np.zeros(0, np.int64)
        halves = told.view(np.uint64)
        hashes = join_hashes(halves[pairs], halves[there[pairs]])
        rows = [_row(chunk % buckets, chunk, _DOCS, order, keys, counts.astype(np.uint32))]
        if len(pairs):
            rows += _pack(chunk, at[pairs], hashes, doc[pairs], order, buckets, narrow)
        return pa.Table.from_batches([_batch(rows)])

    return run


def _spans(length: int):
    """A chunk: per document the words its repeats cover, as (id, key, starts, ends)."""

    def run(table: pa.Table) -> pa.Table:
        (order, keys, counts), at, told = _gathered(table)
        first = np.cumsum(counts) - counts
        doc = np.searchsorted(first + counts, at, "right")
        later = order[doc] > told
        at, doc = at[later], doc[later]
        opens = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (at[1:] > at[:-1] + length)))) \
            if len(at) else np.zeros(0, np.int64)
        closes = np.append(opens[1:], len(at))[:len(opens)] - 1
        starts = (at[opens] - first[doc[opens]]).astype(np.int32)
        ends = (at[closes] + length - first[doc[opens]]).astype(np.int32)
        whose, begin = np.unique(doc[opens], return_index=True)
        cuts = np.append(begin, len(opens)).astype(np.int32)
        ids = order[whose]
        return pa.table({
            "id": pa.array(ids, pa.int64(), mask=ids == _NULL_ID), "key": pa.array(keys[whose], pa.int64()),
            "starts": pa.ListArray.from_arrays(pa.array(cuts), pa.array(starts)),
            "ends": pa.ListArray.from_arrays(pa.array(cuts), pa.array(ends))})

    return run


def _lengths(length: int, seed: int) -> list[int]:
    out = [min(seed, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


def repeated_spans(documents: DataFrame, length: int = LENGTH, seed: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Word spans covered by windows of ``length`` words that a smaller id has too.

    Columns id, key, starts, ends (word numbers, end exclusive); only documents
    with spans. ``key`` is the text's hash: rows of one id with different texts
    stay apart, equal rows give equal spans twice. A null id is larger than any
    other, a null text has no words. ``seed`` is the first level's length,
    half the length asked for unless given. ``documents`` must be read from
    files or a checkpoint, so that a repeated task packs the same chunks.

    Hashes: levels before the last keep 32 bits beside the bucket and only
    choose candidates; the last compares 64 bits among candidates.
    """
    lengths = _lengths(length, seed or math.ceil(length / 2))
    text = F.col(text_col).cast("string")
    total = documents.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(16, math.ceil(total / BUCKET_BYTES))
    narrow = len(lengths) > 1
    level = documents.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text")) \
        .mapInArrow(_seed_windows(lengths[0], buckets, narrow), _PIECE)
    for shorter, longer in zip(lengths, lengths[1:]):
        level = level.groupBy("bucket").applyInArrow(_answer(True), _PIECE)
        narrow = longer < length
        level = level.groupBy("chunk").applyInArrow(_extend(shorter, longer, buckets, narrow), _PIECE)
    level = level.groupBy("bucket").applyInArrow(_answer(False), _PIECE)
    return level.groupBy("chunk").applyInArrow(_spans(length), "id long, key long, starts array<int>, ends array<int>")


def _cut(with_text: bool):
    """Scan: (id, key, text, starts, ends) to counts, SHA-256 of the kept words and, if wanted, the kept text."""

    def run(batches):
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(2))
            starts, ends = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            n_words, removed, kept, digest = [], [], [], []
            for i in range(batch.num_rows):
                words = buffer[offsets[i]:offsets[i + 1]].tobytes().split()
                left, last = [], 0
                for a, b in zip(starts[i] or (), ends[i] or ()):
                    left += words[last:a]
                    last = b
                left += words[last:]
                text = b" ".join(left)
                n_words.append(len(words))
                removed.append(len(words) - len(left))
                kept.append(text if with_text else None)
                digest.append(hashlib.sha256(text).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string()), pa.array(digest, pa.string())],
                names=["id", "n_words", "n_removed", "kept", "kept_sha256"])

    return run


def remove_repeats(documents: DataFrame, length: int = LENGTH, seed: int | None = None, id_col: str = "doc_id",
                   text_col: str = "text", with_text: bool = True) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept (words joined by a space; null without ``with_text``), kept_sha256.

    Only texts that may have spans are shuffled to meet them; the rest stays in
    the scan. See :func:`repeated_spans` for nulls and repeated rows.
    """
    text = F.col(text_col).cast("string")
    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))
    spans = cut_lineage(repeated_spans(documents, length, seed, id_col, text_col)).dropDuplicates(["id", "key"])
    rows = bitmap.mark(rows, "key", bitmap.words(spans, "key"), "may")
    met = rows.where("may").alias("l").join(
        spans.alias("r"), F.col("l.id").eqNullSafe(F.col("r.id")) & (F.col("l.key") == F.col("r.key")), "left"
    ).select("l.id", "l.key", "l.text", "r.starts", "r.ends")
    none = F.lit(None).cast("array<int>")
    alone = rows.where("not may").select("id", "key", "text", none.alias("starts"), none.alias("ends"))
    return met.unionByName(alone).mapInArrow(
        _cut(with_text), "id long, n_words long, n_removed long, kept string, kept_sha256 string")
