"""Benchmark decontamination by winnowed fingerprints.

Every window of ``WINDOW`` words spans ``WINDOW - GRAM + 1`` k-grams; the
smallest k-gram hash among them (the last one of equals) is its fingerprint. A
window that a document and an item share has the same fingerprint in both, so
joining fingerprints misses no shared window. Each joined fingerprint is then
extended to the windows around it, whose words decide.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm import bitmap
from larkspur.llm.words import letters_and_digits, slices, split, text_buffer, window_hashes, windows, word_hashes
from larkspur.session import cut_lineage

WINDOW = 10
GRAM = 5

_FINGERPRINTED = "id long, key long, n_words long, at array<int>, size array<int>, hash array<long>, words array<binary>"


def winnow(words, hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """First words of the k-grams chosen by any window inside one document."""
    grams = window_hashes(hashes, gram)
    span = window - gram + 1
    count = len(grams) - span + 1
    if count <= 0:
        return np.zeros(0, np.int64)
    best, at = grams[:count].copy(), np.zeros(count, np.int8)
    for step in range(1, span):
        later = grams[step:step + count]
        smaller = later <= best
        best[smaller] = later[smaller]
        at[smaller] = step
    whole = words.doc[:count] == words.doc[window - 1:window - 1 + count]
    return np.unique((np.arange(count) + at)[whole])


def _scan(window: int, gram: int, short: tuple[int, ...], bits: np.ndarray | None):
    """Rows of documents with the fingerprints that may match and the windows around them.

    Without ``bits`` (the benchmark side) all fingerprints are given, and the
    windows are those of the item.
    """
    alphabet = letters_and_digits()

    def text_of(words, start, size):
        return b" ".join(words.bytes(i) for i in range(start, start + size))

    def run(batches):
        for batch in batches:
            buffer, offsets = text_buffer(batch.column(2))
            ids, keys = batch.column(0), batch.column(1)
            for low, high in slices(offsets):
                words = split(buffer, offsets, (low, high), alphabet)
                hashes = word_hashes(words)
                counts = words.counts
                first = np.concatenate(([0], np.cumsum(counts)))
                found = [[] for _ in range(high - low)]
                grams = window_hashes(hashes, gram)
                chosen = winnow(words, hashes, window, gram)
                marks = grams[chosen]
                if bits is not None:
                    kept = bitmap.contains(bits, marks)
                    chosen, marks = chosen[kept], marks[kept]
                if bits is None:
                    for d in np.flatnonzero(counts):
                        size = min(window, int(counts[d]))
                        if size < window:
                            value = int(window_hashes(hashes[first[d]:first[d + 1]], size)[0] + np.uint64(size))
                            found[d].append((0, size, value, text_of(words, first[d], size)))
                        else:
                            for start in range(first[d], first[d + 1] - window + 1):
                                found[d].append((start - first[d], size, None, text_of(words, start, size)))
                    for at, mark in zip(chosen, marks):
                        d = words.doc[at]
                        found[d].append((int(at - first[d]), 0, int(mark), None))
                else:
                    seen = set()
                    for at, mark in zip(chosen.tolist(), marks.tolist()):
                        d = words.doc[at]
                        for start in range(max(first[d], at - window + gram), min(at, first[d + 1] - window) + 1):
                            if (start, mark) not in seen:
                                seen.add((start, mark))
                                found[d].append((int(start - first[d]), window, mark, text_of(words, start, window)))
                    for size in short:
                        at, value = windows(words, size, hashes)
                        value = value + np.uint64(size)
                        hit = bitmap.contains(bits, value)
                        for start, mark in zip(at[hit].tolist(), value[hit].tolist()):
                            d = words.doc[start]
                            found[d].append((int(start - first[d]), size, mark, text_of(words, start, size)))
                rows = [[(a, s, None if h is None else h - (1 << 64) if h >> 63 else h, w) for a, s, h, w in row]
                        for row in found]
                yield pa.RecordBatch.from_arrays([
                    ids.slice(low, high - low).cast(pa.int64()), keys.slice(low, high - low),
                    pa.array(counts, pa.int64()),
                    pa.array([[x[0] for x in r] for r in rows], pa.list_(pa.int32())),
                    pa.array([[x[1] for x in r] for r in rows], pa.list_(pa.int32())),
                    pa.array([[x[2] for x in r] for r in rows], pa.list_(pa.int64())),
                    pa.array([[x[3] for x in r] for r in rows], pa.list_(pa.binary())),
                ], names=["id", "key", "n_words", "at", "size", "hash", "words"])

    return run


def _exploded(scanned: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("at", "size", "hash", "words"))
    return scanned.select("id", "key", zipped.alias("_x")).select("id", "key", "_x.*")


def contaminated_windows(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
                         gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """Documents as (id, key, n_words), and their windows that occur in items.

    The second frame has (id, key, at, size, item): the window's first word,
    its length and one item that has it; ``key`` tells rows of one id with
    different texts apart. A null text has no words; an item of fewer words
    than a window, but not none, is one window of its own length. Equal rows
    of documents give equal windows. Empty inputs give no windows.
    """
    if not 0 < gram <= window:
        raise ValueError("gram must be between 1 and window")
    items = cut_lineage(_exploded(
        benchmark.select(F.lit(None).cast("long").alias("id"), F.xxhash64(F.col(item_col)).alias("key"),
                         F.col(item_text_col).cast("string").alias("text"))
        .mapInArrow(_scan(window, gram, (), None), _FINGERPRINTED)))
    names = benchmark.select(F.xxhash64(F.col(item_col)).alias("key"), F.col(item_col).alias("item")).distinct()
    item_windows = items.where("words is not null").select("key", "size", "words").distinct() \
        .join(names, "key").select("size", "words", "item")
    marks = items.where("hash is not null").select("hash").distinct()
    short = tuple(sorted(r[0] for r in items.where(f"size between 1 and {window - 1}").select("size").distinct().collect()))
    bits = bitmap.build(items, "hash")
    scanned = cut_lineage(
        documents.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(F.col(text_col)).alias("key"),
                         F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_scan(window, gram, short, bits), _FINGERPRINTED))
    hits = (
        _exploded(scanned).join(marks, "hash", "left_semi").select("id", "key", "at", "size", "words").distinct()
        .join(item_windows, ["size", "words"]).select("id", "key", "at", "size", "item")
    )
    return scanned.select("id", "key", "n_words"), hits


def decontaminate(documents: DataFrame, benchmark: DataFrame, **columns) -> DataFrame:
    """One row per document: id, key, n_words, n_hit, items (sorted distinct item ids as strings).

    ``n_hit`` counts the words inside any matching window. Item ids that are
    null make hits but are not listed. See :func:`contaminated_windows`.
    """
    rows, hits = contaminated_windows(documents, benchmark, **columns)
    per_window = hits.groupBy("id", "key", "at", "size").agg(F.collect_set(F.col("item").cast("string")).alias("_items"))
    reach = F.coalesce(F.max(F.col("at") + F.col("size")).over(
        Window.partitionBy("id", "key").orderBy("at", "size").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = per_window.select("id", "key", "_items", F.greatest(
        F.lit(0), F.col("at") + F.col("size") - F.greatest(F.col("at"), reach)).alias("_new"))
    found = covered.groupBy("id", "key").agg(
        F.sum("_new").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_items")))).alias("items"))
    left, right = rows.alias("l"), found.alias("r")
    same = F.col("l.id").eqNullSafe(F.col("r.id")) & F.col("l.key").eqNullSafe(F.col("r.key"))
    return left.join(right, same, "left").select(
        "l.id", "l.key", "l.n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"))
