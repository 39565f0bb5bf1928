"""Alignment of two tokenizers, and how many documents hold each pair of linked tokens.

A byte-level tokenizer (A) and a piece tokenizer (B) cut the same bytes. Offsets
where tokens of both end cut them into groups; an A and a B token are linked if
their byte ranges overlap. The first pass aligns all documents and keeps, per
task, the distinct pairs with the number of its documents that hold them. A
minimal perfect hash of all distinct pairs turns each task's counts into a dense
vector without keys, and the vectors are summed in a tree. The second pass
looks the counts up, by hash and verified key.

Neither tokenizer's tokens cross from a visible character to a blank or line
line break, so texts are aligned one distinct stretch at a time. The first pass
writes down, for every slice of documents, the links of its new stretches and the
numbers of each document's stretches; the second reads these instead of texts.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.llm.words import mix
from larkspur.session import cut_lineage

BUCKET = 1 << 18
BUCKETS_AT_ONCE = 16
FAN_IN = 8
CHUNK = 1000

_CACHED = 500_000
_KEPT_PAIRS = 1 << 20
_FLAGS = 1 << 24
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
_RUN = re.compile(r"\s[ \n]|\x00")
_U = np.uint64


def _byte_letters() -> dict[str, int]:
    """Letter to byte of byte-level vocabularies: printable bytes stand for themselves, the rest follow from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass
class Aligned:
    """Some stretches, in an order of its own.

    ``stats`` has the numbers of A tokens, B tokens, groups and links; the links
    of stretch i are ``links[bounds[i]:bounds[i + 1]]``; its groups' text ends
    in a semicolon. Stretches whose bytes were changed are in ``lost``.
    """

    stretches: list[str]
    stats: np.ndarray
    bounds: np.ndarray
    links: np.ndarray
    texts: list[str]
    lost: list[str]


class Aligner:
    """Both tokenizers, from their files."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(byte_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = _byte_letters()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            if all(c in letters for c in token):
                self.a_bytes[i] = bytes(letters[c] for c in token)
        self.b_bytes, whole = [], False
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_unused(i):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace("▁", " ").encode())
                whole |= "\n" in piece or re.search("[^▁]▁", piece) is not None
        #: A piece across a blank leaves only whole texts to align.
        self.whole = whole
        #: A's ids before a comma, before a bar; B's before a comma, before a semicolon.
        self.written = [f"{i}{end}" for size, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for end in ends for i in range(size)]
        self.a_size = np.array([len(x) for x in self.a_bytes])
        self.b_size = np.array([len(x) for x in self.b_bytes])

    def cut(self, text: str) -> list[str]:
        """Stretches of a blank and ``text``, cut before each blank or line break that follows a visible character."""
        full = " " + text
        if self.whole:
            return [full]
        if _RUN.search(full):
            return _CUT.split(full)
        return full.replace("\n", "\x00\n").replace(" ", "\x00 ").split("\x00")[1:]

    def align(self, stretches: list[str], with_text: bool) -> Aligned:
        """Stretches that end in a visible character are aligned as one text behind a letter, others one by one."""
        alone = [s for s in stretches if s[-1].isspace() or "▁" in s or len(s) > 200]
        apart = set(alone)
        together = [s for s in stretches if s not in apart]
        parts: list[Aligned] = []
        lost: list[str] = []
        if self.whole:
            alone, together = stretches, []
        for low in range(0, len(together), CHUNK):
            part = together[low:low + CHUNK]
            found = self._joined(part, with_text)
            if found is None:
                alone = alone + part
            else:
                parts.append(found)
        for s in alone:
            found = self._joined([s], with_text)
            if found is None:
                lost.append(s)
            else:
                parts.append(found)
        starts = np.cumsum([0, *[len(p.links) for p in parts]])
        return Aligned([s for p in parts for s in p.stretches],
                       np.concatenate([np.zeros((0, 4), np.int64), *[p.stats for p in parts]]),
                       np.concatenate([np.zeros(1, np.int64), *[p.bounds[1:] + at for p, at in zip(parts, starts)]]),
                       np.concatenate([np.zeros(0, np.int64), *[p.links for p in parts]]), [t for p in parts for t in p.texts], lost)

    def _joined(self, part: list[str], with_text: bool) -> Aligned | None:
        """Alignment of stretches as one text, behind a letter unless they are whole texts.

        None if a tokenizer changes bytes or the end of a stretch is no token's.
        """
        led = not self.whole
        text = "x" * led + "".join(part)
        raw = text.encode()
        a, b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[not led:], num_threads=1)
        # B has added its blank before the letter
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != b" " * led + raw:
            return None
        ends = led + np.cumsum([len(s) if s.isascii() else len(s.encode()) for s in part])
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]) - led
        if led:
            a_from, b_from = np.searchsorted(a_end, 1), np.searchsorted(b_end, 1)
            if a_end[a_from] != 1 or b_end[b_from] != 1:
                return None
            a, a_end, b, b_end = a[a_from + 1:], a_end[a_from + 1:], b[b_from + 1:], b_end[b_from + 1:]
        both = np.intersect1d(a_end, b_end, assume_unique=True)
        if not len(both) or not np.array_equal(both[np.searchsorted(both, ends).clip(max=len(both) - 1)], ends):
            return None
        every = np.union1d(a_end, b_end)
        links = (a[np.searchsorted(a_end, every)] << 32) | b[np.searchsorted(b_end, every)]
        bounds = [np.concatenate(([0], np.searchsorted(x, ends, "right"))) for x in (a_end, b_end, both, every)]
        stats = np.stack([np.diff(x) for x in bounds], axis=1)
        texts = self._texts(a, a_end, b, b_end, both, bounds[0] + bounds[1]) if with_text else []
        return Aligned(part, stats, bounds[3], links, texts, [])

    def _texts(self, a, a_end, b, b_end, both, bounds) -> list[str]:
        """Each stretch's groups as text: tokens in order of group, side and place, each with what follows it."""
        a_last, b_last = np.isin(a_end, both, assume_unique=True), np.isin(b_end, both, assume_unique=True)
        group = np.concatenate([2 * np.searchsorted(both, a_end), 2 * np.searchsorted(both, b_end) + 1])
        sizes = len(self.a_bytes), len(self.b_bytes)
        code = np.concatenate([a + sizes[0] * a_last, 2 * sizes[0] + b + sizes[1] * b_last])
        words = list(map(self.written.__getitem__, code[np.argsort(group, kind="stable")].tolist()))
        cuts = bounds.tolist()
        return ["".join(words[low:high]) for low, high in zip(cuts, cuts[1:])]


@lru_cache(maxsize=4)
def _aligner(byte_path: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, piece_path)


class PairHash:
    """A minimal perfect hash: each level keeps the keys that are alone at their place, the rest go on."""

    def __init__(self, words: list[np.ndarray], keys: np.ndarray):
        self.words, self.keys = words, keys
        ones = np.concatenate([np.bitwise_count(w) for w in words]) if words else np.zeros(0, np.uint8)
        self.before = np.cumsum(ones, dtype=np.int64) - ones
        self.first = np.cumsum([0, *map(len, words)])

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(keys ^ _U((0x9E3779B97F4A7C15 * (level + 1)) & (2 ** 64 - 1))) % _U(size)

    @staticmethod
    def build(keys: np.ndarray) -> "PairHash":
        """Over distinct keys; ``keys`` of the result are in the order of their hashes."""
        rest, words = keys.astype(np.int64).view(_U), []
        while len(rest):
            size = -(-2 * len(rest) // 64) * 64
            places = PairHash._places(rest, len(words), size).astype(np.int64)
            alone = np.bincount(places, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view("<u8").astype(_U))
            rest = rest[~alone[places]]
        made = PairHash(words, np.zeros(0, np.int64))
        order = made.slots(keys)
        made.keys = np.empty(len(keys), np.int64)
        made.keys[order] = keys
        return made

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Hash of each key, below the number of keys; of other keys any, or -1."""
        out, left, rest = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys.astype(np.int64).view(_U)
        for level, words in enumerate(self.words):
            places = self._places(rest, level, 64 * len(words))
            word, bit = (places >> _U(6)).astype(np.int64), places & _U(63)
            held = words[word]
            here = (held >> bit) & _U(1) == 1
            rank = self.before[self.first[level] + word] + np.bitwise_count(held & ((_U(1) << bit) - _U(1)))
            out[left[here]] = rank[here]
            left, rest = left[~here], rest[~here]
        return out

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Hash of each key, -1 for keys it was not built over."""
        at = self.slots(keys)
        if not len(self.keys):
            return at
        return np.where((at >= 0) & (self.keys[at] == keys), at, -1)

    def pack(self) -> tuple[list[bytes], bytes]:
        return [w.tobytes() for w in self.words], self.keys.tobytes()

    @staticmethod
    def unpack(words: list[bytes], keys: bytes) -> "PairHash":
        return PairHash([np.frombuffer(w, _U) for w in words], np.frombuffer(keys, np.int64))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    high = mix(keys.astype(np.int64).view(_U) + _U(0x5851F42D4C957F2D)) >> _U(32)
    return ((high * _U(buckets)) >> _U(32)).astype(np.int64)


@dataclass
class Table:
    """Hashes, keys and, when they are known, counts of some buckets of pairs."""

    buckets: int
    hashes: dict[int, PairHash]
    counts: dict[int, np.ndarray] = field(default_factory=dict)

    def each(self, pairs: np.ndarray):
        """(bucket, places in ``pairs``, slots) for the pairs in these buckets."""
        whose = bucket_of(pairs, self.buckets)
        for bucket, known in self.hashes.items():
            at = np.flatnonzero(whose == bucket)
            slots = known.find(pairs[at])
            yield bucket, at[slots >= 0], slots[slots >= 0]


def _rows_of(batch, limit: int = 1 << 21):
    """Slices of a batch of about ``limit`` bytes of text, or of one longer text."""
    low, held = 0, 0
    texts = batch.column(1).to_pylist()
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= limit or i == len(texts) - 1:
            yield low, texts[low:i + 1]
            low, held = i + 1, 0


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of every run."""
    return np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())


class _Known:
    """Stretches met so far by number; -1 for those whose bytes a tokenizer changes."""

    def __init__(self, aligner: Aligner, with_text: bool):
        self.aligner, self.with_text = aligner, with_text
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.size = 0

    def learn(self, texts: list[str | None]) -> tuple[list[list[str]], Aligned, bool]:
        """The texts' stretches, the alignment of new ones, and whether all others were forgotten."""
        split = [self.aligner.cut(t) if t else [] for t in texts]
        met = set().union(*split)
        new = [s for s in met if s not in self.number]
        forgotten = len(self.number) + len(new) > _CACHED
        if forgotten:
            self.clear()
            new = list(met)
        found = self.aligner.align(new, self.with_text)
        self.number |= dict(zip(found.stretches, range(self.size, self.size + len(found.stretches))))
        self.number |= dict.fromkeys(found.lost, -1)
        self.size += len(found.stretches)
        return split, found, forgotten

    def numbers(self, split: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(documents with tokens, their numbers of stretches, numbers of those stretches)."""
        sizes = np.array([len(s) for s in split], np.int64)
        at = np.fromiter(map(self.number.__getitem__, itertools.chain.from_iterable(split)), np.int64, int(sizes.sum()))
        whose = np.repeat(np.arange(len(split)), sizes)
        good = sizes > 0
        good[whose[at < 0]] = False
        return np.flatnonzero(good), sizes[good], at[good[whose]]


def _packed(values: np.ndarray) -> bytes:
    raw = values.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kind) -> np.ndarray:
    size = int.from_bytes(blob[:8], "little")
    return np.frombuffer(pa.decompress(blob[8:], decompressed_size=size, codec="zstd", asbytes=True) if size else b"", kind)


#: A row is a document, a slice that stands before its documents, or a pair with its number of documents.
_DOCUMENT = {"n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}
_SLICE = {"fresh": pa.bool_(), "links": pa.binary(), "sizes": pa.binary(), "at": pa.binary(), "per_doc": pa.binary()}
_PAIR = {"pair": pa.int64(), "n": pa.int64()}
_WRITTEN = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, fresh boolean, links binary, sizes binary, " \
    "at binary, per_doc binary, pair long, n long"


def _rows(kind: pa.DataType, count: int, values: dict) -> pa.RecordBatch:
    kinds = {"id": kind, "key": pa.int64()} | _DOCUMENT | _SLICE | _PAIR
    return pa.RecordBatch.from_arrays([
        pa.nulls(count, t) if name not in values else values[name] if isinstance(values[name], pa.Array) else pa.array(values[name], t)
        for name, t in kinds.items()], names=list(kinds))


def _first_pass(byte_path: str, piece_path: str):
    def scan(batches):
        known = _Known(_aligner(byte_path, piece_path), True)
        stats, texts, kind = np.zeros((0, 4), np.int64), [], None
        number: dict[int, int] = {}
        counts = np.zeros(0, np.int64)
        starts = sizes = flat = np.zeros(0, np.int64)

        def kept():
            keys = np.fromiter(number, np.int64, len(number))
            for low in range(0, len(keys), 1 << 16):
                part = keys[low:low + (1 << 16)]
                yield _rows(kind, len(part), {"pair": part, "n": counts[low:low + len(part)]})

        def described(part, fresh, found, docs, per_doc, at):
            """The slice, then its documents."""
            count = part.num_rows
            every = np.zeros(count, np.int32)
            every[docs] = per_doc
            yield _rows(kind, 1, {"fresh": [fresh], "links": [_packed(found.links)], "sizes": [_packed(np.diff(found.bounds).astype(np.int32))],
                                  "at": [_packed(at.astype(np.int32))], "per_doc": [_packed(every)]})
            out, digests, low = np.zeros((count, 4), np.int64), [""] * count, 0
            if len(docs):
                out[docs] = np.add.reduceat(stats[at], np.cumsum(per_doc) - per_doc, axis=0)
            for i, size in zip(docs.tolist(), per_doc.tolist()):
                whole = "".join([texts[k] for k in at[low:low + size].tolist()])
                digests[i] = hashlib.sha256(whole[:-1].encode()).hexdigest()
                low += size
            yield _rows(kind, count, {"id": part.column(0), "key": part.column(2), "groups_sha256": digests,
                                      **{name: out[:, k] for k, name in enumerate(["n_a", "n_b", "n_groups", "n_links"])}})

        for batch in batches:
            kind = batch.schema.field(0).type
            for low, rows in _rows_of(batch):
                fresh = len(number) > _KEPT_PAIRS
                if fresh:
                    yield from kept()
                    number, counts = {}, counts[:0]
                    known.clear()
                    starts = sizes = flat = flat[:0]
                split, found, forgotten = known.learn(rows)
                fresh |= forgotten
                if fresh:
                    starts = sizes = flat = flat[:0]
                    stats, texts = stats[:0], []
                stats = np.concatenate([stats, found.stats])
                texts += found.texts
                distinct, which = np.unique(found.links, return_inverse=True)
                ids = np.array([number.setdefault(p, len(number)) for p in distinct.tolist()], np.int64)
                starts = np.concatenate([starts, len(flat) + found.bounds[:-1]])
                sizes = np.concatenate([sizes, np.diff(found.bounds)])
                flat = np.concatenate([flat, ids[which]])
                counts = np.concatenate([counts, np.zeros(len(number) - len(counts), np.int64)])
                docs, per_doc, at = known.numbers(split)
                yield from described(batch.slice(low, len(rows)), fresh, found, docs, per_doc, at)
                # which document holds which pair, for as many documents at a time as fit
                ends, step = np.cumsum(per_doc), max(1, _FLAGS // max(1, len(number)))
                for first in range(0, len(docs), step):
                    here = slice(ends[first] - per_doc[first], ends[min(first + step, len(docs)) - 1])
                    own, whose = at[here], np.repeat(np.arange(len(per_doc[first:first + step])), per_doc[first:first + step])
                    held = np.zeros((len(per_doc[first:first + step]), len(number)), bool)
                    held[np.repeat(whose, sizes[own]), flat[_ragged(starts[own], sizes[own])]] = True
                    counts += held.sum(axis=0)
        yield from kept()

    return scan


def _second_pass(shared, best):
    def scan(batches):
        table, top = shared.value, best.value
        sums = waiting = np.zeros((0, 2), np.int64)
        for batch in batches:
            out, low = np.zeros((batch.num_rows, 2), np.int64), 0
            is_slice = batch.column("links").is_valid().to_numpy(zero_copy_only=False)
            for here in [*np.flatnonzero(is_slice).tolist(), batch.num_rows]:
                out[low:here], waiting = waiting[:here - low], waiting[here - low:]
                low = here + 1
                if here < batch.num_rows:
                    fresh, links, sizes, at, per_doc = (batch.column(name)[here].as_py() for name in _SLICE)
                    bounds = np.concatenate(([0], np.cumsum(_unpacked(sizes, np.int32), dtype=np.int64)))
                    sums = np.concatenate([sums[:0] if fresh else sums, _sums(_unpacked(links, np.int64), bounds, table, top)])
                    at, per_doc = _unpacked(at, np.int32), _unpacked(per_doc, np.int32).astype(np.int64)
                    waiting, docs = np.zeros((len(per_doc), 2), np.int64), np.flatnonzero(per_doc)
                    if len(docs):
                        waiting[docs] = np.add.reduceat(sums[at], (np.cumsum(per_doc) - per_doc)[docs], axis=0)
            documents = pa.array(~is_slice)
            whole = batch.select(["id", "key", *_DOCUMENT]).filter(documents)
            arrays = dict(zip(whole.schema.names, whole.columns)) | {
                "n_best": pa.array(out[~is_slice, 0]), "count_sum": pa.array(out[~is_slice, 1])}
            names = ["id", "key", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
            yield pa.RecordBatch.from_arrays([arrays[n] for n in names], names=names)
    return scan


def _sums(links: np.ndarray, bounds: np.ndarray, table: Table, best: np.ndarray) -> np.ndarray:
    """Per stretch: links with their A id's highest count, and the sum of counts, over the pairs of ``table``."""
    pairs, which = np.unique(links, return_inverse=True)
    count = np.zeros(len(pairs), np.int64)
    for bucket, at, slots in table.each(pairs):
        count[at] = table.counts[bucket][slots]
    top = count > 0
    top[top] = count[top] == best[pairs[top] >> 32]
    upto = np.concatenate([np.zeros((1, 2), np.int64), np.cumsum(np.stack([top[which], count[which]], axis=1), axis=0)])
    return upto[bounds[1:]] - upto[bounds[:-1]]


def _hashed(key, table):
    words, keys = PairHash.build(np.sort(table["pair"].to_numpy())).pack()
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "words": pa.array([words], pa.list_(pa.binary())),
                     "keys": pa.array([keys], pa.binary())})


def _summed(key, table):
    vectors = [np.frombuffer(v, np.int64) for v in table["counts"].to_pylist()]
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "part": pa.array([key[1].as_py()], pa.int64()),
                     "counts": pa.array([np.sum(vectors, axis=0).tobytes()], pa.binary())})


def pair_tables(found: DataFrame):
    """Tables of counts, at most BUCKETS_AT_ONCE buckets each, for sparse counts (pair, n) of the first pass.

    About BUCKET pairs are hashed together, and a table holds at most about
    BUCKET * BUCKETS_AT_ONCE of them (17 bytes each), whatever the corpus is;
    more pairs make more tables.
    """
    spark = found.sparkSession
    distinct = cut_lineage(found.select("pair").distinct())
    buckets = max(1, -(-distinct.count() // BUCKET))

    def deal(batches):
        for batch in batches:
            pairs = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(bucket_of(pairs, buckets)), batch.column(0)], names=["bucket", "pair"])

    hashes = cut_lineage(distinct.mapInArrow(deal, "bucket long, pair long").groupBy("bucket").applyInArrow(
        _hashed, "bucket long, words array<binary>, keys binary"))
    parts = found.rdd.getNumPartitions()
    for low in range(0, buckets, BUCKETS_AT_ONCE):
        here = (F.col("bucket") >= low) & (F.col("bucket") < low + BUCKETS_AT_ONCE)
        table = Table(buckets, {r["bucket"]: PairHash.unpack(r["words"], r["keys"]) for r in hashes.where(here).collect()})
        shared = spark.sparkContext.broadcast(table)

        def dense(batches, shared=shared):
            known = shared.value
            counts = {b: np.zeros(len(h.keys), np.int64) for b, h in known.hashes.items()}
            for batch in batches:
                pairs, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
                for bucket, at, slots in known.each(pairs):
                    np.add.at(counts[bucket], slots, n[at])
            part = TaskContext.get().partitionId()
            for bucket, vector in counts.items():
                if vector.any():
                    yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int64()), pa.array([part], pa.int64()), pa.array([vector.tobytes()], pa.binary())],
                                                     names=["bucket", "part", "counts"])

        vectors, left = found.select("pair", "n").mapInArrow(dense, "bucket long, part long, counts binary"), parts
        while left > 1:
            vectors = vectors.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("long")).groupBy("bucket", "part").applyInArrow(
                _summed, "bucket long, part long, counts binary")
            left = -(-left // FAN_IN)
        table.counts = {r["bucket"]: np.frombuffer(r["counts"], np.int64) for r in vectors.select("bucket", "counts").collect()}
        yield table
        shared.unpersist()


def align(documents: DataFrame, byte_tokenizer: str, piece_tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A pair's count is the number of rows that hold it linked. Null and empty
    texts, and texts whose bytes a tokenizer changes, have zeros and an empty
    hash and count for no pair; repeated rows are documents of their own.
    Memory in a task, and on the driver, is bounded by caches, one table of
    pairs and A's vocabulary; with more tables each reads what was written down,
    and their sums meet by id and hash of the text, where repeated rows have
    equal sums.
    """
    spark = documents.sparkSession
    paths = byte_tokenizer, piece_tokenizer
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.xxhash64(F.col(text_col).cast("string")).alias("key"))
    written = cut_lineage(rows.mapInArrow(_first_pass(*paths), f"id {dict(documents.dtypes)[id_col]}, {_WRITTEN}"))
    found = cut_lineage(written.where("pair is not null").select("pair", "n"))
    top, tables = np.zeros(0, np.int64), []
    for table in pair_tables(found):
        for bucket, known in table.hashes.items():
            ids = known.keys >> 32
            if len(ids):
                top = np.concatenate([top, np.zeros(max(0, int(ids.max()) + 1 - len(top)), np.int64)])
                np.maximum.at(top, ids, table.counts[bucket])
        tables.append(spark.sparkContext.broadcast(table))
    best = spark.sparkContext.broadcast(top)
    # a checkpoint keeps partitions and the order of their rows: a slice stands before its documents
    scanned = written.where("pair is null").select("id", "key", *_DOCUMENT, *_SLICE)
    kinds = f"id {dict(documents.dtypes)[id_col]}, key long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    passes = [scanned.mapInArrow(_second_pass(t, best), kinds) for t in tables]
    whole = passes[0]
    if len(passes) > 1:
        more = None
        for p in passes[1:]:
            one = p.groupBy("id", "key").agg(F.max("n_best").alias("b"), F.max("count_sum").alias("s"))
            more = one if more is None else more.unionByName(one)
        more = more.groupBy("id", "key").agg(F.sum("b").alias("b"), F.sum("s").alias("s"))
        w, m = whole.alias("w"), more.alias("m")
        whole = w.join(m, F.col("w.id").eqNullSafe(F.col("m.id")) & F.col("w.key").eqNullSafe(F.col("m.key"))).select(
            "w.*", "b", "s").withColumns({"n_best": F.col("n_best") + F.col("b"), "count_sum": F.col("count_sum") + F.col("s")}).drop("b", "s")
    return whole.drop("key")
