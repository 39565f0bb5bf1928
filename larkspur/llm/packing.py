"""Packing tokenized documents into sequences by a grouping genetic algorithm.

Documents are tokenized and cut into pieces of at most one sequence. Pieces
that fill a sequence are done; the others are dealt evenly into blocks, and
each block is packed by islands that evolve side by side. An individual is a
whole packing of its block. A child takes whole well-filled bins of one parent,
the other parent's bins that hold any of the same pieces are dissolved with its
worst and a few random bins, and the pieces that lost their bin are placed again by best fit.
After every round an island sends its elite to the next one. Then each block
keeps its best packing, but gives its least filled bins back; what all blocks
gave back is dealt into fewer blocks and packed again, until one block is left.
"""

from __future__ import annotations

import random
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

CAPACITY = 2048
BLOCK = 4096
ISLANDS = 2
POPULATION = 6
ELITE = 2
ROUNDS = 4
GENERATIONS = 5
GIVEN_BACK = 1 / 16

_CACHED_WORDS = 600_000
_MARK = "\x01"
_END_ID = b"\0\0\0\0"
#: What keeps a text from being lower-cased as a whole: letters that NFC may change, the mark, added tokens.
_STRANGE = re.compile("[\u0300-\U0010ffff\x01]|<\\|")
_SIGNS = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"

_IS_SIGN, _IS_LETTER, _IS_BLANK = (np.isin(np.arange(256), list(x)) for x in (_SIGNS.encode(), range(97, 123), (32, *range(9, 14))))


def _is_plain(text: str) -> bool:
    """Whether a text may be lower-cased as a whole; texts of Latin-1 letters are told without a look at each."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _STRANGE.search(text) is None
    return _MARK not in text and "<|" not in text


class WordTokens:
    """Token ids of texts, one distinct word at a time.

    The tokenizer drops white space and none of its steps looks across it, so
    ids of a text are those of its words. Arrow splits plain texts and gives
    their distinct words and finds the known ones; ids are dealt out to all
    places by number. Words below U+0300 are unchanged by
    NFC and lower-cased letter by letter, and signs behind their letters are
    tokens apart; many of them go through a tokenizer without normalizer as
    one text, told apart by a mark. Other words, and those that hold the mark
    or may hold an added token, go whole through the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        mark = self.bare.encode(_MARK, add_special_tokens=False).ids
        assert len(mark) == 1, "the mark must be one token"
        self.mark = mark[0]
        vocabulary = self.bare.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = None
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(False, use_regex=False)])
        #: words of other texts; words of plain texts, their ids one after another and how many each has
        self.known: dict[str, bytes] = {"": b""}
        self._forget()

    def _forget(self) -> None:
        self.words, self.flat, self.size = pa.array([], pa.large_string()), np.zeros(0, "<u4"), np.zeros(0, np.int64)

    def _encode(self, words, known: dict[str, bytes]) -> None:
        """Learn lower-case words without marks or added tokens."""
        alone, other, ended = [], [], []
        for w in words:
            if w.isalpha():
                alone.append(w)
                continue
            # letters and a run of signs behind them are tokens apart
            letters = w.rstrip(_SIGNS)
            if letters != w and letters.isalpha():
                ended.append((w, letters, w[len(letters):]))
            else:
                other.append(w)
        if ended:
            alone = list({*alone, *[letters for _, letters, _ in ended if letters not in known]})
            other = list({*other, *[signs for _, _, signs in ended if signs not in known]})
        for part, ids in self._ids(self.letters, alone, " "):
            # a word of letters is one stretch of tokens up to one that ends a word
            self._keep(known, part, ids, (4 * np.flatnonzero(self.ends[ids]) + 4).tolist(), 0)
        for part, ids in self._ids(self.bare, other, f" {_MARK} "):
            self._keep(known, part, ids, [*(4 * np.flatnonzero(ids == self.mark)).tolist(), 4 * len(ids)], 4)
        for w, letters, signs in ended:
            known[w] = known[letters] + known[signs]

    @staticmethod
    def _ids(tokenizer, words: list[str], between: str):
        for low in range(0, len(words), 1000):
            part = words[low:low + 1000]
            yield part, np.array(tokenizer.encode_batch_fast([between.join(part)], add_special_tokens=False)[0].ids, "<u4")

    @staticmethod
    def _keep(known: dict[str, bytes], words: list[str], ids: np.ndarray, ends: list[int], gap: int) -> None:
        """Words whose ids end at the bytes ``ends``, ``gap`` bytes apart."""
        raw = ids.tobytes()
        for w, a, b in zip(words, [0, *[e + gap for e in ends[:-1]]], ends, strict=True):
            known[w] = raw[a:b]

    def _plain(self, texts: list[str]) -> list[bytes]:
        """Ids of texts that may be lower-cased as a whole."""
        counts, which, words = _numbered_words(texts)
        at = pc.index_in(words, value_set=self.words)
        if len(self.words) + at.null_count > _CACHED_WORDS:
            self._forget()
            at = pc.index_in(words, value_set=self.words)
        new = words.filter(at.is_null())
        listed, met = new.to_pylist(), {"": b""}
        self._encode([w for w in listed if w], met)
        found = list(map(met.__getitem__, listed))
        number = at.fill_null(-1).to_numpy().astype(np.int64)
        number[number < 0] = len(self.words) + np.arange(len(new))
        self.words = pa.concat_arrays([self.words, new])
        self.flat = np.concatenate([self.flat, np.frombuffer(b"".join(found), "<u4")])
        self.size = np.concatenate([self.size, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        which = number[which]
        sizes, starts = self.size[which], (np.cumsum(self.size) - self.size)[which]
        ends = np.cumsum(sizes)
        ids = self.flat[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])]
        cuts = np.concatenate(([0], ends))[np.cumsum([0, *counts])].tolist()
        return [ids[low:high].tobytes() for low, high in zip(cuts, cuts[1:])]

    def _other(self, texts: list[str]) -> list[bytes]:
        """Ids of texts with letters from U+0300 on, the mark, or what may be an added token."""
        split = [t.replace("\n", " ").split(" ") for t in texts]
        met = set().union(*split)
        words = {w for w in met if w not in self.known}
        if len(self.known) + len(words) > _CACHED_WORDS:
            self.known, words = {"": b""}, met - {""}
        strange = [w for w in words if _STRANGE.search(w)]
        lower = {w: w.lower() for w in words.difference(strange)}
        self._encode({x for x in lower.values() if x not in self.known}, self.known)
        for w, low in lower.items():
            self.known[w] = self.known[low]
        if strange:
            for w, e in zip(strange, self.whole.encode_batch_fast(strange, add_special_tokens=False)):
                self.known[w] = np.array(e.ids, "<u4").tobytes()
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        out, plain = [b""] * len(texts), [_is_plain(t) for t in texts]
        for kind, run in ((True, self._plain), (False, self._other)):
            places = [i for i, p in enumerate(plain) if p is kind]
            if places:
                for i, found in zip(places, run([texts[i] for i in places])):
                    out[i] = found
        return out


def _numbered_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(words of each text, number of the word at each place, distinct words) of lower-cased texts.

    Signs at the end of a word are a word of their own behind a letter a-z:
    they are tokens apart.
    """
    column = pa.array([t.lower() + "\n" for t in texts], pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[:len(texts) + 1]
    raw = np.frombuffer(column.buffers()[2], np.uint8)[:offsets[-1]]
    # the last byte of a text is a blank
    sign = _IS_SIGN[raw]
    first, last = np.flatnonzero(sign[1:] & ~sign[:-1]) + 1, np.flatnonzero(sign[:-1] & ~sign[1:])
    if sign[0]:
        last = last[1:]
    first = first[_IS_LETTER[raw[first - 1]] & _IS_BLANK[raw[last + 1]]]
    offsets = offsets + np.searchsorted(first, offsets)
    apart = np.insert(raw, first, 32)
    split = pc.ascii_split_whitespace(pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer(offsets), pa.py_buffer(apart)))
    numbered = split.flatten().dictionary_encode()
    return pc.list_value_length(split).to_numpy(), numbered.indices.to_numpy(), numbered.dictionary


@lru_cache(maxsize=4)
def _tokens(path: str) -> WordTokens:
    return WordTokens(path)


def pieces(documents: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           capacity: int = CAPACITY) -> DataFrame:
    """(id, piece, start, length, crc): each document's ids and a closing 0, cut where it is longer than ``capacity``.

    ``tokenizer`` is the path of the tokenizer's file on every machine. Null
    texts count as empty ones, which are the closing 0 alone.
    """
    def scan(batches):
        tokens = _tokens(tokenizer)
        for batch in batches:
            low, texts = 0, [t or "" for t in batch.column(1).to_pylist()]
            sizes = np.cumsum([0, *map(len, texts)])
            while low < len(texts):
                high = max(low + 1, int(np.searchsorted(sizes, sizes[low] + (1 << 22), "right")) - 1)
                out = []
                for at, ids in zip(range(low, high), tokens.ids(texts[low:high])):
                    ids += _END_ID
                    view, step = memoryview(ids), 4 * capacity
                    out += [(at, i, i * capacity, min(step, len(ids) - i * step) // 4, zlib.crc32(view[i * step:(i + 1) * step]))
                            for i in range(-(-len(ids) // step))]
                at, piece, start, length, crc = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(at)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["id", "piece", "start", "length", "crc"])
                low = high

    return documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        scan, f"id {dict(documents.dtypes)[id_col]}, piece int, start long, length long, crc long")


def best_fit(items, lengths: list[int], bins: np.ndarray, fills: list[int], capacity: int) -> None:
    """Place each of ``items`` in the fullest bin that takes it, or in a new one; ``bins`` and ``fills`` change.

    Bins lie in stacks by free space, and a bit mask tells which have any.
    """
    stacks: dict[int, list[int]] = {}
    for b, fill in enumerate(fills):
        if 0 < fill < capacity:
            stacks.setdefault(capacity - fill, []).append(b)
    mask = 0
    for free in stacks:
        mask |= 1 << free
    empty = [b for b, fill in enumerate(fills) if fill == 0]
    for i in items:
        length = lengths[i]
        room = mask >> length
        if room:
            free = length + (room & -room).bit_length() - 1
            stack = stacks[free]
            b = stack.pop()
            if not stack:
                mask &= ~(1 << free)
        else:
            free = capacity
            if empty:
                b = empty.pop()
            else:
                b = len(fills)
                fills.append(0)
        bins[i] = b
        fills[b] += length
        free -= length
        if free:
            stacks.setdefault(free, []).append(b)
            mask |= 1 << free


def _compact(bins: np.ndarray) -> np.ndarray:
    return np.unique(bins, return_inverse=True)[1].astype(np.int32)


def cross(receiver: np.ndarray, donor: np.ndarray, lengths: np.ndarray, capacity: int, rng: random.Random) -> np.ndarray:
    """A child: whole well-filled bins of ``donor``, bins of ``receiver`` free of their pieces, the rest by best fit."""
    fills = np.bincount(donor, lengths).astype(np.int64)
    good = np.argsort(-fills, kind="stable")[:max(1, len(fills) // 2)]
    chosen = good[rng.sample(range(len(good)), max(1, int(len(good) * rng.uniform(0.2, 0.8))))]
    given = np.zeros(len(fills), bool)
    given[chosen] = True
    injected = given[donor]
    held = np.bincount(receiver, lengths).astype(np.int64)
    broken = np.zeros(len(held), bool)
    broken[receiver[injected]] = True
    worst = np.argsort(held, kind="stable")[:1 + int(len(held) * rng.uniform(0, 0.1))]
    broken[worst] = True
    broken[rng.sample(range(len(held)), int(len(held) * rng.uniform(0, 0.05)))] = True
    displaced = np.flatnonzero(broken[receiver] & ~injected)
    child = receiver.astype(np.int64)
    child[injected] = len(held) + donor[injected]
    order = displaced[np.argsort(-lengths[displaced], kind="stable")].tolist()
    child[displaced] = -1
    labels, child = np.unique(child, return_inverse=True)
    if len(order):
        child -= 1
    totals = np.bincount(child[child >= 0], lengths[child >= 0], len(labels) - bool(len(order))).astype(np.int64).tolist()
    best_fit(order, lengths.tolist(), child, totals, capacity)
    return _compact(child)


def cost(bins: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[int, float]:
    """Number of bins, then how unevenly they are filled: full bins beside empty ones are best."""
    fills = np.bincount(bins, lengths) / capacity
    return len(fills), -float((fills * fills).sum())


def evolve(population: list[np.ndarray], lengths: np.ndarray, rng: random.Random, first: bool, lead: bool,
           capacity: int = CAPACITY, size: int = POPULATION, generations: int = GENERATIONS) -> list[np.ndarray]:
    """The best ``size`` individuals after some generations; the best comes first.

    ``first`` adds random packings, of which a ``lead`` island has one in
    decreasing order. A generation crosses two tournament winners as often as
    there are individuals. It ends early once no packing can have fewer bins.
    """
    population, listed = list(population), lengths.tolist()
    if first:
        for number in range(size):
            order = rng.sample(range(len(lengths)), len(lengths))
            if lead and number == 0:
                order.sort(key=lambda i: -listed[i])
            bins, fills = np.zeros(len(lengths), np.int64), []
            best_fit(order, listed, bins, fills, capacity)
            population.append(_compact(bins))
    ranked = sorted(((cost(p, lengths, capacity), n, p) for n, p in enumerate(population)), key=lambda x: x[:2])
    bound = -(-int(lengths.sum()) // capacity)
    for generation in range(generations):
        if ranked[0][0][0] <= bound and not (first and generation == 0):
            break
        parents = range(len(ranked))
        for _ in range(size):
            a, b = (min(rng.sample(parents, min(2, len(parents)))) for _ in range(2))
            child = cross(ranked[a][2], ranked[b][2], lengths, capacity, rng)
            worth = cost(child, lengths, capacity)
            if all(worth != known for known, _, _ in ranked):
                ranked.append((worth, len(ranked), child))
        ranked = [(c, n, p) for n, (c, _, p) in enumerate(sorted(ranked, key=lambda x: x[:2])[:size])]
    return [p for _, _, p in ranked[:size]]


_STATE = "block long, island int, migrant boolean, uids binary, lengths binary, population binary"
_PLACED = "block long, uid long, length long, bin long, offset long, given_back boolean"


def _state(rows: list[tuple]) -> pa.Table:
    block, island, migrant, uids, lengths, population = map(list, zip(*rows))
    return pa.table({"block": pa.array(block, pa.int64()), "island": pa.array(island, pa.int32()), "migrant": pa.array(migrant, pa.bool_()),
                     "uids": pa.array(uids, pa.binary()), "lengths": pa.array(lengths, pa.binary()), "population": pa.array(population, pa.binary())})


def _individuals(population: bytes, count: int) -> list[np.ndarray]:
    return list(np.frombuffer(population, np.int32).reshape(-1, count))


def _opened(islands: int):
    def run(key, table):
        table = table.sort_by("uid")
        uids, lengths = table["uid"].to_numpy().astype(np.int64).tobytes(), table["length"].to_numpy().astype(np.int32).tobytes()
        return _state([(key[0].as_py(), i, False, uids if i == 0 else b"", lengths, b"") for i in range(islands)])
    return run


def _evolved(level: int, number: int, islands: int, capacity: int, seed: int):
    def run(key, table):
        block, island = key[0].as_py(), key[1].as_py()
        rows = sorted(table.to_pylist(), key=lambda r: r["migrant"])
        own = rows[0]
        lengths = np.frombuffer(own["lengths"], np.int32)
        population = [p for r in rows for p in _individuals(r["population"], len(lengths))]
        rng = random.Random(f"{seed}:{level}:{number}:{block}:{island}")
        best = evolve(population, lengths, rng, number == 0, island == 0, capacity)
        out = [(block, island, False, own["uids"], own["lengths"], b"".join(p.tobytes() for p in best))]
        if islands > 1:
            out.append((block, (island + 1) % islands, True, b"", b"", b"".join(p.tobytes() for p in best[:ELITE])))
        return _state(out)
    return run


def _closed(capacity: int, given_back: float):
    """The best packing of a block: place of every piece, its least filled bins marked as given back."""
    def run(key, table):
        rows = sorted((r for r in table.to_pylist() if not r["migrant"]), key=lambda r: r["island"])
        lengths = np.frombuffer(rows[0]["lengths"], np.int32)
        best = min((p for r in rows for p in _individuals(r["population"], len(lengths))), key=lambda p: cost(p, lengths, capacity))
        order = np.argsort(best, kind="stable")
        fills = np.bincount(best, lengths).astype(np.int64)
        before = np.cumsum(lengths[order]) - lengths[order]
        first = np.cumsum(fills) - fills
        back = np.zeros(len(fills), bool)
        if given_back:
            back[np.argsort(fills, kind="stable")[:max(1, int(len(fills) * given_back))]] = True
        return pa.table({"block": np.full(len(order), key[0].as_py()), "uid": np.frombuffer(rows[0]["uids"], np.int64)[order], "length": lengths[order].astype(np.int64),
                         "bin": best[order].astype(np.int64), "offset": (before - first[best[order]]).astype(np.int64),
                         "given_back": back[best[order]]})
    return run


def pack_lengths(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, rounds: int = ROUNDS,
                 given_back: float = GIVEN_BACK, seed: int = 0) -> DataFrame:
    """(uid, sequence, offset) for items (uid, length), uids unique and lengths from 1 to ``capacity - 1``."""
    level, done, parallel = 0, None, 2 * items.sparkSession.sparkContext.defaultParallelism
    items = cut_lineage(items.select("uid", "length"))
    while True:
        blocks = max(1, -(-items.count() // block))
        dealt = items.withColumn("block", F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)))
        state = cut_lineage(dealt.groupBy("block").applyInArrow(_opened(islands), _STATE))
        for number in range(rounds):
            # few bytes but long to evolve: not to be merged into a few tasks
            spread = state.repartition(max(parallel, blocks * islands // 8), "block", "island")
            state = cut_lineage(spread.groupBy("block", "island").applyInArrow(_evolved(level, number, islands, capacity, seed), _STATE))
        best = cut_lineage(state.groupBy("block").applyInArrow(_closed(capacity, given_back if blocks > 1 else 0), _PLACED))
        kept = best.where(~F.col("given_back")).select(
            "uid", (F.lit(level << 56) + F.col("block") * (1 << 20) + F.col("bin")).alias("sequence"), "offset")
        done = kept if done is None else done.unionByName(kept)
        if blocks == 1:
            return done
        items, level = best.where("given_back").select("uid", "length"), level + 1


def pack(documents: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         seed: int = 0) -> DataFrame:
    """One row per piece: id, piece, start, length, crc, sequence, offset.

    Only documents longer than ``capacity`` are cut. Repeated rows are
    documents of their own, null ids stay null, and a table without rows gives
    none. Pieces get their numbers from the written table, so a lost executor
    does not change them. Blocks hold about ``BLOCK`` pieces whatever their
    documents, sources or ids are.
    """
    cut = cut_lineage(pieces(documents, tokenizer, id_col, text_col, capacity)).withColumn("uid", F.monotonically_increasing_id())
    full = cut.where(F.col("length") == capacity).select(
        "id", "piece", "start", "length", "crc", (-F.col("uid") - 1).alias("sequence"), F.lit(0).cast("long").alias("offset"))
    part = cut.where(F.col("length") < capacity)
    placed = pack_lengths(part, capacity, seed=seed)
    return full.unionByName(part.join(placed, "uid").select(full.columns))
