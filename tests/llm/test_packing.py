import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from larkspur.llm import catalog, packing
from tests.llm.frames import LONG, documents

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(texts):
    whole = Tokenizer.from_file(PATH)
    return [np.array([*e.ids, 0], "<u4") for e in whole.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(got, texts, capacity=2048):
    """Pieces are cut as stated from ids of whole texts, and no sequence is too long or has a gap; the number of sequences."""
    want = []
    for ids in ids_of(texts):
        for i, low in enumerate(range(0, len(ids), capacity)):
            part = ids[low:low + capacity]
            want.append((i, low, len(part), zlib.crc32(part.tobytes())))
    assert sorted(tuple(r)[1:5] for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r[5]].append((r[6], r[3]))
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins)


@pytest.mark.parametrize("text", [
    "", " ", "plain words, and more!", "ÉCOLE Straße İstanbul ΣΑΣ ΣΑΣΣ", "a\x1cb a b\tc d", "é ́x ño", "<|endoftext|> <|STARTOFTEXT|> x<|startoftext|>y",
    "\x01 a\x01b", "a\x85b\xa0c\x0bd\x1ee\x0cf g\rh", "it's 'S don't 12 3a4", "end. End, END!? end... a_b_ x's. 's. é, 3. ²! ª. µ; A1, <b>, (paren) -dash- word***", "日本語 текст 😀👍🏽", "ﬁ ſ Å Ω", "x" * 5000, "\ud800".encode("utf-8", "replace").decode()])
def test_ids_of_words_are_ids_of_texts(text):
    tokens = packing.WordTokens(PATH)
    texts = [text, f"a {text} b", f"{text}\n{text}"]
    assert tokens.ids(texts) == [i[:-1].tobytes() for i in ids_of(texts)]


def test_signs_behind_letters_are_words_of_their_own():
    counts, which, words = packing._numbered_words(["It's, a-b. X!?", "", "...x, it's é."])
    places = [words[i].as_py() for i in which]
    at = np.cumsum([0, *counts]).tolist()
    assert [[w for w in places[low:high] if w] for low, high in zip(at, at[1:])] == [
        ["it's", ",", "a-b", ".", "x", "!?"], [], ["...x", ",", "it's", "é."]]
    assert len(set(words.to_pylist())) == len(words)


def test_known_words_are_not_encoded_again(monkeypatch):
    tokens, met = packing.WordTokens(PATH), []
    learn = tokens._encode
    monkeypatch.setattr(tokens, "_encode", lambda words, known: (met.extend(words), learn(words, known)))
    texts = ["alpha beta. gamma", "Beta, alpha! delta", "delta gamma; beta"]
    assert [tokens.ids([t])[0] for t in texts] == [i[:-1].tobytes() for i in ids_of(texts)]
    assert sorted(met) == sorted([".", "alpha", "beta", "gamma", "!", ",", "delta", ";"])


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(packing, "_CACHED_WORDS", 5)
    tokens = packing.WordTokens(PATH)
    texts = [f"word{i} word{i + 1} again" for i in range(20)]
    for t in texts:
        assert tokens.ids([t]) == [i[:-1].tobytes() for i in ids_of([t])]


def test_children_hold_every_piece_once_and_whole_bins():
    rng = random.Random(1)
    lengths = np.array([rng.randint(1, 100) for _ in range(300)], np.int32)
    found = packing.evolve([], lengths, rng, True, False, 100, 4, 1)
    for _ in range(50):
        a, b = rng.sample(found, 2)
        child = packing.cross(a, b, lengths, 100, rng)
        assert len(child) == 300 and np.bincount(child, lengths).max() <= 100 and (np.bincount(child) > 0).all()
        whole = {frozenset(np.flatnonzero(b == k).tolist()) for k in np.unique(b)}
        assert whole & {frozenset(np.flatnonzero(child == k).tolist()) for k in np.unique(child)}


def test_evolution_beats_best_fit_decreasing():
    """Triplets that fill a bin exactly: decreasing order is known to waste bins on them."""
    rng = np.random.default_rng(0)
    a, b = rng.integers(400, 900, (2, 300))
    lengths = np.concatenate([a, b, 2048 - a - b]).astype(np.int32)
    bins, fills = np.zeros(len(lengths), np.int64), []
    packing.best_fit(np.argsort(-lengths, kind="stable").tolist(), lengths.tolist(), bins, fills, 2048)
    population = []
    for number in range(4):
        population = packing.evolve(population, lengths, random.Random(number), number == 0, True)
    assert 300 <= packing.cost(population[0], lengths, 2048)[0] < len(fills)


def test_best_fit_takes_the_fullest_bin_that_has_room():
    rng = random.Random(3)
    lengths = [rng.randint(1, 60) for _ in range(200)]
    bins, fills = np.zeros(200, np.int64), []
    packing.best_fit(range(200), lengths, bins, fills, 60)
    held = []
    for i, length in enumerate(lengths):
        room = [f for f in held if f + length <= 60]
        fill = held[bins[i]] if bins[i] < len(held) else None
        assert fill == (max(room) if room else None)
        if fill is None:
            held.append(0)
        held[bins[i]] += length
    assert held == fills


@pytest.mark.parametrize("block", [40, 4096])
def test_blocks_end_near_the_bound(spark, block):
    rng = random.Random(7)
    lengths = [rng.randint(1, 700) for _ in range(1000)]
    items = spark.createDataFrame(list(enumerate(lengths)), "uid long, length long")
    got = packing.pack_lengths(items, block=block).collect()
    bins = defaultdict(int)
    for r in got:
        bins[r["sequence"]] += lengths[r["uid"]]
    assert sorted(r["uid"] for r in got) == list(range(1000)) and max(bins.values()) <= 2048
    assert len(bins) <= -(-sum(lengths) // 2048) * (1.03 if block == 40 else 1) + 1


def test_awkward_rows(spark):
    rows = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, LONG), (3, LONG), (4, "\n\t "), (5, "é" * 3000)]
    got = packing.pack(documents(spark, rows), PATH).collect()
    check(got, [t for _, t in rows])
    assert {r["id"] for r in got} == {1, 2, None, 3, 4, 5}
    assert packing.pack(documents(spark, []), PATH).collect() == []


def test_op13(spark, folder):
    got = catalog.op13_best_fit_packing(spark, folder).collect()
    texts = [r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    count = check(got, texts)
    assert count <= -(-sum(map(len, ids_of(texts))) // 2048) + 1
    assert [c for c in got[0].asDict()] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
