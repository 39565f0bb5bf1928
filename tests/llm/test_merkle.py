import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.llm import merkle
from tests.llm.frames import LONG, documents


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def lift(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(*now[i:i + 3]) for i in range(0, len(now), 3)])
    return levels


def walk(levels, at, value):
    """Siblings on the way up, and the root with ``value`` at ``at``."""
    out = []
    for nodes in levels[:-1]:
        run = list(range(at // 3 * 3, min(at // 3 * 3 + 3, len(nodes))))
        out += [nodes[i] for i in run if i != at]
        value = h(*[value if i == at else nodes[i] for i in run])
        at //= 3
    return out, value


def brute(rows):
    """rows of (doc_id, source, lang, n_chars, text) to the operator's rows."""
    trees = {}
    for r in rows:
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
        text = r[4].replace("\n", "") if hit and r[4] is not None else r[4]
        trees.setdefault(r[1], []).append((r[0], record(r), record((*r[:4], text))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {}
    for s in names:
        trees[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        levels[s] = lift([x[1] for x in trees[s]])
    top = lift([levels[s][-1][0] for s in names])
    root = top[-1][0] if names else None
    for place, s in enumerate(names):
        for at, (doc, leaf, changed) in enumerate(trees[s]):
            low, value = walk(levels[s], at, changed)
            high, value = walk(top, place, value)
            yield doc, leaf, levels[s][-1][0], root, h(*low, *high), value, value == root


def found(spark, rows):
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    df = documents(spark, [(r[0], r[4], r[2], r[1]) for r in rows])
    return sorted(map(tuple, merkle.verify(merkle.manifest(df, changed)).collect()), key=repr)


def made(rows):
    return [(d, s, lang, None if t is None else len(t), t) for d, t, lang, s in rows]


@pytest.mark.parametrize("counts", [{"a": 1}, {None: 3, "b": 4}, {"z": 100, "é": 1, "": 2, None: 28, "A": 9}])
def test_against_brute_force(spark, monkeypatch, counts):
    """Chunks of nine, so that trees of several rounds are met."""
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    rng = random.Random(5)
    rows = [(rng.randrange(10 ** 6), rng.choice(["a\nb", "c", "", "\n", "é"]), "en", s) for s, n in counts.items() for _ in range(n)]
    rows = made(rows)
    assert found(spark, rows) == sorted(brute(rows), key=repr)


def test_many_sources(spark, monkeypatch):
    monkeypatch.setattr(merkle, "HEIGHT", 1)
    rows = made([(i, f"t\n{i}", None, f"s{i % 40}") for i in range(200)])
    assert found(spark, rows) == sorted(brute(rows), key=repr)


def test_awkward_rows(spark):
    rows = made([(None, None, None, None), (None, None, None, None), (1, "", None, "x"), (2, None, "de", "x"), (2, "same\n", "de", "x"),
                 (2, "same\n", "de", "x"), (3, LONG + "\n", None, "x")])
    assert found(spark, rows) == sorted(brute(rows), key=repr)
    assert found(spark, []) == []


def test_states_resume_the_hash():
    """A state before a slot goes on to the digest that hashing the whole run gives."""
    rng = np.random.default_rng(3)
    for count in (1, 2, 3, 50):
        leaves = rng.integers(0, 256, (count, 32), dtype=np.uint8)
        chunk = merkle.Chunk.build(leaves, merkle.height(count))
        assert [x.tobytes().hex() for x in chunk.levels[-1]] == lift([x.tobytes().hex() for x in leaves])[-1]
        assert (merkle.fold(leaves, chunk.steps()) == chunk.levels[-1][0]).all()
