import random
from collections import defaultdict
from fractions import Fraction

import pytest

from larkspur.llm import mixing
from tests.llm.frames import LONG, documents


def filled(sizes, epochs=3):
    """Targets by the published rule, in exact arithmetic."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, clamped = sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in clamped)
        live = sum(weight[s] for s in names if s not in clamped)
        target = {s: Fraction(epochs * sizes[s]) if s in clamped else Fraction(rest * weight[s], live) for s in names}
        above = {s for s in names if s not in clamped and target[s] > epochs * sizes[s]}
        if not above:
            return target
        clamped |= above


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_words_taken(spark, seed):
    rng = random.Random(seed)
    names = [None, "b", "a", "Z", "é", "\U0001f600", "tiny"]
    rows = [(i, " ".join(["w"] * rng.choice([1, 3, 10, 40])), None, rng.choice(names[:-1] * 9 + ["tiny"])) for i in range(400)]
    got = mixing.mix(documents(spark, rows)).collect()
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = filled(sizes)
    assert len(got) == 400 and sum(target.values()) == pytest.approx(sum(sizes.values()))
    for s, goal in want.items():
        assert target[s] == pytest.approx(float(goal))
        assert target[s] - 40 <= taken[s] <= target[s] + 1e-6
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.mix(documents(spark, rows[::-1])).collect()), key=repr)


def test_awkward_rows(spark):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (None, "x y", None, None), (None, "x y", None, None), (3, LONG, None, "b"), (3, LONG, None, "b")]
    got = mixing.mix(documents(spark, rows)).collect()
    assert len(got) == 6 and {r["size"] for r in got} == {0, 2, 120_000}
    assert sum(r["taken"] for r in got) <= sum(r["size"] for r in got)
    assert mixing.mix(documents(spark, [])).collect() == []
    assert [r["taken"] for r in mixing.mix(documents(spark, [(1, None)])).collect()] == [0]


def test_given_weights(spark):
    rows = [(i, "w " * 10, None, "ab"[i % 2]) for i in range(40)]
    weights = spark.createDataFrame([("a", 3), ("b", 0)], "source string, weight long")
    got = mixing.mix(documents(spark, rows), weights, total=300)
    per = {r[0]: r[1] for r in got.groupBy("source").sum("taken").collect()}
    assert per == {"a": 300, "b": 0}
