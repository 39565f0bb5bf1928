import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur.llm import repeats
from tests.llm.frames import LONG, documents


def expected(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t, *_ in rows]
    place = [float("inf") if r[0] is None else r[0] for r in rows]
    least = {}
    for p, w in zip(place, words):
        for i in range(len(w) - length + 1):
            g = tuple(w[i:i + length])
            least[g] = min(least.get(g, p), p)
    out = []
    for (d, *_), p, w in zip(rows, place, words):
        gone = set()
        for i in range(len(w) - length + 1):
            if least[tuple(w[i:i + length])] < p:
                gone.update(range(i, i + length))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(map(tuple, df.select("id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


@pytest.mark.parametrize("length,seed", [(13, None), (5, None), (8, 2), (3, 3), (1, None)])
def test_against_brute_force(spark, monkeypatch, length, seed):
    monkeypatch.setattr(repeats, "CHUNK", 300)
    rng = random.Random(length)
    base = [" ".join(rng.choices("abcdefgh", k=rng.randint(0, 60))) for _ in range(30)]
    rows = [(rng.choice([None, *range(40)]), "\t".join([rng.choice(base), rng.choice(base)])) for _ in range(60)]
    rows += [(7, "x"), (7, "x"), (100, rows[0][1]), (100, rows[0][1]), (3, "é " * 20), (2, "é " * 20)]
    assert found(repeats.remove_repeats(documents(spark, rows), length, seed)) == expected(rows, length)


def test_awkward_texts(spark):
    rows = [(1, None), (2, ""), (None, " \n\x0b "), (4, LONG), (5, LONG + "end"), (6, "\x00 a b  c"), (None, LONG)]
    got = repeats.remove_repeats(documents(spark, rows))
    assert found(got) == expected(rows, 13)
    assert {r["id"]: r["kept"] for r in got.where("id = 6").collect()} == {6: "\x00 a b  c"}
    assert repeats.remove_repeats(documents(spark, [])).collect() == []


def test_a_passage_in_every_document_takes_one_entry_a_chunk(spark):
    passage = " ".join(f"p{i}" for i in range(20))
    rows = documents(spark, [(i, f"u{i} {passage} v{i}") for i in range(500)])
    spans = repeats.repeated_spans(rows)
    assert spans.count() == 499
    assert {(tuple(r["starts"]), tuple(r["ends"])) for r in spans.collect()} == {((1,), (21,))}
    scan = rows.select("doc_id", F.xxhash64("text").alias("key"), "text").coalesce(1)
    asks = scan.mapInArrow(repeats._seed_windows(13, 1, False), repeats._PIECE).where("kind = 2").collect()
    assert len(asks) == 1 and len(asks[0]["a"]) // 8 < 8 + 500 * 28


def test_lengths_double():
    assert repeats._lengths(13, 7) == [7, 13] and repeats._lengths(13, 2) == [2, 4, 8, 13] and repeats._lengths(4, 9) == [4]


def test_levels_end_without_candidates(spark):
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(20)]
    assert repeats.repeated_spans(documents(spark, rows)).collect() == []
