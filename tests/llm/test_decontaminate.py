import random
import re

import numpy as np
import pytest

from larkspur.llm import bitmap, decontaminate as d
from larkspur.llm.words import letters_and_digits, split, text_buffer, windows, word_hashes
from tests.llm.frames import LONG, documents, table


def words_of(text):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(low))


def expected(docs, items, window=10):
    grams = {}
    for item, text in items:
        w = words_of(text)
        for i in range(max(len(w) - window + 1, 1) if w else 0):
            grams.setdefault(tuple(w[i:i + window]), set()).add(item)
    out = []
    for doc, text, *_ in docs:
        w, hit, found = words_of(text), set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit.update(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), tuple(sorted(str(x) for x in found if x is not None))))
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    rows = d.decontaminate(documents(spark, docs), table(spark, "item_id long, text string", items), **options)
    return sorted(((r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("window,gram", [(10, 5), (10, 10), (4, 2), (10, 1)])
def test_against_brute_force(spark, window, gram):
    rng = random.Random(window * gram)
    items = [(i % 7, " ".join(rng.choices("abc", k=rng.randint(0, 25)))) for i in range(12)] + [(None, "N u l l item of more than ten words it has")]
    docs = [(i, "; ".join(rng.choice([" ".join(rng.choices("ABCd", k=9)), rng.choice(items)[1].upper()]) for _ in range(6))) for i in range(60)]
    docs += [docs[0], docs[0], (0, docs[1][1]), (None, docs[2][1])]
    assert found(spark, docs, items, window=window, gram=gram) == expected(docs, items, window)


def test_awkward_tables(spark):
    items = [(1, None), (2, ""), (3, "!?"), (10, "lorem ipsum"), (9, "Ünï cödé w rds"), (11, LONG)]
    docs = [(1, None), (2, ""), (3, LONG), (4, "x ünï"), (5, "Ünï cödé w rds"), (None, None)]
    want = expected(docs, items)
    got = found(spark, docs, items)
    assert got == want and any(len(x[3]) == 2 for x in got)
    assert found(spark, docs, []) == expected(docs, [])
    assert found(spark, [], items) == []


def test_every_shared_window_shares_a_fingerprint():
    import pyarrow as pa
    rng = random.Random(1)
    text = " ".join(rng.choices("abcdefgh", k=400))
    buffer, offsets = text_buffer(pa.array([text, text[100:500], "a b c"]))
    words = split(buffer, offsets, (0, 3), letters_and_digits())
    chosen = d.winnow(words, word_hashes(words), 10, 5)
    for start, _ in zip(*windows(words, 10)):
        assert ((chosen >= start) & (chosen <= start + 5)).any()


def test_bitmap_forms_agree(spark):
    rows = spark.range(2000).selectExpr("xxhash64(id) AS h", "id % 3 = 0 AS known")
    bits = bitmap.build(rows.where("known"), "h")
    got = bitmap.mark(rows, "h", bitmap.words(rows.where("known"), "h"), "may").collect()
    assert all(r["may"] for r in got if r["known"]) and sum(r["may"] for r in got if not r["known"]) < 10
    assert [r["may"] for r in got] == bitmap.contains(bits, np.array([r["h"] for r in got])).tolist()
