"""Language ID and toxicity: held-out results on a few invented languages, and awkward rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from larkspur.llm import langid, toxicity
from tests.llm.frames import LONG, documents, table

ALPHABETS = {"xa": "abcde aeiou", "xb": "fghij aeiou", "xc": "klmno éèà", "xd": "pqrst ñü", "xe": "uvwxyz о", "xf": "абвгд", "xg": "αβγδε"}


def speak(rng, lang, words):
    letters = ALPHABETS[lang].replace(" ", "")
    return " ".join("".join(rng.choices(letters, k=rng.randint(2, 7))) for _ in range(words))


@pytest.mark.parametrize("count", [1, 2, 4, 7])
def test_languages(spark, count):
    rng, names = random.Random(count), list(ALPHABETS)[:count]
    rows = [(i, speak(rng, lang, 40), lang, None) for i in range(60) for lang in names]
    model = langid.fit(documents(spark, rows + [(1, None, "xa", None), (2, "text", None, None), (3, "", "xa", None)]))
    tests = [(i, speak(rng, lang, 12), None, lang) for i in range(20) for lang in names]
    got = langid.identify(documents(spark, tests), model).collect()
    assert sum(r["_lang"] == r["source"] for r in got) >= 0.97 * len(got)
    assert all(0 <= r["_score"] <= 1 for r in got)
    assert not model.code.shape[0] != count


def test_codewords_stand_apart():
    for n in (2, 3, 4, 5, 6, 20, 100):
        code = langid.codewords(n)
        assert len({tuple(c) for c in code.tolist()}) == n
        if n > 2:
            assert min((code[i] != code[j]).sum() for i in range(n) for j in range(i)) >= 2


def test_wrong_bits_are_corrected():
    counts = np.zeros((5, 1 << langid.SLOTS_LOG2))
    model = langid.Model(list("abcde"), counts)
    for i, word in enumerate(model.code):
        margins = np.where(word, 1.0, -1.0)
        for bits in ((), (0,), (3, 9)):
            wrong = margins.copy()
            wrong[list(bits)] *= -0.3
            assert model.decode(wrong, 100)[0] == "abcde"[i]
    assert model.decode(np.zeros(model.code.shape[1]), 100)[2]


def test_bounds_come_from_every_distinct_text(spark):
    """Order statistics over all texts, however many; a copy counts once."""
    rng = random.Random(5)
    texts = [(lang, speak(rng, lang, rng.randint(1, 3))) for _ in range(11_000) for lang in ("xa", "xb", "xe", "xg")]
    rows = [(i, text, lang, None) for i, (lang, text) in enumerate(texts + [("xa", texts[0][1])] * 500)]
    model = langid.fit(documents(spark, rows))
    gaps, losses = ([[] for _ in langid.LENGTHS] for _ in range(2))
    for lang, text in set(texts):
        raw = langid._LOWER[np.frombuffer(text.encode(), np.uint8)]
        for at, length in enumerate(langid.LENGTHS):
            if length <= len(raw):
                found = model.distances(model.margins(langid._cut(raw, length)), length)
                if model.languages[int(np.argmin(found))] == lang:
                    near = np.sort(found)
                    gaps[at].append(near[1] - near[0])
                    losses[at].append(near[0])
    assert sum(map(bool, losses)) >= 5
    for at in range(len(langid.LENGTHS)):
        if losses[at]:
            n = len(losses[at])
            low, high = (max(int(np.ceil(p * n)), 1) - 1 for p in (langid.OUTSIDE, 1 - langid.OUTSIDE))
            assert model.gaps[at] == pytest.approx(max(sorted(gaps[at])[low], 1e-3), rel=1e-9)
            assert model.losses[at] == pytest.approx(max(sorted(losses[at])[high], np.log(2) / model.code.shape[1]), rel=1e-9)


def test_bounds_of_long_texts_come_from_the_whole_text(spark):
    """A long text is judged whole, so the training texts beyond the last length are too, not by their first kilobyte."""
    rng = random.Random(7)
    texts = [(lang, speak(rng, lang, 400) + " " + speak(rng, other, rng.randint(0, 300)))
             for _ in range(60) for lang, other in (("xa", "xb"), ("xb", "xe"), ("xe", "xa"))]
    assert min(len(text) for _, text in texts) > langid.LENGTHS[-1]
    model = langid.fit(documents(spark, [(i, text, lang, None) for i, (lang, text) in enumerate(texts)]))
    gaps, losses = [], []
    for lang, text in texts:
        raw = langid._LOWER[np.frombuffer(text.encode(), np.uint8)]
        found = np.sort(model.distances(model.margins(raw), len(raw)))
        if model.languages[int(np.argmin(model.distances(model.margins(raw), len(raw))))] == lang:
            gaps.append(found[1] - found[0])
            losses.append(found[0])
    n = len(losses)
    low, high = (max(int(np.ceil(p * n)), 1) - 1 for p in (langid.OUTSIDE, 1 - langid.OUTSIDE))
    assert model.gaps[-1] == pytest.approx(max(sorted(gaps)[low], 1e-3), rel=1e-9)
    assert model.losses[-1] == pytest.approx(max(sorted(losses)[high], np.log(2) / model.code.shape[1]), rel=1e-9)
    assert len(model.gaps) == len(langid.LENGTHS) + 1
    for lang, text in texts[:9]:
        raw = langid._LOWER[np.frombuffer(text.encode(), np.uint8)]
        margins = model.margins(raw)
        found = np.sort(model.distances(margins, len(raw)))
        assert model.decode(margins, len(raw))[2] == (found[1] - found[0] < model.gaps[-1] or found[0] > model.losses[-1])


def test_a_task_sends_the_slots_it_met():
    texts = ["abc", "abd", "é"]
    rows = [r for b in langid._counts_by_language([pa.record_batch([pa.array(["xa", "xa", "xb"]), pa.array(texts)], ["lang", "text"])])
            for r in b.to_pylist()]
    assert len(rows) <= 12 and all(r["n"] > 0 for r in rows) and sum(r["n"] for r in rows) == 6 + 6 + 3
    assert len({(r["lang"], r["slot"]) for r in rows}) == len(rows)


def test_bounds_see_no_more_than_they_cut(spark):
    rows = ["a" * 5000, "1" * 3000 + "b", "1" * 3000, "\U0001F600" * 1027 + "ж" * 9, "é" * 1028, ""]
    got = [r["t"] for r in documents(spark, [(i, t, "xa", None) for i, t in enumerate(rows)]).orderBy("doc_id").select(
        langid._judged_part("text").alias("t")).collect()]
    assert got == [rows[0][:1028], rows[1], rows[2], rows[3][:1028], rows[4], ""]


def test_undetermined(spark):
    rng = random.Random(0)
    model = langid.fit(documents(spark, [(i, speak(rng, "xa", 9), "xa", None) for i in range(5)] + [(9, speak(rng, "xf", 9), "xf", None)]))
    rows = [(1, None), (2, ""), (3, "12 !? \n"), (None, "а"), (4, LONG), (4, LONG)]
    got = {(r["doc_id"]): r["_lang"] for r in langid.identify(documents(spark, rows), model).collect()}
    assert got == {1: "und", 2: "und", 3: "und", None: "xf", 4: "xa"}
    assert langid.fit(documents(spark, [])) is None
    assert [r["_lang"] for r in langid.identify(documents(spark, [(1, "abc")]), None).collect()] == ["und"]


def test_mixed_and_unlearned_texts_are_flagged(spark):
    rng, names = random.Random(5), ["xa", "xb", "xc", "xd"]
    model = langid.fit(documents(spark, [(i, speak(rng, lang, 60), lang, None) for i in range(150) for lang in names]))
    rows = [(i, speak(rng, lang, 50), None, "clean") for i in range(25) for lang in names]
    for i in range(100):
        a, b = rng.sample(names, 2)
        rows += [(i, speak(rng, a, 25) + " " + speak(rng, b, 25), None, "mixed"), (i, speak(rng, rng.choice(["xf", "xg"]), 50), None, "foreign")]
    got = langid.identify(documents(spark, rows), model).collect()
    share = {kind: np.mean([r["_ambiguous"] for r in got if r["source"] == kind]) for kind in ("clean", "mixed", "foreign")}
    assert share["clean"] <= 0.05 and share["mixed"] >= 0.9 and share["foreign"] == 1, share


def insult(rng, bad):
    words = speak(rng, rng.choice(["xa", "xb"]), rng.randint(5, 60)).split()
    for _ in range(rng.randint(2, 4) if bad else 0):
        words.insert(rng.randrange(len(words) + 1), rng.choice(["zorgul", "Zorguls", "vrexit!"]))
    return " ".join(words)


def test_toxicity(spark):
    rng = random.Random(3)
    rows = [(i, insult(rng, i % 9 == 0)) for i in range(900)]
    labels = [(i, 1, int(i % 9 == 0)) for i in range(600)] + [(3, 1, None), (None, 1, 1), (5000, 1, 1), (4, 1, 0), (9, 1, 1)]
    model = toxicity.fit(documents(spark, rows), table(spark, "doc_id long, quality int, toxic int", labels))
    extra = [(None, None), (None, ""), (7000, LONG), (7001, LONG + " zorgul vrexit zorgul")]
    got = toxicity.score(documents(spark, rows[600:] + extra), model).collect()
    right = sum((r["_toxicity"] >= 0.5) == (r["doc_id"] % 9 == 0) for r in got if r["doc_id"] is not None and r["doc_id"] < 7000)
    assert right >= 0.97 * 300 and all(0 <= r["_toxicity"] <= 1 for r in got)
    again = toxicity.score(documents(spark, rows[600:]), toxicity.fit(
        documents(spark, rows[::-1]), table(spark, "doc_id long, quality int, toxic int", labels[::-1]))).collect()
    assert [r["_toxicity"] for r in again] == pytest.approx([r["_toxicity"] for r in got[:300]])


def test_toxicity_without_both_classes(spark):
    rows = documents(spark, [(1, "a b"), (2, None)])
    for labels, least, most in (([], 0.5, 0.5), ([(1, 1, 0)], 0, 0.01), ([(1, 1, 1)], 0.99, 1)):
        model = toxicity.fit(rows, table(spark, "doc_id long, quality int, toxic int", labels))
        assert all(least <= r["_toxicity"] <= most for r in toxicity.score(rows, model).collect())
    assert toxicity.score(documents(spark, []), model).collect() == []


def test_sample_is_bounded(spark):
    rows = [(i, f"word{i}") for i in range(50)]
    model = toxicity.fit(documents(spark, rows), table(spark, "doc_id long, quality int, toxic int", [(i, 1, i % 2) for i in range(50)]), train_rows=10)
    assert np.isfinite(model.bias)
