"""Language identification by error-correcting output codes.

Every language has a codeword; each bit has a binary classifier over hashed
byte n-grams that separates the languages with a 1 there from those with a 0.
A text's classifier outputs are decoded to the codeword of least loss, so some
bits may be wrong. The classifiers are multinomial models of both sides, made
from n-gram counts of each language over all training rows. All training texts, cut
to several lengths and, if longer than these, whole, say how near the runner-up and how far the best codeword may
be: mixed texts and texts in no learned language are flagged by that.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.llm.words import text_buffer
from larkspur.session import cut_lineage

SLOTS_LOG2 = 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 512
SMOOTHING = 0.5
#: Largest share of the training texts decoded right that each of the two bounds leaves outside, and lengths at which they are set;
#: longer texts have bounds of their own, set by the whole texts.
OUTSIDE = 0.005
LENGTHS = (1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024)
UNDETERMINED = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


def _slots(raw: np.ndarray, order: int) -> np.ndarray:
    """Slot of the n-gram of ``order`` bytes that starts at each byte."""
    count = len(raw) - order + 1
    value = np.full(count, order, np.uint32)
    for step in range(order):
        value = value * np.uint32(257) + raw[step:step + count]
    return ((value * np.uint32(2654435761)) >> np.uint32(32 - SLOTS_LOG2)).astype(np.int64)


def _counts_by_language(batches):
    """Scan: (lang, text) to n-gram counts, one row per language and slot that the task has met."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        buffer, offsets = text_buffer(batch.column(1))
        for i, lang in enumerate(langs):
            raw = _LOWER[buffer[offsets[i]:offsets[i + 1]]]
            into = total.setdefault(lang, np.zeros(1 << SLOTS_LOG2, np.int64))
            for low in range(0, max(len(raw), 1), 1 << 20):
                part = raw[low:low + (1 << 20) + max(ORDERS) - 1]
                for order in ORDERS:
                    if len(part) >= order:
                        found = _slots(part, order)
                        into += np.bincount(found[:1 << 20], minlength=1 << SLOTS_LOG2)
    for lang, counts in total.items():
        met = np.flatnonzero(counts)
        for low in range(0, len(met), 1 << 13):
            slots = met[low:low + (1 << 13)]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(slots)), pa.array(slots, pa.int32()), pa.array(counts[slots])], names=["lang", "slot", "n"])


def codewords(languages: int, seed: int = 11) -> np.ndarray:
    """One row of bits per language.

    Up to five languages all distinct splits are used. Beyond that, seeded
    balanced splits: the code with the largest least distance of 200 drawn.
    """
    if languages < 2:
        return np.ones((languages, 1), bool)
    if languages <= 5:
        columns = [c for c in product((0, 1), repeat=languages) if c[0] == 1 and not all(c)]
        return np.array(columns, bool).T
    rng = np.random.default_rng(seed)
    bits = int(np.ceil(10 * np.log2(languages)))
    best, least = None, -1
    half = np.arange(languages) % 2 == 0
    for _ in range(200):
        code = np.stack([rng.permutation(half) for _ in range(bits)], 1)
        distance = (code[:, None, :] != code[None, :, :]).sum(2) + bits * np.eye(languages, dtype=int)
        if distance.min() > least:
            best, least = code, distance.min()
    return best


class Model:
    """Codewords, weights (slot x bit) and decoding."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.code = codewords(len(languages))
        share = (counts + SMOOTHING) / (counts + SMOOTHING).sum(1, keepdims=True)
        weights = []
        for bit in range(self.code.shape[1]):
            on, off = share[self.code[:, bit]], share[~self.code[:, bit]]
            weights.append(np.log(on.mean(0)) - np.log(off.mean(0)) if len(off) and len(on) else np.zeros(share.shape[1]))
        self.weights = np.stack(weights, 1).astype(np.float32)
        #: least gap to the runner-up and largest loss of the best, for texts of each of LENGTHS bytes or more, and for longer ones
        self.gaps = np.full(len(LENGTHS) + 1, 1e-3)
        self.losses = np.full(len(LENGTHS) + 1, np.inf)

    def margins(self, raw: np.ndarray) -> np.ndarray:
        """Mean weight of the text's n-grams per bit."""
        total, n = np.zeros(self.weights.shape[1]), 0
        for low in range(0, len(raw), 1 << 16):
            part = raw[low:low + (1 << 16) + max(ORDERS) - 1]
            for order in ORDERS:
                if len(part) >= order:
                    found = _slots(part, order)[:1 << 16]
                    total += self.weights[found].sum(0, dtype=np.float64)
                    n += len(found)
        return total / max(n, 1)

    def distances(self, margins: np.ndarray, n: int) -> np.ndarray:
        """Loss of each language's codeword.

        A bit's loss is logistic in its margin, which counts at most the
        evidence of 100 bytes so that a long text keeps a graded score.
        """
        evidence = margins * min(n, 100)
        return np.where(self.code, np.logaddexp(0, -evidence), np.logaddexp(0, evidence)).sum(1) / self.code.shape[1]

    def decode(self, margins: np.ndarray, n: int) -> tuple[str, float, bool]:
        """Language of least loss-weighted distance, its score, and whether it cannot be told.

        It cannot if the runner-up is too near or the best codeword too far,
        by the bounds for texts of ``n`` bytes.
        """
        losses = self.distances(margins, n)
        best = int(np.argmin(losses))
        share = np.exp(losses.min() - losses)
        score = float(share[best] / share.sum())
        second = np.sort(losses)[1] if len(losses) > 1 else np.inf
        at = max(int(np.searchsorted(LENGTHS, n, "right")) - 1, 0) + (n > LENGTHS[-1])
        return self.languages[best], score, bool(second - losses[best] < self.gaps[at] or losses[best] > self.losses[at])


def _has_letter(raw: np.ndarray) -> bool:
    """Whether a text of these bytes holds a letter of any script."""
    return bool(_ASCII_LETTER[raw[:256]].any()) or any(map(str.isalpha, raw.tobytes().decode("utf-8", "replace")))


def _cut(raw: np.ndarray, length: int) -> np.ndarray:
    """The first ``length`` bytes, without a broken character at the end."""
    end = length
    while 0 < end < len(raw) and raw[end] & 0xC0 == 0x80:
        end -= 1
    return raw[:end]


def _judged_part(text: str) -> Column:
    """What ``_judged`` cuts to LENGTHS: the characters it cuts from, and the whole text only where no letter is among them."""
    head = F.substring(text, 1, LENGTHS[-1] + 4)
    return F.when(head.rlike("\\p{L}"), head).otherwise(F.col(text))


def _judged(model: Model, lang: str, text: str, whole: np.ndarray) -> tuple[list, list]:
    """Gap to the runner-up and loss of the best codeword at each of LENGTHS, and of the ``whole`` text where it has more bytes.

    None where the text is shorter or decoded wrong.
    """
    gaps, losses = [None] * (len(LENGTHS) + 1), [None] * (len(LENGTHS) + 1)
    # a character has a byte at least
    raw = _LOWER[np.frombuffer(text[:LENGTHS[-1] + 4].encode("utf-8", "replace"), np.uint8)]
    ends = np.array([len(_cut(raw, length)) for length in LENGTHS if length <= len(raw)])
    if not len(ends) or not any(map(str.isalpha, text)):
        return gaps, losses
    total, n = np.zeros((len(ends), model.code.shape[1])), np.zeros(len(ends))
    for order in ORDERS:
        upto = (ends - order + 1).clip(0)
        if upto[-1]:
            sums = np.cumsum(model.weights[_slots(raw, order)[:upto[-1]]], 0, dtype=np.float64)
            total += np.where(upto[:, None] > 0, sums[upto - 1], 0.0)
            n += upto
    judged = list(zip(total / n.clip(1)[:, None], LENGTHS))
    if len(whole) > LENGTHS[-1]:
        judged.append((model.margins(_LOWER[whole]), len(whole)))
    for at, (margins, length) in enumerate(judged):
        found = model.distances(margins, length)
        if model.languages[int(np.argmin(found))] == lang:
            near = np.sort(found)
            losses[at] = float(near[0])
            gaps[at] = float(near[1] - near[0]) if len(near) > 1 else None
    return gaps, losses


def _set_bounds(model: Model, known: DataFrame) -> None:
    """Bounds of the model from all distinct training texts, each cut to every length it has, and longer ones as a whole.

    The order statistics are exact: counts of narrow bins of values say which
    bin holds the wanted one, and the values of that bin are ranked.
    """
    shared = known.sparkSession.sparkContext.broadcast(model)

    def judge(batches):
        own = shared.value
        for batch in batches:
            # whole texts stay in their Arrow buffer
            buffer, offsets = text_buffer(batch.column(3))
            both = [_judged(own, lang, text, buffer[low:high]) for lang, text, low, high in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(2), *[pa.array([b[i] for b in both], pa.list_(pa.float64())) for i in (0, 1)]],
                names=["lang", "h", "gaps", "losses"])

    each = known.select("lang", _judged_part("text").alias("text"), F.xxhash64("text").alias("h"),
                        F.when(F.octet_length("text") > LENGTHS[-1], F.col("text")).alias("whole")).mapInArrow(
        judge, "lang string, h long, gaps array<double>, losses array<double>").dropDuplicates(["lang", "h"])
    kinds = F.array(F.struct(F.lit(0).alias("kind"), F.lit(OUTSIDE).alias("p"), F.col("gaps").alias("v")),
                    F.struct(F.lit(1).alias("kind"), F.lit(1 - OUTSIDE).alias("p"), F.col("losses").alias("v")))
    # steps of 1 / 4096 of an octave
    tall = each.select(F.inline(kinds)).select("kind", "p", F.posexplode("v").alias("at", "x")).where("x is not null") \
        .groupBy("kind", "p", "at", "x").agg(F.count("*").alias("n")).withColumn("bin", F.floor(F.log2(F.col("x") + 2.0 ** -30) * 4096))
    tall = cut_lineage(tall)
    group = Window.partitionBy("kind", "at")
    wanted = F.greatest(F.ceil(F.col("p") * F.sum("n").over(group)), F.lit(1))
    bins = tall.groupBy("kind", "p", "at", "bin").agg(F.sum("n").alias("n")).select(
        "kind", "at", "bin", "n", F.sum("n").over(group.orderBy("bin")).alias("upto"), wanted.alias("k"))
    edge = bins.where("upto >= k and upto - n < k").select("kind", "at", "bin", (F.col("k") - F.col("upto") + F.col("n")).alias("need"))
    ranks = tall.join(F.broadcast(edge), ["kind", "at", "bin"]).withColumn("upto", F.sum("n").over(group.orderBy("x")))
    found = {(r["kind"], r["at"]): r["x"] for r in ranks.where("upto >= need and upto - n < need").select("kind", "at", "x").collect()}
    # one undecided bit is borne at any length
    one = np.log(2) / model.code.shape[1]
    for at in range(len(model.losses)):
        if (1, at) in found:
            model.gaps[at] = max(found.get((0, at), 0.0), 1e-3)
            model.losses[at] = max(found[1, at], one)
    for at in range(1, len(model.losses)):
        if np.isinf(model.losses[at]):
            model.gaps[at], model.losses[at] = model.gaps[at - 1], model.losses[at - 1]


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model | None:
    """Classifiers from all rows with a language and a text; None without any.

    What reaches the driver is one row of ``2 ** SLOTS_LOG2`` counts a language, for
    at most ``MAX_LANGUAGES``; more raise ValueError.
    """
    known = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .where("lang is not null and text is not null")
    sums = known.mapInArrow(_counts_by_language, "lang string, slot int, n long").groupBy("lang", "slot").agg(
        F.sum("n").alias("n"))
    sizes = dict(known.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect())
    names = list(sizes)
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not names:
        return None
    names.sort()
    place = {name: i for i, name in enumerate(names)}
    found = sums.where("n > 0").toArrow()
    counts = np.zeros((len(names), 1 << SLOTS_LOG2))
    row = np.array([place[x] for x in found["lang"].to_pylist()], np.int64)
    counts[row, found["slot"].to_numpy()] = found["n"].to_numpy()
    model = Model(names, counts)
    _set_bounds(model, known)
    return model


def identify(documents: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``documents`` with _lang, _score and _ambiguous (the runner-up is near, or the text is unlike the training texts).

    A text that is null or has no letter, and any text without a model, is
    ``und`` with score 0 and not ambiguous. Other columns are kept; one that has an added name is replaced.
    """
    documents = documents.drop("_lang", "_score", "_ambiguous", "_judged")
    shared = documents.sparkSession.sparkContext.broadcast(model)
    schema = "_lang string, _score double, _ambiguous boolean"

    # texts stay in their Arrow buffer, so a worker holds one of them beside it
    @F.arrow_udf(schema)
    def judge(texts: pa.Array) -> pa.Array:
        known, rows = shared.value, []
        buffer, offsets = text_buffer(texts)
        for low, high in zip(offsets, offsets[1:]):
            raw = buffer[low:high]
            if known is None or not _has_letter(raw):
                rows.append((UNDETERMINED, 0.0, False))
            else:
                rows.append(known.decode(known.margins(_LOWER[raw]), len(raw)))
        lang, score, ambiguous = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
                                          names=["_lang", "_score", "_ambiguous"])

    # not to be repeated where a filter looks at a part of the result
    once = judge.asNondeterministic()
    return documents.select("*", once(F.col(text_col).cast("string")).alias("_judged")) \
        .select(*[F.col(f"`{c}`") for c in documents.columns], "_judged.*")


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold
