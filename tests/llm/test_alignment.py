import hashlib
import itertools
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import sentencepiece
from tokenizers import Tokenizer

from larkspur.llm import alignment, catalog
from tests.llm.frames import LONG, documents

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "plain words, and more!", "two  blanks\n\nand\t tabs \n x ", "  lead", "\n", " ", "\nline\n", "it's 3.14 don't", "<|endoftext|> <s>",
         "naïve café ﬁ ① Å   　x", "日本語のテキスト 😀👍🏽 текст", "a\x00b \x00 c", "a\x1c\x1d b\u0085c   d", "under▁score", "ok ▁ not",
         "x" * 3000, "é ́ combining", "12345 1 000 000", "\r\nwin\r\n dows", "aaaa" * 50 + " b" * 50]


class Brute:
    """Whole texts by both tokenizers, compared byte by byte."""

    def __init__(self):
        self.a = Tokenizer.from_file(PATHS[0])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in printable)}

    def spans(self, text):
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False)
        a_raw = [bytes(self.byte[c] for c in t) for t in a.tokens]
        b_raw = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                 for i, p in ((i, self.b.id_to_piece(i)) for i in self.b.encode(text, num_threads=1))]
        if b"".join(a_raw) != (" " + text).encode() or b"".join(b_raw) != (" " + text).encode():
            return None
        return list(zip(a.ids, np.cumsum([len(x) for x in a_raw]))), list(zip(self.b.encode(text, num_threads=1), np.cumsum([len(x) for x in b_raw])))

    def rows(self, docs):
        """docs of (id, text) to the operator's rows."""
        spans = [self.spans(t) for _, t in docs]
        count, links = Counter(), []
        for both in spans:
            now = []
            if both:
                a, b = both
                i = j = 0
                while i < len(a) and j < len(b):
                    now.append((a[i][0], b[j][0]))
                    end_a, end_b = a[i][1], b[j][1]
                    i, j = i + (end_a <= end_b), j + (end_b <= end_a)
            links.append(now)
            count.update(set(now))
        best = Counter()
        for (a, _), n in count.items():
            best[a] = max(best[a], n)
        for (doc, _), both, now in zip(docs, spans, links):
            if not both:
                yield doc, 0, 0, 0, 0, 0, 0, ""
                continue
            ends = sorted({int(e) for _, e in both[0]} & {int(e) for _, e in both[1]})
            groups, left = [], [list(side) for side in both]
            for high in ends:
                taken = [[i for i, e in itertools.takewhile(lambda x: x[1] <= high, side)] for side in left]
                for side, t in zip(left, taken):
                    del side[:len(t)]
                groups.append("|".join(",".join(map(str, t)) for t in taken))
            yield (doc, len(both[0]), len(both[1]), len(groups), len(now), sum(count[p] == best[p[0]] for p in now), sum(count[p] for p in now),
                   hashlib.sha256(";".join(groups).encode()).hexdigest())


@pytest.fixture(scope="module")
def brute():
    return Brute()


def check(spark, brute, rows):
    got = alignment.align(documents(spark, rows), *PATHS).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, brute.rows(rows)))


def test_against_whole_texts(spark, brute):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, f"before {t} after\n{t}") for i, t in enumerate(TEXTS)]
    rows += [(None, "same text"), (None, "same text"), (7, "same text"), (8, None), (9, LONG[:100_000])]
    check(spark, brute, rows)
    assert alignment.align(documents(spark, []), *PATHS).collect() == []


def test_many_tables_and_small_caches(spark, brute, monkeypatch):
    """Several buckets a table and several tables, flushed counts: the sums of the parts are the whole."""
    for name, value in {"BUCKET": 40, "BUCKETS_AT_ONCE": 2, "FAN_IN": 2, "CHUNK": 3, "_CACHED": 20, "_KEPT_PAIRS": 30}.items():
        monkeypatch.setattr(alignment, name, value)
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "same text"), (3, "same text"), (None, "same text")]
    check(spark, brute, rows)


@pytest.mark.parametrize("count", [0, 1, 2, 100, 20_000])
def test_hash_is_minimal_and_perfect(count):
    rng = np.random.default_rng(count)
    keys = np.unique(rng.integers(0, 1 << 40, count))
    made = alignment.PairHash.build(keys)
    made = alignment.PairHash.unpack(*made.pack())
    assert sorted(made.find(keys).tolist()) == list(range(len(keys)))
    other = np.setdiff1d(rng.integers(0, 1 << 40, 1000), keys)
    assert (made.find(other) == -1).all()
    assert sum(w.nbytes for w in made.words) * 8 <= 4 * len(keys) + 64 * 20


def test_op12(spark, brute, folder):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = catalog.op12_token_alignment(spark, folder).collect()
    assert sorted(map(tuple, got)) == sorted(brute.rows(docs))
    assert list(got[0].asDict()) == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_second_pass_reads_what_the_first_wrote(monkeypatch):
    """Each stretch is aligned once, and slices may fall into any batches."""
    texts = ["one two one", None, "", "two three\n", "one two one"]
    aligner, met = alignment.Aligner(*PATHS), []
    align = aligner.align
    monkeypatch.setattr(aligner, "align", lambda stretches, with_text: met.extend(stretches) or align(stretches, with_text))
    monkeypatch.setattr(alignment, "_aligner", lambda *_: aligner)
    batches = [pa.record_batch([pa.array([i]), pa.array([t], pa.string()), pa.array([i])], ["id", "text", "key"]) for i, t in enumerate(texts)]
    wrote = pa.Table.from_batches(list(alignment._first_pass(*PATHS)(iter(batches))))
    assert len(met) == len(set(met))
    pairs = {r["pair"]: r["n"] for r in wrote.to_pylist() if r["pair"] is not None}
    made = alignment.PairHash.build(np.array(sorted(pairs)))
    table = alignment.Table(1, {0: made}, {0: np.array([pairs[k] for k in made.keys.tolist()])})
    best = np.zeros(1 + max(p >> 32 for p in pairs), np.int64)
    for p, n in pairs.items():
        best[p >> 32] = max(best[p >> 32], n)
    rest = wrote.filter(pc.is_null(wrote["pair"]))
    second = alignment._second_pass(SimpleNamespace(value=table), SimpleNamespace(value=best))
    for size in (1, 2, 100):
        got = [r for b in second(iter(rest.combine_chunks().to_batches(size))) for r in b.to_pylist()]
        assert [r["id"] for r in got] == [0, 1, 2, 3, 4]
        assert [r["count_sum"] for r in got[1:3]] == [0, 0] and got[0]["count_sum"] > 0
        assert [{**r, "id": 0, "key": 0} for r in got if r["id"] in (0, 4)][0] == {**got[4], "id": 0, "key": 0}
        # the pairs of "one" are in two documents, those of "two" in three
        assert got[0]["count_sum"] >= 2 * got[0]["n_links"] and got[0]["n_links"] >= got[0]["n_best"] > 0
