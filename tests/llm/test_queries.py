"""The registered queries and the pipeline over the given tables, against brute force."""

import hashlib
import os
import re
from collections import Counter
from html import unescape

import numpy as np
import pytest

import corpus_pipeline
from larkspur.llm import catalog, mixing, simhash
from tests.llm.test_decontaminate import expected as contaminated
from tests.llm.test_secrets import base
from tests.llm.test_simhash import brute

LARGER = os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.01")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{LARGER}/documents.parquet").orderBy("doc_id").collect()


def test_names():
    assert [n.split("_")[0] for n in catalog.QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_op3(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = catalog.op3_main_text(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        blocks = [" ".join(unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:p|h1)>", article)]
        assert r["text"] == "\n".join(filter(None, blocks)) and r["n_chars"] == len(r["text"])


def test_op5(spark, docs):
    got = {r["doc_id"]: r for r in catalog.op5_secret_scan(spark, LARGER).collect()}
    assert len(got) == len(docs) and any(r["n_assign"] for r in got.values())
    for d in docs:
        want, row = base(d["text"]), got[d["doc_id"]]
        text = ",".join(f"{k}:{s}:{e}" for s, e, k in want)
        kinds = Counter(k for _, _, k in want)
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert row["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(row["spans"].split(","))


def test_op6(spark, docs):
    lang = {d["doc_id"]: d["lang"] for d in docs}
    got = catalog.op6_language_id(spark, LARGER).collect()
    out = [r for r in got if r["held_out"]]
    assert len(got) == len(docs) and len(out) > 200
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in out) >= 0.98 * len(out)


def test_op7(spark):
    folder = LARGER
    toxic = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = catalog.op7_toxicity(spark, folder).collect()
    out = [(r["predicted"], toxic[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in toxic]
    assert sum(a == b for a, b in out) >= 0.9 * len(out)


def test_op9(spark, docs):
    got = {r["doc_id"]: r["licences"] for r in catalog.op9_licence_scan(spark, LARGER).collect()}
    named = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "All rights reserved.": "All-Rights-Reserved"}
    for d in docs:
        assert set(filter(None, got[d["doc_id"]].split(","))) == {v for k, v in named.items() if k in d["text"]}


def test_op10(spark, docs):
    prints = [simhash.fingerprint((d["text"] or "").encode()) & (2 ** 64 - 1) for d in docs]
    root = brute_fast(prints)
    want = {(d["doc_id"], f"{p:016x}", docs[r]["doc_id"]) for d, p, r in zip(docs, prints, root)}
    got = catalog.op10_simhash(spark, LARGER).select("doc_id", "fingerprint", "component_id").collect()
    assert set(map(tuple, got)) == want and len(got) == len(docs)


def brute_fast(prints):
    """brute(), comparing one row with all at a time."""
    v, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[:i]) <= 4):
            a, b = sorted((find(i), find(int(j))))
            root[b] = a
    return [find(i) for i in range(len(v))]


def test_pipeline_stages(spark, folder, tmp_path):
    """Each stage against brute force on its own input."""
    now = spark.read.parquet(f"{folder}/documents.parquet")
    extra = [(100_000, "12 34 !?", None, "src1", 8), (100_001, None, None, None, None), (None, "palabras sin número", None, "src2", 19)]
    now = now.unionByName(spark.createDataFrame(extra, now.schema))
    columns, before, results = now.columns, now.collect(), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, now, folder).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        results[name] = (before, now.collect())
        before = results[name][1]
        assert name == "mixing sources" or now.columns == columns

    had, got = results["language ID"]
    assert {r["doc_id"] for r in had} - {r["doc_id"] for r in got} == {100_000, 100_001}

    had, got = results["SimHash near-dedup"]
    had = sorted(had, key=lambda r: (r["doc_id"] is None, r["doc_id"]))
    roots = brute([simhash.fingerprint(r["text"].encode()) & (2 ** 64 - 1) for r in had])
    assert sorted(map(repr, got)) == sorted(repr(had[i]) for i in set(roots))

    had, got = results["benchmark decontamination"]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    dirty = {d for d, _, n, _ in contaminated([(r["doc_id"], r["text"]) for r in had], items) if n}
    assert dirty and sorted(map(repr, got)) == sorted(repr(r) for r in had if r["doc_id"] not in dirty)

    had, got = results["secret scans"]
    text = {r["doc_id"]: r for r in got}
    assert len(got) == len(had)
    for r in had:
        if base(r["text"]):
            assert not base(text[r["doc_id"]]["text"]) and text[r["doc_id"]]["n_chars"] == len(text[r["doc_id"]]["text"])
        else:
            assert text[r["doc_id"]] == r

    had, got = results["mixing sources"]
    want = mixing.mix(spark.createDataFrame(had, ", ".join(f"{c} {t}" for c, t in spark.read.parquet(f"{folder}/documents.parquet").dtypes)))
    assert sorted(map(repr, got)) == sorted(repr(r) for r in want.where("copies > 0").withColumnRenamed("id", "doc_id").collect())


def test_pipeline_runs(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r["taken"] == r["size"] * r["copies"] and r["copies"] > 0 for r in rows)
