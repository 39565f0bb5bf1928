"""Trees grown from histograms against a plain recursive search of every cut."""

import pickle
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.catalog import models
from larkspur.models import grower, trees


def table(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(i, float(rng.randrange(9)), float(rng.randrange(4)) if rng.random() < 0.9 else None, float(rng.randrange(30)),
             float(rng.randrange(-50, 50)), rng.randrange(3)) for i in range(n)]
    return spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, k int")


FEATURES = ["a", "b", "c"]


def plain(x, y, times, depth, least=1.0):
    """{heap node: (rows, mean)} of the best tree, the first feature and least cut first."""
    out = {}

    def visit(node, here):
        n, g = times[here].sum(), (times[here] * y[here]).sum()
        out[node] = (n, g / n)
        best = None
        if node.bit_length() <= depth:
            for f in range(x.shape[1]):
                for cut in np.unique(x[here, f])[:-1]:
                    left = here[x[here, f] <= cut]
                    right = here[x[here, f] > cut]
                    nl, nr = times[left].sum(), times[right].sum()
                    if nl < least or nr < least:
                        continue
                    gl, gr = (times[left] * y[left]).sum(), (times[right] * y[right]).sum()
                    score = gl * gl / nl + gr * gr / nr
                    if score > (best[0] if best else g * g / n + 1e-12 * abs(g * g / n)):
                        best = score, left, right
        if best:
            visit(2 * node, best[1])
            visit(2 * node + 1, best[2])

    visit(1, np.flatnonzero(times > 0))
    return out


@pytest.mark.parametrize("local", [10_000, 200, 1])
def test_trees_are_those_of_a_plain_search(spark, local):
    """However many levels are split from summed cells; unknown values are in the last bin, bootstraps go by hash."""
    df = table(spark).repartition(3)
    fit = grower.fit_forest(df, FEATURES, "y", grower.Rule(6), 3, key="row_id", local=local)
    rows = df.select("*", grower.row_hash(F.col("row_id")).alias("h")).collect()
    x = np.array([[3.0 if r[f] is None else r[f] for f in FEATURES] for r in rows])
    y, hashes = np.array([r["y"] for r in rows]), np.array([r["h"] for r in rows])
    for tree, t in enumerate(grower.unpacked(r) for r in fit.trees.orderBy("tree").collect()):
        want = plain(x, y, grower.bootstrap(hashes, tree), 6)
        got = {int(h): (n, v[0]) for h, n, v in zip(t.heap, t.rows, t.value)}
        assert got.keys() == want.keys()
        for node in want:
            assert got[node] == pytest.approx(want[node])


def test_predictions_walk_the_trees(spark, monkeypatch):
    """One batch a tree gives the same sums as one batch for all."""
    df = table(spark)
    fit = grower.fit_forest(df, FEATURES, "y", grower.Rule(5), 4, key="row_id")
    once = {r["row_id"]: r["prediction"] for r in fit.transform(df).collect()}
    monkeypatch.setattr(grower, "BATCH_BYTES", 1)
    again = grower.TreeModel(fit.features, fit.cuts, fit.trees)
    assert len(again.batches()) == 4
    for r in again.transform(df).collect():
        assert r["prediction"] == pytest.approx(once[r["row_id"]])
    assert sum(fit.featureImportances) == pytest.approx(1)


def test_classes_vote_by_shares(spark):
    df = table(spark)
    fit = grower.fit_forest(df, FEATURES, "k", grower.Rule(20, subset=2), 5, 3, "row_id")
    rows = fit.transform(df).collect()
    for r in rows:
        assert sum(r["probability"]) == pytest.approx(1) and r["prediction"] == int(np.argmax(r["probability"]))
    assert sum(r["prediction"] == r["k"] for r in rows) > 0.6 * len(rows)


def test_boosting_lowers_the_loss_and_survives_checkpoints(spark, monkeypatch):
    df = table(spark)
    monkeypatch.setattr(grower, "KEEP_EVERY", 3)
    kept = grower.fit_boosting(df, FEATURES, "y", grower.Rule(3, 1.0, 1.0), 8, 0.3)
    monkeypatch.setattr(grower, "KEEP_EVERY", 100)
    whole = grower.fit_boosting(df, FEATURES, "y", grower.Rule(3, 1.0, 1.0), 8, 0.3)
    a, b = ({r["row_id"]: r["prediction"] for r in f.transform(df).collect()} for f in (kept, whole))
    assert a == pytest.approx(b)
    losses = [fit.transform(df).agg(F.avg((F.col("y") - F.col("prediction")) ** 2)).first()[0] for fit in
              (whole, grower.fit_boosting(df, FEATURES, "y", grower.Rule(3, 1.0, 1.0), 1, 0.3))]
    assert losses[0] < losses[1] < df.agg(F.var_pop("y")).first()[0]


def test_awkward_tables(spark):
    same = spark.createDataFrame([(i, 1.0, None, 2.0, 5.0, 0) for i in range(10)] + [(99, 1.0, None, 2.0, None, None)],
                                 "row_id long, a double, b double, c double, y double, k int")
    fit = grower.fit_forest(same, FEATURES, "y", grower.Rule(5), 2, key="row_id")
    assert {r["prediction"] for r in fit.transform(same).collect()} == {5.0}
    boosted = grower.fit_boosting(same, FEATURES, "y", grower.Rule(2, 1.0, 1.0), 2, 0.1)
    assert {r["prediction"] for r in boosted.transform(same).collect()} == {5.0}


def test_one_partition_is_spread(spark):
    """Rows that come in one partition are binned into chunks that every core has a share of."""
    df = table(spark).coalesce(1)
    made = grower.chunks(df, FEATURES, "y", grower.fit_bins(df, FEATURES), "row_id")
    assert made.rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism
    assert made.agg(F.sum("n")).first()[0] == 600


def test_large_nodes_that_cannot_be_split_end_without_their_rows(spark, monkeypatch):
    """Rows alike in every feature, and rows at the last depth, are leaves made of sums; no task gets more than ``local`` of them."""
    rows = [(i, float(i % 2), 0.0, 0.0, float(i % 2 * 7 + i % 3), 0) for i in range(900)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, k int")

    def never(*args):
        raise AssertionError("rows were brought together")

    monkeypatch.setattr(grower, "grow", never)
    for depth in (1, 5):
        fit = grower.fit_forest(df, FEATURES, "y", grower.Rule(depth), 2, local=10, bootstrapped=False)
        assert {(r["row_id"] % 2, round(r["prediction"], 6)) for r in fit.transform(df).collect()} == {(0, 1.0), (1, 8.0)}


def test_batches_of_trees_are_passes_of_their_own(spark, monkeypatch):
    """No plan names more than one batch of trees, so that a worker holds one."""
    df = table(spark)
    monkeypatch.setattr(grower, "BATCH_BYTES", 1)
    fit = grower.fit_forest(df, FEATURES, "y", grower.Rule(3), 3, key="row_id")
    plan = fit.transform(df)._jdf.queryExecution().optimizedPlan().toString()
    assert len(fit.batches()) == 3 and plan.count("total(") == 1


def test_boosting_sends_splits_to_the_driver_not_cells(spark, monkeypatch):
    sent = []
    collect = type(spark.sparkContext.emptyRDD()).collect
    rdd = type(table(spark).rdd.map(len))
    monkeypatch.setattr(rdd, "collect", lambda self: sent.append(len(pickle.dumps(out := collect(self)))) or out)
    monkeypatch.setattr(rdd, "reduce", lambda *a: pytest.fail("cells reach the driver"))
    monkeypatch.setattr(rdd, "treeReduce", lambda *a: pytest.fail("cells reach the driver"))
    df = table(spark).repartition(6)
    one = grower.fit_boosting(df, FEATURES, "y", grower.Rule(4, 1.0, 1.0), 2, 0.3)
    monkeypatch.setattr(grower, "CHUNK_ROWS", 64)
    many = grower.fit_boosting(df, FEATURES, "y", grower.Rule(4, 1.0, 1.0), 2, 0.3)
    assert max(sent) < 8_000
    a, b = ({r["row_id"]: r["prediction"] for r in f.transform(df).select("row_id", "prediction").toLocalIterator()} for f in (one, many))
    assert a == pytest.approx(b)


def test_rows_of_the_same_bins_are_boosted_as_one(spark, monkeypatch):
    """However many rows there are, boosting goes on over their combinations of bins, in one task."""
    rows = [(i, float(i % 3), float(i % 2), 0.0, float(i % 7), i % 2, 1.0 + i % 4) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double, k int, w double").repartition(5)
    cuts = grower.fit_bins(df, FEATURES)
    made = grower.chunks(df, FEATURES, "y", cuts, None, "w")
    for most in (grower.BOOST_ROWS, 0):
        monkeypatch.setattr(grower, "BOOST_ROWS", most)
        found, left = grower.merged_chunks(made, 3, 3000)
        parts = [grower._opened(r.asDict(), 3) for r in found.collect()]
        x, times, target, weight = (np.concatenate(v) for v in zip(*parts))
        assert left == len(x) and left <= 6 * 16 and (most or left == len({tuple(r) for r in x.tolist()}) == 6)
        assert times.sum() == 3000 and weight.sum() == sum(r[-1] for r in rows)
        assert weight @ target == pytest.approx(sum(r[-1] * r[-3] for r in rows))


@pytest.mark.parametrize("classes", [0, 2])
def test_boosting_in_one_task_finds_the_trees_of_jobs_by_level(spark, monkeypatch, classes):
    df = table(spark)
    label = "k2" if classes else "y"
    df = df.selectExpr("*", "cast(y > 3 as int) as k2")
    one = grower.fit_boosting(df, FEATURES, label, grower.Rule(4, 1.0, 1.0), 3, 0.3, classes)
    monkeypatch.setattr(grower, "BOOST_ROWS", 0)
    many = grower.fit_boosting(df, FEATURES, label, grower.Rule(4, 1.0, 1.0), 3, 0.3, classes)
    a, b = ({r["row_id"]: r["_raw"][0] for r in f.with_raw(df).select("row_id", "_raw").collect()} for f in (one, many))
    assert a == pytest.approx(b) and one.trees.count() == many.trees.count() == 3


def test_nodes_written_seldom_or_often_give_the_same_forest(spark, monkeypatch):
    df = table(spark)
    seldom = grower.fit_forest(df, FEATURES, "k", grower.Rule(9, subset=2), 3, key="row_id", local=20)
    monkeypatch.setattr(grower, "LEVELS_KEPT", 1)
    often = grower.fit_forest(df, FEATURES, "k", grower.Rule(9, subset=2), 3, key="row_id", local=20)
    a, b = (sorted(map(str, grower.node_report(f).drop("value").collect())) for f in (seldom, often))
    assert a == b and len(a) > 30


def test_deep_trees_are_grown_without_sums_of_every_node(spark):
    """MLlib's tasks would each send the cells of every node of a level."""
    df = table(spark)
    fit = trees.fit_tree_classifier(df, FEATURES, "k", depth=20)
    assert isinstance(fit, grower.TreeModel) and fit.trees.count() == 1
    assert sorted(trees.importances(fit)) == sorted(FEATURES) and sum(trees.importances(fit).values()) == pytest.approx(1)
    rows = fit.transform(df).select("k", "prediction").collect()
    assert sum(r["k"] == r["prediction"] for r in rows) > 0.7 * len(rows)
    assert not isinstance(trees.fit_tree_regressor(df, ["a", "c"], "y", depth=3), grower.TreeModel)


def test_bins_from_exact_counts(spark):
    rows = [(float(i % 128), float(i % 129), None if i % 2 else float("nan"), float(i % 3)) for i in range(2000)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(6)
    a, b, c, d = grower.fit_bins(df, ["a", "b", "c", "d"])
    assert len(a) == len(np.unique(np.quantile(np.arange(128.0), [j / 64 for j in range(1, 64)], method="inverted_cdf")))
    assert 50 < len(b) <= 63 and len(c) == 0 and d.tolist() == [0.5, 1.5]


def test_chunks_hold_hashes_and_weights_only_where_there_are_any(spark):
    df = table(spark).withColumn("w", F.lit(2.0))
    cuts = grower.fit_bins(df, FEATURES)
    bare = grower.chunks(df, FEATURES, "y", cuts).first()
    full = grower.chunks(df, FEATURES, "y", cuts, "row_id", "w").first()
    assert bare["hashes"] == bare["weight"] == b"" and len(full["hashes"]) == len(full["weight"]) == 8 * full["n"]
    assert grower._chunk(bare, 3)[3].tolist() == [1.0] * bare["n"] and grower._chunk(full, 3)[3].tolist() == [2.0] * full["n"]


def test_parts_of_a_table_are_written_once_and_by_columns(spark, monkeypatch):
    made = []
    monkeypatch.setattr(models, "spread", lambda df: made.append(df) or df)
    train, test = models.parts(table(spark), "row_id", ["a", "c"], "k", scaled=False, stratify=True)
    assert len(made) == 1 and made[0].inputFiles() and all(f.endswith(".parquet") for f in made[0].inputFiles())
    assert train.count() + test.count() == 600 and test.count() >= 120
