import numpy as np
import pytest
from pyspark.sql import functions as F

from larkspur.models import grid, linear, trees
from larkspur.models.bayes import GaussianBayes
from larkspur.models.discriminant import Discriminant
from larkspur.models.perceptron import Perceptron

C = F.col

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 3)) @ np.array([[1, 0.4, 0], [0, 1, 0.3], [0, 0, 1]])
    y = 3 + x @ [2.0, -1.0, 0.0] + rng.normal(scale=0.3, size=600)
    cls = (x @ [1.0, 1.0, -0.5] + rng.normal(scale=0.7, size=600) > 0).astype(int)
    frame = spark.createDataFrame(
        [(i, *map(float, r), float(t), int(k)) for i, (r, t, k) in enumerate(zip(x, y, cls))],
        "id bigint, a double, b double, c double, y double, k int").cache()
    return frame, x, y, cls


def test_ols_equals_the_normal_equations(data):
    df, x, y, _ = data
    fit = linear.fit_ols(df, X, "y")
    design = np.column_stack([x, np.ones(len(x))])
    exact = np.linalg.lstsq(design, y, rcond=None)[0]
    assert [*fit.coefficients().values(), fit.model.intercept] == pytest.approx(exact, abs=1e-8)
    assert linear.p_values(fit)["a"] < 1e-6 < linear.p_values(fit)["c"]


def test_aliased_and_constant_columns_are_left_out(data):
    df = data[0].withColumns({"twice": F.col("a") + F.col("b"), "one": F.lit(1.0)})
    assert linear.independent_columns(df, ["one", "a", "b", "twice", "c"]) == ["a", "b", "c"]


@pytest.mark.parametrize("alpha", [1.0, 500.0])
def test_ridge_equals_the_closed_form(data, alpha):
    df, x, y, _ = data
    xc, yc = x - x.mean(0), y - y.mean()
    exact = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert list(linear.fit_ridge(df, X, "y", alpha).coefficients().values()) == pytest.approx(exact, abs=1e-8)


def test_lasso_meets_its_optimality_conditions(data):
    df, x, y, _ = data
    fit = linear.fit_lasso(df, X, "y", 0.1)
    w = np.array(list(fit.coefficients().values()))
    slope = x.T @ (y - x @ w - fit.model.intercept) / len(x)
    for wi, g in zip(w, slope):
        assert abs(g) <= 0.1 + 1e-4
        if abs(wi) > 1e-6:
            assert g == pytest.approx(0.1 * np.sign(wi), abs=1e-4)


def test_logistic_gradient_vanishes(data):
    df, x, _, k = data
    fit = linear.fit_logistic(df, X, "k")
    w = np.array(list(fit.coefficients().values()))
    p = 1 / (1 + np.exp(-(x @ w + fit.model.intercept)))
    assert np.abs(x.T @ (p - k) + w).max() / len(x) < 1e-5
    assert {r[3] for r in linear.odds_ratios(fit)} == {"up", "down"}


def test_naive_bayes_equals_numpy(data):
    df, x, _, k = data
    scores = []
    for c in (0, 1):
        m, v = x[k == c].mean(0), x[k == c].var(0) + 1e-9 * x.var(0).max()
        scores.append(np.log((k == c).mean()) - 0.5 * (np.log(2 * np.pi * v) + (x - m) ** 2 / v).sum(1))
    got = [r["prediction"] for r in GaussianBayes.fit(df, X, "k").transform(df).orderBy("id").collect()]
    assert got == list(np.argmax(scores, axis=0))


def test_discriminant_equals_numpy(data):
    df, x, _, k = data
    means = np.array([x[k == c].mean(0) for c in (0, 1)])
    centred = x - means[k]
    w = np.linalg.solve(centred.T @ centred / (len(x) - 2), means.T).T
    b = -0.5 * (means * w).sum(1) + np.log([(k == c).mean() for c in (0, 1)])
    fit = Discriminant.fit(df, X, "k")
    assert list(fit.coefficients().values()) == pytest.approx(w[1] - w[0], rel=1e-6)
    got = [r["prediction"] for r in fit.transform(df).orderBy("id").collect()]
    assert got == list(np.argmax(x @ w.T + b, axis=1))


def test_perceptron_separates_separable_classes(data):
    df = data[0].withColumn("k", (F.col("a") + F.col("b") > 0).cast("int")).where(F.abs(F.col("a") + F.col("b")) > 0.3)
    fit = Perceptron.fit(df, X, "k", "id", partitions=3)
    assert fit.transform(df).where("prediction != k").count() == 0


def test_perceptron_multiclass_is_repeatable(data):
    df = data[0].withColumn("k3", F.when(F.col("a") > 1, 2).when(F.col("a") > -1, 1).otherwise(0))
    run = lambda: Perceptron.fit(df, X, "k3", "id", classes=3, max_iter=4, partitions=2).weights
    assert run() == run()


def test_deeper_trees_fit_better(data):
    df = data[0]
    errors = [grid.score_regression(trees.fit_tree_regressor(df, X, "y", d), df, "y")["mse"] for d in (1, 3, 6)]
    assert errors[0] > errors[1] > errors[2]


def test_balanced_weights_sum_to_n(data):
    df = data[0]
    total = df.select(F.sum(trees.balanced_weight(df, "k"))).first()[0]
    assert total == pytest.approx(600)


def test_poly_ridge_has_twenty_terms(data):
    df = data[0].withColumns({"d": F.col("a") * 2, "e": F.col("b") - 1})
    assert len(linear.fit_poly_ridge(df, ["a", "b", "c", "d", "e"], "y").features) == 20


def test_grid_has_every_model_and_set(data):
    df = data[0].withColumn("is_test", F.col("id") % 5 == 0)
    sets = {"base": ["a", "b"], "enriched": X}
    out = grid.run_grid(df, sets, "y", grid.regressors(), grid.score_regression, grid.REG_METRICS)
    assert {(r["feature_set"], r["model"]) for r in out.collect()} == {
        (s, m) for s in sets for m in grid.regressors()}


def test_perceptron_does_not_depend_on_the_cluster(spark):
    df = spark.range(400).select("id", (C("id") % 17).cast("double").alias("a"), (C("id") % 5).cast("double").alias("b"),
                                 ((C("id") % 17) + (C("id") % 3) > 8).cast("int").alias("y"))
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    for n in ("8", "200"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(Perceptron.fit(df, ["a", "b"], "y", "id", partitions=4, max_iter=5).weights)
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_pairwise_correlations_leave_missing_values_out(spark):
    from larkspur.operators.statistics import pearson_matrix
    rows = [(float(i), float(i * i % 7) if i % 3 else None, 4.0 if i % 5 else None) for i in range(40)]
    got = {(r["x"], r["y"]): r["r"] for r in pearson_matrix(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]).collect()}
    pairs = np.array([(a, b) for a, b, _ in rows if b is not None])
    assert abs(got["a", "b"] - np.corrcoef(pairs.T)[0, 1]) < 1e-12 and got["a", "b"] == got["b", "a"] and got["c", "a"] is None


def test_perceptron_looks_at_few_rows_behind_a_mistake():
    """Every row wrong: looking 256 rows ahead each time would read 256 rows a mistake."""
    from larkspur.models import perceptron

    class Counted(np.ndarray):
        seen = 0

        def __matmul__(self, other):
            Counted.seen += len(self)
            return np.asarray(self) @ other

    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(1000, 3)), rng.choice([-1.0, 1.0], 1000)
    w, mistakes = perceptron._pass(x.view(Counted), y, np.zeros(3))
    want, wrong = np.zeros(3), 0
    for row, sign in zip(x, y):
        if sign * (row @ want) <= 0:
            want, wrong = want + sign * row, wrong + 1
    assert mistakes == wrong > 300 and np.allclose(np.asarray(w), want)
    assert Counted.seen < 16 * len(x)
