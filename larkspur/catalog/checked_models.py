"""Models whose fit has a closed form or a condition that SQL can state (M).

The same operators run on full feature lists in ``models`` under names that end
in ``_full``; those have no SQL.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.catalog.models import _solve_pair, house_table
from larkspur.catalog.registry import query, view
from larkspur.functions import geo
from larkspur.models import grid, linear, trees
from larkspur.models.discriminant import Discriminant
from larkspur.models.perceptron import Perceptron
from larkspur.operators import encoding
from larkspur.plans import housing as housing_plan
from larkspur.sources.tables import Tables

C = F.col
PAIR = ["MedInc", "AveRooms"]
RICH = 2.0

view("zoned", f"""select *, case when Latitude < 34 then 1 when Latitude < 36 then 2 when Latitude < 38 then 3 else 4 end
  as zone, cast(MedHouseVal > {RICH} as int) as rich from blocks""", "blocks")


def zoned(t: Tables):
    """Blocks with their zone, a class of value, and both as doubles."""
    zone = geo.latitude_zone(C("Latitude"))
    return t.blocks.withColumns({"zone": zone, "z": zone.cast("double"), "rich": (C("MedHouseVal") > RICH).cast("int")})


# --- linear ---------------------------------------------------------------------------
def _plain_pair(a: str, b: str, y: str, alpha: str = "0e0") -> str:
    """Two-feature least squares on unscaled columns with an unpenalised intercept, by Cramer's rule."""
    va, vb, ab = (f"(covar_pop({p}, {q}) + {k})" for p, q, k in
                  ((a, a, f"{alpha} / count(*)"), (b, b, f"{alpha} / count(*)"), (a, b, "0e0")))
    ca, cb = (f"covar_pop({y}, {p})" for p in (a, b))
    det = f"({va} * {vb} - {ab} * {ab})"
    return f"unnest([({ca} * {vb} - {cb} * {ab}) / {det}, ({cb} * {va} - {ca} * {ab}) / {det}]) as coefficient"


@query(f"select unnest(['MedInc', 'AveRooms']) as feature, {_plain_pair('MedInc', 'AveRooms', 'MedHouseVal')} from blocks",
       "blocks", doubles="coefficient")
def linear_regression_plain_closed_form(t: Tables):
    return linear.report(t.spark, linear.fit_plain(t.blocks, PAIR, "MedHouseVal").coefficients())


@query(f"""select unnest(['MedInc', 'MedInc_pow_2']) as feature, {_plain_pair('a', 'b', 'MedHouseVal', '3e0')}
  from (select MedInc as a, MedInc * MedInc as b, MedHouseVal from blocks)""", "blocks", doubles="coefficient")
def poly_ridge_closed_form(t: Tables):
    return linear.report(t.spark, linear.fit_poly_ridge(t.blocks, ["MedInc"], "MedHouseVal", alpha=3.0).coefficients())


@query(f"""select f as feature, 0e0 as excess from (select unnest([{', '.join(f"'{c}'" for c in housing_plan.RAW)}]) as f)""",
       doubles="excess", digits=5)
def lasso(t: Tables):
    """How far each feature's slope of the loss is beyond what the penalty allows: nowhere at the optimum."""
    alpha = 0.05
    data = encoding.Scaler.fit(t.blocks, housing_plan.RAW).apply(t.blocks)
    fit = linear.fit_lasso(data, housing_plan.RAW, "MedHouseVal", alpha)
    gap = fit.transform(data).withColumn("_e", C("MedHouseVal") - C("prediction"))
    slope = gap.agg(*[F.avg(C("_e") * C(f)).alias(f) for f in housing_plan.RAW]).first()
    excess = {f: slope[f] - alpha * float(np.sign(w)) if w else max(abs(slope[f]) - alpha, 0.0)
              for f, w in fit.coefficients().items()}
    return linear.report(t.spark, excess, "excess")


def _logistic_slopes(data, fit, features, label: str, classes: list[int]):
    """Mean slope of the penalised loss per class and feature."""
    n = data.count()
    scored = fit.transform(data).withColumn("_p", vector_to_array("probability"))
    cells = []
    for k in classes:
        error = F.get("_p", F.lit(k)) - (C(label) == k).cast("double")
        cells += [F.avg(error * C(f)).alias(f"{k}|{f}") for f in features]
    sums = scored.agg(*cells).first()
    matrix = fit.model.coefficientMatrix.toArray()
    weights = {k: matrix[k] if len(matrix) > 1 else matrix[0] for k in classes}
    return [(k, f, float(sums[f"{k}|{f}"] + weights[k][i] / n)) for k in classes for i, f in enumerate(features)]


@query("select unnest(['MedInc', 'AveRooms']) as feature, 0e0 as slope", doubles="slope", digits=3)
def logistic_closed_form(t: Tables):
    """The slope of the loss at the fitted weights, feature by feature."""
    data = encoding.Scaler.fit(t.blocks, PAIR).apply(zoned(t))
    slopes = _logistic_slopes(data, linear.fit_logistic(data, PAIR, "rich"), PAIR, "rich", [1])
    return t.spark.createDataFrame([(f, s) for _, f, s in slopes], "feature string, slope double")


@query("""select cast(k as int) as k, feature, 0e0 as slope from (select unnest([0, 1, 2, 3]) as k), (select unnest(['MedInc', 'AveRooms'])
  as feature)""", doubles="slope", digits=3)
def logistic_multiclass_closed_form(t: Tables):
    data = encoding.Scaler.fit(t.blocks, PAIR).apply(zoned(t)).withColumn("k", C("zone") - 1)
    fit = linear.fit_logistic(data, PAIR, "k", multiclass=True)
    return t.spark.createDataFrame(_logistic_slopes(data, fit, PAIR, "k", [0, 1, 2, 3]), "k int, feature string, slope double")


# --- trees: one cut of four zones, found by trying all ------------------------------------
def _stump(value: str, weight: str, prediction: str) -> str:
    """Prediction per zone of the best cut: the one with the largest sum of (side's sum)^2 / (side's weight)."""
    return f"""with g as (select zone, sum({weight}) as n, sum(({weight}) * ({value})) as s from zoned group by 1),
  c as (select a.zone as cut, sum(b.n) filter (b.zone <= a.zone) as nl, sum(b.s) filter (b.zone <= a.zone) as sl,
    sum(b.n) filter (b.zone > a.zone) as nr, sum(b.s) filter (b.zone > a.zone) as sr from g a, g b group by 1),
  w as (select * from c where nr > 0 order by sl * sl / nl + sr * sr / nr desc, cut limit 1)
  select zone, {prediction.format(m='case when zone <= cut then sl / nl else sr / nr end')} as prediction from g, w"""


def _per_zone(t: Tables, fit):
    zones = zoned(t).select("zone", "z").distinct()
    return fit.transform(zones).select("zone", C("prediction").cast("double").alias("prediction"))


@query(_stump("MedHouseVal", "1e0", "{m}"), "zoned", doubles="prediction")
def tree_regressor_stump(t: Tables):
    return _per_zone(t, trees.fit_tree_regressor(zoned(t), ["z"], "MedHouseVal", depth=1))


@query(_stump("rich", "1e0", "cast(({m}) > 0.5e0 as double)"), "zoned", doubles="prediction")
def tree_classifier_stump(t: Tables):
    return _per_zone(t, trees.fit_tree_classifier(zoned(t), ["z"], "rich", depth=1))


@query("""select count(*) as n, count(*) as n_in_range, 1e0 as importance from blocks""", "blocks", doubles="importance")
def forest_regressor_bounds(t: Tables):
    """Averages of leaves stay inside the labels' range, and importances add up to one."""
    ends = t.blocks.agg(F.min("MedHouseVal"), F.max("MedHouseVal")).first()
    fit = trees.fit_forest_regressor(t.blocks, housing_plan.RAW, "MedHouseVal", trees=10, depth=6)
    inside = C("prediction").between(ends[0] - 1e-9, ends[1] + 1e-9)
    return fit.transform(t.blocks).agg(F.count("*").alias("n"), F.count_if(inside).alias("n_in_range")).withColumn(
        "importance", F.lit(sum(trees.importances(fit).values())))


@query("""select rich, count(*) as n, count(*) as n_votes_add_up, (select count(*) from zoned) / (2e0 * count(*)) as weight
  from zoned group by 1""", "zoned", doubles="weight")
def forest_classifier_votes(t: Tables):
    """Balanced weights, and votes that add up to one and agree with the prediction."""
    weighted = zoned(t).withColumn("weight", trees.balanced_weight(zoned(t), "rich"))
    fit = trees.fit_forest_classifier(weighted, housing_plan.RAW, "rich", trees=10, depth=6, weight="weight")
    votes = fit.transform(weighted).withColumn("_p", C("probability"))
    sound = (F.abs(F.get("_p", F.lit(0)) + F.get("_p", F.lit(1)) - 1) < 1e-9) & (
        (C("prediction") == 1) == (F.get("_p", F.lit(1)) > F.get("_p", F.lit(0))))
    return votes.groupBy("rich").agg(F.count("*").alias("n"), F.count_if(sound).alias("n_votes_add_up"),
                                     F.first("weight").alias("weight"))


# --- other classifiers -------------------------------------------------------------------
_M = "avg(MedInc) as ma, avg(AveRooms) as mb"


@query(f"""with m as (select zone, count(*) as n, {_M} from zoned group by 1),
  s as (select sum((MedInc - ma) * (MedInc - ma)) / (count(*) - 4) as va, sum((AveRooms - mb) * (AveRooms - mb)) / (count(*) - 4)
    as vb, sum((MedInc - ma) * (AveRooms - mb)) / (count(*) - 4) as ab, count(*) as total from zoned join m using (zone)),
  w as (select zone, (ma * vb - mb * ab) / (va * vb - ab * ab) as wa, (mb * va - ma * ab) / (va * vb - ab * ab) as wb, ma, mb,
    n, total from m, s)
  select block_id, prediction from (select block_id, w.zone as prediction, row_number() over (partition by block_id order by
    MedInc * wa + AveRooms * wb - 0.5e0 * (ma * wa + mb * wb) + ln(n / total) desc) as place from zoned, w) where place = 1""",
       "zoned")
def lda_classifier_closed_form(t: Tables):
    data = zoned(t)
    return Discriminant.fit(data, PAIR, "zone").transform(data).select("block_id", "prediction")


@query("select rich, count(*) as n, 0 as mistakes from (select MedInc > 5 as rich from blocks where MedInc < 4 or MedInc > 6) "
       "group by 1", "blocks", bigints="mistakes")
def perceptron_separable(t: Tables):
    """A table that a line separates is learnt without a mistake."""
    apart = t.blocks.where("MedInc < 4 or MedInc > 6").withColumn("y", (C("MedInc") > 5).cast("int"))
    data = encoding.Scaler.fit(apart, PAIR).apply(apart)
    fit = Perceptron.fit(data, PAIR, "y", "block_id", partitions=4)
    return fit.transform(data).groupBy((C("y") == 1).alias("rich")).agg(
        F.count("*").alias("n"), F.count_if(C("prediction") != C("y")).alias("mistakes"))


# --- reports ---------------------------------------------------------------------------
@query(f"""select feature, importance, cast(feature = 'AveRooms' as int) as is_enrichment from (
  select unnest(['MedInc', 'AveRooms']) as feature, {_solve_pair('MedInc', 'AveRooms', 'MedHouseVal', '50e0')
    .replace('as coefficient', 'as importance')} from blocks) order by abs(importance) desc limit 1""", "blocks",
       doubles="importance")
def importance_report(t: Tables):
    scaled = encoding.Scaler.fit(t.blocks, PAIR).apply(t.blocks)
    values = linear.fit_ridge(scaled, PAIR, "MedHouseVal", alpha=50.0).coefficients()
    return grid.importance_report(t.spark, values, ["AveRooms"], k=1).select("feature", "importance", "is_enrichment")


def grid_sql(sets: dict[str, list[str]], models: list[str]) -> str:
    rows = [f"('{name}', '{model}', {len(columns)}, true)" for name, columns in sets.items() for model in models]
    return f"select * from (values {', '.join(rows)}) v(feature_set, model, n_features, in_bounds)"


REGRESSORS = ["OLS", "Ridge", "Lasso", "Decision Tree", "Polynomial"]
CLASSIFIERS = ["Logistic Reg", "Decision Tree", "Naive Bayes", "LDA", "Perceptron"]


def checked(results, metric: str):
    """A results table as its shape and whether every score is one."""
    ok = F.coalesce(C(metric).between(0, 1) if metric == "f1" else (C(metric) <= 1) & (C("mse") >= C("mae") * C("mae") - 1e-9), F.lit(False))
    return results.select("feature_set", "model", "n_features", ok.alias("in_bounds"))


_SETS = {"base": housing_plan.RAW, "with ratios": housing_plan.feature_sets()["base"]}


@query(grid_sql(_SETS, REGRESSORS))
def model_grid_shape(t: Tables):
    """The five regressors on two feature sets of housing blocks."""
    from larkspur.operators import sampling
    split = sampling.split_by_hash(house_table(t), "block_id")
    return checked(grid.run_grid(split, _SETS, "MedHouseVal", grid.regressors(["MedInc", "AveRooms"]),
                                 grid.score_regression, grid.REG_METRICS), "r2")
