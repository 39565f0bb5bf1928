"""Predictors and trained models (M)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from larkspur.catalog.registry import query, view
from larkspur.functions import distance as fd
from larkspur.functions import geo, timeparts as tp
from larkspur.models import grid, linear, store, trees
from larkspur.models.bayes import GaussianBayes
from larkspur.models.discriminant import Discriminant, class_moments, pooled_covariance
from larkspur.models.perceptron import Perceptron
from larkspur.operators import encoding, evaluation, sampling
from larkspur.operators.skew import lookup_join
from larkspur.plans import experiment
from larkspur.plans import housing as housing_plan
from larkspur.plans import rides as ride_plan
from larkspur.session import spread, stored
from larkspur.sources.tables import Tables

C = F.col

view("predicted", """select p.*, m.p from priced p join (select name, cab_type, avg(price) as p from priced
  group by 1, 2) m on p.name = m.name and p.cab_type = m.cab_type""", "priced")
view("predicted_base", """select p.*, m.p from priced p join (select cab_type, avg(price) as p from priced
  group by 1) m on p.cab_type = m.cab_type""", "priced")
_R = """name, count(*) as n, 1 - avg((price - p) * (price - p)) / var_pop(price) as r2, avg(abs(price - p)) as mae"""
view("results", f"""select 'base' as feature_set, {_R} from predicted_base group by 2 union all
  select 'enriched', {_R} from predicted group by 2""", "predicted", "predicted_base")
view("pairs", """select b.name, b.r2 as base_r2, e.r2 as enriched_r2, b.mae as base_mae, e.mae as enriched_mae
  from results b join results e on b.name = e.name where b.feature_set = 'base' and e.feature_set = 'enriched'""",
     "results")


def predicted(t: Tables, by=("name", "cab_type")):
    """Rides with the mean price of their group as the prediction ``p``."""
    means = t.priced.groupBy(*by).agg(F.avg("price").alias("p"))
    return lookup_join(t.priced, means, list(by), "inner")


def sql_results(t: Tables):
    """Metrics of two group-mean predictors, per service."""
    parts = []
    for name, by in (("base", ["cab_type"]), ("enriched", ["name", "cab_type"])):
        metrics = evaluation.regression_metrics(predicted(t, by), "price", "p", ["name"])
        parts.append(metrics.withColumn("feature_set", F.lit(name)))
    return parts[0].unionByName(parts[1])


# --- trained models -----------------------------------------------------------------
SERVICES = "purchase|signup"
ZONES = ["NATION_1", "NATION_5", "NATION_9"]
HOUSE = housing_plan.feature_sets()["enriched"]
FLIGHT = ["month", "day", "hour", "distance", "is_early_morning", "is_morning", "is_afternoon", "is_evening",
          "is_night", "is_winter", "is_spring", "is_summer", "is_fall", "short_haul", "medium_haul", "long_haul",
          "carrier_encoded", "origin_encoded", "dest_encoded"]
FARE = ["distance_km", "hour", "is_monsoon", "traffic_level", "vehicle_type_UberGo", "vehicle_type_Premier",
        "vehicle_type_Rickshaw"]
VECTOR_SIZE = 64


def ride_table(t: Tables):
    return ride_plan.feature_table(t.rides, "ride_id", premium=SERVICES, humid=0.8, zones=ZONES)


def house_table(t: Tables):
    return housing_plan.feature_table(t.blocks, cap=4.9)


def flight_table(t: Tables, flights=None):
    """Flights with their flags and codes; ``flights`` may be a table computed before."""
    flights = stored(t.flights) if flights is None else flights
    flagged = flights.withColumns(
        tp.day_part_flags(C("hour")) | tp.season_flags(C("month")) | fd.haul_bands(C("distance")))
    codes = encoding.fit_dictionary(flights, ["carrier", "origin", "dest"])
    return encoding.apply_dictionary(flagged, codes, ["carrier", "origin", "dest"])


def fare_table(t: Tables):
    from larkspur.catalog.features import fares
    from larkspur import fixed_values as fv
    return encoding.one_hot(fares(t), "vehicle_type", list(fv.FARE_RATES))


def vector_table(t: Tables):
    """Embeddings as 64 plain columns with their class."""
    columns = [F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(VECTOR_SIZE)]
    return t.table("embeddings").select("vec_id", "label", *columns)


VECTOR = [f"e{i}" for i in range(VECTOR_SIZE)]


def parts(df, key, features, label, scaled=True, stratify=False):
    """Train and test parts on a table computed once, scaled on request."""
    keep = df.select(*dict.fromkeys([key, *features, label]))
    # Parquet takes a fraction of a checkpoint's bytes, and passes read the columns they use
    keep = spread(stored(keep))
    split = sampling.split_stratified(keep, key, label) if stratify else sampling.split_by_hash(keep, key)
    train, test = grid.train_test(split)
    if scaled:
        scaler = encoding.Scaler.fit(train, features)
        train, test = scaler.apply(train), scaler.apply(test)
    return train, test


def regression_report(t, fit, test, label, values, name="coefficient"):
    """Metrics on the test part beside every feature's value."""
    m = evaluation.regression_metrics(fit.transform(test), label, "prediction").first()
    table = linear.report(t.spark, values, name)
    return table.withColumns({c: F.lit(m[c]).cast("double") for c in ("r2", "mae", "mse", "rmse")})


def binary_report(t, fit, test, label, values, name="coefficient"):
    m = evaluation.binary_metrics(fit.transform(test), label, "prediction").first()
    table = linear.report(t.spark, values, name)
    return table.withColumns({c: F.lit(m[c]).cast("double") for c in ("accuracy", "precision", "recall", "f1")})


def averaged_report(t, predictions, label):
    m = evaluation.averaged_metrics(predictions, label, "prediction").collect()
    return t.spark.createDataFrame(
        [tuple(float(v) for v in row) for row in m],
        "n double, accuracy double, precision_weighted double, recall_weighted double, f1_weighted double, "
        "f1_macro double")


@query(name="ols_full")
def ols(t: Tables):
    train, test = parts(house_table(t), "block_id", HOUSE, "MedHouseVal")
    fit = linear.fit_ols(train, HOUSE, "MedHouseVal")
    out = regression_report(t, fit, test, "MedHouseVal", fit.coefficients())
    p = linear.report(t.spark, linear.p_values(fit), "p_value")
    return out.join(p, "feature")


@query(name="ridge_full")
def ridge(t: Tables):
    train, test = parts(house_table(t), "block_id", HOUSE, "MedHouseVal")
    fit = linear.fit_ridge(train, HOUSE, "MedHouseVal")
    return regression_report(t, fit, test, "MedHouseVal", fit.coefficients())


@query(name="lasso_full")
def lasso(t: Tables):
    train, test = parts(house_table(t), "block_id", HOUSE, "MedHouseVal")
    fit = linear.fit_lasso(train, HOUSE, "MedHouseVal", 0.01)
    kept = linear.selected(fit)
    return regression_report(t, fit, test, "MedHouseVal", fit.coefficients()).withColumn(
        "is_selected", F.col("feature").isin(list(kept)))


@query(name="tree_regressor_full")
def tree_regressor(t: Tables):
    train, test = parts(fare_table(t), "ride_id", FARE, "fare", scaled=False)
    fit = trees.fit_tree_regressor(train, FARE, "fare")
    return regression_report(t, fit, test, "fare", trees.importances(fit), "importance")


@query(name="poly_ridge_full")
def poly_ridge(t: Tables):
    columns = [c for c in housing_plan.POLY_CANDIDATES if c in HOUSE][:5]
    train, test = parts(house_table(t), "block_id", columns, "MedHouseVal", scaled=False)
    fit = linear.fit_poly_ridge(train, columns, "MedHouseVal")
    return regression_report(t, fit, test, "MedHouseVal", fit.coefficients())


@query(name="linear_regression_plain_full")
def linear_regression_plain(t: Tables):
    train, test = parts(fare_table(t), "ride_id", FARE, "fare", scaled=False)
    fit = linear.fit_plain(train, FARE, "fare")
    return regression_report(t, fit, test, "fare", fit.coefficients())


@query(name="forest_regressor_full")
def forest_regressor(t: Tables):
    train, test = parts(house_table(t), "block_id", HOUSE, "MedHouseVal", scaled=False)
    fit = trees.fit_forest_regressor(train, HOUSE, "MedHouseVal", trees=50, depth=20)
    return regression_report(t, fit, test, "MedHouseVal", trees.importances(fit), "importance")


@query(name="boosted_regressor_full")
def boosted_regressor(t: Tables):
    train, test = parts(fare_table(t), "ride_id", FARE, "fare", scaled=False)
    fit = trees.fit_boosted_regressor(train, FARE, "fare")
    return regression_report(t, fit, test, "fare", trees.importances(fit), "importance")


@query(name="logistic_full")
def logistic(t: Tables):
    train, test = parts(house_table(t), "block_id", HOUSE, "is_high_value", stratify=True)
    fit = linear.fit_logistic(train, HOUSE, "is_high_value")
    out = binary_report(t, fit, test, "is_high_value", fit.coefficients())
    return out.withColumns({"odds_ratio": F.exp("coefficient"),
                            "direction": F.when(F.col("coefficient") > 0, "up").otherwise("down")})


@query(name="logistic_multiclass_full")
def logistic_multiclass(t: Tables):
    columns = experiment.TIER_FEATURES
    table = experiment.tiers(ride_table(t)).select("ride_id", "tier", *columns)
    train, test = parts(table, "ride_id", columns, "tier", stratify=True)
    fit = linear.fit_logistic(train, columns, "tier", multiclass=True)
    return averaged_report(t, fit.transform(test), "tier")


@query(name="tree_classifier_full")
def tree_classifier(t: Tables):
    flights = stored(t.flights.drop("totflight", "arr_delay"))
    train, test = parts(flight_table(t, flights), "flight_id", FLIGHT, "is_delayed", scaled=False, stratify=True)
    fit = trees.fit_tree_classifier(train, FLIGHT, "is_delayed", depth=20)
    return binary_report(t, fit, test, "is_delayed", trees.importances(fit), "importance")


NB = ["distance", "surge_multiplier", "temperature", "humidity", "pressure"]
_NB_STATS = ", ".join(f"avg({c}) as m_{c}, var_pop({c}) as v_{c}" for c in NB)
_NB_FLOOR = "1e-9 * (select greatest(" + ", ".join(f"var_pop({c})" for c in NB) + ") from priced)"
_NB_SCORE = "ln(prior)" + "".join(
    f" - 0.5e0 * ln(2 * pi() * (v_{c} + eps)) - ({c} - m_{c}) * ({c} - m_{c}) / (2 * (v_{c} + eps))" for c in NB)


@query(f"""select ride_id, name, prediction, prior from (select p.ride_id, p.name, s.cls as prediction, s.prior,
  row_number() over (partition by p.ride_id order by {_NB_SCORE} desc, s.cls) as rn from priced p, (select name as cls,
  count(*) / (select count(*) from priced) as prior, {_NB_FLOOR} as eps, {_NB_STATS} from priced group by 1) s)
  where rn = 1""", "priced", doubles="prior")
def gaussian_nb(t: Tables):
    """Service from five measurements, with the prior of the predicted class."""
    fit = GaussianBayes.fit(t.priced, NB, "name")
    pairs = [F.lit(x) for pair in fit.priors().items() for x in pair]
    return fit.transform(t.priced.select("ride_id", "name", *NB)).select(
        "ride_id", "name", "prediction", F.try_element_at(F.create_map(*pairs), C("prediction")).alias("prior"))


@query(name="lda_classifier_full")
def lda_classifier(t: Tables):
    train, test = parts(vector_table(t), "vec_id", VECTOR, "label", stratify=True)
    fit = Discriminant.fit(train, VECTOR, "label")
    return averaged_report(t, fit.transform(test), "label")


_LDA = ["MedInc", "HouseAge", "AveRooms"]
_LDA_PAIRS = [(a, b) for a in _LDA for b in _LDA]


@query(f"""select unnest([{', '.join(f"'{a}'" for a, b in _LDA_PAIRS)}]) as x,
  unnest([{', '.join(f"'{b}'" for a, b in _LDA_PAIRS)}]) as y,
  unnest([{', '.join(f"sum(({a} - m_{a}) * ({b} - m_{b})) / (count(*) - 4)" for a, b in _LDA_PAIRS)}]) as covariance
  from (select *, {', '.join(f"avg({c}) over (partition by zone) as m_{c}" for c in _LDA)} from
  (select *, case when Latitude < 34 then 1 when Latitude < 36 then 2 when Latitude < 38 then 3 else 4 end as zone
  from blocks))""", "blocks", doubles="covariance")
def lda_pooled_covariance(t: Tables):
    df = t.blocks.withColumn("zone", geo.latitude_zone(C("Latitude")))
    rows = class_moments(df, _LDA, "zone").collect()
    means = {r["zone"]: [r[f"mean_{c}"] for c in _LDA] for r in rows}
    cov = pooled_covariance(df, _LDA, "zone", means)
    cells = [(a, b, float(cov[i, j])) for i, a in enumerate(_LDA) for j, b in enumerate(_LDA)]
    return t.spark.createDataFrame(cells, "x string, y string, covariance double")


@query(name="perceptron_full")
def perceptron(t: Tables):
    train, test = parts(vector_table(t), "vec_id", VECTOR, "label", stratify=True)
    fit = Perceptron.fit(train, VECTOR, "label", "vec_id", partitions=8, classes=10)
    return averaged_report(t, fit.transform(test), "label")


@query("""select ride_id, (select count(*) from priced) / (5 * count(*) over (partition by name)) as weight
  from priced""", "priced", doubles="weight")
def balanced_weights(t: Tables):
    return t.priced.select("ride_id", trees.balanced_weight(t.priced, "name").alias("weight"))


@query(name="forest_classifier_full")
def forest_classifier(t: Tables):
    train, test = parts(vector_table(t), "vec_id", VECTOR, "label", scaled=False, stratify=True)
    weighted = train.withColumn("weight", trees.balanced_weight(train, "label"))
    fit = trees.fit_forest_classifier(weighted, VECTOR, "label", weight="weight")
    return averaged_report(t, fit.transform(test), "label")


@query(name="boosted_classifier_full")
def boosted_classifier(t: Tables):
    train, test = parts(house_table(t), "block_id", HOUSE, "is_high_value", scaled=False, stratify=True)
    fit = trees.fit_boosted_classifier(train, HOUSE, "is_high_value")
    return binary_report(t, fit, test, "is_high_value", trees.importances(fit), "importance")


@query(name="importance_report_full")
def importance_report(t: Tables):
    from larkspur import fixed_values as fv
    train, _ = parts(house_table(t), "block_id", HOUSE, "MedHouseVal", scaled=False)
    fit = trees.fit_tree_regressor(train, HOUSE, "MedHouseVal")
    return grid.importance_report(t.spark, trees.importances(fit), fv.GEO_ENRICHMENT)


@query(name="model_grid_full")
def model_grid(t: Tables):
    """Ten models on housing blocks, base and enriched."""
    return housing_plan.run_models(house_table(t), "block_id")


@query()
def model_grid_rides(t: Tables):
    """Base against enriched regressors on rides, with the change per model."""
    return experiment.enrichment_study(ride_table(t), "ride_id")


@query()
def model_grid_services(t: Tables):
    """Price inside each of three services, with and without surge."""
    return experiment.within_service(ride_table(t), "ride_id", ["click", "view", "purchase"])


@query("select is_delayed, count(*) as n, count(*) as n_equal from flights group by 1", "flights")
def model_store(t: Tables):
    """Save a tree with its dictionary, load both, and compare the predictions."""
    from larkspur.catalog.tables import scratch_path
    path = scratch_path(t, "model")
    flights = stored(t.flights.drop("totflight", "arr_delay"))
    codes = encoding.fit_dictionary(flights, ["carrier", "origin", "dest"])
    table = flight_table(t, flights)
    fit = trees.fit_tree_classifier(table, FLIGHT, "is_delayed", depth=5)
    store.save_model(fit, codes, path)
    model, dictionary = store.load_model(t.spark, path)
    fresh = flights.withColumns(
        tp.day_part_flags(C("hour")) | tp.season_flags(C("month")) | fd.haul_bands(C("distance")))
    coded = encoding.apply_dictionary(fresh, dictionary, ["carrier", "origin", "dest"])
    loaded = model.transform(coded).select("flight_id", C("prediction").alias("loaded"))
    both = fit.transform(table).select("flight_id", "is_delayed", "prediction").join(loaded, "flight_id")
    return both.groupBy("is_delayed").agg(
        F.count("*").alias("n"), F.count_if(C("prediction") == C("loaded")).alias("n_equal"))


@query(f"""select block_id, cast(i - 1 as int) as pos, v[i] as value from (select block_id,
  [{', '.join(housing_plan.RAW)}] as v from blocks), (select unnest(range(1, {len(housing_plan.RAW) + 1})) as i)""",
       "blocks", doubles="value")
def assemble_matrix(t: Tables):
    """Cells of the assembled feature vectors, in list order."""
    vectors = linear.assemble(t.blocks, housing_plan.RAW)
    return vectors.select("block_id", F.posexplode(vector_to_array("features")).alias("pos", "value"))


def _solve_pair(a: str, b: str, y: str, alpha: str) -> str:
    """Two-feature ridge on standardised columns, by Cramer's rule."""
    zz = f"1 + {alpha} / count(*)"
    r = lambda p, q: f"covar_pop({p}, {q}) / (stddev_pop({p}) * stddev_pop({q}))"
    c = lambda p: f"covar_pop({y}, {p}) / stddev_pop({p})"
    det = f"(({zz}) * ({zz}) - ({r(a, b)}) * ({r(a, b)}))"
    one = f"(({c(a)}) * ({zz}) - ({c(b)}) * ({r(a, b)})) / {det}"
    two = f"(({c(b)}) * ({zz}) - ({c(a)}) * ({r(a, b)})) / {det}"
    return f"unnest([{one}, {two}]) as coefficient"


def _pair_fit(t: Tables, fit):
    columns = ["MedInc", "AveRooms"]
    scaled = encoding.Scaler.fit(t.blocks, columns).apply(t.blocks)
    return linear.report(t.spark, fit(scaled, columns, "MedHouseVal").coefficients())


@query(f"select unnest(['MedInc', 'AveRooms']) as feature, {_solve_pair('MedInc', 'AveRooms', 'MedHouseVal', '0e0')} "
       "from blocks", "blocks", doubles="coefficient")
def ols_two_features(t: Tables):
    return _pair_fit(t, linear.fit_ols)


@query(f"select unnest(['MedInc', 'AveRooms']) as feature, {_solve_pair('MedInc', 'AveRooms', 'MedHouseVal', '50e0')} "
       "from blocks", "blocks", doubles="coefficient")
def ridge_two_features(t: Tables):
    return _pair_fit(t, lambda df, f, y: linear.fit_ridge(df, f, y, alpha=50.0))


@query("""select 'MedInc' as feature, sign(c) * greatest(abs(c) - 0.01e0, 0) as coefficient from (select
  covar_pop(MedHouseVal, MedInc) / stddev_pop(MedInc) as c from blocks)""", "blocks", doubles="coefficient")
def lasso_one_feature(t: Tables):
    """On one standardised column the lasso is a soft threshold."""
    scaled = encoding.Scaler.fit(t.blocks, ["MedInc"]).apply(t.blocks)
    return linear.report(t.spark, linear.fit_lasso(scaled, ["MedInc"], "MedHouseVal", 0.01).coefficients())
