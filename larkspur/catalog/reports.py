"""Statistics, encodings, evaluation and decisions (A, E, V and D)."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.catalog import features as ff
from larkspur.catalog.models import predicted, sql_results
from larkspur.catalog.registry import query, view
from larkspur.catalog.rows import NUMERIC, md5_sql, r_sql, scenarios
from larkspur.functions.distance import band_label, label_of
from larkspur.functions.ride import premium_by_pattern
from larkspur.functions.timeparts import flag
from larkspur.operators import decisions, encoding, evaluation, joins, ordering, sampling, statistics
from larkspur.operators.quantiles import quantile_values, quantiles
from larkspur.sources.tables import Tables

C = F.col


# --- statistics -------------------------------------------------------------------
@query("select name, count(*) as n from rides group by 1", "rides")
def value_counts(t: Tables):
    return statistics.value_counts(t.rides, "name")


@query("select name, count(price) as n, avg(price) as mean, stddev_samp(price) as std from rides group by 1", "rides",
       doubles="mean std")
def service_stats(t: Tables):
    return statistics.group_stats(t.rides, ["name"], "price")


@query("select name, cab_type, avg(price) as mean_value, count(price) as n from priced group by 1, 2", "priced",
       doubles="mean_value")
def group_mean_sorted(t: Tables):
    return statistics.group_mean_sorted(t.priced, ["name", "cab_type"], "price")


@query(f"""select n, target, positives, positives / n as rate from (select count(*) as n,
  unnest(['is_surging', 'is_premium', 'is_platform_a']) as target, unnest([sum(cast(surge_multiplier > 1 as int)),
  sum({ff.PREMIUM}), sum(cast(cab_type = 'A' as int))]) as positives from rides)""", "rides", doubles="rate",
       bigints="positives")
def class_rate(t: Tables):
    return statistics.class_rate(t.rides, {
        "is_surging": flag(C("surge_multiplier") > 1), "is_premium": premium_by_pattern(C("name"), ff.SERVICES),
        "is_platform_a": flag(C("cab_type") == "A")})


RANGE_SQL = """count({0}) as n, min({0}) as min_value, max({0}) as max_value, avg({0}) as mean_value,
  quantile_cont({0}, 0.5) as median_value"""


@query(f"select name, {RANGE_SQL.format('price')} from rides group by 1", "rides", doubles="mean_value median_value")
def target_range(t: Tables):
    return statistics.target_range(t.rides, "price", ["name"])


@query("""select cab_type, cast(i - 1 as int) as i, [0.25e0, 0.5e0, 0.75e0][i] as prob, q[i] as quantile from
  (select cab_type, quantile_cont(price, [0.25, 0.5, 0.75]) as q from priced group by 1), (select unnest([1, 2, 3]) as i)
  """, "priced", doubles="quantile", name="quantiles")
def quantile_rows(t: Tables):
    return quantiles(t.priced, "price", [0.25, 0.5, 0.75], ["cab_type"])


PAIR_FEATURES = NUMERIC + ["always_one"]
view("constant", "select *, 1 as always_one, cast(surge_multiplier > 1 as int) as surging from priced", "priced")


@query(f"""select unnest([{', '.join(f"'{c}'" for c in PAIR_FEATURES)}]) as feature,
  unnest([{', '.join(r_sql('price', c) for c in PAIR_FEATURES)}]) as r_price,
  unnest([{', '.join(r_sql('surging', c) for c in PAIR_FEATURES)}]) as r_surging from constant""", "constant",
       doubles="r_price r_surging")
def pearson_pairs(t: Tables):
    df = t.priced.withColumns({"always_one": F.lit(1), "surging": (C("surge_multiplier") > 1).cast("int")})
    return statistics.pearson_pairs(df, PAIR_FEATURES, ["price", "surging"])


@query(f"""select unnest([{', '.join(f"'{c}'" for c in fv.GEO_ENRICHMENT)}]) as feature,
  unnest([{', '.join(r_sql('MedHouseVal', c) for c in fv.GEO_ENRICHMENT)}]) as r_MedHouseVal from geo""", "geo",
       doubles="r_MedHouseVal")
def pearson_pairs_geo(t: Tables):
    return statistics.pearson_pairs(ff.geo_features(t.blocks), fv.GEO_ENRICHMENT, ["MedHouseVal"])


MATRIX = ["MedInc", "HouseAge", "AveRooms", "AveBedrms", "Population", "AveOccup", "Latitude", "Longitude",
          "dist_to_coast", "dist_nearest_city", "MedHouseVal"]


@query(f"""select unnest([{', '.join(f"'{a}'" for a in MATRIX for b in MATRIX)}]) as x,
  unnest([{', '.join(f"'{b}'" for a in MATRIX for b in MATRIX)}]) as y,
  unnest([{', '.join(r_sql(a, b) for a in MATRIX for b in MATRIX)}]) as r from geo""", "geo", doubles="r")
def pearson_matrix(t: Tables):
    return statistics.pearson_matrix(ff.geo_features(t.blocks), MATRIX)


LEVEL_SQL = ", ".join(f"avg(price) filter (surge_multiplier = {v}) as \"{n}\""
                      for v, n in zip(fv.SURGE_LEVELS, fv.SURGE_LABELS))


def severity_level(t: Tables):
    df = ff.weathered(t.priced).withColumn("severity", C("is_rainy") + C("is_cold") + C("is_high_humidity"))
    df = joins.code_lookup(df, "severity", fv.SEVERITY_LABELS, "severity_name")
    return joins.code_lookup(df, "surge_multiplier", dict(zip(fv.SURGE_LEVELS, fv.SURGE_LABELS)), "surge_name")


@query(f"""select severity_name, {', '.join(f'round("{n}", 6) as "{n}"' for n in fv.SURGE_LABELS)} from (
  select severity_name, {LEVEL_SQL} from (select *, case {ff.RAINY} + {ff.COLD} + {ff.HUMID} when 0 then 'Clear'
  when 1 then 'Moderate' when 2 then 'Severe' end as severity_name from priced) where severity_name is not null
  group by 1)""", "priced")
def pivot_mean(t: Tables):
    wide = statistics.pivot_mean(severity_level(t), "severity_name", "surge_name", fv.SURGE_LABELS, "price")
    return wide.select("severity_name", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in fv.SURGE_LABELS])


@query("""select cab_type, cast(least(floor(price / 2.5e0), 30) as int) as bin, count(*) as n,
  least(floor(price / 2.5e0), 30) * 2.5e0 as bin_start from priced where price >= 0 and price <= 77.5 group by 1, 2, 4""",
       "priced")
def fixed_width_histogram(t: Tables):
    return statistics.fixed_width_histogram(t.priced, "price", 2.5, 31, ["cab_type"])


def _equal_bins(source: str, x: str, bins: int, key: str = "") -> str:
    head = f"{key}, " if key else ""
    return f"""select {head}bin, count(*) as n, any_value(a) + bin * any_value(w) as bin_start from (select *,
      cast(least(floor(({x} - a) / w), {bins - 1}) as int) as bin from (select *, (b - a) / {bins} as w from
      (select *, min({x}) over () as a, max({x}) over () as b from {source}))) group by {head}bin"""


@query(f"""select 'value' as measure, is_coastal, bin, n, bin_start from ({_equal_bins('geo', 'MedHouseVal', 50, 'is_coastal')})
  union all select 'log1p', is_coastal, bin, n, bin_start from ({_equal_bins('logged', 'log_value', 40, 'is_coastal')})""",
       "geo logged", doubles="bin_start")
def equal_width_histogram(t: Tables):
    df = ff.geo_features(t.blocks).withColumn("log_value", F.log1p("MedHouseVal"))
    plain = statistics.equal_width_histogram(df, "MedHouseVal", 50, ["is_coastal"])
    logged = statistics.equal_width_histogram(df, "log_value", 40, ["is_coastal"])
    return plain.withColumn("measure", F.lit("value")).unionByName(logged.withColumn("measure", F.lit("log1p")))


view("logged", "select *, ln(1 + MedHouseVal) as log_value from geo", "geo")


@query("""select cast(g.bin as int) as bin, coalesce(n, 0) as n, mean_y, a + (g.bin + 0.5e0) * w as center from
  (select unnest(range(20)) as bin) g cross join (select min(dist_to_coast) as a, (max(dist_to_coast)
    - min(dist_to_coast)) / 20 as w from geo) left join (select least(floor((dist_to_coast - a) / w), 19) as bin,
    count(*) as n, avg(MedHouseVal) as mean_y from geo, (select min(dist_to_coast) as a, (max(dist_to_coast)
    - min(dist_to_coast)) / 20 as w from geo) group by 1) m on m.bin = g.bin""", "geo", doubles="mean_y center")
def binned_mean(t: Tables):
    return statistics.binned_mean(ff.geo_features(t.blocks), "dist_to_coast", "MedHouseVal", 20)


LENGTH_SQL = "case when distance < 2 then 'short (<2)' when distance < 5 then 'medium (2-5)' else 'long (>=5)' end"


def _box_sql(source: str, keys: str, x: str) -> str:
    return f"""select {keys}, q1, median_value, q3, count({x}) as n, min(case when inside then {x} end) as whisker_low,
      max(case when inside then {x} end) as whisker_high, count(*) filter (not inside) as n_outside from (select *,
      {x} >= q1 - 1.5e0 * (q3 - q1) and {x} <= q3 + 1.5e0 * (q3 - q1) as inside from {source} join (select {keys},
      quantile_cont({x}, 0.25) as q1, quantile_cont({x}, 0.5) as median_value, quantile_cont({x}, 0.75) as q3
      from {source} group by all) using ({keys})) group by all"""


view("lengths", f"select *, {LENGTH_SQL} as ride_length from priced", "priced")


@query(_box_sql("lengths", "ride_length, cab_type", "price"), "lengths", doubles="q1 median_value q3")
def box_stats(t: Tables):
    df = t.priced.withColumn("ride_length", band_label(C("distance")))
    return statistics.box_stats(df, "price", ["ride_length", "cab_type"])


view("regions", """select *, unnest(list_filter([case when is_bay_area = 1 then 'bay' end, case when is_socal = 1 then
  'south' end, case when is_coastal = 1 and is_bay_area = 0 and is_socal = 0 then 'coastal_other' end,
  case when is_coastal = 0 then 'inland' end], lambda x: x is not null)) as region from geo""", "geo")


def regions(t: Tables):
    bay, south, coastal = (C(c) == 1 for c in ("is_bay_area", "is_socal", "is_coastal"))
    return statistics.region_rows(ff.geo_features(t.blocks), {
        "bay": bay, "south": south, "coastal_other": coastal & ~bay & ~south, "inland": ~coastal})


@query("select region, block_id, MedHouseVal from regions", "regions")
def region_case_partition(t: Tables):
    return regions(t).select("region", "block_id", "MedHouseVal")


@query(_box_sql("regions", "region", "MedHouseVal"), "regions", doubles="q1 median_value q3")
def box_stats_by_region(t: Tables):
    return statistics.box_stats(regions(t), "MedHouseVal", ["region"])


def _trend_sql(source: str, y: str, x: str, key: str = "") -> str:
    head = f"{key}, " if key else ""
    return f"""select *, intercept + slope * x_min as y_start, intercept + slope * x_max as y_end from (select {head}
      count(*) as n, regr_slope({y}, {x}) as slope, regr_intercept({y}, {x}) as intercept, {r_sql(y, x)} as r,
      regr_r2({y}, {x}) as r2, min({x}) as x_min, max({x}) as x_max from {source} where {y} is not null and
      {x} is not null {'group by ' + key if key else ''})"""


TREND = "slope intercept r r2 y_start y_end"


@query(_trend_sql("priced", "price", "distance"), "priced", doubles=TREND)
def linear_trend(t: Tables):
    return statistics.linear_trend(t.priced, "price", "distance")


@query(_trend_sql("geo", "MedHouseVal", "MedInc", "is_coastal"), "geo", doubles=TREND)
def grouped_linear_trend(t: Tables):
    return statistics.linear_trend(ff.geo_features(t.blocks), "MedHouseVal", "MedInc", ["is_coastal"])


QQ = statistics.normal_points(99)


@query(f"""select count(*) as n_points, regr_slope(o, z) as slope, regr_intercept(o, z) as intercept, {r_sql('o', 'z')} as r
  from (select unnest(q) as o, unnest([{', '.join(repr(z) + 'e0' if 'e' not in repr(z) else repr(z) for _, z in QQ)}]) as z
  from (select quantile_cont(price, [{', '.join(repr(p) for p, _ in QQ)}]) as q from priced))""", "priced",
       doubles="slope intercept r")
def normal_qq(t: Tables):
    return statistics.qq_fit(statistics.qq_points(t.priced, "price", 99))


@query("""select climate_zone, ['warm', 'mediterranean', 'temperate', 'cool'][climate_zone] as zone_name, count(*) as n,
  avg(MedHouseVal) as mean_value from geo group by 1 order by 1""", "geo", doubles="mean_value")
def group_mean_by_zone(t: Tables):
    zones = ff.geo_features(t.blocks).groupBy("climate_zone").agg(
        F.count("*").alias("n"), F.avg("MedHouseVal").alias("mean_value"))
    return joins.code_lookup(zones, "climate_zone", fv.ZONE_NAMES, "zone_name").orderBy("climate_zone")


@query("""select count(price) filter (cab_type = 'A') as a_n, avg(price) filter (cab_type = 'A') as a_mean,
  count(price) filter (cab_type = 'B') as b_n, avg(price) filter (cab_type = 'B') as b_mean from priced""", "priced",
       doubles="a_mean b_mean")
def compare_groups(t: Tables):
    return statistics.compare_groups(t.priced, {"a": C("cab_type") == "A", "b": C("cab_type") == "B"}, "price")


@query(f"""select ride_id, distance, price, is_premium, count(*) over (partition by is_premium) as class_n from
  (select *, {ff.PREMIUM} as is_premium from priced order by {md5_sql()}, ride_id limit 2000)""", "priced")
def scatter_sample(t: Tables):
    df = t.priced.select("ride_id", "distance", "price",
                         premium_by_pattern(C("name"), ff.SERVICES).alias("is_premium"))
    sample = sampling.cap_sample(df, "ride_id", 2000)
    sizes = sample.groupBy("is_premium").agg(F.count("*").alias("class_n"))
    return joins.label_join(sample, sizes, ["is_premium"])


@query("""select * from (select 'service' as choice, surge_multiplier, avg(price) filter (name = 'view') as first_mean,
  avg(price) filter (name = 'purchase') as second_mean from priced group by 2 union all
  select 'platform', surge_multiplier, avg(price) filter (cab_type = 'A'), avg(price) filter (cab_type = 'B')
  from priced group by 2) t, (select 0 as z), lateral (select second_mean - first_mean as saving)
  where first_mean is not null and second_mean is not null""".replace("t, (select 0 as z),", "t,"), "priced",
       doubles="first_mean second_mean saving")
def price_delta_decomposition(t: Tables):
    service = statistics.price_deltas(t.priced, "name", "view", "purchase", ["surge_multiplier"], "price")
    platform = statistics.price_deltas(t.priced, "cab_type", "A", "B", ["surge_multiplier"], "price")
    return service.withColumn("choice", F.lit("service")).unionByName(platform.withColumn("choice", F.lit("platform")))


@query("""with m as (select name, surge_multiplier, avg(price) as p from priced group by 1, 2)
  select a.name as first, b.name as second, a.surge_multiplier, a.p as first_mean, b.p as second_mean, b.p - a.p as saving
  from m a join m b on a.surge_multiplier = b.surge_multiplier and a.name < b.name""".replace("with m as (", "select * from (with m as (") + ")",
       "priced", doubles="first_mean second_mean saving")
def service_price_deltas(t: Tables):
    """What any service costs beside any other, at equal surge."""
    return statistics.all_price_deltas(t.priced, "name", ["surge_multiplier"], "price")


# --- encodings --------------------------------------------------------------------
@query("""select "column", value, cast(dense_rank() over (partition by "column" order by value) - 1 as int) as code
  from (select distinct unnest(['cab_type', 'source', 'route']) as "column", unnest([cab_type, source,
  source || '_' || destination]) as value from rides)""", "rides")
def label_encode(t: Tables):
    from larkspur.functions.ride import route_key
    df = t.rides.withColumn("route", route_key(C("source"), C("destination")))
    return encoding.fit_dictionary(df, ["cab_type", "source", "route"])


def _code(column: str) -> str:
    return f"cast(dense_rank() over (order by {column}) - 1 as int) as {column}_encoded"


@query(f"""select flight_id, {_code('carrier')}, {_code('origin')}, {_code('dest')} from flights""", "flights")
def encode_all_strings(t: Tables):
    df = t.flights
    text = [c for c in encoding.string_columns(df) if c != "flight_id"]
    coded = encoding.apply_dictionary(df, encoding.fit_dictionary(df, text), text)
    return coded.select("flight_id", *[f"{c}_encoded" for c in text])


@query("""select ride_id, distance_km, cast(vehicle_type = 'UberGo' as int) as vehicle_type_UberGo,
  cast(vehicle_type = 'Premier' as int) as vehicle_type_Premier, cast(vehicle_type = 'Rickshaw' as int)
  as vehicle_type_Rickshaw from synth""", "synth", doubles="distance_km")
def one_hot(t: Tables):
    return encoding.one_hot(ff.synthetic(t), "vehicle_type", list(fv.FARE_RATES)).select(
        "ride_id", "distance_km", "vehicle_type_UberGo", "vehicle_type_Premier", "vehicle_type_Rickshaw")


SCALED = ["distance", "temperature", "pressure", "always_one"]


@query(f"""select ride_id, is_test, {', '.join(f"({c} - m_{c}) / case when s_{c} = 0 then 1 else s_{c} end as {c}"
  for c in SCALED)} from split, (select {', '.join(f"avg({c}) as m_{c}, stddev_pop({c}) as s_{c}" for c in SCALED)}
  from split where not is_test)""", "split", doubles=" ".join(SCALED))
def standardize(t: Tables):
    df = t.priced.withColumn("always_one", F.lit(1.0))
    split = sampling.split_by_hash(df, "ride_id").select("ride_id", "is_test", *SCALED)
    return encoding.Scaler.fit(split.where("not is_test"), SCALED).apply(split)


view("split", f"""select *, 1e0 as always_one, cast('0x' || substr({md5_sql()}, 1, 8) as ubigint) % 100 < 20 as is_test
  from priced""", "priced")
POLY = ["distance", "surge_multiplier", "temperature", "humidity", "pressure"]
POLY_TERMS = [(f"{a}^2" if a == b else f"{a}*{b}", f"{a} * {b}") for a, b in combinations_with_replacement(POLY, 2)]


@query(f"""select ride_id, {', '.join(POLY)}, {', '.join(f'round({e}, 6) as "{n}"' for n, e in POLY_TERMS)} from priced""",
       "priced", doubles=" ".join(POLY))
def poly2_features(t: Tables):
    terms = encoding.poly2_columns(POLY)
    return t.priced.select("ride_id", *[F.round(c, 6).alias(n) if n not in POLY else c for n, c in terms.items()])


GRAM = ["1", "MedInc", "HouseAge", "AveRooms", "MedHouseVal"]
GRAM_PAIRS = list(combinations_with_replacement(GRAM, 2))


@query(f"""select unnest([{', '.join(f"'{a}'" for a, b in GRAM_PAIRS)}]) as x,
  unnest([{', '.join(f"'{b}'" for a, b in GRAM_PAIRS)}]) as y, unnest([{', '.join(
      f"sum({'1e0' if a == '1' else a} * {'1e0' if b == '1' else b})" for a, b in GRAM_PAIRS)}]) as moment from blocks""",
       "blocks", doubles="moment", digits=4)
def gram_moments(t: Tables):
    return encoding.gram_moments(t.blocks, ["MedInc", "HouseAge", "AveRooms"], "MedHouseVal")


# --- evaluation -------------------------------------------------------------------
REG = """count(*) as n, 1 - avg((price - p) * (price - p)) / var_pop(price) as r2, avg(abs(price - p)) as mae,
  avg((price - p) * (price - p)) as mse, sqrt(avg((price - p) * (price - p))) as rmse"""


@query(f"select name, {REG} from predicted group by 1 union all select 'all', {REG} from predicted", "predicted",
       doubles="r2 mae mse rmse")
def regression_metrics(t: Tables):
    df = predicted(t)
    whole = evaluation.regression_metrics(df, "price", "p").withColumn("name", F.lit("all"))
    return evaluation.regression_metrics(df, "price", "p", ["name"]).unionByName(whole)


view("two_class", """select ride_id, name, cab_type, cast(price > (select quantile_cont(price, 0.5) from priced) as int) as y,
  cast(distance > 4.9e0 as int) as p from priced""", "priced")


def binary(t: Tables):
    median = quantile_values(t.priced, "price", [0.5])[0]
    return t.priced.select("ride_id", "name", "cab_type", (C("price") > median).cast("int").alias("y"),
                           (C("distance") > F.lit(4.9)).cast("int").alias("p"))


CELLS = """count(*) filter (y = 1 and p = 1) as tp, count(*) filter (y = 0 and p = 1) as fp,
  count(*) filter (y = 1 and p = 0) as fn, count(*) filter (y = 0 and p = 0) as tn"""


@query(f"""select name, tp + fp + fn + tn as n, (tp + tn) / (tp + fp + fn + tn) as accuracy,
  coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(tp + fn, 0), 0) as recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) as f1 from (select name, {CELLS} from two_class group by 1)""",
       "two_class", doubles="accuracy precision recall f1")
def binary_metrics(t: Tables):
    return evaluation.binary_metrics(binary(t), "y", "p", ["name"])


@query(f"""select cab_type, tn, fp, fn, tp, coalesce(tn / nullif(tn + fp, 0), 0) as specificity
  from (select cab_type, {CELLS} from two_class group by 1)""", "two_class", doubles="specificity")
def confusion_matrix(t: Tables):
    return evaluation.confusion_matrix(binary(t), "y", "p", ["cab_type"])


view("four", "select ride_id, cab_type, tier as y, cast(floor(distance / 2.5e0) as int) as p from tiered", "tiered")
view("per_class", """select cab_type, cls, hits, coalesce(hits / nullif(predicted, 0), 0) as precision,
  coalesce(hits / nullif(support, 0), 0) as recall, coalesce(2 * hits / nullif(predicted + support, 0), 0) as f1, support
  from (select cab_type, cls, sum(cast(is_y = 1 and y = p as int)) as hits, sum(cast(is_y = 0 as int)) as predicted,
    sum(cast(is_y = 1 as int)) as support from (select cab_type, y, p, unnest([y, p]) as cls, unnest([1, 0]) as is_y
    from four) group by 1, 2)""", "four")


def four_class(t: Tables):
    return ordering.quantile_tiers(t.priced, "price").select(
        "ride_id", "cab_type", C("tier").alias("y"), F.floor(C("distance") / 2.5).cast("int").alias("p"))


@query("""select cab_type, sum(support) as n, sum(hits) / sum(support) as accuracy,
  sum(precision * support) / sum(support) as precision_weighted, sum(recall * support) / sum(support) as recall_weighted,
  sum(f1 * support) / sum(support) as f1_weighted, avg(f1) as f1_macro from per_class group by 1""", "per_class",
       doubles="accuracy precision_weighted recall_weighted f1_weighted f1_macro", bigints="n")
def averaged_metrics(t: Tables):
    return evaluation.averaged_metrics(four_class(t), "y", "p", ["cab_type"])


@query("""select cab_type, cast(cls as varchar) as row_name, precision, recall, f1, support from per_class union all
  select cab_type, 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from per_class group by 1 union all
  select cab_type, 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) from per_class group by 1""", "per_class",
       doubles="precision recall f1", bigints="support")
def classification_report(t: Tables):
    return evaluation.classification_report(four_class(t), "y", "p", ["cab_type"])


@query("""select name, count(*) as n, avg(price - p) as mean_residual, stddev_samp(price - p) as std_residual,
  avg(abs(price - p)) as mean_abs_residual, min(price - p) as min_residual, max(price - p) as max_residual
  from predicted group by 1""", "predicted",
       doubles="mean_residual std_residual mean_abs_residual min_residual max_residual")
def residual_summary(t: Tables):
    return evaluation.residual_summary(predicted(t), "price", "p", ["name"])


view("deltas", """select *, delta / nullif(abs(base_mae), 0) * 100 as pct_change, case when -delta > 0.001e0 then 'better'
  when -delta < -0.001e0 then 'worse' else 'same' end as status from (select name, base_mae, enriched_mae,
  enriched_mae - base_mae as delta from pairs)""", "pairs")


def deltas(t: Tables):
    pairs = joins.base_vs_enriched(sql_results(t), ["name"], ["mae"])
    return evaluation.metric_delta(pairs, "mae", lower_is_better=True)


@query("select * from deltas", "deltas", doubles="base_mae enriched_mae delta pct_change")
def metric_delta(t: Tables):
    return deltas(t)


@query("""select 'rides' as dataset, count(*) as n_models, count(*) filter (status = 'better') as n_better,
  avg(base_mae) as mean_base, avg(enriched_mae) as mean_enriched, avg(pct_change) as mean_pct_change from deltas""",
       "deltas", doubles="mean_base mean_enriched mean_pct_change")
def improvement_summary(t: Tables):
    return evaluation.improvement_summary(deltas(t).withColumn("dataset", F.lit("rides")), "mae", ["dataset"])


@query(f"""select metric, value, recorded, case when value > recorded + 0.0005e0 then 'new'
  when recorded > value + 0.0005e0 then 'recorded' else 'tie' end as winner, cast(value > recorded + 0.0005e0 as int)
  as is_win from (select unnest(['reg_best_r2', 'reg_avg_r2', 'reg_enrichment']) as metric, unnest([max(enriched_r2),
  avg(enriched_r2), avg(enriched_r2) - avg(base_r2)]) as value, unnest([0.9639e0, 0.7755e0, 0e0]) as recorded
  from pairs)""", "pairs", doubles="value")
def recorded_verdict(t: Tables):
    wide = joins.base_vs_enriched(sql_results(t), ["name"], ["r2"]).agg(
        F.max("enriched_r2").alias("reg_best_r2"), F.avg("enriched_r2").alias("reg_avg_r2"),
        (F.avg("enriched_r2") - F.avg("base_r2")).alias("reg_enrichment"))
    tall = evaluation.results_rows(wide, [], ["reg_best_r2", "reg_avg_r2", "reg_enrichment"])
    return evaluation.verdicts(tall, fv.RECORDED_RESULTS, "metric", "value")


@query("""select tier, count(*) as n, count(*) / (select count(*) from tiered) as prior, min(price) as min_value,
  max(price) as max_value from tiered group by 1""", "tiered", doubles="prior")
def prior_and_balance(t: Tables):
    return evaluation.prior_and_balance(ordering.quantile_tiers(t.priced, "price"), "tier", "price")


# --- decisions --------------------------------------------------------------------
@query("""select ride_id, base_rate + distance * per_mile * surge_multiplier as cost from priced join rates using (name)""",
       "priced rates", doubles="cost")
def ride_cost_score(t: Tables):
    from larkspur.catalog.rows import rates
    scored = joins.label_join(t.priced.select("ride_id", "name", "distance", "surge_multiplier"), rates(t), ["name"])
    return scored.select("ride_id", decisions.ride_cost(
        C("base_rate"), C("per_mile"), C("distance"), C("surge_multiplier")).alias("cost"))


@query("""select miles, platform, cheapest, cost as cheapest_cost, dearest_cost, dearest_cost - cost as saving from (
  select miles, platform, name || '@' || surge as cheapest, cost, max(cost) over w as dearest_cost,
  row_number() over (partition by miles, platform order by cost, name || '@' || surge) as rn from scenarios
  window w as (partition by miles, platform)) where rn = 1""", "scenarios", doubles="cheapest_cost dearest_cost saving")
def cheapest_option(t: Tables):
    scored = scenarios(t).withColumn("option", F.concat_ws("@", "name", C("surge").cast("string")))
    return decisions.cheapest_option(scored, "cost", "option", ["miles", "platform"])


view("invested", """select block_id, MedHouseVal / nullif(MedInc / (select quantile_cont(MedInc, 0.5) from geo), 0)
  * (1 + 0.5e0 * is_coastal) * (1 + 0.2e0 * cast(HouseAge <= 10 as int)) as score from geo""", "geo")


def invested(t: Tables):
    median = quantile_values(t.blocks, "MedInc", [0.5])[0]
    df = ff.geo_features(t.blocks)
    return df.select("block_id", decisions.investment_score(
        C("MedHouseVal"), C("MedInc"), median, C("is_coastal"), flag(C("HouseAge") <= 10)).alias("score"))


@query("select block_id, score from invested", "invested", doubles="score")
def investment_score(t: Tables):
    return invested(t)


@query("""select tier, ['Underperforming', 'Moderate', 'Strong Value', 'Prime Investment'][tier + 1] as tier_name,
  count(*) as n, count(*) / (select count(*) from invested) as share, min(score) as min_value, max(score) as max_value
  from (select score, cast(case when score <= q[1] then 0 when score <= q[2] then 1 when score <= q[3] then 2 else 3 end
  as int) as tier from invested, (select quantile_cont(score, [0.3, 0.6, 0.9]) as q from invested)) group by 1, 2""",
       "invested", doubles="share min_value max_value")
def investment_tiers(t: Tables):
    return ordering.tier_summary(decisions.investment_tiers(invested(t), "score"), "score")
