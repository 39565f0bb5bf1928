"""Sampling, joins, sorts and set operations (P, J and T)."""

from __future__ import annotations

from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.catalog import features as ff
from larkspur.catalog.registry import query, view
from larkspur.catalog.tables import BAND_SQL, fine_strata, strata
from larkspur.functions import geo
from larkspur.functions.distance import price_band
from larkspur.functions.timeparts import hour_floor
from larkspur.operators import cleaning, decisions, encoding, evaluation, joins, ordering, sampling, statistics
from larkspur.sources.tables import Tables

C = F.col
QUARTER = 4  # samples are a quarter of their table
_SIZE = f"(select count(*) // {QUARTER} from strata)"


def size(df) -> int:
    return df.count() // QUARTER


def md5_sql(key: str = "ride_id") -> str:
    return f"md5(concat(cast({key} as varchar), ':42'))"


# --- sampling -------------------------------------------------------------------
@query("""select ride_id, stratum, cab_type || '_' || case when price <= 10 then 'low' when price <= 15 then 'mid'
  when price <= 25 then 'high' else 'premium' end as coarse from strata""", "strata")
def strata_key(t: Tables):
    return strata(t).select("ride_id", "stratum",
                            sampling.strata_key(C("cab_type"), price_band(C("price"))).alias("coarse"))


view("ranked_strata", f"""select *, row_number() over (partition by stratum order by {md5_sql()}, ride_id) as rn,
  count(*) over (partition by stratum) as n_s, (select count(*) from strata) as n_all from strata""", "strata")
view("sampled", f"select * from ranked_strata where rn <= greatest(1, floor(n_s / n_all * (n_all // {QUARTER})))", "ranked_strata")
view("topped", f"""select ride_id, stratum, price, cab_type, 'stratified' as origin from sampled union all
  select ride_id, stratum, price, cab_type, 'top_up' from (select *, row_number() over (order by {md5_sql()}, ride_id)
    as r2 from ranked_strata where ride_id not in (select ride_id from sampled))
  where r2 <= {_SIZE} - (select count(*) from sampled)""", "sampled")


@query("select ride_id, stratum from sampled", "sampled")
def stratified_sample(t: Tables):
    return sampling.stratified_sample(strata(t), "ride_id", "stratum", size(strata(t))).select("ride_id", "stratum")


@query("select ride_id, stratum, origin from topped", "topped")
def sample_top_up(t: Tables):
    return sampling.sample_with_top_up(strata(t), "ride_id", "stratum", size(strata(t))).select("ride_id", "stratum", "origin")


@query(f"select ride_id, price from priced order by {md5_sql()}, ride_id limit (select count(*) // {QUARTER} from priced)", "priced")
def cap_sample(t: Tables):
    return sampling.cap_sample(t.priced.select("ride_id", "price"), "ride_id", size(t.priced))


@query(f"""select ride_id, row_number() over (order by {md5_sql()}, ride_id) <= ceil(0.2e0 * count(*) over ()) as is_test,
  cast('0x' || substr({md5_sql()}, 1, 8) as ubigint) % 100 < 20 as is_test_by_hash from priced""", "priced")
def train_test_split(t: Tables):
    exact = sampling.split_exact(t.priced.select("ride_id"), "ride_id")
    return sampling.split_by_hash(exact, "ride_id", name="is_test_by_hash")


@query(f"""select l.ride_id, l.surging, rn <= take as is_test from (select ride_id, surging, row_number() over
    (partition by surging order by {md5_sql()}, ride_id) as rn from labelled) l
  join (select surging, base + cast(row_number() over (order by part desc, surging) <= w - sum(base) over () as int) as take
    from (select surging, w, floor(n * w / n_all) as base, n * w / n_all - floor(n * w / n_all) as part
      from (select surging, count(*) as n, (select count(*) from labelled) as n_all,
        ceil(0.2e0 * (select count(*) from labelled)) as w from labelled group by 1))) q on l.surging = q.surging""",
       "labelled")
def stratified_split(t: Tables):
    labelled = t.priced.select("ride_id", (C("surge_multiplier") > 1).cast("int").alias("surging"))
    return sampling.split_stratified(labelled, "ride_id", "surging")


view("labelled", "select ride_id, cast(surge_multiplier > 1 as int) as surging from priced", "priced")


@query(f"""select ride_id, price, p, abs(price - p) as abs_diff from predicted order by {md5_sql()}, ride_id limit 3""",
       "predicted", doubles="p abs_diff")
def pick_examples(t: Tables):
    from larkspur.catalog.models import predicted
    return sampling.pick_examples(predicted(t), "ride_id", "price", "p")


@query("""select "column", p.value, population_n, population_share, coalesce(sample_n, 0) as sample_n,
  coalesce(sample_share, 0e0) as sample_share from
  (select "column", value, count(*) as population_n, count(*) / (select count(*) from strata) as population_share from
    (select unnest(['cab_type', 'band']) as "column", unnest([cab_type, band]) as value from banded) group by 1, 2) p
  left join (select "column" as c, value, count(*) as sample_n, count(*) / (select count(*) from sampled) as sample_share
    from (select unnest(['cab_type', 'band']) as "column", unnest([cab_type, band]) as value from banded
      where ride_id in (select ride_id from sampled)) group by 1, 2) s on s.c = p."column" and s.value = p.value""",
       "banded sampled", doubles="population_share sample_share")
def stratum_balance(t: Tables):
    df = strata(t).withColumn("band", price_band(C("price")))
    sample = sampling.stratified_sample(df, "ride_id", "stratum", size(df))
    return sampling.stratum_balance(df, sample, ["cab_type", "band"])


view("banded", f"select *, {BAND_SQL} as band from priced", "priced")


# --- joins ----------------------------------------------------------------------
@query("""select ride_id, date_trunc('hour', ts + interval 30 minute) as merge_time, temp_c, precipitation, wind_speed
  from rides left join hourly on hour_ts = date_trunc('hour', ts + interval 30 minute)""", "rides hourly")
def hourly_weather_join(t: Tables):
    joined = joins.hourly_join(t.rides.select("ride_id", "ts"), "ts", t.hourly, "hour_ts", "temp_c")
    return joined.select("ride_id", "merge_time", "temp_c", "precipitation", "wind_speed")


@query("select block_id, near.d as dist_to_coast, cast(near.i as int) as coast_point from nearest", "nearest",
       doubles="dist_to_coast")
def nearest_reference_point(t: Tables):
    near = geo.nearest_point()
    return geo.with_unit_vector(t.blocks, "Latitude", "Longitude").select("block_id", near["distance"].alias("dist_to_coast"), near["point"].alias("coast_point"))


DIST_COLUMNS = [f"dist_{c}" for c in fv.CITIES] + ["dist_nearest_city"]


@query(f"select block_id, {', '.join(DIST_COLUMNS)} from geo", "geo", doubles=" ".join(DIST_COLUMNS))
def distance_matrix(t: Tables):
    placed = geo.with_unit_vector(t.blocks, "Latitude", "Longitude")
    return placed.select("block_id", *[c.alias(n) for n, c in geo.city_distances().items()])


@query(f"""select ride_id, severity, case severity when 0 then 'Clear' when 1 then 'Moderate' when 2 then 'Severe' end
  as severity_name, case surge_multiplier when 1 then '1x' when 1.25 then '1.25x' when 1.5 then '1.5x'
  when 1.75 then '1.75x' when 2 then '2x' when 2.5 then '2.5x' when 3 then '3x' end as surge_name,
  [{", ".join(f"'{n}'" for n in fv.SERVICE_NAMES.values())}][service_code + 1] as service_name from
  (select *, {ff.RAINY} + {ff.COLD} + {ff.HUMID} as severity, ride_id % 15 as service_code from rides)""", "rides")
def code_lookup(t: Tables):
    df = ff.weathered(t.rides).withColumn("severity", C("is_rainy") + C("is_cold") + C("is_high_humidity"))
    df = joins.code_lookup(df, "severity", fv.SEVERITY_LABELS, "severity_name")
    df = joins.code_lookup(df, "surge_multiplier", dict(zip(fv.SURGE_LEVELS, fv.SURGE_LABELS)), "surge_name")
    df = joins.code_lookup(df.withColumn("service_code", (C("ride_id") % 15).cast("int")), "service_code", fv.SERVICE_NAMES,
                           "service_name")  # two codes are in no table
    return df.select("ride_id", "severity", "severity_name", "surge_name", "service_name")


@query("""select ride_id, source from rides where source in (select n_name from nation join region
  on n_regionkey = r_regionkey where r_name in ('ASIA', 'EUROPE', 'REGION_1', 'REGION_3'))""", "rides")
def membership_semi(t: Tables):
    zones = t.table("nation").join(t.table("region"), C("n_regionkey") == C("r_regionkey")).where(
        C("r_name").isin("ASIA", "EUROPE", "REGION_1", "REGION_3")).select(C("n_name").alias("source"))
    return joins.membership_semi(t.rides.select("ride_id", "source"), zones, ["source"])


@query("""select ride_id, stratum from dest_strata where stratum in (select stratum from dest_strata group by 1
  having count(*) >= 10)""", "dest_strata")
def valid_strata_semi(t: Tables):
    df = fine_strata(t).select("ride_id", "stratum")
    return cleaning.valid_strata_semi(df, cleaning.stratum_sizes(df, "stratum"), "stratum")


@query("select ride_id, stratum from strata where ride_id not in (select ride_id from sampled)", "strata sampled")
def not_sampled_anti(t: Tables):
    return sampling.outside_sample(strata(t), "ride_id", "stratum", size(strata(t))).select("ride_id", "stratum")


@query("""select ride_id, route, coalesce(code, -1) as route_encoded from (select ride_id,
  source || '_' || destination as route from rides) left join (select r, cast(row_number() over (order by r) - 1 as int)
  as code from (select distinct source || '_' || destination as r from rides where surge_multiplier > 2)) on r = route""",
       "rides")
def encoder_apply(t: Tables):
    """Codes learnt on high-surge rides; routes that never surged are unseen."""
    from larkspur.functions.ride import route_key
    routed = t.rides.withColumn("route", route_key(C("source"), C("destination")))
    codes = encoding.fit_dictionary(routed.where("surge_multiplier > 2"), ["route"])
    return encoding.apply_dictionary(routed.select("ride_id", "route"), codes, ["route"])


@query("""select ride_id, count(starts) filter (ts >= starts and ts < ends) as n_events,
  cast(count(starts) > 0 as int) as is_event_day, cast(count(starts) filter (ts >= starts and ts < ends) > 0 as int)
  as is_during_event, cast(count(starts) filter (ts >= starts and ts < ends and venue = source) > 0 as int)
  as is_at_event_venue from rides left join calendar on cast(ts as date) >= cast(starts as date)
  and cast(cast(ts as date) as timestamp) < ends group by 1""", "rides calendar", bigints="n_events")
def event_day_join(t: Tables):
    joined = joins.window_join(t.rides.select("ride_id", "ts", "source"), "ts", "source", t.calendar)
    return joined.select("ride_id", "n_events", "is_event_day", "is_during_event", "is_at_event_venue")


@query("""select ride, as_of, f.week as week_matched, gas_price from (
  select cast(l_orderkey as varchar) || ':' || l_partkey || ':' || l_suppkey || ':' || l_linenumber as ride,
    unnest([l_shipdate, l_shipdate + interval 11 year]) as as_of from lineitem) asof left join fuel f on as_of >= f.week""", "fuel")
def asof_weekly_price(t: Tables):
    """The order-week price in force on each ship date, and eleven years later, when only the last week is left."""
    ride = F.concat_ws(":", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("ride")
    later = (C("l_shipdate") + F.make_ym_interval(F.lit(11))).cast(dict(t.table("lineitem").dtypes)["l_shipdate"])
    shipped = t.table("lineitem").select(ride, F.explode(F.array("l_shipdate", later)).alias("as_of"))
    return joins.asof_join(shipped, "as_of", t.fuel, "week", ["gas_price"])


view("traffic", """select source || '_' || destination as route, cast(hour(ts) as int) as hour,
  avg(surge_multiplier * 60) as delay from rides group by 1, 2""", "rides")


@query("""select ride_id, r.source || '_' || r.destination as route, cast(hour(ts) as int) as hour, delay,
  case when delay < 60.5e0 then 'low' when delay < 80 then 'moderate' when delay < 110 then 'heavy' else 'severe' end
  as congestion_level from rides r left join traffic t on r.source || '_' || r.destination = t.route
  and cast(hour(ts) as int) = t.hour""", "rides traffic", doubles="delay")
def route_hour_traffic_join(t: Tables):
    from larkspur.functions.ride import route_key
    rides = t.rides.select("ride_id", route_key(C("source"), C("destination")).alias("route"),
                           F.hour("ts").alias("hour"), "surge_multiplier")
    delay = F.avg(C("surge_multiplier") * 60)
    traffic = rides.groupBy("route", "hour").agg(delay.alias("delay"))
    level = F.when(C("delay") < 60.5, "low").when(C("delay") < 80, "moderate").when(C("delay") < 110, "heavy")
    joined = joins.keyed_join(rides.drop("surge_multiplier"), traffic, ["route", "hour"])
    return joined.withColumn("congestion_level", level.otherwise("severe"))


view("station_delays", """select station, hour_ts, max(delay) as max_delay, avg(delay) as avg_delay, count(*) as n_alerts
  from (select unnest([destination, 'ZONE_' || ((cast(substr(destination, 6) as int) + 1) % 12)]) as station,
    date_trunc('hour', ts) as hour_ts, windSpeed as delay from rides where surge_multiplier > 1) group by 1, 2""",
     "rides")


@query("""select ride_id, destination, date_trunc('hour', ts) as hour_ts, max_delay, avg_delay, n_alerts
  from rides left join station_delays d on station = destination and d.hour_ts = date_trunc('hour', ts)""",
       "rides station_delays", doubles="avg_delay")
def station_delay_join(t: Tables):
    hour = hour_floor(C("ts")).alias("hour_ts")
    following = F.concat(F.lit("ZONE_"), (
        (F.substring("destination", 6, 3).cast("int") + 1) % 12).cast("string"))
    alerts = t.rides.where("surge_multiplier > 1").select(
        F.array(C("destination"), following).alias("stations"), hour, C("windSpeed").alias("delay"))
    delays = joins.station_delays(alerts, "stations", "hour_ts", "delay").withColumnRenamed("station", "destination")
    return joins.keyed_join(t.rides.select("ride_id", "destination", hour), delays, ["destination", "hour_ts"])


@query("""select name, base_r2, enriched_r2, base_mae, enriched_mae from pairs""", "pairs",
       doubles="base_r2 enriched_r2 base_mae enriched_mae")
def base_vs_enriched_join(t: Tables):
    from larkspur.catalog.models import sql_results
    return joins.base_vs_enriched(sql_results(t), ["name"], ["r2", "mae"])


GRID = {"surge": [1.0, 1.5, 2.0], "platform": ["A", "B"], "miles": [1.0, 5.0]}
view("rates", """select name, min(price) as base_rate, avg(price / (distance + 1)) as per_mile from priced group by 1""",
     "priced")
view("scenarios", """select *, base_rate + miles * per_mile * surge as cost from rates,
  (select unnest([1e0, 1.5e0, 2e0]) as surge), (select unnest(['A', 'B']) as platform),
  (select unnest([1e0, 5e0]) as miles)""", "rates")


def rates(t: Tables):
    return t.priced.groupBy("name").agg(
        F.min("price").alias("base_rate"), F.avg(C("price") / (C("distance") + 1)).alias("per_mile"))


def scenarios(t: Tables):
    grid = joins.scenario_grid(rates(t), GRID)
    return grid.withColumn("cost", decisions.ride_cost(C("base_rate"), C("per_mile"), C("miles"), C("surge")))


@query("select name, surge, platform, miles, cost from scenarios", "scenarios", doubles="cost")
def scenario_grid(t: Tables):
    return scenarios(t).select("name", "surge", "platform", "miles", "cost")


# --- sorts and sets ---------------------------------------------------------------
@query("select name, cab_type, avg(price) as mean_value, count(price) as n from priced group by 1, 2 "
       "order by mean_value, name, cab_type", "priced", doubles="mean_value")
def sort_by(t: Tables):
    return statistics.group_mean_sorted(t.priced, ["name", "cab_type"], "price")


@query("select ride_id, ts, price from priced order by ts, ride_id limit 10", "priced")
def head_n(t: Tables):
    return ordering.head_n(t.priced.select("ride_id", "ts", "price"), ["ts", "ride_id"], 10)


NUMERIC = ["distance", "surge_multiplier", "temperature", "apparentTemperature", "humidity", "cloudCover",
           "precipProbability", "windSpeed", "windGust", "precipIntensity", "visibility", "pressure", "dewPoint"]


def r_sql(y: str, x: str) -> str:
    return f"covar_pop({y}, {x}) / nullif(stddev_pop({y}) * stddev_pop({x}), 0)"


@query(f"""select feature, r_price from (select unnest([{', '.join(f"'{c}'" for c in NUMERIC)}]) as feature,
  unnest([{', '.join(r_sql('price', c) for c in NUMERIC)}]) as r_price from priced)
  order by abs(r_price) desc, feature limit 5""", "priced", doubles="r_price")
def top_k_abs(t: Tables):
    return ordering.top_k_abs(statistics.pearson_pairs(t.priced, NUMERIC, ["price"]), "r_price", "feature")


@query("""(select ride_id, price, p, price - p as residual, 'low' as side from predicted order by price - p, ride_id
  limit 3) union all (select ride_id, price, p, price - p, 'high' from predicted order by price - p desc, ride_id
  limit 3)""", "predicted", doubles="p residual")
def extreme_residuals(t: Tables):
    from larkspur.catalog.models import predicted
    return evaluation.extreme_residuals(predicted(t), "ride_id", "price", "p")


@query("select distinct source, source_code as source_encoded from coded order by 2", "coded")
def distinct_pairs(t: Tables):
    codes = encoding.fit_dictionary(t.priced, ["source"])
    coded = encoding.apply_dictionary(t.priced, codes, ["source"])
    return ordering.distinct_pairs(coded, "source", "source_encoded")


@query("select origin, count(*) as n, count(distinct ride_id) as n_distinct, sum(price) as total_price from topped "
       "group by 1", "topped", doubles="total_price", digits=3)
def union_samples(t: Tables):
    sample = sampling.sample_with_top_up(strata(t), "ride_id", "stratum", size(strata(t)))
    return sample.groupBy("origin").agg(F.count("*").alias("n"), F.countDistinct("ride_id").alias("n_distinct"),
                                        F.sum("price").alias("total_price"))


@query("""select cab_type, name, mean_value, n from (select *, row_number() over (partition by cab_type
  order by mean_value desc, name) as rn from (select cab_type, name, avg(price) as mean_value, count(price) as n
  from priced group by 1, 2)) where rn = 1""", "priced", doubles="mean_value")
def best_of(t: Tables):
    means = statistics.group_mean_sorted(t.priced, ["name", "cab_type"], "price")
    return ordering.best_of(means, "mean_value", "name", ["cab_type"])


@query("""select feature_set, name, r2, cast(rank() over (partition by feature_set order by r2 desc) as int) as place
  from results""", "results", doubles="r2")
def leaderboard(t: Tables):
    from larkspur.catalog.models import sql_results
    return ordering.leaderboard(sql_results(t), "r2", ["feature_set"]).select("feature_set", "name", "r2", "place")


@query("""select week, gas_price, gas_price - lag(gas_price) over (order by week) as price_change,
  cast(gas_price > 3 as int) as is_high_price from fuel""", "fuel", doubles="gas_price price_change")
def week_over_week(t: Tables):
    return ordering.week_over_week(t.fuel, "week", "gas_price")


@query("""select ride_id, tier, ['Underperforming', 'Moderate', 'Strong Value', 'Prime Investment'][tier + 1]
  as tier_name from (select ride_id, cast(case when price <= q[1] then 0 when price <= q[2] then 1 when price <= q[3]
  then 2 else 3 end as int) as tier from priced, (select quantile_cont(price, [0.3, 0.6, 0.9]) as q from priced))""",
       "priced")
def percentile_tiers(t: Tables):
    return decisions.investment_tiers(t.priced.select("ride_id", "price"), "price").select(
        "ride_id", "tier", "tier_name")
