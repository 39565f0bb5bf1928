"""Scans, sinks, payloads, reference tables and cleaning (S and C)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.catalog import features as ff
from larkspur.catalog.registry import query, view
from larkspur.functions import geo
from larkspur.functions.timeparts import hour_floor
from larkspur.operators import cleaning, encoding, evaluation, sampling, statistics
from larkspur.session import shared_dir
from larkspur.sources import files, pages, payloads, reference
from larkspur.sources.tables import SCHEMAS, Tables

C = F.col


def scratch_path(t: Tables, name: str) -> str:
    """A fresh folder under the shared directory of the session."""
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


# --- sources and sinks ----------------------------------------------------------
@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate from orders")
def scan_table(t: Tables):
    return scan_table_frame(t).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")


def scan_table_frame(t: Tables):
    return files.scan_parquet(t.spark, f"{t.folder}/orders.parquet", SCHEMAS["orders"])


@query("select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders", doubles="o_totalprice", digits=2)
def scan_csv_table(t: Tables):
    """Orders as a headered CSV, read with declared types."""
    path = scratch_path(t, "orders-csv")
    files.sink_dataset(scan_table_frame(t).select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"), path, "csv")
    return files.scan_csv(t.spark, path, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double")


@query("""select cab_type, count(*) as n, sum(price) as total_price, min(ts) as first_ts, max(ts) as last_ts
  from priced group by 1""", "priced", doubles="total_price", digits=3)
def sink_dataset(t: Tables):
    """Write CSV and parquet, read both back, and total what both hold."""
    dataset = t.priced.select("ride_id", "cab_type", "ts", "price")
    parquet, csv = scratch_path(t, "dataset"), scratch_path(t, "dataset-csv")
    files.sink_dataset(dataset, parquet)
    files.sink_dataset(files.scan_parquet(t.spark, parquet), csv, "csv")
    back = files.scan_csv(t.spark, csv, "ride_id bigint, cab_type string, ts timestamp_ntz, price double")
    both = files.scan_parquet(t.spark, parquet).join(back.select("ride_id"), "ride_id", "left_semi")
    return both.groupBy("cab_type").agg(
        F.count("*").alias("n"), F.sum("price").alias("total_price"), F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"))


@query("""select count(price) as n_target, min(price) as min_value, max(price) as max_value, avg(price) as mean_value,
  quantile_cont(price, 0.5) as median_value, cast(20 as int) as n_columns, count(*) as n_rows from rides""", "rides",
       doubles="mean_value median_value")
def table_profile(t: Tables):
    return statistics.table_profile(t.rides, "price")


MEASURES = {"temperature_2m": "temp_c", "relative_humidity_2m": "humidity", "precipitation": "precipitation",
            "wind_speed_10m": "wind_speed"}


@query("select * from hourly", "hourly")
def unpivot_hourly_payload(t: Tables):
    packed = payloads.pack_hourly(t.hourly, "hour_ts", MEASURES, F.to_date("hour_ts"))
    return payloads.unpivot_hourly(packed, "payload", MEASURES)


@query("""select block_id, Latitude as lat, Longitude as lon, cast(row_number() over (partition by block_id order by i)
  - 1 as int) as pos, Latitude + i / 10 as station_lat, Longitude - i / 10 as station_lon
  from blocks, (select unnest(range(6)) as i)""", "blocks", doubles="lat lon station_lat station_lon")
def nested_pick(t: Tables):
    """Positions from nested payloads: the first match, and the first six features of each zone."""
    near = F.array(*[
        F.struct(F.struct(F.lit("Point").alias("type"), F.array(
            C("Longitude") - F.lit(i) / 10, C("Latitude") + F.lit(i) / 10).alias("coordinates")).alias("geometry"))
        for i in range(8)])
    match = F.struct(F.array(C("Longitude"), C("Latitude")).alias("coordinates"))
    stored = t.blocks.select("block_id", F.to_json(F.struct(
        F.array(match).alias("addressMatches"), near.alias("features"))).alias("payload"))
    schema = ("addressMatches array<struct<coordinates: array<double>>>, "
              "features array<struct<geometry: struct<type: string, coordinates: array<double>>>>")
    first = payloads.first_match(C("payload"), schema, "addressMatches")
    parsed = stored.select("block_id", payloads.lat_lon(first["coordinates"]).alias("home"),
                           F.from_json("payload", schema)["features"].alias("features"))
    stations = payloads.leading_features(parsed, "features", ["block_id", "home"], 6)
    at = payloads.lat_lon(C("feature.geometry.coordinates"))
    return stations.where(C("feature.geometry.type") == "Point").select(
        "block_id", C("home.lat").alias("lat"), C("home.lon").alias("lon"), "pos",
        at["lat"].alias("station_lat"), at["lon"].alias("station_lon"))


TEXT_SQL = r"""regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'),
  '<[^>]*>', ' ', 'g')"""


@query(rf"""select page_id, title, number, cast(i - 1 as int) as item_no, hrefs[i] as href, texts[i] as link_text from (
  select page_id, trim(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)) as title,
    coalesce(try_cast(regexp_extract({TEXT_SQL}, '([0-9]+(?:\.[0-9]+)?)', 1) as double), 89.5e0) as number,
    regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) as hrefs,
    regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) as texts,
    unnest(case when len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1)) = 0 then [null]
      else range(1, 1 + len(regexp_extract_all(html, '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1))) end) as i
    from (select page_id, html from pages union all select -1 - page_id, replace(html, '<a ', '<i ') from pages where page_id % 10 = 0))
  """, doubles="number")
def html_field_extract(t: Tables):
    """Title, number and links of every page; every tenth page comes once more without its links."""
    raw = t.table("pages").select("page_id", "html")
    bare = raw.where("page_id % 10 = 0").select((-1 - C("page_id")).alias("page_id"), F.replace(C("html"), F.lit("<a "), F.lit("<i ")).alias("html"))
    fields = raw.unionByName(bare).select(
        "page_id", "html", F.coalesce(pages.element_text(C("html"), "h1"), F.lit("")).alias("title"),
        pages.number_of(pages.visible_text(C("html")), fv.FUEL_PRICE_DEFAULT).alias("number"))
    return pages.repeated_items(fields, "html", '<a [^>]*href="([^"]*)"[^>]*>([^<]*)</a>', ["href", "link_text"],
                                ["page_id", "title", "number"])


def _points_sql() -> str:
    return ", ".join(f"({i}, {lat}e0, {lon}e0)" for i, (lat, lon) in enumerate(fv.COAST_POINTS))


NEAREST_SQL = "list_min([" + ", ".join(
    f"{{'d': {ff.miles_sql('Latitude', 'Longitude', p)}, 'i': {i}}}" for i, p in enumerate(fv.COAST_POINTS)) + "])"
view("nearest", f"select *, {NEAREST_SQL} as near from blocks", "blocks")


@query(f"""select cast(p.point as int) as point, p.lat, p.lon, coalesce(n, 0) as n_blocks, coalesce(seen_lat, p.lat)
  as used_lat from (values {_points_sql()}) p(point, lat, lon) left join
  (select near.i as i, count(*) as n, avg(Latitude) as seen_lat from nearest group by 1) on i = p.point""", "nearest",
       doubles="lat lon used_lat", bigints="n_blocks")
def reference_points(t: Tables):
    """Coast points with the blocks nearest to each; an average position where blocks were seen."""
    near = geo.nearest_point()
    seen = geo.with_unit_vector(t.blocks, "Latitude", "Longitude").select(near["point"].alias("point"), "Latitude").groupBy("point").agg(
        F.count("*").alias("n"), F.avg("Latitude").alias("seen_lat"))
    return reference.coast_points(t.spark).join(seen, "point", "left").select(
        "point", "lat", "lon", F.coalesce("n", F.lit(0)).alias("n_blocks"),
        reference.with_fallback(C("seen_lat"), C("lat")).alias("used_lat"))


@query(f"""select block_id, zone as climate_zone, [{", ".join(f"'{n}'" for n in fv.ZONE_NAMES.values())}][zone] as zone_name
  from (select block_id, case when Latitude < 34 then 1 when Latitude < 36 then 2 when Latitude < 38 then 3 else 4 end as zone
  from blocks)""", "blocks")
def climate_zone_names(t: Tables):
    """Blocks with the name of their zone from the reference table."""
    zoned = t.blocks.select("block_id", geo.latitude_zone(C("Latitude")).alias("climate_zone"))
    return zoned.join(reference.climate_zones(t.spark), "climate_zone").select("block_id", "climate_zone", "zone_name")


@query(f"""select ride_id, condition, case condition {" ".join(f"when '{k}' then {v}e0" for k, v in fv.DELAY_PROBABILITY.items())} end
  as probability from (select ride_id, case when precipIntensity > 0 then 'rain' when isodow(ts) >= 6 then 'weekend'
  when hour(ts) between 7 and 9 then 'weekday_morning' when hour(ts) between 17 and 19 then 'weekday_evening' end as condition
  from rides)""", "rides", doubles="probability")
def delay_probability(t: Tables):
    """Rides with the published probability of a delay for their condition; NULL for the rest."""
    hour = F.hour("ts")
    condition = F.when(C("precipIntensity") > 0, "rain").when(F.weekday("ts") >= 5, "weekend").when(
        hour.between(7, 9), "weekday_morning").when(hour.between(17, 19), "weekday_evening")
    rides = t.rides.select("ride_id", condition.alias("condition"))
    return rides.join(reference.delay_probabilities(t.spark), "condition", "left").select("ride_id", "condition", "probability")


@query("select distinct event_type, cast(ts as date) as event_date from events")
def event_calendar_rows(t: Tables):
    """{type: [dates]} per day, built from events, to one row per type and date."""
    daily = t.table("events").select("event_type", F.to_date("ts").alias("d")).distinct()
    packed = daily.groupBy("d").agg(F.map_from_entries(
        F.collect_list(F.struct("event_type", F.array("d")))).alias("calendar"))
    return payloads.map_rows(packed, "calendar", "event_type", "event_date")


@query("""select name, m as metric, case m when 'n' then n when 'r2' then r2 when 'mae' then mae when 'mse' then mse
  else sqrt(mse) end as value from (select name, cast(count(*) as double) as n, 1 - avg((price - p) * (price - p))
    / var_pop(price) as r2, avg(abs(price - p)) as mae, avg((price - p) * (price - p)) as mse from predicted group by 1),
  (select unnest(['n', 'r2', 'mae', 'mse', 'rmse']) as m)""", "predicted", doubles="value")
def results_table(t: Tables):
    from larkspur.catalog.models import predicted
    metrics = evaluation.regression_metrics(predicted(t), "price", "p", ["name"])
    return evaluation.results_rows(metrics, ["name"], ["n", "r2", "mae", "mse", "rmse"])


# --- cleaning -------------------------------------------------------------------
@query("select ride_id, price, distance, surge_multiplier from rides where price is not null and distance is not null "
       "and surge_multiplier is not null", "rides")
def drop_null_subset(t: Tables):
    return cleaning.drop_null_subset(t.rides, ["price", "distance", "surge_multiplier"]).select(
        "ride_id", "price", "distance", "surge_multiplier")


@query("select ride_id, price from rides where price > 0", "rides")
def positive_filter(t: Tables):
    return cleaning.positive_filter(t.rides, "price").select("ride_id", "price")


CAP = 4.9


def _rules():
    return {
        "value_cap": C("MedHouseVal") < CAP, "occupancy_cap": C("AveOccup") <= fv.HOUSING_CAPS["AveOccup"],
        "rooms_cap": C("AveRooms") <= fv.HOUSING_CAPS["AveRooms"],
        "bedrooms_cap": C("AveBedrms") <= fv.HOUSING_CAPS["AveBedrms"]}


RULE_SQL = """case when not MedHouseVal < 4.9e0 then 'value_cap' when not AveOccup <= 10 then 'occupancy_cap'
  when not AveRooms <= 15 then 'rooms_cap' when not AveBedrms <= 5 then 'bedrooms_cap' else 'kept' end"""
view("kept_blocks", f"select * from blocks where {RULE_SQL} = 'kept'", "blocks")


@query(f"""select rule, count(k) as n_rows from (select unnest(['value_cap', 'occupancy_cap', 'rooms_cap',
  'bedrooms_cap', 'kept']) as rule) left join (select {RULE_SQL} as k from blocks) on k = rule group by 1""", "blocks")
def range_outlier_filters(t: Tables):
    return cleaning.rule_removals(t.blocks, _rules())


@query("select block_id, MedHouseVal from kept_blocks", "kept_blocks", name="range_outlier_rows")
def range_outlier_rows(t: Tables):
    return cleaning.range_filters(t.blocks, _rules()).select("block_id", "MedHouseVal")


BAND_SQL = """case when price <= 10 then 'low' when price <= 15 then 'mid' when price <= 25 then 'high'
  when price <= 1000 then 'premium' else 'nan' end"""
view("strata", f"select *, cab_type || '_' || name || '_' || {BAND_SQL} as stratum from priced", "priced")
view("dest_strata", "select *, cab_type || '_' || destination || '_' || source as stratum from priced", "priced")


def strata(t: Tables):
    from larkspur.functions.distance import price_band
    return t.priced.withColumn("stratum", sampling.strata_key(C("cab_type"), C("name"), price_band(C("price"))))


def fine_strata(t: Tables):
    """Platform, destination and source: many strata, some of them rare."""
    return t.priced.withColumn("stratum", sampling.strata_key(C("cab_type"), C("destination"), C("source")))


@query("""select ride_id, stratum, stratum_n from (select ride_id, stratum, count(*) over (partition by stratum)
  as stratum_n from dest_strata) where stratum_n >= 10""", "dest_strata")
def rare_stratum_filter(t: Tables):
    return cleaning.rare_stratum_filter(fine_strata(t), "stratum").select("ride_id", "stratum", "stratum_n")


@query("""select name, count(*) as n, avg(price) as mean, stddev_samp(price) as std from priced
  where name in ('click', 'view', 'purchase') group by 1""", "priced", doubles="mean std")
def segment_filter(t: Tables):
    return statistics.group_stats(cleaning.segment_filter(t.priced, "name", ["click", "view", "purchase"]),
                                  ["name"], "price")


GEO_COLUMNS = ", ".join(f"('{c}')" for c in fv.GEO_ENRICHMENT)


@query(f"""select c as column_name, n_null, cast(n_null = 0 as int) as passed from (
  select unnest([{', '.join(f"'{c}'" for c in fv.GEO_ENRICHMENT)}]) as c,
         unnest([{', '.join(f"count(*) filter ({c} is null)" for c in fv.GEO_ENRICHMENT)}]) as n_null from geo)""",
       "geo")
def not_null_validation(t: Tables):
    return cleaning.not_null_validation(ff.geo_features(t.blocks), fv.GEO_ENRICHMENT)


@query("""select count(*) as rows_before, count(*) filter (price > 0) as rows_after,
  count(*) - count(*) filter (price > 0) as rows_removed, count(*) filter (price > 0 and price is null) as nulls_left
  from rides""", "rides")
def drop_report(t: Tables):
    return cleaning.drop_report(t.rides, C("price") > 0, "price")


@query("""select unnest(['negative_distance', 'non_positive_price', 'missing_price', 'surge_below_one']) as rule,
  unnest([count(*) filter (distance < 0), count(*) filter (price <= 0), count(*) filter (price is null),
          count(*) filter (surge_multiplier < 1)]) as n_violations from rides""", "rides")
def range_checks(t: Tables):
    return cleaning.range_checks(t.rides, {
        "negative_distance": C("distance") < 0, "non_positive_price": C("price") <= 0,
        "missing_price": C("price").isNull(), "surge_below_one": C("surge_multiplier") < 1})


view("zone_hours", """select source, date_trunc('hour', ts) as hour_ts, avg(temperature) as temp from rides group by 1, 2""",
     "rides")
view("zone_grid", """select g.source, g.hour_ts, temp from (select source, unnest(generate_series(a, b, interval 1 hour))
  as hour_ts from (select source, min(hour_ts) as a, max(hour_ts) as b from zone_hours group by 1)) g
  left join zone_hours z on g.source = z.source and g.hour_ts = z.hour_ts""", "zone_hours")


@query("""select source, hour_ts, temp, v0 as temp_filled, case when epoch(t1) = epoch(t0) then v0
  else v0 + (v1 - v0) * ((epoch(hour_ts) - epoch(t0)) / (epoch(t1) - epoch(t0))) end as temp_linear from (
  select *, last_value(temp ignore nulls) over back as v0, first_value(temp ignore nulls) over ahead as v1,
    last_value(case when temp is not null then hour_ts end ignore nulls) over back as t0,
    first_value(case when temp is not null then hour_ts end ignore nulls) over ahead as t1 from zone_grid
  window back as (partition by source order by hour_ts rows between unbounded preceding and current row),
         ahead as (partition by source order by hour_ts rows between current row and unbounded following))""",
       "zone_grid", doubles="temp temp_filled temp_linear")
def fill_gaps(t: Tables):
    """Mean temperature per zone and hour; hours without rides are filled."""
    hour = hour_floor(C("ts"))
    series = t.rides.groupBy("source", hour.alias("hour_ts")).agg(F.avg("temperature").alias("temp"))
    return cleaning.fill_gaps(series, "hour_ts", "temp", ["source"])


@query("select ride_id, distance, surge_multiplier, temperature, humidity from rides", "rides")
def feature_select(t: Tables):
    return cleaning.feature_select(t.rides, ["ride_id", "distance", "surge_multiplier", "snow", "temperature",
                                             "humidity", "gust_direction"])


@query("select ride_id, distance, temperature, humidity, 'surge_multiplier,name' as removed from rides", "rides")
def leakage_exclude(t: Tables):
    wide = t.rides.select("ride_id", "distance", "surge_multiplier", "name", "temperature", "humidity")
    kept, removed = cleaning.leakage_exclude(wide)
    return kept.withColumn("removed", F.lit(",".join(removed)))


@query(f"""select r.ride_id, 'regression' as task, source_code as source, distance, price, cast(null as int) as is_premium
  from coded r union all select r.ride_id, 'classification', source_code, distance, null, {ff.PREMIUM} from coded r""",
       "coded", doubles="price")
def task_split(t: Tables):
    from larkspur.functions.ride import premium_by_pattern
    df = t.priced.withColumn("is_premium", premium_by_pattern(C("name"), ff.SERVICES))
    codes = encoding.fit_dictionary(df, ["source"])
    coded = encoding.apply_dictionary(df, codes, ["source"]).select(
        "ride_id", "source_encoded", "distance", "surge_multiplier", "price", "is_premium")
    regression, classes = cleaning.task_split(
        coded, ["source_encoded", "distance", "surge_multiplier"], "price", "is_premium", ["ride_id"])
    return regression.drop("surge_multiplier").withColumn("task", F.lit("regression")).unionByName(
        classes.withColumn("task", F.lit("classification")), allowMissingColumns=True)


view("coded", "select *, cast(dense_rank() over (order by source) - 1 as int) as source_code from priced", "priced")
