"""Scalar features (F1-F37)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.catalog.registry import query, view
from larkspur.functions import distance as fd
from larkspur.functions import geo, housing, ride, timeparts as tp, weather
from larkspur.operators import ordering
from larkspur.operators.cleaning import optional_column
from larkspur.operators.skew import lookup_join, sent_if_few
from larkspur.plans import housing as plans_housing
from larkspur.session import cut_lineage, stored
from larkspur.sources import reference, synth
from larkspur.sources.tables import Tables

C = F.col
SERVICES = "purchase|signup"

# --- SQL fragments shared by several counterparts --------------------------
HOUR, DOW = "cast(hour(ts) as int)", "cast(isodow(ts) - 1 as int)"
WEEKEND = "cast(isodow(ts) >= 6 as int)"
MORNING = "cast(hour(ts) between 7 and 9 and isodow(ts) < 6 as int)"
EVENING = "cast(hour(ts) between 17 and 19 and isodow(ts) < 6 as int)"
RUSH = "cast((hour(ts) between 7 and 9 or hour(ts) between 17 and 19) and isodow(ts) < 6 as int)"
NIGHT = "cast(hour(ts) >= 22 or hour(ts) <= 5 as int)"
RAINY = "cast(precipIntensity > 0 as int)"
COLD = "cast(temperature < 40 as int)"
HUMID = "cast(humidity > 0.8e0 as int)"
LOWVIS = "cast(visibility < 3 as int)"
LOWPRESS = "cast(pressure < 1005 as int)"
HIGHWIND = "cast(windGust > 20 as int)"
HIGHPREC = "cast(precipProbability > 0.5e0 as int)"
PREMIUM = "coalesce(cast(regexp_matches(name, '(?i)purchase|signup') as int), 0)"


def miles_sql(lat: str, lon: str, point: tuple[float, float]) -> str:
    a, b = f"{point[0]}e0", f"{point[1]}e0"
    half_lat = f"sin((radians({a}) - radians({lat})) / 2)"
    half_lon = f"sin((radians({b}) - radians({lon})) / 2)"
    return (f"2 * 3959 * asin(sqrt({half_lat} * {half_lat} + cos(radians({lat})) * cos(radians({a})) "
            f"* {half_lon} * {half_lon}))")


COAST_SQL = "least(" + ", ".join(miles_sql("Latitude", "Longitude", p) for p in fv.COAST_POINTS) + ")"
CITY_SQL = ", ".join(f"{miles_sql('Latitude', 'Longitude', p)} as dist_{n}" for n, p in fv.CITIES.items())
NEAREST_CITY_SQL = "least(" + ", ".join(f"dist_{n}" for n in fv.CITIES) + ")"
ZONE_SQL = "case when Latitude < 34 then 1 when Latitude < 36 then 2 when Latitude < 38 then 3 else 4 end"

view("located", f"select *, {COAST_SQL} as dist_to_coast, {CITY_SQL} from blocks", "blocks")
view("geo", f"""select *, {NEAREST_CITY_SQL} as dist_nearest_city, cast(dist_to_coast < 30 as int) as is_coastal,
  cast(dist_SF < 50 as int) as is_bay_area, cast(dist_LA < 60 as int) as is_socal, {ZONE_SQL} as climate_zone,
  MedInc * (1 / (dist_to_coast + 1)) as income_coast_interaction, Population / (AveOccup + 0.1e0) as urban_density,
  MedInc * cast(dist_to_coast < 30 as int) as coastal_income from located""", "located")


geo_features = plans_housing.enrich


def clock(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Hour, weekday, weekend, rush and night columns."""
    parts = tp.time_parts(C(ts))
    timed = df.withColumns({"hour": parts["hour"], "day_of_week": parts["day_of_week"]})
    weekend = tp.weekend_flag(C("day_of_week"))
    return timed.withColumns(
        {"is_weekend": weekend, "is_night": tp.night_flag(C("hour"))} | tp.rush_flags(C("hour"), weekend))


def weathered(df: DataFrame) -> DataFrame:
    flags = weather.weather_flags(C("precipIntensity"), C("temperature"), C("humidity"), humid=0.8)
    extra = weather.extended_flags(*[C(c) for c in (
        "temperature", "apparentTemperature", "visibility", "precipProbability", "pressure", "windGust",
        "cloudCover")])
    return df.withColumns(flags | extra)


# --- time -------------------------------------------------------------------
@query(f"""select ride_id, {HOUR} as hour, cast(day(ts) as int) as day, {DOW} as day_of_week,
  cast(month(ts) as int) as month from rides""", "rides")
def time_parts(t: Tables):
    return t.rides.select("ride_id", *[c.alias(n) for n, c in tp.time_parts(C("ts")).items()])


@query(f"select ride_id, {WEEKEND} as is_weekend from rides", "rides")
def weekend_flag(t: Tables):
    return t.rides.select("ride_id", tp.weekend_flag(F.weekday("ts")).alias("is_weekend"))


@query(f"""select ride_id, {MORNING} as is_morning_rush, {EVENING} as is_evening_rush, {RUSH} as is_rush_hour,
  {RUSH} as rush_compact from rides""", "rides")
def rush_flags(t: Tables):
    weekend, hour = tp.weekend_flag(F.weekday("ts")), F.hour("ts")
    flags = tp.rush_flags(hour, weekend) | {"rush_compact": tp.rush_compact(hour, weekend)}
    return t.rides.select("ride_id", *[c.alias(n) for n, c in flags.items()])


@query(f"""select ride_id, {NIGHT} as is_night, cast(hour(ts) >= 20 or hour(ts) < 5 as int) as is_night_early,
  cast(hour(ts) < 4 as int) as is_late_night, cast(hour(ts) < 6 as int) as is_night_after_midnight,
  cast((hour(ts) >= 20 or hour(ts) < 5) and isodow(ts) >= 6 as int) as weekend_night from rides""", "rides")
def night_flags(t: Tables):
    flags = tp.night_flags(F.hour("ts"), tp.weekend_flag(F.weekday("ts")))
    return t.rides.select("ride_id", *[c.alias(n) for n, c in flags.items()])


@query("""select flight_id, cast(hour >= 5 and hour < 8 as int) as is_early_morning,
  cast(hour >= 8 and hour < 12 as int) as is_morning, cast(hour >= 12 and hour < 16 as int) as is_afternoon,
  cast(hour >= 16 and hour < 20 as int) as is_evening, cast(hour >= 20 or hour < 5 as int) as is_night
  from flights""", "flights")
def day_part_flags(t: Tables):
    return t.flights.select("flight_id", *[c.alias(n) for n, c in tp.day_part_flags(C("hour")).items()])


@query("""select flight_id, cast(month in (12, 1, 2) as int) as is_winter, cast(month in (3, 4, 5) as int) as is_spring,
  cast(month in (6, 7, 8) as int) as is_summer, cast(month in (9, 10, 11) as int) as is_fall, 0 as is_weekend
  from flights""", "flights")
def season_flags(t: Tables):
    return t.flights.select("flight_id", *[c.alias(n) for n, c in tp.season_flags(C("month")).items()])


@query("""select o_orderkey, cast(hour(o_orderdate) between 9 and 17 and isodow(o_orderdate) < 6 as int)
  as is_business_hours, cast(week(o_orderdate) as int) as week_of_year, cast(quarter(o_orderdate) as int) as quarter
  from orders""")
def calendar_extras(t: Tables):
    extras = tp.calendar_extras(C("o_orderdate"))
    return t.table("orders").select("o_orderkey", *[c.alias(n) for n, c in extras.items()])


@query(f"""select ride_id, sin(hour(ts) * (2 * pi() / 24)) as hour_sin, cos(hour(ts) * (2 * pi() / 24)) as hour_cos,
  sin({DOW} * (2 * pi() / 7)) as dow_sin, cos({DOW} * (2 * pi() / 7)) as dow_cos from rides""", "rides",
       doubles="hour_sin hour_cos dow_sin dow_cos")
def cyclic_encoding(t: Tables):
    circle = tp.cyclic_encoding(F.hour("ts"), F.weekday("ts"))
    return t.rides.select("ride_id", *[c.alias(n) for n, c in circle.items()])


# --- distance and bands -------------------------------------------------------
@query("""select ride_id, cast(distance < 2 as int) as short_ride, cast(distance >= 2 and distance < 5 as int)
  as medium_ride, cast(distance >= 5 as int) as long_ride, case when distance < 2 then 'short (<2)'
  when distance < 5 then 'medium (2-5)' else 'long (>=5)' end as ride_length from rides""", "rides")
def distance_bands(t: Tables):
    bands = fd.ride_bands(C("distance")) | {"ride_length": fd.band_label(C("distance"))}
    return t.rides.select("ride_id", *[c.alias(n) for n, c in bands.items()])


@query("""select flight_id, cast(distance < 500 as int) as short_haul, cast(distance >= 500 and distance < 1500 as int)
  as medium_haul, cast(distance >= 1500 as int) as long_haul from flights""", "flights")
def haul_bands(t: Tables):
    return t.flights.select("flight_id", *[c.alias(n) for n, c in fd.haul_bands(C("distance")).items()])


@query("""select block_id, ln(1 + Population) as log_population, ln(1 + MedInc) as log_income,
  ln(1 + MedHouseVal) as log_value from blocks""", "blocks", doubles="log_population log_income log_value")
def log_transforms(t: Tables):
    return t.blocks.select("block_id", F.log1p("Population").alias("log_population"),
                           F.log1p("MedInc").alias("log_income"), F.log1p("MedHouseVal").alias("log_value"))


@query("select ride_id, ln(1 + distance) as log_distance, distance * distance as distance_sq from rides", "rides",
       doubles="log_distance distance_sq")
def polynomial_scalar(t: Tables):
    return t.rides.select("ride_id", F.log1p("distance").alias("log_distance"),
                          F.pow("distance", F.lit(2)).alias("distance_sq"))


@query("""select ride_id, case when price > 0 and price <= 10 then 'low' when price > 10 and price <= 15 then 'mid'
  when price > 15 and price <= 25 then 'high' when price > 25 and price <= 1000 then 'premium' end as band_wide,
  case when price > 0 and price <= 10 then 'low' when price > 10 and price <= 15 then 'mid'
  when price > 15 and price <= 25 then 'high' when price > 25 and price <= 100 then 'premium' end as band_narrow
  from rides""", "rides")
def fixed_bands(t: Tables):
    return t.rides.select("ride_id", fd.price_band(C("price")).alias("band_wide"),
                          fd.price_band(C("price"), top=100).alias("band_narrow"))


view("tiered", """select p.*, cast(case when price <= q[1] then 0 when price <= q[2] then 1 when price <= q[3] then 2
  else 3 end as int) as tier from priced p, (select quantile_cont(price, [0.25, 0.5, 0.75]) as q from priced)""",
     "priced")
TIER_NAME_SQL = "['Budget', 'Economy', 'Premium', 'Luxury'][tier + 1]"


@query(f"""select tier, {TIER_NAME_SQL} as tier_name, count(*) as n, count(*) / (select count(*) from priced) as share,
  min(price) as min_value, max(price) as max_value from tiered group by 1, 2""", "tiered", doubles="share")
def quantile_tiers(t: Tables):
    return ordering.tier_summary(ordering.quantile_tiers(t.priced, "price"), "price")


@query(f"select ride_id, tier, {TIER_NAME_SQL} as tier_name from tiered", "tiered")
def quantile_tier_rows(t: Tables):
    return ordering.quantile_tiers(t.priced, "price").select("ride_id", "tier", "tier_name")


@query("""select block_id, cast(MedHouseVal > (select quantile_cont(MedHouseVal, 0.5) from blocks) as int)
  as is_high_value from blocks""", "blocks")
def median_split_target(t: Tables):
    return t.blocks.select("block_id", ordering.above_median(t.blocks, "MedHouseVal").alias("is_high_value"))


view("flights_delay", "select f.*, m.avgdelay from flights f left join (select carrier, avg(arr_delay) as avgdelay from flights "
     "group by 1) m on f.carrier = m.carrier", "flights")


@query("""select *, cast(hour >= 8 and hour < 12 as int) * high_traffic_route as morning_busy_route,
  cast(month in (12, 1, 2) and distance >= 1500 as int) as winter_long_haul
  from (select flight_id, hour, month, distance,
    cast(totflight > (select quantile_cont(totflight, 0.5) from flights_delay) as int) as high_traffic_route,
    cast(avgdelay > (select quantile_cont(avgdelay, 0.5) from flights_delay) as int) as high_avg_delay_route
    from flights_delay)""", "flights_delay", doubles="distance")
def median_flag_feature(t: Tables):
    flights = stored(t.flights.select("flight_id", "carrier", "hour", "month", "distance", "totflight", "arr_delay"))
    means = cut_lineage(flights.groupBy("carrier").agg(F.avg("arr_delay").alias("avgdelay")))
    df = lookup_join(flights, sent_if_few(means), ["carrier"])
    busy = ordering.above_median(df, "totflight") if "totflight" in df.columns else F.lit(0)
    late = ordering.above_median(df, "avgdelay") if "avgdelay" in df.columns else F.lit(0)
    out = df.select("flight_id", "hour", "month", "distance", busy.alias("high_traffic_route"),
                    late.alias("high_avg_delay_route"))
    return out.withColumns({
        "morning_busy_route": tp.day_part_flags(C("hour"))["is_morning"] * C("high_traffic_route"),
        "winter_long_haul": tp.season_flags(C("month"))["is_winter"] * fd.haul_bands(C("distance"))["long_haul"]})


@query("""select ride_id, cast(surge_multiplier > 1 as int) as is_surging, cast(cab_type = 'A' as int) as is_platform_a
  from rides""", "rides")
def threshold_target(t: Tables):
    return t.rides.select("ride_id", tp.flag(C("surge_multiplier") > 1.0).alias("is_surging"),
                          tp.flag(C("cab_type") == "A").alias("is_platform_a"))


# --- weather ------------------------------------------------------------------
@query(f"""select ride_id, {RAINY} as is_rainy, {COLD} as is_cold, cast(temperature > 75 as int) as is_hot,
  cast(humidity > 70 as int) as is_high_humidity, {HUMID} as is_humid_share from rides""", "rides")
def weather_flags(t: Tables):
    flags = weather.weather_flags(C("precipIntensity"), C("temperature"), C("humidity"))
    share = weather.weather_flags(C("precipIntensity"), C("temperature"), C("humidity"), humid=0.8)
    return t.rides.select("ride_id", *[c.alias(n) for n, c in flags.items()],
                          share["is_high_humidity"].alias("is_humid_share"))


@query(f"""select ride_id, apparentTemperature - temperature as wind_chill, {LOWVIS} as low_visibility,
  {HIGHPREC} as high_precip_prob, {LOWPRESS} as low_pressure, {HIGHWIND} as high_wind,
  cast(windGust > 15 as int) as high_gust, cast(cloudCover > 0.8e0 as int) as overcast from rides""", "rides",
       doubles="wind_chill")
def weather_extended_flags(t: Tables):
    return weathered(t.rides).select("ride_id", "wind_chill", "low_visibility", "high_precip_prob", "low_pressure",
                                     "high_wind", "high_gust", "overcast")


@query(f"""select ride_id, {RAINY} + {COLD} + {HUMID} as weather_severity, {RAINY} + {COLD} as weather_severity_two,
  {RAINY} + {COLD} + {LOWVIS} + {HIGHWIND} as severe_weather,
  {LOWVIS} + {LOWPRESS} + {HIGHWIND} + {HIGHPREC} as severe_composite,
  2 * {RAINY} + {COLD} + {HUMID} as weather_severity_enhanced,
  cast(2 * {RAINY} + {COLD} + {HUMID} >= 2 as int) as is_adverse_weather from rides""", "rides")
def severity_scores(t: Tables):
    scores = weather.severity_scores(*[C(c) for c in (
        "is_rainy", "is_cold", "is_high_humidity", "low_visibility", "high_wind", "low_pressure",
        "high_precip_prob")])
    return weathered(t.rides).select("ride_id", *[c.alias(n) for n, c in scores.items()])


@query("""select hour_ts, cast(precipitation > 0 as int) as is_raining, cast(precipitation > 5 as int) as is_heavy_rain,
  cast(temp_c < 5 as int) as is_cold, cast(temp_c > 30 as int) as is_hot, cast(wind_speed > 20 as int) as is_windy,
  cast(precipitation > 0 and wind_speed > 20 as int) as is_storm,
  cast(precipitation > 0 as int) + cast(precipitation > 5 as int) + cast(temp_c < 5 as int) + cast(temp_c > 30 as int)
    + cast(wind_speed > 20 as int) as weather_severity_score from hourly""", "hourly")
def hourly_weather_severity(t: Tables):
    flags = weather.hourly_severity(C("temp_c"), C("precipitation"), C("wind_speed"))
    return t.hourly.select("hour_ts", *[c.alias(n) for n, c in flags.items()])


# --- interactions -------------------------------------------------------------
@query(f"""select ride_id, distance * surge_multiplier as distance_surge, {RAINY} * surge_multiplier as weather_surge,
  {RUSH} * surge_multiplier as rush_surge, ({RAINY} + {COLD} + {HUMID}) * surge_multiplier as severity_surge,
  distance * 1e0 as distance_no_surge from rides""", "rides",
       doubles="distance_surge weather_surge rush_surge severity_surge distance_no_surge")
def surge_interactions(t: Tables):
    df = weathered(clock(t.rides))
    severity = C("is_rainy") + C("is_cold") + C("is_high_humidity")
    args = (C("is_rainy"), C("is_rush_hour"), severity)
    with_surge = ride.surge_interactions(C("distance"), C("surge_multiplier"), *args)
    without = ride.surge_interactions(C("distance"), None, *args)
    return df.select("ride_id", *[c.alias(n) for n, c in with_surge.items()],
                     without["distance_surge"].alias("distance_no_surge"))


@query(f"""select ride_id, {RAINY} * {RUSH} as rain_rush, {COLD} * {NIGHT} as cold_night, {RAINY} * {NIGHT} as rain_night,
  ({RAINY} + {COLD} + {LOWVIS} + {HIGHWIND}) * {RUSH} as bad_weather_rush, precipProbability * {RUSH} as precip_rush,
  visibility * distance as visibility_distance, {LOWPRESS} * {RAINY} as storm_indicator from rides""", "rides",
       doubles="precip_rush visibility_distance")
def condition_interactions(t: Tables):
    df = weathered(clock(t.rides))
    severe = C("is_rainy") + C("is_cold") + C("low_visibility") + C("high_wind")
    products = ride.condition_interactions(
        C("is_rainy"), C("is_cold"), C("is_rush_hour"), C("is_night"), severe, C("precipProbability"),
        C("visibility"), C("distance"), C("pressure"))
    return df.select("ride_id", *[c.alias(n) for n, c in products.items()])


@query(f"""select ride_id, {PREMIUM} as is_premium, cast(cab_type = 'A' as int) * {PREMIUM} as a_premium,
  cast(cab_type = 'B' as int) * {PREMIUM} as b_premium from rides""", "rides")
def premium_by_pattern(t: Tables):
    premium = ride.premium_by_pattern(C("name"), SERVICES)
    return t.rides.select("ride_id", premium.alias("is_premium"),
                          (tp.flag(C("cab_type") == "A") * premium).alias("a_premium"),
                          (tp.flag(C("cab_type") == "B") * premium).alias("b_premium"))


@query("""select ride_id, cast(cab_type = 'A' and name in ('purchase') as int) as a_premium,
  cast(cab_type = 'B' and name in ('purchase', 'signup') as int) as b_premium,
  cast((cab_type = 'A' and name in ('purchase')) or (cab_type = 'B' and name in ('purchase', 'signup')) as int)
  as is_premium from rides""", "rides")
def premium_by_list(t: Tables):
    flags = ride.premium_by_list(C("cab_type"), C("name"), {"A": ["purchase"], "B": ["purchase", "signup"]})
    return t.rides.select("ride_id", *[c.alias(n) for n, c in flags.items()])


@query("""select ride_id, source || '_' || destination as route, source || '_to_' || destination as route_to
  from rides""", "rides")
def route_key(t: Tables):
    return t.rides.select("ride_id", ride.route_key(C("source"), C("destination")).alias("route"),
                          ride.route_key(C("source"), C("destination"), "_to_").alias("route_to"))


# --- housing and geography ------------------------------------------------------
@query("""select block_id, AveBedrms / (AveRooms + 0.001e0) as bedroom_ratio, AveRooms / (AveOccup + 0.001e0)
  as rooms_per_person, Population / (AveOccup + 0.001e0) as pop_density, Population / (AveOccup + 0.1e0)
  as urban_density from blocks""", "blocks", doubles="bedroom_ratio rooms_per_person pop_density urban_density")
def housing_ratios(t: Tables):
    ratios = housing.housing_ratios(C("AveBedrms"), C("AveRooms"), C("AveOccup"), C("Population"))
    return t.blocks.select("block_id", *[c.alias(n) for n, c in ratios.items()])


@query("""select block_id, cast(HouseAge <= 10 as int) as is_new_house, cast(HouseAge >= 40 as int) as is_old_house,
  cast(MedInc < 3 as int) as is_low_income, cast(MedInc > 6 as int) as is_high_income,
  cast(AveOccup > 3.5e0 as int) as is_crowded from blocks""", "blocks")
def housing_flags(t: Tables):
    flags = housing.housing_flags(C("HouseAge"), C("MedInc"), C("AveOccup"))
    return t.blocks.select("block_id", *[c.alias(n) for n, c in flags.items()])


@query("""select block_id, MedInc * HouseAge as income_age, MedInc * AveRooms as income_rooms,
  income_coast_interaction, coastal_income from geo""", "geo",
       doubles="income_age income_rooms income_coast_interaction coastal_income")
def housing_interactions(t: Tables):
    df = geo.with_unit_vector(t.blocks, "Latitude", "Longitude").withColumn("dist_to_coast", geo.nearest_miles())
    coastal = tp.flag(C("dist_to_coast") < fv.COASTAL_MILES)
    products = housing.housing_interactions(C("MedInc"), C("HouseAge"), C("AveRooms"), C("dist_to_coast"), coastal)
    return df.select("block_id", *[c.alias(n) for n, c in products.items()])


@query(f"""select block_id, {miles_sql('Latitude', 'Longitude', fv.CITIES['SF'])} as miles from blocks""", "blocks",
       doubles="miles")
def haversine_miles(t: Tables):
    lat, lon = fv.CITIES["SF"]
    return t.blocks.select("block_id", geo.haversine_miles(
        C("Latitude"), C("Longitude"), F.lit(lat), F.lit(lon)).alias("miles"))


@query("select block_id, is_coastal, is_bay_area, is_socal from geo", "geo")
def region_flags(t: Tables):
    return geo_features(t.blocks).select("block_id", "is_coastal", "is_bay_area", "is_socal")


@query(f"select block_id, {ZONE_SQL} as climate_zone from blocks", "blocks")
def latitude_zone(t: Tables):
    return t.blocks.select("block_id", geo.latitude_zone(C("Latitude")).alias("climate_zone"))


# --- enrichment -----------------------------------------------------------------
EVENT_TIME = "cast(hour(ts) in (22, 23) and isodow(ts) < 6 as int)"


@query(f"""select ride_id, {EVENT_TIME} as is_event_time,
  cast(hour(ts) in (21, 22, 23) and isodow(ts) < 6 as int) as is_event_time_wide from rides""", "rides")
def event_window_flag(t: Tables):
    flags = ride.event_window_flag(C("hour"), C("is_night"), C("is_weekend"))
    return clock(t.rides).select("ride_id", *[c.alias(n) for n, c in flags.items()])


@query(f"select ride_id, {RUSH} * {RAINY} as likely_transit_delay from rides", "rides")
def transit_delay_flag(t: Tables):
    return weathered(clock(t.rides)).select(
        "ride_id", ride.transit_delay_flag(C("is_rush_hour"), C("is_rainy")).alias("likely_transit_delay"))


ZONES = ["NATION_1", "NATION_5", "NATION_9"]


@query("""select ride_id, cast(source in ('NATION_1', 'NATION_5', 'NATION_9') as int) as is_high_demand_zone
  from rides""", "rides")
def demand_zone_flag(t: Tables):
    return t.rides.select("ride_id", ride.demand_zone_flag(C("source"), ZONES).alias("is_high_demand_zone"))


@query("""select ride_id, cast(distance > 5 and surge_multiplier > 1 as int) as fuel_price_indicator,
  cast(distance > 5 as int) as fuel_price_indicator_distance from rides""", "rides")
def fuel_indicator(t: Tables):
    return t.rides.select(
        "ride_id", ride.fuel_indicator(C("distance"), C("surge_multiplier")).alias("fuel_price_indicator"),
        ride.fuel_indicator(C("distance")).alias("fuel_price_indicator_distance"))


@query(f"""select ride_id, distance * {EVENT_TIME} as distance_event_interaction, {RAINY} * {RUSH}
  as weather_rush_interaction, cast(cab_type = 'B' as int) * {RAINY} as cab_weather_interaction,
  {PREMIUM} * {RAINY} as premium_weather_interaction from rides""", "rides",
       doubles="distance_event_interaction")
def enrichment_interactions(t: Tables):
    df = weathered(clock(t.rides))
    event = ride.event_window_flag(C("hour"), C("is_night"), C("is_weekend"))["is_event_time"]
    products = ride.enrichment_interactions(
        C("distance"), event, C("is_rainy"), C("is_rush_hour"), tp.flag(C("cab_type") == "B"),
        ride.premium_by_pattern(C("name"), SERVICES))
    return df.select("ride_id", *[c.alias(n) for n, c in products.items()])


def uniform_sql(key: str, stream: str) -> str:
    digest = f"md5(concat(cast({key} as varchar), ':{stream}'))"
    return f"(cast(cast('0x' || substr({digest}, 1, 8) as ubigint) as double) / 4294967296)"


def _vehicle_sql(key: str) -> str:
    u = uniform_sql(key, "vehicle")
    return f"case when {u} < 1e0 / 3 then 'Rickshaw' when {u} < 2e0 / 3 then 'UberGo' else 'Premier' end"


view("synth", f"""select event_id as ride_id, 1 + {uniform_sql('event_id', 'distance')} * 24 as distance_km,
  cast(floor({uniform_sql('event_id', 'hour')} * 24) as int) as hour,
  cast({uniform_sql('event_id', 'monsoon')} < 0.2e0 as int) as is_monsoon, {_vehicle_sql('event_id')} as vehicle_type,
  case when {uniform_sql('event_id', 'traffic')} < 0.5e0 then 1e0 when {uniform_sql('event_id', 'traffic')} < 0.8e0
  then 1.5e0 else 2e0 end as traffic_level from events""")


def synthetic(t: Tables) -> DataFrame:
    return synth.synth_rides(t.table("events").select(C("event_id").alias("ride_id")), "ride_id")


@query("select * from synth", "synth", doubles="distance_km")
def synth_rides(t: Tables):
    return synthetic(t)


def fares(t: Tables) -> DataFrame:
    rated = synthetic(t).join(F.broadcast(reference.fare_rates(t.spark)), "vehicle_type")
    fare = ride.fare_formula(C("distance_km"), C("rate"), C("hour"), C("is_monsoon"), C("traffic_level"))
    return rated.withColumn("fare", fare)


@query("""select ride_id, vehicle_type, (distance_km * case vehicle_type when 'Rickshaw' then 15 when 'UberGo'
  then 18 else 25 end + 89.5e0 * 0.05e0) * case when hour in (8, 9, 17, 18) then 1.4e0 else 1e0 end
  * case when is_monsoon = 1 then 1.3e0 else 1e0 end * traffic_level as fare from synth""", "synth", doubles="fare")
def fare_formula(t: Tables):
    return fares(t).select("ride_id", "vehicle_type", "fare")


@query(f"""select ride_id, {RAINY} as is_rainy, {HUMID} as is_humid, 0 as is_snowy from rides""", "rides", name="optional_column")
def optional_column_flags(t: Tables):
    rain = optional_column(t.rides, ["precipIntensity", "rain"], 0.0)
    humid = optional_column(t.rides, ["humidity"], 0.0)
    snow = optional_column(t.rides, ["snow", "snowDepth"], 0.0)
    return t.rides.select("ride_id", tp.flag(rain > 0).alias("is_rainy"), tp.flag(humid > 0.8).alias("is_humid"),
                          tp.flag(snow > 0).alias("is_snowy"))
