"""Stand-in tables: the expected inputs, derived from the test tables.

Joins carry no hints. Catalyst broadcasts a side whose files are small and
sort-merges otherwise, and adaptive skew handling splits a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larkspur.functions.timeparts import hour_floor, week_floor


def _k():
    return F.get_json_object("props", "$.k").cast("bigint")


def rides(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    e, k = F.col("event_id"), F.col("k")
    step = e % 20
    joined = (
        events.withColumn("k", _k())
        .join(customer.select("c_custkey", "c_nationkey"), F.col("user_id") == F.col("c_custkey"))
        .join(nation.select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    whole = lambda c: c.cast("double")
    return joined.select(
        e.alias("ride_id"), "ts",
        F.when(e % 13 != 0, F.col("value") + F.lit(2.5)).alias("price"),
        (k / 10).alias("distance"),
        F.when(e % 100 == 99, 3.0).when(step < 14, 1.0).when(step < 16, 1.25).when(step == 16, 1.5)
        .when(step == 17, 1.75).when(step == 18, 2.0).otherwise(2.5).alias("surge_multiplier"),
        F.when(F.col("user_id") % 2 == 0, "A").otherwise("B").alias("cab_type"),
        F.col("event_type").alias("name"),
        F.col("n_name").alias("source"),
        F.concat(F.lit("ZONE_"), (k % 12).cast("string")).alias("destination"),
        whole(20 + e * 7 % 70).alias("temperature"),
        whole(20 + e * 7 % 70 - e * 3 % 11).alias("apparentTemperature"),
        ((e * 13 % 100) / 100).alias("humidity"),
        ((e * 19 % 100) / 100).alias("cloudCover"),
        ((e * 17 % 100) / 100).alias("precipProbability"),
        whole(e * 3 % 26).alias("windSpeed"),
        whole(e * 3 % 26 + e % 9).alias("windGust"),
        F.when(e % 4 == 0, (e % 10) / 100).otherwise(0.0).alias("precipIntensity"),
        ((e * 11 % 100) / 10).alias("visibility"),
        whole(990 + e * 5 % 40).alias("pressure"),
        whole(e * 23 % 60).alias("dewPoint"),
    )


RIDES_SQL = """
select event_id as ride_id, ts,
  case when event_id % 13 <> 0 then value + 2.5e0 end as price,
  k / 10 as distance,
  case when event_id % 100 = 99 then 3e0 when event_id % 20 < 14 then 1e0 when event_id % 20 < 16 then 1.25e0
       when event_id % 20 = 16 then 1.5e0 when event_id % 20 = 17 then 1.75e0
       when event_id % 20 = 18 then 2e0 else 2.5e0 end as surge_multiplier,
  case when user_id % 2 = 0 then 'A' else 'B' end as cab_type,
  event_type as name, n_name as source, 'ZONE_' || (k % 12) as destination,
  cast(20 + event_id * 7 % 70 as double) as temperature,
  cast(20 + event_id * 7 % 70 - event_id * 3 % 11 as double) as apparentTemperature,
  (event_id * 13 % 100) / 100 as humidity, (event_id * 19 % 100) / 100 as cloudCover,
  (event_id * 17 % 100) / 100 as precipProbability,
  cast(event_id * 3 % 26 as double) as windSpeed, cast(event_id * 3 % 26 + event_id % 9 as double) as windGust,
  case when event_id % 4 = 0 then (event_id % 10) / 100 else 0e0 end as precipIntensity,
  (event_id * 11 % 100) / 10 as visibility, cast(990 + event_id * 5 % 40 as double) as pressure,
  cast(event_id * 23 % 60 as double) as dewPoint
from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events)
join customer on user_id = c_custkey join nation on c_nationkey = n_nationkey
"""


def blocks(customer: DataFrame, orders: DataFrame) -> DataFrame:
    first = orders.groupBy("o_custkey").agg(F.min_by("o_totalprice", "o_orderkey").alias("first_price"))
    key = F.col("c_custkey")
    return customer.join(first, key == F.col("o_custkey")).select(
        key.alias("block_id"),
        ((F.col("c_acctbal") + F.lit(1000.0)) / F.lit(1000.0)).alias("MedInc"),
        (1 + key % 52).cast("double").alias("HouseAge"),
        (3 + (key * 7 % 150) / 10).alias("AveRooms"),
        (F.lit(0.8) + (key * 7 % 45) / 10).alias("AveBedrms"),
        (100 + key * 37 % 3000).cast("double").alias("Population"),
        (F.lit(1.5) + (key * 11 % 95) / 10).alias("AveOccup"),
        (F.lit(32.5) + (key * 37 % 950) / 100).alias("Latitude"),
        (F.lit(-124.3) + (key * 91 % 1000) / 100).alias("Longitude"),
        (F.col("first_price") / F.lit(1e5)).alias("MedHouseVal"),
    )


BLOCKS_SQL = """
select c_custkey as block_id, (c_acctbal + 1000e0) / 1000e0 as MedInc,
  cast(1 + c_custkey % 52 as double) as HouseAge, 3 + (c_custkey * 7 % 150) / 10 as AveRooms,
  0.8e0 + (c_custkey * 7 % 45) / 10 as AveBedrms, cast(100 + c_custkey * 37 % 3000 as double) as Population,
  1.5e0 + (c_custkey * 11 % 95) / 10 as AveOccup, 32.5e0 + (c_custkey * 37 % 950) / 100 as Latitude,
  -124.3e0 + (c_custkey * 91 % 1000) / 100 as Longitude, first_price / 1e5 as MedHouseVal
from customer join (select o_custkey, arg_min(o_totalprice, o_orderkey) as first_price from orders group by 1)
  on c_custkey = o_custkey
"""


def flights(lineitem: DataFrame, orders: DataFrame, part: DataFrame, supplier: DataFrame,
            customer: DataFrame, nation: DataFrame) -> DataFrame:
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").cast("string")
    key = F.md5(F.concat_ws(
        "|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        cents("l_quantity"), cents("l_extendedprice"), cents("l_discount"), cents("l_tax"),
        "l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss")))
    origin = nation.select(F.col("n_nationkey").alias("_o"), F.col("n_name").alias("origin"))
    dest = nation.select(F.col("n_nationkey").alias("_d"), F.col("n_name").alias("dest"))
    # customers meet the orders, of which there are fewer than line items
    placed = (
        orders.select("o_orderkey", "o_custkey", "o_orderdate")
        .join(customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(dest, F.col("c_nationkey") == F.col("_d")).select("o_orderkey", "o_orderdate", "dest"))
    return (
        lineitem.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origin, F.col("s_nationkey") == F.col("_o"))
        .select(
            key.alias("flight_id"), F.month("l_shipdate").alias("month"),
            F.dayofmonth("l_shipdate").alias("day"), (F.col("l_linenumber") * 3).alias("hour"),
            (F.col("l_extendedprice") / 40).alias("distance"), F.col("p_brand").alias("carrier"),
            "origin", "dest", F.col("l_quantity").alias("totflight"),
            (F.date_diff("l_shipdate", "o_orderdate") - 40).cast("double").alias("arr_delay"))
        .withColumn("is_delayed", (F.col("arr_delay") > 15).cast("int"))
    )


FLIGHTS_SQL = """
select md5(concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber,
    cast(round(l_quantity * 100) as bigint), cast(round(l_extendedprice * 100) as bigint),
    cast(round(l_discount * 100) as bigint), cast(round(l_tax * 100) as bigint),
    l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'))) as flight_id,
  cast(month(l_shipdate) as int) as month, cast(day(l_shipdate) as int) as day, l_linenumber * 3 as hour,
  l_extendedprice / 40 as distance, p_brand as carrier, o.n_name as origin, d.n_name as dest,
  l_quantity as totflight,
  cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) - 40 as double) as arr_delay,
  cast(date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) - 40 > 15 as int) as is_delayed
from lineitem join orders on l_orderkey = o_orderkey join part on l_partkey = p_partkey
join supplier on l_suppkey = s_suppkey join customer on o_custkey = c_custkey
join nation o on s_nationkey = o.n_nationkey join nation d on c_nationkey = d.n_nationkey
"""


def hourly(events: DataFrame) -> DataFrame:
    k = F.col("k")
    return (
        events.select(hour_floor(F.col("ts")).alias("hour_ts"), _k().alias("k"),
                      "event_type")
        .groupBy("hour_ts").agg(
            (F.max(k) - 60).cast("double").alias("temp_c"), F.min(k).cast("double").alias("humidity"),
            F.count_if(F.col("event_type") == "error").cast("double").alias("precipitation"),
            ((F.max(k) - F.min(k)) / 4).alias("wind_speed"))
    )


HOURLY_SQL = """
select date_trunc('hour', ts) as hour_ts, cast(max(k) - 60 as double) as temp_c, cast(min(k) as double) as humidity,
  cast(count(*) filter (event_type = 'error') as double) as precipitation, (max(k) - min(k)) / 4 as wind_speed
from (select *, cast(json_extract_string(props, '$.k') as bigint) as k from events) group by 1
"""


def fuel(orders: DataFrame) -> DataFrame:
    return orders.groupBy(week_floor(F.col("o_orderdate")).alias("week")).agg(
        (F.lit(2.45) + (F.count("*") % 70) / 100).alias("gas_price"))


FUEL_SQL = """
select cast(date_trunc('week', o_orderdate) as timestamp) as week, 2.45e0 + (count(*) % 70) / 100 as gas_price
from orders group by 1
"""


def calendar(events: DataFrame) -> DataFrame:
    """Late windows of three hours on every day with events, and one across midnight each tenth day."""
    days = events.select(F.to_date("ts").alias("event_date")).distinct()
    midnight = F.col("event_date").cast("timestamp_ntz")
    hours = lambda h: midnight + F.make_dt_interval(F.lit(0), F.lit(h))
    venue = lambda shift: F.concat(F.lit("NATION_"), ((F.dayofmonth("event_date") + shift) % 25).cast("string"))
    late = days.select("event_date", hours(21).alias("starts"), hours(24).alias("ends"), venue(0).alias("venue"))
    night = days.where(F.dayofmonth("event_date") % 10 == 5).select(
        "event_date", hours(22).alias("starts"), hours(25).alias("ends"), venue(1).alias("venue"))
    return late.unionByName(night)


CALENDAR_SQL = """
with d as (select distinct cast(ts as date) as event_date from events)
select event_date, cast(event_date as timestamp) + interval 21 hour as starts,
  cast(event_date as timestamp) + interval 24 hour as ends, 'NATION_' || (day(event_date) % 25) as venue from d
union all select event_date, cast(event_date as timestamp) + interval 22 hour,
  cast(event_date as timestamp) + interval 25 hour, 'NATION_' || ((day(event_date) + 1) % 25) from d
where day(event_date) % 10 = 5
"""
