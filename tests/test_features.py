import datetime as dt

import pytest
from pyspark.sql import functions as F

from larkspur.functions import distance, geo, ride, timeparts, weather
from larkspur.operators import cleaning, encoding, joins, statistics

C = F.col


def at(text):
    return dt.datetime.fromisoformat(text)


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_price_bands_are_right_closed(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (10.01,), (15.0,), (25.0,), (1000.0,), (1000.5,), (None,)], "p double")
    assert values(df, distance.price_band(C("p"))) == [
        None, "low", "mid", "mid", "high", "premium", None, None]


def test_rush_and_night(spark):
    df = spark.createDataFrame([(at("2024-01-01T21:30:00"),), (at("2024-01-01T22:00:00"),), (at("2024-01-06T22:30:00"),),
                                (at("2024-01-02T09:59:59"),), (at("2024-01-06T08:00:00"),)], "ts timestamp_ntz")
    hour, weekend = F.hour("ts"), timeparts.weekend_flag(F.weekday("ts"))
    flags = ride.event_window_flag(hour, timeparts.night_flag(hour), weekend)
    assert values(df, flags["is_event_time"]) == [0, 1, 0, 0, 0]
    assert values(df, flags["is_event_time_wide"]) == [1, 1, 0, 0, 0]
    assert values(df, timeparts.rush_flags(hour, weekend)["is_rush_hour"]) == [0, 0, 0, 1, 0]
    assert values(df, timeparts.rush_compact(hour, weekend)) == [0, 0, 0, 1, 0]


def test_nearest_hour_rounds_half_up(spark):
    df = spark.createDataFrame([(at("2024-01-01T10:29:59.999999"),), (at("2024-01-01T10:30:00"),)], "ts timestamp_ntz")
    assert values(df, timeparts.nearest_hour(C("ts"))) == [at("2024-01-01T10:00:00"), at("2024-01-01T11:00:00")]


def test_missing_values_count_as_zero_flags(spark):
    df = spark.createDataFrame([(None, None, None), (0.1, 30.0, 0.9)], "r double, t double, h double")
    flags = weather.weather_flags(C("r"), C("t"), C("h"), humid=0.8)
    assert [values(df, c) for c in flags.values()] == [[0, 1], [0, 1], [0, 0], [0, 1]]
    names = spark.createDataFrame([(None,), ("Lux black",), ("Pool",)], "n string")
    assert values(names, ride.premium_by_pattern(C("n"))) == [0, 1, 0]


def test_surge_defaults_to_one(spark):
    df = spark.createDataFrame([(2.0, None)], "d double, s double")
    products = ride.surge_interactions(C("d"), C("s"), F.lit(1), F.lit(1), F.lit(2))
    assert values(df, products["severity_surge"]) == [2.0]


def test_chord_distance_agrees_with_haversine(spark):
    points = [(37.7749, -122.4194), (37.775, -122.4194), (32.54, -117.12), (41.0, -124.0)]
    df = geo.with_unit_vector(spark.createDataFrame(points, "lat double, lon double"), "lat", "lon")
    city = points[0]
    both = df.select(geo.miles_to(city), geo.haversine_miles(C("lat"), C("lon"), F.lit(city[0]), F.lit(city[1])))
    for a, b in both.collect():
        assert a == pytest.approx(b, abs=1e-8)


def test_missing_position_is_not_coastal(spark):
    df = geo.with_unit_vector(spark.createDataFrame([(None, 1.0)], "lat double, lon double"), "lat", "lon")
    near = geo.nearest_miles()
    assert values(df, F.isnan(near)) == [True]
    assert values(df, geo.region_flags(near, near, near)["is_coastal"]) == [0]


def test_rules_count_each_row_once(spark):
    df = spark.createDataFrame([(1, 1), (9, 9), (1, 9), (None, 1)], "a int, b int")
    rules = {"a_cap": C("a") < 5, "b_cap": C("b") < 5}
    got = {r["rule"]: r["n_rows"] for r in cleaning.rule_removals(df, rules).collect()}
    assert got == {"a_cap": 2, "b_cap": 1, "kept": 1}
    assert cleaning.range_filters(df, rules).count() == 1


def test_strata_of_nine_go_and_of_ten_stay(spark):
    df = spark.createDataFrame([(i, "nine" if i < 9 else "ten") for i in range(19)], "id int, s string")
    assert set(values(cleaning.rare_stratum_filter(df, "s"), "s")) == {"ten"}


def test_fill_gaps(spark):
    hours = [(("z", at(f"2024-01-01T0{h}:00:00"), v)) for h, v in [(0, 1.0), (3, 7.0), (4, None), (5, 9.0)]]
    df = spark.createDataFrame(hours, "z string, h timestamp_ntz, v double")
    got = [(r["v_filled"], r["v_linear"]) for r in cleaning.fill_gaps(df, "h", "v", ["z"]).orderBy("h").collect()]
    assert got == [(1, 1), (1, 3), (1, 5), (7, 7), (7, 8), (9, 9)]


def test_repeated_hours_do_not_multiply_rides(spark):
    rides = spark.createDataFrame([(1, at("2024-01-01T10:10:00")), (2, at("2024-01-01T12:00:00"))], "id int, ts timestamp_ntz")
    hourly = spark.createDataFrame([(at("2024-01-01T10:00:00"), 5.0), (at("2024-01-01T10:00:00"), 4.0)], "h timestamp_ntz, t double")
    got = {r["id"]: r["t"] for r in joins.hourly_join(rides, "ts", hourly, "h", "t").collect()}
    assert got == {1: 4.0, 2: None}


def test_asof_takes_the_last_price_at_or_before(spark):
    prices = spark.createDataFrame([(at("2024-01-01T00:00:00"), 1.0), (at("2024-01-08T12:00:00"), 2.0)], "w timestamp_ntz, p double")
    rides = spark.createDataFrame([(1, at("2023-12-31T23:59:59")), (2, at("2024-01-08T11:59:59")),
                                   (3, at("2024-01-08T12:00:00")), (4, at("2024-03-01T00:00:00"))], "id int, ts timestamp_ntz")
    got = {r["id"]: r["p"] for r in joins.asof_join(rides, "ts", prices, "w", ["p"]).collect()}
    assert got == {1: None, 2: 1.0, 3: 2.0, 4: 2.0}


def test_event_windows_are_half_open(spark):
    calendar = spark.createDataFrame([(dt.date(2024, 1, 5), at("2024-01-05T21:00:00"), at("2024-01-05T22:00:00"), "V"),
                                      (dt.date(2024, 1, 5), at("2024-01-05T21:30:00"), at("2024-01-05T23:00:00"), "W")],
                                     "event_date date, starts timestamp_ntz, ends timestamp_ntz, venue string")
    rides = spark.createDataFrame([(1, at("2024-01-05T21:00:00"), "W"), (2, at("2024-01-05T21:45:00"), "W"),
                                   (3, at("2024-01-05T22:00:00"), "X"), (4, at("2024-01-06T21:00:00"), "V")],
                                  "id int, ts timestamp_ntz, p string")
    got = {r["id"]: (r["n_events"], r["is_event_day"], r["is_at_event_venue"])
           for r in joins.window_join(rides, "ts", "p", calendar).collect()}
    assert got == {1: (1, 1, 0), 2: (2, 1, 1), 3: (1, 1, 0), 4: (0, 0, 0)}


def test_dictionary_is_sorted_and_unseen_is_minus_one(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "c string")
    dictionary = encoding.fit_dictionary(df, ["c"])
    assert {r["value"]: r["code"] for r in dictionary.collect()} == {"a": 0, "b": 1, "nan": 2}
    new = spark.createDataFrame([("a",), ("z",)], "c string")
    assert values(encoding.apply_dictionary(new, dictionary, ["c"]), "c_encoded") == [0, -1]


def test_codes_follow_the_sorted_values(spark):
    df = spark.range(300).select((C("id") % 37).cast("string").alias("a"), F.when(C("id") % 5 > 0, (C("id") % 5).cast("string")).alias("b"))
    got = sorted(tuple(r) for r in encoding.fit_dictionary(df, ["a", "b"]).collect())
    want = [("a", v, i) for i, v in enumerate(sorted(str(k) for k in range(37)))]
    assert got == sorted(want + [("b", v, i) for i, v in enumerate(["1", "2", "3", "4", "nan"])])


def test_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (1.0, 4.0, 3.0), (1.0, None, 1.0)], "k double, x double, y double")
    scaled = encoding.Scaler.fit(df, ["k"]).apply(df)
    assert values(scaled, "k") == [0.0, 0.0, 0.0]
    got = {r["feature"]: r["r_y"] for r in statistics.pearson_pairs(df, ["k", "x"], ["y"]).collect()}
    assert got["k"] is None and got["x"] == pytest.approx(-1.0)
