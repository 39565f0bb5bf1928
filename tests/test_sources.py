import pytest
from pyspark.sql import functions as F

from larkspur import fixed_values as fv
from larkspur.functions.ride import premium_by_pattern
from larkspur.plans import rides as ride_plan
from larkspur.plans import housing as housing_plan
from larkspur.sources import files, pages, payloads, reference, synth
from larkspur.streaming.features import stream_features, stream_with_weather

C = F.col


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 2.5), (2, None, None)], "id int, s string, x double")
    files.sink_dataset(df, str(tmp_path / "out"), "csv")
    back = files.scan_csv(spark, str(tmp_path / "out"), "id int, s string, x double")
    assert sorted(back.collect()) == sorted(df.collect())


def test_missing_elements_fall_back(spark):
    html = '<div><strong class="p" id="price"> €91.25 </strong><a href="/x">one</a></div>'
    df = spark.createDataFrame([(1, html), (2, "<p>none</p>")], "id int, html string")
    price = pages.number_of(pages.element_text(C("html"), "strong", "price"), 89.5)
    assert [r[0] for r in df.orderBy("id").select(price).collect()] == [91.25, 89.5]
    items = pages.repeated_items(df, "html", '<a href="([^"]*)">([^<]*)</a>', ["href", "text"], ["id"])
    assert [tuple(r) for r in items.collect()] == [(1, 0, "/x", "one"), (2, None, None, None)]


def test_empty_match_gives_null(spark):
    schema = "m array<struct<coordinates: array<double>>>"
    df = spark.createDataFrame([('{"m": []}',), ('{"m": [{"coordinates": [-122.0, 37.0]}]}',)], "p string")
    first = payloads.first_match(C("p"), schema, "m")
    got = [r[0] for r in df.select(payloads.lat_lon(first["coordinates"])).collect()]
    assert got[0]["lat"] is None and (got[1]["lat"], got[1]["lon"]) == (37.0, -122.0)


def test_synthetic_rides_repeat_and_stay_in_range(spark):
    once, again = synth.synth_range(spark, 500), synth.synth_range(spark, 500).repartition(7)
    assert sorted(once.collect()) == sorted(again.collect())
    row = once.agg(F.min("distance_km"), F.max("distance_km"), F.max("hour"), F.avg("is_monsoon")).first()
    assert row[0] >= 1 and row[1] < 25 and row[2] <= 23 and 0.1 < row[3] < 0.3


def test_reference_tables(spark):
    assert reference.coast_points(spark).count() == 29
    assert reference.cities(spark).count() == 5 and reference.cities(spark, extended=True).count() == 7
    assert reference.line_stations(spark).count() == 4 and reference.delay_probabilities(spark).count() == 5


def test_ride_feature_counts(tables):
    table = ride_plan.feature_table(tables.rides, "ride_id", size=200, premium="purchase|signup")
    assert len(ride_plan.feature_lists(True, False)) == 32 and len(ride_plan.feature_lists(True, True)) == 40
    assert set(ride_plan.feature_lists(True, True)) <= set(table.columns)
    assert not [c for c in ride_plan.feature_lists(False, True) if "surge" in c or c == "is_premium"]
    assert table.count() == 200 and table.select("ride_id").distinct().count() == 200


def test_housing_feature_counts(tables):
    sets = housing_plan.feature_sets()
    assert (len(sets["base"]), len(sets["enriched"])) == (20, 34)
    table = housing_plan.feature_table(tables.blocks, cap=4.9)
    assert set(sets["enriched"]) <= set(table.columns)
    assert table.where("is_high_value is null").count() == 0


def test_features_run_on_a_stream(spark, tables, tmp_path):
    source = str(tmp_path / "in")
    rides = tables.rides
    rides.write.parquet(source)
    stream = stream_features(spark.readStream.schema(rides.schema).parquet(source), "purchase|signup")
    joined = stream_with_weather(stream, tables.hourly.select("hour_ts", "temp_c"))
    run = joined.select("ride_id", "is_rush_hour", "is_premium", "temp_c").writeStream.format("memory") \
        .queryName("streamed").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination(120)
    streamed = spark.table("streamed")
    batch = rides.where("price > 0").select("ride_id", premium_by_pattern(C("name"), "purchase|signup").alias("p"))
    assert streamed.count() == batch.count()
    assert streamed.join(batch, "ride_id").where("is_premium != p").count() == 0


@pytest.mark.parametrize("name", ["median_flag_feature", "model_store"])
def test_flights_are_computed_once(spark, folder, name):
    """What is read several times is stored, so no plan joins the line items again."""
    from larkspur.catalog import all_queries
    plan = all_queries()[name](spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan
