import pytest
from pyspark.sql import functions as F

from larkspur.operators.ranks import sorted_position
from larkspur.operators.skew import lookup_join


@pytest.fixture
def small_partitions(spark):
    """Adaptive execution that regards partitions over a few kB (equal rows compress well) as skewed, and no broadcast."""
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k"}
    before = {k: spark.conf.get(k, None) for k in options}
    for k, v in options.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_a_million_identical_rows_are_split(spark, small_partitions):
    big = spark.range(1_100_000, numPartitions=16).select(
        F.when(F.col("id") < 1_000_000, F.lit(7)).otherwise(F.col("id") % 1000).alias("k"), F.lit(2.5).alias("value"))
    small = spark.range(1000).select(F.col("id").cast("int").alias("k"), F.col("id").alias("v"))
    for how in ("inner", "left"):
        joined = lookup_join(big.withColumn("k", F.col("k").cast("int")), small, ["k"], how)
        hot = joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count_if((F.col("k") == 7) & (F.col("value") == 2.5)).alias("n")).where("n > 0")
        counts = [r["n"] for r in hot.collect()]
        assert sum(counts) >= 1_000_000 and len(counts) >= 4 and max(counts) < 500_000, counts


def test_positions_over_ranges(spark):
    df = spark.range(5000, numPartitions=7).select(F.md5(F.col("id").cast("string")).alias("h"))
    got = sorted_position(df, ["h"]).collect()
    assert [r["h"] for r in sorted(got, key=lambda r: r["position"])] == sorted(r["h"] for r in got)
    assert sorted(r["position"] for r in got) == list(range(5000))
    assert sorted_position(df.where("false"), ["h"]).collect() == []
