import pytest
from pyspark.sql import functions as F

from larkspur.operators.quantiles import quantile_columns, quantile_values, quantiles

PROBS = [0.0, 0.1, 0.333, 0.5, 0.9, 0.99, 1.0]


def wide(spark, n=30_000):
    """A third of the rows share one value, the rest spread out."""
    x = F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_000_003)) / 97)
    return spark.range(n).select((F.col("id") % 4).alias("g"), x.alias("x"))


def builtin(df, by=()):
    p = F.percentile("x", F.array(*[F.lit(p) for p in PROBS])).alias("q")
    return {tuple(r[c] for c in by): r["q"] for r in df.groupBy(*by).agg(p).collect()}


@pytest.fixture(params=[1, 7])
def ranges(spark, request):
    """That many ranges, however few the rows."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)
    yield request.param
    for k, v in before.items():
        spark.conf.set(k, v)


def test_equals_the_builtin(spark, ranges):
    df = wide(spark)
    assert quantile_values(df, "x", PROBS) == builtin(df)[()]


def test_per_group_with_a_hot_group_and_a_null_group(spark, ranges):
    df = wide(spark).withColumn("g", F.when(F.col("g") < 2, 0).when(F.col("g") == 2, 1))
    got = {}
    for r in quantiles(df, "x", PROBS, ["g"]).collect():
        got.setdefault((r["g"],), {})[r["i"]] = r["quantile"]
    assert {k: [v[i] for i in range(len(PROBS))] for k, v in got.items()} == builtin(df, ["g"])


def test_one_value_and_few_values(spark):
    for values in ([4.0] * 1000, [1.0, 2.0], [1.0] * 99 + [5.0], [float(i % 3) for i in range(50)]):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        assert quantile_values(df, "x", PROBS) == builtin(df)[()]


def test_missing_values_are_ignored(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (1.0,), (2.0,)], "x double")
    assert quantile_values(df, "x", [0.5]) == [1.5]
    assert quantile_values(df.where("false"), "x", [0.5]) == [None]


def test_named_columns(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(5)] + [("b", 1.0)], "g string, x double")
    got = {r["g"]: (r["lo"], r["hi"]) for r in quantile_columns(df, "x", {"lo": 0.25, "hi": 0.75}, ["g"]).collect()}
    assert got == {"a": (1.0, 3.0), "b": (1.0, 1.0)}
