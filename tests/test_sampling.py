import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from larkspur.operators import sampling


def digest(key, seed=42):
    return hashlib.md5(f"{key}:{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def strata(spark):
    """1,200 rows: a third in one stratum, one of 9 rows, one of 1."""
    def stratum(i):
        if i == 0:
            return "single"
        if i < 10:
            return "nine"
        return "hot" if i % 3 == 0 else f"s{i % 7}"
    return spark.createDataFrame([(i, stratum(i)) for i in range(1200)], "id bigint, s string").cache()


def brute_sample(rows, size):
    groups = defaultdict(list)
    for i, s in rows:
        groups[s].append(i)
    taken = set()
    for ids in groups.values():
        take = max(1, math.floor(len(ids) / len(rows) * size))
        taken |= set(sorted(ids, key=lambda i: (digest(i), i))[:take])
    return taken


def test_stratified_sample_matches_brute_force(strata):
    rows = [tuple(r) for r in strata.collect()]
    got = {r["id"] for r in sampling.stratified_sample(strata, "id", "s", 300).collect()}
    assert got == brute_sample(rows, 300)


@pytest.mark.parametrize("size", [1, 40, 300, 1200])
def test_lowest_hashes_of_every_stratum(strata, size):
    marked = sampling.flag_lowest(strata, "id", sampling.take_proportional(size), ["s"])
    rows = [tuple(r) for r in strata.collect()]
    assert {r["id"] for r in marked.where("is_taken").collect()} == brute_sample(rows, size)


def test_top_up_reaches_the_size_without_repeats(strata):
    got = [r["id"] for r in sampling.sample_with_top_up(strata, "id", "s", 300).collect()]
    assert len(got) == len(set(got)) == 300
    everything = sampling.sample_with_top_up(strata, "id", "s", 5000)
    assert everything.count() == everything.select("id").distinct().count() == 1200


def test_cap_keeps_small_tables_whole(strata):
    assert sampling.cap_sample(strata, "id", 5000).count() == 1200
    assert sampling.cap_sample(strata, "id", 17).count() == 17
    assert sampling.cap_sample(strata, "id", 0).count() == 0
    assert sampling.cap_sample(strata.where("false"), "id", 5).count() == 0


def test_exact_split(strata):
    marked = sampling.split_exact(strata, "id", 0.2)
    test = {r["id"] for r in marked.where("is_test").collect()}
    assert test == set(sorted(range(1200), key=digest)[:240])
    assert marked.count() == 1200


def test_stratified_split_keeps_shares(strata):
    marked = sampling.split_stratified(strata, "id", "s")
    sizes, test = Counter(), Counter()
    for r in marked.collect():
        sizes[r["s"]] += 1
        test[r["s"]] += r["is_test"]
    assert sum(test.values()) == 240
    assert all(abs(test[s] - 0.2 * n) < 1 for s, n in sizes.items())


def test_another_seed_gives_another_sample(strata):
    first = {r["id"] for r in sampling.cap_sample(strata, "id", 100).collect()}
    second = {r["id"] for r in sampling.cap_sample(strata, "id", 100, seed=7).collect()}
    assert first != second


def test_partitioning_does_not_matter(strata):
    ids = lambda df: {r["id"] for r in sampling.stratified_sample(df, "id", "s", 200).collect()}
    assert ids(strata.repartition(1)) == ids(strata.repartition(13, F.rand(1)))


def test_missing_stratum_part_reads_nan(spark):
    df = spark.createDataFrame([("A", None), (None, "x")], "p string, n string")
    got = [r[0] for r in df.select(sampling.strata_key(F.col("p"), F.col("n"))).collect()]
    assert got == ["A_nan", "nan_x"]


def test_rows_of_two_classes_stay_in_their_tasks(spark):
    """A split by class deals no rows by the class: each task keeps its share."""
    df = spark.range(4000, numPartitions=8).withColumn("label", F.col("id") % 2)
    sizes = sampling.split_stratified(df, "id", "label").groupBy(F.spark_partition_id()).count().collect()
    assert [r["count"] for r in sizes] == [500] * 8
