"""Repeatable sampling and splitting, keyed by a seeded hash.

The order of ``md5(key:seed)`` is the shuffle: any engine, any partitioning
and any recomputed task gives the same rows. "The n lowest hashes" is found by
counting bins of leading hash bits, about sqrt(rows) of them a group, and
ranking the rows of one bin; the final pass only compares each row with a cut.
"""

from __future__ import annotations

import math
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.operators.ranks import leading_bits, root_bits
from larkspur.operators.skew import lookup_join, sent_if_few
from larkspur.session import cut_lineage

SEED = 42
_H = "_hash"


def seeded_hash(key: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))


def hash_percent(key: str, seed: int = SEED) -> Column:
    """0 to 99 from the first 8 hex digits of the hash."""
    return F.pmod(F.conv(F.substring(seeded_hash(key, seed), 1, 8), 16, 10).cast("bigint"), F.lit(100))


Quotas = Callable[[DataFrame], DataFrame]


def _with_group_values(df: DataFrame, side: DataFrame, by: list[str], how: str) -> DataFrame:
    """Bring per-group values to the rows; without groups ``side`` has one row or none.

    A join by key would put the rows of two classes into two tasks, so the
    values of few groups go to the rows where they are. ``side`` is a computed table.
    """
    if by:
        return lookup_join(df, sent_if_few(side), by, how)
    one = F.lit(0).alias("_one")
    return df.select("*", one).join(F.broadcast(side.select("*", one)), "_one", how).drop("_one")


def flag_lowest(df: DataFrame, key: str, quotas: Quotas, by: Sequence[str] = (), seed: int = SEED,
                name: str = "is_taken") -> DataFrame:
    """Mark, per group, the ``take`` rows with the lowest seeded hash.

    ``quotas`` turns the group sizes (by…, n) into (by…, take). ``key`` must
    be unique. Groups without a quota are marked false. ``df`` is read twice:
    once for its keys and hashes, once for the marks.
    """
    by = list(by)
    hashed = cut_lineage(df.select(*by, F.col(key).alias("_key"), seeded_hash(key, seed).alias(_H)))
    sizes = hashed.groupBy(*by).agg(F.count("*").alias("n"))
    takes = quotas(sizes).where("take > 0").select(*by, F.least("take", "n").alias("take"), root_bits(F.col("n")).alias("bits"))
    placed = _with_group_values(hashed, cut_lineage(takes), by, "inner").withColumn("bin", leading_bits(F.col(_H), F.col("bits")))
    bins = placed.groupBy(*by, "bin", "take").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("bin"))
    edge = cut_lineage(bins.withColumn("upto", upto).where("upto >= take and upto - n < take").select(
        *by, F.col("bin").alias("edge"), (F.col("take") - F.col("upto") + F.col("n")).alias("need")))
    at_edge = _with_group_values(placed, edge, by, "inner").where("bin = edge")
    place = F.row_number().over(Window.partitionBy(*by).orderBy(_H, "_key"))
    cuts = cut_lineage(
        at_edge.withColumn("place", place).where(F.col("place") == F.col("need"))
        .select(*by, F.col(_H).alias("cut_hash"), F.col("_key").alias("cut_key")))
    mine = seeded_hash(key, seed)
    joined = _with_group_values(df, cuts, by, "left")
    taken = (mine < F.col("cut_hash")) | ((mine == F.col("cut_hash")) & (F.col(key) <= F.col("cut_key")))
    return joined.withColumn(name, F.coalesce(taken, F.lit(False))).select(*df.columns, name)


def take_n(n: int) -> Quotas:
    """The same number from every group."""
    return lambda groups: groups.withColumn("take", F.lit(n).cast("bigint"))


def take_proportional(size: int) -> Quotas:
    """Per group max(1, floor(n_s / N x size)) rows."""
    def quotas(groups: DataFrame) -> DataFrame:
        total = groups.agg(F.sum("n")).first()[0] or 1
        return groups.withColumn("take", F.greatest(F.lit(1), F.floor(F.col("n") / F.lit(total) * F.lit(size))))
    return quotas


def take_share(share: float) -> Quotas:
    """ceil(share x n) rows of every group."""
    return lambda groups: groups.withColumn("take", F.ceil(F.lit(share) * F.col("n")))


def take_stratified(share: float, label: str) -> Quotas:
    """ceil(share x N) rows over all groups, in proportion to their sizes.

    Groups get the floor of their part; the rows left over go to the largest
    fractions, ties to the lower label.
    """
    def quotas(groups: DataFrame) -> DataFrame:
        total = groups.agg(F.sum("n")).first()[0] or 0
        wanted = math.ceil(share * total)
        part = F.col("n") * F.lit(wanted) / F.lit(total or 1)
        floors = groups.withColumn("base", F.floor(part)).withColumn("part", part - F.floor(part))
        spare = wanted - (floors.agg(F.sum("base")).first()[0] or 0)
        # one row per class
        order = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("part"), label))
        return floors.withColumn("take", F.col("base") + F.when(order <= spare, 1).otherwise(0))
    return quotas


def strata_key(*parts: Column) -> Column:
    """Parts joined by ``_``; a missing part reads ``nan``."""
    return F.concat_ws("_", *[F.coalesce(p.cast("string"), F.lit("nan")) for p in parts])


def stratified_sample(df: DataFrame, key: str, stratum: str, size: int, seed: int = SEED) -> DataFrame:
    """Per stratum max(1, floor(n_s / N x size)) rows."""
    marked = flag_lowest(df, key, take_proportional(size), [stratum], seed)
    return marked.where("is_taken").drop("is_taken")


def sample_with_top_up(df: DataFrame, key: str, stratum: str, size: int,
                       seed: int = SEED) -> DataFrame:
    """A stratified sample filled up to exactly ``size`` rows.

    The fill comes from rows not yet sampled, so no row appears twice.
    ``origin`` tells the two parts apart.
    """
    drawn = []

    def quotas(groups: DataFrame) -> DataFrame:
        taken = take_proportional(size)(groups)
        drawn.append(taken.agg(F.sum(F.least("n", "take"))).first()[0] or 0)
        return taken

    marked = flag_lowest(df, key, quotas, [stratum], seed)
    first = marked.where("is_taken").drop("is_taken")
    rest = marked.where(~F.col("is_taken")).drop("is_taken")
    missing = max(0, size - drawn[0])
    if missing == 0:
        return first.withColumn("origin", F.lit("stratified"))
    fill = flag_lowest(rest, key, take_n(missing), seed=seed).where("is_taken").drop("is_taken")
    return union_samples(first.withColumn("origin", F.lit("stratified")),
                         fill.withColumn("origin", F.lit("top_up")))


def union_samples(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.unionByName(second)


def not_sampled(df: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the sample."""
    return df.join(sample.select(key), key, "left_anti")


def outside_sample(df: DataFrame, key: str, stratum: str, size: int, seed: int = SEED) -> DataFrame:
    """Rows that a stratified sample of ``size`` leaves, by the same mark and without a join of keys."""
    marked = flag_lowest(df, key, take_proportional(size), [stratum], seed)
    return marked.where(~F.col("is_taken")).drop("is_taken")


def cap_sample(df: DataFrame, key: str, n: int, seed: int = SEED) -> DataFrame:
    """The whole table, or a seeded choice of ``n`` rows when it is larger."""
    return flag_lowest(df, key, take_n(n), seed=seed).where("is_taken").drop("is_taken")


def split_exact(df: DataFrame, key: str, test_share: float = 0.2, seed: int = SEED,
                name: str = "is_test") -> DataFrame:
    """Mark exactly ceil(share x n) rows as test."""
    return flag_lowest(df, key, take_share(test_share), seed=seed, name=name)


def split_by_hash(df: DataFrame, key: str, percent: int = 20, seed: int = SEED,
                  name: str = "is_test") -> DataFrame:
    """Mark each row by its own hash: no counting pass, sizes are approximate."""
    return df.withColumn(name, hash_percent(key, seed) < percent)


def split_stratified(df: DataFrame, key: str, label: str, test_share: float = 0.2,
                     seed: int = SEED, name: str = "is_test") -> DataFrame:
    """Mark ceil(share x n) test rows so that class shares are preserved."""
    return flag_lowest(df, key, take_stratified(test_share, label), [label], seed, name)


def pick_examples(df: DataFrame, key: str, actual: str, predicted: str, n: int = 3,
                  seed: int = SEED) -> DataFrame:
    """A few seeded rows with actual, predicted and their absolute gap."""
    return (
        df.orderBy(seeded_hash(key, seed), key).limit(n)
        .select(key, actual, predicted, F.abs(F.col(actual) - F.col(predicted)).alias("abs_diff"))
    )


def stratum_balance(population: DataFrame, sample: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of every value of every column, in the population and the sample."""
    def shares(df: DataFrame, name: str) -> DataFrame:
        n = df.count()
        tall = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("value"))
            for c in columns])).alias("e"))
        return tall.groupBy("e.column", "e.value").agg(
            F.count("*").alias(f"{name}_n"), (F.count("*") / F.lit(max(n, 1))).alias(f"{name}_share"))
    joined = shares(population, "population").join(shares(sample, "sample"), ["column", "value"], "left")
    return joined.na.fill({"sample_n": 0, "sample_share": 0.0})
