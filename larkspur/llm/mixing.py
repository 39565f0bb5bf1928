"""Mixing sources to target weights by capped water-filling.

A source's target is its share of the total by weight, but at most ``epochs``
times its own size. Sources above their limit are clamped there and what they
leave is shared among the rest by weight, until none is above. A target of e
epochs takes every document ``floor(e)`` times and fills the fraction with
documents in a seeded order, in a few rounds: each takes the documents that
fit, up to the first that does not, out of those no larger than what is left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

EPOCHS = 3
CYCLE = (1, 2, 3)
SEED = 7
ROUNDS = 4


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: tuple[int, ...] = CYCLE) -> DataFrame:
    """(source, size) with weights that repeat ``cycle`` over sources by code point, null last.

    Ranks come from range partitions: counts of whole partitions (one row each)
    and ranks inside a partition, so no task sees all sources.
    """
    parts = cut_lineage(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    before = parts.groupBy("_part").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.coalesce(F.sum("_n").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in cycle]),
                          (F.pmod(F.col("_before") + F.col("_rank"), F.lit(len(cycle))) + 1).cast("int"))
    return parts.withColumn("_rank", rank).join(before, "_part") \
        .select("source", "size", weight.alias("weight"))


def water_fill(sources: DataFrame, total: int | None = None, epochs: int = EPOCHS) -> DataFrame:
    """(source, size, weight) with the target of each source.

    ``total`` is the size of the mix, all sizes together unless given. Each
    round is one aggregate whose single row reaches the driver. A total beyond
    ``epochs`` times all sizes leaves every source at its limit; sources with
    weight 0 or size 0 get 0.
    """
    limit = F.col("size") * F.lit(epochs)
    live = F.col("weight") > 0
    if total is None:
        total = sources.agg(F.sum("size")).first()[0] or 0
    clamped = F.lit(False)
    seen = -1
    rest, weights = total, 0
    while True:
        held, weights, n = sources.agg(
            F.sum(F.when(clamped & live, limit)), F.sum(F.when(~clamped & live, F.col("weight"))),
            F.sum((clamped & live).cast("long"))).first()
        rest = total - (held or 0)
        if not weights or n == seen:
            break
        seen = n
        # compared as products of whole numbers, so a source at its very limit is never misjudged
        clamped = F.col("weight").cast("decimal(38,0)") * F.lit(rest) >= limit.cast("decimal(38,0)") * F.lit(weights)
    share = F.col("weight") * F.lit(float(rest)) / F.lit(float(weights or 1))
    target = F.when(~live, F.lit(0.0)).when(clamped, limit.cast("double")).otherwise(share)
    return sources.withColumn("target", target.cast("double"))


def mix(documents: DataFrame, weights: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", epochs: int = EPOCHS, total: int | None = None, seed: int = SEED,
        rounds: int = ROUNDS) -> DataFrame:
    """One row per document: id, source, size, source_size, target, copies, taken (= size * copies).

    ``weights`` has (source, weight), one row a source; without it they repeat
    1, 2, 3. Sizes are words; a null text has none. Null is a source of its
    own. The seeded order is by MD5 of seed and id; equal rows are told apart
    only by their order, which does not change the result. A source's words
    never pass its target. After round r they miss it by less than the document
    that did not fit, which is no larger than what round r - 1 left.

    The order is dealt by leading bits of the hash into about sqrt(n) bins a
    source, so neither a bin nor the list of bins is the whole of a hot source.
    """
    order = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))), 1, 16)
    rows = cut_lineage(documents.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        count_words(F.col(text_col)).alias("size"), order.alias("_order")))
    sizes = rows.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("_n"))
    weighed = cut_lineage(cyclic_weights(sizes) if weights is None else
                          sizes.join(weights.select(F.col("source").alias("_s"), "weight"),
                                     F.col("source").eqNullSafe(F.col("_s")), "left")
                          .select("source", "size", F.coalesce("weight", F.lit(0)).cast("long").alias("weight")))
    targets = water_fill(weighed, total, epochs)
    epoch = F.when(F.col("size") > 0, F.col("target") / F.col("size")).otherwise(F.lit(0.0))
    whole = F.floor(epoch).cast("long")
    plan = cut_lineage(
        targets.join(sizes.select(F.col("source").alias("_s"), "_n"), F.col("source").eqNullSafe(F.col("_s"))).select(
            F.col("source").alias("_source"), F.col("size").alias("source_size"), "target", whole.alias("copies"),
            (F.col("target") - whole * F.col("size")).alias("_left"),
            F.greatest(F.lit(0), F.least(F.lit(24), F.ceil(F.log2(F.col("_n").cast("double")) / 2))).cast("int").alias("_bits")))
    leading = F.conv(F.substring("_order", 1, 6), 16, 10).cast("long")
    now = rows.join(plan, F.col("source").eqNullSafe(F.col("_source"))).withColumns({
        "_bin": F.call_function("shiftright", leading, (F.lit(24) - F.col("_bits")).cast("int")),
        "_done": F.lit(False)}).drop("_bits", "_source")
    for _ in range(rounds):
        now = cut_lineage(_take(now))
    return now.select("id", "source", "size", "source_size", "target",
                      (F.col("copies") + F.col("_done").cast("long")).alias("copies")).withColumn(
        "taken", F.col("size") * F.col("copies"))


def _take(rows: DataFrame) -> DataFrame:
    """Mark the documents that fit into what is left of their source, up to the first that does not."""
    open_ = ~F.col("_done") & (F.col("size") <= F.col("_left"))
    step = F.when(open_, F.col("size")).otherwise(0)
    bins = rows.groupBy("source", "_bin").agg(F.sum(step).alias("_words"))
    before = bins.select(
        F.col("source").alias("_s"), F.col("_bin").alias("_b"),
        F.coalesce(F.sum("_words").over(Window.partitionBy("source").orderBy("_bin").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    placed = rows.join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b"))).drop("_s", "_b")
    inside = F.sum(step).over(Window.partitionBy("source", "_bin").orderBy("_order", "id", "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    marked = cut_lineage(placed.withColumn("_new", open_ & (F.col("_before") + inside <= F.col("_left"))).drop("_before"))
    gained = marked.groupBy(F.col("source").alias("_s")).agg(F.sum(F.when(F.col("_new"), F.col("size")).otherwise(0)).alias("_got"))
    return marked.join(gained, F.col("source").eqNullSafe(F.col("_s"))).withColumns({
        "_left": F.col("_left") - F.col("_got"), "_done": F.col("_done") | F.col("_new")}).drop("_s", "_got", "_new")
