"""Mixing sources to target weights.

Rows get hash-random keys, are range-sorted by key within each source, and distributed prefix sums of their sizes cut each
source at its exact budget; budgets above a source's size repeat it for whole epochs first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, WS, checkpointed, small_side, text_key

#: Key ranges a source is cut into. A range is what one task sorts; it holds 1/1024 of a source's rows.
RANGES = 1024
#: A range is hot with more rows than this, and more than so many times the mean of its source: some id has most of them.
HOT_ROWS, HOT_TIMES = 10_000, 20
SEED = "mix-1"


def mix_key(doc_id: Column, seed: str = SEED) -> Column:
    """Hash-random key: 32 hexadecimal digits, uniform, the same in every run."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """Targets of the sources of sizes (source, source_size): adds weight and target.

    Sources in code point order, null last, get the weights in turn and share the total size. No target exceeds max_epochs
    times its source's size; what is above is shared again by weight. Sorting by size over weight makes the capped sources a
    prefix, so one pass of window sums finds the final level. One row per source is sorted in one task.
    """
    by_name, everything = Window.orderBy(F.col("source").asc_nulls_last()), Window.partitionBy()
    ranked = sizes.withColumn("pos", F.row_number().over(by_name)).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("pos") - 1, F.lit(len(weights))) + 1))
    cap = (F.lit(max_epochs) * F.col("source_size")).cast("long")
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "pos")
    ranked = (
        ranked.withColumn("cap", cap)
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("rest", F.col("total") - F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)) + F.col("cap"))
        .withColumn("rest_weight", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("rank", F.row_number().over(by_ratio))
        .withColumn("capped", F.col("weight") * F.col("rest") / F.col("rest_weight") > F.col("cap"))
        .withColumn("level", F.min(F.when(~F.col("capped"), F.struct("rank", "rest", "rest_weight"))).over(everything))
    )
    capped = F.col("level").isNull() | (F.col("rank") < F.col("level.rank"))
    target = F.when(capped, F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level.rest") / F.col("level.rest_weight"))
    return ranked.select("source", "source_size", "weight", target.alias("target"))


def _segmented(keyed: DataFrame, totals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """keyed and totals with mix_segment, which cuts hot ranges further, in key order: before the most frequent key, by size the rows of this key, and
    behind it. So rows that repeat an id meet in one task only if they are of one size too."""
    mean = F.avg("n").over(Window.partitionBy("mix_skey"))
    hot = totals.withColumn("mean", mean).where((F.col("n") > HOT_ROWS) & (F.col("n") > HOT_TIMES * F.col("mean"))).select("mix_skey", "mix_range")
    none = F.lit(0).cast("long")
    hot = checkpointed(hot)
    if not hot.limit(1).count():
        return keyed.withColumn("mix_segment", none), totals.withColumn("mix_segment", none)
    often = keyed.join(F.broadcast(hot), ["mix_skey", "mix_range"], "left_semi").groupBy("mix_skey", "mix_range", "mix_key").agg(F.count("*").alias("n"))
    often = often.groupBy("mix_skey", "mix_range").agg(F.max_by("mix_key", F.struct("n", "mix_key")).alias("mix_often"))
    own, often_key = F.col("mix_key"), F.col("mix_often")
    segment = F.when(own == often_key, F.col("mix_size") + 1).when(own > often_key, F.lit((1 << 63) - 1)).otherwise(none)
    keyed = keyed.join(small_side(often), ["mix_skey", "mix_range"], "left").withColumn("mix_segment", F.coalesce(segment, none)).drop("mix_often")
    return keyed, keyed.groupBy("mix_skey", "mix_range", "mix_segment").agg(F.sum("mix_size").alias("range_size"))


def mix_sources(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, seed: str = SEED) -> DataFrame:
    """How much of each row the mix takes.

    rows has doc_id, source and mix_size (long) and may have more columns, which stay; names with the prefix mix_ are this
    operator's. Adds mix_source_size, mix_target (double), mix_taken (long): whole epochs of the row, plus the part of it that
    lies before the source's budget in key order. The last row before the budget may be taken in part, so that the taken sizes of
    a source add up to its target, rounded. Rows that repeat an id are kept and ordered by size; equal ones are
    interchangeable. A null doc_id is hashed as the word null, a null source is a source of its own, sorted last.
    An empty table gives an empty result; a source of size 0 has target 0.
    """
    keyed = rows.withColumns({"mix_skey": text_key(F.col("source")), "mix_key": mix_key(F.col("doc_id"), seed)})
    keyed = keyed.withColumn("mix_range", F.shiftright(F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long") * RANGES, 32).cast("int"))
    totals = checkpointed(keyed.groupBy("mix_skey", "mix_range").agg(F.sum("mix_size").alias("range_size"), F.count("*").alias("n")))
    name = F.when(F.col("mix_skey") != "n", F.substring("mix_skey", 2, 1 << 30)).alias("source")  # sums alone keep the aggregates in hash tables
    targets = source_targets(totals.groupBy("mix_skey").agg(F.sum("range_size").alias("source_size")).select(name, "source_size"), weights, max_epochs)
    keyed, ranges = _segmented(keyed, totals)
    by_range = Window.partitionBy("mix_skey").orderBy("mix_range", "mix_segment").rowsBetween(Window.unboundedPreceding, 0)
    ranges = ranges.withColumn("mix_before", F.sum("range_size").over(by_range) - F.col("range_size"))
    targets = targets.select(text_key(F.col("source")).alias("mix_skey"), F.col("source_size").alias("mix_source_size"), F.col("target").alias("mix_target"))
    side = small_side(ranges.select("mix_skey", "mix_range", "mix_segment", "mix_before").join(targets, "mix_skey"))
    order = Window.partitionBy("mix_skey", "mix_range", "mix_segment").orderBy("mix_key", "doc_id", "mix_size")
    within = F.sum("mix_size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("mix_size")
    placed = keyed.withColumn("mix_within", within).join(side, ["mix_skey", "mix_range", "mix_segment"])
    budget = F.floor(F.col("mix_target") + 0.5).cast("long")
    epochs = F.when(F.col("mix_source_size") > 0, F.floor(budget / F.greatest(F.col("mix_source_size"), F.lit(1)))).otherwise(0).cast("long")
    left = budget - epochs * F.col("mix_source_size") - F.col("mix_before") - F.col("mix_within")
    taken = epochs * F.col("mix_size") + F.greatest(F.lit(0).cast("long"), F.least(left, F.col("mix_size")))
    return placed.withColumn("mix_taken", taken).drop("mix_skey", "mix_key", "mix_range", "mix_segment", "mix_before", "mix_within")


def mixed_copies(mixed: DataFrame) -> DataFrame:
    """The rows that the mix emits, from the result of mix_sources with a text column: a row for each epoch, the last one cut in
    its text behind the last word that the mix takes of it. Rows of size 0 aren't emitted."""
    whole = F.floor(F.col("mix_taken") / F.greatest(F.col("mix_size"), F.lit(1))).cast("int")
    part = (F.col("mix_taken") - whole * F.col("mix_size")).cast("int")
    copies = F.concat(F.array_repeat(F.lit(-1), whole), F.when(part > 0, F.array(part)).otherwise(F.array().cast("array<int>")))
    words = F.regexp_extract_all("text", F.lit(f"{WS}*{WORD}"), F.lit(0))  # each with the white space before it
    cut = F.array_join(F.slice(words, F.lit(1), F.greatest(F.col("mix_copy"), F.lit(1))), "")
    out = mixed.where(F.col("mix_taken") > 0).withColumn("mix_copy", F.explode(copies))
    return out.withColumn("text", F.when(F.col("mix_copy") < 0, F.col("text")).otherwise(cut)).drop("mix_copy")
