"""Helpers that the corpus operators share."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.sources.folders import checkpoint_folder, shared_folder  # noqa: F401

#: White space in the sense of all operators here: space, tab, line feed, vertical tab, form feed, carriage return.
WS = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


#: Applications whose executors have this package.
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors' Python, once, so that they need no installation and no path of the driver's. Operators that
    run Python on executors call it for themselves."""
    package = Path(__file__).resolve().parent.parent
    if spark.sparkContext.applicationId in _SHIPPED or not package.is_dir():
        return
    folder = tempfile.mkdtemp(prefix="package-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    _SHIPPED.add(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def packed(docs: DataFrame, *apart: str) -> DataFrame:
    """docs with the columns apart, and the others in a struct rest, so that no name of theirs meets one of an operator."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in apart]
    return docs.select(*apart, F.struct(*(others or [F.lit(0).alias("none")])).alias("rest"))


def unpacked(columns: list[str], *apart: str) -> list[Column]:
    """The columns of a packed table, in this order."""
    return [F.col(f"`{c}`") if c in apart else F.col("rest").getField(c).alias(c) for c in columns]


def checkpointed(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the cluster's shared checkpoint folder."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def small_side(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """df for the small side of a join: computed once, broadcast only if it has at most max_rows rows, otherwise shuffled."""
    kept = checkpointed(df)
    return F.broadcast(kept) if kept.limit(max_rows + 1).count() <= max_rows else kept


def prefix_sums(rows: DataFrame, keys: list[str], order: str, value: str, chunk: int = 1024) -> DataFrame:
    """rows, of one row for each keys and order (a whole number), with before: the sum of value over the rows of the same keys
    and a lower order. Sums go over chunks of order and over the chunks' totals, so no task sums all rows of a key."""
    part = rows.withColumn("chunk", F.floor(F.col(order) / chunk).cast("long"))
    totals = part.groupBy(*keys, "chunk").agg(F.sum(value).alias("total"))
    over_chunks = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    carried = totals.select(*keys, "chunk", (F.sum("total").over(over_chunks) - F.col("total")).alias("carried"))
    within = Window.partitionBy(*keys, "chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    own = part.withColumn("before", F.sum(value).over(within) - F.col(value))
    return own.join(carried, [*keys, "chunk"]).withColumn("before", F.col("before") + F.col("carried")).drop("chunk", "carried")


def text_key(value: Column) -> Column:
    """A string that differs for every value and for null, so that nulls join and group like other values."""
    return F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), value.cast("string")))
