"""Merging of tables that grow by parts: latest version, sums, and restriction to touched keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], version: str, ties: list[str]) -> DataFrame:
    """Of each key the row of the largest version; of equal versions the first by ties."""
    order = Window.partitionBy(*keys).orderBy(F.col(version).desc(), *ties)
    return rows.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def folded(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows of equal keys folded into their sum."""
    return rows.groupBy(*keys).agg(F.sum(value).alias(value))


def touched(rows: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """The rows whose key occurs in part."""
    return rows.join(part.select(key).distinct(), key, "left_semi")


def routed(rows: DataFrame, by: str, kinds: tuple[str, ...]) -> dict[str, DataFrame]:
    """The rows of each kind, without the column that names it: one log, a target for each kind. Other kinds go nowhere."""
    return {kind: rows.where(F.col(by) == kind).drop(by) for kind in kinds}
