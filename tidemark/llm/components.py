"""Connected components by propagation of least labels with pointer jumping; nothing is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed


def components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(id, label) for vertices (id long, value): label is the least (value, id) that edges (a, b) reach from id.

    Labels travel along edges in both directions, and each round every vertex also takes over the label of the vertex that its
    label names, so chains halve; rounds end when no label changes, as they must, since labels only fall. Joins are on a hash of the id, so that Spark can split the partition of a vertex with very many
    edges. Each round is written to the checkpoint folder.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    both = checkpointed(both.withColumn("key", F.xxhash64("b")))
    labels = checkpointed(vertices.select("id", F.struct("value", "id").alias("label")))
    while True:
        named = labels.select(F.xxhash64("id").alias("key"), F.col("id").alias("named"), F.col("label").alias("other"))
        near = both.join(named, (both["key"] == named["key"]) & (F.col("b") == F.col("named"))).select(F.col("a").alias("id"), F.col("other").alias("label"), F.lit(True).alias("moved"))
        own = labels.select("id", "label", F.lit(False).alias("moved"))
        low = own.union(near).groupBy("id").agg(F.min("label").alias("label"), F.min(F.when(~F.col("moved"), F.col("label"))).alias("old")).where(F.col("old").isNotNull())
        low = low.withColumn("key", F.xxhash64("label.id"))
        jumped = low.join(named.withColumnRenamed("key", "key2"), (F.col("key") == F.col("key2")) & (F.col("label.id") == F.col("named")))
        labels = checkpointed(jumped.select("id", F.least("label", "other").alias("label"), "old"))
        if labels.where(F.col("label") != F.col("old")).limit(1).count() == 0:
            return labels.select("id", "label")
        labels = labels.select("id", "label")
