"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.classifier import score_documents
from tidemark.llm.common import checkpointed, packed, shared_folder, small_side, table, unpacked, word_count
from tidemark.llm.jaccard_join import jaccard_join
from tidemark.llm.line_dedup import dedup_lines
from tidemark.llm.mixing import mix_sources, mixed_copies
from tidemark.llm.pieces import encode_documents
from tidemark.sources.folders import remove

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_new_text(columns: list[str], *apart: str) -> list[Column]:
    """The columns of a packed table whose text has changed: n_chars follows it."""
    out = unpacked(columns, *apart)
    return [F.length("text").cast("long").alias(c) if c == "n_chars" else column for c, column in zip(columns, out, strict=True)]


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores 0.3 or more. All columns stay, whatever their names; so they do in the other stages."""
    own = ("doc_id", "text")
    kept = score_documents(packed(docs, *own), table(spark, sf_dir, "labels")).where(F.col("score") >= 0.3)
    return kept.select(*unpacked(docs.columns, *own))


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a larger doc_id keeps; n_chars follows the text."""
    own = ("doc_id", "text")
    return dedup_lines(packed(docs, *own)).select(*_with_new_text(docs.columns, *own))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of similar documents, that of least doc_id, null last, and among rows of that id of least hash of the
    text. Texts without words are classes of their own; of rows that repeat id and text, one."""
    own = ("doc_id", "text")
    told = checkpointed(jaccard_join(docs, tell_rows=True).select("doc_id", "text_hash", "class_set"))
    alone = F.col("class_set").isNull()
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")).alias("first")
    classes = told.groupBy("class_set", F.when(alone, F.col("doc_id")), F.when(alone, F.col("text_hash"))).agg(first)
    classes = classes.select(F.col("first.doc_id").alias("kept_id"), F.col("first.text_hash").alias("kept_hash"))
    rows = packed(docs, *own).withColumn("text_hash", F.xxhash64("text"))
    kept = rows.join(classes, rows["doc_id"].eqNullSafe(F.col("kept_id")) & (F.col("text_hash") == F.col("kept_hash")), "left_semi")
    repeats = checkpointed(told.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again"), F.col("text_hash").alias("again_hash")))
    if repeats.limit(1).count():
        side = small_side(repeats)
        same = kept["doc_id"].eqNullSafe(F.col("again")) & (F.col("text_hash") == F.col("again_hash"))
        one = kept.join(side, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
        kept = kept.join(side, same, "left_anti").unionByName(one)
    return kept.select(*unpacked(docs.columns, *own))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, a row for each epoch; the document at a source's budget is cut there."""
    own = ("doc_id", "text", "source")
    mixed = mix_sources(packed(docs, *own).withColumn("mix_size", word_count(F.col("text"))))
    return mixed_copies(mixed).select(*_with_new_text(docs.columns, *own))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row's text."""
    encoded = encode_documents(docs.select("doc_id", "lang", "source", "text"))
    return encoded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("line_dedup", dedup),
    ("jaccard_join", join_near_duplicates),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: A trained classifier has no SQL form; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the table documents of sf_dir. Stages are written to the cluster's shared folder; each is removed when
    the next one is written, and the last when the application ends."""
    folder = shared_folder(spark, "pipeline")
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs.write.mode("overwrite").parquet(f"{folder}/{i}-{name}")
            docs = spark.read.parquet(f"{folder}/{i}-{name}")
            if before:
                remove(spark, before)
            before = f"{folder}/{i}-{name}"
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
