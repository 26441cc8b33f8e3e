"""The queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import classifier, fingerprints, jaccard_join, line_dedup, mixing, pieces, quality_rules, sharding, sql, urls, warc
from tidemark.llm.common import shared_folder, table, word_count


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and links of every document among those of similar word shingles."""
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and whether it passes the quality rules; its source is its host."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op3_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labelled documents that aren't held out."""
    out = classifier.score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    held_out = classifier.held_out(F.col("doc_id")).alias("held_out")
    return out.select("doc_id", held_out, "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that each document loses to the largest document that shares them, and the digest of what stays."""
    out = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("mix_size"))
    out = mixing.mix_sources(docs)
    return out.select("doc_id", *[F.col(f"mix_{n}").alias(n) for n in ("size", "source_size", "target", "taken")])


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of every document and of its edited version, and their likeness."""
    return fingerprints.fingerprint_versions(table(spark, sf_dir, "documents")).drop("edit", "step")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of the token ids of every document, and whether decoding them gives the text back."""
    return pieces.token_digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages hold of each page."""
    folder = shared_folder(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), folder)
    captures = warc.with_pages(warc.assemble(warc.read_warc(spark, folder, payloads=False)))
    digest = F.substring_index("payload_digest", ":", -1).alias("payload_digest")
    return captures.select("page_id", "payload_bytes", digest, F.col("type").alias("record_type"), F.col("refers_page").alias("refers_to"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, under the law of near equal bytes."""
    out = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url by the fixed rules and by rules mined from the labelled pages."""
    pages = table(spark, sf_dir, "pages")
    return urls.judge_urls(pages, urls.labelled_urls(pages, table(spark, sf_dir, "labels")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (
        op1_jaccard_join,
        op2_quality_rules,
        op3_classifier,
        op4_line_dedup,
        op5_mixing,
        op6_fingerprints,
        op7_sentencepiece,
        op8_warc,
        op9_sharding,
        op10_url_filter,
    )
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(sql.ORACLES)
