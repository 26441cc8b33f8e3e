"""Quality rules: statistics of single documents, and line frequency across the documents of a host.

Built-in expressions only. Arrays of words and windows are kept as columns of their own, so that lambdas read them by reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import text_key

BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"


def _covered(starts: Column, width: int) -> Column:
    """Positions that windows of this width cover, from their rising start positions."""
    steps = F.transform(starts, lambda x, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - x, F.lit(width))))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def base_statistics(rows: DataFrame, width: int = 5) -> DataFrame:
    """rows with a text column, plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; null text counts as empty.

    Repeated windows are found by 64-bit hashes: a row whose hashes are all distinct is done; the others are sorted with their positions.
    """
    body = F.coalesce(F.col("text"), F.lit(""))
    out = rows.withColumns(
        {
            "q_words": F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda x: x != ""),
            "q_lines": F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != ""),
            "n_symbols": F.regexp_count(body, F.lit(SYMBOLS)).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("q_words").cast("long"),
            "word_chars": F.length(F.array_join("q_words", "")).cast("long"),
            "n_dup_lines": (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long"),
            "q_hashes": F.transform("q_words", lambda x: F.xxhash64(x)),
        }
    )
    windows = F.transform("q_hashes", lambda x, i: F.xxhash64(x, *[F.get("q_hashes", i + k) for k in range(1, width)]))
    out = out.withColumn("q_windows", F.slice(windows, 1, F.greatest(F.size("q_hashes") - (width - 1), F.lit(0))))
    repeats = F.size(F.array_distinct("q_windows")) < F.size("q_windows")
    out = out.withColumn("q_sorted", F.when(repeats, F.sort_array(F.transform("q_windows", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))

    def twin(x: Column, other: Column) -> Column:
        return F.coalesce(x["h"] == other["h"], F.lit(False))

    starts = F.transform("q_sorted", lambda x, i: F.when(twin(x, F.get("q_sorted", i - 1)) | twin(x, F.get("q_sorted", i + 1)), x["p"]))
    out = out.withColumn("q_starts", F.sort_array(F.filter(starts, lambda x: x.isNotNull())))
    out = out.withColumn("n_repeat_words", F.coalesce(_covered(F.col("q_starts"), width), F.lit(0)).cast("long"))
    return out.drop("q_words", "q_lines", "q_hashes", "q_windows", "q_sorted", "q_starts")


def lines_of(rows: DataFrame, least_chars: int) -> DataFrame:
    """(row_key, line_at, chars, line_key, host) of each line whose normalised form, trimmed and in lower case, has least_chars."""
    line = F.posexplode(F.split(F.coalesce(F.col("text"), F.lit("")), "\n")).alias("line_at", "line")
    lines = rows.select("row_key", "host", line).withColumn("norm", F.lower(F.btrim("line", F.lit(BLANK))))
    return lines.where(F.length("norm") >= least_chars).select("row_key", "line_at", F.length("line").alias("chars"), F.xxhash64("host", "norm").alias("line_key"), "host")


def quality_rules(docs: DataFrame, host: str = "source", least_chars: int = 20, least_docs: int = 20, left_share: float = 0.3) -> DataFrame:
    """Statistics and verdict of every document.

    docs has doc_id, text and the host column; other columns are not read. Returns doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, n_removed_lines, removed_chars.

    base_failed: under 10 words, or over 20 % of the words in repeated windows. A line of at least least_chars code points is
    removed from all documents of a host where it is found in more than least_docs of them, however many documents the host has. A
    document of which less than left_share of the characters stays is depleted; depleted and base_failed ones aren't kept. Null text
    counts as empty and fails; a null host is a host of its own. Each row counts as a document: rows that repeat a doc_id
    get a row each. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", text_key(F.col(host)).alias("host"))
    rows = rows.withColumn("row_key", F.xxhash64("doc_id", "text", "host"))
    lines = lines_of(rows, least_chars)
    # in a row a line counts once: only its first place goes into the count
    split = F.split(F.coalesce("text", F.lit("")), "\n")
    norms = F.filter(F.transform(split, lambda x: F.lower(F.btrim(x, F.lit(BLANK)))), lambda x: F.length(x) >= least_chars)
    per_row = F.array_distinct(F.transform(norms, lambda x: F.xxhash64(F.col("host"), x)))
    counted = rows.select(F.explode(per_row).alias("line_key")).groupBy("line_key").agg(F.count("*").alias("n")).where(F.col("n") > least_docs)
    # a key of its own on both sides, so that a line of very many documents is a partition that Spark splits
    frequent = counted.select(F.xxhash64("line_key").alias("join_key"), "line_key")
    hits = lines.withColumn("join_key", F.xxhash64("line_key")).join(frequent, ["join_key", "line_key"]).select("row_key", "line_at", "chars")
    removed = hits.groupBy("row_key", "line_at").agg(F.max("chars").alias("chars")).groupBy("row_key").agg(F.count("*").alias("n_removed_lines"), F.sum("chars").cast("long").alias("removed_chars"))
    total = F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))).cast("long")
    base = base_statistics(rows).withColumn("total_chars", total).drop("text", "host")
    out = base.join(removed, "row_key", "left").fillna(0, ["n_removed_lines", "removed_chars"])
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    depleted = F.col("total_chars") - F.col("removed_chars") < left_share * F.col("total_chars")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select(*names, failed.alias("base_failed"), (~failed & ~depleted).alias("kept"), "n_removed_lines", "removed_chars")
