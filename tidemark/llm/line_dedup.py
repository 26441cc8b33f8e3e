"""Line deduplication with two Bloom filters, of lines seen once and lines seen twice."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpointed, packed, ship, unpacked
from tidemark.llm.textkit import small_batches, text_slices

BLANK = b" \t\n\x0b\x0c\r"
#: Bits of the filters for each line, and most bits of one filter: 128 MB, whatever the input. Beyond it more lines that
#: don't repeat are suspected and shuffled; the result stays exact.
BITS_PER_LINE, MOST_BITS = 16, 1 << 30
#: Bits that one task merges; positions that a task gathers before it hands them on.
BLOCK, MOST_HELD = 1 << 20, 4_000_000
PROBES = 2
#: Bits of the filter of marked documents for each of them, and most bits.
BITS_PER_DOC, MOST_DOC_BITS = 32, 1 << 28


def line_key(line: bytes) -> bytes:
    """The line without white space at both ends, A-Z lower-cased."""
    return line.strip(BLANK).lower()


def keys_of(text: bytes, least: int) -> list[bytes]:
    """The distinct keys of at least so many code points."""
    keys = {line_key(x) for x in text.split(b"\n") if len(x) >= least}
    return [k for k in keys if long_enough(k, least)]


def long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Positions of the probes of each hash, a column for each probe."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(hashes + np.uint64(i) * step) & np.uint64(bits - 1) for i in range(PROBES)], axis=1).astype(np.int64)


def _marks(batches: Iterator[pa.RecordBatch], bits: int, least: int, block: int) -> Iterator[pa.RecordBatch]:
    """For each block of the filters, the positions that lines of this task hit once and those that they hit twice or more. They are handed on
    whenever MOST_HELD are gathered, so no task holds a filter."""

    def marked(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        at, n = np.unique(np.concatenate(held), return_counts=True)
        edges = np.searchsorted(at, np.arange(0, bits + block, block))
        for i in np.flatnonzero(np.diff(edges)):
            own, seen = (at[edges[i] : edges[i + 1]] - i * block).astype(np.uint32), n[edges[i] : edges[i + 1]]
            yield pa.RecordBatch.from_pydict({"block": pa.array([i], pa.int32()), "once": [own.tobytes()], "twice": [own[seen > 1].tobytes()]})

    held, size = [], 0
    for _, texts in text_slices(batches):
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(k) for t in texts for k in keys_of(t, least)), np.uint64)
        at = positions(hashes, bits)
        held += [at[:, 0], at[at[:, 0] != at[:, 1], 1]]
        size += len(hashes) * PROBES
        if size >= MOST_HELD:
            yield from marked(held)
            held, size = [], 0
    if size:
        yield from marked(held)


def _merge(key: tuple, tables: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    once, twice = np.zeros(block, bool), np.zeros(block, bool)
    for batch in tables:
        for a, b in zip(batch.column("once").to_pylist(), batch.column("twice").to_pylist(), strict=True):
            a, b = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
            twice[a[once[a]]] = True
            twice[b] = True
            once[a] = True
    yield pa.RecordBatch.from_pydict({"block": pa.array([key[0].as_py()], pa.int32()), "bits": [np.packbits(twice, bitorder="little").tobytes()]})


def twice_seen(docs: DataFrame, least: int, most_bits: int) -> tuple[Broadcast, int]:
    """The filter of lines seen twice, broadcast, and its number of bits, at most most_bits.

    Each task marks the two filters for its own documents; blocks of all tasks' filters are merged apart from each other, where a
    position that two tasks have seen once has been seen twice.
    """
    lines = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()[0] or 0
    bits = min(most_bits, max(BLOCK, 1 << (BITS_PER_LINE * int(lines) - 1).bit_length()))
    block = min(BLOCK, bits)
    marks = docs.select("text").mapInArrow(lambda b: _marks(b, bits, least, block), "block int, once binary, twice binary")

    def merged(key: tuple, tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _merge(key, tables, block)

    blocks = marks.groupBy("block").applyInArrow(merged, "block int, bits binary")
    whole = np.zeros(bits >> 3, np.uint8)
    for row in blocks.toLocalIterator():
        whole[row["block"] * block >> 3 : (row["block"] + 1) * block >> 3] = np.frombuffer(row["bits"], np.uint8)
    return docs.sparkSession.sparkContext.broadcast(whole), bits


def _suspects(batches: Iterator[pa.RecordBatch], twice: Broadcast, bits: int, least: int) -> Iterator[pa.RecordBatch]:
    seen = twice.value
    for batch, texts in text_slices(batches):
        rows, keys = [], []
        for i, text in enumerate(texts):
            own = keys_of(text, least)
            rows += [i] * len(own)
            keys += own
        at = positions(np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys)), bits)
        hit = ((seen[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1).nonzero()[0]
        own = batch.select(["doc", "text_hash"]).take(pa.array([rows[i] for i in hit], pa.int64()))
        yield pa.RecordBatch.from_arrays([*own.columns, pa.array([digest(keys[i]) for i in hit], pa.binary())], ["doc", "text_hash", "digest"])


def marked_documents(drops: DataFrame) -> tuple[Broadcast, int]:
    """A filter of the keys of drops (column line_key), broadcast, and its number of bits, at most MOST_DOC_BITS."""
    bits = min(MOST_DOC_BITS, 1 << max(10, (BITS_PER_DOC * drops.count() - 1).bit_length()))
    at = F.pmod(F.col("line_key"), F.lit(bits))
    words = drops.select(F.shiftright(at, 5).alias("word"), F.expr(f"shiftleft(1L, CAST(pmod(line_key, {bits}) & 31 AS INT))").alias("bit"))
    words = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()  # at most MOST_DOC_BITS / 32 rows
    whole = np.zeros(bits >> 5, np.uint32)
    whole[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).astype(np.uint32)
    return drops.sparkSession.sparkContext.broadcast(whole), bits


def _is_marked(batch: pa.RecordBatch, filter_: np.ndarray, bits: int) -> np.ndarray:
    at = batch.column("line_key").to_numpy(zero_copy_only=False) % bits
    return (filter_[at >> 5] >> (at & 31).astype(np.uint32)) & 1 == 1


def _untouched(batches: Iterator[pa.RecordBatch], marked: Broadcast, bits: int) -> Iterator[pa.RecordBatch]:
    """The documents that lose nothing, as they are."""
    for batch in small_batches(batches):
        rows = batch.filter(pa.array(~_is_marked(batch, marked.value, bits)))
        text = pc.fill_null(rows.column("text"), "")
        lines = pc.cast(pc.add(pc.count_substring(text, "\n"), 1), pa.int64())
        columns = [rows.column("doc_id"), rows.column("rest"), text, lines, pa.array(np.zeros(rows.num_rows, np.int64))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "rest", "text", "n_lines", "n_dropped"])


def _suspected(batches: Iterator[pa.RecordBatch], marked: Broadcast, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in small_batches(batches):
        yield batch.filter(pa.array(_is_marked(batch, marked.value, bits)))


def _strip(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch, own in text_slices(batches):
        texts, counts, dropped = [], [], []
        for text, drop in zip(own, batch.column("line_digests").to_pylist(), strict=True):
            lines = text.split(b"\n")
            kept = lines
            if drop:
                gone = set(drop)
                kept = [x for x in lines if len(x) < least or not long_enough(k := line_key(x), least) or digest(k) not in gone]
            texts.append(b"\n".join(kept))
            counts.append(len(lines))
            dropped.append(len(lines) - len(kept))
        columns = [batch.column("doc_id"), batch.column("rest"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "rest", "text", "n_lines", "n_dropped"])


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, most_bits: int = MOST_BITS) -> DataFrame:
    """docs (doc_id, text, maybe more) without the lines that documents share, with n_lines (before dropping) and n_dropped.

    A line whose key has at least least_chars code points and is found in at least least_docs documents stays only in the largest
    doc_id that holds it, there every time it occurs. Null and empty texts are one empty line, and come out empty. A null
    doc_id counts as one document below all others; rows that repeat a doc_id are one document, and keep or lose a
    line together. Other columns stay as they are, whatever their names; columns n_lines and n_dropped of docs are replaced. An empty table
    gives an empty result.

    Only lines that the filter of twice-seen hashes holds are shuffled, as 16-byte digests of their keys; they are then
    counted exactly. Of texts only those that lose a line, and the few that a filter of these takes for such, are shuffled, to
    meet their drop lists, which are of a row's own lines.
    """
    ship(docs.sparkSession)
    others = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    docs = packed(docs.select(*[F.col(f"`{c}`") for c in others]), "doc_id", "text")
    doc, hashed = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("doc"), F.xxhash64("text").alias("text_hash")
    twice, bits = twice_seen(docs, least_chars, most_bits)
    suspects = docs.select(doc, "text", hashed).mapInArrow(lambda b: _suspects(b, twice, bits, least_chars), "doc long, text_hash long, digest binary")
    suspects = checkpointed(suspects)
    shared = suspects.groupBy("digest").agg(F.countDistinct("doc").alias("n"), F.max("doc").alias("keeper")).where(F.col("n") >= least_docs)
    shared = shared.select(F.hex("digest").alias("key"), "keeper")
    drops = suspects.withColumn("key", F.hex("digest")).join(shared, "key").where(F.col("doc") != F.col("keeper"))
    drops = drops.groupBy(F.xxhash64("doc", "text_hash").alias("line_key"), "doc", "text_hash").agg(F.collect_set("digest").alias("line_digests"))
    drops = checkpointed(drops)
    marked, doc_bits = marked_documents(drops)

    rows = docs.select("doc_id", "text", "rest", doc, hashed).withColumn("line_key", F.xxhash64("doc", "text_hash"))
    head = T.StructType([docs.schema["doc_id"], docs.schema["rest"]])
    done = T.StructType([*head, T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    whole = rows.select("doc_id", "text", "rest", "line_key").mapInArrow(lambda b: _untouched(b, marked, doc_bits), done)
    found = rows.mapInArrow(lambda b: _suspected(b, marked, doc_bits), rows.schema).join(drops, ["line_key", "doc", "text_hash"], "left")
    cut = found.select("doc_id", "rest", "text", "line_digests").mapInArrow(lambda b: _strip(b, least_chars), done)
    return whole.union(cut).select(*unpacked(others, "doc_id", "text"), "n_lines", "n_dropped")
