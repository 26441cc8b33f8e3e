"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages. Every passage is encoded from learned embeddings of its words, of their first and last bytes and of
all its bytes; gated attention weights the encodings, and the weighted sum is scored. Embeddings, encoder, attention and output
are trained together from document labels.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpointed, ship
from tidemark.llm.textkit import mix, text_slices, words_of

#: Words of a passage; most labelled documents, and passages of them, that training takes.
PASSAGE, MOST_DOCS, MOST_PASSAGES = 64, 4000, 40_000
#: Embeddings of hashed n-grams; their width; width of encodings and of attention.
BUCKETS, EMBEDDED, HIDDEN, ATTENTION = 1 << 14, 8, 16, 8
#: Numbers that describe a passage besides its n-grams and bytes.
STATS = 4


@dataclass
class Bags:
    """Documents as bags of passages: grams holds the buckets of all n-grams, those of passage i from at[i] to at[i + 1]; chars the
    share of each byte in each passage; stats its other numbers; and the passages of document i go from begin[i] to begin[i + 1]."""

    grams: np.ndarray
    at: np.ndarray
    chars: np.ndarray
    stats: np.ndarray
    begin: np.ndarray

    def take(self, docs: np.ndarray) -> Bags:
        passages, begin = _rows(self.begin, docs)
        grams, at = _rows(self.at, passages)
        return Bags(self.grams[grams], at, self.chars[passages], self.stats[passages], begin)

    @staticmethod
    def join(bags: list[Bags]) -> Bags:
        if not bags:
            return bags_of([])
        ends = lambda xs: np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x) for x in xs]))])
        whole = [np.concatenate([getattr(x, n) for x in bags]) for n in ("grams", "chars", "stats")]
        return Bags(whole[0], ends([x.at for x in bags]), whole[1], whole[2], ends([x.begin for x in bags]))

    def pack(self) -> bytes:
        """One document's bag; shares of bytes keep three digits."""
        parts = (np.diff(self.at).astype(np.uint16), self.grams.astype(np.uint16), np.round(self.chars * 65535).astype(np.uint16), self.stats.astype(np.float32))
        return zlib.compress(b"".join(x.tobytes() for x in parts), 1)

    @staticmethod
    def unpack(raw: bytes, passages: int) -> Bags:
        raw = zlib.decompress(raw)
        sizes = np.frombuffer(raw, np.uint16, passages)
        at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        here = 2 * passages
        grams = np.frombuffer(raw, np.uint16, int(at[-1]), here)
        here += 2 * int(at[-1])
        chars = np.frombuffer(raw, np.uint16, 256 * passages, here).reshape(-1, 256).astype(np.float32) / 65535
        stats = np.frombuffer(raw, np.float32, STATS * passages, here + 512 * passages).reshape(-1, STATS)
        return Bags(grams, at, chars, stats, np.array([0, passages]))


def _rows(begin: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Members of the groups which, group by group, and where each of them begins; group i has begin[i] to begin[i + 1]."""
    sizes = begin[which + 1] - begin[which]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return np.repeat(begin[which] - ends[:-1], sizes) + np.arange(ends[-1]), ends


def bags_of(texts: list[bytes]) -> Bags:
    """Bags of the whole texts; a text without words is one passage without n-grams and bytes."""
    w = words_of(texts)
    counts = np.diff(w.begin)
    begin = np.concatenate([[0], np.cumsum(np.maximum(1, -(-counts // PASSAGE)))])
    total = int(begin[-1])
    stats, sizes = np.zeros((total, STATS), np.float32), np.zeros(total, np.int64)
    if not len(w.start):
        return Bags(np.zeros(0, np.uint16), np.zeros(total + 1, np.int64), np.zeros((total, 256), np.float32), stats, begin)
    text = np.repeat(np.arange(len(texts)), counts)
    passage = begin[text] + (np.arange(len(text)) - w.begin[text]) // PASSAGE
    head = np.flatnonzero(np.append(True, passage[1:] != passage[:-1]))
    of, n = passage[head], np.diff(np.append(head, len(passage)))
    length = (w.end - w.start).astype(np.int64)

    # each word gives three buckets: of itself, of its first three bytes and of its last three
    data = np.concatenate([w.data, np.zeros(3, np.uint8)]).astype(np.uint64)
    first = [np.where(length > i, data[w.start + i], 0) for i in range(3)]
    last = [np.where(length > i, data[w.end - 1 - i], 0) for i in range(3)]
    code = lambda x, kind: mix(x[0] | x[1] << np.uint64(8) | x[2] << np.uint64(16) | np.uint64(kind << 32))
    grams = np.stack([w.hashes, code(first, 1), code(last, 2)], axis=1) % np.uint64(BUCKETS)
    sizes[of] = 3 * n

    # bytes from the first of the passage's words to the end of its last one
    start, end = w.start[head], w.end[head + n - 1]
    span, _ = _rows(np.concatenate([[0], np.cumsum(end - start)]), np.arange(len(of)))
    span += np.repeat(start - np.concatenate([[0], np.cumsum(end - start)[:-1]]), end - start)
    owner = np.repeat(of, end - start)
    chars = np.bincount(owner * 256 + w.data[span], minlength=256 * total).reshape(-1, 256).astype(np.float32)
    chars[of] /= (end - start)[:, None]

    key = np.sort((passage.astype(np.uint64) << np.uint64(40)) | (w.hashes >> np.uint64(24)))
    new = np.append(True, key[1:] != key[:-1])
    again = np.append(False, (w.hashes[1:] == w.hashes[:-1]) & (passage[1:] == passage[:-1]))
    stats[of, 0] = np.log1p(n) / 4
    stats[of, 1] = np.add.reduceat(length, head) / n / 10
    stats[of, 2] = np.add.reduceat(again.astype(np.int64), head) / n
    stats[of, 3] = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=total)[of] / n
    return Bags(grams.ravel().astype(np.uint16), np.concatenate([[0], np.cumsum(sizes)]), chars, stats, begin)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _sums(rows: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Sums of the rows of each group; groups may be empty."""
    out = np.zeros((len(begin) - 1, *rows.shape[1:]), rows.dtype)
    some = np.flatnonzero(np.diff(begin))
    if len(some):
        out[some] = np.add.reduceat(rows, begin[some])
    return out


def new_model(bags: Bags, share: float, seed: int = 7) -> dict:
    """Model before training: E and C embed n-grams and bytes; W and b encode; V, c, U, d and w attend; o and p score."""
    r, inputs = np.random.default_rng(seed), 2 * EMBEDDED + STATS
    normal = lambda *shape: r.normal(0, shape[0] ** -0.5, shape)
    return {
        "mean": bags.stats.mean(0), "scale": bags.stats.std(0) + 1e-3, "E": r.normal(0, 1, (BUCKETS, EMBEDDED)).astype(np.float32), "C": r.normal(0, 3, (256, EMBEDDED)),
        "W": normal(inputs, HIDDEN), "b": np.zeros(HIDDEN), "V": normal(HIDDEN, ATTENTION), "c": np.zeros(ATTENTION), "U": normal(HIDDEN, ATTENTION), "d": np.zeros(ATTENTION),
        "w": normal(ATTENTION), "o": np.zeros(HIDDEN), "p": np.array(np.log(share / (1 - share))),
    }


LEARNED = ("E", "C", "W", "b", "V", "c", "U", "d", "w", "o", "p")


def forward(model: dict, bags: Bags) -> tuple:
    """Score of each bag, with what training needs to go back."""
    n = np.maximum(1, np.diff(bags.at))[:, None]
    grams = _sums(model["E"][bags.grams], bags.at) / n
    x = np.concatenate([grams, bags.chars @ model["C"], (bags.stats - model["mean"]) / model["scale"]], axis=1)
    h = np.tanh(x @ model["W"] + model["b"])
    t, g = np.tanh(h @ model["V"] + model["c"]), _sigmoid(h @ model["U"] + model["d"])
    e = (t * g) @ model["w"]
    sizes = np.diff(bags.begin)
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, bags.begin[:-1]), sizes))
    a = e / np.repeat(np.add.reduceat(e, bags.begin[:-1]), sizes)
    z = np.add.reduceat(h * a[:, None], bags.begin[:-1])
    return _sigmoid(z @ model["o"] + model["p"]), x, h, t, g, a, z


def gradient(model: dict, bags: Bags, labels: np.ndarray) -> dict:
    """Gradient of the mean cross-entropy of the labels in every learned parameter."""
    y, x, h, t, g, a, z = forward(model, bags)
    sizes = np.diff(bags.begin)
    dy = (y - labels) / len(labels)
    dz = np.repeat(dy[:, None] * model["o"], sizes, axis=0)
    da = (dz * h).sum(1)
    de = a * (da - np.repeat(np.add.reduceat(a * da, bags.begin[:-1]), sizes))
    dt, dg = de[:, None] * model["w"] * g * (1 - t * t), de[:, None] * model["w"] * t * g * (1 - g)
    dh = (dz * a[:, None] + dt @ model["V"].T + dg @ model["U"].T) * (1 - h * h)
    dx = dh @ model["W"].T
    n = np.diff(bags.at)
    each = np.repeat(dx[:, :EMBEDDED] / np.maximum(1, n)[:, None], n, axis=0)
    grams = np.stack([np.bincount(bags.grams, each[:, i], BUCKETS) for i in range(EMBEDDED)], axis=1)
    return {
        "o": z.T @ dy, "p": dy.sum(), "w": (t * g).T @ de, "V": h.T @ dt, "c": dt.sum(0), "U": h.T @ dg, "d": dg.sum(0), "W": x.T @ dh, "b": dh.sum(0),
        "C": bags.chars.T @ dx[:, EMBEDDED : 2 * EMBEDDED], "E": grams,
    }


def train(bags: Bags, labels: np.ndarray, epochs: int = 8, batch: int = 128, rate: float = 0.02, seed: int = 7, least_steps: int = 200) -> dict:
    """Model by Adam, over at least so many epochs and steps; the same bags in the same order give the same model. With one class only, or
    none, the score is the same for all: the share of label 1, or a half."""
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        return {"constant": share}
    r, model = np.random.default_rng(seed), new_model(bags, share, seed)
    m, v, step = {k: 0 * model[k] for k in LEARNED}, {k: 0 * model[k] for k in LEARNED}, 0
    epochs = max(epochs, -(-least_steps // -(-len(labels) // batch)))
    for epoch in range(epochs):
        order = r.permutation(len(labels))
        for i in range(0, len(order), batch):
            own = order[i : i + batch]
            grad = gradient(model, bags.take(own), labels[own])
            step += 1
            for k in LEARNED:
                gk = (grad[k] + (1e-4 * model[k] if k in "CWVUwo" else 0)).astype(model[k].dtype)
                m[k] = 0.9 * m[k] + 0.1 * gk
                v[k] = 0.999 * v[k] + 0.001 * gk * gk
                model[k] = model[k] - rate * (1 - epoch / epochs) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return {k: x.astype(np.float32) for k, x in model.items()}


def scores(model: dict, texts: list[bytes]) -> np.ndarray:
    if "constant" in model:
        return np.full(len(texts), model["constant"])
    return forward(model, bags_of(texts))[0]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text is a multiple of 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        bags = bags_of(texts)
        sizes = np.diff(bags.begin)
        packed = [bags.take(np.array([i])).pack() for i in range(len(texts))]
        columns = {n: batch.column(n) for n in ("doc_id", "quality", "text_hash")}
        yield pa.RecordBatch.from_pydict({**columns, "passages": pa.array(sizes, pa.int64()), "bag": pa.array(packed, pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS, most_passages: int = MOST_PASSAGES) -> dict:
    """Model learned from labels (doc_id, quality) of docs (doc_id, text), without the rows held out.

    Learned from are at most most_docs labelled ids, those of the least hash, as far as their documents have at most most_passages
    passages together; a document that would exceed them is passed over. An id labelled twice counts by its larger label, and of rows
    that repeat an id the one of least hash of the text is learned from. Null labels and ids don't count. Hashed n-grams
    and shares of bytes come to the driver, not texts.
    """
    spark = docs.sparkSession
    ship(spark)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_docs).collect()  # at most most_docs rows
    place = {r["doc_id"]: i for i, r in enumerate(picked)}
    side = spark.createDataFrame([(r["doc_id"], int(r["quality"])) for r in picked], "doc_id long, quality int")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(F.broadcast(side), "doc_id")
    found = rows.mapInArrow(_bags, "doc_id long, quality int, text_hash long, passages long, bag binary")
    one = F.min(F.struct("text_hash", "passages", "quality", "bag")).alias("one")
    found = checkpointed(found.groupBy("doc_id").agg(one).select("doc_id", "one.passages", "one.quality", "one.bag"))
    chosen, left = [], most_passages
    for r in sorted(found.select("doc_id", "passages").collect(), key=lambda r: place[r["doc_id"]]):
        if r["passages"] <= left:
            chosen.append(r["doc_id"])
            left -= r["passages"]
    wanted = spark.createDataFrame([(x,) for x in chosen], "doc_id long")
    rows = sorted(found.join(F.broadcast(wanted), "doc_id").collect(), key=lambda r: place[r["doc_id"]])  # at most most_passages passages
    bags = Bags.join([Bags.unpack(bytes(r["bag"]), r["passages"]) for r in rows])
    return train(bags, np.array([r["quality"] for r in rows], np.float64))


def _scored(batches: Iterator[pa.RecordBatch], model: dict) -> Iterator[pa.RecordBatch]:
    for batch, texts in text_slices(batches):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores(model, texts).astype(np.float64))], [*batch.schema.names, "score"])


def score_documents(docs: DataFrame, labels: DataFrame, most_docs: int = MOST_DOCS) -> DataFrame:
    """docs with score (0 to 1, higher: quality 1 is likelier), from the whole text alone.

    Null and empty texts are scored as one empty passage. Other columns stay as they are; a column score of docs is replaced.
    Repeated rows stay. Without labels every score is 0.5; an empty table gives an empty result.
    """
    docs = docs.drop("score")
    ship(docs.sparkSession)
    model = fit(docs, labels, most_docs)
    schema = T.StructType([*docs.schema, T.StructField("score", T.DoubleType())])
    return docs.mapInArrow(lambda batches: _scored(batches, model), schema)
