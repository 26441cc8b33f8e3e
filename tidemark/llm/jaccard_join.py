"""N-gram Jaccard join by chosen paths.

Sets of word shingles are split recursively: a node samples coordinates of the sets' min-hash vectors and sends each set to a child for
each sampled coordinate and its value, so that similar sets stay together with a probability of at least one over the depth. Small
nodes are compared by brute force; many independent runs bring the recall to its target. A pair is compared in the least node that both
sets share, and nodes of many sets don't enumerate pairs that are certain to meet in a lesser one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, ship, small_side
from tidemark.llm.components import components
from tidemark.llm.textkit import mix, text_slices, words_of

#: Coordinates of a set's min-hash vector; levels of splitting; sets, and shingles of them, in a block of a node. Two blocks are compared at once.
COORDINATES, DEPTH, BUCKET, BLOCK_SHINGLES = 64, 3, 512, 4_000_000
#: Standard deviations below the expected agreement of min-hash vectors at which a pair is no candidate any more.
SLACK = 4.3
_R = np.random.default_rng(611953)
_A = _R.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _R.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
NO_ID = (1 << 63) - 1


def least_agreement(similarity: float) -> int:
    """Coordinates in which the min-hash vectors of a candidate pair agree at least."""
    return math.ceil(COORDINATES * (similarity - SLACK * math.sqrt(similarity * (1 - similarity) / COORDINATES)))


def filter_loss(similarity: float) -> float:
    """Chance that the vectors of a pair of this similarity agree in fewer coordinates: 4e-5 at 0.8."""
    return sum(math.comb(COORDINATES, k) * similarity**k * (1 - similarity) ** (COORDINATES - k) for k in range(least_agreement(similarity)))


def runs_for(recall: float, similarity: float, depth: int = DEPTH) -> int:
    """Runs that find a pair of this similarity with the recall, if all of its nodes split down to depth: a node's children share
    a coordinate sampled at rate 1 / (similarity * COORDINATES) with the chance that the recursion below computes. What the filter of
    candidates loses counts as well."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - (1 - alive / COORDINATES) ** COORDINATES
    missed = 1 - recall / (1 - filter_loss(similarity))
    if missed <= 0:
        raise ValueError(f"a recall of {recall} is beyond the filter of candidates")
    return math.ceil(math.log(missed) / math.log(1 - alive))


def sampled(node: np.ndarray, similarity: float) -> np.ndarray:
    """Mask (nodes, coordinates): which coordinates each node samples, by hash of node and coordinate."""
    h = mix(node[:, None] + _A[None, :])
    return h < np.uint64(int(2**64 / (similarity * COORDINATES)))


def child(node: np.ndarray, coordinate: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(mix(node ^ _B[coordinate]) + value.astype(np.uint64))


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Rising distinct hashes of the shingles of each text. A text of fewer words has one shingle, all its words; one
    without words has none."""
    w = words_of(texts)
    x, out = w.hashes, []
    if len(x) >= width:
        n = len(x) - width + 1
        grams = x[:n].copy()
        for k in range(1, width):
            grams = mix(grams * np.uint64(3) + x[k : k + n])
    for a, b in zip(w.begin[:-1], w.begin[1:], strict=True):
        if b - a >= width:
            out.append(np.unique(grams[a : b - width + 1]))
        elif b > a:
            whole = x[a : a + 1] + np.uint64(b - a)
            for k in range(a + 1, b):
                whole = mix(whole * np.uint64(3) + x[k : k + 1])
            out.append(whole)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(values: np.ndarray) -> int:
    return int(mix(np.array([mix(values).sum(dtype=np.uint64) + np.uint64(len(values))]))[0].view(np.int64))


def _signed(batches: Iterator[pa.RecordBatch], width: int, runs: int, similarity: float) -> Iterator[pa.RecordBatch]:
    roots = mix(np.arange(runs, dtype=np.uint64) + np.uint64(99))
    run, coordinate = np.nonzero(sampled(roots, similarity))
    for batch, texts in text_slices(batches):
        sets = shingle_sets(texts, width)
        full = [i for i, s in enumerate(sets) if len(s)]
        sizes = np.array([len(s) for s in sets])
        signatures = np.zeros((len(sets), COORDINATES), np.uint32)
        if full:
            values = np.concatenate([sets[i] for i in full])
            at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
            for t in range(COORDINATES):
                signatures[full, t] = np.minimum.reduceat((values * _A[t] + _B[t]) >> np.uint64(32), at)
        keys = child(roots[run][None, :], coordinate[None, :], signatures[:, coordinate]).view(np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.where(sizes > 0, keys.shape[1], 0))])
        yield pa.RecordBatch.from_pydict(
            {
                "doc": batch.column("doc"), "set_id": pa.array([set_id(s) for s in sets], pa.int64()), "size": pa.array(sizes, pa.int64()), "signature": pa.array([x.tobytes() for x in signatures], pa.binary()),
                "keys": pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[sizes > 0].ravel(), pa.int64())),
                **{n: batch.column(n) for n in batch.schema.names if n not in ("doc", "text")},
            }
        )


def _split(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            node = batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            row, coordinate = np.nonzero(sampled(node, similarity))
            children = child(node[row], coordinate, signature[row, coordinate]).view(np.int64)
            own = batch.select(["set_id", "size"]).take(pa.array(row))
            yield pa.RecordBatch.from_arrays([pa.array(children), *own.columns], ["node", "set_id", "size"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of the same node, low and high block, together in one table of one or many groups; rows come sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for name in ("node", "low", "high"):
            values = batch.column(name).to_numpy(zero_copy_only=False)
            same &= values == values[-1]
        cut = batch.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
        if held and cut == 0 and all(held[-1].column(n)[-1].as_py() == batch.column(n)[0].as_py() for n in ("node", "low", "high")):
            held.append(batch)
            continue
        if cut == 0:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
            continue
        yield pa.Table.from_batches([*held, batch.slice(0, cut)])
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def _ranges(table: pa.Table) -> list[tuple[int, int]]:
    columns = [table.column(n).to_numpy() for n in ("node", "low", "high")]
    if not len(columns[0]):
        return []
    new = np.append(True, np.any([c[1:] != c[:-1] for c in columns], axis=0))
    at = np.flatnonzero(new)
    return list(zip(at.tolist(), np.append(at[1:], len(new)).tolist(), strict=True))


def _first_shared(a: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least node that the lists of each pair share."""
    width = max(len(x) for x in a)
    lists = np.full((len(a), width), np.iinfo(np.int64).max)
    for k, x in enumerate(a):
        lists[k, : len(x)] = np.sort(x)
    out = np.zeros(len(i), np.int64)
    step = max(1, 2_000_000 // (width * width))
    for s in range(0, len(i), step):
        x, y = lists[i[s : s + step]], lists[j[s : s + step]]
        shared = (x[:, :, None] == y[:, None, :]).any(2)
        out[s : s + step] = np.where(shared, x, np.iinfo(np.int64).max).min(1)
    return out


def _pairs(block: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    if low == high:
        return np.triu_indices(len(block), 1)
    a, b = np.flatnonzero(block == low), np.flatnonzero(block == high)
    return np.repeat(a, len(b)), np.tile(b, len(a))


MEMBER = ("node", "low", "high", "block", "set_id", "copies", "nodes")


def _candidates(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Members of nodes that have a candidate there: a member whose min-hash vector agrees enough, and with which no lesser node is shared."""
    for table in _groups(batches):
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
        nodes, block = table.column("nodes").to_pylist(), table.column("block").to_numpy()
        node, low, high = (table.column(n).to_numpy() for n in ("node", "low", "high"))
        keep = np.zeros(table.num_rows, bool)
        for a, b in _ranges(table):
            if b - a < 2:
                continue
            i, j = _pairs(block[a:b], low[a], high[a])
            alike = np.concatenate([(signature[a + i[s : s + 20_000]] == signature[a + j[s : s + 20_000]]).sum(1) for s in range(0, len(i), 20_000)]) if len(i) else np.zeros(0)
            near = np.flatnonzero(alike >= least)
            if len(near):
                i, j = i[near], j[near]
                own = _first_shared([np.array(x) for x in nodes[a:b]], i, j) == node[a]
                keep[a + i[own]] = keep[a + j[own]] = True
        yield from table.select(list(MEMBER)).take(pa.array(np.flatnonzero(keep))).to_batches()


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs, by products of incidence matrices over parts of the vocabulary."""
    values = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(values)
    values, row = values[order], row[order]
    new = np.append(True, values[1:] != values[:-1])
    shared = np.repeat(np.diff(np.append(np.flatnonzero(new), len(values))) > 1, np.diff(np.append(np.flatnonzero(new), len(values))))
    values, row = values[shared], row[shared]
    out = np.zeros((len(sets), len(sets)), np.float32)
    if not len(values):
        return out
    code = np.cumsum(np.append(True, values[1:] != values[:-1])) - 1
    for begin in range(0, int(code[-1]) + 1, 4096):
        a, b = np.searchsorted(code, [begin, begin + 4096])
        part = np.zeros((len(sets), 4096), np.float32)
        part[row[a:b], code[a:b] - begin] = 1
        out += part @ part.T
    return out


def _links(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """Exact links of each node's members that no lesser node has: their number and documents for each set, and a set that it is joined to."""
    for table in _groups(batches):
        nodes, block, ids, copies = table.column("nodes").to_pylist(), table.column("block").to_numpy(), table.column("set_id").to_numpy(), table.column("copies").to_numpy()
        node, low, high, raw = *(table.column(n).to_numpy() for n in ("node", "low", "high")), table.column("shingles").to_pylist()
        for a, b in _ranges(table):
            _, first = np.unique(ids[a:b], return_index=True)
            at = a + np.sort(first)
            if len(at) < 2:
                continue
            sets = [np.frombuffer(raw[k], np.uint64) for k in at]
            size = np.array([len(s) for s in sets], np.float64)
            i, j = _pairs(block[at], low[a], high[a])
            if len(at) <= 6:
                both = np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(i, j, strict=True)], np.float64)
            else:
                both = intersections(sets)[i, j].astype(np.float64)
            good = both + 1e-9 >= similarity * (size[i] + size[j] - both)
            i, j = i[good], j[good]
            if not len(i):
                continue
            own = _first_shared([np.array(nodes[k]) for k in at], i, j) == node[a]
            i, j = i[own], j[own]
            if not len(i):
                continue
            links = np.bincount(i, minlength=len(at)) + np.bincount(j, minlength=len(at))
            docs = np.bincount(i, copies[at][j], len(at)) + np.bincount(j, copies[at][i], len(at))
            root = np.arange(len(at))
            while True:
                least = root.copy()
                np.minimum.at(least, i, root[j])
                np.minimum.at(least, j, root[i])
                least = least[least]
                if (least == root).all():
                    break
                root = least
            has = np.flatnonzero(links)
            yield pa.RecordBatch.from_pydict({"set_id": ids[at[has]], "n": links[has].astype(np.int64), "docs": docs[has].astype(np.int64), "root": ids[at[root[has]]]})


def _shingles(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for _, texts in text_slices(batches):
        sets = [s for s in shingle_sets(texts, width) if len(s)]
        yield pa.RecordBatch.from_pydict({"set_id": pa.array([set_id(s) for s in sets], pa.int64()), "shingles": pa.array([s.tobytes() for s in sets], pa.binary())})


def _cells(found: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows (node, low, high, block, set_id, copies, nodes, signature) that bring the members of every node together in pairs of blocks.

    found is (set_id, node, n, shingles) with the node's sets and their shingles. A node of up to two blocks is one block. In a larger
    one, members of the same least node are kin if they fill a block and that node is another: every pair of them meets
    there, so blocks of one kin aren't paired with each other. A large group of similar texts, which shares most of its nodes, is thus paired
    block by block in one of them instead of in all.
    """
    per_set = found.groupBy("set_id").agg(F.collect_set(F.struct("node", "n", "shingles")).alias("in"))
    per_set = per_set.withColumn("nodes", F.transform("in", lambda x: x["node"])).withColumn("least", F.array_min("nodes"))
    blocks = F.ceil(F.greatest(F.col("n") / BUCKET, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    at = per_set.select("set_id", "nodes", "least", F.inline("in")).withColumn("blocks", blocks)
    at = checkpointed(at.join(sets.select("set_id", "copies", "size", "signature"), "set_id"))
    member = ("node", "low", "high", "block", "set_id", "copies", "nodes", "signature")
    zero = F.lit(0).cast("long")
    small = at.where("blocks <= 2").withColumns({"low": zero, "high": zero, "block": zero}).select(*member)
    large = at.where("blocks > 2")
    if not large.limit(1).count():
        return small

    kin = large.where("least <> node").groupBy("node", "least").agg(F.count("*").alias("kin_n"), F.sum("size").alias("kin_shingles"))
    kin = kin.where(F.col("kin_n") >= BUCKET).withColumn("kin", F.row_number().over(Window.partitionBy("node").orderBy("least")).cast("long"))
    kin_blocks = F.ceil(F.greatest(F.col("kin_n") / BUCKET, F.col("kin_shingles") / BLOCK_SHINGLES))
    kin = checkpointed(kin.withColumn("kin_blocks", kin_blocks.cast("long")).withColumn("key", F.xxhash64("node", "least")))
    by_node = kin.groupBy("node").agg(F.sum("kin_n").alias("in_kin"), F.sum("kin_shingles").alias("in_kin_shingles"), F.collect_list(F.struct("kin", "kin_blocks")).alias("kins"))
    whole = large.groupBy("node").agg(F.first("n").alias("n"), F.first("shingles").alias("shingles")).join(by_node, "node", "left")
    rest = F.greatest((F.col("n") - F.coalesce("in_kin", zero)) / BUCKET, (F.col("shingles") - F.coalesce("in_kin_shingles", zero)) / BLOCK_SHINGLES)
    numbers = lambda kin, n: F.transform(F.sequence(zero, n - 1), lambda b: kin * (1 << 32) + b)
    plain = F.greatest(F.lit(1), F.ceil(rest)).cast("long")
    others = F.flatten(F.concat(F.array(numbers(zero, F.col("plain"))), F.coalesce(F.transform("kins", lambda x: numbers(x["kin"], x["kin_blocks"])), F.array().cast("array<array<bigint>>"))))
    whole = whole.withColumn("plain", plain).select(F.xxhash64("node").alias("node_key"), "node", "plain", others.alias("others"))
    # joined on hashes of their own, which both sides exchange, so that Spark can split a large node
    rows = large.withColumns({"key": F.xxhash64("node", "least"), "node_key": F.xxhash64("node")})
    rows = rows.join(small_side(kin.select("key", "node", "least", "kin", "kin_blocks")), ["key", "node", "least"], "left")
    rows = rows.join(small_side(whole), ["node_key", "node"]).withColumn("kin", F.coalesce("kin", zero))
    own = F.col("kin") * (1 << 32) + F.pmod(F.xxhash64("set_id"), F.coalesce("kin_blocks", "plain"))
    met = F.filter("others", lambda b: (F.col("kin") == 0) | (F.shiftright(b, 32) != F.col("kin")))
    rows = rows.withColumn("block", own).withColumn("other", F.explode(met))
    return small.unionByName(rows.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")}).select(*member))


def jaccard_join(docs: DataFrame, width: int = 5, similarity: float = 0.8, recall: float = 0.999, tell_rows: bool = False) -> DataFrame:
    """Class and links of every document whose shingle sets are alike.

    docs has doc_id and text; other columns are not read. Two documents are linked if the Jaccard similarity of their sets of
    shingles, width words each, is at least similarity; a text of fewer words has one shingle. Returns a row for each row of docs:
    doc_id, class_id (the least doc_id that links lead to), copy_of (the least doc_id with the same set), n_copies (documents with
    the same set, this one included), n_set_links (other sets that are linked to this one), n_links (other documents linked to this one, copies
    included). Texts without words, null or empty, are linked to none and are classes of their own. A null doc_id counts as the
    largest; rows that repeat a doc_id are documents of their own that share the id. An empty table gives an empty result.
    With tell_rows, rows also have text_hash (xxhash64 of text, to find a row among others of its id) and class_set (a set that stands
    for the class, other than class_id never shared by two classes; null for a text without words).

    Equal sets are one set from the start; sets are told apart by 64-bit hashes. A pair of sets is a candidate if their min-hash vectors
    agree in least_agreement(similarity) coordinates, 38 of 64 at 0.8; links are verified on the whole sets, in the least node that
    a pair shares, so that none counts twice and no pair is emitted. recall is that of a pair at exactly similarity, by the runs and the
    filter of candidates together; more similar pairs are found more surely. Nodes above a block after DEPTH levels are compared in
    pairs of blocks, which bounds what a task holds in sets and in shingles.
    """
    ship(docs.sparkSession)
    runs, least = runs_for(recall, similarity), least_agreement(similarity)
    doc = F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("doc")
    rows = docs.select(doc, "text")
    told, told_type = (rows.withColumn("text_hash", F.xxhash64("text")), ", text_hash long") if tell_rows else (rows, "")
    signed = told.mapInArrow(lambda b: _signed(b, width, runs, similarity), "doc long, set_id long, size long, signature binary, keys array<long>" + told_type)
    signed = checkpointed(signed)
    first = [F.first(c).alias(c) for c in ("size", "signature", "keys")]
    sets = signed.where("size > 0").groupBy("set_id").agg(F.min("doc").alias("rep"), F.count("*").alias("copies"), *first)
    sets = checkpointed(sets)
    level, leaves = sets.select("set_id", "size", F.explode("keys").alias("node")), []
    for depth in range(1, DEPTH + 1):
        counts = level.groupBy("node").agg(F.count("*").alias("n"), F.sum("size").alias("shingles")).where("n > 1")
        counts = counts.select(F.xxhash64("node").alias("key"), "n", "shingles", F.col("node").alias("counted"))
        met = level.withColumn("key2", F.xxhash64("node")).join(counts, (F.col("key2") == F.col("key")) & (F.col("node") == F.col("counted")))
        met = checkpointed(met.select("node", "set_id", "n", "shingles"))
        large = (F.col("n") > BUCKET) | (F.col("shingles") > BLOCK_SHINGLES) & (F.col("n") > 2)
        last = depth == DEPTH
        leaves.append(met if last else met.where(~large))
        big = met.where(large)
        if last or big.limit(1).count() == 0:
            break
        split = big.select("node", "set_id").join(sets.select("set_id", "size", "signature"), "set_id")
        level = split.mapInArrow(lambda b: _split(b, similarity), "node long, set_id long, size long").distinct()
    found = leaves[0]
    for more in leaves[1:]:
        found = found.union(more)

    def grouped(df: DataFrame) -> DataFrame:
        return df.repartition("node", "low", "high").sortWithinPartitions("node", "low", "high")

    member = "node long, low long, high long, block long, set_id long, copies long, nodes array<long>"
    likely = checkpointed(grouped(_cells(found, sets)).mapInArrow(lambda b: _candidates(b, least), member))
    needed = likely.select("set_id").distinct().join(sets.select("set_id", "rep"), "set_id").select(F.col("rep").alias("doc")).distinct()
    shingles = rows.join(small_side(needed, 500_000), "doc", "left_semi").mapInArrow(lambda b: _shingles(b, width), "set_id long, shingles binary")
    shingles = shingles.groupBy("set_id").agg(F.first("shingles").alias("shingles"))
    links = grouped(likely.join(shingles, "set_id")).mapInArrow(lambda b: _links(b, similarity), "set_id long, n long, docs long, root long")
    links = checkpointed(links)
    counts = links.groupBy("set_id").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    linked = counts.join(sets.select("set_id", "rep"), "set_id")
    labels = components(linked.select(F.col("set_id").alias("id"), F.col("rep").alias("value")), links.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    known = sets.select("set_id", "rep", "copies").join(counts, "set_id", "left").join(labels.withColumnRenamed("id", "set_id"), "set_id", "left")
    stands = [F.coalesce("label.id", "set_id").alias("class_set")] * tell_rows
    known = known.select(F.xxhash64("set_id").alias("key"), "rep", "copies", "n", "docs", F.coalesce("label.value", "rep").alias("class"), *stands)
    out = signed.select("doc", *["text_hash"] * tell_rows, F.when(F.col("size") > 0, F.xxhash64("set_id")).alias("key")).join(known, "key", "left")
    shown = lambda c: F.nullif(c, F.lit(NO_ID))
    copies = F.coalesce("copies", F.lit(1).cast("long"))
    none = F.lit(0).cast("long")
    return out.select(
        shown(F.col("doc")).alias("doc_id"),
        shown(F.coalesce("class", "doc")).alias("class_id"),
        shown(F.coalesce("rep", "doc")).alias("copy_of"),
        copies.alias("n_copies"),
        F.coalesce("n", none).alias("n_set_links"),
        (copies - 1 + F.coalesce("docs", none)).alias("n_links"),
        *["text_hash", "class_set"] * tell_rows,
    )
