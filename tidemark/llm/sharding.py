"""Sharding: best-fit-decreasing bin packing of indivisible groups into fixed-capacity shards.

Groups of one size are interchangeable for packing, so the driver packs size classes: how many groups there are of each size. Distinct
sizes add up to at most all bytes, so there are at most sqrt(2 * bytes) classes. Groups learn their shard from their rank in their class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, prefix_sums, small_side

#: Documents, or groups of one size, that one task numbers.
SLICE = 1_000
#: Size classes above which their table is shuffled rather than broadcast.
MOST_BROADCAST = 500_000


class Bins:
    """Open bins in a treap, a balanced tree ordered by (remaining capacity, bin). A node is [key, priority, left, right]."""

    def __init__(self) -> None:
        self.root: list | None = None

    @classmethod
    def _split(cls, node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = cls._split(node[3], key)
            return node, right
        left, node[2] = cls._split(node[2], key)
        return left, node

    @classmethod
    def _merge(cls, a: list | None, b: list | None) -> list | None:
        if a is None or b is None:
            return b if a is None else a
        if a[1] > b[1]:
            a[3] = cls._merge(a[3], b)
            return a
        b[2] = cls._merge(a, b[2])
        return b

    def put(self, left: int, number: int) -> None:
        small, large = self._split(self.root, (left, number))
        node = [(left, number), number * 2654435761 % (1 << 32), None, None]
        self.root = self._merge(self._merge(small, node), large)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """Takes out the bin of least remaining capacity that holds size, the lowest among equals."""
        small, fit = self._split(self.root, (size, -1))
        if fit is None:
            self.root = small
            return None
        node = fit
        while node[2] is not None:
            node = node[2]
        left, number = node[0]
        _, large = self._split(fit, (left, number + 1))
        self.root = self._merge(small, large)
        return left, number


def best_fit(classes: list[tuple[int, int]], capacity: int, bins: int | None = None) -> list[list[tuple[int, int]]] | None:
    """Runs (bin, count) of each class (size, count), for falling sizes; None if more than bins are needed.

    The tightest remaining capacity that holds an item takes it, the lowest bin among equals; a new bin opens where none does. An
    item makes its bin tighter still, so the next ones of its size follow it there until the bin is full for them.
    """
    free, out, opened = Bins(), [], 0
    for size, count in classes:
        runs = []
        while count:
            found = free.tightest(size)
            if found is None:
                if size > capacity or opened == bins:
                    return None
                found, opened = (capacity, opened), opened + 1
            left, number = found
            n = min(count, left // size)
            runs.append((number, n))
            free.put(left - n * size, number)
            count -= n
        out.append(runs)
    return out


def pack(classes: list[tuple[int, int]], shards: int) -> list[list[tuple[int, int]]]:
    """Runs (shard, count) of each class (size, count), for falling sizes: best fit under the smallest capacity that shards can hold, found
    by growing steps and bisection. An item that is larger than an even share of what is left gets a shard of its own first."""
    rest, runs = [list(c) for c in classes], [[] for _ in classes]
    total, at, alone = sum(s * n for s, n in classes), 0, 0
    while alone < shards - 1 and at < len(rest) and rest[at][0] * (shards - alone) >= total:
        runs[at].append((alone, 1))
        total -= rest[at][0]
        alone += 1
        rest[at][1] -= 1
        at += not rest[at][1]
    left, todo = shards - alone, [(s, n) for s, n in rest[at:]]
    if not todo:
        return runs
    low = max(todo[0][0], -(-total // left))
    high, step = low, 1
    while (found := best_fit(todo, high, left)) is None:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        if (better := best_fit(todo, middle, left)) is None:
            low = middle + 1
        else:
            high, found = middle, better
    for own, more in zip(runs[at:], found, strict=True):
        own += [(alone + number, n) for number, n in more]
    return runs


def shard_documents(docs: DataFrame, shards: int = 16) -> DataFrame:
    """Shard and slot of each document; documents of equal text stay together and the shards' bytes are near equal.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32 (unsigned), shard (int), slot (long, gapless from 0 in each shard).
    Null text counts as the empty text. Repeated rows are documents of the same group and get slots of their own. An empty
    table gives an empty result. Other columns are not read.

    Groups are identified by SHA-256. Every group is packed by best fit, by falling bytes and, among equal ones, by its hash. Ranks and
    slots come from prefix sums over slices, so no task numbers a whole size class, shard or hot group; rows that repeat id and
    text are counted first and unfolded last.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    size, crc = (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    slim = docs.select("doc_id", size, crc, F.unhex(F.sha2(text, 256)).alias("group"))
    rows = checkpointed(slim.groupBy("doc_id", "size", "text_crc32", "group").agg(F.count("*").alias("copies")))
    groups = rows.groupBy("group").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.sum("copies").alias("n"))
    groups = checkpointed(groups)
    classes = [tuple(r) for r in groups.groupBy("bytes").agg(F.count("*").alias("n")).collect()]  # at most sqrt(2 * bytes) rows
    classes.sort(reverse=True)
    table = []
    for (bytes_, n), runs in zip(classes, pack(classes, shards), strict=True):
        first, firsts = 0, []
        for _, count in runs:
            firsts.append(first)
            first += count
        table.append((bytes_, n, firsts, [shard for shard, _ in runs]))
    places = spark.createDataFrame(table, "bytes long, class_n long, firsts array<long>, shards array<int>")
    places = F.broadcast(places) if len(table) <= MOST_BROADCAST else places

    # a group of one document of a class in one shard needs no look-up: its size is its class
    whole = F.size("shards") == 1
    needed = groups.join(places, "bytes").where((F.col("n") > 1) | ~whole)
    known = needed.where(whole).select("group", F.get("shards", F.lit(0)).alias("known"))
    split = needed.where(~whole)
    head = F.conv(F.hex(F.substring("group", 1, 4)), 16, 10).cast("long")
    split = split.withColumn("slice", F.shiftright(head * F.ceil(F.col("class_n") / SLICE), 32))
    before = prefix_sums(split.groupBy("bytes", "slice").agg(F.count("*").alias("members")), ["bytes"], "slice", "members")
    nth = F.row_number().over(Window.partitionBy("bytes", "slice").orderBy("group"))
    split = split.withColumn("nth", nth).join(small_side(before.drop("members")), ["bytes", "slice"])
    rank = F.col("before") + F.col("nth") - 1
    run = F.size(F.filter("firsts", lambda first: first <= rank)) - 1
    known = known.union(split.select("group", F.get("shards", run).alias("known")))
    known = small_side(known.withColumn("key", F.xxhash64("group")))
    # joined on a hash of its own, which both sides exchange, so that Spark can split a hot group
    found = rows.withColumn("key", F.xxhash64("group")).join(known, ["key", "group"], "left")
    by_size = places.select(F.col("bytes").alias("size"), F.get("shards", F.lit(0)).alias("sized"))
    by_size = F.broadcast(by_size) if len(table) <= MOST_BROADCAST else by_size
    placed = found.join(by_size, "size", "left").withColumn("shard", F.coalesce("known", "sized"))

    n, most = rows.agg(F.coalesce(F.sum("copies"), F.lit(0)), F.max("copies")).first()
    slices = max(1, -(-n // SLICE))
    placed = placed.select("doc_id", "size", "text_crc32", "group", "copies", "shard", F.pmod(F.xxhash64("doc_id", "group"), F.lit(slices)).alias("slice"))
    placed = checkpointed(placed)
    before = prefix_sums(placed.groupBy("shard", "slice").agg(F.sum("copies").alias("members")), ["shard"], "slice", "members")
    order = Window.partitionBy("shard", "slice").orderBy("doc_id", "text_crc32", "group")
    within = F.sum("copies").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("copies")
    numbered = placed.withColumn("within", within).join(small_side(before.drop("members")), ["shard", "slice"])
    first = F.col("before") + F.col("within")
    numbered = numbered.select("doc_id", "size", "text_crc32", "shard", first.alias("first"), (first + F.col("copies") - 1).alias("last"))
    # at most SLICE copies at once; the parts of a row of more copies are dealt out
    parts = numbered.withColumn("part", F.explode(F.sequence("first", "last", F.lit(SLICE).cast("long"))))
    if (most or 0) > SLICE:
        parts = parts.repartition("part")
    slot = F.explode(F.sequence("part", F.least(F.col("last"), F.col("part") + SLICE - 1)))
    return parts.select("doc_id", "size", "text_crc32", "shard", slot.alias("slot"))
