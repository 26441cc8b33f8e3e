"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch has three rows of cells; each digest is added to one cell of every row, as a count, the xor of the digests and the xor of
their check hashes. Sketches of two versions subtract cell by cell, and peeling cells that hold a single digest recovers the
digests in which the versions differ. A difference that can't be peeled is made again with larger rows.

Cells are rows of a DataFrame: a digest is placed by three updates, cells are sums and xors by key, and a step of peeling replaces
each pure cell of one row of the sketch by the digest found and two more updates. All rows of a document stay in one partition, so a
whole peeling is one stage. Built-in expressions only; the longer ones are SQL text, which is read faster than it is put together.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed

BLANK = " \t\n\x0b\x0c\r"
#: A paragraph: a line, or of a long line 160 characters and what is left of the last word.
PARAGRAPH = r"[^\n]{1,160}[^\n ]*"
#: Least cells of a row of a sketch; cells of a row for each digest, at least; steps of peeling, one for each row; how much larger the
#: rows of the next try are. Empty cells cost nothing, so wide rows, which peel in few steps, are cheaper than many steps.
CELLS, ROOM, STEPS, GROWTH = 8, 4, 3, 4
LOWEST = -(1 << 63)
#: Hashes of a digest that choose its cell in each row, and its check hash.
PLACES = {f"h{r}": f"xxhash64(k, {r})" for r in range(3)}
CHECK = "(xxhash64(k, 3) & 4294967295L)"


@dataclass(frozen=True)
class Difference:
    """The sketch of the version plus less that of the version minus, under a name."""

    name: str
    plus: str
    minus: str


def digests(text: Column) -> Column:
    """Distinct 64-bit digests of the paragraphs of text, in any order."""
    parts = F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda x: F.btrim(x, F.lit(BLANK)))
    return F.array_distinct(F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.xxhash64(x)))


def cells_for(n: Column) -> Column:
    """Cells of a row for n digests: the least of 8, 12, 16, 24, 32, 48 and so on that isn't below ROOM * n."""
    least = F.greatest(ROOM * n.cast("long"), F.lit(CELLS).cast("long"))
    power = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(least - 1)))
    less = F.call_function("div", power * 3, F.lit(4).cast("long"))
    return F.when((less >= least) & (power > CELLS), less).otherwise(power)


def _place(row: int, m: str, h: str) -> str:
    return f"{row} * {m} + pmod({h}, {m})"


def _struct(**values: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in values.items()) + ")"


def _cell(t: str, m: str, cell: str, n: str, k: str = "k", c: str = "c", sign: str = "0L", found: str = "0L") -> str:
    """A cell or an update of one: table, cells in a row, place; count and xors; a digest found there, with its sign."""
    return _struct(t=t, m=m, cell=cell, n=n, k=k, c=c, sign=sign, found=found)


def _folded(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Cells from updates; empty ones go. The row with the payload, of cell -1, stays."""
    sums = [F.expr(f"{'sum' if n in ('n', 'sign') else 'bit_xor'}({n}) AS {n}") for n in ("n", "k", "c", "sign", "found")]
    return rows.groupBy(*keys, "payload", "t", "m", "cell").agg(*sums).where("cell < 0 OR n <> 0 OR k <> 0 OR c <> 0 OR sign <> 0")


def _peeled(cells: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Cells after all steps of peeling. A pure cell of one row of a sketch holds a digest that no other cell of that row holds, so
    nothing is taken away twice; it keeps the digest, with its sign, in found."""
    for step in range(STEPS):
        row = step % 3
        pure = f"abs(n) = 1 AND cell >= {row} * m AND cell < {row + 1} * m AND c = {CHECK} AND cell = {_place(row, 'm', PLACES[f'h{row}'])}"
        others = [_cell("t", "m", _place(r, "m", PLACES[f"h{r}"]), "-n") for r in range(3) if r != row]
        parts = ", ".join([_cell("t", "m", "cell", "0L", "0L", "0L", "n", "k"), *others])
        same = _cell("t", "m", "cell", "n", "k", "c", "sign", "found")
        cells = _folded(cells.selectExpr(*keys, "payload", f"inline(CASE WHEN {pure} THEN array({parts}) ELSE array({same}) END)"), keys)
    return cells


def _collected(cells: DataFrame, keys: tuple[str, ...], names: list[str]) -> DataFrame:
    """A row for each key: payload, and for each difference by name struct(plus, minus), the digests that only one side has; null if
    peeling left something."""
    found = ["first(payload, true) AS payload"]
    for t, name in enumerate(names):
        found.append(f"max(CASE WHEN t = {t} AND (n <> 0 OR k <> 0 OR c <> 0) THEN true END) AS {name}_left")
        found += [f"collect_list(CASE WHEN t = {t} AND sign = {sign} THEN found END) AS {name}_{side}" for side, sign in (("plus", 1), ("minus", -1))]
    done = [f"CASE WHEN {name}_left IS NULL THEN {_struct(plus=f'{name}_plus', minus=f'{name}_minus')} END AS {name}" for name in names]
    return cells.groupBy(*keys).agg(*map(F.expr, found)).selectExpr(*keys, "payload", *done)


def _with_digests(rows: DataFrame, keys: tuple[str, ...], versions: tuple[str, ...], carried: list[str]) -> DataFrame:
    """A row for each digest k of each version, by its number, with its hashes; and one of version -1 with carried as payload."""
    kinds = [_struct(version=str(i), ks=v) for i, v in enumerate(versions)] + [_struct(version="-1", ks="array(0L)")]
    payload = _struct(**{c: c for c in carried})
    each = rows.selectExpr(*keys, f"{payload} AS payload", *[c for c in rows.columns if c.startswith("m_")], f"inline(array({', '.join(kinds)}))")
    each = each.selectExpr("* EXCEPT (payload, ks)", "CASE WHEN version < 0 THEN payload END AS payload", "explode(ks) AS k")
    return each.selectExpr("*", *[f"{h} AS {name}" for name, h in PLACES.items()], f"{CHECK} AS c")


NO_CELL = _cell("-1", "-1L", "-1L", "0L", "0L", "0L")


def _attempt(rows: DataFrame, keys: tuple[str, ...], versions: tuple[str, ...], differences: list[Difference], tried: int) -> DataFrame:
    """rows, with the differences that they lack made and peeled, in rows of cells GROWTH ** tried times those of the larger version."""
    names, carried = [d.name for d in differences], [c for c in rows.columns if c not in keys]
    for d in differences:
        size = cells_for(F.greatest(F.size(d.plus), F.size(d.minus)))
        rows = rows.withColumn(f"m_{d.name}", F.when(F.col(d.name).isNull(), size * GROWTH**tried))
    cases = []
    for i, version in enumerate(versions):
        updates = []
        for t, d in enumerate(differences):
            for sign, side in (("1L", d.plus), ("-1L", d.minus)):
                updates += [_cell(str(t), f"m_{d.name}", _place(r, f"m_{d.name}", f"h{r}"), sign) for r in range(3) if side == version]
        cases.append(f"WHEN version = {i} THEN array({', '.join(updates)})")
    each = _with_digests(rows, keys, versions, carried)
    cells = each.selectExpr(*keys, "payload", f"inline(CASE {' '.join(cases)} ELSE array({NO_CELL}) END)").where("m IS NOT NULL")
    out = _collected(_peeled(_folded(cells, keys), keys), keys, names)
    kept = [f"coalesce(payload.{c}, {c}) AS {c}" if c in names else f"payload.{c}" for c in carried]
    return out.selectExpr(*keys, *kept)


def peeled_differences(rows: DataFrame, keys: tuple[str, ...], versions: tuple[str, ...], differences: list[Difference]) -> list[DataFrame]:
    """rows (keys, versions: arrays of distinct digests, maybe more) with a column for each difference: struct(plus, minus), the
    digests that only one of its versions has. They come in parts, one for each try, which together have every row once.

    keys together are unique, and rows of a key's first column are in one partition; this holds in each part too. What can't be
    peeled is tried again with larger rows until nothing is left; each try is computed once and kept in the checkpoint folder.
    """
    finished = " AND ".join(f"{d.name} IS NOT NULL" for d in differences)
    rows = rows.selectExpr("*", *[f"CAST(NULL AS struct<plus:array<bigint>,minus:array<bigint>>) AS {d.name}" for d in differences])
    done: list[DataFrame] = []
    while True:
        out = checkpointed(_attempt(rows, keys, versions, differences, len(done)))
        done.append(out.where(finished))
        rows = out.where(f"NOT ({finished})")
        if not rows.limit(1).count():
            return done
        rows = rows.repartition(keys[0])


def _hex(value: str, digits: int) -> str:
    """The lowest digits of value, as that many hexadecimal digits."""
    return f"lpad(hex({value if digits == 16 else f'{value} & {(1 << 4 * digits) - 1}L'}), {digits}, '0')"


def with_sketch_texts(rows: DataFrame, **versions: str) -> DataFrame:
    """rows with the fingerprints of columns of distinct digests, by the name that they get, as text: in base 64, the cells in a row
    and the number of digests (4 bytes each), and the non-empty cells in rising order with their place (4), count (1), xor of digests
    (8) and of check hashes (4).

    The three updates of each digest are sorted by cell, as a number of the cell and the digest's index, and each run of a cell is summed.
    """
    rows = rows.withColumns({f"m_{v}": cells_for(F.size(v)) for v in versions.values()})
    updates = {}
    for v in versions.values():
        three = ", ".join(f"shiftleft({_place(r, f'm_{v}', PLACES[f'h{r}'])}, 24) + i" for r in range(3))
        updates[f"updates_{v}"] = F.expr(f"sort_array(flatten(transform({v}, (k, i) -> array({three}))))")
    rows = rows.withColumns(updates)
    heads = {f"heads_{v}": F.expr(f"filter(transform(updates_{v}, (x, i) -> CASE WHEN i = 0 OR shiftright(x, 24) <> shiftright(get(updates_{v}, i - 1), 24) THEN i END), i -> i IS NOT NULL)") for v in versions.values()}
    rows = rows.withColumns(heads)
    texts = []
    for name, v in versions.items():
        k = lambda at: f"get({v}, CAST(get(updates_{v}, {at}) & 16777215L AS INT))"  # noqa: B023, E731
        cell = _hex(f"shiftright(get(updates_{v}, at), 24)", 8)
        one = f"concat({cell}, '01', {_hex('k', 16)}, {_hex(CHECK, 8)})"
        one = f"get(transform(array({k('at')}), k -> {one}), 0)"
        run = f"transform(sequence(at, next - 1), j -> {k('j')})"
        total = f"aggregate({run}, {_struct(n='0L', k='0L', c='0L')}, (a, k) -> {_struct(n='a.n + 1L', k='a.k ^ k', c=f'a.c ^ {CHECK}')})"
        many = f"concat({cell}, {_hex('sum.n', 2)}, {_hex('sum.k', 16)}, {_hex('sum.c', 8)})"
        many = f"get(transform(array({total}), sum -> {many}), 0)"
        entry = f"get(transform(array(coalesce(get(heads_{v}, nth + 1), size(updates_{v}))), next -> CASE WHEN next - at = 1 THEN {one} ELSE {many} END), 0)"
        head = f"{_hex(f'm_{v}', 8)}, {_hex(f'CAST(size({v}) AS BIGINT)', 8)}"
        text = f"base64(unhex(concat({head}, array_join(transform(heads_{v}, (at, nth) -> {entry}), ''))))"
        texts.append(F.replace(F.expr(text), F.lit("\r\n"), F.lit("")).alias(name))
    made = [c for v in versions.values() for c in (f"m_{v}", f"updates_{v}", f"heads_{v}")]
    return rows.select("*", *texts).drop(*made)


def decoded(fingerprint: Column) -> Column:
    """Struct (m, size, cells: array of struct (cell, n, k, c)) of a fingerprint's text."""
    digits = F.hex(F.unbase64(fingerprint))

    def number(at: Column | int, n: int) -> Column:
        return F.conv(F.substring(digits, F.lit(at) if isinstance(at, int) else at, F.lit(n)), 16, -10).cast("long")

    def cell(i: Column) -> Column:
        at = 17 + 34 * i
        return F.struct(number(at, 8).alias("cell"), number(at + 8, 2).alias("n"), number(at + 10, 16).alias("k"), number(at + 26, 8).alias("c"))

    count = F.call_function("div", F.length(digits) - 16, F.lit(34)).cast("int")
    every = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), cell)).otherwise(F.array().cast("array<struct<cell:bigint,n:bigint,k:bigint,c:bigint>>"))
    return F.struct(number(1, 8).alias("m"), number(9, 8).alias("size"), every.alias("cells"))


def _peeled_text(rows: DataFrame, plus: str, minus: str | None) -> DataFrame:
    """(id, found): the digests that only the decoded fingerprint plus has and only minus has; null if peeling fails."""
    parts = [f"struct(1L AS sign, {plus}.cells AS cells)"] + ([f"struct(-1L AS sign, {minus}.cells AS cells)"] if minus else [])
    # a row of cell -1 stands for ids whose cells are all empty
    parts.append("struct(0L AS sign, array(named_struct('cell', -1L, 'n', 0L, 'k', 0L, 'c', 0L)) AS cells)")
    each = rows.repartition("id").selectExpr("id", f"{plus}.m AS m", f"inline(array({', '.join(parts)}))").selectExpr("id", "m", "sign", "inline(cells)")
    cells = each.selectExpr("id", "CAST(NULL AS struct<none:int>) AS payload", "0 AS t", "m", "cell", "sign * n AS n", "k", "c", "0L AS sign", "0L AS found")
    return _collected(_peeled(_folded(cells, ("id",)), ("id",)), ("id",), ["found"]).select("id", "found")


def recovered(fingerprints: DataFrame) -> DataFrame:
    """(id, digests) of fingerprints (id, unique; fingerprint, text): the digests that peeling recovers, null if it fails."""
    rows = fingerprints.select("id", decoded(F.col("fingerprint")).alias("own"))
    return _peeled_text(rows, "own", None).select("id", F.col("found.plus").alias("digests"))


def differences(pairs: DataFrame) -> DataFrame:
    """(id, plus, minus) of pairs (id, unique; a and b, texts of fingerprints): the digests that only a and only b has.

    Fingerprints of equal rows of cells are subtracted and peeled. Where they are unequal or peeling fails, the digests that each gives by
    itself are placed in larger sketches, which are subtracted and peeled. plus and minus are null if a fingerprint can't be peeled by itself.
    """
    rows = checkpointed(pairs.select("id", decoded(F.col("a")).alias("a"), decoded(F.col("b")).alias("b")))
    first = checkpointed(rows.select("id").join(_peeled_text(rows.where("a.m = b.m"), "a", "b"), "id", "left"))
    rest = rows.join(first.where("found IS NULL").select("id"), "id", "left_semi")
    both = _peeled_text(rest, "a", None).selectExpr("id", "found.plus AS own").join(_peeled_text(rest, "b", None).selectExpr("id", "found.plus AS other"), "id")
    both = checkpointed(both)
    out = first.where("found IS NOT NULL").unionByName(both.where("own IS NULL OR other IS NULL").select("id", F.lit(None).cast(first.schema["found"].dataType).alias("found")))
    whole = both.where("own IS NOT NULL AND other IS NOT NULL").repartition("id")
    for part in peeled_differences(whole, ("id",), ("own", "other"), [Difference("found", "own", "other")]):
        out = out.unionByName(part.select("id", "found"))
    return out.select("id", "found.plus", "found.minus")


def likeness(size_a: Column, size_b: Column, plus: Column) -> Column:
    """Shared digests over all digests, given how many only the first has; 1 if neither has any."""
    union = size_b + plus
    return F.when(union == 0, F.lit(1.0)).otherwise((size_a - plus) / union)


def _order_key(doc_id: Column, text: Column) -> Column:
    """16 bytes that sort by id, null first, and by a hash of the text."""
    flip = F.lit(LOWEST).cast("long")
    known = F.coalesce(doc_id, flip)
    return F.unhex(F.concat(F.lpad(F.hex(known.bitwiseXOR(flip)), 16, "0"), F.lpad(F.hex(F.xxhash64(text).bitwiseXOR(flip)), 16, "0")))


def _bounds(docs: DataFrame, rows_per_range: int, most_ranges: int, per_range: int = 4) -> bytes:
    """Order keys that cut docs into ranges of about rows_per_range rows, one behind the other, from a sample of ids. The rows of an id that
    is found often are cut by the hash of their texts, which is uniform."""
    ids = docs.select(F.coalesce(F.col("doc_id"), F.lit(LOWEST).cast("long")).alias("id"))
    n = ids.count()
    ranges = max(1, min(most_ranges, n // rows_per_range))
    sample = ids.where(F.rand(17) < per_range * ranges / max(1, n)).groupBy("id").agg(F.count("*").alias("n"))
    out, held = [], 0
    for row in sorted(sample.collect()):  # about per_range * most_ranges rows at most
        parts = max(1, row["n"] // per_range)
        low = (row["id"] + (1 << 63)).to_bytes(8, "big")
        if held >= per_range or parts > 1:
            out.append(low + bytes(8))
            held = 0
        out += [low + ((i << 64) // parts).to_bytes(8, "big") for i in range(1, parts)]
        held += row["n"] if parts == 1 else per_range
    return b"".join(out)


def with_next(docs: DataFrame, extra=None, rows_per_range: int = 400, most_ranges: int = 1 << 16) -> DataFrame:
    """(range, place, doc_id, text, next_text): every row with the text of the next one in descending doc_id, the first after the last.
    extra lists dictionaries of further columns, by name; they come with their values of the next row, named next_ and the name.

    Null ids come last, rows of one id in the falling order of their texts' hashes; null texts are empty. Rows are dealt once to
    ranges of about equal size, with a copy of the first row of the next range at each range's end; at most most_ranges bounds come to
    the driver. place is the row's number in its range.
    """
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("order_key", _order_key(F.col("doc_id"), F.col("text")))
    bounds = _bounds(docs, rows_per_range, most_ranges)
    count = len(bounds) // 16
    literal, powers = F.lit(bytearray(bounds)), F.array(*[F.lit(1 << s) for s in reversed(range(count.bit_length()))])

    def range_of(key: Column) -> Column:
        """Number of bounds that aren't above key."""
        if not count:
            return F.lit(0)
        bound = lambda i: F.substring(literal, 16 * i + 1, F.lit(16))
        return F.aggregate(powers, F.lit(0), lambda low, p: F.when((low + p <= count) & (bound(low + p - 1) <= key), low + p).otherwise(low))

    heads = rows.select("order_key").groupBy(range_of(F.col("order_key")).alias("range")).agg(F.max("order_key").alias("head")).collect()  # a row for each range
    heads.sort(key=lambda r: -r["range"])
    takes = [(r["head"], heads[i - 1]["range"]) for i, r in enumerate(heads)]  # the first range's head goes behind the last range
    takes = docs.sparkSession.createDataFrame(takes, "head binary, to int")
    rows = rows.join(F.broadcast(takes), F.col("order_key") == F.col("head"), "left")
    own = F.struct(range_of(F.col("order_key")).alias("range"), F.lit(False).alias("copy"))
    copy = F.struct(F.col("to").alias("range"), F.lit(True).alias("copy"))
    rows = rows.withColumn("place", F.explode(F.when(F.col("to").isNull(), F.array(own)).otherwise(F.array(own, copy))))
    rows = rows.select("doc_id", "text", "order_key", "place.range", "place.copy").repartition(F.col("range"))
    more = list(extra) if extra else []
    for step in more:
        rows = rows.withColumns(step)
    names = ["text", *(n for step in more for n in step)]
    order = Window.partitionBy("range").orderBy("copy", F.col("order_key").desc())
    # copies stay until their text has served as the next one
    following = {f"next_{n}": F.lead(n).over(order) for n in names}
    return rows.withColumns({"place": F.row_number().over(order), **following}).where(~F.col("copy")).select("range", "place", "doc_id", *names, *following)


def fingerprint_versions(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited version, and their likeness to each other and to the next document's.

    The edited text is the text with its last third, rounded down, replaced by the first as many code points of the next document.
    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and the digests recovered: those
    that only the text and only its edited version has (edit: plus, minus), and only the text and only the next one has (step). The
    likeness is the share of distinct paragraphs that two versions have in common, 1 for two texts without any. Null text counts
    as empty. Repeated rows stay and follow each other; a single row is its own next. An empty table gives an empty result. Only
    doc_id and text are read.

    A fingerprint depends on its text alone: a sketch with room for all digests, so that nearly every one can be peeled by itself, and
    two of them be compared by their texts with differences().
    """
    rows = with_next(docs, [{"own": digests(F.col("text"))}]).withColumn("n_chars", F.length("text").cast("long"))
    third = F.floor(F.col("n_chars") / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - third), F.substring("next_text", F.lit(1), third))
    rows = rows.withColumn("edited_text", edited).withColumn("edited", digests(F.col("edited_text")))
    names = ("doc_id", "n_chars", "edited_sha256", "next_size")
    rows = rows.withColumns({"edited_sha256": F.sha2("edited_text", 256), "next_size": F.size("next_own")})
    rows = rows.select("range", "place", *names, "own", "edited", F.col("next_own").alias("next"))
    out = None
    for part in peeled_differences(rows, ("range", "place"), ("own", "edited", "next"), [Difference("edit", "own", "edited"), Difference("step", "own", "next")]):
        out = part if out is None else out.unionByName(part)
    out = with_sketch_texts(out, fingerprint="own", edited_fingerprint="edited")
    near = {"near_edited": likeness(F.size("own"), F.size("edited"), F.size("edit.plus")), "near_next": likeness(F.size("own"), F.col("next_size"), F.size("step.plus"))}
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", *[c.alias(k) for k, c in near.items()], "edit", "step")
