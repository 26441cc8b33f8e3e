import gzip
import hashlib
import io
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import classifier, fingerprints, jaccard_join, line_dedup, mixing, pieces, quality_rules, registry, sharding, urls, warc
from tidemark.llm.common import word_count
from tidemark.llm.components import components

WS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, size long, block int, host string, ids string, n_lines string, digests int, key string, id string"
LINE = "A shared line of at least twenty characters."
EDGE = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \n\t ", None, "a"), (None, "null id with some words in the text here", "en", "b"), (4, f"{LINE}\nunique four", "en", "a"),
    (5, f"  {LINE.upper()} \nunique five", "en", "a"), (6, f"{LINE}\n{LINE}\nunique six", "en", ""), (6, f"{LINE}\n{LINE}\nunique six", "en", ""), (7, "word " * 30_000, "en", "b"), (8, "x" * 50_000, "en", "b"),
    (9, "é日本😀 \x00 ▁ \r\n end", "fr", "é"), (10, "one two three four five six seven eight nine ten", "en", "a"), (11, "one two three four five six seven eight nine ten", "en", "c"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(*r, 1, 0.5, 3, 1, "h", "i", "n", 2, "k", "d") for r in EDGE]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").persist()


def words(text):
    return [w for w in re.split(f"[{WS}]+", text or "") if w]


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, sf_dir, name):
    from oracle import same

    same(spark, sf_dir, registry.queries()[name], registry.oracle_sql()[name])


# 1


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_links(texts):
    sets, index = {d: shingles(t) for d, t in texts.items()}, defaultdict(list)
    for d, s in sets.items():
        for g in s:
            index[g].append(d)
    links = defaultdict(set)
    for d, s in sets.items():
        for other, k in Counter(o for g in s for o in index[g] if o != d).items():
            if 5 * k >= 4 * (len(s) + len(sets[other]) - k):
                links[d].add(other)
    return links


def brute_classes(texts, links):
    best = {}
    for d in sorted(texts):
        if d not in best:
            todo = [d]
            while todo:
                x = todo.pop()
                if x not in best:
                    best[x] = d
                    todo += links[x]
    return best


def test_jaccard_against_brute_force(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    links = brute_links(texts)
    classes = brute_classes(texts, links)
    for r in jaccard_join.jaccard_join(documents).collect():
        assert (r["n_links"], r["class_id"]) == (len(links[r["doc_id"]]), classes[r["doc_id"]])


def test_jaccard_large_group(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BUCKET", 16)  # so that nodes are split and compared in blocks
    r = random.Random(3)
    base = [f"w{i}" for i in range(150)]
    texts = {}
    for d in range(150):
        w = list(base)
        for _ in range(r.randrange(6)):
            w[r.randrange(150)] = f"new{r.randrange(10**6)}"
        texts[d] = " ".join(w)
    links = brute_links(texts)
    classes = brute_classes(texts, links)
    met, cells = [], jaccard_join._cells

    def counted(found, sets):
        out = cells(found, sets)
        met.append((found.count(), out.count()))
        return out

    monkeypatch.setattr(jaccard_join, "_cells", counted)
    got = jaccard_join.jaccard_join(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {x["doc_id"]: (x["n_links"], x["class_id"]) for x in got} == {d: (len(links[d]), classes[d]) for d in texts}
    # blocks of a group that meets in a lesser node aren't paired: far fewer rows than a row for each other block in every node
    assert met[0][1] < met[0][0] * len(texts) / 16 / 2


def test_recall_counts_the_filter():
    loss = jaccard_join.filter_loss(0.8)
    assert 1e-6 < loss < 1e-4 and jaccard_join.runs_for(0.999, 0.8) >= jaccard_join.runs_for(0.99, 0.8)
    r = np.random.default_rng(1)
    assert (r.binomial(jaccard_join.COORDINATES, 0.8, 1_000_000) < jaccard_join.least_agreement(0.8)).mean() < 3 * loss
    with pytest.raises(ValueError):
        jaccard_join.runs_for(1 - loss / 2, 0.8)


def test_jaccard_edges(edge, none):
    got = sorted(jaccard_join.jaccard_join(edge).collect(), key=str)
    assert len(got) == len(EDGE)
    by = {r["doc_id"]: r for r in got}
    assert by[10]["class_id"] == by[11]["class_id"] == 10 and by[11]["n_links"] == 1 and by[11]["n_copies"] == 2
    assert by[6]["n_copies"] == 2 and by[1]["n_links"] == 0 and by[2]["class_id"] == 2 and by[None]["class_id"] is None
    assert jaccard_join.jaccard_join(none).count() == 0


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101)]
    vertices = spark.createDataFrame([(i, i) for i in [*range(41), 100, 101, 200]], "id long, value long")
    got = {r["id"]: r["label"]["value"] for r in components(vertices, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 200: 200}


# 2


def test_rules_edges(edge, none):
    got = quality_rules.quality_rules(edge)
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(EDGE) and by[1]["base_failed"] and by[2]["n_words"] == 0
    assert by[7]["n_repeat_words"] == 30_000 and by[8]["word_chars"] == 50_000 and by[6]["n_dup_lines"] == 1 and by[10]["kept"]
    assert quality_rules.quality_rules(none).count() == 0


def test_rules_remove_frequent_lines(spark):
    rows = [(i, f"{LINE}\nbody {i} " + " ".join(f"w{i}x{k}" for k in range(40)), "h") for i in range(30)] + [(100 + i, LINE + f"\n short body of {i} and so on and on", "g") for i in range(30)]
    rows += [(200 + i, f"{LINE} Twice.\nx{i}", "i") for i in range(25)]
    got = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert all(got[i]["n_removed_lines"] == 1 and got[i]["kept"] for i in range(30))
    assert all(not got[200 + i]["kept"] for i in range(25))


def test_rules_do_not_depend_on_the_size_of_the_host(spark):
    rows = [(i, f"{LINE}\nbody {i} " + " ".join(f"w{i}x{k}" for k in range(40)), "h") for i in range(21)]
    clean = spark.range(1000, 4000).selectExpr("id AS doc_id", "concat('clean words of ', id) AS text", "'h' AS source")
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for df in (docs, docs.union(clean)):
        got = {r["doc_id"]: r["n_removed_lines"] for r in quality_rules.quality_rules(df).where("doc_id < 1000").collect()}
        assert got == {i: 1 for i in range(21)}
    assert sum(r["n_removed_lines"] for r in quality_rules.quality_rules(docs.where("doc_id > 0")).collect()) == 0


# 3


def test_classifier_held_out(spark, documents, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = classifier.score_documents(documents.select("doc_id", "text"), labels).join(labels, "doc_id").withColumn("out", classifier.held_out(F.col("doc_id"))).collect()
    out = [r for r in got if r["out"]]
    assert out and np.mean([(r["score"] >= 0.3) == (r["quality"] == 1) for r in out]) >= 0.9


def test_classifier_edges(spark, edge, none):
    labels = spark.createDataFrame([(1, 1, None), (2, None, 1), (None, 1, 1), (10, 1, 0), (7, 0, 0), (4, 1, 0), (4, 0, 0), (8, 0, 1)], "doc_id long, quality int, toxic int")
    got = classifier.score_documents(edge, labels)
    assert got.count() == len(EDGE) and got.where("score is null or score < 0 or score > 1").count() == 0 and "host" in got.columns
    assert {r["score"] for r in classifier.score_documents(edge, labels.where("false")).collect()} == {0.5}
    assert classifier.score_documents(none, labels).count() == 0
    again = {r["doc_id"]: r["score"] for r in classifier.score_documents(edge, labels).collect()}
    assert again == {r["doc_id"]: r["score"] for r in got.collect()}


def plain_score(model, bags, d):
    """The score of document d in plain Python."""
    import math

    dot = lambda v, m, j: sum(x * m[i][j] for i, x in enumerate(v))
    squash = lambda x: 1 / (1 + math.exp(-x))
    hs, es = [], []
    for p in range(bags.begin[d], bags.begin[d + 1]):
        grams = bags.grams[bags.at[p] : bags.at[p + 1]]
        x = [sum(model["E"][g][i] for g in grams) / max(1, len(grams)) for i in range(classifier.EMBEDDED)]
        x += [dot(bags.chars[p], model["C"], i) for i in range(classifier.EMBEDDED)]
        x += [(v - m) / q for v, m, q in zip(bags.stats[p], model["mean"], model["scale"], strict=True)]
        h = [math.tanh(dot(x, model["W"], j) + model["b"][j]) for j in range(classifier.HIDDEN)]
        gates = [math.tanh(dot(h, model["V"], j) + model["c"][j]) * squash(dot(h, model["U"], j) + model["d"][j]) for j in range(classifier.ATTENTION)]
        hs.append(h)
        es.append(math.exp(sum(g * w for g, w in zip(gates, model["w"], strict=True))))
    z = [sum(e * h[j] for e, h in zip(es, hs, strict=True)) / sum(es) for j in range(classifier.HIDDEN)]
    return squash(sum(a * b for a, b in zip(z, model["o"], strict=True)) + model["p"])


@pytest.fixture(scope="module")
def small_bags():
    r = random.Random(3)
    texts = [" ".join(r.choice(["good", "fine", "###", "Zé", "a", "1"]) for _ in range(n)).encode() for n in (200, 3, 64, 65, 130, 1)] + [b"", b" \n"]
    bags = classifier.bags_of(texts)
    bags.chars, bags.stats = bags.chars.astype(np.float64), bags.stats.astype(np.float64)
    g = np.random.default_rng(1)
    model = {k: g.normal(0, 0.5, np.shape(v)) for k, v in classifier.new_model(bags, 0.4).items()} | {"scale": np.ones(classifier.STATS)}
    return bags, model


def test_forward_against_plain_python(small_bags):
    bags, model = small_bags
    got = classifier.forward(model, bags)[0]
    assert np.allclose(got, [plain_score(model, bags, d) for d in range(len(got))], atol=1e-12)
    one = [classifier.Bags.unpack(bags.take(np.array([d])).pack(), int(np.diff(bags.begin)[d])) for d in range(len(got))]
    assert np.allclose(classifier.forward(model, classifier.Bags.join(one))[0], got, atol=1e-3)


def test_gradient_against_finite_differences(small_bags):
    bags, model = small_bags
    labels = np.array([1.0, 0, 1, 0, 0, 1, 1, 0])

    def loss(m):
        y = classifier.forward(m, bags)[0]
        return -np.mean(labels * np.log(y) + (1 - labels) * np.log(1 - y))

    found, r = classifier.gradient(model, bags, labels), random.Random(5)
    for name in classifier.LEARNED:
        shape = np.shape(model[name])
        for _ in range(12):
            at = (int(r.choice(bags.grams)), r.randrange(shape[1])) if name == "E" else (r.choice(b"goZ# a"), r.randrange(shape[1])) if name == "C" else tuple(r.randrange(n) for n in shape)
            up, down = ({**model, name: np.array(model[name], copy=True)} for _ in range(2))
            up[name][at] += 1e-5
            down[name][at] -= 1e-5
            assert abs((loss(up) - loss(down)) / 2e-5 - found[name][at]) < 1e-8, (name, at)


def test_training_fits():
    r = random.Random(0)
    texts = [" ".join(r.choice(("bad bad awful" if y == 0 else "good fine nice").split()) for _ in range(90)).encode() for y in (0, 1) * 20]
    bags, labels = classifier.bags_of(texts), np.array([0.0, 1] * 20)
    model = classifier.train(bags, labels)
    assert ((classifier.scores(model, texts) > 0.5) == (labels == 1)).all()
    assert classifier.train(classifier.bags_of([]), np.zeros(0)) == {"constant": 0.5}


def test_training_is_bounded(spark, monkeypatch):
    seen, train = [], classifier.train
    monkeypatch.setattr(classifier, "train", lambda bags, labels, **kw: seen.append((len(labels), int(bags.begin[-1]))) or train(bags, labels, **kw))
    rows = [(i, ("good " if i % 2 else "bad ") * 100) for i in range(60)] + [(3, f"row {k} of an id that is found often") for k in range(200)] + [(61, "long " * 5000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(62)], "doc_id long, quality int")
    classifier.fit(docs, labels, most_docs=40, most_passages=30)
    assert seen[-1][0] <= 40 and seen[-1][1] <= 30
    classifier.fit(docs, labels)
    learned = sum(1 for i in range(62) if i != 60 and not spark.range(1).select(classifier.held_out(F.lit(i))).first()[0])
    assert seen[-1][0] == learned  # one row of each id that is found


# 4


def brute_lines(rows):
    holders = defaultdict(set)
    key = lambda x: x.strip(WS).translate({c: c + 32 for c in range(65, 91)})
    for d, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 20:
                holders[key(x)].add(-1 if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(holders.get(key(x), ())) < 3 or max(holders[key(x)]) == (-1 if d is None else d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=str)


def test_lines(edge, none, documents):
    for df in (edge, documents):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = line_dedup.dedup_lines(df)
        assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str) == brute_lines(rows)
    assert line_dedup.dedup_lines(none).count() == 0
    names = ("line_doc", "line_digests", "rest", "line_key", "text_hash", "doc", "key", "key2")
    got = line_dedup.dedup_lines(edge.select("*", *[F.lit(n).alias(n) for n in names if n != "key"]))
    assert all(got.where(F.col(n) != (n if n != "key" else "k")).count() == 0 for n in names) and got.count() == len(EDGE)


def test_lines_of_rows_without_id(spark):
    rows = [(None, f"{LINE}\nown line of a row without an id, number {i}") for i in range(50)] + [(1, LINE), (2, LINE + "\nx")]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str) == brute_lines(rows)


def test_lines_with_saturated_filter(edge):
    rows = [(r["doc_id"], r["text"]) for r in edge.select("doc_id", "text").collect()]
    got = line_dedup.dedup_lines(edge.select("doc_id", "text"), most_bits=64)
    assert sorted((tuple(r) for r in got.select("doc_id", "n_lines", "n_dropped", "text").collect()), key=str) == brute_lines(rows)


# 5


def test_mix(edge, none, documents):
    for df in (edge, documents):
        mixed = mixing.mix_sources(df.withColumn("mix_size", word_count(F.col("text"))))
        assert mixed.count() == df.count()
        for r in mixed.groupBy("source").agg(F.sum("mix_size").alias("s"), F.first("mix_target").alias("t"), F.sum("mix_taken").alias("k"), F.max(F.col("mix_taken") - 3 * F.col("mix_size")).alias("over")).collect():
            assert r["over"] <= 0 and abs(r["t"] - r["k"]) <= 0.5 and r["t"] <= 3 * r["s"] + 1e-6
        total = mixed.agg(F.sum("mix_taken"), F.sum("mix_size")).first()
        assert abs(total[0] - total[1]) <= 30
        copies = mixing.mixed_copies(mixed)
        assert copies.agg(F.sum(word_count(F.col("text")))).first()[0] == total[0]
    assert mixing.mix_sources(none.withColumn("mix_size", word_count(F.col("text")))).count() == 0


def test_mix_of_rows_that_repeat_an_id(spark, monkeypatch):
    rows = [(i, "a" if i % 3 else "b", 1 + i % 7) for i in range(300)] + [(None, "a", 1 + i % 5) for i in range(400)] + [(7, "b", 3)] * 50
    df = spark.createDataFrame(rows, "doc_id long, source string, mix_size long")
    plain = sorted(map(tuple, mixing.mix_sources(df).collect()), key=str)
    monkeypatch.setattr(mixing, "HOT_ROWS", 10)
    monkeypatch.setattr(mixing, "HOT_TIMES", 3)
    totals = mixing._segmented(df.withColumns({"mix_skey": F.lit("v"), "mix_range": F.lit(0), "mix_key": mixing.mix_key(F.col("doc_id"))}), spark.createDataFrame([("v", 0, 750)] + [("v", k, 1) for k in range(1, 9)], "mix_skey string, mix_range int, n long"))[1]
    assert totals.count() == 7  # before the key, a segment for each of its five sizes, and behind it
    assert sorted(map(tuple, mixing.mix_sources(df).collect()), key=str) == plain


def test_cut_copies_keep_white_space(spark):
    text = " one  two\n\tthree\r\nfour\n"
    mixed = spark.createDataFrame([(text, 4, n) for n in (1, 2, 3, 4, 7)], "text string, mix_size long, mix_taken long")
    got = sorted((r["mix_taken"], r["text"]) for r in mixing.mixed_copies(mixed).collect())
    three = " one  two\n\tthree"
    assert got == sorted([(1, " one"), (2, " one  two"), (3, three), (4, text), (7, text), (7, three)])


def test_targets(spark):
    got = mixing.source_targets(spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 4)], "source string, source_size long"))
    t = {r["source"]: r["target"] for r in got.collect()}
    # weights 1, 2, 3, 1; the first and the last are capped at 30 and 12, the rest is shared 2 to 3
    assert t["a"] == 30 and t[None] == 12 and abs(t["b"] - 1972 * 2 / 5) < 1e-9 and abs(t["c"] - 1972 * 3 / 5) < 1e-9


# 6


def test_fingerprints(documents, edge, none):
    part = re.compile(fingerprints.PARAGRAPH)
    cut = lambda t: {x.strip(WS) for x in part.findall(t)} - {""}
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    rows = sorted(((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()), reverse=True)
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_versions(documents).collect()}
    for i, (d, t) in enumerate(rows):
        other = rows[(i + 1) % len(rows)][1]
        third = len(t) // 3
        edited = t[: len(t) - third] + other[:third]
        r = got[d]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert abs(r["near_edited"] - like(cut(t), cut(edited))) < 1e-9 and abs(r["near_next"] - like(cut(t), cut(other))) < 1e-9
    out = fingerprints.fingerprint_versions(edge).collect()
    assert len(out) == len(EDGE) and len({r["fingerprint"] for r in out if r["doc_id"] in (10, 11)}) == 1
    assert fingerprints.fingerprint_versions(none).count() == 0


def cells_of(fingerprint):
    """Cells in a row, number of digests, and {cell: [n, k, c]} of a fingerprint's text, read in plain Python."""
    import base64

    raw = base64.b64decode(fingerprint)
    number = lambda a, n: int.from_bytes(raw[a : a + n], "big")
    return number(0, 4), number(4, 4), {number(a, 4): [number(a + 4, 1), number(a + 5, 8), number(a + 13, 4)] for a in range(8, len(raw), 17)}


def peeled_in_python(cells, places):
    """Digests that peeling recovers, from cells alone; places maps a digest to its three cells. None if some cells stay."""
    found, live = set(), True
    while live:
        live = False
        for at in list(cells):
            n, k, c = cells[at]
            if n == 1 and k in places and at in places[k] and places[k][3] == c:
                found.add(k)
                live = True
                for other in places[k][:3]:
                    x = cells[other]
                    cells[other] = [x[0] - 1, x[1] ^ k, x[2] ^ c]
    return found if not any(map(any, cells.values())) else None


def test_fingerprints_hold_the_likeness(spark, documents):
    out = fingerprints.fingerprint_versions(documents).persist()
    rows = {r["doc_id"]: r for r in out.collect()}
    order = sorted(rows, reverse=True)
    pairs = [(2 * d, rows[d]["fingerprint"], rows[d]["edited_fingerprint"]) for d in order]
    pairs += [(2 * d + 1, rows[d]["fingerprint"], rows[order[(i + 1) % len(order)]]["fingerprint"]) for i, d in enumerate(order)]
    size = {i: (cells_of(a)[1], cells_of(b)[1]) for i, a, b in pairs}
    got = fingerprints.differences(spark.createDataFrame(pairs, "id long, a string, b string")).collect()
    whole = [r for r in got if r["plus"] is not None]
    assert len(got) == len(pairs) and len(whole) >= 0.98 * len(got)
    for r in whole:
        d, other = divmod(r["id"], 2)
        (a, b), row = size[r["id"]], rows[d]
        assert abs((1.0 if not b + len(r["plus"]) else (a - len(r["plus"])) / (b + len(r["plus"]))) - row["near_next" if other else "near_edited"]) < 1e-9
        side = row["step" if other else "edit"]
        assert sorted(r["plus"]) == sorted(side["plus"]) and sorted(r["minus"]) == sorted(side["minus"])


def test_fingerprints_peel_in_plain_python(spark, documents):
    docs = documents.select("doc_id", "text").orderBy("doc_id").limit(40)
    out = fingerprints.with_sketch_texts(docs.select("doc_id", fingerprints.digests(F.col("text")).alias("own")), fingerprint="own").collect()
    every = spark.createDataFrame([(r["doc_id"], k, cells_of(r["fingerprint"])[0]) for r in out for k in r["own"]], "doc_id long, k long, m long")
    where = every.selectExpr("doc_id", "k", *[f"{r} * m + pmod(xxhash64(k, {r}), m) AS p{r}" for r in range(3)], "xxhash64(k, 3) & 4294967295L AS c").collect()
    unsigned = lambda k: k % (1 << 64)
    places = defaultdict(dict)
    for r in where:
        places[r["doc_id"]][unsigned(r["k"])] = (r["p0"], r["p1"], r["p2"], r["c"])
    got = {r["doc_id"]: peeled_in_python(cells_of(r["fingerprint"])[2], places[r["doc_id"]]) for r in out}
    assert sum(v is not None for v in got.values()) >= 38
    assert all(got[r["doc_id"]] in (None, {unsigned(k) for k in r["own"]}) for r in out)
    again = {r["id"]: r["digests"] for r in fingerprints.recovered(spark.createDataFrame([(r["doc_id"], r["fingerprint"]) for r in out], "id long, fingerprint string")).collect()}
    assert all(sorted(again[r["doc_id"]]) == sorted(r["own"]) for r in out if got[r["doc_id"]] is not None)


def test_peeling_tries_larger_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "CELLS", 1)
    monkeypatch.setattr(fingerprints, "ROOM", 1)
    r = random.Random(2)
    rows = [(i, [r.randrange(-(2**63), 2**63) for _ in range(r.randrange(30))], [r.randrange(-(2**63), 2**63) for _ in range(r.randrange(30))]) for i in range(50)]
    rows = [(i, a, b + a[: len(a) // 2]) for i, a, b in rows]
    df = spark.createDataFrame(rows, "id long, a array<long>, b array<long>").repartition("id")
    parts = fingerprints.peeled_differences(df, ("id",), ("a", "b"), [fingerprints.Difference("found", "a", "b")])
    got = {x["id"]: x["found"] for part in parts for x in part.collect()}
    assert len(parts) > 1 and len(got) == 50
    for i, a, b in rows:
        assert sorted(got[i]["plus"]) == sorted(set(a) - set(b)) and sorted(got[i]["minus"]) == sorted(set(b) - set(a))


def test_next_crosses_ranges(spark):
    ids = [None, 5, 5, 7, 100, 10**12, -3]
    df = spark.createDataFrame([(d, f"t{i}") for i, d in enumerate(ids)], "doc_id long, text string")
    got = {r["text"]: r["next_text"] for r in fingerprints.with_next(df, rows_per_range=1).collect()}
    order, t = [], "t5"
    for _ in ids:
        order.append(t)
        t = got[t]
    assert t == "t5" and len(set(order)) == len(ids)
    assert [ids[int(x[1:])] for x in order] == [10**12, 100, 7, 5, 5, -3, None]

    # a third of all rows has one id: they are dealt to many ranges
    rows = [(i, f"text {i}") for i in range(400)] + [(200, f"more {i}") for i in range(200)]
    got = fingerprints.with_next(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), rows_per_range=20).collect()
    assert max(Counter(r["range"] for r in got).values()) < 150
    following, t, walk = {r["text"]: r["next_text"] for r in got}, "text 399", []
    for _ in got:
        walk.append(200 if t.startswith("more") else int(t[5:]))
        t = following[t]
    assert t == "text 399" and len(walk) == 600 and walk == sorted(walk, reverse=True)


# 7


def test_pieces_equal_library(documents, edge, none):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    for df in (documents, edge):
        got = pieces.decode_documents(pieces.encode_documents(df)).select("text", "ids", "decoded").collect()
        assert len(got) == df.count()
        for r in got:
            assert r["ids"] == model.encode(r["text"] or "")
            assert r["decoded"] == (r["text"] or "").replace("▁", " ")
    assert pieces.encode_documents(none).count() == 0 and pieces.token_digests(none).count() == 0


def test_pieces_random():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    encoder, r = pieces.Encoder(pieces.Vocabulary.load()), random.Random(2)
    texts = ["".join(r.choice("abet hinger \n.éß日\t▁😀") for _ in range(r.randrange(80))) for _ in range(500)]
    texts += ["ab" * 600, "a" * 1000 + " b", " " * 40]
    ids, at = encoder.encode(texts)
    for i, t in enumerate(texts):
        assert ids[at[i] : at[i + 1]].tolist() == model.encode(t)


# 8


def pages(spark):
    long = "ü" * 600
    rows = [(1, "http://a.com/x", long), (2, "http://a.com/y", long), (3, "http://b.com/z", "short"), (4, "http://b.com/w", "short"), (5, None, None), (None, "http://c.com/", long), (7, "bad\r\nurl", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 1000), (7, "bad\r\nurl", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 1000), (8, "", "")]
    return spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, digest string, payload_bytes int")


def test_warc_round_trip(spark, tmp_path):
    df = pages(spark)
    warc.write_warc(df, f"file://{tmp_path}/w", max_records=5)
    found = warc.with_pages(warc.assemble(warc.read_warc(spark, f"file://{tmp_path}/w"))).collect()
    assert len(found) == df.count()
    html = defaultdict(list)
    for r in df.collect():
        html[r["page_id"]].append(r["html"] or "")
    by = defaultdict(list)
    for r in found:
        by[r["page_id"]].append(r)
        payload = html[r["page_id"]][0].encode()
        assert r["payload_digest"] == "sha1:" + hashlib.sha1(payload).hexdigest() and r["payload_bytes"] == len(payload)
        assert r["payload"] == (payload.decode() if r["type"] == "response" else None) and r["request"] is not None
    assert by[2][0]["type"] == "response" and by[1][0]["refers_page"] == 2 and by[None][0]["refers_page"] == 2
    assert sorted(r["type"] for r in by[7]) == ["response", "revisit"] and by[3][0]["type"] == by[4][0]["type"] == "response"
    members = 0
    for path in (tmp_path / "w").glob("part-*"):
        assert path.name.endswith(".warc.gz")
        raw, at, own = path.read_bytes(), 0, []
        while at < len(raw):  # each record is a gzip member
            z = zlib.decompressobj(31)
            own.append(z.decompress(raw[at:]) + z.flush())
            at = len(raw) - len(z.unused_data)
        assert own[0].startswith(b"WARC/1.1\r\nWARC-Type: warcinfo") and len(own) <= 5
        assert all(x.startswith(b"WARC/1.1\r\n") and x.endswith(b"\r\n\r\n") and x.count(b"WARC-Record-ID") >= 1 for x in own)
        members += sum(b"WARC-Type: warcinfo" not in x for x in own)
    assert members == 3 * df.count()
    warc.write_warc(df.where("false"), f"file://{tmp_path}/e")
    assert warc.assemble(warc.read_warc(spark, f"file://{tmp_path}/e")).count() == 0


def test_warc_archives_are_bounded_by_bytes(spark, tmp_path):
    html = [hashlib.sha512(b"%d" % i).hexdigest() * (200 if i == 7 else 4) for i in range(60)]
    df = spark.createDataFrame([(i, f"http://h/{i}", x) for i, x in enumerate(html)], "page_id long, url string, html string").coalesce(1)
    warc.write_warc(df, f"file://{tmp_path}/w", max_bytes=2000)
    found = warc.with_pages(warc.assemble(warc.read_warc(spark, f"file://{tmp_path}/w"))).collect()
    assert sorted((r["page_id"], r["payload"]) for r in found) == list(enumerate(html))
    files = list((tmp_path / "w").glob("*.warc.gz"))
    assert len(files) > 10
    for path in files:
        types = [r["type"] for r in warc.parse(io.BytesIO(gzip.decompress(path.read_bytes())))]
        assert types[0] == "warcinfo" and types.count("warcinfo") == 1
        assert path.stat().st_size <= 2000 or len(types) == 2


def test_warc_long_records_end_with_a_zero():
    for size in (0, 10, (1 << 24) - 4, 1 << 24, (1 << 25) + 5):
        member = warc.gzip_member(b"x" * size)
        assert member[-1] == 0 and gzip.decompress(member) == b"x" * size + b"\r\n\r\n"


def test_warc_is_read_once(spark, tmp_path):
    warc.write_warc(pages(spark), f"file://{tmp_path}/w")
    captures = warc.assemble(warc.read_warc(spark, f"file://{tmp_path}/w", payloads=False))
    plan = captures._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan binaryFile") + plan.count("Scan binaryFile") == 1 or plan.count("binaryFile") == 1
    assert "binaryFile" not in warc.with_pages(captures)._jdf.queryExecution().executedPlan().toString()


def test_warc_parses_plain_streams():
    record = b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nContent-Length: 23\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody\r\n\r\n"
    got = list(warc.parse(io.BytesIO(gzip.decompress(gzip.compress(record) + gzip.compress(record)))))
    assert [r["payload"] for r in got] == ["body", "body"] and got[0]["payload_bytes"] == 4


def test_warc_measures_payloads():
    def record(body, declared=b"body", more=b""):
        block = b"HTTP/1.1 200 OK\r\nContent-Length: %d%s\r\n\r\n" % (len(declared), more) + body
        head = b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <r>\r\nWARC-Payload-Digest: sha1:%s\r\n" % hashlib.sha1(declared).hexdigest().encode()
        return head + b"Content-Length: %d\r\n\r\n" % len(block) + block

    (got,) = warc.parse(io.BytesIO(record(b"body") + b"\r\n\r\n"))
    assert got["payload_bytes"] == 4 and got["payload_digest"] == "sha1:" + hashlib.sha1(b"body").hexdigest()
    (got,) = warc.parse(io.BytesIO(record(b"4\r\nbody\r\n0\r\n\r\n", more=b"\r\nTransfer-Encoding: chunked")))
    assert got["payload_bytes"] == 14 and got["payload_digest"] != "sha1:" + hashlib.sha1(b"body").hexdigest()
    for broken in (record(b"bodY"), record(b"bod"), record(b"body")[:-1], record(b"body")[:40]):
        with pytest.raises(ValueError):
            list(warc.parse(io.BytesIO(broken)))


# 9


def test_shards(edge, none, documents):
    for df in (edge, documents):
        got = sharding.shard_documents(df).collect()
        assert len(got) == df.count()
        slots, text = defaultdict(list), defaultdict(set)
        texts = {r["doc_id"]: r["text"] or "" for r in df.collect()}
        size = Counter()
        for r in got:
            slots[r["shard"]].append(r["slot"])
            text[texts[r["doc_id"]]].add(r["shard"])
            size[r["shard"]] += r["size"]
            assert r["size"] == len(texts[r["doc_id"]].encode()) + 1 and 0 <= r["shard"] < 16
        assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and all(len(v) == 1 for v in text.values())
    assert len(size) == 16 and max(size.values()) < 1.02 * sum(size.values()) / 16
    assert sharding.shard_documents(none).count() == 0


def brute_shards(rows, shards):
    """Shard of each id, by best fit one group at a time, and the number of groups of size classes that are split between shards."""
    groups = defaultdict(lambda: [0, []])
    for d, t in rows:
        raw = (t or "").encode()
        group = groups[hashlib.sha256(raw).digest()]
        group[0] += len(raw) + 1
        group[1].append(d)
    items = sorted(groups.items(), key=lambda x: (-x[1][0], x[0]))
    sizes = [n for _, (n, _) in items]
    total, alone = sum(sizes), 0
    while alone < min(shards - 1, len(sizes)) and sizes[alone] * (shards - alone) >= total:
        total -= sizes[alone]
        alone += 1

    def fit(capacity):
        free, out = [], []
        for n in sizes[alone:]:
            fits = [(f, i) for i, f in enumerate(free) if f >= n]
            if not fits:
                if len(free) == shards - alone or n > capacity:
                    return None
                free.append(capacity)
                fits = [(capacity, len(free) - 1)]
            i = min(fits)[1]
            free[i] -= n
            out.append(alone + i)
        return out

    low = max([*sizes[alone : alone + 1], -(-total // (shards - alone))])
    high, step = low, 1
    while fit(high) is None:
        low, high, step = high + 1, high + step, step * 2
    while low < high:
        middle = (low + high) // 2
        low, high = (middle + 1, high) if fit(middle) is None else (low, middle)
    return {d: s for (_, (_, ids)), s in zip(items, [*range(alone), *fit(high)], strict=True) for d in ids}


@pytest.mark.parametrize("scale", ["sf0.01", "sf0.1"])
def test_shards_against_brute_force(spark, scale):
    docs = spark.read.parquet(f"/root/testdata/{scale}/documents.parquet")
    want = brute_shards([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], 16)
    assert {r["doc_id"]: r["shard"] for r in sharding.shard_documents(docs).collect()} == want


def test_shards_of_equal_sizes(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLICE", 7)
    rows = [(i % 90, f"text {i % 160:03d}") for i in range(400)] + [(5, "again")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.shard_documents(docs, 5).collect()
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        where[r["text_crc32"]].add(r["shard"])
    assert len(got) == 700 and all(sorted(v) == list(range(len(v))) for v in slots.values()) and all(len(v) == 1 for v in where.values())
    by_text = {zlib.crc32(t.encode()): t for _, t in rows}
    want = brute_shards([(t, t) for _, t in rows], 5)
    assert {by_text[c]: next(iter(v)) for c, v in where.items()} == want


def test_best_fit_against_brute_force():
    r = random.Random(1)
    for _ in range(200):
        sizes = sorted((r.randrange(1, 60) for _ in range(r.randrange(1, 40))), reverse=True)
        free, out = [], []
        for s in sizes:
            fits = [(f, i) for i, f in enumerate(free) if f >= s]
            i = min(fits)[1] if fits else len(free)
            if not fits:
                free.append(70)
            free[i] -= s
            out.append(i)
        classes = sorted(Counter(sizes).items(), reverse=True)
        runs = sharding.best_fit(classes, 70)
        assert [b for own in runs for b, n in own for _ in range(n)] == out
        packed = sharding.pack(classes, 5)
        assert [sum(n for _, n in own) for own in packed] == [n for _, n in classes] and {b for own in packed for b, _ in own} <= set(range(5))


# 10


def test_url_rules(spark):
    cases = {
        "http://x.com/": ("com/", "allow"), "https://Example.COM/en/1?q": ("example.com/en/", "block"), "http://www.example.com/en/2": ("www.example.com/en/", "allow"), "http://m.example.com/en/": ("example.com/en/", "block"),
        "http://a.net/es/1": ("net/es/", "block"), "http://a.net/de/1": (None, "allow"), "http://xcom/": (None, "allow"), "http://a.com": (None, "allow"), "no host": (None, "allow"), None: (None, "allow"), "http://notexample.com/en/": ("com/", "allow"),
    }
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(cases)], "page_id long, url string, host string")
    got = urls.judge_urls(df, spark.createDataFrame([], "url string, bad boolean")).collect()
    assert {tuple(cases)[r["page_id"]]: (r["rule"], r["verdict"]) for r in got} == cases
    assert urls.judge_urls(df.where("false"), spark.createDataFrame([], "url string, bad boolean")).count() == 0


def test_mined_rules_against_brute_force(spark):
    from itertools import combinations, product

    r = random.Random(4)
    rows = []
    for i in range(400):
        a, b, c = r.choice("ab"), r.choice("cd"), r.choice("efg")
        rows.append((f"http://{a}.{b}.org/{c}/{i}?{c}k=1&{c}l=2", r.random() < (0.95 if (a, c) == ("a", "e") else 0.1)))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    rules = {tuple(sorted(s)): x["confidence"] for x in urls.mine_rules(df, 0.02, 8, 0.6).collect() for s in product(*x["any_of"])}
    tokens = {u: frozenset(t) for u, t in df.select("url", urls.url_tokens(F.col("url"))).collect()}
    seen, bad = Counter(), Counter()
    for u, y in rows:
        for k in range(1, len(tokens[u]) + 1):
            for s in combinations(sorted(tokens[u]), k):
                seen[s] += 1
                bad[s] += y
    good = {s: bad[s] / seen[s] for s in seen if bad[s] >= 8 and bad[s] / seen[s] >= 0.6}
    best = {s: c for s, c in good.items() if not any(set(t) < set(s) and good[t] >= c for t in good)}
    assert rules.keys() == best.keys() and all(abs(rules[s] - best[s]) < 1e-9 for s in best)
    matched = {x["url"] for x in urls.matching_urls(df, urls.mine_rules(df, 0.02, 8, 0.6)).collect()}
    assert matched == {u for u, _ in rows if any(set(s) <= tokens[u] for s in best)}


def test_rules_of_urls_with_many_items_against_brute_force(spark):
    from itertools import combinations

    r = random.Random(7)
    rows = []
    for i in range(160):
        held = [k for k in range(13) if r.random() < 0.75]
        rows.append((f"http://h{i}.org/" + "/".join(f"s{k}" for k in held), r.random() < (0.9 if {0, 1} <= set(held) and 2 not in held else 0.35)))
    # items of least confidence, of which two together are certain
    rows += [(f"http://x{i}.org/p/q/" + "/".join(f"s{k}" for k in range(13) if k != i), True) for i in range(12)]
    rows += [(f"http://y{i}.org/{'pq'[i % 2]}", False) for i in range(100)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    rules = {tuple(x["tokens"]): x["confidence"] for x in urls.mine_rules(df).collect()}
    tokens = {u: sorted(t for t in ts if t.startswith("path=")) for u, ts in df.select("url", urls.url_tokens(F.col("url"))).collect()}
    seen, bad = Counter(), Counter()
    for u, y in rows:
        for k in range(1, len(tokens[u]) + 1):
            for s in combinations(tokens[u], k):
                seen[s] += 1
                bad[s] += y
    good = {s: bad[s] / seen[s] for s in seen if bad[s] >= 8 and bad[s] / seen[s] >= 0.6}
    best = {s: c for s, c in good.items() if not any(good.get(t, 0) >= c for k in range(1, len(s)) for t in combinations(s, k))}
    assert rules == best and rules["path=p", "path=q"] == 1 and max(map(len, best)) > 3
    least = {s for s in good if not any(t in good for k in range(1, len(s)) for t in combinations(s, k))}
    assert {tuple(x["tokens"]) for x in urls.mine_rules(df, minimal=True).collect()} == least and len(least) < len(best)
    pages = df.select(F.monotonically_increasing_id().alias("page_id"), "url")
    assert {x["host"] for x in urls.judge_urls(pages, df).where("mined").collect()} == {u.split("/")[2] for u, _ in rows if any(set(s) <= set(tokens[u]) for s in best)}


def test_verdicts_of_long_templates_with_gaps(spark):
    r = random.Random(1)
    path = lambda: "/".join(f"s{k}" for k in range(40) if r.random() < 0.9)
    rows = [(f"http://x.org/{path()}/{i}", i < 20) for i in range(30)] + [(f"http://y{i}.org/{i}", False) for i in range(50)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    pages = df.select(F.monotonically_increasing_id().alias("page_id"), "url")
    began = time.perf_counter()
    assert {x["host"] for x in urls.judge_urls(pages, df).where("mined").collect()} == {"x.org"} and time.perf_counter() - began < 60


@pytest.mark.parametrize("noise", [False, True])
def test_rules_of_long_templates(spark, noise):
    path = lambda i: "/".join(f"s{k}" for k in range(40) if not noise or k % 25 != i)
    rows = [(f"http://x.org/{path(i)}/{i}", i < 20) for i in range(25)] + [(f"http://y{i}.org/{i}", False) for i in range(50)]
    df = spark.createDataFrame(rows, "url string, bad boolean")
    began = time.perf_counter()
    rules = urls.mine_rules(df)
    matched = {x["url"] for x in urls.matching_urls(df, rules).collect()}
    assert {u for u, _ in rows[:25]} == matched and time.perf_counter() - began < 60
    assert rules.where("confidence < 0.6 OR support * 75 < 7.5").count() == 0


def test_rules_of_one_item_need_the_same_count_in_large_tables(spark):
    clean = spark.range(20_000).selectExpr("concat('http://fine', id, '.org/', id) AS url", "false AS bad")
    bad = spark.range(9).selectExpr("concat('http://bad.org/', id) AS url", "true AS bad")
    assert urls.mine_rules(bad.union(clean.limit(100))).select("tokens").collect() == urls.mine_rules(bad.union(clean)).select("tokens").collect() != []


def test_fixed_rules_against_sql(spark, sf_dir):
    import duckdb

    sql = r"""
    WITH p AS (SELECT page_id, coalesce(url, '') AS url FROM read_parquet('{0}/pages.parquet')),
    h AS (SELECT page_id, translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM p),
    r(action, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
    m AS (SELECT page_id, max({{'n': length(rule_host || rule_path), 'rule': rule_host || rule_path, 'action': action}}) AS best
          FROM h JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY page_id)
    SELECT page_id, host, path, best.rule, best.action FROM h LEFT JOIN m USING (page_id)""".format(sf_dir)
    want = sorted(duckdb.sql(sql).fetchall())
    rows = registry.queries()["op10_url_filter"](spark, sf_dir).collect()
    got = [(r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in rows]
    assert sorted(got, key=lambda x: x[0]) == want and all(r["verdict"] == ("block" if r["mined"] else "allow") for r in rows if not r["rule"])
