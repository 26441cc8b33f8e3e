"""URL filters: fixed host and path rules, and association rules that FP-growth mines from labelled URLs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, ship, small_side

#: Action, host and path prefix of each fixed rule.
FIXED_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
BAD = "class=bad"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Distinct tokens: labels of the host with the whole host, segments of the path, names of the query's parameters."""
    query = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))

    def named(kind: str, values: Column) -> Column:
        return F.transform(F.filter(values, lambda x: x != ""), lambda x: F.concat(F.lit(f"{kind}="), x))

    host = host_of(url)
    names = F.transform(F.split(query, "&"), lambda x: F.split_part(x, F.lit("="), F.lit(1)))
    return F.array_distinct(F.concat(named("label", F.split(host, r"\.")), named("host", F.array(host)), named("path", F.split(path_of(url), "/")), named("query", names)))


def fixed_rule(host: Column, path: Column, rules=FIXED_RULES) -> Column:
    """Struct (action, rule) of the longest fixed rule that fits, or null. A rule fits its host and all its subdomains where the
    path starts with the rule's path."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(action).alias("action"), F.lit(h + p).alias("rule"))) for action, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2]))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<action:string,rule:string>")


def _token_classes(held: DataFrame, least_bad: int) -> DataFrame:
    """(token, class, n, n_bad) of the tokens of held (id, bad, token) that at least least_bad bad URLs hold.

    Tokens that the same URLs hold are one class, named by its least token; such URLs are told apart by two xors of hashes. So a
    class has no more members than a URL has tokens.
    """
    same = {"x": F.bit_xor(F.xxhash64("id")), "y": F.bit_xor(F.xxhash64("id", F.lit(1)))}
    tokens = held.groupBy("token").agg(F.count("*").alias("n"), F.count_if("bad").alias("n_bad"), *[c.alias(k) for k, c in same.items()])
    name = F.min("token").over(Window.partitionBy("n", "n_bad", "x", "y"))
    return tokens.where(F.col("n_bad") >= least_bad).withColumn("class", name).select("token", "class", "n", "n_bad")


def _merged(batches: Iterator[pa.RecordBatch], least_bad: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """A conditional database (path, n_bad, n_clean) as names of its items, a row for each item with a flag for each path, and both
    counts of each path. Items below least_bad or in all clean paths are left out, and paths that are then equal are one."""
    rows = pa.Table.from_batches(list(batches)).combine_chunks()
    bad, clean = (rows[k].to_numpy() for k in ("n_bad", "n_clean"))
    paths = rows["path"].combine_chunks()
    items = paths.flatten().dictionary_encode()
    at = np.repeat(np.arange(len(paths)), paths.value_lengths().to_numpy())
    item, n = items.indices.to_numpy(), len(items.dictionary)
    some = (np.bincount(item, bad[at], n) >= least_bad) & (np.bincount(item, clean[at], n) < clean.sum())
    held = np.zeros((len(paths), np.count_nonzero(some)), bool)
    use = some[item]
    held[at[use], (np.cumsum(some) - 1)[item[use]]] = True
    held, same = np.unique(np.packbits(held, axis=1), axis=0, return_inverse=True)
    flags = np.ascontiguousarray(np.unpackbits(held, axis=1, count=np.count_nonzero(some)).T.astype(bool))
    names = items.dictionary.filter(pa.array(some)).to_pylist()
    return names, flags, *(np.bincount(same.reshape(-1), w, len(held)).astype(np.int64) for w in (bad, clean))


def _grown(names: list[str], holds: np.ndarray, bad: np.ndarray, clean: np.ndarray, least_bad: int, least_confidence: float, minimal: bool = False) -> Iterator[tuple[list[str], int, int]]:
    """Sets (items, n_bad, n_clean) that pattern growth finds in a conditional database, of at least both bounds and more
    confident than without any one of their items.

    An item that excludes no clean path of a set excludes none of a larger one, and the set without it is as confident. So a set grows
    only by items that exclude some, and as long as each of its items does. Nor does it grow if even the clean paths that hold all
    items it could get are too many. Both leave out no set that could be a rule. If minimal, sets that hold a rule are left out.
    """
    stack = [((), np.arange(len(bad)), list(range(len(names))), [])]
    while stack:
        own, paths, items, without = stack.pop()
        own_bad, own_clean = bad[paths], clean[paths]
        total, everywhere, growing = own_clean.sum(), np.ones(len(paths), bool), []
        for item in items:
            inside = holds[item][paths]
            n_bad, n_clean = own_bad[inside].sum(), own_clean[inside].sum()
            if n_bad >= least_bad and n_clean < total:
                growing.append((item, n_bad, n_clean))
                everywhere &= inside
        most = max((n_bad for _, n_bad, _ in growing), default=0)
        if not growing or most / (most + own_clean[everywhere].sum()) < least_confidence:
            continue
        for nth, (item, n_bad, n_clean) in enumerate(growing):
            inside = holds[item][paths]
            wider = [w[holds[item][w]] for w in without] + [paths[~inside]]
            more = [(bad[w].sum(), clean[w].sum()) for w in wider]
            if any(c == 0 or minimal and (n_bad + b) / (n_bad + b + n_clean + c) >= least_confidence for b, c in more):
                continue
            is_rule = n_bad / (n_bad + n_clean) >= least_confidence
            if is_rule and all(n_bad * (n_clean + c) > (n_bad + b) * n_clean for b, c in more):
                yield [names[i] for i in (*own, item)], int(n_bad), int(n_clean)
            if n_clean and nth + 1 < len(growing) and not (minimal and is_rule):
                stack.append(((*own, item), paths[inside], [i for i, _, _ in growing[nth + 1 :]], wider))


def _frequent_sets(held: DataFrame, items: DataFrame, least_bad: int, least_confidence: float, minimal: bool) -> DataFrame:
    """Sets (tokens, n, n_bad) of two or more classes, found by FP-growth in at least least_bad bad URLs, that imply a bad URL with
    at least least_confidence and more surely than without any one class; held is (id, bad, class). If minimal, sets that hold another are
    left out where their task can tell.

    URLs of equal items are one path, which goes from the rarest item to the most frequent. Each item's conditional database holds
    what follows it in the paths, and is mined in one task: a rare item's has few paths, a frequent one's few items.
    """
    ship(held.sparkSession)
    path = F.transform(F.sort_array(F.collect_list(F.struct("n", "class"))), lambda x: x["class"]).alias("path")
    urls = held.join(small_side(items.select("class", "n")), "class").groupBy("id", "bad").agg(path)
    paths = urls.groupBy("path").agg(F.count_if("bad").alias("n_bad"), F.count_if(~F.col("bad")).alias("n_clean"))
    each = paths.select("path", F.posexplode("path").alias("nth", "class"), "n_bad", "n_clean")
    each = each.select("class", F.slice("path", F.col("nth") + 2, F.size("path")).alias("path"), "n_bad", "n_clean")
    bases = each.groupBy("class", "path").agg(F.sum("n_bad").alias("n_bad"), F.sum("n_clean").alias("n_clean"))

    def mined(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = _grown(*_merged(batches, least_bad), least_bad, least_confidence, minimal)
        first, out = key[0].as_py(), []
        for own, n_bad, n_clean in found:
            out.append((sorted([first, *own]), n_bad + n_clean, n_bad))
            if len(out) == 10_000:
                yield _sets(out)
                out = []
        yield _sets(out)

    parts = int(held.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, as few bytes may be much work
    return bases.repartition(parts, "class").groupBy("class").applyInArrow(mined, "tokens array<string>, n long, n_bad long")


def _sets(rows: list[tuple[list[str], int, int]]) -> pa.RecordBatch:
    tokens, n, n_bad = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(tokens, pa.list_(pa.string())), pa.array(n, pa.int64()), pa.array(n_bad, pa.int64())], ["tokens", "n", "n_bad"])


def _inverted(sets: DataFrame) -> DataFrame:
    """Inverted index (class, tokens): each set of classes under that of its classes that the fewest sets share."""
    each = sets.select("tokens", F.explode("tokens").alias("class"))
    shared = each.groupBy("class").agg(F.count("*").alias("n"))
    return each.join(shared, "class").groupBy("tokens").agg(F.min_by("class", F.struct("n", "class")).alias("class"))


def _holders(owned: DataFrame, sets: DataFrame) -> DataFrame:
    """The rows of owned, which has own (the classes of a URL), for each of the sets that they hold, with its tokens."""
    looked = owned.withColumn("class", F.explode("own")).join(small_side(_inverted(sets)), "class")
    return looked.where(F.size(F.array_except("tokens", "own")) == 0).drop("class", "own")


def mine_rules(labelled: DataFrame, min_support: float = 0.001, min_count: int = 8, min_confidence: float = 0.6, minimal: bool = False) -> DataFrame:
    """Rules (tokens, any_of, confidence, support) that imply a bad URL, from labelled (url, bad).

    Tokens that the same labelled URLs hold are one item: tokens has the least token of each item, any_of all of them, and any will do. So
    tokens that a site's template repeats don't multiply. Confidence is the share of bad URLs among those that hold the rule, support the
    share of all labelled URLs that hold it and are bad.

    Rules of one item come from plain counts, with at least min_count bad URLs in tables of any size. FP-growth mines the combinations,
    of items that are neither certain by themselves nor in every clean URL; such rules need min_count bad URLs and min_support of all. It
    takes all items of a URL, however many. A rule of which a part is a rule at least as confident is left out; if minimal, any of which a
    part is a rule: the others match the same URLs, and are fewer. No labelled URLs, or none bad, give no rules.
    """
    baskets = labelled.select(url_tokens(F.col("url")).alias("tokens"), F.coalesce("bad", F.lit(False)).alias("bad"))
    baskets = checkpointed(baskets.withColumn("id", F.monotonically_increasing_id()))
    n, bad = baskets.agg(F.count("*"), F.count_if("bad")).first()
    if not bad:
        return labelled.sparkSession.createDataFrame([], "tokens array<string>, any_of array<array<string>>, confidence double, support double")
    held = baskets.select("id", "bad", F.explode("tokens").alias("token"))
    classes = checkpointed(_token_classes(held, min_count))
    found = classes.groupBy("class").agg(F.first("n").alias("n"), F.first("n_bad").alias("n_bad"), F.sort_array(F.collect_list("token")).alias("members"))
    found = checkpointed(found)
    rules = found.select(F.array("class").alias("tokens"), "n", "n_bad")
    least = max(min_count, math.ceil(min_support * n))
    extended = F.col("n_bad") / F.col("n") < (min_confidence if minimal else 1.0)
    items = found.where((F.col("n_bad") >= least) & extended & (F.col("n") - F.col("n_bad") < n - bad)).select("class", "n")
    if items.limit(2).count() == 2:
        held = held.join(small_side(classes.select("token", "class")), "token").select("id", "bad", "class").distinct()
        rules = rules.union(checkpointed(_frequent_sets(held, items, least, min_confidence, minimal)))
    rules = rules.withColumn("confidence", F.col("n_bad") / F.col("n")).where(F.col("confidence") >= min_confidence)
    rules = checkpointed(rules.select("tokens", "confidence", (F.col("n_bad") / n).alias("support")))
    part = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("part_confidence"), F.element_at("tokens", 1).alias("token"))
    wider = rules.select("tokens", "confidence", F.explode("tokens").alias("token")).join(part, "token")
    wider = wider.where((F.size("part") < F.size("tokens")) & (F.size(F.array_except("part", "tokens")) == 0) & (F.lit(minimal) | (F.col("part_confidence") >= F.col("confidence"))))
    kept = rules.join(wider.select("tokens").distinct(), "tokens", "left_anti")
    named = kept.select("*", F.posexplode("tokens").alias("nth", "class")).join(found.select("class", "members"), "class")
    members = F.transform(F.sort_array(F.collect_list(F.struct("nth", "members"))), lambda x: x["members"])
    return checkpointed(named.groupBy("tokens", "confidence", "support").agg(members.alias("any_of")).select("tokens", "any_of", "confidence", "support"))


def matching_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct urls (column url) that hold, for some rule, a token of each of its items.

    A URL's tokens are looked up among the items of the rules, and its items in the inverted index of the rules.
    """
    item = F.explode(F.arrays_zip("tokens", "any_of")).alias("item")
    names = rules.select(item).select(F.col("item.tokens").alias("class"), F.explode("item.any_of").alias("token")).distinct()
    looked = urls.select("url").where(F.col("url").isNotNull()).distinct().select("url", F.explode(url_tokens(F.col("url"))).alias("token"))
    own = looked.join(small_side(names), "token").groupBy("url").agg(F.collect_set("class").alias("own"))
    return _holders(own, rules.select("tokens")).select("url").distinct()


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=FIXED_RULES, **mining) -> DataFrame:
    """Verdict on each row's url. Returns page_id, host, path, rule, verdict and mined (whether a mined rule fits).

    The longest fixed rule that fits decides; elsewhere a URL is blocked if a mined rule fits it and allowed if not. A null
    url, or one without ://, has an empty host and path, fits no fixed rule, and is allowed. Repeated rows stay. Empty tables give
    an empty result. Only page_id and url are read of pages.
    """
    slim = pages.select("page_id", "url")
    matched = small_side(matching_urls(slim, mine_rules(labelled, **{"minimal": True, **mining}))).withColumn("mined", F.lit(True))
    judged = slim.join(matched, "url", "left").withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    judged = judged.withColumn("fixed", fixed_rule(F.col("host"), F.col("path"), rules)).withColumn("mined", F.coalesce("mined", F.lit(False)))
    verdict = F.coalesce("fixed.action", F.when(F.col("mined"), "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"), "mined")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad): pages whose page_id has a label; bad means of low quality or toxic."""
    bad = labels.groupBy(F.col("doc_id").alias("page_id")).agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return pages.select("page_id", "url").where(F.col("url").isNotNull()).join(bad.where(F.col("bad").isNotNull()), "page_id").select("url", "bad")
