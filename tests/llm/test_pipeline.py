import pathlib

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from test_operators import brute_classes, brute_lines, brute_links
from tidemark.llm.classifier import score_documents


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    out = [spark.read.parquet(f"{sf_dir}/documents.parquet")]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, out[-1], sf_dir).write.parquet(f"{folder}/{i}")
        out.append(spark.read.parquet(f"{folder}/{i}"))
    return out


def _texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_each_stage_does_its_work(spark, sf_dir, stages):
    docs, scored, lined, joined, mixed, encoded = stages
    assert all(x.columns == docs.columns for x in (scored, lined, joined, mixed))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert _texts(scored) == _texts(score_documents(docs, labels).where("score >= 0.3"))
    assert _texts(lined) == {d: t for d, _, _, t in brute_lines(list(_texts(scored).items()))}
    texts = _texts(lined)
    classes = brute_classes(texts, brute_links(texts))
    assert _texts(joined) == {d: t for d, t in texts.items() if classes[d] == d}
    assert {r["doc_id"] for r in mixed.collect()} <= set(_texts(joined))
    assert encoded.count() == mixed.count() and encoded.where("size(ids) <> n_tokens").count() == 0


def test_run(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    same = lambda df: sorted((r["doc_id"], r["ids"]) for r in df.collect())
    assert same(got) == same(stages[-1])


def test_stages_take_edge_rows(spark, sf_dir, stages):
    docs = stages[0]
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "a b c d e f g h i j " * 2000, None, None, 3)]
    df = spark.createDataFrame(rows, docs.schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df, sf_dir).count() >= 0, name
        assert stage(spark, df.where(F.lit(False)), sf_dir).count() == 0, name


def test_one_row_of_each_class(spark, sf_dir):
    def text(name):
        return " ".join(f"{name}{k}" for k in range(60))

    near = {n: text(n) + " end" for n in "abc"}
    rows = [(1, text("a")), (5, text("b")), (5, near["a"]), (6, text("c")), (6, text("d")), (7, near["b"]), (None, text("e")), (None, text("e") + " end"), (None, text("f")), (None, near["c"]), (8, ""), (9, None), (9, None)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], docs.schema).repartition(3)
    got = [(r["doc_id"], r["text"]) for r in corpus_pipeline.join_near_duplicates(spark, df, sf_dir).collect()]
    e = [t for d, t in got if d is None and t != text("f")]
    assert len(e) == 1 and e[0] in (text("e"), text("e") + " end")
    assert sorted((x for x in got if x[1] not in e), key=str) == sorted([(1, text("a")), (5, text("b")), (6, text("c")), (6, text("d")), (None, text("f")), (8, ""), (9, None)], key=str)


#: Names that the operators use, or used, inside.
INNER = (
    "kept_id", "kept_hash", "line_doc", "line_digests", "line_key", "mix_key", "mix_copy", "mix_size", "mix_range", "mix_taken", "score", "n_dropped", "n_lines", "join_hash", "text_hash", "rest",
    "doc", "class_set", "class_id", "again", "again_hash", "ids", "key", "size", "none", "block", "node", "host", "decoded", "passages",
)


@pytest.mark.parametrize("at", range(len(corpus_pipeline.STAGES)))
def test_stages_keep_columns_of_any_name(spark, sf_dir, stages, at):
    stage = corpus_pipeline.STAGES[at][1]
    docs = stages[at].select("*", *[F.lit(n).alias(n) for n in INNER])
    got = stage(spark, docs, sf_dir)
    if at + 1 < len(corpus_pipeline.STAGES):
        assert got.columns == docs.columns and got.where(" OR ".join(f"{n} IS NULL OR {n} <> '{n}'" for n in INNER)).count() == 0
    assert got.count() == stages[at + 1].count()


def test_run_leaves_one_stage(spark, sf_dir, monkeypatch):
    folders, shared = [], corpus_pipeline.shared_folder
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda *a: folders.append(shared(*a)) or folders[-1])
    assert corpus_pipeline.run(spark, sf_dir).count() > 0
    names = [p.name for p in pathlib.Path(folders[0].removeprefix("file:")).iterdir() if not p.name.startswith(".")]
    assert names == ["3-mixing"]
