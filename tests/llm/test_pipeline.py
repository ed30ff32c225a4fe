"""The pipeline against brute force on a small fixture taken from the given tables."""

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from candleflow.llm import byteconv as B
from candleflow.llm.common import components, load
from candleflow.session import scratch_path
from test_linededup import brute_runs
from test_minhash import brute as groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = load(spark, SF, "documents"), []
    for name, stage in C.STAGES:
        path = scratch_path(spark, f"test-{name}")
        stage(spark, docs, SF).write.parquet(path)
        out.append((name, docs, spark.read.parquet(path)))
        docs = out[-1][2]
    return {name: (a, b) for name, a, b in out}


def test_stage_order_and_columns(spark, stages):
    assert [n for n, _ in C.STAGES] == ["quality", "line_dedup", "near_dedup", "packing"]
    columns = load(spark, SF, "documents").columns
    assert all(stages[n][1].columns == columns for n in ("quality", "line_dedup", "near_dedup"))


def test_quality_keeps_what_scores_well(spark, stages):
    before, after = stages["quality"]
    net = B.train(before, load(spark, SF, "labels"))
    want = {r.doc_id for r in B.score(before, net).where("predicted = 1").collect()}
    assert {r.doc_id for r in after.collect()} == want
    good = {r.doc_id for r in load(spark, SF, "labels").where("quality = 1").collect()}
    assert len(good & want) >= 0.95 * len(good)


def test_line_dedup_leaves_each_passage_once(spark, stages):
    before, after = stages["line_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    left = brute_runs(spark, [r for r in rows if r[1]])
    want = {i: (left[i, t][0] if t else t) for i, t in rows if not t or left[i, t][1] == 0 or left[i, t][0].strip()}
    assert {r.doc_id: r.text for r in after.collect()} == want
    assert after.where(F.col("n_chars") != F.length("text")).count() == 0


def test_near_dedup_leaves_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    root = groups(rows)
    assert {r.doc_id for r in after.collect()} == {i for i, _ in rows if root[i] == i}


def test_packing_holds_every_document(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}
    full = after.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert all(r.n <= 2048 for r in full) and len(full) <= sum(r.n for r in full) / 2048 * 1.02 + 2


def test_components(spark):
    import random

    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    out = {r.id: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert out == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_near_dedup_decides_by_row(spark):
    """A doc_id on rows of different texts, repeated rows, rows without words
    or doc_id, and columns with names that clash."""
    copied, own, more = (" ".join(f"{w}{k}" for k in range(30)) for w in "abc")
    rows = [(1, copied), (2, copied), (2, own), (3, more), (3, more), (4, more + " end"), (5, ""), (6, " "), (5, None), (None, copied), (None, copied), (7, own)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], COLUMNS).selectExpr("*", "1 as h1", "2 as group_id", "'x' as kept")
    out = C.near_dedup(spark, docs, "")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id or 0, r.text) for r in out.collect()), key=str)
    assert got == sorted([(1, copied), (2, own), (3, more), (5, ""), (5, None), (6, " "), (0, copied), (0, copied)], key=str)


@pytest.mark.parametrize("stage", [C.line_dedup, C.near_dedup])
def test_stages_take_empty_tables(spark, stage):
    docs = spark.createDataFrame([], COLUMNS)
    assert stage(spark, docs, "").count() == 0 and stage(spark, docs, "").columns == docs.columns
    assert C.packing(spark, docs, "").count() == 0


def test_quality_without_labelled_texts_keeps_all(spark):
    docs = spark.createDataFrame([(i, "some text", "en", "s", 9) for i in range(5)], COLUMNS)
    labels = spark.createDataFrame([(100 + i, i % 2) for i in range(40)], "doc_id long, quality int")
    net = B.train(docs, labels)
    assert isinstance(net, float) and 0 < net < 1
    assert B.passing(docs, net).count() == 5 and B.score(docs, net).where("score between 0 and 1").count() == 5


def test_long_labelled_texts_are_learned_from(spark):
    docs = spark.createDataFrame([(i, ("aeiou stou " if i % 2 else "*** zz# ") * 2500) for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    assert isinstance(B.train(docs, labels), B.Network)
    assert isinstance(B.train(docs, labels, max_bytes=10), B.Network)  # the shortest of each class
