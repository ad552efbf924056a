"""The pipeline against its stages done by hand on the rows they were given."""

from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import SparkSession
from pyspark.sql import types as T

import corpus_pipeline
from feedmetrics.llm.store import land, no_rows
from test_decontaminate import expected as hits
from test_exact_dedup import clean
from test_jaccard_join import expected as groups

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    given = {r["doc_id"]: r["text"] for r in docs.collect()}
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "best-fit packing"]
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r["doc_id"]: r["text"] for r in kept.collect()}
        kept = corpus_pipeline.land(stage(spark, kept, SF), "test-stage")
        assert kept.dtypes == docs.dtypes
        after = {r["doc_id"] for r in kept.collect()}
        if name == "toxicity":
            clean_ids = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 0").collect()}
            assert len(clean_ids - after) <= 2 and len(after) > 0.8 * len(before) and after < before.keys()
        elif name == "exact dedup":
            best = {}
            for d in sorted(before, key=lambda d: (-len(before[d]), d)):
                best.setdefault(clean(before[d]), d)
            assert after == set(best.values())
        elif name == "n-gram Jaccard join":
            assert after == {c for _, n, c in groups(sorted(before.items())) if n} | {d for d in before if not before[d].split()}
        else:
            assert after == {d for d, _, _, _, _, bad in hits(sorted(before.items()), items) if not bad}
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert {r["doc_id"] for r in packed} == after
    used = Counter()
    for r in packed:
        used[r["sequence_id"]] += r["length"]
    assert max(used.values()) <= 2048
    assert given.keys() >= after


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    used = Counter()
    for r in rows:
        used[r["sequence_id"]] += r["length"]
    assert rows and max(used.values()) <= 2048
    assert len({(r["doc_id"], r["piece"]) for r in rows}) == len(rows)


EDGE = [
    (1, None), (2, ""), (3, " \n "), (3, " \n "), (None, "no id here at all but some words"), (4, "no id here at all but some words"),
    (5, "a b"), (5, "a b"), (6, "word " * 30_000), (7, "Ünïcode \U0001d11e words <|endoftext|> and more of them"), (8, "x"),
]


def edge_table(spark, rows):
    """Rows with nulls, repeats and a long text, in a table whose other columns have names that stages use inside."""
    names = ("__row", "id", "label", "kept", "keep_id", "score", "part", "n", "digest", "spans", "length")
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(c) for c in names}).withColumn("source", F.lit(None).cast("string"))


def test_stages_on_edge_rows(spark):
    docs = edge_table(spark, EDGE)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.land(stage(spark, docs, SF), "edge-stage")
        assert out.dtypes == docs.dtypes, name
        rows = out.collect()
        assert all(r[c] == c for r in rows for c in ("__row", "label", "kept", "score")), name
        texts = sorted((r["text"] or "") for r in rows)
        if name == "exact dedup":
            assert len(texts) == len({clean(t) for _, t in EDGE})
        elif name == "n-gram Jaccard join":
            assert len(texts) == 4 + len({t for _, t in EDGE if (t or "").split()})
        else:
            assert texts == sorted((t or "") for _, t in EDGE), name
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sum(r["piece"] == 0 for r in packed) == len(EDGE)


def test_stages_on_an_empty_table(spark):
    docs = edge_table(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == [], name


@pytest.mark.parametrize("stage, kept", [(corpus_pipeline.one_of_each_text, [1, 2, 4]), (corpus_pipeline.one_of_each_group, [1, 4])])
def test_no_table_is_made_of_python_rows(spark, monkeypatch, stage, kept):
    """Frames of Python lists take workers with a daemon of their own on every executor."""
    words = " ".join(f"w{i}" for i in range(40))
    docs = land(spark.createDataFrame([(1, words), (2, words + " x"), (3, words), (4, "other")], "doc_id long, text string"), "few")

    def refused(*_, **__):
        raise AssertionError("createDataFrame")

    monkeypatch.setattr(SparkSession, "createDataFrame", refused)
    assert sorted(r["doc_id"] for r in stage(spark, docs, None).collect()) == kept


def test_a_table_without_rows(spark):
    schema = T.StructType().add("a", T.LongType()).add("b", T.StructType().add("c", T.StringType()).add("d", T.BinaryType()))
    empty = no_rows(spark, schema)
    assert [(f.name, f.dataType) for f in empty.schema] == [(f.name, f.dataType) for f in schema] and empty.collect() == []
    assert "ExistingRDD" not in empty._jdf.queryExecution().toString()
