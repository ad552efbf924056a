"""Toxicity and quality: held-out accuracy, folds, and edge cases."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import boosting, labelled, quality, toxicity

SF = "/root/testdata/sf0.1"
CASES = [(toxicity.toxicity, "toxic", 5, 0), (quality.quality, "quality", 3, 1)]


def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable"), kind="stable")
    pos = y == 1
    return (order[pos].mean() - (pos.sum() - 1) / 2) / (~pos).sum()


@pytest.mark.parametrize("classify,label,folds,out", CASES)
def test_held_out_rows(spark, classify, label, folds, out):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = {r["id"]: r for r in classify(docs, labels).collect()}
    assert len(rows) == docs.count()
    for doc, r in rows.items():
        assert r["held_out"] == (zlib.crc32(str(doc).encode()) % folds == out)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    known = [(rows[r["doc_id"]], r[label]) for r in labels.collect() if rows[r["doc_id"]]["held_out"]]
    y = np.array([v for _, v in known])
    score = np.array([r["score"] for r, _ in known])
    assert auc(score, y) > 0.97
    assert np.mean((score >= 0.5) == y) > 0.97


@pytest.mark.parametrize("classify,label,folds,out", CASES)
def test_held_out_labels_are_never_used(spark, classify, label, folds, out):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    turned = labels.withColumn(label, F.when(labelled.held_out(F.col("doc_id"), folds, out), 1 - F.col(label)).otherwise(F.col(label)))
    assert turned.exceptAll(labels).count() > 0
    first, second = ({r["id"]: r["score"] for r in classify(docs, x).collect()} for x in (labels, turned))
    assert first == second


@pytest.mark.parametrize("classify,label,folds,out", CASES)
def test_edges(spark, classify, label, folds, out):
    docs = spark.createDataFrame(
        [(1, None), (2, ""), (2, ""), (None, "some text"), (4, "you idiot " * 60_000), (5, "!!! ??? \x00")], "doc_id long, text string"
    ).withColumn("score", F.lit("clash"))
    schema = f"doc_id long, {label} int"
    for labels in ([], [(2, 1)], [(None, 1), (1, None)], [(1, 0), (2, 1), (2, 0), (4, 1), (5, 0), (99, 1)]):
        rows = classify(docs, spark.createDataFrame(labels, schema)).collect()
        assert len(rows) == 6 and all(0 <= r["score"] <= 1 for r in rows)
        assert [r["held_out"] for r in rows if r["id"] is None] == [False]
    assert classify(docs.limit(0), spark.createDataFrame([(1, 1)], schema)).collect() == []


def test_drop_toxic_keeps_clean_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("clash"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    out = toxicity.drop_toxic(docs, labels)
    assert out.dtypes == docs.dtypes
    kept = {r["doc_id"] for r in out.select("doc_id").collect()}
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    toxic, clean = [d for d in known if known[d]], [d for d in known if not known[d]]
    assert np.mean([d in kept for d in clean]) > 0.995
    assert np.mean([d in kept for d in toxic]) < 0.15      # some labelled texts hold no sign of it


def test_obfuscated_words_are_seen():
    words = toxicity.Lexicon(dict.fromkeys(toxicity.INSULTS, 4.0))
    plain, hidden, clean = toxicity.features(["you are an idiot", "you are an 1d.i0t!", "you are a friend"], words)
    assert plain[1] == hidden[1] > clean[1] == 0
    assert hidden[13] > plain[13] == 0
    assert plain[7] == 1


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 3))
    y = ((x[:, 0] > 0.5) != (x[:, 1] > 0.3)).astype(float)
    model = boosting.boost(x[:3000], y[:3000])
    assert np.mean((model.margin(x[3000:]) > 0) == y[3000:]) > 0.97


def test_isotonic_is_the_best_rising_fit():
    scores = np.array([1.0, 2, 3, 4, 5, 6])
    xs, ps = boosting.isotonic(scores, np.array([0, 1, 0, 0, 1, 1]))
    assert np.allclose(np.interp([2, 3, 4], xs, ps), 1 / 3)
    assert (np.diff(ps) >= 0).all() and 0 < ps[0] < ps[-1] < 1


def test_hashed_sample(spark):
    df = spark.range(50_000).select(F.col("id").cast("string").alias("k"))
    whole = [r["k"] for r in df.orderBy(F.pmod(F.xxhash64("k"), F.lit(1 << 40)), "k").limit(700).collect()]
    for total in (50_000, 10, 60_000):
        assert [r["k"] for r in labelled.hashed_sample(df, "k", 700, total).collect()] == whole
    assert labelled.hashed_sample(df, "k", 60_000, 50_000).count() == 50_000
    assert labelled.hashed_sample(df.limit(0), "k", 5, 0).count() == 0


def test_copies_do_not_fill_a_sample(spark):
    df = spark.range(300).select(F.concat(F.lit("text "), "id").alias("k"))
    first = labelled.hashed_sample(df, "k", 1, 300).first()["k"]
    copies = df.union(spark.range(5000).select(F.lit(first).alias("k")))
    assert labelled.distinct_texts(copies, "k") == 300
    sample = [r["k"] for r in labelled.hashed_sample(copies, "k", 100, 300).collect()]
    assert len(sample) == len(set(sample)) == 100
    assert sample == [r["k"] for r in labelled.hashed_sample(df, "k", 100, 300).collect()]
