"""Benchmark windows against a search at every place."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import decontaminate as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, window=10):
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, passage in items:
            p = words(passage)
            for s in range(max(1, len(p) - window + 1) if p else 0):
                part = p[s: s + window]
                for at in range(len(w) - len(part) + 1):
                    if w[at: at + len(part)] == part:
                        hit.update(range(at, at + len(part)))
                        found.add(item)
        names = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((doc, len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def case(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(12)] + ["É", "Ab", "9"]
    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 25]))) for i in range(12)] + [(2, text(12)), (None, text(11)), (50, None)]
    docs = []
    for i in range(60):
        parts = [text(rng.randint(0, 15))]
        for _ in range(rng.randint(0, 3)):
            own = words(rng.choice(items)[1])
            cut = rng.randint(0, max(0, len(own) - 9))
            parts += [" ".join(own[cut: cut + rng.randint(8, 14)]), text(rng.randint(0, 4))]
        docs.append((i, " ".join(parts)))
    return docs + [(100, None), (101, ""), (102, "--- !!"), (7, docs[7][1]), (None, docs[3][1]), (103, " ".join(w for _, t in docs for w in words(t)))], items


@pytest.mark.parametrize("seed,options", [(1, {}), (2, {"windows_per_block": 7}), (3, {"window": 4})])
def test_against_search(spark, seed, options):
    docs, items = case(seed)
    found = op.find_items(
        spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_words", F.lit("clash")),
        spark.createDataFrame(items, "item_id long, text string"), **options)
    got = sorted((tuple(r) for r in op.report(found).collect()), key=str)
    assert got == expected(docs, items, options.get("window", 10))


def test_empty_tables(spark):
    docs, items = case(4)
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r["n_hit"] for r in op.report(op.find_items(some, none)).collect()} == {0}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert op.find_items(empty, spark.createDataFrame(items, "item_id long, text string")).collect() == []


def test_drop_contaminated(spark):
    docs, items = case(5)
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"__row": F.lit(1), "spans": F.lit("s")})
    out = op.drop_contaminated(table, spark.createDataFrame(items, "item_id long, text string"))
    assert out.dtypes == table.dtypes
    clean = sorted((d for d, _, _, _, _, bad in expected(docs, items) if not bad), key=str)
    assert sorted((r["doc_id"] for r in out.collect()), key=str) == clean


def test_items_that_share_a_passage_make_one_row_for_each_place(spark):
    """500 items of one template, and a document that repeats it: places, not places times items."""
    template = " ".join(f"t{i}" for i in range(30))
    items = [(i, template) for i in range(500)] + [(1000, template + " and its own end of ten words beside it here")]
    docs = [(1, " ".join([template] * 40)), (2, "clean"), (3, template + " and its own end of ten words beside it here")]
    frame = spark.createDataFrame(items, "item_id long, text string")
    windows, owners = op._owned(op.item_windows(frame))
    assert windows.count() == 21 + 10 and owners.count() == 2
    rows = op._matches(
        spark.createDataFrame(docs, "id long, text string").select(F.col("id").alias(op.ROW), "id", op.words(F.col("text")).alias("w")),
        op.prefix_table(windows, op._rarity(spark.createDataFrame(docs, "id long, text string"), windows, "text")))
    assert rows.filter("id = 1 AND owner IS NOT NULL").count() == 40 * 21
    got = sorted((tuple(r) for r in op.report(op.find_items(spark.createDataFrame(docs, "doc_id long, text string"), frame)).collect()), key=str)
    assert got == expected(docs, items)
