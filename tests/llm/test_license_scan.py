"""Licence scans against a comparison of every sentence with every template."""

import random
import re

import pytest
from pyspark.sql import functions as F

from feedmetrics.llm import license_scan as op


def sentences(text):
    lines = re.split(r"(?<=[.!?:;])[ \t-\r]+|[\n\r]+", text)
    across = re.split(r"(?<=[.!?:;])[ \t-\r]+", re.sub(r"[\n\r]+", " ", text))
    return set(lines + across)


def expected(text, licenses, percent=80):
    out = set()
    for s in sentences(text or ""):
        own = set(op.plain_bigrams(s))
        best = max(
            ((2 * len(own & set(t)) / (len(own) + len(t)), len(t), name, 200 * len(own & set(t)) >= percent * (len(own) + len(t)))
             for name, texts in licenses.items() for t in [op.plain_bigrams(x) for x in texts] if t), default=(0, 0, "", False))
        if own and best[3]:
            out.add((round(best[0], 9), best[2], s))
    return out


def noisy(rng, text):
    words = text.split(" ")
    for _ in range(rng.randint(0, max(1, len(words) // 6))):
        at = rng.randrange(len(words))
        kind = rng.random()
        if kind < 0.4:
            words[at] = words[at].upper() + rng.choice([",", " ", "\n", " - "])
        elif kind < 0.7:
            words.insert(at, rng.choice(["really", "the", "\n"]))
        elif len(words) > 2:
            del words[at]
    return " ".join(words)


@pytest.mark.parametrize("percent", [80, 60])
def test_against_all_templates(spark, percent):
    rng = random.Random(4)
    notices = [t for texts in op.LICENSES.values() for t in texts]
    rows = [(1, None), (2, ""), (3, " .\n!"), (None, notices[0]), (5, "Licensed"), (6, "under CC BY 4.0"), (6, "under CC BY 4.0"),
            (7, "word " * 100_000 + notices[3])]
    for i in range(150):
        parts = [" ".join(rng.choice(["the", "license", "of", "mit", "free", "version", "x"]) for _ in range(rng.randint(0, 30)))]
        for _ in range(rng.randint(0, 3)):
            parts += [noisy(rng, rng.choice(notices)), rng.choice(["Some prose. ", "and more;", ""])]
        rows.append((100 + i, rng.choice(["\n", " ", ". ", "\r\n"]).join(parts)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("found", F.lit("clash"))
    got = [(r["id"], {(round(f["dice"], 9), f["license"], f["sentence"]) for f in r["found"]}) for r in op.scan(docs, percent=percent).collect()]
    assert sorted(got, key=str) == sorted(((d, expected(t, op.LICENSES, percent)) for d, t in rows), key=str)
    assert sum(len(f) for _, f in got) > 100


def test_a_match_needs_one_of_the_necessary_bigrams():
    rng = random.Random(1)
    for n in range(1, 40):
        own = [f"a{i} b" for i in range(n)]
        needed = set(op.necessary(own))
        for _ in range(50):
            shared = rng.sample(own, rng.randint(0, n))
            extra = rng.randint(0, 3)
            if 200 * len(shared) >= 80 * (len(shared) + extra + n):
                assert needed & set(shared)


def test_report(spark):
    docs = spark.createDataFrame(
        [(1, "Released under the MIT License. Text.\nLicensed under CC BY-NC 4.0."), (2, "nothing")], "doc_id long, text string")
    assert [tuple(r) for r in op.report(op.scan(docs)).orderBy("doc_id").collect()] == [
        (1, "cc-by-nc-4.0,mit", 2, "cc-by-nc-4.0", 1.0), (2, "", 0, None, None)]


def test_own_templates_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "Use it as you like, friend.")], "doc_id long, text string")
    own = {"friendly": ("Use it as you like, my friend.",), "odd": ("one", "")}
    (row,) = op.scan(docs, licenses=own, percent=70).collect()
    assert [f["license"] for f in row["found"]] == ["friendly"]
    assert op.scan(docs.limit(0)).collect() == []
