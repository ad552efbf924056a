"""Histograms of one scan against the same bins cut with the extremes known."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from data import feed_and_messages, WINDOW
from feedmetrics import operators as op
from feedmetrics.operators.dyadic import exponent


def expected(rows, bins):
    finite = [v for _, v in rows if v is not None and math.isfinite(v)]
    out = Counter()
    if finite:
        e = exponent(min(finite), max(finite), bins)
    for g, v in rows:
        if v is None:
            continue
        if math.isfinite(v):
            place = math.floor(math.ldexp(v, -e))
            out[g, math.ldexp(place, e), math.ldexp(place + 1, e)] += 1
        else:
            out[g, "nan" if math.isnan(v) else v, "nan" if math.isnan(v) else v] += 1
    return out


def got(df, by="g"):
    return Counter({
        (r[by] if by else None, *("nan" if math.isnan(x) else x for x in (r["bin_lo"], r["bin_hi"]))): r["n"] for r in df.collect()})


SAMPLES = {
    "growing": [2.0**i for i in range(-20, 40)],
    "around zero": [x / 7 for x in range(-90, 90)],
    "one value": [3.25] * 40,
    "zeros": [0.0, -0.0, 0.0],
    "large": [1e15 + i for i in range(64)],
    "tiny": [5e-324, 1e-310, -1e-300],
    "far apart": [-1e300, 1e300, 0.0],
    "odd": [math.nan, math.inf, -math.inf, 1.0, 2.0, math.nan, None],
    "edges": [0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0],
    "negative": [-8.0, -7.999, -4.0, -1.0],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("bins", [1, 7, 20])
def test_counts(spark, name, bins):
    values = SAMPLES[name]
    if bins == 1 and min((v for v in values if v and math.isfinite(v)), default=0) < 0 < max((v for v in values if v and math.isfinite(v)), default=0):
        pytest.skip("no bin of a power of two holds both signs")
    rng = random.Random(name)
    rows = [(rng.choice(["a", "b", None]), v) for v in values]
    df = spark.createDataFrame(rows, "g string, x double").repartition(5)
    assert got(op.histogram_one_scan(df, "x", "g", bins)) == expected(rows, bins)
    assert sum(got(op.histogram_one_scan(df, "x", None, bins), None).values()) == sum(v is not None for v in values)


def test_bins_are_few_and_wide_enough(spark):
    rng = random.Random(3)
    values = [rng.gauss(100, 30) for _ in range(5000)]
    rows = op.histogram_one_scan(spark.createDataFrame([(v,) for v in values], "x double").repartition(16), "x", None, 20).collect()
    assert 10 <= len(rows) <= 20 and sum(r["n"] for r in rows) == 5000
    assert all(r["n"] == sum(r["bin_lo"] <= v < r["bin_hi"] for v in values) for r in rows)


def test_empty_and_null(spark):
    df = spark.createDataFrame([("a", None)], "g string, x double")
    assert op.histogram_one_scan(df, "x", "g").collect() == []
    assert op.histogram_one_scan(df.limit(0), "x").columns == ["bin_lo", "bin_hi", "n"]


def test_one_scan(spark):
    plan = op.histogram_one_scan(op.user_ctr(feed_and_messages(spark, "sf0.01")[0], *WINDOW), "ctr", "exp_group")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Subquery" not in text
    ints = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").alias("x"))
    assert sum(r["n"] for r in op.histogram_one_scan(ints, "x", "g", 4).collect()) == 100
