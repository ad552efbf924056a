"""Draws of counts per value against exact chances, samples of users, and each other."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from data import users_frame
from feedmetrics import operators as op
from feedmetrics.operators import aacells


def chances(total, left, drawn):
    return [math.comb(left, x) * math.comb(total - left, drawn - x) / math.comb(total, drawn) if x <= left and drawn - x <= total - left else 0.0
            for x in range(drawn + 1)]


@pytest.mark.parametrize("total, left, drawn", [
    (10, 4, 3), (10, 0, 3), (10, 10, 3), (10, 4, 10), (1, 1, 1), (7, 3, 0), (60, 25, 30), (500, 3, 400), (1000, 500, 1), (200, 199, 150)])
def test_quantiles(total, left, drawn):
    u = (np.arange(4000) + 0.5) / 4000
    full = [np.full(len(u), v, np.int64) for v in (total, left, drawn)]
    got = aacells.hypergeometric_quantiles(*full, u)
    bounds = np.cumsum(chances(total, left, drawn))
    assert (got == np.minimum(np.searchsorted(bounds, u, side="right"), drawn)).all()
    assert got.min() >= max(0, drawn - (total - left)) and got.max() <= min(left, drawn)


def test_quantiles_of_large_numbers():
    u = (np.arange(2000) + 0.5) / 2000
    total, left, drawn = 3_000_000_000, 1_000_000_000, 90_000
    got = aacells.hypergeometric_quantiles(*[np.full(len(u), v, np.int64) for v in (total, left, drawn)], u)
    assert got.mean() == pytest.approx(drawn / 3, rel=1e-3)
    assert got.std() == pytest.approx(math.sqrt(drawn * 2 / 9), rel=1e-2)


def sample(spark, users=400, groups=(2, 3)):
    rows = [(u, g, (u * 7 + g) % 11, 10 + u % 5) for g in groups for u in range(users)] + [(10_000, groups[0], 3, 0)]
    return users_frame(spark, rows).cache()


def test_moments_are_those_of_samples(spark):
    """Means and variances over replicates agree with those of samples of users, within their own error."""
    users = sample(spark)
    got = op.aa_moments(users, sample_size=60, n_exp=4000).toPandas()
    want = op.aa_samples(users, sample_size=60, n_exp=4000).groupBy("replicate").agg(*aacells_moments()).toPandas()
    assert len(got) == 4000 and (got["n1"] == 60).all() and (got["n2"] == 60).all()
    for c in ("mean1", "mean2", "var1", "var2"):
        error = math.hypot(got[c].std(), want[c].std()) / math.sqrt(4000)
        assert abs(got[c].mean() - want[c].mean()) < 5 * error, c
        assert got[c].std() == pytest.approx(want[c].std(), rel=0.08), c
    assert abs(np.corrcoef(got["mean1"], got["mean2"])[0, 1]) < 0.08


def aacells_moments():
    from feedmetrics.operators.stats import moments

    return moments("metric", (2, 3))


def test_the_whole_group_is_its_own_sample(spark):
    users = sample(spark, 50)
    row = op.aa_moments(users, sample_size=50, n_exp=3).orderBy("replicate").collect()
    for i, g in ((1, 2), (2, 3)):
        mean, var = users.where(f"exp_group = {g} and ctr is not null").agg(F.avg("ctr"), F.var_samp("ctr")).first()
        assert [r[f"mean{i}"] for r in row] == pytest.approx([mean] * 3)
        assert [r[f"var{i}"] for r in row] == pytest.approx([var] * 3)


def test_blocks_slices_and_partitions_change_nothing(spark):
    users = sample(spark)
    want = op.aa_moments(users, sample_size=30, n_exp=200).orderBy("replicate").collect()
    for options in ({"block_bits": 1}, {"block_bits": 3, "slices": 5}, {"slices": 1}):
        got = op.aa_moments(users.repartition(5), sample_size=30, n_exp=200, **options).orderBy("replicate").collect()
        for a, b in zip(got, want, strict=True):
            assert tuple(a) == pytest.approx(tuple(b)), options


def test_small_samples_and_one_value(spark):
    one = op.aa_moments(sample(spark, 20), sample_size=1, n_exp=10).collect()
    assert len(one) == 10 and all(r["n1"] == 1 and r["var1"] is None for r in one)
    same = op.aa_moments(users_frame(spark, [(u, g, 1, 2) for g in (2, 3) for u in range(9)]), sample_size=5, n_exp=10)
    assert {(r["mean1"], r["var2"]) for r in same.collect()} == {(0.5, 0.0)}
    assert {r["p_value"] for r in op.aa_pvalues_of(same).collect()} == {None}


def test_large_values_keep_their_differences(spark):
    users = sample(spark, 50).withColumn("ctr", F.col("ctr") + 1e9)
    near = op.aa_moments(users, sample_size=50, n_exp=1).first()
    assert near["var1"] == pytest.approx(users.where("exp_group = 2").agg(F.var_samp("ctr")).first()[0], rel=1e-5)


def test_groups_that_are_too_small(spark):
    for users in (sample(spark, 8), sample(spark, 8, (2, 4))):
        with pytest.raises(Exception, match="group 3 has [80] users, fewer than a sample of 9|group 2 has 8 users"):
            op.aa_moments(users, sample_size=9, n_exp=4).collect()
    with pytest.raises(ValueError, match="sample_size"):
        op.aa_moments(sample(spark, 8), sample_size=0)


def test_work_does_not_grow_with_the_sample(spark):
    """Rows that meet a block are one per replicate and block, whatever the sample."""
    leaves = [len(aacells.descend("2", np.full(16, 10**7), 0, 0, 4, np.arange(100), np.full(100, size), 42)[0])
              for size in (10, 1000, 1_000_000)]
    assert leaves[0] <= 1000 and leaves[1:] == [1600, 1600]
