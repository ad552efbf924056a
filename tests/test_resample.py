"""Resampling: exactness of the kernels, invariance, and statistical behaviour."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from data import WINDOW, feed_and_messages, users_frame
from feedmetrics import operators as op
from feedmetrics import plans
from feedmetrics.operators import resample


def some_users(n=400, seed=5):
    rng = random.Random(seed)
    return [(i, 1 + i % 2, rng.randrange(4), 1 + rng.randrange(5)) for i in range(n)]


def as_arrays(boot):
    rows = boot.orderBy("replicate").collect()
    assert [r.replicate for r in rows] == list(range(len(rows)))
    return np.array([r.ctr1 for r in rows]), np.array([r.ctr2 for r in rows])


def splitmix(seed, i):
    mask = (1 << 64) - 1
    z = (seed + i * 0x9E3779B97F4A7C15) & mask
    z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 & mask
    z = (z ^ z >> 27) * 0x94D049BB133111EB & mask
    return (z ^ z >> 31) >> 12


def test_hashed_uniforms():
    for seed in (0, 7, 16**15 - 1):
        assert resample.hashed_uniforms(seed, 50).tolist() == [splitmix(seed, i) / 2**52 for i in range(50)]


@pytest.mark.parametrize("n", [1, 2, 30, 1000, 10**6, 10**9])
def test_poisson_quantiles(n):
    u = resample.hashed_uniforms(3, 20_000)
    w = resample.poisson_quantiles(n, u)
    assert abs(w.mean() - n) < 5 * (n / 20_000) ** 0.5
    assert w.var() == pytest.approx(n, rel=0.06)
    if n < 50:
        total, cdf = 0.0, []
        for k in range(200):
            total += math.exp(k * math.log(n) - n - math.lgamma(k + 1))
            cdf.append(total)
        assert all((k == 0 or cdf[k - 1] <= x) and x < cdf[k] for x, k in zip(u.tolist(), w.tolist()))


def test_cells_match_the_same_draws_in_numpy(spark):
    rows = some_users()
    cells = {}
    for _, g, likes, views in rows:
        cells[g, likes, views] = cells.get((g, likes, views), 0) + 1
    sums = np.zeros((2, 2, 50), dtype=np.int64)
    for (g, likes, views), n in cells.items():
        seed = int(hashlib.md5(f"{g}:{likes}:{views}:7".encode()).hexdigest()[:15], 16)
        w = resample.poisson_quantiles(n, resample.hashed_uniforms(seed, 50))
        sums[g - 1] += np.array([w * likes, w * views])
    c1, c2 = as_arrays(op.poisson_bootstrap(users_frame(spark, rows), 50, seed=7))
    assert np.allclose(c1, sums[0, 0] / sums[0, 1], rtol=0, atol=1e-15)
    assert np.allclose(c2, sums[1, 0] / sums[1, 1], rtol=0, atol=1e-15)


@pytest.mark.parametrize("method", ["cells", "users"])
def test_groups_may_be_text(spark, method):
    users = users_frame(spark, some_users())
    named = users.withColumn("exp_group", F.when(F.col("exp_group") == 1, "a").otherwise("b"))
    assert op.poisson_bootstrap(named, 20, ("a", "b"), method=method).count() == 20
    assert op.welch_ttest(named, "ctr", ("a", "b")).first().t == op.welch_ttest(users).first().t
    assert op.mann_whitney(named, "ctr", ("a", "b")).first() == op.mann_whitney(users).first()
    samples = op.aa_samples(named, groups=("a", "b"), sample_size=5, n_exp=4)
    assert samples.count() == 40 and op.aa_pvalues(samples, ("a", "b")).count() == 4


def test_counts_are_checked(spark):
    users = users_frame(spark, some_users())
    for method in ("cells", "users"):
        with pytest.raises(ValueError, match="n_boot"):
            op.poisson_bootstrap(users, 0, method=method)
    with pytest.raises(ValueError, match="sample_size"):
        op.aa_samples(users, sample_size=0)
    with pytest.raises(ValueError, match="n_exp"):
        op.aa_samples(users, n_exp=0)


@pytest.mark.parametrize("method", ["cells", "users"])
def test_bootstrap_does_not_depend_on_partitions(spark, method):
    users = users_frame(spark, some_users())
    results = [as_arrays(op.poisson_bootstrap(users.repartition(n), 40, method=method)) for n in (1, 2, 8)]
    for other in results[1:]:
        assert np.array_equal(results[0], other)


def test_both_methods_agree_in_distribution(spark):
    users = users_frame(spark, some_users())
    cells = as_arrays(op.poisson_bootstrap(users, 2000, method="cells"))
    direct = as_arrays(op.poisson_bootstrap(users, 2000, method="users"))
    pooled = {r.exp_group: r.global_ctr for r in op.pooled_ctr(users).collect()}
    for i in (0, 1):
        spread = direct[i].std()
        assert abs(cells[i].mean() - direct[i].mean()) < 4 * spread / np.sqrt(1000)
        assert cells[i].std() == pytest.approx(spread, rel=0.12)
        assert abs(cells[i].mean() - pooled[i + 1]) < spread / 4


def test_poisson_weights(spark):
    key = F.col("id").cast("string")
    drawn = spark.range(200_000).select(
        resample.poisson_weight(F.md5(key)).alias("w"), resample.uniform(key, digits=13).alias("u"))
    got = {r.w: r["count"] for r in drawn.groupBy("w").count().collect()}
    cdf = [-1.0, *(b / 16**13 for b in resample.poisson_bounds()), 2.0]
    assert len(cdf) > 18
    off = drawn.select("u", F.array(*[F.lit(c) for c in cdf]).alias("cdf"), "w").where(
        ~((F.col("u") >= F.get("cdf", F.col("w"))) & (F.col("u") < F.get("cdf", F.col("w") + 1))))
    assert off.count() == 0
    for k, p in enumerate([0.367879, 0.367879, 0.183940, 0.061313, 0.015328]):
        assert got[k] / 200_000 == pytest.approx(p, abs=5 * (p / 200_000) ** 0.5)


def test_unknown_method(spark):
    with pytest.raises(ValueError):
        op.poisson_bootstrap(users_frame(spark, some_users(4)), 5, method="other")


def aa_users(n):
    return [(i, 2 + i % 2, 1 + i % 7, 3 + i % 5) for i in range(2 * n)]


@pytest.mark.parametrize("n, size", [(20, 10), (20, 20), (40, 10), (200, 10), (9, 2)])
def test_samples_are_whole_and_without_replacement(spark, n, size):
    users = users_frame(spark, aa_users(n))
    got = op.aa_samples(users, sample_size=size, n_exp=30)
    cells = got.groupBy("replicate", "exp_group").agg(
        F.count("*").alias("n"), F.count_distinct("user_id").alias("d")).collect()
    assert len(cells) == 60 and all(c.n == c.d == size for c in cells)
    known = {(u.user_id, u.exp_group, u.ctr) for u in users.collect()}
    assert {(r.user_id, r.exp_group, r.metric) for r in got.collect()} <= known


@pytest.mark.parametrize("n, size", [(30, 10), (60, 10)])
def test_every_user_is_equally_likely(spark, n, size):
    users = users_frame(spark, aa_users(n))
    n_exp = 1500
    counts = op.aa_samples(users, sample_size=size, n_exp=n_exp).groupBy("user_id").count().collect()
    p = size / n
    assert len(counts) == 2 * n
    spread = (n_exp * p * (1 - p)) ** 0.5
    assert all(abs(c["count"] - n_exp * p) < 5 * spread for c in counts)


def test_samples_do_not_depend_on_partitions(spark):
    for n in (30, 60):
        users = users_frame(spark, aa_users(n))
        results = {
            tuple(sorted(map(tuple, op.aa_samples(users.repartition(k), sample_size=10, n_exp=20).collect())))
            for k in (1, 3, 8)
        }
        assert len(results) == 1


def test_numbering_does_not_depend_on_blocks(spark):
    users = users_frame(spark, aa_users(500)).withColumnRenamed("ctr", "metric")
    numbers = [{(r.exp_group, r.number): r.user_id for r in resample.numbered(users, n).collect()} for n in (60, 7, 1_000_000)]
    assert numbers[0] == numbers[1] == numbers[2] and len(numbers[0]) == 1000
    for g in (2, 3):
        assert sorted(n for group, n in numbers[0] if group == g) == list(range(500))


def test_samples_do_not_depend_on_blocks(spark):
    users = users_frame(spark, aa_users(300))
    first, second = (
        sorted(map(tuple, op.aa_samples(users, sample_size=12, n_exp=20, rows_per_block=n).collect())) for n in (60, 1_000_000))
    assert first == second


def test_one_rule_for_every_group_size(spark):
    """The sample follows from the numbers alone, also where it is most of the group."""
    users = users_frame(spark, aa_users(40))
    by_number = {(r.exp_group, r.number): r.user_id for r in resample.numbered(users.withColumnRenamed("ctr", "metric")).collect()}
    for size in (1, 10, 39, 40):
        got = op.aa_samples(users, sample_size=size, n_exp=3).collect()
        for replicate in range(3):
            for g in (2, 3):
                pack = list(range(40))
                for i in range(size):
                    h = hashlib.md5(f"draw:{g}:{replicate}:{i}:42".encode()).hexdigest()[:13]
                    p = i + int(int(h, 16) / 16.0**13 * (40 - i))
                    pack[i], pack[p] = pack[p], pack[i]
                assert {r.user_id for r in got if (r.replicate, r.exp_group) == (replicate, g)} == {
                    by_number[g, n] for n in pack[:size]}


def test_too_small_a_group_is_an_error(spark):
    with pytest.raises(Exception, match="group 2 has 5 users, fewer than a sample of 6"):
        op.aa_samples(users_frame(spark, aa_users(5)), groups=(2,), sample_size=6, n_exp=3).collect()
    with pytest.raises(Exception, match="group 9 has 0 users"):
        op.aa_samples(users_frame(spark, aa_users(5)), groups=(2, 9), sample_size=2, n_exp=3).collect()


def test_replicates_without_p_value_count_in_the_denominator(spark):
    p = spark.createDataFrame([(0, 0.01), (1, None), (2, 0.9), (3, 0.04)], "replicate int, p_value double")
    row = op.aa_fpr(p).first()
    assert (row.n_exp, row.fpr, row.split_ok) == (4, 0.5, False)
    assert op.aa_fpr(p, alpha=0.02).first().split_ok is False
    assert op.aa_fpr(p.where("replicate > 0"), alpha=0.4).first().split_ok is True


def test_aa_p_values_are_roughly_uniform(spark):
    rng = random.Random(2)
    users = users_frame(spark, [(i, 2 + i % 2, rng.randrange(50), 20 + rng.randrange(30)) for i in range(4000)])
    p = op.aa_pvalues(op.aa_samples(users, sample_size=50, n_exp=1000))
    hist = op.histogram(p, "p_value", None, 10, (0.0, 1.0)).orderBy("bin_lo").collect()
    assert sum(h.n for h in hist) == 1000
    assert all(60 <= h.n <= 140 for h in hist)


def test_aa_check_equals_its_parts(spark):
    feed, _ = feed_and_messages(spark, "sf0.01")
    whole = plans.aa_check(feed, *WINDOW, sample_size=10, n_exp=50).first()
    users = op.user_ctr(feed, *WINDOW, (2, 3))
    parts = op.aa_fpr(op.aa_pvalues(op.aa_samples(users, sample_size=10, n_exp=50))).first()
    assert whole == parts


def test_many_packs_at_once_are_dealt_like_one():
    from feedmetrics.operators.resample import dealt

    rng = np.random.default_rng(0)
    for size, draws in ((1, 1), (10, 10), (12, 5), (29, 29), (600, 50), (10**9, 500)):
        places = np.arange(draws) + (rng.random((60, draws)) * (size - np.arange(draws))).astype(np.int64)
        for row, numbers in zip(places.tolist(), dealt(places).tolist()):
            pack = {}
            want = []
            for i, p in enumerate(row):
                pack[i], pack[p] = pack.get(p, p), pack.get(i, i)
                want.append(pack[i])
            assert numbers == want and len(set(numbers)) == draws
