"""Tail probabilities and tests against known values and brute force."""

import math
import random

import numpy as np
import pytest

from data import users_frame
from feedmetrics import operators as op
from feedmetrics.functions.pvalues import gaussian_two_sided, student_two_sided


def student(t, df):
    return float(student_two_sided(np.array([t], float), np.array([df], float))[0])


@pytest.mark.parametrize("t, df, p", [
    (2.0, 10, 0.0733880348), (0.0, 7, 1.0), (1.0, 1, 0.5), (12.706204736, 1, 0.05), (2.228138852, 10, 0.05),
    (4.587, 10, 0.001), (1.959963985, 1e7, 0.05),
])
def test_student(t, df, p):
    assert student(t, df) == pytest.approx(p, abs=2e-6)
    assert student(-t, df) == student(t, df)


def test_student_cauchy_closed_form():
    for t in (0.1, 0.7, 3.0, 40.0):
        assert student(t, 1) == pytest.approx(1 - 2 / math.pi * math.atan(t), abs=1e-12)


def closed_form(t, df):
    """Student's distribution for a whole ``df`` as a finite sum."""
    theta, cos2 = math.atan(t / math.sqrt(df)), df / (df + t * t)
    total, term = 0.0, 1.0
    if df % 2:
        for k in range(1, (df - 1) // 2 + 1):
            total += term
            term *= cos2 * 2 * k / (2 * k + 1)
        return 1 - 2 / math.pi * (theta + math.sin(theta) * math.cos(theta) * total)
    for k in range(1, df // 2 + 1):
        total += term
        term *= cos2 * (2 * k - 1) / (2 * k)
    return 1 - math.sin(theta) * total


@pytest.mark.parametrize("df", [1, 2, 3, 4, 7, 10, 31, 100, 999, 1000, 2001, 30_000])
def test_student_closed_forms(df):
    for t in (0.0, 0.01, 0.3, 1.0, 1.96, 3.0, 6.0, 40.0):
        assert student(t, df) == pytest.approx(closed_form(t, df), abs=1e-10)


@pytest.mark.parametrize("df", [1e5, 1e6, 1e7, 1e8, 1e9])
def test_student_of_many_degrees_of_freedom(df):
    """The normal tail and the first term in 1 / df."""
    for t in (0.01, 0.5, 1.0, 1.96, 3.0, 4.2, 5.0):
        density = math.exp(-t * t / 2) / math.sqrt(2 * math.pi)
        first = density * (t**3 + t) / (2 * df)
        assert student(t, df) == pytest.approx(math.erfc(t / math.sqrt(2)) + first, rel=1e-7, abs=max(1e-13, 100 * first / df))


def test_a_fraction_that_does_not_converge_is_nan(monkeypatch):
    monkeypatch.setattr("feedmetrics.functions.pvalues._ROUNDS", 3)
    assert math.isnan(student(1.0, 50))


def test_undefined_input_gives_nan():
    assert math.isnan(student(float("nan"), 5)) and math.isnan(student(1.0, 0))


def test_gaussian():
    z = gaussian_two_sided(np.array([1.96, 0.0, -3.0]))
    assert z.tolist() == pytest.approx([0.0499957903, 1.0, 1.0])


def sample(n, seed, top):
    rng = random.Random(seed)
    return [(i, 1 + i % 2, rng.randrange(top), rng.randrange(top)) for i in range(n)]


def brute_force_u(users):
    a = [x.ctr for x in users if x.exp_group == 1 and x.ctr is not None]
    b = [x.ctr for x in users if x.exp_group == 2 and x.ctr is not None]
    return len(a), len(b), sum((x > y) + 0.5 * (x == y) for x in a for y in b)


@pytest.mark.parametrize("ranges", [1, 2, 7, 256])
@pytest.mark.parametrize("top", [2, 5, 200])
def test_mann_whitney_counts_pairs(spark, ranges, top):
    users = users_frame(spark, sample(300, 11, top))
    n1, n2, u = brute_force_u(users.collect())
    row = op.mann_whitney(users, ranges=ranges).first()
    assert (row.n1, row.n2, row.u1) == (n1, n2, u)
    assert row.u1 + row.u2 == n1 * n2


def test_mann_whitney_known_p_value(spark):
    rows = [(i, 1, x, 100) for i, x in enumerate([19, 22, 16, 29, 24])]
    rows += [(i, 2, x, 100) for i, x in enumerate([20, 11, 17, 12], start=5)]
    row = op.mann_whitney(users_frame(spark, rows)).first()
    assert row.u1 == 17
    assert row.p_value == pytest.approx(0.11134688653314041, abs=1e-12)


def test_mann_whitney_all_tied(spark):
    row = op.mann_whitney(users_frame(spark, [(i, 1 + i % 2, 1, 1) for i in range(10)])).first()
    assert row.u1 == row.u2 == 12.5 and row.z is None and row.p_value is None


def test_mann_whitney_does_not_depend_on_partitions(spark):
    users = users_frame(spark, sample(200, 3, 9))
    results = {tuple(op.mann_whitney(users.repartition(n)).first()) for n in (1, 2, 8)}
    assert len(results) == 1


def test_t_test_forms(spark):
    rows = [(i, 1, x, 10) for i, x in enumerate([1, 4, 7, 7])] + [(i, 2, x, 10) for i, x in enumerate([2, 3, 9], 4)]
    users = users_frame(spark, rows)
    x, y = np.array([0.1, 0.4, 0.7, 0.7]), np.array([0.2, 0.3, 0.9])
    vx, vy = x.var(ddof=1), y.var(ddof=1)
    welch, pooled = op.t_test(users).first(), op.t_test(users, equal_var=True).first()
    assert welch.t == pytest.approx((x.mean() - y.mean()) / math.sqrt(vx / 4 + vy / 3))
    assert pooled.df == 5
    assert pooled.t == pytest.approx(
        (x.mean() - y.mean()) / math.sqrt((3 * vx + 2 * vy) / 5 * (1 / 4 + 1 / 3)))
    assert 0 < welch.p_value < 1 and 0 < pooled.p_value < 1


@pytest.mark.parametrize("rows", [
    [],
    [(0, 1, 1, 2)],
    [(0, 1, 1, 2), (1, 2, 1, 2)],
    [(0, 1, 1, 2), (1, 1, 1, 2), (2, 2, 1, 2), (3, 2, 1, 2)],
    [(0, 1, 1, 0), (1, 1, 1, 2), (2, 1, 2, 2)],
])
def test_tests_without_spread_or_without_a_group_give_no_p_value(spark, rows):
    users = users_frame(spark, rows)
    assert op.welch_ttest(users).first().p_value is None
    assert op.t_test(users, equal_var=True).first().p_value is None


@pytest.mark.parametrize("equal_var", [False, True])
def test_constant_groups_with_different_means(spark, equal_var):
    low, high = [(i, 1, 1, 4) for i in range(5)], [(10 + i, 2, 1, 2) for i in range(4)]
    row = op.t_test(users_frame(spark, low + high), equal_var=equal_var).first()
    assert (row.t, row.p_value) == (-math.inf, 0.0)
    turned = op.t_test(users_frame(spark, low + high), groups=(2, 1), equal_var=equal_var).first()
    assert (turned.t, turned.p_value) == (math.inf, 0.0)


def test_mann_whitney_sums_are_exact(spark):
    """Rank sums beyond 2 ** 53 halves: many ties stand for many users."""
    from pyspark.sql import functions as F

    users = spark.range(4_000_000).select(
        F.col("id").alias("user_id"), (1 + F.col("id") % 2).cast("int").alias("exp_group"), (F.col("id") % 1000 / 7.0).alias("ctr"))
    rows = {op.mann_whitney(users, ranges=r).first().u1 for r in (1, 16, 256, 1000)}
    # Per value 4,000 users, all of one group: even values are group 1, odd ones group 2.
    expected = 4000 * 4000 * sum(range(500))
    assert rows == {float(expected)}


def test_mann_whitney_of_nothing(spark):
    row = op.mann_whitney(users_frame(spark, [])).first()
    assert (row.n1, row.n2, row.p_value) == (0, 0, None)
