"""Whole analyses of an experiment: every A/B test in one table, and the A/A verdict."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.experiment import bucket_ctr, smoothed_ctr, user_ctr
from ..operators.resample import aa_fpr, aa_pvalues, aa_samples, bootstrap_diff, poisson_bootstrap
from ..operators.stats import MOMENT_NAMES, mann_whitney, moments, welch_ttest, with_t_test
from .checkpoint import materialize


def experiment_report(
    feed: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    groups: tuple = (1, 2),
    alpha: float = 0.05,
    smoothing: float = 5,
    n_buckets: int = 50,
    n_boot: int = 10_000,
    seed: int = 42,
    bootstrap_method: str = "cells",
    users: DataFrame | None = None,
) -> DataFrame:
    """All tests of the CTR difference as (method, statistic, p_value, reject) rows.

    The events are scanned once, into a per-user table that all tests read; pass ``users`` to keep that
    table in your own hands (see ``materialized``). The t-tests of a user's own and smoothed CTR share
    one pass over it, the bucket tests one small table. The bootstrap has no p-value: it rejects when
    its interval for ctr2 - ctr1 does not touch 0.
    """
    if users is None:
        users = materialize(user_ctr(feed, start, end, groups))
    buckets = materialize(bucket_ctr(users, n_buckets))
    metrics = ("ctr", "smoothed_ctr")
    both = smoothed_ctr(users, smoothing).agg(*[
        F.struct(*moments(m, groups)).alias(m) for m in metrics]).select(F.inline(F.array(*[
            F.struct(F.lit(f"welch_{m}").alias("method"), *[F.col(f"{m}.{c}").alias(c) for c in MOMENT_NAMES]) for m in metrics])))

    def row(test: DataFrame, method: Column, statistic: str) -> DataFrame:
        return test.select(
            method.alias("method"),
            F.col(statistic).alias("statistic"),
            F.col("p_value"),
            (F.col("p_value") < alpha).alias("reject"),
        )

    boot = bootstrap_diff(poisson_bootstrap(users, n_boot, groups, seed, bootstrap_method), alpha)
    no_p: Column = F.lit(None).cast("double")
    rows = [
        row(with_t_test(both, equal_var=False), F.col("method"), "t"),
        row(mann_whitney(users, "ctr", groups), F.lit("mann_whitney_ctr"), "u1"),
        row(welch_ttest(buckets, "bucket_ctr", groups), F.lit("welch_bucket_ctr"), "t"),
        row(mann_whitney(buckets, "bucket_ctr", groups), F.lit("mann_whitney_bucket_ctr"), "u1"),
        boot.select(
            F.lit("poisson_bootstrap").alias("method"),
            F.col("mean_diff").alias("statistic"),
            no_p.alias("p_value"),
            (~F.col("touches_zero")).alias("reject"),
        ),
    ]
    report = rows[0]
    for other in rows[1:]:
        report = report.unionByName(other)
    return report


def aa_check(
    feed: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    groups: tuple = (2, 3),
    sample_size: int = 500,
    n_exp: int = 10_000,
    alpha: float = 0.05,
    seed: int = 42,
) -> DataFrame:
    """False positive rate of the splitter on repeated samples: n_exp, fpr, split_ok."""
    users = materialize(user_ctr(feed, start, end, groups))
    samples = aa_samples(users, "ctr", groups, sample_size, n_exp, seed)
    return aa_fpr(aa_pvalues(samples, groups), alpha)
