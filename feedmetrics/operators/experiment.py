"""Experiment metrics: pooled, smoothed and bucketed click-through rates, and histograms."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bucket_of, in_days, ratio
from .feed import likes, user_ctr, views

__all__ = ["bucket_ctr", "group_ctr", "group_summary", "histogram", "pooled_ctr", "smoothed_ctr", "user_ctr"]


def group_ctr(
    feed: DataFrame, start: dt.date | str, end: dt.date | str, groups: tuple[int, ...] = (1, 2)
) -> DataFrame:
    """CTR of all likes and views of a group, straight from the events (one row per group)."""
    return (
        in_days(feed, start, end)
        .where(F.col("exp_group").isin(*groups))
        .groupBy("exp_group")
        .agg(ratio(likes(), views()).alias("global_ctr"))
    )


def pooled_ctr(users: DataFrame) -> DataFrame:
    """The same from per-user likes and views."""
    return users.groupBy("exp_group").agg(
        ratio(F.sum("likes"), F.sum("views")).alias("global_ctr")
    )


def smoothed_ctr(users: DataFrame, alpha: float = 5) -> DataFrame:
    """Adds the group's CTR and each user's CTR pulled towards it by ``alpha`` views.

    ``users`` is a ``user_ctr`` result, whose group filter bounds the broadcast side: one row per
    requested group. Unlike a window over ``exp_group`` this keeps the users of a group spread
    over all tasks.
    """
    return users.join(F.broadcast(pooled_ctr(users)), "exp_group").select(
        "user_id",
        "exp_group",
        "ctr",
        "global_ctr",
        "likes",
        "views",
        ((F.col("likes") + F.lit(float(alpha)) * F.col("global_ctr")) / (F.col("views") + F.lit(float(alpha))))
        .alias("smoothed_ctr"),
    )


def group_summary(smoothed: DataFrame) -> DataFrame:
    """Pooled CTR and mean per-user CTR per group."""
    return smoothed.groupBy("exp_group").agg(
        F.avg("global_ctr").alias("global_ctr"), F.avg("ctr").alias("mean_ctr_by_user")
    )


def bucket_ctr(users: DataFrame, n_buckets: int = 50, portable: bool = True) -> DataFrame:
    """Pooled CTR per group and hash bucket of users; empty buckets have no row."""
    return (
        users.groupBy("exp_group", bucket_of(F.col("user_id"), n_buckets, portable).alias("bucket"))
        .agg(ratio(F.sum("likes"), F.sum("views")).alias("bucket_ctr"))
    )


def histogram(
    df: DataFrame,
    column: str,
    by: str | None = None,
    bins: int = 20,
    bounds: tuple[float, float] | None = None,
) -> DataFrame:
    """Counts per equal-width bin: (by,) bin_lo, bin_hi, n. Empty bins have no row.

    Groups share the edges, which run from minimum to maximum unless ``bounds`` fixes them. The
    extremes come from a scalar subquery, so nothing is brought to the driver; the last bin
    includes its upper edge. Values below or above ``bounds`` are counted in bins that are open on
    that side (``bin_lo`` or ``bin_hi`` NULL), NaN in a bin of its own (both edges NaN): the counts add
    up to the rows whose value is not NULL.
    """
    values = df.where(F.col(column).isNotNull()).withColumn("value", F.col(column).cast("double"))
    if bounds is None:
        numbers = F.when(~F.isnan("value"), F.col("value"))
        extremes = values.agg(F.struct(F.min(numbers).alias("lo"), F.max(numbers).alias("hi"))).scalar()
        values = values.withColumn("edges", extremes)
        lo, hi = F.col("edges.lo"), F.col("edges.hi")
    else:
        lo, hi = F.lit(float(bounds[0])), F.lit(float(bounds[1]))
    width = (hi - lo) / F.lit(float(bins))
    position = F.floor((F.col("value") - lo) / F.nullif(width, F.lit(0.0)))
    nan, below, above = F.lit(bins + 1), F.lit(-1), F.lit(bins)
    binned = values.select(
        *([F.col(by)] if by else []),
        F.when(F.isnan("value"), nan)
        .when(F.col("value") < lo, below)
        .when(F.col("value") > hi, above)
        .otherwise(F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1))).alias("bin"),
        lo.alias("lo"),
        hi.alias("hi"),
        width.alias("width"),
    )
    keys = ([by] if by else []) + ["bin", "lo", "hi", "width"]
    bin_, inside = F.col("bin"), F.col("bin").between(0, bins - 1)

    def edge(number, open_bin, closed_bin, closed_edge):
        return (
            F.when(inside, F.col("lo") + number * F.col("width"))
            .when(bin_ == closed_bin, F.col(closed_edge))
            .when(bin_ != open_bin, F.lit(float("nan")))
        )

    return (
        binned.groupBy(*keys)
        .agg(F.count("*").alias("n"))
        .select(
            *([by] if by else []),
            edge(bin_, below, above, "hi").alias("bin_lo"),
            edge(bin_ + 1, above, below, "lo").alias("bin_hi"),
            "n",
        )
    )
