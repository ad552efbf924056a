"""Feed metrics: audience, likes, views and click-through rate per day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, by_day, day_of, in_days, last_days, ratio

DAY_FORMAT = "yyyy-MM-dd"


def likes() -> Column:
    return F.expr("count_if(action = 'like')")


def views() -> Column:
    return F.expr("count_if(action = 'view')")


def _metrics_per_day(feed: DataFrame) -> DataFrame:
    # One distinct only, so the plan first merges rows per (day, user) on the map side and no
    # single task ever sees all users of a day.
    return (
        feed.groupBy(day_of().alias("day"))
        .agg(
            F.count_distinct("user_id").alias("DAU"),
            likes().alias("Likes"),
            views().alias("Views"),
        )
        .withColumn("CTR", F.bround(ratio(F.col("Likes"), F.col("Views")), 3))
    )


def feed_metrics_yesterday(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """DAU, Likes, Views, CTR of the day before ``as_of``; no row if that day is empty."""
    return _metrics_per_day(last_days(feed, as_of, 1)).drop("day")


def feed_metrics_daily(feed: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """The same per day of the report window; ``day`` is text, as charts label it."""
    per_day = _metrics_per_day(last_days(feed, as_of, days))
    return by_day(per_day.withColumn("day", F.date_format("day", DAY_FORMAT)), "day")


def period_bounds(feed: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """First and last day with activity in the report window, as text."""
    return last_days(feed, as_of, days).agg(
        F.date_format(F.min("time"), DAY_FORMAT).alias("start_period"),
        F.date_format(F.max("time"), DAY_FORMAT).alias("end_period"),
    )


def feed_report_metrics(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Yesterday's feed metrics as (report_date, metric, value) rows."""
    names = ["DAU", "Likes", "Views", "CTR"]
    return (
        feed_metrics_yesterday(feed, as_of)
        .select(
            F.lit(as_date(as_of)).alias("report_date"),
            *[F.col(n).cast("double").alias(n) for n in names],
        )
        .unpivot(["report_date"], names, "metric", "value")
    )


def user_ctr(
    feed: DataFrame,
    start: dt.date | str,
    end: dt.date | str,
    groups: tuple[int, ...] = (1, 2),
) -> DataFrame:
    """Per-user likes, views and CTR in the days ``start`` to ``end`` for some experiment groups.

    CTR is NULL for users without views; the tests leave those users out.
    """
    return (
        in_days(feed, start, end)
        .where(F.col("exp_group").isin(*groups))
        .groupBy("user_id", "exp_group")
        .agg(likes().alias("likes"), views().alias("views"))
        .withColumn("ctr", ratio(F.col("likes"), F.col("views")))
        .select("user_id", "exp_group", "ctr", "likes", "views")
    )
