"""Distinct users of any window from one small sketch per day, within a known error.

A day's sketch is some kilobytes whatever its users are. Sketches of days are merged by a maximum of their
registers, so a user who comes on many days counts once, days may come in any order and more than once,
and no window reads the events again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, by_day, day_of, in_days, ratio
from .feed import likes, views

LG_REGISTERS = 12


def relative_error(lg_registers: int = LG_REGISTERS) -> float:
    """One standard error of an estimate as a share of the count; small counts are exact or nearly so."""
    return 1.04 / 2 ** (lg_registers / 2)


def feed_sketches(
    feed: DataFrame, start: dt.date | str, end: dt.date | str, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """``day, users, likes, views`` of the days ``start`` to ``end``; ``users`` is a sketch of those active.

    Sketches are built per task before anything is shuffled: a row per day and task. Rows without a
    user add to likes and views only. ``lg_registers`` is from 4 to 21 and must be the same for all days.
    """
    return in_days(feed, start, end).groupBy(day_of().alias("day")).agg(
        F.hll_sketch_agg("user_id", lg_registers).alias("users"), likes().alias("likes"), views().alias("views"))


def merge_sketches(days: DataFrame, later: DataFrame) -> DataFrame:
    """Days of both tables; a day in both is that of ``later``: a day made again takes the place of the old one."""
    marked = days.withColumn("__age", F.lit(0)).unionByName(later.withColumn("__age", F.lit(1)))
    return marked.groupBy("day").agg(
        *[F.max_by(c, "__age").alias(c) for c in days.columns if c != "day"])


def feed_metrics_of_days(sketches: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """``feed_metrics_daily`` from day rows: day, DAU (estimated), Likes, Views, CTR."""
    today = as_date(as_of)
    rows = sketches.where(F.col("day").between(F.lit(today - dt.timedelta(days=days)), F.lit(today - dt.timedelta(days=1))))
    return by_day(rows.select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.hll_sketch_estimate("users").alias("DAU"),
        F.col("likes").alias("Likes"), F.col("views").alias("Views"),
        F.bround(ratio(F.col("likes"), F.col("views")), 3).alias("CTR")), "day")


def feed_metrics_of_windows(sketches: DataFrame, as_of: dt.date | str, windows: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """Users (estimated), likes, views and CTR of the last 1, 7, … days before ``as_of``: a row per window.

    Windows share one pass over the day rows. A window without activity has no row.
    """
    today = as_date(as_of)
    longest = today - dt.timedelta(days=max(windows))
    rows = sketches.where((F.col("day") >= F.lit(longest)) & (F.col("day") < F.lit(today)))
    age = F.date_diff(F.lit(today), "day")
    of_window = F.filter(F.array(*[F.lit(w) for w in sorted(set(windows))]), lambda w: w >= age)
    return rows.withColumn("days", F.explode(of_window)).groupBy("days").agg(
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("users"), F.sum("likes").alias("likes"), F.sum("views").alias("views")
    ).withColumn("ctr", F.bround(ratio(F.col("likes"), F.col("views")), 3))


def presence_sketches(
    feed: DataFrame, msg: DataFrame, start: dt.date | str, end: dt.date | str, lg_registers: int = LG_REGISTERS
) -> DataFrame:
    """``day, feed, messenger``: sketches of the users of either service; NULL where a day has none."""
    def of(events: DataFrame, name: str) -> DataFrame:
        return in_days(events, start, end).groupBy(day_of().alias("day")).agg(F.hll_sketch_agg("user_id", lg_registers).alias(name))

    both = of(feed, "feed").unionByName(of(msg, "messenger"), allowMissingColumns=True)
    return both.groupBy("day").agg(F.max("feed").alias("feed"), F.max("messenger").alias("messenger"))


def service_usage_of_windows(presence: DataFrame, as_of: dt.date | str, windows: tuple[int, ...] = (1, 7, 30)) -> DataFrame:
    """Users of the feed, of the messenger, of both and of either in windows of days, estimated from sketches.

    ``both`` is feed + messenger - either, so its error is up to that of the three together.
    """
    today = as_date(as_of)
    age = F.date_diff(F.lit(today), "day")
    of_window = F.filter(F.array(*[F.lit(w) for w in sorted(set(windows))]), lambda w: w >= age)
    rows = presence.where(F.col("day") < F.lit(today)).withColumn("days", F.explode(of_window))
    merged = rows.groupBy("days").agg(F.hll_union_agg("feed").alias("feed"), F.hll_union_agg("messenger").alias("messenger"))
    users = {c: F.coalesce(F.hll_sketch_estimate(c), F.lit(0)) for c in ("feed", "messenger")}
    either = F.coalesce(F.hll_sketch_estimate(F.hll_union("feed", "messenger")), F.greatest(*users.values()))
    return merged.select("days", *[u.alias(c) for c, u in users.items()], either.alias("either")).withColumn(
        "both", F.greatest(F.col("feed") + F.col("messenger") - F.col("either"), F.lit(0)))
