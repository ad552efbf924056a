"""Whole-app metrics: service mix, messages, posts, and users who came or left."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import as_date, before_day, by_day, day_of, in_days, last_days, ratio, since_day

FEED, MESSENGER, BOTH = "feed", "messenger", "feed+messenger"
SERVICES = (FEED, BOTH, MESSENGER)


def daily_presence(events: DataFrame) -> DataFrame:
    """Distinct (user_id, day) pairs."""
    return events.select("user_id", day_of().alias("day")).distinct()


def service_usage_daily(
    feed: DataFrame,
    msg: DataFrame,
    as_of: dt.date | str,
    days: int = 7,
    labels: dict[str, str] | None = None,
    strict: bool = False,
    ordered: bool = True,
) -> DataFrame:
    """Users per day by the services they used that day: feed, messenger, or both.

    The flags of both services meet in one aggregate per (user, day), which equals a full outer
    join of the presences but never pairs rows and pre-aggregates before its shuffle.
    ``strict`` counts all messenger-only users of a day as one, the way an outer join does whose
    unmatched left key falls back to 0. ``labels`` renames the service names. ``ordered`` sorts the
    report; leave it out where the rows are worked on further.
    """
    def flagged(events: DataFrame, in_feed: bool, in_messenger: bool) -> DataFrame:
        return last_days(events, as_of, days).select(
            "user_id",
            day_of().alias("day"),
            F.lit(in_feed).alias("use_feed"),
            F.lit(in_messenger).alias("use_messenger"),
        )

    per_user = (
        flagged(feed, True, False)
        .unionByName(flagged(msg, False, True))
        .groupBy("user_id", "day")
        .agg(F.max("use_feed").alias("use_feed"), F.max("use_messenger").alias("use_messenger"))
    )
    name = {**{s: s for s in SERVICES}, **(labels or {})}
    service = (
        F.when(F.col("use_feed") & ~F.col("use_messenger"), name[FEED])
        .when(~F.col("use_feed") & F.col("use_messenger"), name[MESSENGER])
        .when(F.col("use_feed") & F.col("use_messenger"), name[BOTH])
        .otherwise("error")
    )
    # (user, day) is unique by now, so a plain count is the distinct count.
    users: Column = F.count("user_id")
    if strict:
        users = F.when(F.col("using_service") == name[MESSENGER], F.least(users, F.lit(1))).otherwise(users)
    usage = per_user.groupBy(
        F.date_format("day", "yyyy-MM-dd").alias("day"), service.alias("using_service")
    ).agg(users.alias("cnt_users"))
    return by_day(usage, "day", "using_service") if ordered else usage


def service_usage_share(usage: DataFrame) -> DataFrame:
    """Adds the day's total and each service's share of it (at most one row per day and service)."""
    return usage.withColumn(
        "total", F.sum("cnt_users").over(Window.partitionBy("day"))
    ).withColumn("per", F.bround(ratio(F.col("cnt_users"), F.col("total")), 3))


def service_usage_pivot(
    share: DataFrame, services: tuple[str, ...] = SERVICES, labels: dict[str, str] | None = None
) -> DataFrame:
    """Shares as one row per day and one column per service, ordered by day.

    ``labels`` is the mapping given to ``service_usage_daily``: columns have the names it gave.
    """
    names = [(labels or {}).get(s, s) for s in services]
    return by_day(share.groupBy("day").pivot("using_service", names).agg(F.first("per")), "day")


def messages_sent_daily(msg: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Messages sent per day of the report window."""
    per_day = last_days(msg, as_of, days).groupBy(day_of().alias("day"))
    return by_day(per_day.agg(F.count("user_id").alias("mess_sent")), "day")


def messages_sent_latest(per_day: DataFrame) -> DataFrame:
    """Messages of the last day that has any, 0 if the window is empty."""
    return per_day.agg(F.coalesce(F.max_by("mess_sent", "day"), F.lit(0)).alias("mess_sent"))


def new_posts(feed: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Number of posts first seen yesterday; one row, 0 if there are none.

    Rows from ``as_of`` on cannot change whether a post first appeared yesterday, so the scan
    stops there. It starts with the first event; ``new_posts_from`` needs a table of first days only.
    """
    return new_posts_from(posts_first_seen(feed, as_of), as_of)


def posts_first_seen(feed: DataFrame, until: dt.date | str) -> DataFrame:
    """``post_id, public_time``: the first action on every post, over the days before ``until``."""
    return before_day(feed, until).groupBy("post_id").agg(F.min("time").alias("public_time"))


def posts_of_day(feed: DataFrame, day: dt.date | str) -> DataFrame:
    """``posts_first_seen`` of one day alone."""
    return in_days(feed, day, day).groupBy("post_id").agg(F.min("time").alias("public_time"))


def merge_posts_first_seen(seen: DataFrame, feed: DataFrame, day: dt.date | str) -> DataFrame:
    """``seen`` with one more day of events; only that day is scanned."""
    return seen.unionByName(posts_of_day(feed, day)).groupBy("post_id").agg(F.min("public_time").alias("public_time"))


def new_posts_from(seen: DataFrame, as_of: dt.date | str) -> DataFrame:
    """``new_posts`` from a table of first days that covers the days before ``as_of``."""
    today = as_date(as_of)
    yesterday = today - dt.timedelta(days=1)
    first = F.col("public_time")
    return (
        seen.where((first >= F.lit(yesterday)) & (first < F.lit(today)))
        .agg(F.count("post_id").alias("new_posts"))
        .select(F.lit(yesterday).alias("day"), "new_posts")
    )


def _activity_rows(feed: DataFrame, msg: DataFrame) -> DataFrame:
    """(user_id, time) of every action; senders and receivers come from one scan of the messages."""
    parties = msg.select(F.explode(F.array("user_id", "reciever_id")).alias("user_id"), "time")
    return feed.select("user_id", "time").unionByName(parties)


def all_activity(feed: DataFrame, msg: DataFrame) -> DataFrame:
    """Distinct (user_id, time) over feed actions, sent and received messages."""
    return _activity_rows(feed, msg).distinct()


def user_lifespan(feed: DataFrame, msg: DataFrame, until: dt.date | str | None = None) -> DataFrame:
    """First and last active day per user, from one aggregate over all activity.

    Duplicates cannot change a minimum or maximum, so the union is not made distinct. Without
    ``until`` all rows count, today's partial data included; with it only rows before that day.
    """
    if until is not None:
        feed, msg = before_day(feed, until), before_day(msg, until)
    return _first_and_last(_activity_rows(feed, msg))


def _first_and_last(activity: DataFrame) -> DataFrame:
    return activity.groupBy("user_id").agg(
        F.to_date(F.min("time")).alias("first_time"),
        F.to_date(F.max("time")).alias("last_time"),
    )


def lifespan_of_day(feed: DataFrame, msg: DataFrame, day: dt.date | str) -> DataFrame:
    """``user_lifespan`` of one day alone."""
    return _first_and_last(_activity_rows(in_days(feed, day, day), in_days(msg, day, day)))


def merge_lifespan(lifespan: DataFrame, feed: DataFrame, msg: DataFrame, day: dt.date | str) -> DataFrame:
    """``lifespan`` with one more day of activity; of the events only that day is scanned.

    Days may come in any order and more than once: minimum and maximum do not change.
    """
    return lifespan.unionByName(lifespan_of_day(feed, msg, day)).groupBy("user_id").agg(
        F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"))


def new_users(lifespan: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Users whose first active day is yesterday."""
    yesterday = as_date(as_of) - dt.timedelta(days=1)
    return lifespan.where(F.col("first_time") == F.lit(yesterday)).select("user_id", "first_time")


def new_users_count(lifespan: DataFrame, as_of: dt.date | str) -> DataFrame:
    return new_users(lifespan, as_of).agg(F.count("user_id").alias("new_users"))


def _gone(ref_day: dt.date, days: int) -> Column:
    return F.col("last_time") < F.lit(ref_day - dt.timedelta(days=days))


def gone_users(lifespan: DataFrame, ref_day: dt.date | str, days: int = 7) -> DataFrame:
    """Users whose last active day lies more than ``days`` days before ``ref_day``."""
    return lifespan.where(_gone(as_date(ref_day), days)).select("user_id", "last_time")


def gone_users_delta(lifespan: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Gone users as of yesterday, as of the day before, and the difference, in one pass."""
    yesterday = as_date(as_of) - dt.timedelta(days=1)
    return lifespan.agg(
        F.count_if(_gone(yesterday, days)).alias("gone_yesterday"),
        F.count_if(_gone(yesterday - dt.timedelta(days=1), days)).alias("gone_day_before"),
    ).withColumn("delta", F.col("gone_yesterday") - F.col("gone_day_before"))


def gone_users_delta_recent(feed: DataFrame, msg: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """The ``delta`` of ``gone_users_delta`` from the last days alone.

    Between the day before and yesterday those users are newly gone whose last active day lies
    ``days`` + 1 days before yesterday: nobody else needs to be looked at, and no earlier event.
    """
    last = as_date(as_of) - dt.timedelta(days=days + 2)
    recent = _first_and_last(_activity_rows(since_day(feed, last), since_day(msg, last)))
    return recent.agg(F.count_if(F.col("last_time") == F.lit(last)).alias("delta"))


def app_report_metrics(
    feed: DataFrame,
    msg: DataFrame,
    as_of: dt.date | str,
    lifespan: DataFrame | None = None,
    posts: DataFrame | None = None,
) -> DataFrame:
    """The four numbers of the daily app report as (report_date, metric, value) rows.

    ``lifespan`` and ``posts`` are the per-user and per-post tables kept by ``merge_lifespan`` and
    ``merge_posts_first_seen``, covering the days before ``as_of``. With them the events of the last
    nine days are enough; without them the whole history is scanned.
    """
    day = as_date(as_of)
    yesterday = day - dt.timedelta(days=1)
    new = F.count_if(F.col("first_time") == F.lit(yesterday)).alias("new_users")
    if lifespan is None:
        # New and gone users share one per-user table and one pass over it.
        gone = F.count_if(_gone(yesterday, 7)) - F.count_if(_gone(yesterday - dt.timedelta(days=1), 7))
        users = [user_lifespan(feed, msg).agg(new, gone.alias("gone_users_delta"))]
    else:
        delta = gone_users_delta_recent(feed, msg, as_of).withColumnRenamed("delta", "gone_users_delta")
        users = [lifespan.agg(new), delta]
    seen = posts_first_seen(feed, as_of) if posts is None else posts
    messages = messages_sent_latest(messages_sent_daily(msg, as_of)).select(
        F.col("mess_sent").alias("messages_sent")
    )

    def as_rows(df: DataFrame) -> DataFrame:
        return df.unpivot([], df.columns, "metric", "value")

    rows = as_rows(users[0])
    for part in [*users[1:], new_posts_from(seen, as_of).select("new_posts"), messages]:
        rows = rows.unionByName(as_rows(part))
    return rows.select(F.lit(day).alias("report_date"), "metric", "value")
