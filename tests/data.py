"""Views over the test tables and small hand-made frames."""

from __future__ import annotations

import datetime as dt

from feedmetrics import sources

AS_OF = "2024-01-31"
WINDOW = ("2024-01-08", "2024-01-14")


def feed_and_messages(spark, sf, sparse=False):
    events = sources.read_events(spark, f"/root/testdata/{sf}/events.parquet")
    return sources.feed_actions(events, sparse), sources.message_actions(events, sparse)


def at(day: str, hour: int = 12) -> dt.datetime:
    return dt.datetime.combine(dt.date.fromisoformat(day), dt.time(hour))


def feed_frame(spark, rows):
    """(user, post, action, day[, group]) with fixed demographics."""
    full = [(r[0], r[1], r[2], at(r[3]), r[4] if len(r) > 4 else 1, 0, 20, "iOS") for r in rows]
    return spark.createDataFrame(full, sources.FEED_SCHEMA)


def message_frame(spark, rows):
    """(sender, receiver, day[, gender, age, os])"""
    full = [(r[0], r[1], at(r[2]), *(r[3:] or (0, 20, "iOS"))) for r in rows]
    return spark.createDataFrame(full, sources.MESSAGE_SCHEMA)


def users_frame(spark, rows):
    """(user, group, likes, views) with the CTR derived."""
    full = [(u, g, likes / views if views else None, likes, views) for u, g, likes, views in rows]
    return spark.createDataFrame(full, "user_id long, exp_group int, ctr double, likes long, views long")
