"""Days of presence as bits: a user's use of both services over 64 days in one narrow row.

Exact, unlike a sketch, and mergeable: a day more, or the same day again, is an OR. Any report over days
tests bits of these rows and never brings user and day together again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, by_day, day_of
from .app import BOTH, FEED, MESSENGER, SERVICES

SPAN = 64               # days of a row: the bits of a bigint
EPOCH = dt.date(1970, 1, 1)


def _number(day: Column) -> Column:
    return F.date_diff(day, F.lit(EPOCH))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), number.cast("int"))


def presence_bitmaps(feed: DataFrame, msg: DataFrame) -> DataFrame:
    """``user_id, span, feed, messenger``: for each user and span of 64 days, a bit per day with activity.

    Span s holds the days from 64 s on after 1970-01-01, bit b the day 64 s + b. Rows without a time are
    left out; NULL users share one row per span.
    """
    def bits(events: DataFrame, name: str) -> DataFrame:
        number = _number(day_of())
        return events.where("time IS NOT NULL").select(
            "user_id", F.floor(number / F.lit(float(SPAN))).alias("span"), _bit(F.pmod(number, F.lit(SPAN))).alias(name))

    return merge_presence(bits(feed, "feed").unionByName(bits(msg, "messenger"), allowMissingColumns=True))


def merge_presence(*tables: DataFrame) -> DataFrame:
    """The OR of tables of ``presence_bitmaps``: days in any order, and more than once, change nothing."""
    rows = tables[0]
    for other in tables[1:]:
        rows = rows.unionByName(other)
    zero = F.lit(0).cast("bigint")
    return rows.groupBy("user_id", "span").agg(
        *[F.coalesce(F.bit_or(c), zero).alias(c) for c in ("feed", "messenger")])


def service_usage_of(
    presence: DataFrame, as_of: dt.date | str, days: int = 7, labels: dict[str, str] | None = None, ordered: bool = True,
) -> DataFrame:
    """``service_usage_daily`` from bitmaps that cover the ``days`` before ``as_of``.

    Rows of other spans are not read, and only counts per day are shuffled: no user meets another row.
    """
    today = as_date(as_of)
    first, last = (today - dt.timedelta(days=d) - EPOCH for d in (days, 1))
    wanted = F.array(*[F.lit(n) for n in range(first.days, last.days + 1)])
    rows = presence.where(F.col("span").between(first.days // SPAN, last.days // SPAN))
    number = F.explode(F.filter(wanted, lambda n: F.floor(n / F.lit(float(SPAN))) == F.col("span"))).alias("number")
    seen = rows.select("user_id", "feed", "messenger", number).withColumn("bit", _bit(F.pmod("number", F.lit(SPAN))))
    flags = [(F.col(c).bitwiseAND(F.col("bit")) != 0) for c in ("feed", "messenger")]
    name = {**{s: s for s in SERVICES}, **(labels or {})}
    service = F.when(flags[0] & flags[1], name[BOTH]).when(flags[0], name[FEED]).when(flags[1], name[MESSENGER])
    usage = (
        seen.select("user_id", F.date_add(F.lit(EPOCH), F.col("number")).alias("day"), service.alias("using_service"))
        .where("using_service IS NOT NULL")
        .groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "using_service").agg(F.count("user_id").alias("cnt_users"))
    )
    return by_day(usage, "day", "using_service") if ordered else usage


def active_days(presence: DataFrame, as_of: dt.date | str, days: int = 28) -> DataFrame:
    """How many users were active on 1, 2, … of the ``days`` before ``as_of``: n_days, users."""
    today = as_date(as_of)
    first, last = (today - dt.timedelta(days=d) - EPOCH for d in (days, 1))
    count = None
    for span in range(first.days // SPAN, last.days // SPAN + 1):
        low, high = max(first.days - span * SPAN, 0), min(last.days - span * SPAN, SPAN - 1)
        mask = sum(1 << b for b in range(low, high + 1))
        mask = mask - (1 << SPAN) if mask >= 1 << (SPAN - 1) else mask
        own = F.when(F.col("span") == span, F.bit_count(F.col("feed").bitwiseOR(F.col("messenger")).bitwiseAND(F.lit(mask))))
        count = own if count is None else F.coalesce(count, own)
    rows = presence.where(F.col("span").between(first.days // SPAN, last.days // SPAN)).select("user_id", count.alias("n"))
    return rows.groupBy("user_id").agg(F.sum("n").alias("n_days")).where("n_days > 0").groupBy("n_days").agg(F.count("*").alias("users"))
