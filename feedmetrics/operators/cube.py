"""The daily activity cube (user x demographics) and its rollups per dimension.

Outer joins of zero-filled measures are written as union + sum: sides that are unique on the key
give the same rows, NULL keys group together instead of failing to match, and every shuffle is
preceded by a partial aggregate, so a user with a third of the traffic costs one row per task.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import as_date, day_of, in_days, last_days
from .feed import likes, views
from .intime import attributes_in_time

DEMOGRAPHICS = ["gender", "age", "os"]
CUBE_KEYS = ["day", "user_id", *DEMOGRAPHICS]
MESSAGE_MEASURES = ["messages_sent", "messages_received", "users_sent", "users_received"]
MEASURES = ["views", "likes", "messages_received", "messages_sent", "users_received", "users_sent"]
DIMENSIONS = ("os", "gender", "age")


def _feed_measures(strict: bool) -> list:
    """``strict`` counts rows for both measures (counting a comparison counts non-nulls)."""
    if strict:
        return [F.count("*").alias("likes"), F.count("*").alias("views")]
    return [likes().alias("likes"), views().alias("views")]


def _yesterday(events: DataFrame, as_of: dt.date | str) -> DataFrame:
    return last_days(events, as_of, 1).withColumn("day", day_of())


def _of_days(events: DataFrame, days: Sequence[dt.date]) -> DataFrame:
    """Events of some days; their range reaches the scan, the days between them are left out after it."""
    rows = in_days(events, min(days), max(days)).withColumn("day", day_of())
    whole = (max(days) - min(days)).days + 1 == len(set(days))
    return rows if whole else rows.where(F.col("day").isin(sorted(set(days))))


def feed_cube(feed: DataFrame, as_of: dt.date | str, strict: bool = False) -> DataFrame:
    """Likes and views of yesterday per user and demographics."""
    return _yesterday(feed, as_of).groupBy(*CUBE_KEYS).agg(*_feed_measures(strict))


def messages_sent(msg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Messages of yesterday per sender and demographics."""
    return _yesterday(msg, as_of).groupBy(*CUBE_KEYS).agg(F.count("*").alias("messages_sent"))


def messages_received(msg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Messages of yesterday per receiver, keyed by the demographics stored with the message."""
    return (
        _yesterday(msg, as_of).withColumn("user_id", F.col("reciever_id"))
        .groupBy(*CUBE_KEYS).agg(F.count("*").alias("messages_received"))
    )


def _pairs(msg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Messages per sender, receiver and demographics: all four message measures follow from it."""
    return _pairs_of(_yesterday(msg, as_of))


def _pairs_of(dated: DataFrame) -> DataFrame:
    return dated.groupBy("day", "user_id", "reciever_id", *DEMOGRAPHICS).agg(F.count("*").alias("messages"))


def users_sent(msg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Distinct receivers per sender and demographics."""
    return _pairs(msg, as_of).groupBy(*CUBE_KEYS).agg(F.count("*").alias("users_sent"))


def users_received(msg: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Distinct senders per receiver and demographics."""
    return (
        _pairs(msg, as_of).withColumn("user_id", F.col("reciever_id"))
        .groupBy(*CUBE_KEYS).agg(F.count("*").alias("users_received"))
    )


def received_by(msg: DataFrame, as_of: dt.date | str, demographics: DataFrame) -> DataFrame:
    """Messages and distinct senders of yesterday per receiver, keyed by the receiver's own demographics.

    ``demographics`` holds one row per ``user_id``; a second one raises, as it would count messages
    twice. Receivers without one keep NULL attributes. Messages are summed to one row per receiver
    before the join, so a receiver with a third of the traffic is one row there.

    With a ``time`` column it holds the attributes of a user from that time on, in any number of rows, and
    every message counts for those its receiver had when it was sent (see ``attributes_in_time``).
    """
    return _received_by(_yesterday(msg, as_of), demographics)


def _received_by(dated: DataFrame, demographics: DataFrame) -> DataFrame:
    if "time" in demographics.columns:
        known = attributes_in_time(
            dated.select("day", "time", F.col("user_id").alias("sender"), F.col("reciever_id").alias("user_id")),
            demographics, DEMOGRAPHICS)
        keys = ["day", "user_id", *DEMOGRAPHICS]
        return known.groupBy(*keys, "sender").agg(F.count("*").alias("messages")).groupBy(*keys).agg(
            F.sum("messages").alias("messages_received"), F.count("*").alias("users_received"))
    per_receiver = (
        _pairs_of(dated)
        .groupBy("day", "user_id", "reciever_id").agg(F.sum("messages").alias("messages"))
        .groupBy("day", F.col("reciever_id").alias("user_id"))
        .agg(F.sum("messages").alias("messages_received"), F.count("*").alias("users_received"))
    )
    repeated = F.concat(F.lit("more than one row of demographics for user "), F.col("user_id").cast("string"))
    kinds = {f.name: f.dataType for f in demographics.schema}
    people = (
        demographics.groupBy("user_id")
        .agg(F.count("*").alias("rows"), *[F.first(c).alias(c) for c in DEMOGRAPHICS])
        .select("user_id", *[
            F.when(F.col("rows") > 1, F.raise_error(repeated).cast(kinds[c])).otherwise(F.col(c)).alias(c) for c in DEMOGRAPHICS])
    )
    return per_receiver.join(people, "user_id", "left")


def message_cube(
    msg: DataFrame,
    as_of: dt.date | str,
    strict: bool = False,
    demographics: DataFrame | None = None,
) -> DataFrame:
    """Sent and received messages and partners of yesterday per user and demographics.

    By default every sender and receiver appears. ``strict`` keeps only rows with a sender side
    and ``user_id <> 0``: that is what remains when the keys of an outer join are read from its
    left side and unmatched keys are 0. Received messages are keyed by the demographics stored
    with the message unless ``demographics`` gives the receivers' own.
    """
    return _message_cube(_yesterday(msg, as_of), strict, demographics)


def _message_cube(dated: DataFrame, strict: bool, demographics: DataFrame | None) -> DataFrame:
    zero = F.lit(0).cast("bigint")

    def sent_side(n, partners):
        return F.struct(
            F.col("user_id"), n.alias("messages_sent"), zero.alias("messages_received"),
            partners.alias("users_sent"), zero.alias("users_received"),
        )

    def received_side(n, partners):
        return F.struct(
            F.col("reciever_id").alias("user_id"), zero.alias("messages_sent"), n.alias("messages_received"),
            zero.alias("users_sent"), partners.alias("users_received"),
        )

    n, one = F.col("messages"), F.lit(1).cast("bigint")
    pairs = _pairs_of(dated)
    if demographics is None:
        sides = pairs.select("day", *DEMOGRAPHICS, F.inline(F.array(sent_side(n, one), received_side(n, one))))
    else:
        sides = pairs.select("day", *DEMOGRAPHICS, F.inline(F.array(sent_side(n, one)))).unionByName(
            _received_by(dated, demographics).withColumns({"messages_sent": zero, "users_sent": zero}))
    cube = sides.groupBy(*CUBE_KEYS).agg(*[F.sum(m).alias(m) for m in MESSAGE_MEASURES])
    if strict:
        cube = cube.where((F.col("messages_sent") > 0) & (F.col("user_id") != 0))
    return cube


def _sums() -> list:
    return [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in MEASURES]


def activity_cube(feed_part: DataFrame, message_part: DataFrame) -> DataFrame:
    """Feed and message measures of a user side by side, 0 where one is missing."""
    return (
        feed_part.unionByName(message_part, allowMissingColumns=True).groupBy(*CUBE_KEYS).agg(*_sums())
    )


def rollup_dimension(cube: DataFrame, dimension: str) -> DataFrame:
    """Sums of all measures by one dimension, in long format."""
    return (
        cube.groupBy(F.col("day").alias("event_date"), F.col(dimension).alias("dimension_value"))
        .agg(*_sums())
        .select(
            "event_date",
            F.lit(dimension).alias("dimension"),
            F.col("dimension_value").cast("string").alias("dimension_value"),
            *MEASURES,
        )
    )


def dimension_rollup(cube: DataFrame, dimensions: tuple[str, ...] = DIMENSIONS) -> DataFrame:
    """``rollup_dimension`` of every dimension, from one pass over ``cube``.

    Rows are first summed per combination of the dimensions: the grouping sets then expand a few
    hundred rows instead of every user.
    """
    combos = cube.groupBy("day", *dimensions).agg(*_sums())
    label, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in dimensions:
        chosen = F.grouping(name) == 0
        label = F.when(chosen, F.lit(name)).otherwise(label)
        value = F.when(chosen, F.col(name).cast("string")).otherwise(value)
    sets = [[F.col("day"), F.col(name)] for name in dimensions]
    return (
        combos.groupingSets(sets, "day", *dimensions)
        .agg(label.alias("dimension"), value.alias("dimension_value"), *_sums())
        .select(F.col("day").alias("event_date"), "dimension", "dimension_value", *MEASURES)
    )


def daily_rollup(
    feed: DataFrame,
    msg: DataFrame,
    as_of: dt.date | str,
    strict: bool = False,
    demographics: DataFrame | None = None,
) -> DataFrame:
    """Yesterday's per-dimension table straight from the events.

    Equals ``dimension_rollup(activity_cube(feed_cube, message_cube))``. Sums over users do not
    need the users: feed rows are summed by demographics right away, and messages only per
    (sender, receiver) to count partners. The strict form drops rows by user, so its message side
    still goes through the per-user cube. ``demographics`` is as in ``message_cube``: without it
    received messages follow the sender's attributes, which the message carries.
    """
    return _rollup(_yesterday(feed, as_of), _yesterday(msg, as_of), strict, demographics)


def rollup_of_days(
    feed: DataFrame,
    msg: DataFrame,
    days: Sequence[dt.date | str],
    strict: bool = False,
    demographics: DataFrame | None = None,
) -> DataFrame:
    """``daily_rollup`` of several days in one plan: the rows each of them has by itself."""
    wanted = [as_date(d) for d in days]
    return _rollup(_of_days(feed, wanted), _of_days(msg, wanted), strict, demographics)


def _rollup(feed: DataFrame, msg: DataFrame, strict: bool, demographics: DataFrame | None) -> DataFrame:
    keys = ["day", *DEMOGRAPHICS]
    feed_part = feed.groupBy(*keys).agg(*_feed_measures(strict))
    if strict:
        message_part = _message_cube(msg, True, demographics).drop("user_id")
        return dimension_rollup(feed_part.unionByName(message_part, allowMissingColumns=True))
    messages, partners = F.sum("messages"), F.count("*")
    sent = [messages.alias("messages_sent"), partners.alias("users_sent")]
    by_sender = _pairs_of(msg).groupBy(*keys)
    if demographics is None:
        parts = [by_sender.agg(*sent, messages.alias("messages_received"), partners.alias("users_received"))]
    else:
        received = [F.sum(c).alias(c) for c in ("messages_received", "users_received")]
        parts = [by_sender.agg(*sent), _received_by(msg, demographics).groupBy(*keys).agg(*received)]
    for part in parts:
        feed_part = feed_part.unionByName(part, allowMissingColumns=True)
    return dimension_rollup(feed_part)
