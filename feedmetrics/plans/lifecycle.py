"""Per-user and per-post tables kept from day to day, in buckets, so that their history stays in place.

A day's rows are few beside those of all days before. The kept table lies in buckets by its key; the day's
rows are dealt into as many, and each bucket joins its own: only the day is shuffled, and every bucket
is written by the task that read it. The new version is published in one step.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.app import lifespan_of_day, posts_of_day
from ..sources.publish import buckets_of, publish_table

BUCKETS = 64


def store(df: DataFrame, table: str, key: str, buckets: int = BUCKETS) -> None:
    """Keep a table of ``user_lifespan`` or ``posts_first_seen`` in buckets by its key, one file per bucket."""
    publish_table(df.repartition(buckets, key), table, key, buckets)


def extended(
    kept: DataFrame, fresh: DataFrame, key: str, buckets: int, least: tuple[str, ...] = (), greatest: tuple[str, ...] = ()
) -> DataFrame:
    """``kept`` with the rows of ``fresh``: per key the least and greatest of both sides.

    Both hold a key once. ``kept`` comes from a table in ``buckets`` by ``key`` and is not shuffled; of its
    rows only the one with a NULL key, which no join matches, is summed up apart.
    """
    columns = [*least, *greatest]
    known = kept.where(F.col(key).isNotNull()).alias("kept")
    of_day = fresh.where(F.col(key).isNotNull()).repartition(buckets, key).alias("fresh")
    merge = {c: F.least for c in least} | {c: F.greatest for c in greatest}
    joined = known.join(of_day, key, "full").select(
        key, *[merge[c](F.col(f"kept.{c}"), F.col(f"fresh.{c}")).alias(c) for c in columns])
    no_key = kept.select(key, *columns).unionByName(fresh.select(key, *columns)).where(F.col(key).isNull()).groupBy(key).agg(
        *[F.min(c).alias(c) for c in least], *[F.max(c).alias(c) for c in greatest])
    return joined.unionByName(no_key)


def extended_lifespan(spark: SparkSession, table: str, feed: DataFrame, msg: DataFrame, day: dt.date | str) -> DataFrame:
    """The kept lifespans with one more day of activity; of the events only that day is scanned."""
    return extended(
        spark.table(table), lifespan_of_day(feed, msg, day), "user_id", buckets_of(spark, table), ("first_time",), ("last_time",))


def extended_posts(spark: SparkSession, table: str, feed: DataFrame, day: dt.date | str) -> DataFrame:
    """The kept first actions on posts with one more day of events."""
    return extended(spark.table(table), posts_of_day(feed, day), "post_id", buckets_of(spark, table), ("public_time",))


def load_lifespan(feed: DataFrame, msg: DataFrame, day: dt.date | str, table: str, buckets: int = BUCKETS) -> None:
    """Bring the kept lifespans up to ``day``; days may come in any order and more than once.

    The first call makes the table from its day. Readers see the old or the new table, never a part.
    """
    spark = feed.sparkSession
    if not spark.catalog.tableExists(table):
        store(lifespan_of_day(feed, msg, day), table, "user_id", buckets)
    else:
        publish_table(extended_lifespan(spark, table, feed, msg, day), table, "user_id", buckets_of(spark, table))


def load_posts(feed: DataFrame, day: dt.date | str, table: str, buckets: int = BUCKETS) -> None:
    """The same for the first action on every post."""
    spark = feed.sparkSession
    if not spark.catalog.tableExists(table):
        store(posts_of_day(feed, day), table, "post_id", buckets)
    else:
        publish_table(extended_posts(spark, table, feed, day), table, "post_id", buckets_of(spark, table))
