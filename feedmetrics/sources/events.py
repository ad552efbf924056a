"""Event tables: explicit schemas, the reader, and the feed/messenger views over raw events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

FEED_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("post_id", T.LongType()),
    T.StructField("action", T.StringType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("exp_group", T.IntegerType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()),
])

MESSAGE_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("reciever_id", T.LongType()),
    T.StructField("time", T.TimestampNTZType()),
    T.StructField("gender", T.IntegerType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("os", T.StringType()),
])


def read_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType = EVENTS_SCHEMA,
    fmt: str = "parquet",
    **options: str,
) -> DataFrame:
    """Scan an event table with a fixed schema (no inference pass over the files).

    ``fmt`` is any Spark source that reads files from a path. The operators need only the columns of
    the schema, so a frame from any other reader serves as well.
    """
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


# User attributes of the raw events: fixed functions of the user id.
_PROFILE = [
    "cast(user_id % 2 as int) as gender",
    "cast(18 + user_id % 3 as int) as age",
    "case when user_id % 4 < 2 then 'iOS' else 'Android' end as os",
]
_K = "cast(get_json_object(props, '$.k') as bigint)"


def _id(number: str, sparse_users: bool) -> str:
    """``sparse_users`` spreads each user over 100 ids.

    Users of the plain view are active nearly every week; the sparse ones come and go, which the
    new/gone user metrics need.
    """
    return f"({number}) * 100 + {_K}" if sparse_users else number


def feed_actions(events: DataFrame, sparse_users: bool = False) -> DataFrame:
    """Likes and views of posts, one row per action (columns of ``FEED_SCHEMA``)."""
    return events.where("event_type in ('click', 'view')").selectExpr(
        f"{_id('user_id', sparse_users)} as user_id",
        "event_id div 3 as post_id",
        "case when event_type = 'click' then 'like' else 'view' end as action",
        "ts as time",
        "cast(user_id % 5 as int) as exp_group",
        *_PROFILE,
    )


def message_actions(events: DataFrame, sparse_users: bool = False) -> DataFrame:
    """Sent messages, one row per message; the profile columns describe the sender."""
    receiver = f"(user_id div 10) * 10 + {_K} % 10"
    return events.where("event_type = 'purchase'").selectExpr(
        f"{_id('user_id', sparse_users)} as user_id",
        f"{_id(receiver, sparse_users)} as reciever_id",
        "ts as time",
        *_PROFILE,
    )
