"""Feed and app metrics: identities and edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from data import AS_OF, feed_and_messages, feed_frame, message_frame
from feedmetrics import operators as op
from feedmetrics import sources
from feedmetrics.functions import in_days

Y = "2024-01-30"


def test_empty_days(spark):
    feed, msg = feed_frame(spark, []), message_frame(spark, [])
    assert op.feed_metrics_yesterday(feed, AS_OF).count() == 0
    assert op.feed_report_metrics(feed, AS_OF).count() == 0
    assert op.new_posts(feed, AS_OF).first().new_posts == 0
    assert op.messages_sent_latest(op.messages_sent_daily(msg, AS_OF)).first()[0] == 0
    assert tuple(op.period_bounds(feed, AS_OF).first()) == (None, None)
    got = {r.metric: r.value for r in op.app_report_metrics(feed, msg, AS_OF).collect()}
    assert got == {"new_users": 0, "gone_users_delta": 0, "new_posts": 0, "messages_sent": 0}


def test_window_excludes_today_and_the_eighth_day(spark):
    feed = feed_frame(spark, [(1, 1, "like", d) for d in ("2024-01-23", "2024-01-24", Y, AS_OF)])
    assert [r.day for r in op.feed_metrics_daily(feed, AS_OF).collect()] == ["2024-01-24", Y]
    assert tuple(op.period_bounds(feed, AS_OF).first()) == ("2024-01-24", Y)


def test_midnight_belongs_to_the_new_day(spark):
    rows = [(1, 1, "view", dt.datetime(2024, 1, 30), 1, 0, 20, "iOS"),
            (2, 1, "view", dt.datetime(2024, 1, 31), 1, 0, 20, "iOS"),
            (3, 1, "view", dt.datetime(2024, 1, 30, 23, 59, 59, 999999), 1, 0, 20, "iOS")]
    feed = spark.createDataFrame(rows, sources.FEED_SCHEMA)
    assert op.feed_metrics_yesterday(feed, AS_OF).first().DAU == 2


def test_no_views_gives_no_ctr(spark):
    row = op.feed_metrics_yesterday(feed_frame(spark, [(1, 1, "like", Y)]), AS_OF).first()
    assert (row.Likes, row.Views, row.CTR) == (1, 0, None)


def test_half_even_rounding(spark):
    feed = feed_frame(spark, [(1, 1, "like", Y)] + [(1, i, "view", Y) for i in range(16)])
    assert op.feed_metrics_yesterday(feed, AS_OF).first().CTR == 0.062


def usage(spark, **kw):
    feed = feed_frame(spark, [(0, 1, "like", Y), (0, 2, "view", Y), (1, 1, "view", Y)])
    msg = message_frame(spark, [(1, 2, Y), (2, 0, Y), (3, 0, Y), (3, 1, Y)])
    return {r.using_service: r.cnt_users for r in op.service_usage_daily(feed, msg, AS_OF, **kw).collect()}


def test_service_usage_counts_user_zero_and_each_user_once(spark):
    assert usage(spark) == {"feed": 1, "feed+messenger": 1, "messenger": 2}
    assert usage(spark, strict=True) == {"feed": 1, "feed+messenger": 1, "messenger": 1}
    assert usage(spark, labels={"messenger": "chat"}) == {"feed": 1, "feed+messenger": 1, "chat": 2}


def test_shares_of_a_day_add_up(spark):
    share = op.service_usage_share(op.service_usage_daily(*feed_and_messages(spark, "sf0.01"), AS_OF))
    sums = [r[0] for r in share.groupBy("day").agg(F.sum("per")).select("sum(per)").collect()]
    assert len(sums) == 7 and all(s == pytest.approx(1, abs=0.0015) for s in sums)
    pivot = op.service_usage_pivot(share)
    assert pivot.columns == ["day", "feed", "feed+messenger", "messenger"] and pivot.count() == 7


def test_latest_messages_fall_back_to_the_last_day_with_any(spark):
    msg = message_frame(spark, [(1, 2, "2024-01-28"), (1, 3, "2024-01-28"), (1, 2, "2024-01-25")])
    assert op.messages_sent_latest(op.messages_sent_daily(msg, AS_OF)).first()[0] == 2


def test_new_posts_need_an_empty_past(spark):
    feed = feed_frame(spark, [(1, 1, "view", "2023-06-01"), (1, 1, "view", Y), (2, 2, "view", Y), (3, 3, "view", AS_OF)])
    assert op.new_posts(feed, AS_OF).first().new_posts == 1


def test_gone_delta_counts_users_last_seen_eight_days_before_yesterday(spark):
    life = op.user_lifespan(*feed_and_messages(spark, "sf0.01", sparse=True))
    row = op.gone_users_delta(life, AS_OF).first()
    assert row.delta == life.where(F.col("last_time") == F.lit(dt.date(2024, 1, 22))).count()
    assert row.gone_yesterday == op.gone_users(life, Y).count()
    assert row.gone_day_before == op.gone_users(life, "2024-01-29").count()


def test_lifespan_covers_receivers_and_today(spark):
    feed = feed_frame(spark, [(1, 1, "view", "2024-01-10")])
    msg = message_frame(spark, [(1, 2, Y), (1, 3, AS_OF)])
    rows = {r.user_id: (str(r.first_time), str(r.last_time)) for r in op.user_lifespan(feed, msg).collect()}
    assert rows == {1: ("2024-01-10", AS_OF), 2: (Y, Y), 3: (AS_OF, AS_OF)}
    until = {r.user_id: str(r.last_time) for r in op.user_lifespan(feed, msg, until=AS_OF).collect()}
    assert until == {1: Y, 2: Y}
    assert [r.user_id for r in op.new_users(op.user_lifespan(feed, msg), AS_OF).collect()] == [2]


def test_lifespan_equals_the_distinct_union(spark):
    feed, msg = feed_and_messages(spark, "sf0.01", sparse=True)
    direct = op.all_activity(feed, msg).groupBy("user_id").agg(
        F.to_date(F.min("time")).alias("first_time"), F.to_date(F.max("time")).alias("last_time"))
    life = op.user_lifespan(feed, msg)
    assert life.exceptAll(direct).count() == 0 and direct.exceptAll(life).count() == 0


def test_presence(spark):
    feed = feed_frame(spark, [(1, 1, "view", Y), (1, 2, "like", Y), (1, 1, "view", AS_OF), (0, 1, "view", Y)])
    assert sorted((r.user_id, str(r.day)) for r in op.daily_presence(feed).collect()) == [
        (0, Y), (1, Y), (1, AS_OF)]


def test_instant_timestamps_work_too(spark):
    zoned = feed_frame(spark, [(1, 1, "view", Y), (2, 1, "like", AS_OF)]).withColumn("time", F.col("time").cast("timestamp"))
    assert op.feed_metrics_yesterday(zoned, AS_OF).first().DAU == 1
    assert in_days(zoned, Y, AS_OF).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_reading_formats(spark, tmp_path, fmt):
    events = sources.read_events(spark, "/root/testdata/sf0.001/events.parquet")
    options = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"} if fmt in ("json", "csv") else {}
    if fmt == "csv":
        options |= {"header": "true", "escape": '"'}
    events.write.format(fmt).options(**options).save(str(tmp_path / fmt))
    back = sources.read_events(spark, str(tmp_path / fmt), fmt=fmt, **options)
    assert back.schema == sources.EVENTS_SCHEMA
    assert back.exceptAll(events).count() == 0 and events.exceptAll(back).count() == 0


def test_pivot_follows_the_labels(spark):
    feed, msg = feed_and_messages(spark, "sf0.01")
    labels = {"feed": "F", "messenger": "M", "feed+messenger": "both"}
    plain = op.service_usage_pivot(op.service_usage_share(op.service_usage_daily(feed, msg, AS_OF, ordered=False)))
    named = op.service_usage_pivot(op.service_usage_share(op.service_usage_daily(feed, msg, AS_OF, labels=labels)), labels=labels)
    assert named.columns == ["day", "F", "both", "M"]
    assert [tuple(r) for r in plain.collect()] == [tuple(r) for r in named.collect()]


def test_merged_tables_equal_the_full_ones(spark):
    feed, msg = feed_and_messages(spark, "sf0.01", sparse=True)
    users, posts = op.user_lifespan(feed, msg, "2024-01-05"), op.posts_first_seen(feed, "2024-01-05")
    for day in ("2024-01-06", "2024-01-05", "2024-01-05", "2024-01-07"):       # in any order, and again
        users, posts = op.merge_lifespan(users, feed, msg, day), op.merge_posts_first_seen(posts, feed, day)
    assert users.exceptAll(op.user_lifespan(feed, msg, "2024-01-08")).count() == 0
    assert posts.exceptAll(op.posts_first_seen(feed, "2024-01-08")).count() == 0
    for as_of in ("2024-01-12", "2024-01-20", AS_OF):
        full = op.gone_users_delta(op.user_lifespan(feed, msg), as_of).first().delta
        assert op.gone_users_delta_recent(feed, msg, as_of).first().delta == full
