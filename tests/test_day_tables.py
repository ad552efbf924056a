"""Tables kept per day or user that reports merge: sketches, bitmaps of days, lifespans in buckets."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from data import AS_OF, feed_and_messages, feed_frame, message_frame
from feedmetrics import operators as op
from feedmetrics import plans, sources
from feedmetrics.sources.publish import buckets_of


@pytest.fixture(scope="module")
def inputs(spark):
    return feed_and_messages(spark, "sf0.01")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- sketches -----------------------------------------------------------------------------------


@pytest.mark.parametrize("lg", [8, 12, 16])
def test_estimates_keep_their_error(spark, lg):
    """Days of 20,000 users of 30,000, shifted from day to day; the union of a week is all of them."""
    users = spark.range(20_000).join(spark.range(7).toDF("d"), how="cross").select(
        F.pmod(F.col("id") + F.col("d") * 1700, F.lit(30_000)).alias("user_id"),
        F.expr("timestamp_ntz'2024-01-24 10:00:00' + make_dt_interval(cast(d as int))").alias("time"), F.lit("view").alias("action"))
    sketches = op.feed_sketches(users, "2024-01-24", "2024-01-30", lg)
    exact = users.select("user_id").distinct().count()
    week = {r["days"]: r["users"] for r in op.feed_metrics_of_windows(sketches, AS_OF, (1, 7)).collect()}
    assert abs(week[7] / exact - 1) < 4 * op.relative_error(lg)
    assert abs(week[1] / 20_000 - 1) < 4 * op.relative_error(lg)
    days = op.feed_metrics_of_days(sketches, AS_OF).collect()
    assert len(days) == 7 and all(abs(r["DAU"] / 20_000 - 1) < 4 * op.relative_error(lg) for r in days)


def test_sketches_of_days_merge_in_any_order(inputs):
    feed = inputs[0]
    whole = op.feed_sketches(feed, "2024-01-20", "2024-01-30")
    first, second = op.feed_sketches(feed, "2024-01-24", "2024-01-30"), op.feed_sketches(feed, "2024-01-20", "2024-01-25")
    for merged in (op.merge_sketches(first, second), op.merge_sketches(op.merge_sketches(second, second), first)):
        assert rows(op.feed_metrics_of_windows(merged, AS_OF, (1, 5, 11))) == rows(op.feed_metrics_of_windows(whole, AS_OF, (1, 5, 11)))


def test_a_day_made_again_takes_the_old_ones_place(spark):
    old = op.feed_sketches(feed_frame(spark, [(1, 1, "view", "2024-01-30"), (2, 1, "view", "2024-01-30")]), "2024-01-30", "2024-01-30")
    new = op.feed_sketches(feed_frame(spark, [(3, 1, "like", "2024-01-30")]), "2024-01-30", "2024-01-30")
    assert rows(op.feed_metrics_of_days(op.merge_sketches(old, new), AS_OF)) == [("2024-01-30", 1, 1, 0, None)]


def test_sketches_of_nothing_and_null_users(spark):
    feed = feed_frame(spark, [(None, 1, "view", "2024-01-30"), (None, 1, "like", "2024-01-30")])
    sketches = op.feed_sketches(feed, "2024-01-30", "2024-01-30")
    assert rows(op.feed_metrics_of_windows(sketches, AS_OF)) == [(1, 0, 1, 1, 1.0), (30, 0, 1, 1, 1.0), (7, 0, 1, 1, 1.0)]
    empty = op.feed_sketches(feed, "2023-01-01", "2023-01-02")
    assert rows(op.feed_metrics_of_windows(empty, AS_OF)) == [] and rows(op.feed_metrics_of_days(empty, AS_OF)) == []


def test_a_service_nobody_used(spark):
    feed, msg = feed_frame(spark, [(1, 1, "view", "2024-01-30")]), message_frame(spark, [(5, 6, "2024-01-01")])
    presence = op.presence_sketches(feed, msg, "2024-01-01", "2024-01-30")
    got = {r["days"]: (r["feed"], r["messenger"], r["either"], r["both"]) for r in op.service_usage_of_windows(presence, AS_OF).collect()}
    assert got == {1: (1, 0, 1, 0), 7: (1, 0, 1, 0), 30: (1, 1, 2, 0)}


# --- bitmaps of days ----------------------------------------------------------------------------


@pytest.mark.parametrize("as_of", ["2024-01-31", "2024-01-20", "2024-01-05", "2024-03-01", "2023-12-01"])
@pytest.mark.parametrize("days", [1, 7, 30])
def test_bitmaps_give_the_daily_report(inputs, as_of, days):
    presence = op.presence_bitmaps(*inputs)
    assert rows(op.service_usage_of(presence, as_of, days)) == rows(op.service_usage_daily(*inputs, as_of, days))


def test_bitmaps_over_the_edges_of_spans(spark):
    """2024-01-10 is bit 0 of a span, 2024-01-09 bit 63 of the one before; days before 1970 count down."""
    days = ["1969-12-30", "1969-12-31", "1970-01-01", "2024-01-08", "2024-01-09", "2024-01-10", "2024-03-13", "2024-03-14"]
    feed = feed_frame(spark, [(u, 1, "view", d) for u in (1, None) for d in days])
    msg = message_frame(spark, [(1, 2, d) for d in days[::2]] + [(3, 2, days[-1])])
    presence = op.presence_bitmaps(feed, msg)
    for d in days:
        as_of = dt.date.fromisoformat(d) + dt.timedelta(days=2)
        assert rows(op.service_usage_of(presence, as_of, 4)) == rows(op.service_usage_daily(feed, msg, as_of, 4))
    assert presence.where("user_id = 1").count() == len({(dt.date.fromisoformat(d) - dt.date(1970, 1, 1)).days // 64 for d in days})
    assert rows(op.active_days(presence.where("user_id IS NOT NULL"), "2024-01-11", 4)) == [(3, 1)]


def test_bitmaps_merge_in_any_order_and_more_than_once(inputs):
    feed, msg = inputs
    parts = [op.presence_bitmaps(*(t.where(F.pmod(F.dayofmonth("time"), F.lit(3)) == i) for t in inputs)) for i in range(3)]
    whole = rows(op.presence_bitmaps(feed, msg))
    assert rows(op.merge_presence(*parts)) == whole
    assert rows(op.merge_presence(parts[2], op.merge_presence(parts[1], parts[0]), parts[1])) == whole
    assert rows(op.merge_presence(parts[0].where("false"))) == []


def test_reports_from_bitmaps_never_group_users(inputs):
    presence = plans.materialize(op.presence_bitmaps(*inputs))
    plan = op.service_usage_of(presence, AS_OF, ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange hashpartitioning(user_id" not in plan
    assert re.search(r"PushedFilters: \[.*span", plan)


# --- lifespans in buckets -----------------------------------------------------------------------


@pytest.fixture
def kept(spark):
    name = f"kept_{uuid.uuid4().hex}"
    yield name
    sources.drop_published(spark, name)


def side_of(plan, scan):
    """The lines of a plan tree from the join down to ``scan``, without the other branches."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if scan in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))       # noqa: E731
    path, level = [], depth(lines[at])
    for line in reversed(lines[: at + 1]):
        if depth(line) <= level:
            path.append(line)
            level = depth(line) - 1
        if "Join" in line:
            return path
    raise AssertionError("no join")


def test_the_history_is_not_shuffled(spark, inputs, kept):
    feed, msg = inputs
    plans.store(op.user_lifespan(feed, msg, "2024-01-29"), kept, "user_id", 16)
    df = plans.extended_lifespan(spark, kept, feed, msg, "2024-01-29")
    plan = df._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    path = side_of(df._jdf.queryExecution().executedPlan().toString(), f"{kept}[user_id")
    assert "Bucketed: true" in path[0] or "FileScan" in path[0]
    assert not any("Exchange" in line for line in path), "\n".join(path)
    plans.load_lifespan(feed, msg, "2024-01-29", kept)
    assert len(spark.table(kept).inputFiles()) == 16            # each bucket was written by one task
    assert rows(spark.table(kept)) == rows(op.user_lifespan(feed, msg, "2024-01-30"))


def test_kept_posts_day_by_day(spark, inputs, kept):
    feed = inputs[0]
    for day in ("2024-01-03", "2024-01-01", "2024-01-02", "2024-01-03"):
        plans.load_posts(feed, day, kept, 4)
    assert buckets_of(spark, kept) == 4
    assert rows(spark.table(kept)) == rows(op.posts_first_seen(feed, "2024-01-04"))
    assert op.new_posts_from(spark.table(kept), "2024-01-03").first()["new_posts"] == op.new_posts(feed, "2024-01-03").first()["new_posts"]


def test_null_keys_and_empty_days(spark, kept):
    feed = feed_frame(spark, [(None, None, "view", "2024-01-02"), (7, 1, "view", "2024-01-02"), (None, 1, "view", "2024-01-05")])
    msg = message_frame(spark, [(7, None, "2024-01-03")])
    for day in ("2024-01-02", "2024-01-03", "2024-01-04", "2024-01-05", "2024-01-02"):
        plans.load_lifespan(feed, msg, day, kept, 4)
    assert rows(spark.table(kept)) == rows(op.user_lifespan(feed, msg))


def test_a_failing_day_leaves_the_kept_table(spark, inputs, kept):
    feed, msg = inputs
    plans.load_lifespan(feed, msg, "2024-01-02", kept, 4)
    before = rows(spark.table(kept))
    broken = feed.withColumn("user_id", F.when(F.col("post_id") % 7 == 3, F.raise_error(F.lit("half way")).cast("bigint")).otherwise(F.col("user_id")))
    with pytest.raises(Exception, match="half way"):
        plans.load_lifespan(broken, msg, "2024-01-03", kept)
    assert rows(spark.table(kept)) == before
