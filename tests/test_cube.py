"""The activity cube, its rollups and the result table."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from data import AS_OF, feed_and_messages, feed_frame, message_frame
from feedmetrics import operators as op
from feedmetrics import plans, sources
from feedmetrics.operators.cube import CUBE_KEYS, MEASURES, MESSAGE_MEASURES

Y = "2024-01-30"


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_message_cube_equals_the_outer_joins(spark):
    _, msg = feed_and_messages(spark, "sf0.01")
    joined = op.messages_sent(msg, AS_OF)
    for part in (op.messages_received(msg, AS_OF), op.users_sent(msg, AS_OF), op.users_received(msg, AS_OF)):
        joined = joined.join(part, CUBE_KEYS, "full")
    cube = op.message_cube(msg, AS_OF)
    assert same(cube, joined.fillna(0, MESSAGE_MEASURES))
    strict = joined.where("messages_sent is not null and user_id <> 0").fillna(0, MESSAGE_MEASURES)
    assert same(op.message_cube(msg, AS_OF, strict=True), strict)


def test_messages_sent_and_received_balance(spark):
    _, msg = feed_and_messages(spark, "sf0.1")
    row = op.message_cube(msg, AS_OF).agg(*[F.sum(m).alias(m) for m in MESSAGE_MEASURES]).first()
    assert row.messages_sent == row.messages_received and row.users_sent == row.users_received


@pytest.mark.parametrize("strict", [False, True])
def test_daily_rollup_equals_the_way_over_the_cube(spark, strict):
    feed, msg = feed_and_messages(spark, "sf0.1")
    cube = op.activity_cube(op.feed_cube(feed, AS_OF, strict), op.message_cube(msg, AS_OF, strict))
    rollup = op.dimension_rollup(cube)
    assert same(op.daily_rollup(feed, msg, AS_OF, strict), rollup)
    one_by_one = op.rollup_dimension(cube, "os")
    for d in ("gender", "age"):
        one_by_one = one_by_one.unionByName(op.rollup_dimension(cube, d))
    assert same(rollup, one_by_one)
    totals = cube.agg(*[F.sum(m).alias(m) for m in MEASURES]).first()
    for r in rollup.groupBy("dimension").agg(*[F.sum(m).alias(m) for m in MEASURES]).collect():
        assert [r[m] for m in MEASURES] == [totals[m] for m in MEASURES]


def test_one_very_popular_receiver(spark):
    rows = [(i, 7, Y) for i in range(1, 200)] + [(1, 7, Y)] * 50 + [(7, 3, Y)]
    row = op.message_cube(message_frame(spark, rows), AS_OF).where("user_id = 7").first()
    assert (row.messages_sent, row.messages_received, row.users_sent, row.users_received) == (2, 249, 2, 199)


def test_unknown_demographics_stay_one_group(spark):
    msg = message_frame(spark, [(1, 2, Y, None, None, None), (3, 1, Y, None, None, None)])
    cube = op.message_cube(msg, AS_OF).where("user_id = 1").collect()
    assert len(cube) == 1 and (cube[0].messages_sent, cube[0].messages_received) == (1, 1)
    rollup = op.dimension_rollup(op.activity_cube(op.feed_cube(feed_frame(spark, []), AS_OF), op.message_cube(msg, AS_OF)))
    assert sorted((r.dimension, r.dimension_value, r.messages_sent) for r in rollup.collect()) == [
        ("age", None, 2), ("gender", None, 2), ("os", None, 2)]


def test_receivers_by_their_own_demographics(spark):
    msg = message_frame(spark, [(1, 2, Y, 0, 20, "iOS"), (1, 2, Y, 0, 21, "iOS"), (2, 1, Y, 1, 30, "Android")])
    people = spark.createDataFrame([(1, 0, 20, "iOS"), (2, 1, 30, "Android")], "user_id long, gender int, age int, os string")
    got = {(r.user_id, r.age): (r.messages_sent, r.messages_received, r.users_sent, r.users_received)
           for r in op.message_cube(msg, AS_OF, demographics=people).collect()}
    assert got == {(1, 20): (1, 1, 1, 1), (1, 21): (1, 0, 1, 0), (2, 30): (1, 2, 1, 1)}


def test_repeated_people_are_an_error(spark):
    msg = message_frame(spark, [(1, 2, Y), (3, 2, Y)])
    people = spark.createDataFrame([(2, 1, 30, "Android"), (2, 1, 31, "Android")], "user_id long, gender int, age int, os string")
    with pytest.raises(Exception, match="more than one row of demographics for user 2"):
        op.message_cube(msg, AS_OF, demographics=people).collect()
    with pytest.raises(Exception, match="more than one row of demographics"):
        plans.run_daily(feed_frame(spark, []), msg, AS_OF, demographics=people).collect()


def test_daily_table_by_receivers_equals_the_cubes_rollup(spark):
    feed, msg = feed_and_messages(spark, "sf0.01")
    people = feed.select("user_id", "gender", "age", "os").distinct()
    for strict in (False, True):
        cube = op.activity_cube(op.feed_cube(feed, AS_OF, strict), op.message_cube(msg, AS_OF, strict, people))
        assert same(plans.run_daily(feed, msg, AS_OF, strict, people), op.dimension_rollup(cube))
    plain, own = plans.run_daily(feed, msg, AS_OF), plans.run_daily(feed, msg, AS_OF, demographics=people)
    assert plain.agg(F.sum("messages_received")).first() == own.agg(F.sum("messages_received")).first()
    assert not same(plain, own)


def test_strict_feed_counts_rows(spark):
    feed = feed_frame(spark, [(1, 1, "like", Y), (1, 2, "view", Y), (1, 3, "view", Y)])
    assert tuple(op.feed_cube(feed, AS_OF).first())[-2:] == (1, 2)
    assert tuple(op.feed_cube(feed, AS_OF, strict=True).first())[-2:] == (3, 3)


def test_reloading_a_day_replaces_it(spark):
    feed, msg = feed_and_messages(spark, "sf0.01")
    spark.sql("DROP TABLE IF EXISTS daily_dimensions")
    for as_of in ("2024-01-30", AS_OF, AS_OF, "2024-01-30"):
        plans.load_daily(feed, msg, as_of, "daily_dimensions")
    table = spark.table("daily_dimensions")
    assert {f.name: f.dataType for f in table.schema} == {f.name: f.dataType for f in sources.RESULT_SCHEMA}
    assert table.groupBy("event_date").count().count() == 2 and table.count() == 14
    assert same(table.where(F.col("event_date") == F.lit(dt.date(2024, 1, 30))), plans.run_daily(feed, msg, AS_OF))


def test_loading_goes_by_name(spark):
    spark.sql("DROP TABLE IF EXISTS by_name")
    sources.ensure_table(spark, "by_name")
    sources.ensure_table(spark, "by_name")
    row = dict(event_date=dt.date(2024, 1, 1), dimension="os", dimension_value="iOS", views=1, likes=2,
               messages_received=3, messages_sent=4, users_received=5, users_sent=6)
    names = sorted(row)
    schema = sources.RESULT_SCHEMA
    df = spark.createDataFrame([tuple(row[n] for n in names)], ", ".join(f"{n} {schema[n].dataType.simpleString()}" for n in names))
    sources.load_result(df, "by_name", "2024-01-01")
    assert spark.table("by_name").first().asDict() == row


def test_an_empty_rerun_clears_the_day(spark):
    feed, msg = feed_and_messages(spark, "sf0.01")
    spark.sql("DROP TABLE IF EXISTS cleared")
    for as_of in ("2024-01-30", AS_OF):
        plans.load_daily(feed, msg, as_of, "cleared")
    plans.load_daily(feed.where("false"), msg.where("false"), AS_OF, "cleared")
    assert [r.event_date for r in spark.table("cleared").select("event_date").distinct().collect()] == [dt.date(2024, 1, 29)]


def test_days_load_in_parallel(spark):
    feed, msg = feed_and_messages(spark, "sf0.01")
    spark.sql("DROP TABLE IF EXISTS in_parallel")
    sources.ensure_table(spark, "in_parallel")
    days = [f"2024-01-{d}" for d in range(24, 32)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda d: plans.load_daily(feed, msg, d, "in_parallel"), days))
    got = spark.table("in_parallel")
    assert got.groupBy("event_date").count().count() == len(days)
    for d in days:
        day = dt.date.fromisoformat(d) - dt.timedelta(days=1)
        assert same(got.where(F.col("event_date") == F.lit(day)), plans.run_daily(feed, msg, d))


def test_rows_of_another_day_are_an_error(spark):
    feed, msg = feed_and_messages(spark, "sf0.01")
    spark.sql("DROP TABLE IF EXISTS other_day")
    sources.ensure_table(spark, "other_day")
    with pytest.raises(Exception, match="a row of another day than 2024-01-01"):
        sources.load_result(plans.run_daily(feed, msg, AS_OF), "other_day", "2024-01-01")
