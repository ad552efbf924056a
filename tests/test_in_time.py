"""Attributes at the time of an event against a search row by row."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from data import AS_OF, message_frame
from feedmetrics import operators as op
from feedmetrics import sources

START = dt.datetime(2024, 1, 30, 0, 0)
EVENTS, HISTORY = "user_id long, time timestamp_ntz, n long", "user_id long, time timestamp_ntz, gender int, os string"


def key(row):
    return tuple((v is not None, v if v is not None else 0) for v in row)


def expected(events, history):
    out = []
    for user, time, n in events:
        known = [h for h in history if user is not None and time is not None and h[0] == user and h[1] is not None and h[1] <= time]
        last = max(known, key=lambda h: (h[1], *key(h[2:]))) if known else (None,) * 4
        out.append((user, time, n, last[2], last[3]))
    return sorted(out, key=lambda r: r[2])


@pytest.mark.parametrize("seed, grain", [(1, "hour"), (2, "minute"), (3, "day"), (4, "month")])
def test_last_row_before(spark, seed, grain):
    rng = random.Random(seed)

    def time():
        return rng.choice([None, *[START + dt.timedelta(minutes=rng.randint(-3000, 3000)) for _ in range(12)]])

    events = [(rng.choice([1, 2, 3, None]), time(), i) for i in range(400)]
    history = [(rng.choice([1, 2, None, 9]), time(), rng.choice([0, 1, None]), rng.choice(["iOS", "Android", None])) for _ in range(60)]
    history += [(1, START, 0, "iOS"), (1, START, 1, None), (1, START, None, "z")]
    events += [(1, START, 1000), (1, START - dt.timedelta(microseconds=1), 1001)]
    got = op.attributes_in_time(
        spark.createDataFrame(events, EVENTS).repartition(3), spark.createDataFrame(history, HISTORY).repartition(2), ["gender", "os"], grain=grain)
    assert got.columns == ["user_id", "time", "n", "gender", "os"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[2]) == expected(events, history)


def test_empty_sides_and_repeated_rows(spark):
    events = spark.createDataFrame([(1, START, 1), (1, START, 1)], EVENTS)
    history = spark.createDataFrame([(1, START, 5, "a")] * 3, HISTORY)
    assert [tuple(r)[3:] for r in op.attributes_in_time(events, history, ["gender", "os"]).collect()] == [(5, "a")] * 2
    assert [tuple(r)[3:] for r in op.attributes_in_time(events, history.limit(0), ["gender", "os"]).collect()] == [(None, None)] * 2
    assert op.attributes_in_time(events.limit(0), history, ["gender", "os"]).collect() == []


def test_a_busy_key_spreads_over_its_hours(spark):
    plan = op.attributes_in_time(
        spark.createDataFrame([(1, START, 1)], EVENTS), spark.createDataFrame([(1, START, 5, "a")], HISTORY), ["gender", "os"]
    )._jdf.queryExecution().executedPlan().toString()
    # Events meet by key and hour only; by key alone there is one row for each hour.
    events = [line for line in plan.splitlines() if "Window [last(__known" in line]
    assert len(events) == 2 and sum("[user_id" in line and "__cut" in line.split("],")[1] for line in events) >= 1
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_receivers_whose_attributes_change_during_the_day(spark):
    msg = message_frame(spark, [(1, 9, "2024-01-30"), (2, 9, "2024-01-30"), (1, 9, "2024-01-30")])
    msg = msg.withColumn("time", F.expr("time + make_interval(0, 0, 0, 0, 0, cast(user_id * 10 as int))"))     # 12:10 and 12:20
    noon = dt.datetime(2024, 1, 30, 12, 15)
    people = spark.createDataFrame(
        [(9, noon - dt.timedelta(days=40), 0, 30, "iOS"), (9, noon, 1, 31, "Android")], "user_id long, time timestamp_ntz, gender int, age int, os string")
    got = {(r["age"], r["os"]): (r["messages_received"], r["users_received"])
           for r in op.message_cube(msg, AS_OF, demographics=people).where("user_id = 9").collect()}
    assert got == {(30, "iOS"): (2, 1), (31, "Android"): (1, 1)}
    one = op.received_by(msg, AS_OF, people.where("gender = 0")).collect()
    same = op.received_by(msg, AS_OF, people.where("gender = 0").drop("time")).collect()
    assert sorted(map(str, (r.asDict(True) for r in one))) == sorted(
        str({k: r[k] for k in one[0].asDict()}) for r in same)
    assert sources.RESULT_SCHEMA.fieldNames() == op.rollup_of_days(
        spark.createDataFrame([], sources.FEED_SCHEMA), msg, ["2024-01-30"], demographics=people).columns
