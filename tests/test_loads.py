"""Loads that change a table in one step, and loads of the days that late files touch."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from data import AS_OF, feed_and_messages
from feedmetrics import plans, sources
from feedmetrics.sources import publish

DAY = dt.date(2024, 1, 30)


@pytest.fixture
def table(spark):
    name = f"loads_{uuid.uuid4().hex}"
    sources.ensure_table(spark, name)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if spark.catalog.tableExists(f"{name}_files"):
        sources.drop_published(spark, f"{name}_files")


def result(spark, day=DAY, views=1, n=1):
    rows = [(day, "os", f"v{i}", views, 0, 0, 0, 0, 0) for i in range(n)]
    return spark.createDataFrame(rows, sources.RESULT_SCHEMA)


def shown(spark, table):
    return sorted((r["event_date"], r["dimension_value"], r["views"]) for r in spark.table(table).collect())


def folder_of(spark, table, day=DAY):
    return publish.table_location(spark, table, f"event_date = '{day}'")


def local(path):
    return path.split(":", 1)[1].replace("///", "/")


def test_a_load_that_fails_leaves_the_old_day(spark, table):
    sources.load_result(result(spark, n=3), table, DAY)
    before, folder = shown(spark, table), folder_of(spark, table)
    broken = result(spark, n=40).repartition(4).withColumn(
        "views", F.when(F.col("dimension_value") == "v17", F.raise_error(F.lit("half way")).cast("bigint")).otherwise(F.col("views")))
    for rows in (broken, result(spark).unionByName(result(spark, DAY - dt.timedelta(days=1)))):
        with pytest.raises(Exception, match="half way|a row of another day"):
            sources.load_result(rows, table, DAY)
        assert shown(spark, table) == before and folder_of(spark, table) == folder
    assert os.listdir(local(os.path.dirname(folder))) == [os.path.basename(folder)]     # nothing left behind


def test_readers_of_the_replaced_files_keep_them(spark, table):
    sources.load_result(result(spark, views=1), table, DAY)
    files = spark.table(table).inputFiles()
    sources.load_result(result(spark, views=2), table, DAY)
    assert [r["views"] for r in spark.read.parquet(*files).collect()] == [1]
    assert shown(spark, table) == [(DAY, "v0", 2)]
    sources.load_result(result(spark, views=3), table, DAY)
    assert shown(spark, table) == [(DAY, "v0", 3)]
    assert len(os.listdir(local(os.path.dirname(folder_of(spark, table))))) == 2        # this one and the one before


def test_an_empty_load_clears_its_day_only(spark, table):
    other = DAY - dt.timedelta(days=1)
    sources.load_result(result(spark), table, DAY)
    sources.load_result(result(spark, other), table, other)
    sources.load_result(result(spark).where("false"), table, DAY)
    assert shown(spark, table) == [(other, "v0", 1)]


def test_the_load_that_started_last_counts(spark, table, monkeypatch):
    sources.load_result(result(spark, views=2), table, DAY)
    monkeypatch.setattr(publish.time, "time_ns", lambda: 1)
    sources.load_result(result(spark, views=1), table, DAY)
    assert shown(spark, table) == [(DAY, "v0", 2)]


def test_a_day_loaded_in_place_is_taken_over(spark, table):
    place = f"{publish.table_location(spark, table)}/event_date={DAY}"
    result(spark, views=7).drop("event_date").write.parquet(place)
    spark.sql(f"ALTER TABLE {table} ADD PARTITION (event_date = '{DAY}') LOCATION '{place}'")
    assert shown(spark, table) == [(DAY, "v0", 7)]
    for views in (1, 2, 3):
        sources.load_result(result(spark, views=views), table, DAY)
        assert shown(spark, table) == [(DAY, "v0", views)]
    assert not os.path.exists(local(place))


def test_several_days_by_one_job(spark, table):
    days = [DAY - dt.timedelta(days=i) for i in range(4)]
    rows = result(spark, days[0], 5).unionByName(result(spark, days[2], 6))
    sources.load_result(result(spark, days[1], 9), table, days[1])
    assert sources.load_days(rows, table, days) == sorted(days)
    assert shown(spark, table) == [(days[2], "v0", 6), (days[0], "v0", 5)]
    assert sources.load_days(rows, table, []) == []
    with pytest.raises(Exception, match="a row of another day"):
        sources.load_days(rows, table, days[:2])
    assert shown(spark, table) == [(days[2], "v0", 6), (days[0], "v0", 5)]


def test_publish_table(spark):
    name = f"published_{uuid.uuid4().hex}"
    sources.publish_table(spark.range(5).toDF("k"), name, "k", 4)
    assert publish.buckets_of(spark, name) == 4
    planned = spark.table(name)
    planned._jdf.queryExecution().executedPlan()
    sources.publish_table(spark.table(name).selectExpr("k + 1 as k"), name, "k", 4)
    assert sorted(r["k"] for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]
    assert sorted(r["k"] for r in planned.collect()) == [0, 1, 2, 3, 4]
    with pytest.raises(Exception, match="wrong"):
        sources.publish_table(spark.range(3).select(F.raise_error(F.lit("wrong")).cast("bigint").alias("k")), name, "k", 4)
    with pytest.raises(ValueError, match="4 buckets"):
        sources.publish_table(spark.range(3).toDF("k"), name, "k", 2)
    assert sorted(r["k"] for r in spark.table(name).collect()) == [1, 2, 3, 4, 5]
    root = local(publish.table_root(spark, name))
    sources.drop_published(spark, name)
    assert not os.path.exists(root) and not spark.catalog.tableExists(name)
    spark.sql(f"CREATE TABLE {name} (k bigint) USING parquet")
    with pytest.raises(ValueError, match="not made by"):
        sources.publish_table(spark.range(3).toDF("k"), name)
    spark.sql(f"DROP TABLE {name}")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith(name)]


# --- late files ---------------------------------------------------------------------------------


@pytest.fixture
def events(spark):
    return sources.read_events(spark, "/root/testdata/sf0.001/events.parquet").where("ts >= date'2024-01-25'")


def rollup(spark, path, day):
    raw = sources.read_events(spark, path)
    return plans.run_daily(sources.feed_actions(raw), sources.message_actions(raw), day + dt.timedelta(days=1))


def agrees(spark, table, path, days):
    for day in days:
        want = rollup(spark, path, day)
        got = spark.table(table).where(F.col("event_date") == F.lit(day)).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, day


def days_from(first, last):
    return [dt.date(2024, 1, d) for d in range(first, last + 1)]


def test_late_files_change_their_days_only(spark, table, events, tmp_path):
    path = str(tmp_path / "events")
    late = (F.to_date("ts") == "2024-01-27") & (F.col("event_type") == "click")
    events.where(~late).write.parquet(path)
    assert plans.load_changed(spark, path, table, "2024-01-30") == days_from(25, 29)
    agrees(spark, table, path, days_from(25, 29))
    folders = {d: folder_of(spark, table, d) for d in days_from(25, 29)}

    assert plans.load_changed(spark, path, table, "2024-01-30") == []
    events.where(late).write.mode("append").parquet(path)
    assert plans.load_changed(spark, path, table, "2024-01-30") == days_from(27, 27)
    agrees(spark, table, path, days_from(25, 29))
    assert {d for d, f in folders.items() if folder_of(spark, table, d) != f} == {dt.date(2024, 1, 27)}

    # The day that was not over has its turn when it is.
    assert plans.load_changed(spark, path, table, AS_OF) == days_from(30, 30)
    assert plans.load_changed(spark, path, table, AS_OF) == []


def test_files_that_change_or_go(spark, table, events, tmp_path):
    path = str(tmp_path / "events")
    parts = [F.to_date("ts") == d for d in ("2024-01-26", "2024-01-27", "2024-01-28")]
    for i, part in enumerate(parts):
        events.where(part).coalesce(1).write.parquet(f"{path}/f{i}")
    files = f"{path}/*"
    assert plans.load_changed(spark, files, table, AS_OF) == days_from(26, 28)
    events.where(parts[0] | (F.to_date("ts") == "2024-01-29")).coalesce(1).write.mode("overwrite").parquet(f"{path}/f0")
    assert plans.load_changed(spark, files, table, AS_OF) == [dt.date(2024, 1, 26), dt.date(2024, 1, 29)]
    events.where("false").write.mode("overwrite").parquet(f"{path}/f1")
    assert plans.load_changed(spark, files, table, AS_OF) == days_from(27, 27)
    assert spark.table(table).where("event_date = date'2024-01-27'").count() == 0
    agrees(spark, table, files, days_from(26, 29))


def test_a_file_with_an_old_time_of_change_is_new(spark, table, events, tmp_path):
    path = str(tmp_path / "events")
    events.where("ts < date'2024-01-26'").write.parquet(f"{path}/a")
    assert plans.load_changed(spark, f"{path}/*", table, AS_OF) == days_from(25, 25)
    events.where("ts >= date'2024-01-30'").coalesce(1).write.parquet(f"{path}/b")
    for name in os.listdir(f"{path}/b"):
        os.utime(f"{path}/b/{name}", (1_000_000_000, 1_000_000_000))
    assert plans.load_changed(spark, f"{path}/*", table, AS_OF) == days_from(30, 30)


def test_a_failing_load_is_repeated(spark, table, events, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    events.write.parquet(path)
    with monkeypatch.context() as broken:
        broken.setattr(plans.daily, "load_days", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            plans.load_changed(spark, path, table, AS_OF, first_day="2024-01-28")
    assert plans.load_changed(spark, path, table, AS_OF, first_day="2024-01-28") == days_from(28, 30)
    assert plans.load_changed(spark, path, table, AS_OF) == days_from(25, 27)


def test_rollup_of_days_is_each_day_by_itself(spark):
    from feedmetrics import operators as op

    feed, msg = feed_and_messages(spark, "sf0.001")
    days = ["2024-01-20", "2024-01-22", "2024-01-23"]
    for strict in (False, True):
        want = None
        for d in days:
            one = op.daily_rollup(feed, msg, dt.date.fromisoformat(d) + dt.timedelta(days=1), strict)
            want = one if want is None else want.unionByName(one)
        got = op.rollup_of_days(feed, msg, days, strict)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
