"""Shapes of the physical plans that matter at scale."""

import math
import os
import re

import pytest
from pyspark.sql import functions as F

from data import AS_OF, WINDOW, feed_and_messages
from feedmetrics import operators as op
from feedmetrics import plans
from feedmetrics.functions import last_days
import __spark_entry__ as contract


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def final(df):
    df.collect()
    return initial(df).split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def inputs(spark):
    return feed_and_messages(spark, "sf0.01")


def test_day_ranges_and_columns_reach_the_scan(inputs):
    plan = formatted(op.feed_metrics_daily(inputs[0], AS_OF))
    pushed = re.search(r"PushedFilters: (.*)", plan).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string>" in plan


def test_date_partitions_are_pruned(spark, inputs, tmp_path):
    path = str(tmp_path / "by_day")
    inputs[0].withColumn("event_date", F.to_date("time")).write.partitionBy("event_date").parquet(path)
    plan = formatted(last_days(spark.read.parquet(path), AS_OF))
    filters = re.search(r"PartitionFilters: (.*)", plan).group(1)
    assert "event_date" in filters and ">=" in filters and "<" in filters
    assert last_days(spark.read.parquet(path), AS_OF).count() == last_days(inputs[0], AS_OF).count()


def test_message_measures_need_one_scan(inputs):
    assert initial(op.message_cube(inputs[1], AS_OF)).count("FileScan") == 1


def test_lifecycle_needs_one_scan_per_table(inputs):
    assert initial(op.gone_users_delta(op.user_lifespan(*inputs), AS_OF)).count("FileScan") == 2


def test_group_totals_reuse_the_per_user_shuffle(inputs):
    plan = final(op.smoothed_ctr(op.user_ctr(inputs[0], *WINDOW)))
    assert "ReusedExchange" in plan and plan.count("FileScan") == 1


def test_rank_test_ranks_within_ranges(inputs):
    plan = final(op.mann_whitney(op.user_ctr(inputs[0], *WINDOW)))
    # One window per range of values, one over the range totals, none over all rows.
    assert len(re.findall(r"\bWindow \[", plan)) == 2
    assert re.search(r"\bWindow \[.*\], \[range#", plan)
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("method", ["users", "cells"])
def test_bootstrap_draws_in_many_tasks(spark, inputs, method):
    users = op.user_ctr(inputs[0], *WINDOW)
    plan = final(op.poisson_bootstrap(users, 100, method=method))
    slices = spark.conf.get("spark.sql.shuffle.partitions")
    assert re.search(rf"Exchange hashpartitioning\(xxhash64\(.*?\), {slices}\), REPARTITION_BY_NUM", plan)


SMALL_INPUT_ONLY = {"read_events", "feed_actions", "message_actions"}


@pytest.mark.parametrize("name", sorted(set(contract._QUERIES) - SMALL_INPUT_ONLY))
def test_no_query_pairs_all_rows(spark, name):
    plan = initial(contract.queries()[name](spark, "/root/testdata/sf0.01"))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == ["day", "DAU", "Likes", "Views", "CTR"] and rows.count() == 7


def test_materialized_tables_live_in_the_shared_folder(spark, inputs):
    users = op.user_ctr(inputs[0], *WINDOW)
    stored = plans.materialize(users)
    assert all(f.split(":", 1)[1].lstrip("/").startswith(
        spark.conf.get("spark.checkpoint.dir").lstrip("/")) for f in stored.inputFiles())
    assert stored.exceptAll(users).count() == 0 and stored.dtypes == users.dtypes


def test_report_reads_the_stored_users_only(spark, inputs):
    plan = initial(plans.experiment_report(inputs[0], *WINDOW, n_boot=20))
    assert "events.parquet" not in plan


def test_report_methods(spark, inputs):
    report = plans.experiment_report(inputs[0], *WINDOW, n_boot=500)
    rows = {r.method: r for r in report.collect()}
    assert set(rows) == {"welch_ctr", "mann_whitney_ctr", "welch_smoothed_ctr", "welch_bucket_ctr",
                         "mann_whitney_bucket_ctr", "poisson_bootstrap"}
    users = op.user_ctr(inputs[0], *WINDOW)
    assert rows["welch_ctr"].p_value == pytest.approx(op.welch_ttest(users).first().p_value)
    assert all(r.reject == (r.p_value < 0.05) for r in rows.values() if r.p_value is not None)
    assert rows["poisson_bootstrap"].reject is False


def test_histogram_keeps_every_value(spark):
    df = spark.createDataFrame([(float(i % 13), i % 2) for i in range(100)] + [(None, 0)], "x double, g int")
    for bins in (1, 4, 13, 50):
        rows = op.histogram(df, "x", "g", bins).collect()
        assert sum(r.n for r in rows) == 100
        assert min(r.bin_lo for r in rows) == 0 and max(r.bin_hi for r in rows) == pytest.approx(12)
    for bounds in ((0.0, 4.0), (5.0, 6.0), (-9.0, -8.0), (20.0, 30.0), (-5.0, 50.0), (3.0, 3.0)):
        rows = op.histogram(df, "x", "g", 4, bounds).collect()
        assert sum(r.n for r in rows) == 100
        values = [float(i % 13) for i in range(100)]
        assert sum(r.n for r in rows if r.bin_lo is None) == sum(v < bounds[0] for v in values)
        assert sum(r.n for r in rows if r.bin_hi is None) == sum(v > bounds[1] for v in values)
    odd = df.unionByName(spark.createDataFrame([(float("nan"), 0)] * 7, "x double, g int"))
    for bounds in (None, (0.0, 4.0)):
        rows = op.histogram(odd, "x", None, 4, bounds).collect()
        assert sum(r.n for r in rows) == 107
        assert [r.n for r in rows if r.bin_lo is not None and math.isnan(r.bin_lo)] == [7]
        assert max(r.bin_hi for r in rows if r.bin_hi is not None and not math.isnan(r.bin_hi)) in (4.0, 12.0)
    one = op.histogram(spark.createDataFrame([(2.5,)] * 3, "x double"), "x", None, 5).collect()
    assert len(one) == 1 and one[0].n == 3
    assert op.histogram(df.where("false"), "x", "g", 5).count() == 0


class _Session:
    """The parts of a session ``shared_dir`` asks for."""

    def __init__(self, master, named=None):
        self.sparkContext, self.conf = self, {"spark.checkpoint.dir": named} if named else {}
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_a_cluster_must_name_its_shared_folder():
    from feedmetrics.plans.checkpoint import shared_dir

    assert shared_dir(_Session("spark://host:7077", "hdfs:///shared")) == "hdfs:///shared"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session("spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(_Session("local-cluster[2,1,1024]"))
    local = _Session("local[2]")
    assert shared_dir(local) == shared_dir(local)


def test_materialized_files_go_with_their_block(spark, inputs):
    with plans.materialized(op.user_ctr(inputs[0], *WINDOW)) as users:
        folder = os.path.dirname(users.inputFiles()[0].split(":", 1)[1].replace("///", "/"))
        assert users.count() > 0 and os.path.isdir(folder)
        report = plans.experiment_report(inputs[0], *WINDOW, n_boot=20, users=users).collect()
        assert len(report) == 6
    assert not os.path.exists(folder)


def test_report_reads_its_users_few_times(inputs):
    plan = initial(plans.experiment_report(inputs[0], *WINDOW, n_boot=20))
    assert len(re.findall(r"FileScan parquet \[[^]]*(?:likes|ctr#)", plan)) < 9


def test_receivers_meet_their_attributes_as_one_row_each(inputs):
    people = inputs[0].select("user_id", "gender", "age", "os").distinct()
    plan = formatted(op.message_cube(inputs[1], AS_OF, demographics=people))
    logical = op.message_cube(inputs[1], AS_OF, demographics=people)._jdf.queryExecution().optimizedPlan().toString()
    below = logical[logical.index("Join LeftOuter"):]
    first = re.search(r"Aggregate \[day#\d+, reciever_id#\d+L\]", below)
    assert first and first.start() < below.index("Relation"), plan


def test_incremental_lifecycle_scans_the_new_days_only(spark, inputs):
    users = spark.createDataFrame([], "user_id long, first_time date, last_time date")
    posts = spark.createDataFrame([], "post_id long, public_time timestamp_ntz")
    plans_ = [
        op.merge_lifespan(users, *inputs, "2024-01-30"), op.merge_posts_first_seen(posts, inputs[0], "2024-01-30"),
        op.app_report_metrics(*inputs, AS_OF, users, posts)]
    for df in plans_:
        filters = re.findall(r"PushedFilters: (.*)", formatted(df))
        assert filters and all("GreaterThanOrEqual(ts,2024-01-2" in f or "GreaterThanOrEqual(ts,2024-01-30" in f for f in filters)


def test_history_bounds_prune_partitions(spark, inputs, tmp_path):
    path = str(tmp_path / "by_day")
    inputs[0].withColumn("event_date", F.to_date("time")).write.partitionBy("event_date").parquet(path)
    feed = spark.read.parquet(path)
    for df in (op.new_posts(feed, AS_OF), op.posts_first_seen(feed, AS_OF)):
        assert "event_date" in re.search(r"PartitionFilters: (.*)", formatted(df)).group(1)
