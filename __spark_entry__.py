"""

``entry(spark)`` is the smoke query, ``queries()[name](spark, sf_dir)`` runs an operator on the
event table of ``sf_dir``, ``oracle_sql()[name]`` is its independent SQL form (see ``oracle.py``).
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import oracle
from feedmetrics import operators as op
from feedmetrics import plans, sources

try:        # the training-data operators are an optional part
    import corpus_pipeline
    from feedmetrics.llm import queries as corpus_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "feedmetrics.llm"):
        raise
    corpus_pipeline = corpus_queries = None

AS_OF = "2024-01-31"                        # "today" of the fixture: its last full day is the 30th
WINDOW = ("2024-01-08", "2024-01-14")       # experiment days
AB, AA = (1, 2), (2, 3)                     # groups compared
N_BOOT, N_EXP, SAMPLE, SMALL_SAMPLE, WHOLE_GROUP = 10_000, 10_000, 10, 5, 29    # 29 users a group at sf0.01
BINS, NARROW = 20, (0.5, 1.0)

LATE_DAY, SKETCH_BITS, USAGE_DATES = "2024-01-27", 16, (AS_OF, "2024-01-20", "2024-01-08")

Query = Callable[[SparkSession, str], DataFrame]


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_events(spark, f"{sf_dir}/events.parquet")


def _feed(spark, d):
    return sources.feed_actions(_events(spark, d))


def _msg(spark, d):
    return sources.message_actions(_events(spark, d))


def _sparse(spark, d):
    events = _events(spark, d)
    return sources.feed_actions(events, sparse_users=True), sources.message_actions(events, sparse_users=True)


def _users(spark, d, groups=AB):
    return op.user_ctr(_feed(spark, d), *WINDOW, groups)


def _bootstrap(spark, d):
    return op.poisson_bootstrap(_users(spark, d), N_BOOT, AB, method="users")


def _aa_samples(spark, d, size=SAMPLE):
    return op.aa_samples(plans.materialize(_users(spark, d, AA)), "ctr", AA, size, N_EXP)


def _aa_pvalues(spark, d):
    return op.aa_pvalues(_aa_samples(spark, d), AA)


def _people(spark, d):
    """Own attributes of everybody who acts in the feed or writes a message."""
    feed, msg = _feed(spark, d), _msg(spark, d)
    keys = ["user_id", "gender", "age", "os"]
    return feed.select(*keys).unionByName(msg.select(*keys)).distinct()


def _merged_lifespan(spark, d):
    """History up to the 29th, then one day after another."""
    feed, msg = _sparse(spark, d)
    out = op.user_lifespan(feed, msg, "2024-01-30")
    for day in ("2024-01-30", "2024-01-31"):
        out = op.merge_lifespan(out, feed, msg, day)
    return out


def _incremental_report(spark, d):
    feed, msg = _sparse(spark, d)
    users = op.merge_lifespan(op.user_lifespan(feed, msg, "2024-01-30"), feed, msg, "2024-01-30")
    posts = op.merge_posts_first_seen(op.posts_first_seen(feed, "2024-01-30"), feed, "2024-01-30")
    return op.app_report_metrics(feed, msg, AS_OF, users, posts)


def _loaded(spark, d):
    """Two days loaded, one of them twice, and the table read back."""
    table = f"daily_{uuid.uuid4().hex}"
    for as_of in (AS_OF, "2024-01-30", AS_OF):
        plans.load_daily(_feed(spark, d), _msg(spark, d), as_of, table)
    rows = plans.materialize(spark.table(table))
    spark.sql(f"DROP TABLE {table}")
    return rows


def _loaded_late(spark, d):
    """Events in two files, the second late: which days the second call loads, and the table after it."""
    events, table = _events(spark, d), f"daily_{uuid.uuid4().hex}"
    path = f"{plans.shared_dir(spark)}/late/{table}"
    late = (F.to_date("ts") == F.lit(LATE_DAY).cast("date")) & (F.hour("ts") >= 18)
    events.where(~late).write.parquet(path)
    plans.load_changed(spark, path, table, "2024-01-30", first_day="2024-01-25")
    events.where(late).write.mode("append").parquet(path)
    again = plans.load_changed(spark, path, table, AS_OF, first_day="2024-01-25")
    rows = plans.materialize(spark.table(table).withColumn("again", F.col("event_date").isin(again)))
    spark.sql(f"DROP TABLE {table}")
    sources.drop_published(spark, f"{table}_files")
    return rows


def _aa_moments(spark, d, size=SAMPLE):
    return op.aa_moments(plans.materialize(_users(spark, d, AA)), "ctr", AA, size, N_EXP)


def _kept_lifespan(spark, d):
    """History up to the 28th stored in buckets, then one day after another."""
    feed, msg = _sparse(spark, d)
    table = f"lifespan_{uuid.uuid4().hex}"
    plans.store(op.user_lifespan(feed, msg, "2024-01-29"), table, "user_id", 8)
    for day in ("2024-01-30", "2024-01-29", "2024-01-31", "2024-01-30"):
        plans.load_lifespan(feed, msg, day, table)
    rows = plans.materialize(spark.table(table))
    sources.drop_published(spark, table)
    return rows


def _kept_posts(spark, d):
    feed = _feed(spark, d)
    table = f"posts_{uuid.uuid4().hex}"
    plans.store(op.posts_first_seen(feed, "2024-01-30"), table, "post_id", 8)
    plans.load_posts(feed, "2024-01-30", table)
    rows = plans.materialize(op.new_posts_from(spark.table(table), AS_OF))
    sources.drop_published(spark, table)
    return rows


def _day_sketches(spark, d):
    """Sketches of three weeks, the last of them made twice and by itself."""
    feed = _feed(spark, d)
    weeks = op.feed_sketches(feed, "2024-01-10", "2024-01-24", SKETCH_BITS)
    return op.merge_sketches(weeks, op.feed_sketches(feed, "2024-01-23", "2024-01-31", SKETCH_BITS))


def _usage_of(spark, d):
    """Service usage on three dates from one table of bitmaps, in which a week came twice."""
    feed, msg = _feed(spark, d), _msg(spark, d)
    again = op.presence_bitmaps(feed.where("time >= date'2024-01-20'"), msg.where("time >= date'2024-01-20'"))
    presence = plans.materialize(op.merge_presence(op.presence_bitmaps(feed, msg), again))
    out = [op.service_usage_of(presence, a, ordered=False).withColumn("as_of", F.lit(a)) for a in USAGE_DATES]
    return out[0].unionByName(out[1]).unionByName(out[2])


def _profiles(spark, d):
    """Attributes as each feed action shows them: they change from one to the next."""
    odd = F.col("post_id") % 2
    return _feed(spark, d).select(
        "user_id", "time", (F.col("post_id") % 3).cast("int").alias("gender"), (20 + odd).cast("int").alias("age"),
        F.when(odd == 0, "iOS").otherwise("Android").alias("os"))


def _constant_ttest(spark, d, equal_var):
    """A metric that does not vary within a group, but between them."""
    users = _users(spark, d).withColumn("share", F.col("exp_group") / F.lit(2.0))
    return op.t_test(users, "share", AB, equal_var)


def _cube(spark, d, strict=False):
    return op.activity_cube(
        op.feed_cube(_feed(spark, d), AS_OF, strict), op.message_cube(_msg(spark, d), AS_OF, strict)
    )



def _usage(spark, d, **kw):
    return op.service_usage_daily(_feed(spark, d), _msg(spark, d), AS_OF, **kw)


def _lifespan(spark, d):
    return op.user_lifespan(*_sparse(spark, d))


def _portable(df: DataFrame) -> DataFrame:
    """Doubles to 6 decimals, days and times as text: comparable between engines."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, T.TimestampNTZType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        out.append(c.alias(f.name))
    return df.select(*out)


_QUERIES: dict[str, Query] = {
    # sources
    "read_events": _events,
    "feed_actions": _feed,
    "message_actions": _msg,
    # feed metrics
    "feed_metrics_yesterday": lambda s, d: op.feed_metrics_yesterday(_feed(s, d), AS_OF),
    "feed_metrics_daily": lambda s, d: op.feed_metrics_daily(_feed(s, d), AS_OF),
    "period_bounds": lambda s, d: op.period_bounds(_feed(s, d), AS_OF),
    "feed_report_metrics": lambda s, d: op.feed_report_metrics(_feed(s, d), AS_OF),
    # app-wide metrics and user lifecycle
    "daily_presence": lambda s, d: op.daily_presence(_feed(s, d)),
    "daily_presence_messenger": lambda s, d: op.daily_presence(_msg(s, d)),
    "service_usage_daily": _usage,
    "service_usage_daily_strict": lambda s, d: _usage(s, d, strict=True),
    "service_usage_share": lambda s, d: op.service_usage_share(_usage(s, d, ordered=False)),
    "service_usage_pivot": lambda s, d: op.service_usage_pivot(op.service_usage_share(_usage(s, d, ordered=False))),
    "messages_sent_daily": lambda s, d: op.messages_sent_daily(_msg(s, d), AS_OF),
    "messages_sent_latest": lambda s, d: op.messages_sent_latest(op.messages_sent_daily(_msg(s, d), AS_OF)),
    "new_posts": lambda s, d: op.new_posts(_feed(s, d), AS_OF),
    "all_activity": lambda s, d: op.all_activity(_feed(s, d), _msg(s, d)),
    "user_lifespan": _lifespan,
    "new_users": lambda s, d: op.new_users(_lifespan(s, d), AS_OF),
    "new_users_count": lambda s, d: op.new_users_count(_lifespan(s, d), AS_OF),
    "gone_users": lambda s, d: op.gone_users(_lifespan(s, d), "2024-01-30"),
    "gone_users_day_before": lambda s, d: op.gone_users(_lifespan(s, d), "2024-01-29").orderBy("last_time"),
    "gone_users_delta": lambda s, d: op.gone_users_delta(_lifespan(s, d), AS_OF),
    "gone_users_delta_recent": lambda s, d: op.gone_users_delta_recent(*_sparse(s, d), AS_OF),
    "user_lifespan_merged": _merged_lifespan,
    "app_report_metrics": lambda s, d: op.app_report_metrics(*_sparse(s, d), AS_OF),
    "app_report_metrics_incremental": _incremental_report,
    # activity cube
    "feed_cube": lambda s, d: op.feed_cube(_feed(s, d), AS_OF),
    "feed_cube_strict": lambda s, d: op.feed_cube(_feed(s, d), AS_OF, strict=True),
    "messages_sent": lambda s, d: op.messages_sent(_msg(s, d), AS_OF),
    "messages_received": lambda s, d: op.messages_received(_msg(s, d), AS_OF),
    "users_sent": lambda s, d: op.users_sent(_msg(s, d), AS_OF),
    "users_received": lambda s, d: op.users_received(_msg(s, d), AS_OF),
    "message_cube": lambda s, d: op.message_cube(_msg(s, d), AS_OF),
    "message_cube_strict": lambda s, d: op.message_cube(_msg(s, d), AS_OF, strict=True),
    "message_cube_demographics": lambda s, d: op.message_cube(_msg(s, d), AS_OF, demographics=_people(s, d)),
    "activity_cube": _cube,
    "rollup_dimension_os": lambda s, d: op.rollup_dimension(_cube(s, d), "os"),
    "rollup_dimension_gender": lambda s, d: op.rollup_dimension(_cube(s, d), "gender"),
    "rollup_dimension_age": lambda s, d: op.rollup_dimension(_cube(s, d), "age"),
    "dimension_rollup": lambda s, d: op.dimension_rollup(_cube(s, d)),
    "dimension_rollup_strict": lambda s, d: op.dimension_rollup(_cube(s, d, strict=True)),
    "run_daily": lambda s, d: plans.run_daily(_feed(s, d), _msg(s, d), AS_OF),
    "run_daily_strict": lambda s, d: plans.run_daily(_feed(s, d), _msg(s, d), AS_OF, strict=True),
    "run_daily_demographics": lambda s, d: plans.run_daily(_feed(s, d), _msg(s, d), AS_OF, demographics=_people(s, d)),
    "load_daily": _loaded,
    "load_changed": _loaded_late,
    "message_cube_in_time": lambda s, d: op.message_cube(_msg(s, d), AS_OF, demographics=_profiles(s, d)),
    "run_daily_in_time": lambda s, d: plans.run_daily(_feed(s, d), _msg(s, d), AS_OF, demographics=_profiles(s, d)),
    # day tables that reports merge
    "user_lifespan_kept": _kept_lifespan,
    "new_posts_kept": _kept_posts,
    "feed_metrics_of_days": lambda s, d: op.feed_metrics_of_days(_day_sketches(s, d), AS_OF),
    "feed_metrics_of_windows": lambda s, d: op.feed_metrics_of_windows(_day_sketches(s, d), AS_OF, (1, 7, 21)),
    "service_usage_of_windows": lambda s, d: op.service_usage_of_windows(
        op.presence_sketches(_feed(s, d), _msg(s, d), "2024-01-10", "2024-01-30", SKETCH_BITS), AS_OF, (1, 7, 21)),
    "service_usage_of": _usage_of,
    "active_days": lambda s, d: op.active_days(op.presence_bitmaps(_feed(s, d), _msg(s, d)), AS_OF, 28),
    # experiment statistics
    "user_ctr": _users,
    "group_ctr": lambda s, d: op.group_ctr(_feed(s, d), *WINDOW, AB),
    "smoothed_ctr": lambda s, d: op.smoothed_ctr(_users(s, d)),
    "group_summary": lambda s, d: op.group_summary(op.smoothed_ctr(_users(s, d))),
    "histogram_ctr": lambda s, d: op.histogram(_users(s, d), "ctr", "exp_group", BINS),
    "histogram_ctr_narrow": lambda s, d: op.histogram(_users(s, d), "ctr", "exp_group", BINS, bounds=NARROW),
    "histogram_smoothed_ctr": lambda s, d: op.histogram(
        op.smoothed_ctr(_users(s, d)), "smoothed_ctr", "exp_group", BINS),
    "histogram_bucket_ctr": lambda s, d: op.histogram(
        op.bucket_ctr(_users(s, d)), "bucket_ctr", "exp_group", BINS),
    "histogram_bootstrap_ctr": lambda s, d: op.histogram(
        _bootstrap(s, d).unpivot(["replicate"], ["ctr1", "ctr2"], "sample", "ctr"), "ctr", "sample", BINS),
    "histogram_bootstrap_diff": lambda s, d: op.histogram(
        _bootstrap(s, d).withColumn("diff", F.col("ctr2") - F.col("ctr1")), "diff", None, BINS),
    "histogram_one_scan": lambda s, d: op.histogram_one_scan(_users(s, d), "ctr", "exp_group", BINS),
    "histogram_one_scan_values": lambda s, d: op.histogram_one_scan(_events(s, d), "value", "event_type", 50),
    "welch_ttest": lambda s, d: op.welch_ttest(_users(s, d), "ctr", AB),
    "welch_ttest_constant": lambda s, d: _constant_ttest(s, d, False),
    "pooled_ttest_constant": lambda s, d: _constant_ttest(s, d, True),
    "mann_whitney": lambda s, d: op.mann_whitney(_users(s, d), "ctr", AB),
    "poisson_bootstrap": _bootstrap,
    "bootstrap_diff": lambda s, d: op.bootstrap_diff(_bootstrap(s, d)),
    "poisson_bootstrap_cells": lambda s, d: op.poisson_bootstrap(_users(s, d), N_BOOT, AB),
    "bootstrap_diff_cells": lambda s, d: op.bootstrap_diff(op.poisson_bootstrap(_users(s, d), N_BOOT, AB)),
    "bucket_ctr": lambda s, d: op.bucket_ctr(_users(s, d)),
    "bucket_welch": lambda s, d: op.welch_ttest(op.bucket_ctr(_users(s, d)), "bucket_ctr", AB),
    "bucket_mann_whitney": lambda s, d: op.mann_whitney(op.bucket_ctr(_users(s, d)), "bucket_ctr", AB),
    "smoothed_welch": lambda s, d: op.welch_ttest(op.smoothed_ctr(_users(s, d)), "smoothed_ctr", AB),
    "experiment_report": lambda s, d: plans.experiment_report(_feed(s, d), *WINDOW),
    # A/A check
    "aa_samples": _aa_samples,
    "aa_samples_large_group": lambda s, d: _aa_samples(s, d, SMALL_SAMPLE),
    "aa_samples_whole_group": lambda s, d: _aa_samples(s, d, WHOLE_GROUP),
    "aa_pvalues": _aa_pvalues,
    "aa_fpr": lambda s, d: op.aa_fpr(_aa_pvalues(s, d)),
    "aa_moments": _aa_moments,
    "aa_moments_whole_group": lambda s, d: _aa_moments(s, d, WHOLE_GROUP),
    "aa_pvalues_of": lambda s, d: op.aa_pvalues_of(_aa_moments(s, d)),
    "aa_fpr_of": lambda s, d: op.aa_fpr(op.aa_pvalues_of(_aa_moments(s, d))),
    "aa_pvalue_histogram": lambda s, d: op.histogram(
        _aa_pvalues(s, d), "p_value", None, BINS, bounds=(0.0, 1.0)),
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: _portable(query(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: feed metrics per day of the last week at the smallest scale."""
    return queries()["feed_metrics_daily"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    out = {name: _registered(query) for name, query in _QUERIES.items()}
    if corpus_queries:
        out |= corpus_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    out = dict(oracle.SQL)
    if corpus_queries:
        out |= corpus_queries.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return out
