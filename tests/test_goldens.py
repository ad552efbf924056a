"""Expected values of FIXTURES.md, computed beforehand with another engine."""

import pytest
from pyspark.sql import functions as F

from data import AS_OF, WINDOW, feed_and_messages
from feedmetrics import operators as op
from feedmetrics import plans

SCALES = ["sf0.001", "sf0.01"]


def pick(scale, small, large):
    return small if scale == "sf0.001" else large


@pytest.mark.parametrize("scale", SCALES)
class TestReports:
    def test_rows(self, spark, scale):
        feed, msg = feed_and_messages(spark, scale)
        assert (feed.count(), msg.count()) == pick(scale, (398, 202), (3988, 1981))

    def test_feed_metrics(self, spark, scale):
        feed, _ = feed_and_messages(spark, scale)
        assert tuple(op.feed_metrics_yesterday(feed, AS_OF).first()) == pick(
            scale, (10, 7, 9, 0.778), (91, 63, 73, 0.863))
        daily = op.feed_metrics_daily(feed, AS_OF).collect()
        assert [r.day for r in daily] == [f"2024-01-{d}" for d in range(24, 31)]
        assert [r.DAU for r in daily] == pick(scale, [11, 8, 7, 10, 13, 9, 10], [90, 91, 90, 90, 88, 92, 91])
        assert [r.Likes for r in daily] == pick(scale, [9, 11, 5, 6, 12, 7, 7], [77, 58, 62, 76, 67, 68, 63])
        assert [r.Views for r in daily] == pick(scale, [5, 9, 2, 8, 7, 5, 9], [66, 73, 79, 60, 66, 73, 73])

    def test_service_usage(self, spark, scale):
        usage = op.service_usage_daily(*feed_and_messages(spark, scale), AS_OF)
        totals = {r[0]: (r[1], r[2]) for r in usage.groupBy("using_service").agg(
            F.sum("cnt_users"), F.count("*")).collect()}
        assert totals == pick(
            scale,
            {"feed": (42, 7), "feed+messenger": (26, 7), "messenger": (7, 5)},
            {"feed": (421, 7), "feed+messenger": (211, 7), "messenger": (151, 7)},
        )

    def test_messages_and_posts(self, spark, scale):
        feed, msg = feed_and_messages(spark, scale)
        per_day = op.messages_sent_daily(msg, AS_OF)
        assert per_day.agg(F.sum("mess_sent")).first()[0] == pick(scale, 35, 441)
        assert op.messages_sent_latest(per_day).first()[0] == pick(scale, 7, 61)
        assert op.new_posts(feed, AS_OF).first().new_posts == pick(scale, 10, 91)

    def test_lifecycle(self, spark, scale):
        life = op.user_lifespan(*feed_and_messages(spark, scale, sparse=True))
        assert op.new_users_count(life, AS_OF).first()[0] == pick(scale, 15, 138)
        assert op.gone_users(life, "2024-01-30").count() == pick(scale, 419, 3741)
        assert tuple(op.gone_users_delta(life, AS_OF).first()) == pick(scale, (419, 390, 29), (3741, 3520, 221))


def totals(df, *columns):
    return tuple(df.agg(F.count("*"), *[F.coalesce(F.sum(c), F.lit(0)) for c in columns]).first())


E9 = {
    "sf0.001": {
        ("age", "18"): (4, 3, 3, 3, 3, 3), ("age", "19"): (4, 2, 1, 1, 1, 1), ("age", "20"): (1, 2, 3, 3, 3, 3),
        ("gender", "0"): (4, 4, 4, 4, 4, 4), ("gender", "1"): (5, 3, 3, 3, 3, 3),
        ("os", "Android"): (3, 4, 3, 3, 3, 3), ("os", "iOS"): (6, 3, 4, 4, 4, 4),
    },
    "sf0.01": {
        ("age", "18"): (21, 16, 17, 17, 16, 16), ("age", "19"): (22, 27, 21, 21, 20, 20),
        ("age", "20"): (30, 20, 23, 23, 23, 23), ("gender", "0"): (35, 34, 34, 34, 32, 32),
        ("gender", "1"): (38, 29, 27, 27, 27, 27), ("os", "Android"): (36, 36, 29, 29, 28, 28),
        ("os", "iOS"): (37, 27, 32, 32, 31, 31),
    },
}
E9_STRICT_MESSAGES = {
    ("age", "18"): (21, 16, 0, 15, 0, 15), ("age", "19"): (22, 27, 3, 21, 3, 20),
    ("age", "20"): (30, 20, 3, 23, 3, 23), ("gender", "0"): (35, 34, 3, 32, 3, 31),
    ("gender", "1"): (38, 29, 3, 27, 3, 27), ("os", "Android"): (36, 36, 2, 29, 2, 28),
    ("os", "iOS"): (37, 27, 4, 30, 4, 30),
}


def rollup_rows(df):
    return {
        (r.dimension, r.dimension_value): (
            r.views, r.likes, r.messages_received, r.messages_sent, r.users_received, r.users_sent)
        for r in df.collect()
    }


@pytest.mark.parametrize("scale", SCALES)
class TestCube:
    measures = ("messages_sent", "messages_received", "users_sent", "users_received")

    def test_parts(self, spark, scale):
        feed, msg = feed_and_messages(spark, scale)
        assert totals(op.feed_cube(feed, AS_OF), "likes", "views") == pick(scale, (10, 7, 9), (91, 63, 73))
        assert totals(op.message_cube(msg, AS_OF), *self.measures) == pick(
            scale, (13, 7, 7, 7, 7), (106, 61, 61, 59, 59))
        assert totals(op.message_cube(msg, AS_OF, strict=True), *self.measures) == pick(
            scale, (6, 6, 0, 6, 0), (52, 59, 6, 58, 6))

    def test_cube_rows(self, spark, scale):
        feed, msg = feed_and_messages(spark, scale)
        one = op.feed_cube(feed, AS_OF)
        assert op.activity_cube(one, op.message_cube(msg, AS_OF)).count() == pick(scale, 17, 166)
        assert op.activity_cube(one, op.message_cube(msg, AS_OF, strict=True)).count() == pick(scale, 11, 113)

    def test_rollup(self, spark, scale):
        feed, msg = feed_and_messages(spark, scale)
        cube = op.activity_cube(op.feed_cube(feed, AS_OF), op.message_cube(msg, AS_OF))
        assert rollup_rows(op.dimension_rollup(cube)) == E9[scale]
        assert rollup_rows(plans.run_daily(feed, msg, AS_OF)) == E9[scale]
        if scale == "sf0.01":
            cube = op.activity_cube(op.feed_cube(feed, AS_OF), op.message_cube(msg, AS_OF, strict=True))
            assert rollup_rows(op.dimension_rollup(cube)) == E9_STRICT_MESSAGES


GROUPS = {
    "sf0.001": {1: (3, 2, 2.833333, 9.388889, 2.75), 2: (3, 3, 0.866667, 0.164444, 0.818182), 3: (3, 2, 0.75, 0.0, 1.0)},
    "sf0.01": {1: (30, 29, 0.963218, 0.483023, 0.831461), 2: (30, 29, 1.19532, 0.948832, 0.929293),
               3: (30, 29, 1.2422, 1.171024, 1.020408)},
}


@pytest.mark.parametrize("scale", SCALES)
class TestExperiment:
    def users(self, spark, scale, groups=(1, 2)):
        return op.user_ctr(feed_and_messages(spark, scale)[0], *WINDOW, groups)

    def test_groups(self, spark, scale):
        rows = self.users(spark, scale, (1, 2, 3)).groupBy("exp_group").agg(
            F.count("*"), F.count("ctr"), F.round(F.avg("ctr"), 6), F.round(F.var_samp("ctr"), 6),
            F.round(F.sum("likes") / F.sum("views"), 6)).collect()
        assert {r[0]: tuple(r[1:]) for r in rows} == GROUPS[scale]

    def test_smoothed(self, spark, scale):
        rows = op.smoothed_ctr(self.users(spark, scale)).groupBy("exp_group").agg(
            F.round(F.avg("smoothed_ctr"), 6)).collect()
        assert dict(map(tuple, rows)) == pick(scale, {1: 2.88125, 2: 0.827273}, {1: 0.858752, 2: 0.976598})

    def test_tests(self, spark, scale):
        welch = op.welch_ttest(self.users(spark, scale)).first()
        want = pick(scale, (0.902439, 1.02342), (-1.044547, 50.640607))
        assert (welch.t, welch.df) == pytest.approx(want, abs=1e-5)
        mw = op.mann_whitney(self.users(spark, scale)).first()
        assert (mw.u1, mw.ties, mw.n1, mw.n2) == pick(scale, (4.5, 6, 2, 3), (380.5, 2124, 29, 29))

    def test_buckets(self, spark, scale):
        rows = op.bucket_ctr(self.users(spark, scale)).groupBy("exp_group").agg(
            F.count("*"), F.count("bucket_ctr"), F.round(F.avg("bucket_ctr"), 6)).collect()
        assert {r[0]: tuple(r[1:]) for r in rows} == pick(
            scale, {1: (3, 2, 2.833333), 2: (3, 3, 0.866667)}, {1: (23, 23, 1.023979), 2: (23, 23, 1.187802)})


def test_bootstrap(spark):
    users = op.user_ctr(feed_and_messages(spark, "sf0.01")[0], *WINDOW)
    boot = op.poisson_bootstrap(users, 200, method="users")
    first = boot.where("replicate = 0").first()
    assert (first.ctr1, first.ctr2) == pytest.approx((0.861111, 0.94186), abs=1e-6)
    diff = op.bootstrap_diff(boot).first()
    assert (diff.mean_diff, diff.share_positive) == pytest.approx((0.086491, 0.665), abs=1e-6)


def test_aa(spark):
    users = plans.materialize(op.user_ctr(feed_and_messages(spark, "sf0.01")[0], *WINDOW, (2, 3)))
    p = op.aa_pvalues(op.aa_samples(users, sample_size=10, n_exp=200))
    t = {r.replicate: r.t for r in p.where("replicate < 2").collect()}
    assert (t[0], t[1]) == pytest.approx((0.120805, 1.650861), abs=1e-6)
    fpr = op.aa_fpr(p).first()
    assert (fpr.n_exp, fpr.fpr, fpr.split_ok) == (200, 0.015, True)
