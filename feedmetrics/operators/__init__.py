from .aacells import aa_moments, aa_pvalues_of
from .app import (
    all_activity,
    app_report_metrics,
    daily_presence,
    gone_users,
    gone_users_delta,
    gone_users_delta_recent,
    lifespan_of_day,
    merge_lifespan,
    merge_posts_first_seen,
    messages_sent_daily,
    messages_sent_latest,
    new_posts,
    new_posts_from,
    new_users,
    new_users_count,
    posts_first_seen,
    posts_of_day,
    service_usage_daily,
    service_usage_pivot,
    service_usage_share,
    user_lifespan,
)
from .cube import (
    activity_cube,
    daily_rollup,
    dimension_rollup,
    feed_cube,
    message_cube,
    messages_received,
    messages_sent,
    received_by,
    rollup_dimension,
    rollup_of_days,
    users_received,
    users_sent,
)
from .dyadic import histogram_one_scan
from .experiment import bucket_ctr, group_ctr, group_summary, histogram, pooled_ctr, smoothed_ctr
from .feed import (
    feed_metrics_daily,
    feed_metrics_yesterday,
    feed_report_metrics,
    period_bounds,
    user_ctr,
)
from .intime import attributes_in_time
from .presence import active_days, merge_presence, presence_bitmaps, service_usage_of
from .resample import aa_fpr, aa_pvalues, aa_samples, bootstrap_diff, poisson_bootstrap
from .sketches import (
    feed_metrics_of_days,
    feed_metrics_of_windows,
    feed_sketches,
    merge_sketches,
    presence_sketches,
    relative_error,
    service_usage_of_windows,
)
from .stats import mann_whitney, t_test, welch_ttest

__all__ = [
    "aa_fpr",
    "aa_moments",
    "aa_pvalues",
    "aa_pvalues_of",
    "aa_samples",
    "active_days",
    "activity_cube",
    "all_activity",
    "app_report_metrics",
    "attributes_in_time",
    "bootstrap_diff",
    "bucket_ctr",
    "daily_presence",
    "daily_rollup",
    "dimension_rollup",
    "feed_cube",
    "feed_metrics_daily",
    "feed_metrics_of_days",
    "feed_metrics_of_windows",
    "feed_metrics_yesterday",
    "feed_report_metrics",
    "feed_sketches",
    "gone_users",
    "gone_users_delta",
    "gone_users_delta_recent",
    "group_ctr",
    "group_summary",
    "histogram",
    "histogram_one_scan",
    "lifespan_of_day",
    "mann_whitney",
    "merge_lifespan",
    "merge_posts_first_seen",
    "merge_presence",
    "merge_sketches",
    "message_cube",
    "messages_received",
    "messages_sent",
    "messages_sent_daily",
    "messages_sent_latest",
    "new_posts",
    "new_posts_from",
    "new_users",
    "new_users_count",
    "period_bounds",
    "poisson_bootstrap",
    "pooled_ctr",
    "posts_first_seen",
    "posts_of_day",
    "presence_bitmaps",
    "presence_sketches",
    "received_by",
    "relative_error",
    "rollup_dimension",
    "rollup_of_days",
    "service_usage_daily",
    "service_usage_of",
    "service_usage_of_windows",
    "service_usage_pivot",
    "service_usage_share",
    "smoothed_ctr",
    "t_test",
    "user_ctr",
    "user_lifespan",
    "users_received",
    "users_sent",
    "welch_ttest",
]
