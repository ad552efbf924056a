from .checkpoint import materialize, materialized, shared_dir
from .daily import load_changed, load_daily, run_daily
from .experiment import aa_check, experiment_report
from .lifecycle import extended_lifespan, extended_posts, load_lifespan, load_posts, store

__all__ = [
    "aa_check",
    "experiment_report",
    "extended_lifespan",
    "extended_posts",
    "load_changed",
    "load_daily",
    "load_lifespan",
    "load_posts",
    "materialize",
    "materialized",
    "run_daily",
    "shared_dir",
    "store",
]
