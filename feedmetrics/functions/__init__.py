from .hashing import FINE_DIGITS, HASH_DIGITS, bucket_of, md5_number, uniform
from .math import ratio
from .pvalues import normal_two_sided, t_two_sided
from .timeframe import DAY_PARTITION, as_date, before_day, by_day, day_of, in_days, last_days, since_day

__all__ = [
    "DAY_PARTITION",
    "FINE_DIGITS",
    "HASH_DIGITS",
    "as_date",
    "before_day",
    "bucket_of",
    "by_day",
    "day_of",
    "in_days",
    "last_days",
    "md5_number",
    "normal_two_sided",
    "ratio",
    "since_day",
    "t_two_sided",
    "uniform",
]
