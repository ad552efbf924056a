"""Portable hashing: the same numbers in any engine that has md5.

Used where a result must be reproducible whatever the partitioning: bucketing users, random
weights and random samples are all functions of the row's key and a seed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIGITS = 8        # hex digits of a hash: 32 bits
FINE_DIGITS = 13       # 52 bits, still exact as a double; for picking among very many rows


def md5_number(key: Column, digits: int = HASH_DIGITS) -> Column:
    """The first ``digits`` hex digits of the md5 of ``key`` as a non-negative bigint."""
    return F.conv(F.substring(F.md5(key.cast("string")), 1, digits), 16, 10).cast("bigint")


def uniform(*parts: Column, digits: int = HASH_DIGITS) -> Column:
    """A number in [0, 1) fixed by ``parts`` (joined with ``:``); exact in double precision."""
    key = F.concat_ws(":", *[p.cast("string") for p in parts])
    return md5_number(key, digits) / F.lit(float(16**digits))


def bucket_of(key: Column, n_buckets: int, portable: bool = True) -> Column:
    """Bucket 0..n-1 of ``key``; ``portable=False`` uses Spark's own, faster ``xxhash64``."""
    hashed = md5_number(key) if portable else F.xxhash64(key)
    return F.pmod(hashed, F.lit(n_buckets)).cast("int")
