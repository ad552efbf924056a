"""Reporting periods as half-open ranges on the raw ``time`` column.

Ranges on the stored column reach the Parquet scan; a filter on a function of it (a day
difference, say) does not. Tables partitioned by ``event_date`` get the same range on that
column too, which prunes whole directories.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_PARTITION = "event_date"


def as_date(day: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def _day_columns(df: DataFrame) -> list[str]:
    return ["time"] + [c for c in df.columns if c == DAY_PARTITION]


def in_days(df: DataFrame, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Rows of the days ``start`` to ``end``, both included."""
    first, after = as_date(start), as_date(end) + dt.timedelta(days=1)
    return df.where(" and ".join(f"{c} >= date'{first}' and {c} < date'{after}'" for c in _day_columns(df)))


def last_days(df: DataFrame, as_of: dt.date | str, days: int = 7) -> DataFrame:
    """Rows of the ``days`` full days before ``as_of`` (``as_of`` itself is today, not included)."""
    today = as_date(as_of)
    return in_days(df, today - dt.timedelta(days=days), today - dt.timedelta(days=1))


def before_day(df: DataFrame, day: dt.date | str) -> DataFrame:
    """Rows of all days before ``day``."""
    return df.where(" and ".join(f"{c} < date'{as_date(day)}'" for c in _day_columns(df)))


def since_day(df: DataFrame, day: dt.date | str) -> DataFrame:
    """Rows of ``day`` and all days after it."""
    return df.where(" and ".join(f"{c} >= date'{as_date(day)}'" for c in _day_columns(df)))


def by_day(df: DataFrame, *columns: str) -> DataFrame:
    """A report ordered by ``columns``; for results of a few rows per day of the report window.

    One task sorts them where they are. A global sort would sample its input first, which runs the
    aggregate before it twice, and shuffle once more.
    """
    return df.coalesce(1).sortWithinPartitions(*columns)


def day_of(time: str = "time") -> Column:
    return F.to_date(F.col(time))
