"""The daily job: events of yesterday to one partition of the result table; later, of the days that changed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import as_date
from ..operators.cube import daily_rollup, rollup_of_days
from ..sources.changes import file_versions, ledger, record, stale_days, touched
from ..sources.events import feed_actions, message_actions, read_events
from ..sources.sink import RESULT_SCHEMA, ensure_table, load_days, load_result
from .checkpoint import materialized


def run_daily(
    feed: DataFrame,
    msg: DataFrame,
    as_of: dt.date | str,
    strict: bool = False,
    demographics: DataFrame | None = None,
) -> DataFrame:
    """The rows of the result table for the day before ``as_of``, as one lazy plan.

    ``demographics`` (one row per ``user_id``) attributes received messages to their receivers.
    """
    return daily_rollup(feed, msg, as_of, strict, demographics).select(*RESULT_SCHEMA.fieldNames())


def load_daily(
    feed: DataFrame,
    msg: DataFrame,
    as_of: dt.date | str,
    table: str,
    strict: bool = False,
    demographics: DataFrame | None = None,
) -> None:
    """Create ``table`` if needed and write the day into it; running again replaces the day."""
    ensure_table(feed.sparkSession, table)
    day = as_date(as_of) - dt.timedelta(days=1)
    load_result(run_daily(feed, msg, as_of, strict, demographics), table, day)


def load_changed(
    spark: SparkSession,
    path: str,
    table: str,
    as_of: dt.date | str,
    first_day: dt.date | str | None = None,
    strict: bool = False,
    demographics: DataFrame | None = None,
) -> list[dt.date]:
    """Load the days before ``as_of`` that files below ``path`` have touched since the last call.

    The first call loads every day from ``first_day`` on (or all); later ones those for which a file came,
    was written anew or went, however old the day is: late events change their own day's partition and no
    other. All of them are computed in one plan and published day by day, each in one step. Returns the
    days loaded; their list and the dates in it are all that reaches the driver.

    What was seen is recorded per file and day in a table beside the result (``<table>_files``), after the
    days are published. A call that fails records nothing, so the next one repeats its days; a file that
    comes while a call runs is new to the next one. Days from ``as_of`` on stay open until they are over.
    """
    today = as_date(as_of)
    events = read_events(spark, path)
    ensure_table(spark, table)
    book = f"{table}_files"
    due = F.col("day") < F.lit(today)
    if first_day is not None:
        due = due & (F.col("day") >= F.lit(as_date(first_day)))
    with materialized(file_versions(spark, path)) as files, materialized(touched(events, files, ledger(spark, book))) as rows:
        days = sorted(r["day"] for r in stale_days(rows).where(due).collect())
        if days:
            feed, msg = feed_actions(events), message_actions(events)
            load_days(rollup_of_days(feed, msg, days, strict, demographics).select(*RESULT_SCHEMA.fieldNames()), table, days)
        record(rows, book, due)
    return days
