"""The daily result table: created once, then loaded one ``event_date`` partition at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from contextlib import ExitStack

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import DAY_PARTITION, as_date
from .publish import VERSIONS, Version, delete_folder, move_folder, publish_partitions, table_location

RESULT_SCHEMA = T.StructType([
    T.StructField(DAY_PARTITION, T.DateType()),
    T.StructField("dimension", T.StringType()),
    T.StructField("dimension_value", T.StringType()),
    T.StructField("views", T.LongType()),
    T.StructField("likes", T.LongType()),
    T.StructField("messages_received", T.LongType()),
    T.StructField("messages_sent", T.LongType()),
    T.StructField("users_received", T.LongType()),
    T.StructField("users_sent", T.LongType()),
])


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType = RESULT_SCHEMA,
    partition_by: str = DAY_PARTITION,
) -> None:
    """Create the Parquet table, partitioned by day, unless it exists."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({partition_by})"
    )


def load_result(df: DataFrame, table: str, day: dt.date | str) -> None:
    """Write ``df`` into ``table`` by column name as its partition ``day``, in place of what is there.

    A rerun of a day leaves one copy of that day, an empty rerun none; other days are not touched. A
    row of another day raises. The day changes in one step when all of it is written: a load that fails
    leaves the old rows, and readers never see a part. Loads of different days can run at the same
    time; of several loads of one day the one that started last counts. No session setting is involved.
    """
    load_days(df, table, [as_date(day)])


def load_days(df: DataFrame, table: str, days: Sequence[dt.date | str]) -> list[dt.date]:
    """``load_result`` for several days, written by one job; returns the days that changed.

    Every day of ``days`` is replaced, also by nothing; a row of any other day raises before one of them
    changes. Each day is published by itself, so a reader may see some days before others.
    """
    spark = df.sparkSession
    wanted = sorted({as_date(d) for d in days})
    if not wanted:
        return []
    schema = spark.table(table).schema
    among = f"day than {wanted[0]}" if len(wanted) == 1 else f"day than those from {wanted[0]} to {wanted[-1]}"
    of_days = F.assert_true(df[DAY_PARTITION].isin(wanted), F.lit(f"a row of another {among}"))
    rows = df.where(of_days.isNull()).select(*[df[f.name].cast(f.dataType) for f in schema])
    root = f"{table_location(spark, table)}/{VERSIONS}"
    with ExitStack() as loads:
        versions = {d: loads.enter_context(Version(spark, f"{root}/{d}")) for d in wanted}
        if len(wanted) == 1:
            staged = [versions[wanted[0]].path]
            rows.drop(DAY_PARTITION).write.parquet(staged[0])
        else:
            # One job writes all days; each day's folder then moves to its own place.
            with Version(spark, f"{root}/several") as several:
                rows.repartition(DAY_PARTITION).write.partitionBy(DAY_PARTITION).parquet(several.path)
                for d, version in versions.items():
                    move_folder(spark, f"{several.path}/{DAY_PARTITION}={d}", version.path)
                delete_folder(spark, several.path)
        changed = publish_partitions(table, DAY_PARTITION, {str(d): (v, v.path) for d, v in versions.items()})
    return [as_date(d) for d in changed]
