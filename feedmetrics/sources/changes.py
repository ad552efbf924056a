"""Which days of an event table were touched by files that came, changed or went since the last look."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .publish import publish_table

FILE = ["file_path", "file_size", "file_modification_time"]
LEDGER_SCHEMA = "file_path string, file_size bigint, file_modification_time timestamp, day date, loaded boolean"


def file_versions(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``: name, size and time of change. Listed, not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select(*[f"_metadata.{c}" for c in FILE])


def ledger(spark: SparkSession, table: str) -> DataFrame:
    """What was recorded by the last look: a row per file and day, whether the day's load is done."""
    return spark.table(table) if spark.catalog.tableExists(table) else spark.createDataFrame([], LEDGER_SCHEMA)


def touched(events: DataFrame, files: DataFrame, known: DataFrame, time: str = "ts") -> DataFrame:
    """The ledger brought up to date: ``known`` with the files of now, whose days are read where they are new.

    ``events`` is read from files (it has ``_metadata``), ``files`` lists those there are. A file is new if
    its name, size or time of change is; then its days are read from it, and files older than every new
    one are left out before anything is read. Rows of a file that changed or went are marked ``gone``: it
    no longer adds to the days it is on record with. A file without events has one row without a day.
    """
    new = files.join(known.select(*FILE).distinct(), FILE, "left_anti")
    since = new.agg(F.min("file_modification_time")).first()[0]
    rows = known.join(files, FILE, "left_semi").withColumn("gone", F.lit(False)).unionByName(
        known.join(files, FILE, "left_anti").withColumns({"loaded": F.lit(False), "gone": F.lit(True)}))
    if since is None:
        return rows
    days = events.where(F.col("_metadata.file_modification_time") >= F.lit(since)).select(
        *[F.col(f"_metadata.{c}").alias(c) for c in FILE], F.to_date(time).alias("day")).distinct()
    return rows.unionByName(new.join(days, FILE, "left").withColumns({"loaded": F.lit(False), "gone": F.lit(False)}))


def stale_days(rows: DataFrame) -> DataFrame:
    """Distinct days of ``touched`` whose loads are not up to date."""
    return rows.where("NOT loaded AND day IS NOT NULL").select("day").distinct()


def record(rows: DataFrame, table: str, loaded: Column) -> None:
    """Make ``rows`` the ledger; ``loaded`` is a condition on ``day`` that says which days are done now.

    Files that went stay on record until each of their days is loaded again.
    """
    done = F.col("day").isNull() | loaded
    kept = rows.where(~F.col("gone") | ~done)
    publish_table(kept.select(*FILE, "day", (F.col("loaded") | done).alias("loaded")), table)
