"""Cutting lineage through the cluster's shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ONE_MACHINE = re.compile(r"local(\[.*\])?")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where it is unset and driver and executors are one process on one machine, a temporary folder
    takes its place for the session. On a cluster a machine-local folder would lose the data with its
    machine, so there it must be set; a ``file:`` path is taken to be a mount that all machines share.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not ONE_MACHINE.fullmatch(spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="feedmetrics-"))
    return spark.sparkContext.getCheckpointDir()


def _fresh_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/feedmetrics/{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For a small derived table (one row per user, say) that several tests use: the events behind it
    are scanned once, and losing an executor does not bring that scan back. Parquet keeps column
    pruning for the readers. The files stay as long as a lazy result may need them; where the result
    is consumed in place, ``materialized`` removes them.
    """
    return _written(df, _fresh_path(df.sparkSession))


@contextmanager
def materialized(df: DataFrame) -> Iterator[DataFrame]:
    """``materialize`` for the length of a ``with`` block; the files go at its end."""
    spark = df.sparkSession
    path = _fresh_path(spark)
    try:
        yield _written(df, path)
    finally:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
