"""Tables in the folder that driver and executors share, and size-checked broadcasts."""

from __future__ import annotations

import pickle
import uuid

from pyspark import cloudpickle
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.checkpoint import shared_dir

ARROW_ROWS_CONF, ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1000
BROADCAST_ROWS = 1_000_000      # narrow rows only: a few tens of bytes each


def small_batches(spark: SparkSession) -> None:
    """Fewer rows per Arrow batch, unless the session has a size of its own.

    Whole documents are large rows: the default of 10,000 would hold tens of megabytes twice per task.
    Results do not depend on it.
    """
    if spark.conf.get(ARROW_ROWS_CONF) == "10000":
        spark.conf.set(ARROW_ROWS_CONF, str(ARROW_ROWS))


def send(spark: SparkSession, value: object) -> Broadcast:
    """``value`` broadcast so that executors can open it without a copy of this package: its classes travel with it."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def opened(sent: Broadcast) -> object:
    """What ``send`` was given; worked out once per task."""
    return pickle.loads(sent.value)


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table, without Python on the executors.

    ``createDataFrame`` of a list, even an empty one, is read by Python workers, which have a daemon of
    their own beside that of ``mapInArrow`` and keep their memory after it.
    """
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new place below ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``docs`` landed with a unique row number, and the name of that column."""
    row = unused_name(docs, "__row")
    return land(docs.withColumn(row, F.monotonically_increasing_id()), name), row


def land(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    The plan behind it is cut: a lost executor costs the reading of a file, and columns such as
    ``monotonically_increasing_id`` are fixed for every later reader.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_enough(narrow: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a landed table of narrow rows may be broadcast."""
    return narrow.limit(rows + 1).count() <= rows


def drop_rows(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``df`` without the rows whose ``key`` is in the landed, one-column table ``keys``.

    Few keys are broadcast, so that wide rows stay where they are; beyond the checked bound the
    join shuffles.
    """
    keys = F.broadcast(keys) if small_enough(keys) else keys
    return df.join(keys, key, "left_anti")


def without(docs: DataFrame, row: str, gone: DataFrame) -> DataFrame:
    """Numbered ``docs`` less the rows listed in the landed table ``gone`` (one column), as they were."""
    kept = drop_rows(docs, gone.toDF(row), row)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns if c != row])
