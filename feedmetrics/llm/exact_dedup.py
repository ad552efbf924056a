"""Exact duplicates by a stateful stream over text digests.

A Structured Streaming aggregation keyed by digest keeps, in RocksDB and without expiry, the digest,
the identifier of the row that stays and the place where its content lies. Digests that were hit
again are checked on the full normalised text before they count as equal.

All of it is DataFrame code; Python runs on the driver only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import fresh_path, land, no_rows, numbered, small_enough, without

WHITE_SPACE = (" ", "\t", "\n", "\x0b", "\f", "\r")     # fixed by the contract: [\x20\x09-\x0D]
DIGEST_BYTES = 32
ROW = "__row"

# Settings of the stream's own session; the caller's session stays as it is.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",        # what lasts is on disk
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",      # many small stores
}
INHERITED_CONF = ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")


def normalised(text: Column) -> Column:
    """``text`` without white space; null counts as empty."""
    out = F.coalesce(text.cast("string"), F.lit(""))
    for c in WHITE_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _stream_session(spark: SparkSession) -> SparkSession:
    session = spark.newSession()
    for key in INHERITED_CONF:
        session.conf.set(key, spark.conf.get(key))
    for key, value in STREAM_CONF.items():
        session.conf.set(key, value)
    return session


def digest_state(log: DataFrame, log_path: str, files_per_trigger: int | None = None) -> DataFrame:
    """One row per digest of the landed log: ``digest, best, n``.

    ``log_path`` is read as a stream until nothing is left. ``best`` orders by most code points, then
    smallest identifier (null last), then first row, and carries the content locator. Each
    micro-batch writes the digests it changed; a repeated batch overwrites its own folder, so a
    restart gives the same rows. The newest version of each digest counts.
    """
    spark = log.sparkSession
    session = _stream_session(spark)
    out = fresh_path(spark, "digest-state")
    reader = session.readStream.schema(log.schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    state = reader.parquet(log_path).groupBy("digest").agg(
        F.min(_order("place")).alias("best"), F.count("*").alias("n"))
    no_rows(spark, state.schema).write.parquet(f"{out}/batch=-1")     # so that the folder exists

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (
        state.writeStream.outputMode("update").trigger(availableNow=True)
        .option("checkpointLocation", fresh_path(spark, "digest-stream"))
        .foreachBatch(save).start()
    )
    query.awaitTermination()
    versions = spark.read.schema(state.schema.add("batch", T.IntegerType())).parquet(out)
    newest = versions.groupBy("digest").agg(F.max_by(F.struct("best", "n"), "batch").alias("last"))
    return newest.select("digest", "last.best", "last.n")


def _collided(texts: DataFrame, state: DataFrame) -> DataFrame:
    """Digests that stand for more than one text, found by comparing the full texts of all hits.

    Texts are grouped before they are shuffled, so a group of copies arrives once per map task
    however large it is. Digests without a second row need no check; they are left out where the
    list of hits may be broadcast.
    """
    hits = land(state.filter("n > 1").select("digest"), "digest-hits")
    texts = texts.select("digest", "text")
    if small_enough(hits):
        texts = texts.join(F.broadcast(hits), "digest", "left_semi")
    distinct = texts.groupBy("digest", "text").agg(F.count("*").alias("n"))
    return distinct.groupBy("digest").agg(F.count("*").alias("texts")).filter("texts > 1").select("digest")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_col: str | None = None,
    digest_bytes: int = DIGEST_BYTES,
    files_per_trigger: int | None = None,
) -> DataFrame:
    """Which rows have equal texts, and which one of each group stays.

    Texts are equal when they are identical without white space. Of a group the row with the most
    code points in the original text stays, then the one with the smallest id.

    Returns a row per row of ``docs``: ``id, keep_id, group_size, kept, text_sha256, __row``.
    ``__row`` is ``row_col`` (a unique number fixed for every reading of ``docs``) or made here.

    Null and empty texts, and texts of white space only, are equal to one another. A null id is
    largest. Rows with the same id and text are counted one by one, and exactly one row of a group is
    kept. An empty table gives an empty result. Other columns are not read, whatever their names.

    ``digest_bytes`` shortens the state's key (for tests of collisions): the result is the same, as
    texts that share a digest are told apart by their bytes.
    """
    spark = docs.sparkSession
    number = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = docs.select(
        number.alias(ROW), F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.length(f"`{text_col}`"), F.lit(0)).cast("bigint").alias("n_chars"),
        normalised(F.col(f"`{text_col}`")).alias("text"),
    ).withColumn("sha", F.unhex(F.sha2("text", 256))).withColumn("digest", F.substring("sha", 1, digest_bytes))
    entries = rows.select(ROW, "id", "n_chars", F.input_file_name().alias("place"), "sha", "digest")
    path = fresh_path(spark, "digest-log")
    entries.write.parquet(path)
    log = spark.read.schema(entries.schema).parquet(path)

    state = land(digest_state(log, path, files_per_trigger), "digest-best")
    collided = land(_collided(rows, state), "digest-collided")
    # A large group of copies is one key here; the rows are narrow, and adaptive execution splits
    # the key on the log's side.
    equal = _verdicts(log.join(state, "digest"))
    if collided.isEmpty():
        return equal.drop("digest")
    mixed = land(rows.join(collided, "digest", "left_semi"), "digest-mixed")
    apart = mixed.groupBy("text").agg(F.min(_order()).alias("best"), F.count("*").alias("n"))
    told_apart = _verdicts(mixed.join(apart, "text"))
    return equal.join(collided, "digest", "left_anti").unionByName(told_apart).drop("digest")


def _order(*more: str) -> Column:
    """Smallest for the row that stays."""
    return F.struct((-F.col("n_chars")).alias("shortness"), F.col("id").isNull().alias("no_id"), "id", ROW, *more)


def _verdicts(joined: DataFrame) -> DataFrame:
    return joined.select(
        "digest", "id", F.col("best.id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col(ROW) == F.col(f"best.{ROW}")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), ROW)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns as they were.

    Nulls, ties and repeated rows are treated as in ``exact_dedup``.
    """
    rows, row = numbered(docs, "dedup-docs")
    gone = land(exact_dedup(rows, id_col, text_col, row).filter("NOT kept").select(ROW), "copies")
    return without(rows, row, gone)
