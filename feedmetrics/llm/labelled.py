"""Labelled samples for the classifiers, and the folds that keep held-out rows away from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import land

SAMPLE_ROWS = 20_000        # labelled rows a classifier is fitted on, at most


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def held_out(id_col: Column, folds: int, out: int) -> Column:
    """Whether a row's label must not be learned from; a row without an id is not held out."""
    return F.coalesce(fold(id_col, folds) == out, F.lit(False))


def hashed_sample(df: DataFrame, key: str, rows: int, total: int) -> DataFrame:
    """One row for each of the ``rows`` values of ``key`` of lowest hash, of about ``total``; all if there are fewer.

    Rows that cannot be among them are left out where they lie, so that what is sorted in one task is a
    little more than the sample, however large the table.
    """
    steps = 1 << 40
    bound = int(steps * (rows + 6 * rows**0.5 + 50) / max(total, 1))
    place = F.pmod(F.xxhash64(key), F.lit(steps))
    near = df.filter(place < bound) if bound < steps else df
    return near.dropDuplicates([key]).orderBy(place, key).limit(rows)


def distinct_texts(df: DataFrame, key: str) -> int:
    """How many distinct values ``key`` has, by their hash; only hashes are shuffled."""
    return df.select(F.xxhash64(key).alias("hash")).distinct().count()


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, folds: int, out: int,
    id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``id, text, label, part`` of at most ``rows`` labelled documents outside the held-out fold.

    Rows are taken by a hash of their id, so the sample depends on the ids alone. Null labels and
    ids are left out; of several labels for one id the largest counts, of several texts the first by
    order. ``part`` is 0..9 by hash.
    """
    key, label = F.col(f"`{id_col}`"), F.col(f"`{label_col}`")
    known = (
        labels.filter(key.isNotNull() & label.isNotNull() & (fold(key, folds) != out))
        .groupBy(key.alias("id")).agg(F.max(label).cast("int").alias("label"))
    )
    taken = hashed_sample(known, "id", rows, known.count())
    texts = docs.select(key.alias("id"), F.col(f"`{text_col}`").alias("text"))
    part = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(10)).cast("int")
    sample = texts.join(F.broadcast(taken), "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return land(sample.withColumn("part", part), f"{label_col}-sample")
