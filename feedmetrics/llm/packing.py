"""Best-fit packing of documents into training sequences of bounded length.

Documents are tokenized and cut where they lie; only the histogram of piece lengths (at most
``capacity`` rows) goes to the driver, which decides how many bins hold which lengths. Pieces of one
length are interchangeable, so a piece finds its bin by its rank among them, which follows from
counts per task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .configurations import GROUPS, Run, pack
from .shingles import chunks, released, slices
from .store import land, small_batches
from .tokens import WordTokens, pieces

CAPACITY = 2048
END_ID = 0                  # closes every document
_LENGTH_SHIFT = 44          # a piece's key: length, then rank


def vocabulary() -> str:
    """The place of the tokenizer on this machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cut(batches: Iterator[pa.RecordBatch], path, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    tokens = WordTokens(path())
    seen: Counter[int] = Counter()
    task = TaskContext.get().partitionId()
    for batch in slices(batches):
        keys, texts = batch.column(0), batch.column(1).to_pylist()
        for a, b in chunks(texts):
            owner, piece, start, length, crc, rank, content = [], [], [], [], [], [], []
            for i, own in zip(range(a, b), tokens.encode_all(texts[a:b])):
                ids = np.append(own, np.uint32(END_ID))
                for k, (at, part) in enumerate(pieces(ids, capacity)):
                    owner.append(i)
                    piece.append(k)
                    start.append(at)
                    length.append(len(part))
                    crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                    rank.append(seen[len(part)])
                    seen[len(part)] += 1
                    if with_ids:
                        content.append(part.astype(np.int32))
            columns = [
                keys.take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(owner), pa.int32()),
                pa.array(rank, pa.int64())]
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if with_ids:
                columns.append(pa.array(content, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def places(runs: list[Run]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, as intervals of rank sorted by length and rank.

    The piece of rank r in an interval goes to sequence ``sequence + r - rank`` at ``offset``.
    """
    key, sequence, offset = [], [], []
    used: Counter[int] = Counter()
    first = 0
    for run in runs:
        at = 0
        for s in run.lengths:
            key.append(s << _LENGTH_SHIFT | used[s])
            sequence.append(first)
            offset.append(at)
            used[s] += run.bins
            at += s
        first += run.bins
    order = np.argsort(np.array(key, np.int64))
    return {"key": np.array(key, np.int64)[order], "sequence": np.array(sequence, np.int64)[order],
            "offset": np.array(offset, np.int64)[order]}


def _place(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    where = sent.value
    for batch in batches:
        names = batch.schema.names
        key = batch.column(names.index("length")).to_numpy() << _LENGTH_SHIFT | batch.column(names.index("rank")).to_numpy()
        at = np.searchsorted(where["key"], key, side="right") - 1
        kept = [n for n in names if n != "rank"]
        yield pa.RecordBatch.from_arrays(
            [batch.column(names.index(n)) for n in kept]
            + [pa.array(where["sequence"][at] + key - where["key"][at]), pa.array(where["offset"][at])],
            names=[*kept, "sequence_id", "offset"])


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    tokenizer=vocabulary, groups: int = GROUPS, with_ids: bool = False,
) -> DataFrame:
    """Pieces of all documents and their places: ``id, piece, start, length, ids_crc32, sequence_id, offset``.

    A document is its token ids and a closing id; only those longer than ``capacity`` are cut.
    Sequences hold at most ``capacity`` ids without gaps. ``with_ids`` adds the ids of each piece.
    ``tokenizer`` gives the path of the vocabulary where it is called, on each executor.

    Null and empty texts are the closing id alone. Rows that repeat an id, and null ids, are packed
    like any other. Ties in length go by the order in which the pieces are read; an empty table gives
    an empty result. Other columns are not read.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    ids = ", ids array<int>" if with_ids else ""
    cut = land(rows.mapInArrow(
        lambda it: released(_cut(it, tokenizer, capacity, with_ids)),
        f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, task int, rank bigint{ids}"), "pieces")

    per_task = cut.groupBy("task", "length").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    base = land(per_task.withColumn("base", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "piece-counts")
    counts = {r["length"]: r["n"] for r in base.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    sent = spark.sparkContext.broadcast(places(pack(counts, capacity, groups)))

    names = [c for c in cut.columns if c not in ("task", "rank")]
    ranked = cut.join(base.select("task", "length", "base"), ["task", "length"]).select(
        *names, (F.col("base") + F.col("rank")).alias("rank"))
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.select(*names).schema)
    return ranked.mapInArrow(lambda it: released(_place(it, sent)), f"{out}, sequence_id bigint, offset bigint")
