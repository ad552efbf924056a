"""Benchmark passages inside documents, by a prefix-filtered set join.

Every window of an item (ten consecutive words) has to occur in full, so of its words, ordered by
how rare they are in the documents, the first alone is a sufficient prefix: a document can hold the
window only where it holds that word. Document words are joined with these prefix words; positions
and lengths bound where the window would lie, and the words there are compared one by one.

All of it is DataFrame code.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import BROADCAST_ROWS, land, numbered, small_enough, without

WINDOW = 10
WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"      # fixed by the contract, after lower-casing A-Z
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOWS_PER_BLOCK = 200_000     # each about 200 bytes; more windows are joined block by block
ROW = "__row"


def words(text: Column) -> Column:
    """The words of ``text`` as an array; null and wordless texts have none."""
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(lowered, WORD_BREAK), "")


def item_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``item, window array<string>``: each distinct run of ``window`` words of an item.

    A shorter item is one window; one without words has none.
    """
    items = benchmark.select(F.col(f"`{id_col}`").alias("item"), words(F.col(f"`{text_col}`")).alias("w")).filter("size(w) > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))
    return items.select("item", F.explode(F.transform(starts, lambda s: F.slice("w", s, window))).alias("window")).distinct()


def _rarity(docs: DataFrame, windows: DataFrame, text_col: str) -> DataFrame:
    """``word, n``: how often each word of the windows occurs in all documents."""
    vocabulary = land(windows.select(F.explode("window").alias("word")).distinct(), "item-words")
    if small_enough(vocabulary):
        vocabulary = F.broadcast(vocabulary)
    seen = docs.select(F.explode(words(F.col(f"`{text_col}`"))).alias("word"))
    return seen.join(vocabulary, "word").groupBy("word").agg(F.count("*").alias("n"))


def _owned(windows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``owner, window`` per distinct window, and ``owner, items`` per distinct list of items that share windows, landed.

    However many items hold a passage, it is looked for once, and a document that holds it names one owner.
    A null item id is in no list.
    """
    lists = land(windows.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items")), "window-items")
    owners = land(lists.select("items").distinct().withColumn("owner", F.monotonically_increasing_id()), "window-owners")
    return land(lists.join(owners, "items").select("owner", "window"), "owned-windows"), owners


def prefix_table(windows: DataFrame, rarity: DataFrame) -> DataFrame:
    """``prefix, lead, owner, window``: the rarest word of each window and its place there.

    Words that occur nowhere are rarest; ties go to the first in the window.
    """
    rarity = F.broadcast(rarity) if small_enough(rarity) else rarity
    places = windows.select("owner", "window", F.posexplode("window").alias("lead", "word"))
    ranked = places.join(rarity, "word", "left").groupBy("owner", "window").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "lead", "word")).alias("rarest"))
    return ranked.select(F.col("rarest.word").alias("prefix"), F.col("rarest.lead").alias("lead"), "owner", "window")


def _matches(rows: DataFrame, prefixes: DataFrame) -> DataFrame:
    """``__row, id, n_words, span, owner`` per window found, and one row without owner per document.

    The documents' own rows come through the same join, by a closing empty word that the prefix
    table holds too: texts are read and split once.
    """
    closing = prefixes.sparkSession.range(1).select(
        F.lit("").alias("prefix"), F.lit(0).alias("lead"), F.lit(None).cast("bigint").alias("owner"),
        F.lit(None).cast("array<string>").alias("window"))
    table = F.broadcast(prefixes.unionByName(closing))
    places = rows.select(ROW, "id", "w", F.posexplode(F.concat("w", F.array(F.lit("")))).alias("place", "word"))
    start = F.col("place") - F.col("lead")
    there = (
        F.col("window").isNull()
        | (start >= 0) & (start + F.size("window") <= F.size("w"))
        & (F.slice("w", F.greatest(start, F.lit(0)) + 1, F.size("window")) == F.col("window"))
    )
    return places.join(table, (F.col("word") == F.col("prefix")) & there).select(
        ROW, "id", F.size("w").alias("n_words"),
        F.when(F.col("window").isNotNull(), F.struct(start.alias("start"), (start + F.size("window")).alias("stop"))).alias("span"),
        "owner")


def find_items(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    row_col: str | None = None,
    windows_per_block: int = WINDOWS_PER_BLOCK,
) -> DataFrame:
    """Per document: ``id, n_words, spans, items, __row``.

    ``spans`` are the places ``[start, stop)`` of windows, ``items`` the distinct ids of the items
    that own them. A document without words, or a null one, has none; an empty benchmark hits
    nothing; items that repeat text all count. A null item id is found like any other, but not listed.
    Rows that repeat an id stay apart (``__row``). Other columns are not read.

    Windows are broadcast in blocks of at most ``windows_per_block``, however long the benchmark. Long texts
    are searched whole, with a row for each place that a window is found at.
    """
    windows, owners = _owned(item_windows(benchmark, item_col, item_text_col, window))
    prefixes = land(prefix_table(windows, land(_rarity(docs, windows, text_col), "item-rarity")), "item-prefixes")
    number = F.col(f"`{row_col}`") if row_col else F.monotonically_increasing_id()
    rows = docs.select(number.alias(ROW), F.col(f"`{id_col}`").alias("id"), words(F.col(f"`{text_col}`")).alias("w"))
    blocks = max(1, -(-prefixes.count() // windows_per_block))
    if blocks > 1:
        rows = land(rows, "document-words")
    block = F.pmod(F.xxhash64("window"), F.lit(blocks))
    found = reduce(DataFrame.unionByName, [
        _matches(rows, prefixes.filter(block == b) if blocks > 1 else prefixes) for b in range(blocks)])
    per_row = found.groupBy(ROW).agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"),
        F.sort_array(F.collect_set("span")).alias("spans"), F.collect_set("owner").alias("owners"))
    named = owners.agg(F.coalesce(F.sum(F.size("items")), F.lit(0)).alias("n")).first()["n"]
    owners = F.broadcast(owners) if named <= BROADCAST_ROWS else owners
    listed = per_row.select(ROW, "id", "n_words", "spans", F.explode_outer("owners").alias("owner")).join(owners, "owner", "left")
    return listed.groupBy(ROW).agg(
        F.first("id").alias("id"), F.max("n_words").alias("n_words"), F.first("spans").alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))


def covered(spans: Column) -> Column:
    """How many places lie in at least one of the sorted ``spans``."""
    step = F.aggregate(
        spans, F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["stop"] - F.greatest(s["start"], a["end"]), F.lit(0))).alias("n"),
            F.greatest(a["end"], s["stop"]).alias("end")))
    return step["n"]


def report(found: DataFrame) -> DataFrame:
    """The counts and the digest of item ids per document."""
    hits = covered(F.col("spans")).cast("bigint")
    names = F.array_join(F.array_sort(F.transform("items", lambda i: i.cast("string"))), ",")
    return found.select(
        F.col("id").alias("doc_id"), F.col("n_words").cast("bigint").alias("n_words"), hits.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"), F.sha2(names, 256).alias("items_sha256"),
        (hits > 0).alias("contaminated"))


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
) -> DataFrame:
    """``docs`` without the documents that hold a window of an item, all columns as they were.

    Null and empty texts hold none and stay; repeated rows and rows that repeat an id are judged one by one.
    An empty benchmark removes nothing, an empty table gives an empty result.
    """
    rows, row = numbered(docs, "decontamination-docs")
    found = find_items(rows, benchmark, id_col, text_col, window=window, row_col=row)
    gone = land(found.filter(F.size("spans") > 0).select(ROW), "contaminated")
    return without(rows, row, gone)
