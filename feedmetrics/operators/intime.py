"""What was known of a user at the time of an event: the last of the rows that came before it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def attributes_in_time(
    events: DataFrame, history: DataFrame, attributes: Sequence[str], key: str = "user_id", time: str = "time", grain: str = "hour",
) -> DataFrame:
    """``events`` with the attributes that their ``key`` had at their ``time``.

    ``history`` holds ``key, time`` and the attributes from that time on, all of them per row; a row counts
    for events of the same instant. Of several rows of one instant the largest counts (NULL first, attribute
    by attribute). Events before the first row, and of keys without one, get NULLs. NULL keys have no
    attributes; history without a time is left out, an event without one knows nothing.

    Both sides are laid into one sequence per key and cut at every ``grain`` of time. Inside a cut a row
    takes the last history row before it; what a cut begins with comes from one row per cut. So a key with
    a third of all events spreads over its cuts, and no event meets more than one row of history.
    """
    names = list(attributes)
    cut = F.date_trunc(grain, F.col(time)).alias("__cut")
    kinds = {f.name: f.dataType for f in history.schema}
    said = events.select("*", cut, F.lit(None).cast(history.select(F.struct(*names)).schema[0].dataType).alias("__known"))
    known = history.where(F.col(key).isNotNull() & F.col(time).isNotNull()).groupBy(key, time).agg(
        F.max(F.struct(*names)).alias("__known")).select(key, time, cut, "__known")
    rows = said.withColumn("__event", F.lit(True)).unionByName(known.withColumn("__event", F.lit(False)), allowMissingColumns=True)

    # false sorts before true: history of an instant comes before its events.
    inside = Window.partitionBy(key, "__cut").orderBy(time, "__event").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.withColumn("__last", F.last("__known", ignorenulls=True).over(inside)).where("__event")

    # One row per key and cut: the last history in it, and then what each cut begins with.
    cuts = (
        known.groupBy(key, "__cut").agg(F.max_by("__known", time).alias("__known"))
        .unionByName(events.select(key, cut).distinct(), allowMissingColumns=True)
        .groupBy(key, "__cut").agg(F.first("__known", ignorenulls=True).alias("__known"))
    )
    before = Window.partitionBy(key).orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
    begins = cuts.withColumn("__begin", F.last("__known", ignorenulls=True).over(before)).select(key, "__cut", "__begin")
    whole = placed.join(begins, [key, "__cut"], "left").withColumn("__last", F.coalesce("__last", "__begin"))
    return whole.select(
        *[F.col(f"`{c}`") for c in events.columns if c not in names],
        *[F.col("__last")[n].cast(kinds[n]).alias(n) for n in names])
