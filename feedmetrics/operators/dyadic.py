"""Histograms in one scan: bins whose width doubles when a value lies outside."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MANTISSA = 52


def exponent(low: float, high: float, bins: int) -> int:
    """The least e for which bins of width 2**e, from multiples of it on, cover ``low`` to ``high`` in ``bins`` steps.

    Not below the spacing of doubles as large as these, so that places of bins are exact integers.
    """
    e = max(math.frexp(low)[1], math.frexp(high)[1], -1021) - MANTISSA - 1
    while math.floor(math.ldexp(high, -e)) - math.floor(math.ldexp(low, -e)) >= bins:
        e += 1
    return e


class Bins:
    """Counts per group and bin, in as few bins of one width as hold all values so far."""

    def __init__(self, bins: int):
        self.bins, self.width, self.low, self.high = bins, None, math.inf, -math.inf
        self.counts: Counter = Counter()        # (group, place): rows

    def add(self, groups: list, values: np.ndarray) -> None:
        if not len(values):
            return
        low, high = min(self.low, values.min()), max(self.high, values.max())
        width = self.width
        if width is None or (low, high) != (self.low, self.high):
            width = exponent(low, high, self.bins)
            if self.width is not None and width > self.width:
                wider: Counter = Counter()
                for (group, place), n in self.counts.items():
                    wider[group, place >> (width - self.width)] += n
                self.counts = wider
            self.low, self.high, self.width = low, high, width
        places = np.floor(np.ldexp(values, -width)).astype(np.int64)
        self.counts.update(zip(groups, places.tolist()))


def _count(batches: Iterator[pa.RecordBatch], bins: int) -> Iterator[pa.RecordBatch]:
    held, odd, kind = Bins(bins), Counter(), None
    for batch in batches:
        kind = batch.schema.field(0).type
        values = batch.column(1).to_numpy(zero_copy_only=False)
        finite = np.isfinite(values)
        groups = batch.column(0)
        for group, value in zip(groups.filter(pa.array(~finite)).to_pylist(), values[~finite].tolist()):
            odd[group, "nan" if math.isnan(value) else value] += 1
        held.add(groups.filter(pa.array(finite)).to_pylist(), values[finite])
    if kind is None:
        return
    rows = [(g, held.width, p, None, n, held.low, held.high) for (g, p), n in held.counts.items()]
    rows += [(g, None, None, math.nan if v == "nan" else v, n, None, None) for (g, v), n in odd.items()]
    names = ["by", "width", "place", "odd", "n", "low", "high"]
    types = [kind, pa.int32(), pa.int64(), pa.float64(), pa.int64(), pa.float64(), pa.float64()]
    columns = list(zip(*rows)) or [()] * len(names)
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def histogram_one_scan(df: DataFrame, column: str, by: str | None = None, bins: int = 20) -> DataFrame:
    """Counts per bin, without looking for the extremes first: (by,) bin_lo, bin_hi, n. Empty bins have no row.

    Bins are 2**e wide and begin at multiples of that, with the least e for which at most ``bins`` of them
    cover all values; a bin holds its lower edge and not its upper one. Groups share the edges. Each task
    counts in bins of its own, doubles their width when a value lies outside, and sends a few rows; bins of
    different tasks differ by a shift. The result is that of binning with the extremes known, and no value
    moves: what counts as one bin at the end was one bin, or parts of it, all along.

    NULLs are left out. NaN and infinite values have bins of their own with that value as both edges.
    """
    group = F.col(f"`{by}`") if by else F.lit(None).cast("string")
    values = df.where(F.col(column).isNotNull()).select(group.alias("by"), F.col(column).cast("double").alias("value"))
    kind = values.schema["by"].dataType.simpleString()
    parts = values.mapInArrow(
        lambda it: _count(it, bins), f"by {kind}, width int, place bigint, odd double, n bigint, low double, high double")
    # What tasks sent, summed per width and place: a few rows for each width that any task ended with.
    summed = parts.groupBy("by", "width", "place", "odd").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
    all_ = Window.partitionBy(F.lit(0))
    known = summed.select("*", *[
        f.over(all_).alias(n) for f, n in ((F.max("width"), "least"), (F.min("low"), "first"), (F.max("high"), "last"))])

    def place_of(edge: str, e):
        return F.floor(F.col(edge) / F.pow(F.lit(2.0), e.cast("double")))

    # The range of all tasks may ask for wider bins than any one of them had.
    most = F.greatest(F.col("least"), F.ceil(F.log2(F.greatest(F.col("last") - F.col("first"), F.lit(1e-300)))).cast("int") + 2)
    fits = F.filter(F.sequence("least", most), lambda e: place_of("last", e) - place_of("first", e) < bins)
    wide = known.withColumn("wide", F.get(fits, F.lit(0)))
    moved = F.call_function("shiftright", F.col("place"), F.col("wide") - F.col("width"))
    edge = F.pow(F.lit(2.0), F.col("wide").cast("double"))
    counted = wide.withColumn("place", moved).groupBy("by", "wide", "place", "odd").agg(F.sum("n").alias("n"))
    return counted.select(
        *([F.col("by").alias(by)] if by else []),
        F.coalesce("odd", F.col("place") * edge).alias("bin_lo"),
        F.coalesce("odd", (F.col("place") + 1) * edge).alias("bin_hi"), "n")
