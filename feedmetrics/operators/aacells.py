"""A/A samples without sampled rows: how many users of each metric value a sample holds.

A sample drawn without replacement is, for its moments, a count per distinct value. Such counts are drawn
down a binary tree over the values of a group, in their order: how many of a node's sample fall on the
users of its left half is one hypergeometric draw, and halves that get nobody are not entered. Work per
replicate is at most the distinct values, and at most the sample times the depth of the tree.

The tree is cut into blocks. Its top is drawn for slices of the replicates, which gives the size of every
replicate's sample in each block; a block and its replicates then meet in one place, whatever the number
of users, values or replicates beyond it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .resample import _FIRST, _GOLDEN, _SECOND, SEED_DIGITS, _at_least_one
from .stats import with_t_test

BLOCK_BITS = 12         # distinct values of a block, as a power of two
SLICES = 32             # tasks that draw the top of the tree
RANGES = 64             # tasks that number the values of a group
CELLS_AT_ONCE = 2_000_000


def node_uniforms(group: str, level: int, nodes: np.ndarray, replicates: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) of 52 bits for each node of a level and replicate: splitmix64 from a hash of the node."""
    names, place = np.unique(nodes, return_inverse=True)
    keys = [int(hashlib.md5(f"{group}:{level}:{n}:{seed}".encode()).hexdigest()[:SEED_DIGITS], 16) for n in names.tolist()]
    z = np.array(keys, np.uint64)[place] + replicates.astype(np.uint64) * _GOLDEN
    z = (z ^ (z >> np.uint64(30))) * _FIRST
    z = (z ^ (z >> np.uint64(27))) * _SECOND
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) / 2.0**52


def hypergeometric_quantiles(total: np.ndarray, left: np.ndarray, drawn: np.ndarray, u: np.ndarray) -> np.ndarray:
    """How many of ``drawn`` out of ``total`` are among the first ``left``: the quantile at each ``u``.

    Masses go from 15 deviations below the mean to as many above, each by its ratio to the one before.
    """
    low, high = np.maximum(0, drawn - (total - left)), np.minimum(drawn, left)
    share = left / total
    mean = drawn * share
    spread = np.sqrt(np.maximum(mean * (1 - share) * (total - drawn) / np.maximum(total - 1, 1), 0))
    first = np.maximum(low, np.floor(mean - 15 * spread - 60).astype(np.int64))
    width = np.minimum(high, np.ceil(mean + 15 * spread + 60).astype(np.int64)) - first + 1
    out = first.copy()
    for size in np.unique(1 << np.ceil(np.log2(np.maximum(width, 1))).astype(np.int64)).tolist():
        rows = np.flatnonzero((width > size // 2) & (width <= size)) if size > 1 else np.zeros(0, np.int64)
        step = max(1, CELLS_AT_ONCE // size)
        for part in (rows[i: i + step] for i in range(0, len(rows), step)):
            x = first[part, None] + np.arange(size - 1)
            inside = np.arange(size - 1) < width[part, None] - 1
            gone = (left[part, None] - x) * (drawn[part, None] - x).astype(float)
            come = (x + 1.0) * (total[part, None] - left[part, None] - drawn[part, None] + x + 1)
            ratio = np.log(np.where(inside, gone, 1.0)) - np.log(np.where(inside, come, 1.0))
            mass = np.concatenate([np.zeros((len(part), 1)), np.cumsum(np.where(inside, ratio, -np.inf), axis=1)], axis=1)
            cumulated = np.cumsum(np.exp(mass - mass.max(axis=1, keepdims=True)), axis=1)
            below = (cumulated <= u[part, None] * cumulated[:, -1:]) & (np.arange(size) < width[part, None] - 1)
            out[part] += below.sum(axis=1)
    return out


def descend(group: str, sizes: np.ndarray, top: int, first: int, bits: int, replicates: np.ndarray, drawn: np.ndarray, seed: int):
    """Draws from one node down ``bits`` levels: (leaf, replicate, count) of the leaves that get anybody.

    ``sizes`` are the users of the leaves, ``top`` and ``first`` the node's level and place in it.
    """
    ends = np.concatenate([[0], np.cumsum(sizes)])
    nodes = np.zeros(len(replicates), np.int64)
    for level in range(bits):
        span = 1 << (bits - level)
        start, middle, stop = (np.minimum(nodes * span + s, len(sizes)) for s in (0, span // 2, span))
        u = node_uniforms(group, top + level, (first << level) + nodes, replicates, seed)
        left = hypergeometric_quantiles(ends[stop] - ends[start], ends[middle] - ends[start], drawn, u)
        nodes, replicates = np.concatenate([2 * nodes, 2 * nodes + 1]), np.concatenate([replicates, replicates])
        drawn = np.concatenate([left, drawn - left])
        some = drawn > 0
        nodes, replicates, drawn = nodes[some], replicates[some], drawn[some]
    return nodes, replicates, drawn


def numbered_values(pool: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``exp_group, metric, n, number, bits``: distinct values counted, and numbered from 0 in their order.

    Values are cut into ranges at approximate quantiles, numbered within their range and shifted by the
    values of lower ranges; the cuts do not affect the numbers. ``bits`` is the depth of the group's tree.
    """
    counted = pool.groupBy("exp_group", "metric").agg(F.count("*").alias("n"))
    fractions = [(i + 1) / ranges for i in range(ranges - 1)]
    cuts = pool.agg(F.percentile_approx("metric", fractions).alias("cuts")).scalar()
    placed = counted.withColumn("cuts", cuts).withColumn(
        "range", F.size(F.filter("cuts", lambda c: c < F.col("metric")))).drop("cuts")
    per_range = placed.groupBy("exp_group", "range").agg(F.count("*").alias("values"))
    lower = Window.partitionBy("exp_group").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("exp_group")
    shifts = per_range.select(
        "exp_group", "range", F.coalesce(F.sum("values").over(lower), F.lit(0)).alias("shift"),
        F.ceil(F.log2(F.sum("values").over(whole).cast("double"))).cast("int").alias("bits"))
    within = Window.partitionBy("exp_group", "range").orderBy("metric")
    return placed.withColumn("rank", F.row_number().over(within)).join(shifts, ["exp_group", "range"]).select(
        "exp_group", "metric", "n", (F.col("shift") + F.col("rank") - 1).alias("number"), "bits")


def aa_moments(
    users: DataFrame, metric: str = "ctr", groups: tuple = (2, 3), sample_size: int = 500, n_exp: int = 10_000,
    seed: int = 42, block_bits: int = BLOCK_BITS, slices: int = SLICES,
) -> DataFrame:
    """Count, mean and variance of samples without replacement: replicate, n1, mean1, var1, n2, mean2, var2.

    ``sample_size`` users per replicate and group, as in ``aa_samples``, by other draws of the same chances.
    Users without the metric are not sampled; a group with fewer users than a sample raises. A sample of
    one has no variance. ``block_bits`` and ``slices`` spread the work and change no result. ``users`` is
    read several times; pass a materialized table.
    """
    _at_least_one(sample_size=sample_size, n_exp=n_exp, slices=slices)
    pool = users.where(F.col("exp_group").isin(*groups) & F.col(metric).isNotNull()).select(
        F.col("exp_group").cast("string").alias("exp_group"), F.col(metric).cast("double").alias("metric"))
    # Sums are taken from the group's mean on, so that large values with small differences keep them.
    means = pool.groupBy("exp_group").agg(F.avg("metric").alias("pivot"))
    values = numbered_values(pool).withColumn("block", F.shiftright("number", block_bits))
    deep = F.greatest(F.col("bits") - block_bits, F.lit(0))
    totals = values.groupBy("exp_group", "block").agg(F.sum("n").alias("size"), F.first("bits").alias("bits")).select(
        "exp_group", "block", "size", deep.alias("deep"), F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"))
    replicates = users.sparkSession.range(n_exp).select(
        F.col("id").cast("int").alias("replicate"), F.pmod("id", F.lit(slices)).cast("int").alias("slice"),
        F.explode(F.array(*[F.lit(str(g)) for g in groups])).alias("exp_group"))

    def named(key: tuple, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), key[0], object)


    def from_the_top(key: tuple, asked: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        sizes = blocks.sort_values("block")["size"].to_numpy(np.int64)
        if len(asked) and sizes.sum() < sample_size:
            raise ValueError(f"group {key[0]} has {sizes.sum()} users, fewer than a sample of {sample_size}")
        if not len(asked):
            return pd.DataFrame(columns=["exp_group", "block", "replicate", "drawn"])
        drawn = np.full(len(asked), sample_size, np.int64)
        block, replicate, drawn = descend(
            key[0], sizes, 0, 0, int(blocks["deep"].iloc[0]), asked["replicate"].to_numpy(), drawn, seed)
        return pd.DataFrame({"exp_group": named(key, block), "block": block, "replicate": replicate, "drawn": drawn})

    def in_the_block(key: tuple, asked: pd.DataFrame, cells: pd.DataFrame) -> pd.DataFrame:
        if not len(asked):
            return pd.DataFrame(columns=["exp_group", "replicate", "n", "s1", "s2"])
        cells = cells.sort_values("number")
        bits = int(cells["bits"].iloc[0])
        above = max(bits - block_bits, 0)
        cell, replicate, drawn = descend(
            key[0], cells["n"].to_numpy(np.int64), above, int(key[1]), bits - above, asked["replicate"].to_numpy(),
            asked["drawn"].to_numpy(np.int64), seed)
        x = (cells["metric"] - cells["pivot"]).to_numpy()[cell]
        names, place = np.unique(replicate, return_inverse=True)
        sums = [np.bincount(place, weights=w, minlength=len(names)) for w in (drawn, drawn * x, drawn * x * x)]
        return pd.DataFrame({"exp_group": named(key, names), "replicate": names, "n": sums[0].astype(np.int64), "s1": sums[1], "s2": sums[2]})

    asked = replicates.groupBy("exp_group", "slice").cogroup(totals.groupBy("exp_group", "slice")).applyInPandas(
        from_the_top, "exp_group string, block bigint, replicate int, drawn bigint")
    cells = values.join(F.broadcast(means), "exp_group")        # one row per requested group
    parts = asked.groupBy("exp_group", "block").cogroup(cells.groupBy("exp_group", "block")).applyInPandas(
        in_the_block, "exp_group string, replicate int, n bigint, s1 double, s2 double")

    per_group = parts.groupBy("replicate", "exp_group").agg(F.sum("n").alias("n"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2")).join(
        F.broadcast(means), "exp_group").select(
            "replicate", "exp_group", "n", (F.col("pivot") + F.col("s1") / F.col("n")).alias("mean"),
            (F.greatest(F.col("s2") - F.col("s1") * F.col("s1") / F.col("n"), F.lit(0.0)) / F.nullif(F.col("n") - 1, F.lit(0))).alias("var"))
    return per_group.groupBy("replicate").agg(*[
        F.max(F.when(F.col("exp_group") == str(g), F.col(name))).alias(f"{name}{i}")
        for i, g in enumerate(groups, start=1) for name in ("n", "mean", "var")])


def aa_pvalues_of(moments: DataFrame) -> DataFrame:
    """Pooled t-test of the two samples of each replicate of ``aa_moments``: replicate, t, df, p_value."""
    return with_t_test(moments, equal_var=True).select("replicate", "t", "df", "p_value")
