"""Resampling: Poisson bootstrap of pooled CTRs, and the A/A check of the user splitter.

Replicates are a column, so all of them run in one job. Every random number is a function of
(row key, replicate, seed): results do not depend on partitioning, and a lost task repeats the
same draws.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import FINE_DIGITS, md5_number, ratio, uniform
from .stats import moments, with_t_test

ROWS_PER_BLOCK = 1_000_000  # users numbered in one window
SEED_DIGITS = 15            # hex digits of a cell's seed: fits a bigint


def poisson_bounds() -> list[int]:
    """P(Poisson(1) <= k) in units of 16 ** -FINE_DIGITS, rounded up, for every k where it is below 1.

    A hash of that many hex digits is below bound k exactly if the draw is at most k; beyond the last
    bound no hash is left, so nothing is cut off.
    """
    bounds, k = [], 0
    while True:
        steps = [math.exp(-1.0) / math.factorial(i) for i in range(k + 1)]
        bound = math.ceil(math.fsum(steps) * 16**FINE_DIGITS)
        if bound >= 16**FINE_DIGITS:
            return bounds
        bounds.append(bound)
        k += 1


def poisson_weight(digest: Column) -> Column:
    """A Poisson(1) draw fixed by the md5 ``digest`` of a key: the quantile at its first 52 bits.

    Hex digits of equal length sort like their numbers, so the digest is compared with the bounds as
    text, which saves a number conversion for every user and replicate. Pass a column, not an
    expression: it is compared several times.
    """
    weight = None
    bounds = poisson_bounds()
    for k, bound in enumerate(bounds):
        below = digest < F.lit(f"{bound:0{FINE_DIGITS}x}")
        weight = F.when(below, k) if weight is None else weight.when(below, k)
    return weight.otherwise(len(bounds))


def _spread(df: DataFrame, *keys: str) -> DataFrame:
    """A table that is small in bytes but about to be multiplied, in as many slices as shuffles have.

    Adaptive execution sizes partitions by bytes and would leave such a table in one task; it keeps
    a number that is asked for. ``spark.sql.shuffle.partitions`` is what the session is sized for. The
    hash keeps a repartition by the keys the table was just grouped by from being dropped.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(slices, F.xxhash64(*keys))


def _at_least_one(**counts: int) -> None:
    for name, value in counts.items():
        if value < 1:
            raise ValueError(f"{name} must be at least 1, not {value}")


def poisson_bootstrap(
    users: DataFrame,
    n_boot: int = 10_000,
    groups: tuple = (1, 2),
    seed: int = 42,
    method: str = "cells",
) -> DataFrame:
    """Pooled CTR of both groups under Poisson(1) user weights: replicate, ctr1, ctr2.

    ``method="cells"`` (default) first counts users with equal (group, likes, views): the weights of
    n equal users add up to one Poisson(n) draw, so the work is distinct cells x replicates however
    many users there are. ``method="users"`` draws a weight for every user and replicate. All draws
    are quantiles at hashed numbers of 52 bits, which any engine can repeat. Both forms shuffle only
    sums per replicate.
    """
    _at_least_one(n_boot=n_boot)
    if method == "cells":
        sums = _bootstrap_cells(users, n_boot, groups, seed)
    elif method == "users":
        sums = _bootstrap_users(users, n_boot, groups, seed)
    else:
        raise ValueError(f"unknown method {method!r}")
    return sums.select(
        "replicate",
        ratio(F.col("likes1"), F.col("views1")).alias("ctr1"),
        ratio(F.col("likes2"), F.col("views2")).alias("ctr2"),
    )


def _bootstrap_users(users: DataFrame, n_boot: int, groups: tuple, seed: int) -> DataFrame:
    drawn = (
        _spread(users.where(F.col("exp_group").isin(*groups)), "user_id", "exp_group")
        .withColumn("user_key", F.concat_ws(":", F.col("user_id"), F.col("exp_group")))
        .select("exp_group", "likes", "views", "user_key", _replicates(n_boot))
        .withColumn("digest", F.md5(F.concat_ws(":", "user_key", F.col("replicate"), F.lit(seed))))
        .withColumn("w", poisson_weight(F.col("digest")))
    )

    def weighted(measure: str, group: int) -> Column:
        return F.sum(F.when(F.col("exp_group") == F.lit(group), F.col("w") * F.col(measure)).otherwise(0))

    return drawn.groupBy("replicate").agg(
        *[weighted(m, g).alias(f"{m}{i}") for i, g in enumerate(groups, start=1) for m in ("likes", "views")]
    )


_GOLDEN, _FIRST, _SECOND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def hashed_uniforms(seed: int, n_boot: int) -> np.ndarray:
    """Numbers in [0, 1) of 52 bits for replicates 0 … n_boot - 1: the splitmix64 sequence from ``seed``."""
    z = np.uint64(seed) + np.arange(n_boot, dtype=np.uint64) * _GOLDEN
    z = (z ^ (z >> np.uint64(30))) * _FIRST
    z = (z ^ (z >> np.uint64(27))) * _SECOND
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(12)).astype(np.float64) / 2.0**52


def poisson_quantiles(n: int, u: np.ndarray) -> np.ndarray:
    """The Poisson(n) quantile at every ``u``: how many k have a cumulated mass of at most ``u``.

    Masses are cumulated from 15 deviations below the mean, where less than 1e-45 lies, to 15 above,
    each by its ratio to the one before: no large numbers are taken from one another.
    """
    reach = 15 * math.sqrt(n) + 60
    k = np.arange(max(0, int(n - reach)), int(n + reach) + 1)
    steps = -np.log1p((k[1:] - n) / n)
    mass = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.exp(mass - mass.max())
    return k[0] + np.searchsorted(np.cumsum(mass / mass.sum()), u, side="right")


def _bootstrap_cells(users: DataFrame, n_boot: int, groups: tuple, seed: int) -> DataFrame:
    # The seed of a cell is a hash of its key, so its draws do not depend on other cells.
    key = F.concat_ws(":", "exp_group", "likes", "views", F.lit(seed))
    cells = (
        users.where(F.col("exp_group").isin(*groups))
        .groupBy("exp_group", "likes", "views")
        .agg(F.count("*").alias("n"))
        .select((F.col("exp_group") == F.lit(groups[0])).alias("in_first"), "likes", "views", "n",
                md5_number(key, SEED_DIGITS).alias("seed"))
    )

    def partial_sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((4, n_boot), dtype=np.int64)
        cells_seen = 0
        for batch in batches:
            cells_seen += len(batch)
            for n, equal in batch.groupby("n"):
                for first, likes, views, own in zip(equal["in_first"], equal["likes"], equal["views"], equal["seed"]):
                    w = poisson_quantiles(int(n), hashed_uniforms(int(own), n_boot))
                    row = 0 if first else 2
                    sums[row] += w * int(likes)
                    sums[row + 1] += w * int(views)
        if cells_seen:
            yield pd.DataFrame({
                "replicate": np.arange(n_boot, dtype=np.int32),
                "likes1": sums[0], "views1": sums[1], "likes2": sums[2], "views2": sums[3],
            })

    schema = "replicate int, likes1 bigint, views1 bigint, likes2 bigint, views2 bigint"
    return (
        _spread(cells, "seed")
        .mapInPandas(partial_sums, schema)
        .groupBy("replicate")
        .agg(*[F.sum(c).alias(c) for c in ("likes1", "views1", "likes2", "views2")])
    )


def bootstrap_diff(boot: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Mean and percentile interval of ctr2 - ctr1 over the replicates, and whether it touches 0."""
    diff = F.col("ctr2") - F.col("ctr1")
    return (
        boot.select(diff.alias("diff"))
        .agg(
            F.avg("diff").alias("mean_diff"),
            F.percentile("diff", alpha / 2).alias("ci_low"),
            F.percentile("diff", 1 - alpha / 2).alias("ci_high"),
            F.avg((F.col("diff") > 0).cast("double")).alias("share_positive"),
        )
        .withColumn("touches_zero", (F.col("ci_low") <= 0) & (F.col("ci_high") >= 0))
    )


def _replicates(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("replicate")


def aa_samples(
    users: DataFrame,
    metric: str = "ctr",
    groups: tuple = (2, 3),
    sample_size: int = 500,
    n_exp: int = 10_000,
    seed: int = 42,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Independent samples without replacement: ``sample_size`` users per replicate and group.

    Returns replicate, exp_group, user_id, metric. Users without the metric are not sampled; a group
    with fewer users than a sample raises.

    One rule for groups of every size: the users of a group are numbered, and each replicate deals
    ``sample_size`` of the numbers as a shuffled pack of cards would be dealt. Work grows with
    users + samples, not users x replicates. ``rows_per_block`` only decides how many tasks number
    the users. ``users`` is read several times; pass a materialized table.
    """
    _at_least_one(sample_size=sample_size, n_exp=n_exp, rows_per_block=rows_per_block)
    pool = users.where(F.col("exp_group").isin(*groups) & F.col(metric).isNotNull()).select(
        "user_id", "exp_group", F.col(metric).alias("metric")
    )
    spark = users.sparkSession
    kind = users.schema["exp_group"].dataType
    wanted = spark.range(1).select(F.explode(F.array(*[F.lit(g).cast(kind) for g in groups])).alias("exp_group"))
    sizes = wanted.join(pool.groupBy("exp_group").agg(F.count("*").alias("size")), "exp_group", "left")
    too_small = F.concat(
        F.lit("group "), F.col("exp_group").cast("string"), F.lit(" has "), F.coalesce("size", F.lit(0)).cast("string"),
        F.lit(f" users, fewer than a sample of {sample_size}"))
    sizes = sizes.withColumn("size", F.when(F.col("size") >= sample_size, F.col("size")).otherwise(F.raise_error(too_small).cast("bigint")))
    # One row per requested group is a bounded table.
    draws = spark.range(n_exp).select(
        F.col("id").cast("int").alias("replicate"), F.explode(F.array(*[F.lit(g).cast(kind) for g in groups])).alias("exp_group")
    ).join(F.broadcast(sizes), "exp_group")
    draw = F.sequence(F.lit(0), F.lit(sample_size - 1))

    def step(i: Column) -> Column:
        u = uniform(F.lit("draw"), F.col("exp_group"), F.col("replicate"), i, F.lit(seed), digits=FINE_DIGITS)
        return i + F.floor(u * (F.col("size") - i))

    dealt = draws.withColumn("swaps", F.transform(draw, step)).select(
        "replicate", "exp_group", F.explode(deal("swaps")).alias("number"))
    return dealt.join(numbered(pool, rows_per_block), ["exp_group", "number"]).select(
        "replicate", "exp_group", "user_id", "metric"
    )


@F.pandas_udf(T.ArrayType(T.LongType()))
def deal(swaps: pd.Series) -> pd.Series:
    """The first numbers of a pack 0, 1, 2, … after swapping place i with place ``swaps[i]`` >= i, in turn."""
    if not len(swaps):
        return pd.Series([], dtype=object)
    return pd.Series(list(dealt(np.stack(swaps.to_numpy()))))


def dealt(places: np.ndarray) -> np.ndarray:
    """``deal`` of many packs, a row each.

    A place drawn once, and beyond the places that are dealt from, holds its own number: all such draws
    are done at once. What is moved to another place is looked at draw by draw, in each row's order; of a
    large pack that is one draw in a few hundred.
    """
    rows, draws = places.shape
    order = np.argsort(places, axis=1, kind="stable")
    again = np.diff(np.take_along_axis(places, order, axis=1), axis=1) == 0
    some = np.zeros((rows, draws), bool)
    edge = np.zeros((rows, 1), bool)
    np.put_along_axis(some, order, np.hstack([again, edge]) | np.hstack([edge, again]), axis=1)
    out, moved, before = places.copy(), {}, -1
    where = np.nonzero(some | (places < draws))
    for row, i, p in zip(where[0].tolist(), where[1].tolist(), places[where].tolist()):
        if row != before:
            moved, before = {}, row
        out[row, i] = moved.get(p, p)
        moved[p] = moved.get(i, i)
    return out


def numbered(pool: DataFrame, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``pool`` with ``number`` = 0 … size - 1 per group, in the order of a hash of the user, then the user.

    Blocks are ranges of the hash with about ``rows_per_block`` users. Users are numbered within their
    block and shifted by the size of the blocks before it (one narrow row per block), so a group is
    never sorted in one task, and the number does not depend on the blocks.
    """
    place = md5_number(F.col("user_id"), FINE_DIGITS)
    blocks = pool.groupBy("exp_group").agg(F.ceil(F.count("*") / F.lit(rows_per_block)).alias("blocks"))
    out = pool.withColumn("place", place).join(F.broadcast(blocks), "exp_group").withColumn(
        "block", F.floor(F.col("place") * F.col("blocks") / F.lit(float(16**FINE_DIGITS))).cast("bigint"))
    block_sizes = out.groupBy("exp_group", "block").agg(F.count("*").alias("in_block"))
    before = Window.partitionBy("exp_group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = block_sizes.select(
        "exp_group", "block", F.coalesce(F.sum("in_block").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("exp_group", "block").orderBy("place", "user_id")
    return (
        out.withColumn("rank", F.row_number().over(within))
        .join(offsets, ["exp_group", "block"])
        .select("user_id", "exp_group", "metric", (F.col("offset") + F.col("rank") - 1).alias("number"))
    )


def aa_pvalues(samples: DataFrame, groups: tuple = (2, 3)) -> DataFrame:
    """Pooled t-test of the two samples of each replicate: replicate, t, df, p_value."""
    rows = samples.groupBy("replicate").agg(*moments("metric", groups))
    return with_t_test(rows, equal_var=True).select("replicate", "t", "df", "p_value")


def aa_fpr(pvalues: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Share of replicates with p < alpha, and whether it stays within alpha.

    A replicate without a p-value counts in the denominator only.
    """
    return pvalues.agg(
        F.count("*").alias("n_exp"),
        ratio(F.count_if(F.col("p_value") < alpha), F.count("*")).alias("fpr"),
    ).withColumn("split_ok", F.col("fpr") <= alpha)
