"""Two-sample tests on a metric column of a (…, exp_group, metric) frame.

Rows with a NULL metric are left out. Every test ends in one row; only the tail probability of
that row is computed in Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import normal_two_sided, t_two_sided


MOMENT_NAMES = ("n1", "mean1", "var1", "n2", "mean2", "var2")


def moments(metric: str, groups: tuple) -> list[Column]:
    """Count, mean and sample variance of both groups as columns n1, mean1, var1, n2, …"""
    def of(group) -> Column:
        return F.when(F.col("exp_group") == F.lit(group), F.col(metric))

    return [
        aggregate(of(group)).alias(f"{name}{i}")
        for i, group in enumerate(groups, start=1)
        for aggregate, name in ((F.count, "n"), (F.avg, "mean"), (F.var_samp, "var"))
    ]


# Squared standard errors of both means, and the degrees of freedom.
_POOLED = [
    "cast(n1 + n2 - 2 as double) as df",
    "((n1 - 1) * var1 + (n2 - 1) * var2) / nullif(df, 0) as pooled",
    "pooled / nullif(n1, 0) as error1",
    "pooled / nullif(n2, 0) as error2",
]
_WELCH = [
    "var1 / nullif(n1, 0) as error1",
    "var2 / nullif(n2, 0) as error2",
    "(error1 + error2) * (error1 + error2) / nullif("
    "error1 * error1 / nullif(n1 - 1, 0) + error2 * error2 / nullif(n2 - 1, 0), 0) as df",
]
# Without any variance different means are infinitely many standard errors apart; equal ones say nothing.
_T = """case when error1 + error2 > 0 then (mean1 - mean2) / sqrt(error1 + error2)
             when error1 + error2 = 0 and mean1 > mean2 then double('Infinity')
             when error1 + error2 = 0 and mean1 < mean2 then double('-Infinity') end as t"""


def with_t_test(df: DataFrame, equal_var: bool) -> DataFrame:
    """Adds t, df and p_value to rows of ``moments``.

    NULL where a variance is missing, or where both are zero and the means are equal. Zero variances
    with different means give t = ±Infinity and p = 0, with df NULL in Welch's form.
    """
    p_value = F.when(F.abs("t") == float("inf"), F.lit(0.0)).otherwise(t_two_sided("t", "df"))
    return (
        df.selectExpr("*", *(_POOLED if equal_var else _WELCH), _T)
        .select(*df.columns, "t", "df", p_value.alias("p_value"))
    )


def t_test(
    df: DataFrame, metric: str = "ctr", groups: tuple = (1, 2), equal_var: bool = False
) -> DataFrame:
    """Student's (``equal_var``) or Welch's t-test; n, mean, variance per group, t, df, p_value."""
    rows = df.where(F.col("exp_group").isin(*groups))
    return with_t_test(rows.agg(*moments(metric, groups)), equal_var)


def welch_ttest(df: DataFrame, metric: str = "ctr", groups: tuple = (1, 2)) -> DataFrame:
    return t_test(df, metric, groups, equal_var=False)


def _cuts(values: DataFrame, column: str, ranges: int, step: int) -> Column:
    """Approximate quantiles that cut ``column`` into ``ranges``, and every ``step``-th of them: a scalar subquery."""
    fractions = [(i + 1) / ranges for i in range(ranges - 1)]
    coarse = F.transform(F.sequence(F.lit(0), F.floor((F.size("fine") - 1) / step).cast("int")), lambda i: F.get("fine", i * step))
    cuts = values.agg(F.percentile_approx(column, fractions).alias("fine"))
    return cuts.select(F.struct("fine", coarse.alias("coarse")).alias("cuts")).scalar()


def mann_whitney(
    df: DataFrame,
    metric: str = "ctr",
    groups: tuple = (1, 2),
    ranges: int = 256,
) -> DataFrame:
    """Mann-Whitney U test, two-sided, normal approximation with tie and continuity correction.

    Ranks without a global sort: rows are first counted per distinct value (ties, however many,
    become one row), distinct values are cut into ranges at approximate quantiles, ranked within
    their range, and each range's ranks are then shifted by the number of rows in lower ranges.
    Only that last step runs in one task, over at most ``ranges`` rows. The cuts decide where work
    is done, not the result: counts and rank sums are exact decimals until the last step.
    """
    first, second = groups
    values = df.where(F.col("exp_group").isin(first, second) & F.col(metric).isNotNull()).select(
        F.col(metric).alias("x"), (F.col("exp_group") == F.lit(first)).alias("in_first"))
    # The range of a value: first among every step-th cut, then among the cuts up to the next of these.
    step = max(1, round(ranges**0.5))
    x = F.col("x")
    counted = (
        values.groupBy("x")
        .agg(F.count_if("in_first").alias("n1"), F.count("*").alias("n"))
        .withColumn("cuts", _cuts(values, "x", max(2, ranges), step))
        .withColumn("first", F.greatest(F.size(F.filter("cuts.coarse", lambda c: c < x)) - 1, F.lit(0)) * step)
        .withColumn("range", F.col("first") + F.size(F.filter(F.slice("cuts.fine", F.col("first") + 1, F.lit(step)), lambda c: c < x)))
        .select("x", "n1", "n", "range")
    )
    # Twice the rank sum is a whole number; cubes of ties and products of sizes overflow bigint.
    whole = "decimal(38, 0)"
    per_range = (
        counted.selectExpr(
            "range", f"cast(n1 as {whole}) as n1", f"cast(n as {whole}) as n",
            f"cast(coalesce(sum(n) over (partition by range order by x "
            f"rows between unbounded preceding and 1 preceding), 0) as {whole}) as before",
        )
        .groupBy("range")
        .agg(
            F.expr(f"cast(sum(n1) as {whole})").alias("n1"),
            F.expr(f"cast(sum(n) as {whole})").alias("n"),
            F.expr(f"cast(sum(cast(n1 * (2 * before + n + 1) as {whole})) as {whole})").alias("ranks1"),
            F.expr("sum(cast(n as double) * n * n - n)").alias("ties"),
        )
    )
    total = per_range.selectExpr(
        "*",
        f"cast(coalesce(sum(n) over (partition by 0 order by range "
        f"rows between unbounded preceding and 1 preceding), 0) as {whole}) as lower",
    ).agg(
        F.expr(f"cast(coalesce(sum(n1), 0) as {whole})").alias("n1"),
        F.expr(f"cast(coalesce(sum(n - n1), 0) as {whole})").alias("n2"),
        F.expr(f"cast(sum(ranks1 + cast(2 * n1 * lower as {whole})) as {whole})").alias("ranks1"),
        F.expr("sum(ties)").alias("ties"),
    )
    return total.selectExpr(
        f"cast(cast(ranks1 - n1 * (n1 + 1) as {whole}) as double) / 2 as u1",
        f"cast(cast(2 * n1 * n2 - (ranks1 - n1 * (n1 + 1)) as {whole}) as double) / 2 as u2",
        "cast(n1 as double) as n1",
        "cast(n2 as double) as n2",
        "ties",
    ).selectExpr(
        "cast(n1 as bigint) as n1",
        "cast(n2 as bigint) as n2",
        "u1",
        "u2",
        "ties",
        "(greatest(u1, u2) - n1 * n2 / 2 - 0.5D) / nullif(sqrt(n1 * n2 / 12 "
        "* (n1 + n2 + 1 - ties / nullif((n1 + n2) * (n1 + n2 - 1), 0))), 0) as z",
    ).withColumn("p_value", normal_two_sided("z"))
