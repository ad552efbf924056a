"""Small column helpers shared by the metrics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as double, NULL where ``den`` is zero (ANSI mode would raise)."""
    return num / F.nullif(den, F.lit(0))
