"""Distinct users over any window from stored sketches, without the users.

A HyperLogLog sketch per group and day has a fixed size and can be united with others, so a window's
distinct users need neither the outcomes nor a shuffle of users.  The relative standard error of an
estimate is about 1.04 / sqrt(2^lg_k).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Logarithm of a sketch's registers.
LG_K = 14


def error_of(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)


def daily_sketches(
    outcomes: DataFrame, by: Sequence[str] = ("experiment_id", "metric_name"), lg_k: int = LG_K
) -> DataFrame:
    """One sketch of the users per ``by`` and day of ``ts``; undated rows are in the day NULL.

    Tasks shuffle sketches, not users.
    """
    return outcomes.groupBy(*by, F.to_date("ts").alias("day")).agg(
        F.hll_sketch_agg("user_id", lg_k).alias("users"), F.count(F.lit(1)).alias("rows")
    )


def united(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows and estimated distinct users per ``by``, from any sketches of one size."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("users").alias("_users"), F.sum("rows").alias("rows"))
    return merged.select(*by, "rows", F.hll_sketch_estimate("_users").alias("users"))


def users_between(sketches: DataFrame, first: str, last: str, by: Sequence[str] = ("experiment_id", "metric_name")) -> DataFrame:
    """:func:`united` over the days from ``first`` to ``last``, both included."""
    return united(sketches.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date"))), by)
