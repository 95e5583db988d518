"""Distribution profiles of outcome values."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from armlift.sources.tables import checkpointed

PERCENTS = tuple(range(1, 100))
# Rank error of an approximate quantile is at most rows / ACCURACY.
ACCURACY = 30_000


def distinct_users(df: DataFrame, by: Sequence[str], approximate: bool = False) -> DataFrame:
    """Rows and distinct users per group.

    The exact count deduplicates (group, user) before counting, so no task
    holds a group's users.  The approximate one is a fixed-size sketch and
    needs no shuffle of users at all.
    """
    if approximate:
        return df.groupBy(*by).agg(
            F.count(F.lit(1)).alias("rows"), F.approx_count_distinct("user_id").alias("users")
        )
    per_user = df.groupBy(*by, "user_id").agg(F.count(F.lit(1)).alias("rows"))
    return per_user.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.count("user_id").alias("users")
    )


def distinct_days(outcomes: DataFrame) -> DataFrame:
    """Distinct calendar days with an outcome, per experiment and metric."""
    days = outcomes.select("experiment_id", "metric_name", F.to_date("ts").alias("day")).distinct()
    return days.groupBy("experiment_id", "metric_name").agg(F.count("day").alias("days"))


def value_histogram(outcomes: DataFrame) -> DataFrame:
    """Rows per value rounded to a whole number, per experiment and metric."""
    return outcomes.groupBy(
        "experiment_id", "metric_name", F.round("value", 0).alias("rounded_value")
    ).agg(F.count(F.lit(1)).alias("rows"))


def quantiles(
    df: DataFrame, by: Sequence[str], percents: Sequence[int] = PERCENTS
) -> DataFrame:
    """One row per group and percent: the value at that rank, exactly, in a group of any size.

    Equal values are counted first.  The distinct values are dealt to tasks by
    range, so a group may cover many of them; a task's ranks start at the number
    of rows its group has in the ranges before, which is one number per task.
    The ranges are checkpointed once, so all steps see the same ones.  NULLs have
    no rank; the least rank is 1.
    """
    by = list(by)
    counted = df.where(F.col("value").isNotNull()).groupBy(*by, "value").agg(F.count(F.lit(1)).alias("_n"))
    dealt = checkpointed(
        counted.repartitionByRange(*by, "value").withColumn("_part", F.spark_partition_id())
    )
    before = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(*by, "_part").agg(F.sum("_n").alias("_rows")).select(
        *by,
        "_part",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("_total"),
    )
    same = reduce(and_, [F.col(f"v.{c}").eqNullSafe(F.col(f"p.{c}")) for c in [*by, "_part"]])
    upto = Window.partitionBy(*[f"v.{c}" for c in by], "v._part").orderBy("value")
    ranked = dealt.alias("v").join(parts.alias("p"), same).select(
        *[f"v.{c}" for c in by],
        "value",
        "_n",
        "_total",
        (F.col("_before") + F.sum("_n").over(upto)).alias("_last"),
    )
    wanted = F.array(*[F.lit(int(p)) for p in percents])
    rank = lambda p: F.greatest(F.ceil(p / F.lit(100.0) * F.col("_total")), F.lit(1))
    here = lambda p: (rank(p) <= F.col("_last")) & (rank(p) > F.col("_last") - F.col("_n"))
    return ranked.select(*by, F.explode(F.filter(wanted, here)).alias("q"), "value")


def approximate_quantiles(
    df: DataFrame, by: Sequence[str], percents: Sequence[int] = PERCENTS
) -> DataFrame:
    """The table of :func:`quantiles` from mergeable sketches: ranks within rows / ``ACCURACY``.

    One pass and a state of bounded size per group.
    """
    shares = [p / 100 for p in percents]
    found = df.groupBy(*by).agg(
        F.percentile_approx("value", shares, ACCURACY).alias("value"),
        F.array(*[F.lit(int(p)) for p in percents]).alias("q"),
    )
    return found.select(*by, F.inline(F.arrays_zip("q", "value")))


def quantile_join(
    outcomes: DataFrame, left: str = "pre_revenue", right: str = "revenue"
) -> DataFrame:
    """Quantiles of two metrics side by side, per experiment and percent."""
    both = quantiles(
        outcomes.where(F.col("metric_name").isin(left, right)), ["experiment_id", "metric_name"]
    )
    one = lambda name: F.max(F.when(F.col("metric_name") == name, F.col("value"))).alias(f"{name}_value")
    sides = both.groupBy("experiment_id", "q").agg(one(left), one(right))
    return sides.dropna(subset=[f"{left}_value", f"{right}_value"])


def distinct_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()
