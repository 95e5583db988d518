"""Per-variant metric aggregates, overall and by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from armlift.operators.grain import MEAN, VARIANCE, arms, merge_moments, user_moments
from armlift.operators.windows import window_filter
from armlift.sources.schemas import DEFAULT_METRICS, KEY, MetricSpec, require_columns


def _analysed_rows(
    outcomes: DataFrame, registry: DataFrame, specs: Sequence[MetricSpec]
) -> DataFrame:
    """Rows of the listed metrics, post metrics cut to the window."""
    require_columns(outcomes, [*KEY, "metric_name", "value", "ts"], "outcomes")
    listed = outcomes.where(F.col("metric_name").isin([s.name for s in specs]))
    uncut = F.col("metric_name").isin([s.name for s in specs if s.period != "post"])
    return window_filter(listed, registry, pre=uncut)


CELL = ["experiment_id", "variant", "metric_name"]


def daily_moments(
    outcomes: DataFrame,
    exposures: DataFrame,
    registry: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    unique: bool = False,
) -> DataFrame:
    """Moments of outcome rows per experiment, variant, metric and day.

    Both aggregate tables follow from it, see :func:`overall_table` and
    :func:`daily_table`; stored, it saves the second pass over the outcomes.
    """
    rows = _analysed_rows(outcomes, registry, specs).withColumn("day", F.to_date("ts"))
    return merge_moments(user_moments(rows, "day").join(arms(exposures, unique=unique), KEY), *CELL, "day")


def overall_table(moments: DataFrame) -> DataFrame:
    """n, mean, sum, stddev, min and max per cell, from moments at that or a finer grain."""
    return merge_moments(moments, *CELL).selectExpr(
        *CELL, "rows AS n", f"{MEAN} AS mean", "total AS sum", f"sqrt({VARIANCE}) AS stddev",
        "lowest AS min", "highest AS max",
    )


def daily_table(moments: DataFrame) -> DataFrame:
    """n, mean and sum per cell and day, from :func:`daily_moments`."""
    return moments.selectExpr(*CELL, "day", "rows AS n", f"{MEAN} AS mean", "total AS sum")


def metric_overall(
    outcomes: DataFrame,
    exposures: DataFrame,
    registry: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
) -> DataFrame:
    """n, mean, sum, stddev, min and max of outcome rows per experiment, variant and metric."""
    users = user_moments(_analysed_rows(outcomes, registry, specs))
    return overall_table(users.join(arms(exposures), KEY))


def metric_daily(
    outcomes: DataFrame,
    exposures: DataFrame,
    registry: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
) -> DataFrame:
    """n, mean and sum of outcome rows per experiment, variant, metric and day."""
    return daily_table(daily_moments(outcomes, exposures, registry, specs))


def daily_preview(daily: DataFrame, rows: int = 10) -> DataFrame:
    """First rows of the daily table in reading order."""
    return daily.orderBy("experiment_id", "day", "metric_name", "variant").limit(rows)
