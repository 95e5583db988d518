"""Ratio metrics: a sum over users divided by another, with linearised variance.

The ratio R of an arm is that of the two means.  A user's share in its error is (x - R y) / mean(y), so
the error follows from the joint moments of numerator and denominator, without a second look at users.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from armlift.functions.normal import two_sided_p
from armlift.operators.ab import INTERVAL, pair_arms
from armlift.operators.grain import user_columns
from armlift.sources.schemas import MetricSpec


@dataclass(frozen=True)
class RatioSpec:
    """``name`` is the users' ``numerator`` over their ``denominator``; a user without either counts as zero."""

    name: str
    numerator: str
    denominator: str


def ratio_stats(
    outcomes: DataFrame, exposures: DataFrame, ratios: Sequence[RatioSpec], unique: bool = False
) -> DataFrame:
    """Users, both means, their variances and covariance per experiment, arm and ratio, in one pass.

    Every metric is rolled up once, as its users' sum, however many ratios name it.
    """
    used = list(dict.fromkeys(m for r in ratios for m in (r.numerator, r.denominator)))
    column = {m: f"m{i}" for i, m in enumerate(used)}
    users = user_columns(outcomes, exposures, [MetricSpec(m) for m in used], list(column.values()), unique=unique)
    users = users.fillna(0.0, list(column.values()))
    items = [
        F.struct(
            F.lit(r.name).alias("metric_name"),
            F.count(F.lit(1)).alias("n"),
            F.avg(x).alias("mean_num"),
            F.avg(y).alias("mean_den"),
            F.var_samp(x).alias("var_num"),
            F.var_samp(y).alias("var_den"),
            F.covar_samp(x, y).alias("cov"),
        )
        for r, x, y in ((r, column[r.numerator], column[r.denominator]) for r in ratios)
    ]
    per_arm = users.groupBy("experiment_id", "variant").agg(F.array(*items).alias("stats"))
    return per_arm.selectExpr("experiment_id", "variant", "inline(stats)")


def ab_ratio(stats: DataFrame) -> DataFrame:
    """Ratios of both arms, their difference, lift, error, z, p-value and 95% interval.

    An arm whose denominator is zero, or that has one user, has no ratio or no error: NULLs.
    """
    spread = "var_num - 2 * ratio * cov + ratio * ratio * var_den"
    arms = stats.selectExpr("*", "try_divide(mean_num, mean_den) AS ratio").selectExpr(
        "*", f"try_divide(CASE WHEN {spread} < 0 THEN 0D ELSE {spread} END, mean_den * mean_den * n) AS error"
    )
    return (
        pair_arms(arms, columns=("n", "ratio", "error"))
        .selectExpr(
            "* EXCEPT (error_control, error_treatment)",
            "ratio_treatment - ratio_control AS delta",
            "try_divide(ratio_treatment - ratio_control, ratio_control) AS rel_lift",
            "sqrt(error_control + error_treatment) AS se",
        )
        .selectExpr("*", "try_divide(delta, se) AS z")
        .selectExpr("*", f"{two_sided_p('z')} AS p_value", *INTERVAL)
    )
