"""CUPED: pre-period covariate adjustment with a pooled theta.

``moments`` is the table of :func:`armlift.operators.moments.arm_moments`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from armlift.functions.normal import ci_95, two_sided_p
from armlift.operators.ab import pair_arms
from armlift.operators.moments import pooled_moments
from armlift.sources.schemas import CUPED_RESULTS

_FORMS = ("raw", "cuped")
_ARMS = ("control", "treatment")


def cuped_moments(moments: DataFrame) -> DataFrame:
    """Pooled mean and variance of the covariate, covariance with the target, theta."""
    return (
        pooled_moments(moments)
        .selectExpr("experiment_id", "n_all AS n", "x_mean", "x_var", "yx_covar", "theta")
        .dropDuplicates(["experiment_id"])
    )


def theta_from_moments(users: DataFrame) -> DataFrame:
    """Theta of complete cases from raw moments; 0 when the covariate does not vary."""
    moments = users.groupBy("experiment_id").agg(
        F.expr("count(1) AS n"),
        F.expr("avg(x) AS x_mean"),
        F.expr("avg(y) AS y_mean"),
        F.expr("avg(x * x) AS x2_mean"),
        F.expr("avg(x * y) AS xy_mean"),
    )
    var_x = "(x2_mean - x_mean * x_mean)"
    return moments.selectExpr(
        "*", f"CASE WHEN {var_x} > 0 THEN (xy_mean - x_mean * y_mean) / {var_x} ELSE 0D END AS theta"
    )


def cuped_group_stats(moments: DataFrame) -> DataFrame:
    """Per arm: n, mean and variance of the target, raw and adjusted.

    With y* = y - theta (x - mean x) the adjusted moments follow from the arm's
    own: no second pass over the users.
    """
    adjusted_var = "var_y + theta * theta * var_x - 2 * theta * cov_xy"
    return pooled_moments(moments).selectExpr(
        "experiment_id", "variant", "n", "theta", "x_mean",
        "mean_y AS mean_raw",
        "var_y AS var_raw",
        "mean_y - theta * (mean_x - x_mean) AS mean_cuped",
        f"CASE WHEN var_y IS NOT NULL THEN greatest({adjusted_var}, 0D) END AS var_cuped",
    )


def cuped(
    moments: DataFrame, target: str = "revenue", covariate: str = "pre_revenue"
) -> DataFrame:
    """Raw and adjusted effect per experiment, with the target as y and the covariate as x.

    Experiments with a missing arm have no row.  z and p are
    NULL, and so is the interval, when the error is 0.
    """
    columns = ("n", "theta", "x_mean", "mean_raw", "var_raw", "mean_cuped", "var_cuped")
    paired = pair_arms(cuped_group_stats(moments), ["experiment_id"], columns)
    error = " + ".join("coalesce(var_{f}_%s, 0D) / n_%s" % (a, a) for a in _ARMS)
    effects = paired.selectExpr(
        "*",
        "theta_control AS theta",
        "x_mean_control AS x_mean",
        *[f"mean_{f}_{a} AS mean_{a}_{f}" for f in _FORMS for a in _ARMS],
        *[f"mean_{f}_treatment - mean_{f}_control AS delta_{f}" for f in _FORMS],
        *[f"sqrt({error.format(f=f)}) AS se_{f}" for f in _FORMS],
    )
    tested = effects.selectExpr("*", *[f"try_divide(delta_{f}, se_{f}) AS z_{f}" for f in _FORMS])
    intervals = [item for f in _FORMS for item in ci_95(f"delta_{f}", f"se_{f}", f"_{f}")]
    return (
        tested.selectExpr(
            "*", *intervals, *[f"{two_sided_p(f'z_{f}')} AS p_value_{f}" for f in _FORMS]
        )
        .withColumns({"metric_name": F.lit(target), "covariate_name": F.lit(covariate)})
        .select(
            *CUPED_RESULTS, "z_raw", "z_cuped", *[f"var_{f}_{a}" for f in _FORMS for a in _ARMS]
        )
    )


def cuped_results(result: DataFrame) -> DataFrame:
    """Stored columns of a :func:`cuped` result."""
    return result.select(*CUPED_RESULTS)


def cuped_results_v1(result: DataFrame) -> DataFrame:
    """The adjusted effect as a ``<metric>__cuped`` row of the A/B results layout."""
    return result.selectExpr(
        "experiment_id",
        "concat(metric_name, '__cuped') AS metric_name",
        "n_control",
        "mean_control_cuped AS mean_control",
        "sqrt(var_cuped_control) AS std_control",
        "n_treatment",
        "mean_treatment_cuped AS mean_treatment",
        "sqrt(var_cuped_treatment) AS std_treatment",
        "delta_cuped AS delta",
        "se_cuped AS se",
        "z_cuped AS z",
        "p_value_cuped AS p_value",
        "ci_low_cuped AS ci_low",
        "ci_high_cuped AS ci_high",
        "try_divide(delta_cuped, mean_control_cuped) AS rel_lift",
    )


def cuped_variance_reduction(result: DataFrame, least: float = 0.0) -> DataFrame:
    """Share of variance removed and narrowing of the interval.

    ``status`` is SKIPPED when the covariate cannot help: theta is 0 or the
    reduction does not exceed ``least``.  The raw estimate is always there.
    """
    return result.selectExpr(
        "experiment_id", "metric_name", "covariate_name", "theta",
        "delta_raw", "se_raw", "delta_cuped", "se_cuped",
        "1 - try_divide(se_cuped * se_cuped, se_raw * se_raw) AS variance_reduction",
        "1 - try_divide(ci_high_cuped - ci_low_cuped, ci_high_raw - ci_low_raw) AS ci_width_reduction",
    ).withColumn(
        "status",
        F.when((F.col("theta") != 0) & (F.col("variance_reduction") > least), "APPLIED")
        .otherwise("SKIPPED"),
    )
