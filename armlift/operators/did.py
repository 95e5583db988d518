"""Difference-in-differences on user-level pre (x) and post (y) values.

``moments`` is the table of :func:`armlift.operators.moments.arm_moments`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from armlift.functions.normal import ci_95, two_sided_p, z_critical
from armlift.operators.ab import pair_arms
from armlift.sources.schemas import DID_RESULTS

_SIDES = (("ctrl", "control"), ("treat", "treatment"))
_PERIODS = ("pre", "post")


def did_cells(moments: DataFrame) -> DataFrame:
    """Per arm: users, mean and variance before and after."""
    return moments.selectExpr(
        "experiment_id", "variant", "n",
        "mean_x AS pre_mean", "mean_y AS post_mean",
        "var_x AS pre_var", "var_y AS post_var", "var_d AS change_var",
    )


def _paired_cells(moments: DataFrame) -> DataFrame:
    """One row per experiment: cell means, arm variances, the estimate and its plain error."""
    paired = pair_arms(
        did_cells(moments),
        ["experiment_id"],
        ("n", "pre_mean", "post_mean", "pre_var", "post_var", "change_var"),
    )
    cells = [(side, arm, period) for side, arm in _SIDES for period in _PERIODS]
    error = " + ".join(f"coalesce({p}_var_{a}, 0D) / n_{a}" for _, a, p in cells)
    return paired.selectExpr(
        "*",
        *[f"{p}_mean_{a} AS y_{s}_{p}" for s, a, p in cells],
        "(post_mean_treatment - pre_mean_treatment) - (post_mean_control - pre_mean_control) AS did",
        f"sqrt({error}) AS se",
    ).selectExpr("*", "try_divide(did, se) AS z")


def did(
    moments: DataFrame,
    window: DataFrame,
    metric_pre: str = "pre_revenue",
    metric_post: str = "revenue",
    metric_name: str | None = None,
    confidence: float = 0.95,
) -> DataFrame:
    """DiD per experiment with the four cell means taken as independent.

    ``window`` (experiment_id, start_ts, end_ts) is reported, not applied; an
    experiment without one has NULL ends.
    ``confidence`` is reported too; the interval is always the 95% one.  For
    other levels see :func:`did_confidence`.
    """
    labels = {
        "metric_name": F.lit(metric_name or metric_post),
        "metric_pre": F.lit(metric_pre),
        "metric_post": F.lit(metric_post),
        "confidence": F.lit(float(confidence)),
    }
    return (
        _paired_cells(moments)
        .selectExpr("*", f"{two_sided_p('z')} AS p_value", *ci_95("did", "se"))
        .join(window, "experiment_id", "left")
        .withColumns(labels)
        .select(*[c for c in DID_RESULTS if c != "analysis_ts"], "n_control", "n_treatment")
    )


def did_results(result: DataFrame) -> DataFrame:
    """Stored columns of a :func:`did` result, without the clock."""
    return result.select(*[c for c in DID_RESULTS if c != "analysis_ts"])


def did_results_v1(result: DataFrame) -> DataFrame:
    """The estimate as a ``<metric>__did`` row of the A/B results layout; lift is over post control."""
    return result.selectExpr(
        "experiment_id",
        "concat(metric_name, '__did') AS metric_name",
        "n_control",
        "y_ctrl_post AS mean_control",
        "CAST(NULL AS DOUBLE) AS std_control",
        "n_treatment",
        "y_treat_post AS mean_treatment",
        "CAST(NULL AS DOUBLE) AS std_treatment",
        "did AS delta",
        "se", "z", "p_value", "ci_low", "ci_high",
        "try_divide(did, y_ctrl_post) AS rel_lift",
    )


def did_confidence(moments: DataFrame, confidence: float | list[float] = 0.95) -> DataFrame:
    """The same estimate with an interval at 0.90, 0.95 or 0.99; other levels fail the query.

    With no error at all z and p are NULL and the interval is the estimate.
    """
    levels = confidence if isinstance(confidence, list) else [confidence]
    return (
        _paired_cells(moments)
        .withColumn("confidence", F.explode(F.array(*[F.lit(float(c)) for c in levels])))
        .selectExpr("*", f"{z_critical('confidence')} * se AS _margin")
        .selectExpr(
            "experiment_id", "confidence",
            "y_treat_pre", "y_treat_post", "y_ctrl_pre", "y_ctrl_post",
            "did", "se", "z", f"{two_sided_p('z')} AS p_value",
            "did - _margin AS ci_low", "did + _margin AS ci_high",
        )
    )


def did_clustered(moments: DataFrame) -> DataFrame:
    """Coefficients of ``measure ~ group * period`` with errors clustered by user.

    Each user gives one pre and one post row, so the sandwich collapses to arm
    variances: of the pre value for the intercept and group, of the change for
    period and interaction.  The usual small-sample factor applies, with G
    users as clusters, 2G rows and 4 coefficients.
    """
    error = lambda kind, arm: f"coalesce({kind}_var_{arm}, 0D) * (n_{arm} - 1) / (n_{arm} * n_{arm})"
    both = lambda kind: f"{error(kind, 'control')} + {error(kind, 'treatment')}"
    terms = {
        "Intercept": ("y_ctrl_pre", error("pre", "control")),
        "group": ("y_treat_pre - y_ctrl_pre", both("pre")),
        "period": ("y_ctrl_post - y_ctrl_pre", error("change", "control")),
        "group:period": ("did", both("change")),
    }
    rows = ", ".join(
        f"named_struct('term', '{term}', 'coef', {coef}, 'error', {squared})"
        for term, (coef, squared) in terms.items()
    )
    factor = "(g / (g - 1)) * ((2 * g - 1) / (2 * g - 4))"
    return (
        _paired_cells(moments)
        .selectExpr("experiment_id", "n_control + n_treatment AS g", f"inline(array({rows}))")
        .selectExpr(
            "experiment_id", "2 * g AS n_obs", "term", "coef",
            f"CASE WHEN g > 2 THEN sqrt({factor} * error) END AS se",
        )
        .selectExpr("*", "try_divide(coef, se) AS z")
        .selectExpr("*", f"{two_sided_p('z')} AS p_value", *ci_95("coef", "se"))
    )


def did_long(users: DataFrame) -> DataFrame:
    """Two rows per user: (group, period, measure), pre as period 0 and post as period 1."""
    return users.selectExpr(
        "experiment_id",
        "user_id",
        "if(variant = 'treatment', 1, 0) AS group",
        "stack(2, 1, y, 0, x) AS (period, measure)",
    )


def cell_regression_table(users: DataFrame) -> DataFrame:
    """The 2 x 2 table of mean measures with its interaction column."""
    return (
        did_long(users)
        .groupBy("experiment_id", "group", "period")
        .agg(F.avg("measure").alias("measure"))
        .withColumn("interaction", F.col("group") * F.col("period"))
    )
