"""Two-variable user moments shared by CUPED and difference-in-differences.

One aggregation over the user table gives the moments of ``x`` and ``y`` per
arm.  Everything after it works on experiments x arms rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


# Select items of one arm's moments over its complete cases, d = y - x.
COMPLETE = "FILTER (WHERE x IS NOT NULL AND y IS NOT NULL)"
MOMENTS = {
    "n": "count(1)",
    "mean_x": "avg(x)",
    "mean_y": "avg(y)",
    "var_x": "var_samp(x)",
    "var_y": "var_samp(y)",
    "cov_xy": "covar_samp(y, x)",
    "var_d": "var_samp(y - x)",
}


def arm_moments(users: DataFrame) -> DataFrame:
    """Moments of x, y and y - x per experiment and variant, over users that have both.

    CUPED and DiD work on this table alone: it is all they need to know about
    the users.
    """
    return users.groupBy("experiment_id", "variant").agg(
        *[F.expr(f"{value} {COMPLETE} AS {name}") for name, value in MOMENTS.items()]
    )


def pooled_moments(arm: DataFrame) -> DataFrame:
    """``arm`` with its experiment's pooled x moments and theta attached to every arm.

    Arms are pooled by adding squared deviations within and between them, so
    the users are not read a second time.
    """
    over = "OVER (PARTITION BY experiment_id)"
    within = "coalesce({c}, 0D) * (n - 1)"
    s_xx = f"{within.format(c='var_x')} + n * (mean_x - x_mean) * (mean_x - x_mean)"
    s_xy = f"{within.format(c='cov_xy')} + n * (mean_x - x_mean) * (mean_y - _y_mean)"
    return (
        arm.where("n > 0").selectExpr(
            "*",
            f"sum(n) {over} AS n_all",
            f"sum(n * mean_x) {over} / sum(n) {over} AS x_mean",
            f"sum(n * mean_y) {over} / sum(n) {over} AS _y_mean",
        )
        .selectExpr("*", f"sum({s_xx}) {over} AS _s_xx", f"sum({s_xy}) {over} AS _s_xy")
        .selectExpr(
            "* EXCEPT (_y_mean, _s_xx, _s_xy)",
            "CASE WHEN n_all > 1 THEN _s_xx / (n_all - 1) END AS x_var",
            "CASE WHEN n_all > 1 THEN _s_xy / (n_all - 1) END AS yx_covar",
            "CASE WHEN _s_xx > 0 THEN _s_xy / _s_xx ELSE 0D END AS theta",
        )
    )
