"""Pre-trend diagnostics: treatment-control deltas by day before exposure and their slope."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from armlift.functions.normal import double, two_sided_p
from armlift.functions.student import equivalent_z
from armlift.operators.grain import arms
from armlift.sources.schemas import KEY

ALPHA = 0.05
LEAST_POINTS = 3


def pretrend_daily(
    outcomes: DataFrame, exposures: DataFrame, metric: str = "pre_revenue", unique: bool = False
) -> DataFrame:
    """Mean value per arm and day relative to the user's exposure, before exposure only.

    Outcomes are first combined per user and calendar day, which keeps the mean
    exact and bounds what one user can bring into the join.
    """
    days = (
        outcomes.where(F.col("metric_name") == metric)
        .groupBy(*KEY, F.to_date("ts").alias("day"))
        .agg(F.sum("value").alias("total"), F.count("value").alias("n"))
    )
    return (
        days.join(arms(exposures, "exposure_ts", unique=unique), KEY)
        .withColumn("k_days", F.datediff("day", "exposure_ts"))
        .where("k_days < 0")
        .groupBy("experiment_id", "k_days", "variant")
        .agg(F.expr("try_divide(sum(total), sum(n)) AS mean"))
    )


def _deltas(daily: DataFrame) -> DataFrame:
    return (
        daily.groupBy("experiment_id", "k_days")
        .agg(
            F.expr("max(mean) FILTER (WHERE variant = 'treatment') AS treat_mean"),
            F.expr("max(mean) FILTER (WHERE variant = 'control') AS control_mean"),
        )
        .selectExpr("*", "treat_mean - control_mean AS delta")
    )


def pretrend_delta(daily: DataFrame) -> DataFrame:
    """Treatment minus control per day; days seen in one arm only are dropped."""
    return _deltas(daily).dropna(subset=["delta"])


def pretrend_moments(daily: DataFrame) -> DataFrame:
    """Sums that determine the regression of delta on day.

    ``distinct_k`` counts days before the arms are paired; the other columns
    use paired days only.
    """
    named = {
        "n": "count", "xbar": "avgx", "ybar": "avgy", "s_xx": "sxx", "s_xy": "sxy", "s_yy": "syy",
    }
    return (
        _deltas(daily)
        .groupBy("experiment_id")
        .agg(
            F.expr("count(1) AS distinct_k"),
            *[F.expr(f"regr_{f}(delta, k_days) AS {name}") for name, f in named.items()],
        )
    )


def pretrend_slope(daily: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Slope of the delta series with its normal-theory test.

    Verdict PASS when p > alpha, FAIL otherwise, INSUFFICIENT_DATA below three
    days, three paired points or without spread in k.  A perfect fit has no
    error: a zero slope then passes with p = 1 and any other fails with p = 0.
    """
    enough = f"distinct_k >= {LEAST_POINTS} AND n >= {LEAST_POINTS} AND s_xx > 0"
    residual = "CASE WHEN slope IS NOT NULL THEN greatest(s_yy - slope * s_xy, 0D) END"
    exact = "if(slope = 0, 1D, 0D)"
    return (
        pretrend_moments(daily)
        .selectExpr("*", f"CASE WHEN {enough} THEN s_xy / s_xx END AS slope")
        .selectExpr("*", f"sqrt({residual} / greatest(n - 2, 1) / s_xx) AS se")
        .selectExpr("*", "try_divide(slope, se) AS z")
        .selectExpr("*", f"CASE WHEN se = 0 THEN {exact} ELSE {two_sided_p('z')} END AS p_value")
        .selectExpr(
            "experiment_id", "distinct_k", "n AS num_pre_points", "slope", "se", "z", "p_value",
            "CASE WHEN slope IS NULL THEN 'INSUFFICIENT_DATA' "
            f"WHEN p_value > {double(alpha)} THEN 'PASS' ELSE 'FAIL' END AS verdict",
        )
    )


def pretrend_slope_hc3(delta: DataFrame) -> DataFrame:
    """Intercept and slope of delta on day with classical and HC3 errors.

    The classical test refers to t with n - 2 degrees of freedom, the HC3 one
    to the normal.  Windows run over one experiment's day series.
    """
    over = "OVER (PARTITION BY experiment_id)"
    points = (
        delta.selectExpr(
            "experiment_id", "delta AS y",
            f"count(1) {over} AS n",
            f"avg(k_days) {over} AS xbar",
            f"avg(delta) {over} AS ybar",
            f"k_days - avg(k_days) {over} AS dx",
        )
        .selectExpr(
            "*", f"sum(dx * dx) {over} AS s_xx", f"sum(dx * (y - ybar)) {over} AS _s_xy"
        )
        .where("n >= 3 AND s_xx > 0")
        .selectExpr(
            "*",
            "_s_xy / s_xx AS slope",
            "y - ybar - _s_xy / s_xx * dx AS e",
            "1 - 1 / n - dx * dx / s_xx AS room",
        )
    )
    fits = points.groupBy("experiment_id", "n", "xbar", "ybar", "s_xx", "slope").agg(
        F.expr("sum(e * e) / (n - 2) AS sigma2"),
        F.expr("sqrt(sum(pow(dx / s_xx * e / room, 2))) AS slope_hc3"),
        F.expr("sqrt(sum(pow((1 / n - xbar * dx / s_xx) * e / room, 2))) AS intercept_hc3"),
    )
    return (
        fits.selectExpr(
            "experiment_id",
            "n",
            """stack(2,
                'Intercept', ybar - slope * xbar, sqrt(sigma2 * (1 / n + xbar * xbar / s_xx)), intercept_hc3,
                'k_days', slope, sqrt(sigma2 / s_xx), slope_hc3
            ) AS (term, coef, se_ols, se_hc3)""",
        )
        .selectExpr(
            "*", "try_divide(coef, se_ols) AS t_ols", "try_divide(coef, se_hc3) AS z_hc3"
        )
        .selectExpr("*", f"{equivalent_z('t_ols', '(n - 2)')} AS _z")
        .selectExpr(
            "* EXCEPT (_z)", f"{two_sided_p('_z')} AS p_ols", f"{two_sided_p('z_hc3')} AS p_hc3"
        )
    )
