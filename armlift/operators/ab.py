"""A/B estimators: two-proportion z, Welch, and the checks that go with them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from armlift.functions.normal import Z_95, Z_CRITICAL, double, two_sided_p
from armlift.functions.student import equivalent_z, t_critical
from armlift.operators.grain import (
    MEAN,
    VARIANCE,
    arms,
    merge_moments,
    user_columns,
    user_moments,
)
from armlift.sources.schemas import ANALYSIS_RESULTS, BINARY_METRICS, DEFAULT_METRICS, KEY, MetricSpec

ARM_STATS = ("n", "mean", "var", "std")
LIFT = [
    "mean_treatment - mean_control AS delta",
    "try_divide(mean_treatment - mean_control, mean_control) AS rel_lift",
]
INTERVAL = [f"delta - {Z_95} * se AS ci_low", f"delta + {Z_95} * se AS ci_high"]


def ab_stats(outcomes: DataFrame, exposures: DataFrame) -> DataFrame:
    """n, mean, var and std of outcome *rows* per experiment, metric and variant.

    Every metric, no window.  The raw-row form; see :func:`user_arm_stats` for
    the form that counts users.
    """
    key = ["experiment_id", "metric_name", "variant"]
    return (
        merge_moments(user_moments(outcomes).join(arms(exposures), KEY), *key)
        .selectExpr(*key, "rows AS n", f"{MEAN} AS mean", f"{VARIANCE} AS var")
        .selectExpr("*", "sqrt(var) AS std")
    )


def user_arm_stats(
    outcomes: DataFrame,
    exposures: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
) -> DataFrame:
    """n, mean, var and std over exposed *users* per experiment, metric and variant.

    A user without an outcome counts as its metric's spec says.  Metrics stay
    columns until they are aggregated, so the long form has only experiments x
    variants x metrics rows.
    """
    names = [f"m{i}" for i in range(len(specs))]
    users = user_columns(outcomes, exposures, specs, names)
    per_arm = users.groupBy("experiment_id", "variant").agg(
        F.array(*stats_items(specs, names)).alias("stats")
    )
    return unfold_stats(per_arm)


def stats_items(specs: Sequence[MetricSpec], names: Sequence[str]) -> list[Column]:
    """One aggregate per metric column: a struct (metric_name, n, mean, var)."""
    shown = [f"coalesce(`{n}`, 0D)" if s.zero_filled else f"`{n}`" for s, n in zip(specs, names)]
    return [
        F.struct(
            F.lit(s.name).alias("metric_name"),
            F.expr(f"count({value}) AS n"),
            F.expr(f"avg({value}) AS mean"),
            F.expr(f"var_samp({value}) AS var"),
        )
        for s, value in zip(specs, shown)
    ]


def other_arm_stats(
    outcomes: DataFrame,
    exposures: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    unique: bool = False,
) -> DataFrame:
    """The table of :func:`user_arm_stats` for every metric of the outcomes that no spec names.

    Any number of metrics: rows stay long.  A user's value is the sum, and exposed
    users without one count as 0; they are added to the moments of the others as
    so many zeros, whose squared deviations need no subtraction.
    """
    listed = [s.name for s in specs]
    who = arms(exposures, unique=unique)
    sizes = who.groupBy("experiment_id", "variant").agg(F.count(F.lit(1)).alias("size"))
    values = (
        outcomes.where(F.col("metric_name").isNotNull() & ~F.col("metric_name").isin(listed))
        .groupBy(*KEY, "metric_name")
        .agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("value"))
        .join(who, KEY)
        .groupBy("experiment_id", "metric_name", "variant")
        .agg(
            F.count(F.lit(1)).alias("k"),
            F.avg("value").alias("some"),
            F.expr("var_pop(value) * count(value) AS m2"),
        )
    )
    # Both arms of a metric that was seen at all: an arm without a value is all zeros.
    cells = values.select("experiment_id", "metric_name").distinct().join(sizes, "experiment_id")
    found = cells.join(values, ["experiment_id", "metric_name", "variant"], "left")
    return found.selectExpr(
        "experiment_id",
        "metric_name",
        "variant",
        "size AS n",
        "coalesce(some * k / size, 0D) AS mean",
        "CASE WHEN size > 1 THEN coalesce(m2 + some * some * k * (size - k) / size, 0D) / (size - 1) END AS var",
    ).selectExpr("*", "sqrt(var) AS std")


def missing_arms(stats: DataFrame, by: Sequence[str] = ("experiment_id", "metric_name")) -> DataFrame:
    """``by`` and ``status`` of every key: OK, MISSING_CONTROL, MISSING_TREATMENT or NO_DATA."""
    has = {arm: F.expr(f"coalesce(bool_or(variant = '{arm}' AND n > 0), false)") for arm in ("control", "treatment")}
    return (
        stats.groupBy(*by)
        .agg(*[found.alias(f"_{arm}") for arm, found in has.items()])
        .selectExpr(
            *by,
            "CASE WHEN _control AND _treatment THEN 'OK' WHEN _treatment THEN 'MISSING_CONTROL'"
            " WHEN _control THEN 'MISSING_TREATMENT' ELSE 'NO_DATA' END AS status",
        )
    )


def unfold_stats(arms_table: DataFrame) -> DataFrame:
    """Long per-metric statistics from an arm table with a ``stats`` array."""
    return arms_table.selectExpr("experiment_id", "variant", "inline(stats)").selectExpr(
        "experiment_id", "metric_name", "variant", "n", "mean", "var", "sqrt(var) AS std"
    )


def pair_arms(
    stats: DataFrame,
    by: Sequence[str] = ("experiment_id", "metric_name"),
    columns: Sequence[str] = ARM_STATS,
) -> DataFrame:
    """One row per key with ``*_control`` and ``*_treatment``; keys missing an arm are left out."""
    sides = [
        F.expr(f"max(CASE WHEN variant = '{arm}' THEN {c} END) AS {c}_{arm}")
        for arm in ("control", "treatment")
        for c in columns
    ]
    return (
        stats.groupBy(*by)
        .agg(*sides)
        .where("n_control > 0 AND n_treatment > 0")
    )


def _tested(paired: DataFrame, se: str, z: str, method: str) -> DataFrame:
    """Effect, error, z, p and 95% interval from SQL text; ``z`` may use delta and se."""
    return (
        paired.selectExpr("*", *LIFT, f"{se} AS se")
        .selectExpr("*", f"{z} AS z")
        .selectExpr("*", f"{two_sided_p('z')} AS p_value", *INTERVAL, f"{method} AS method")
    )


_SUCCESSES = "(mean_control * n_control + mean_treatment * n_treatment)"
_SHARE = f"coalesce(try_divide({_SUCCESSES}, n_control + n_treatment), 0D)"
_PER_TRIAL = "(1 / greatest(n_control, 1) + 1 / greatest(n_treatment, 1))"
_UNPOOLED = " + ".join(
    f"mean_{a} * (1 - mean_{a}) / greatest(n_{a}, 1)" for a in ("control", "treatment")
)
PROPORTION_SE = f"sqrt(greatest({_UNPOOLED}, 0D))"
PROPORTION_Z = (
    f"coalesce(try_divide(delta, sqrt(greatest({_SHARE} * (1 - {_SHARE}) * {_PER_TRIAL}, 0D))), 0D)"
)


def ab_proportion(paired: DataFrame) -> DataFrame:
    """Two-proportion test: pooled error for z and p, unpooled error for ``se`` and the interval."""
    return _tested(paired, PROPORTION_SE, PROPORTION_Z, "'two_proportion_z'")


def _welch_variance(arm: str) -> str:
    mean = f"mean_{arm}"
    return (
        f"CASE WHEN var_control IS NOT NULL AND var_treatment IS NOT NULL THEN var_{arm}"
        f" WHEN {mean} BETWEEN 0 AND 1 THEN {mean} * (1 - {mean}) ELSE 0D END"
    )


WELCH_SE = "sqrt({})".format(
    " + ".join(f"({_welch_variance(a)}) / greatest(n_{a}, 1)" for a in ("control", "treatment"))
)
WELCH_Z = "coalesce(try_divide(delta, se), 0D)"


def ab_welch(paired: DataFrame) -> DataFrame:
    """Difference in means with unpooled variance and a normal reference.

    When either variance is missing both fall back to m(1 - m) for a mean in
    [0, 1], else to 0.
    """
    return _tested(paired, WELCH_SE, WELCH_Z, "'welch_normal_approx'")


def ab_analysis(stats: DataFrame, by: Sequence[str] = ("experiment_id", "metric_name")) -> DataFrame:
    """A/B result per ``by`` (which includes the metric) from per-arm statistics.

    Metrics named like a conversion get the two-proportion test, all others
    Welch.  A metric seen in one arm only has no result.  A control mean of 0
    gives a NULL relative lift.
    """
    names = ", ".join(f"'{m}'" for m in BINARY_METRICS)
    choose = f"if(lower(metric_name) IN ({names}), {{}}, {{}})".format
    tested = _tested(
        pair_arms(stats, by),
        choose(PROPORTION_SE, WELCH_SE),
        choose(PROPORTION_Z, WELCH_Z),
        choose("'two_proportion_z'", "'welch_normal_approx'"),
    )
    return tested.drop("var_control", "var_treatment")


def ab_results_table(results: DataFrame) -> DataFrame:
    """Results in the stored column order, without the two clocks."""
    return results.select(*[c for c in ANALYSIS_RESULTS if not c.endswith("_ts")])


def balance_check(stats: DataFrame) -> DataFrame:
    """Welch test of every pre-period metric: a randomisation check."""
    return ab_welch(pair_arms(stats.where(F.col("metric_name").startswith("pre_"))))


def welch_t(stats: DataFrame) -> DataFrame:
    """Welch's t: statistic, Satterthwaite degrees of freedom, p-value and 95% interval.

    Arms with fewer than two users, or no variance at all, give NULLs.
    """
    c, t = "(var_control / n_control)", "(var_treatment / n_treatment)"
    df = (
        f"try_divide(({c} + {t}) * ({c} + {t}),"
        f" try_divide({c} * {c}, n_control - 1) + try_divide({t} * {t}, n_treatment - 1))"
    )
    return (
        pair_arms(stats)
        .selectExpr("*", *LIFT, f"sqrt({c} + {t}) AS se", f"{df} AS df")
        .selectExpr("*", "try_divide(delta, se) AS t_stat")
        .selectExpr(
            "*", f"{equivalent_z('t_stat', 'df')} AS _z", f"{t_critical('df')} * se AS _margin"
        )
        .selectExpr(
            "* EXCEPT (_z, _margin)",
            f"{two_sided_p('_z')} AS p_value",
            "delta - _margin AS ci_low",
            "delta + _margin AS ci_high",
        )
    )


def converted_users(joined: DataFrame) -> DataFrame:
    """Users, users with a non-zero value, their ratio, and rows, per variant and metric."""
    users = joined.groupBy("experiment_id", "variant", "metric_name", "user_id").agg(
        F.count(F.lit(1)).alias("rows"), F.expr("max(value <> 0) AS converted")
    )
    return (
        users.groupBy("experiment_id", "variant", "metric_name")
        .agg(
            F.count(F.lit(1)).alias("total_users"),
            F.count_if("converted").alias("converted_users"),
            F.sum("rows").alias("rows"),
        )
        .selectExpr("*", "converted_users / total_users AS conversion_proportion")
    )


def _pair_counts(counts: DataFrame) -> DataFrame:
    renamed = counts.withColumnsRenamed({"total_users": "n", "converted_users": "x"})
    return pair_arms(renamed, columns=("n", "x")).selectExpr(
        "*", "x_control / n_control AS p_control", "x_treatment / n_treatment AS p_treatment"
    )


def ztest_pooled(counts: DataFrame) -> DataFrame:
    """Pooled two-proportion z test on (converted, total) counts, treatment minus control."""
    share = "((x_control + x_treatment) / (n_control + n_treatment))"
    error = f"sqrt({share} * (1 - {share}) * (1 / n_control + 1 / n_treatment))"
    return (
        _pair_counts(counts)
        .selectExpr("*", f"try_divide(p_treatment - p_control, {error}) AS z")
        .selectExpr("*", f"{two_sided_p('z')} AS p_value")
    )


def newcombe_ci(counts: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Newcombe's hybrid score interval for the difference of two proportions."""
    q = double(Z_CRITICAL[confidence])

    def wilson(arm: str, sign: str) -> str:
        n, p = f"n_{arm}", f"p_{arm}"
        half = f"{q} * sqrt({p} * (1 - {p}) / {n} + {q} * {q} / (4 * {n} * {n}))"
        return f"({p} + {q} * {q} / (2 * {n}) {sign} {half}) / (1 + {q} * {q} / {n})"

    bounds = [
        f"{wilson(arm, sign)} AS _{side}_{arm}"
        for arm in ("control", "treatment")
        for sign, side in (("-", "low"), ("+", "high"))
    ]
    below = "hypot(p_treatment - _low_treatment, _high_control - p_control)"
    above = "hypot(_high_treatment - p_treatment, p_control - _low_control)"
    return (
        _pair_counts(counts)
        .selectExpr("*", "p_treatment - p_control AS delta", *bounds)
        .selectExpr(
            "* EXCEPT (_low_control, _high_control, _low_treatment, _high_treatment)",
            f"delta - {below} AS ci_low",
            f"delta + {above} AS ci_high",
        )
    )
