"""Decisions from result tables: guardrails, precision, agreement, latest run, memo text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from armlift.functions.scalars import format_general

RESULT_KEY = ["experiment_id", "metric_name"]


def results_latest(results: DataFrame, keys: Sequence[str] = RESULT_KEY) -> DataFrame:
    """The newest row per key by (analysis_ts, computed_ts)."""
    newest = F.max_by(F.struct(*results.columns), F.struct("analysis_ts", "computed_ts"))
    return results.groupBy(*keys).agg(newest.alias("row")).select("row.*")


NOT_EVALUATED = "NOT_EVALUATED"


def _roles(registry: DataFrame) -> DataFrame:
    """(experiment_id, metric_name, role) once per registered metric; a guardrail stays one."""
    role = lambda column, name: F.expr(
        f"transform(coalesce({column}, array()), m -> named_struct('m', m, 'r', '{name}'))"
    )
    both = F.concat(role("guardrail_metrics", "guardrail"), role("primary_metrics", "primary"))
    listed = registry.select("experiment_id", F.explode(both).alias("x"))
    return (
        listed.groupBy("experiment_id", F.col("x.m").alias("metric_name"))
        .agg(F.count_if(F.col("x.r") == "guardrail").alias("guards"))
        .where("metric_name IS NOT NULL")
        .selectExpr("experiment_id", "metric_name", "if(guards > 0, 'guardrail', 'primary') AS role")
    )


def guardrail_flags(
    results: DataFrame, registry: DataFrame, lower_is_better: Sequence[str] = ()
) -> DataFrame:
    """Every registered metric and every result, with its role and whether it is harmed.

    FAIL when the whole interval lies on the harmful side of zero, PASS when it
    does not, NOT_EVALUATED when the guardrail has no result or no interval; only
    guardrails get a status.  A registry id given several times counts once.
    """
    harmed = F.when(
        F.col("metric_name").isin(list(lower_is_better)), F.col("ci_low") > 0
    ).otherwise(F.col("ci_high") < 0)
    status = (
        F.when(F.col("ci_low").isNull() | F.col("ci_high").isNull(), NOT_EVALUATED)
        .when(harmed, "FAIL")
        .otherwise("PASS")
    )
    return (
        _roles(registry)
        .join(results.select(*RESULT_KEY, "delta", "ci_low", "ci_high"), RESULT_KEY, "full_outer")
        .withColumn("role", F.coalesce("role", F.lit("secondary")))
        .withColumn("guardrail_status", F.when(F.col("role") == "guardrail", status))
        .select(*RESULT_KEY, "role", "delta", "ci_low", "ci_high", "guardrail_status")
    )


def precision_scaling(results: DataFrame) -> DataFrame:
    """Interval width of every experiment against the smallest one, per metric.

    ``width_ratio`` is the smallest experiment's width over this one's; under
    root-n scaling it should be near ``expected_ratio``.
    """
    sized = results.selectExpr(
        *RESULT_KEY,
        "n_control + n_treatment AS n_users",
        "ci_high - ci_low AS ci_width",
        "try_divide(abs(delta), ci_high - ci_low) AS effect_to_width",
    )
    smallest = sized.groupBy("metric_name").agg(
        F.min_by(
            F.struct("experiment_id", "n_users", "ci_width"), F.struct("n_users", "experiment_id")
        ).alias("base")
    )
    return sized.join(smallest, "metric_name").selectExpr(
        *sized.columns,
        "base.experiment_id AS base_experiment_id",
        "try_divide(base.ci_width, ci_width) AS width_ratio",
        "sqrt(n_users / base.n_users) AS expected_ratio",
    )


def validate_tolerance(
    platform: DataFrame,
    manual: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = RESULT_KEY,
    tolerance: float = 1e-6,
) -> DataFrame:
    """Cell-by-cell agreement of two result tables: (keys, column, both values, within)."""
    left = platform.select(*keys, *columns).unpivot(list(keys), list(columns), "quantity", "platform")
    right = manual.select(*keys, *columns).unpivot(list(keys), list(columns), "quantity", "manual")
    agree = F.abs(F.col("platform") - F.col("manual")) < tolerance
    both_null = F.col("platform").isNull() & F.col("manual").isNull()
    return (
        left.join(right, [*keys, "quantity"], "full_outer")
        .withColumn("within_tolerance", F.coalesce(agree, both_null))
    )


def results_json(results: DataFrame, analysis: str = "ab") -> DataFrame:
    """One JSON document per experiment: {"experiment_id", "analysis", "results": [...]}.

    A document holds one object per metric of the experiment.
    """
    row = F.struct(*[c for c in results.columns if c != "experiment_id"])
    document = F.struct(
        "experiment_id",
        F.lit(analysis).alias("analysis"),
        F.sort_array(F.collect_list(row)).alias("results"),
    )
    return results.groupBy("experiment_id").agg(F.to_json(document).alias("document"))


def decision_summary(
    ab: DataFrame,
    cuped: DataFrame,
    did: DataFrame,
    pretrend: DataFrame,
    flags: DataFrame,
    registry: DataFrame,
) -> DataFrame:
    """One memo row per registered experiment: decision inputs as columns and a text body.

    The table in the body has one line per metric with a result or a role.  The
    verdict is PASS only if every guardrail is; FAIL if one is harmed, else
    NOT_EVALUATED if one could not be judged or none is registered.
    """
    g = lambda *columns: [format_general(c) for c in columns]
    shown = lambda **named: ", ', ', ".join(f"'{k}=', {format_general(c)}" for k, c in named.items())
    values = g("mean_control", "mean_treatment", "delta", "rel_lift", "ci_low", "ci_high", "p_value")
    cells = ["metric_name", *values, "coalesce(method, 'no result')", "coalesce(guardrail_status, '-')"]
    lines = (
        flags.select(*RESULT_KEY, "guardrail_status")
        .join(ab, RESULT_KEY, "left")
        .selectExpr(
            "experiment_id",
            "guardrail_status",
            "method IS NOT NULL AS tested",
            f"concat('| ', concat_ws(' | ', {', '.join(cells)}), ' |') AS line",
        )
        .groupBy("experiment_id")
        .agg(
            F.expr("count_if(tested) AS metrics"),
            F.expr(
                "CASE WHEN count_if(guardrail_status = 'FAIL') > 0 THEN 'FAIL'"
                f" WHEN count(guardrail_status) = 0 OR count_if(guardrail_status = '{NOT_EVALUATED}') > 0"
                f" THEN '{NOT_EVALUATED}' ELSE 'PASS' END AS guardrail_status"
            ),
            F.expr("array_join(sort_array(collect_list(line)), '\n') AS ab_table"),
        )
    )
    registered = registry.select("experiment_id").where("experiment_id IS NOT NULL").distinct()
    cuped_text = shown(
        theta="theta", delta_cuped="delta_cuped",
        ci_low_cuped="ci_low_cuped", ci_high_cuped="ci_high_cuped",
    )
    did_text = shown(did="did", se="se", p="p_value")
    trend_text = f"{shown(slope='slope', p='p_value')}, ', verdict=', verdict"
    part = lambda df, text, name: df.selectExpr("experiment_id", f"concat({text}) AS {name}")
    trend = pretrend.selectExpr(
        "experiment_id", "verdict", f"concat({trend_text}) AS pretrend_text"
    )
    columns = ("metric", "control", "treatment", "delta", "rel lift", "CI low", "CI high", "p",
               "method", "guardrail")
    optional = lambda title, c: f"concat('{title}: ', coalesce({c}, 'not available'))"
    body = ", ".join(
        [
            "concat('# Decision memo: ', experiment_id)",
            f"'| {' | '.join(columns)} |'",
            "coalesce(ab_table, 'no metric')",
            optional("CUPED", "cuped_text"),
            optional("DiD", "did_text"),
            optional("Pre-trend", "pretrend_text"),
            f"concat('Guardrails: ', coalesce(guardrail_status, '{NOT_EVALUATED}'))",
        ]
    )
    return (
        registered.join(lines, "experiment_id", "left")
        .join(part(cuped, cuped_text, "cuped_text"), "experiment_id", "left")
        .join(part(did, did_text, "did_text"), "experiment_id", "left")
        .join(trend, "experiment_id", "left")
        .selectExpr(
            "experiment_id",
            "coalesce(metrics, 0L) AS metrics",
            f"coalesce(guardrail_status, '{NOT_EVALUATED}') AS guardrail_status",
            "coalesce(verdict, 'not available') AS pretrend_verdict",
            f"concat_ws('\n', {body}) AS memo",
        )
    )
