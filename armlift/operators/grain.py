"""From event grain to user grain: exposure joins, roll-ups and moment merging.

Outcomes are combined per user before they meet the exposures.  Both sides of
that join then have at most a few rows per user, so a user with a huge history
is reduced on the map side and never lands whole in one join task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from armlift.operators.exposure import dedup_exposures
from armlift.sources.schemas import KEY, MetricSpec

USER_METRIC = [*KEY, "metric_name"]


def arms(exposures: DataFrame, *extra: str, unique: bool = False) -> DataFrame:
    """(experiment_id, user_id, variant, ...), one row per user.

    ``unique`` states that ``exposures`` already are, as the canonical table is;
    they are then not aggregated again.
    """
    if not unique:
        exposures = dedup_exposures(exposures.select(*KEY, "variant", "exposure_ts"))
    return exposures.select(*KEY, "variant", *extra)


def join_inner_exposed(outcomes: DataFrame, exposures: DataFrame) -> DataFrame:
    """Outcome rows of exposed users with their arm.

    ``exposures`` must already hold one row per (experiment, user), as the
    canonical table does.  Its shuffle then feeds the sort-merge join directly,
    which lets the adaptive planner split a user whose outcomes are too many
    for one task.
    """
    return outcomes.join(exposures.select(*KEY, "variant"), KEY, "inner")


def join_left_exposed(outcomes: DataFrame, exposures: DataFrame) -> DataFrame:
    """Every outcome row with the arm of its user, NULL where the user was not exposed.

    Exposures are taken as they are: a user exposed twice yields two rows.
    """
    return outcomes.join(exposures.select(*KEY, "variant"), KEY, "left")


# Roll-ups from per-time parts (total, n, lowest, highest), one row per user, metric and time.
# ``first`` takes the earliest value; undated rows sort last and ties go to the smaller value.
_FROM_PARTS = {
    "sum": "sum(total) {filter}",
    "mean": "try_divide(sum(total) {filter}, sum(n) {filter})",
    "max": "max(highest) {filter}",
    "min": "min(lowest) {filter}",
    "first": "min_by(lowest, coalesce(ts, TIMESTAMP'9999-12-31')) {first}",
}
_FROM_ROWS = {
    "sum": "sum(value) {filter}", "mean": "avg(value) {filter}",
    "max": "max(value) {filter}", "min": "min(value) {filter}",
}


def _rollups(outcomes: DataFrame, by: Sequence[str], forms: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """Roll-ups (agg, name, metric or None for all rows) of ``value`` per ``by``, all by hash aggregation.

    The earliest value needs the rows of one time combined first: their order
    is then unique, and the state a time and a value.  Everything else follows
    from the same parts; without a ``first`` the rows are rolled up directly.
    """
    parts = any(agg == "first" for agg, _, _ in forms)
    if parts:
        outcomes = outcomes.groupBy(*USER_METRIC, "ts").agg(
            F.sum("value").alias("total"),
            F.count("value").alias("n"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
    text = _FROM_PARTS if parts else _FROM_ROWS
    chosen = []
    for agg, name, metric in forms:
        only = [] if metric is None else [f"metric_name = {_literal(metric)}"]
        where = lambda tests: f"FILTER (WHERE {' AND '.join(tests)})" if tests else ""
        body = text[agg].format(filter=where(only), first=where([*only, "lowest IS NOT NULL"]))
        chosen.append(F.expr(f"{body} AS `{name}`"))
    return outcomes.groupBy(*by).agg(*chosen)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def user_rollup(outcomes: DataFrame, forms: dict[str, str] | None = None) -> DataFrame:
    """One row per user and metric, with one column per roll-up in ``forms`` (agg -> name)."""
    forms = forms or {"sum": "value"}
    return _rollups(outcomes, USER_METRIC, [(agg, name, None) for agg, name in forms.items()])


def user_columns(
    outcomes: DataFrame,
    exposures: DataFrame,
    specs: Sequence[MetricSpec],
    names: Sequence[str],
    how: str = "left",
    unique: bool = False,
) -> DataFrame:
    """One row per exposed user: arm and one column per metric (NULL when it has none).

    All metrics are rolled up in a single aggregation on (experiment, user),
    and the exposures are deduplicated on the same key unless ``unique``, so each
    table is shuffled once and the join needs no further exchange.  A metric's
    earliest value costs one aggregation more, on its rows' times.
    """
    wanted = outcomes.where(F.col("metric_name").isin([s.name for s in specs]))
    per_user = _rollups(wanted, KEY, [(s.agg, n, s.name) for s, n in zip(specs, names)])
    return arms(exposures, unique=unique).join(per_user, KEY, how)


def user_pivot(
    outcomes: DataFrame,
    exposures: DataFrame,
    target: str = "revenue",
    covariate: str = "pre_revenue",
    agg: str = "first",
) -> DataFrame:
    """Complete cases: exposed users with both a target ``y`` and a covariate ``x``."""
    specs = [MetricSpec(target, agg), MetricSpec(covariate, agg)]
    return user_columns(outcomes, exposures, specs, ["y", "x"], "inner").dropna(subset=["y", "x"])


def user_pivot_zero(
    outcomes: DataFrame,
    exposures: DataFrame,
    target: str = "revenue",
    covariate: str = "pre_revenue",
) -> DataFrame:
    """Exposed users with any row of the two metrics; rows of the other metric count as 0."""
    wanted = outcomes.where(F.col("metric_name").isin(target, covariate))
    per_user = wanted.groupBy(*KEY).agg(
        *[
            F.max(F.when(F.col("metric_name") == name, F.col("value")).otherwise(F.lit(0.0))).alias(c)
            for c, name in (("y", target), ("x", covariate))
        ]
    )
    return arms(exposures).join(per_user, KEY)


def user_moments(outcomes: DataFrame, *extra: str | Column) -> DataFrame:
    """Per user and metric: row count, sum, squared deviations, minimum and maximum."""
    return outcomes.groupBy(*USER_METRIC, *extra).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("value").alias("n"),
        F.sum("value").alias("total"),
        F.expr("var_pop(value) * count(value)").alias("m2"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


# Mean and sample variance from merged moments.
MEAN = "try_divide(total, n)"
VARIANCE = "CASE WHEN n > 1 THEN m2 / (n - 1) END"

# Squared deviations of all rows from those of their parts.  Deviations within
# parts add up.  Those between parts are the weighted sum of n_i (mean_i -
# mean)^2, written with two covariances over the parts (of total and of count
# against the part's mean) so that no large squares are subtracted.
_MERGED_M2 = """
  greatest(
    sum(m2) + count(total) * (
      covar_pop(total, try_divide(total, n))
      - try_divide(sum(total), sum(n)) * covar_pop(n, try_divide(total, n))
    ), 0D
  ) AS m2
"""


def merge_moments(parts: DataFrame, *by: str) -> DataFrame:
    """Moments per group from moments of parts; the columns stay those of user_moments."""
    return parts.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.expr(_MERGED_M2),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
    )
