"""One roll-up of the outcomes from which every analysis follows.

Outcome rows are combined once per user, metric and day, on both sides of the experiment's window, before
they meet the exposures.  What is stored then has the arm and the time of exposure beside the moments, so
user values, daily moments, pre-trends and event-study cells are aggregates of it: the outcomes are read
and exchanged once, however many results are computed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from armlift.functions.scalars import bucket_start, event_time_k
from armlift.operators.event_study import SERIES
from armlift.operators.grain import _literal, arms, merge_moments, user_moments
from armlift.operators.metrics import CELL
from armlift.operators.windows import lookup, registry_window
from armlift.sources.schemas import KEY, MetricSpec

_FAR = "TIMESTAMP'9999-12-31'"
_DAYS = {"day": 1, "week": 7}


def _placed(outcomes: DataFrame, registry: DataFrame, event: tuple[str, int, int] | None) -> DataFrame:
    """Rows with ``day``, ``inside`` (the window, or no window to test) and ``near`` (the event study's reach)."""
    window = registry_window(registry)
    rows = outcomes.withColumn("day", F.to_date("ts"))
    if window is None:
        return rows.withColumns({"inside": F.lit(True), "near": F.lit(False)})
    start, end, ts = F.col("window_start"), F.col("window_end"), F.col("ts")
    near = F.lit(False)
    if event is not None:
        grain, pre, post = event
        back, ahead = (F.make_dt_interval(F.lit(n * _DAYS[grain])) for n in (pre, post))
        near = F.coalesce(ts.between(start - back, start + ahead), F.lit(False))
    inside = start.isNull() | end.isNull() | ts.between(start, end)
    placed = lookup(rows, window, sized_by=registry)
    return placed.withColumns({"inside": F.coalesce(inside, F.lit(False)), "near": near}).drop("window_start", "window_end")


def user_days(
    outcomes: DataFrame,
    exposures: DataFrame,
    registry: DataFrame,
    specs: Sequence[MetricSpec] = (),
    event: tuple[str, int, int] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Moments per exposed user, metric, day and side of the window, with arm and exposure.

    ``event`` (grain, buckets before, buckets after) marks the rows an event study reaches.  ``first_value``
    and ``first_ts`` are the earliest value and its time; they cost one more aggregation and are there
    if a spec needs them.  Undated rows are in the day NULL.
    """
    by = ["day", "inside", "near"]
    rows = _placed(outcomes, registry, event)
    if any(s.agg == "first" for s in specs):
        timed = user_moments(rows, *by, "ts").withColumn("_time", F.expr(f"coalesce(ts, {_FAR})"))
        full = [*KEY, "metric_name", *by]
        first = timed.groupBy(*full).agg(
            F.expr("min_by(lowest, _time) FILTER (WHERE lowest IS NOT NULL) AS first_value"),
            F.expr("min(_time) FILTER (WHERE lowest IS NOT NULL) AS first_ts"),
        )
        same = [F.col(f"m.{c}").eqNullSafe(F.col(f"f.{c}")) for c in full]
        days = merge_moments(timed, *full).alias("m").join(first.alias("f"), same).select("m.*", "first_value", "first_ts")
    else:
        days = user_moments(rows, *by)
    return days.join(arms(exposures, "exposure_ts", unique=unique), KEY)


_FROM_DAYS = {
    "sum": "sum(total) FILTER (WHERE {here})",
    "mean": "try_divide(sum(total) FILTER (WHERE {here}), sum(n) FILTER (WHERE {here}))",
    "max": "max(highest) FILTER (WHERE {here})",
    "min": "min(lowest) FILTER (WHERE {here})",
    "first": "min_by(first_value, first_ts) FILTER (WHERE {here} AND first_value IS NOT NULL)",
}


def user_values(
    days: DataFrame, exposures: DataFrame, specs: Sequence[MetricSpec], names: Sequence[str], unique: bool = False
) -> DataFrame:
    """The table of :func:`armlift.operators.grain.user_columns`, from the roll-up."""
    wanted = days.where(F.col("metric_name").isin([s.name for s in specs]))
    chosen = [
        F.expr(f"{_FROM_DAYS[s.agg].format(here=f'metric_name = {_literal(s.name)}')} AS `{n}`")
        for s, n in zip(specs, names)
    ]
    return arms(exposures, unique=unique).join(wanted.groupBy(*KEY).agg(*chosen), KEY, "left")


def totals(days: DataFrame) -> DataFrame:
    """The roll-up as outcome rows, a total a row, for what adds values up."""
    return days.select(*KEY, "metric_name", F.col("total").alias("value"))


def daily_moments(days: DataFrame, specs: Sequence[MetricSpec]) -> DataFrame:
    """The table of :func:`armlift.operators.metrics.daily_moments`, from the roll-up."""
    uncut = F.col("metric_name").isin([s.name for s in specs if s.period != "post"])
    listed = days.where(F.col("metric_name").isin([s.name for s in specs]) & (uncut | F.col("inside")))
    return merge_moments(listed, *CELL, "day")


def pretrend_daily(days: DataFrame, metric: str = "pre_revenue") -> DataFrame:
    """The table of :func:`armlift.operators.pretrend.pretrend_daily`, from the roll-up."""
    return (
        days.where(F.col("metric_name") == metric)
        .withColumn("k_days", F.datediff("day", "exposure_ts"))
        .where("k_days < 0")
        .groupBy("experiment_id", "k_days", "variant")
        .agg(F.expr("try_divide(sum(total), sum(n)) AS mean"))
    )


def user_bucket_mean(days: DataFrame, registry: DataFrame, metric: str, grain: str = "day") -> DataFrame:
    """The table of :func:`armlift.operators.event_study.user_bucket_mean`, from a roll-up made for its reach."""
    window = registry_window(registry)
    near = lookup(days.where((F.col("metric_name") == metric) & F.col("near")), window, sized_by=registry)
    bucket = bucket_start(F.col("day").cast("timestamp"), grain)
    return (
        near.withColumn("bucket", bucket)
        .withColumn("k", event_time_k(F.col("bucket"), F.col("window_start"), grain))
        .groupBy(*SERIES, "variant", "user_id", "bucket", "k")
        .agg(F.expr("try_divide(sum(total), sum(n)) AS y"))
        .select(*SERIES, "variant", "user_id", F.col("bucket").cast("timestamp").alias("bucket_ts"), "k", "y")
    )
