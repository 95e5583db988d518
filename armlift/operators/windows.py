"""Experiment windows taken from the registry, applied without a skewed join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Accepted names of the window columns, in order of preference.
START_NAMES = ("start_ts", "start_time", "start_datetime", "start_date", "experiment_start_ts")
END_NAMES = ("end_ts", "end_time", "end_datetime", "end_date", "experiment_end_ts")

# A per-experiment table is broadcast up to this many rows and bytes of ids.
BROADCAST_ROWS = 100_000
BROADCAST_ID_BYTES = 8 << 20
# Beyond that, the number of parts an experiment's facts are spread over.
SPREAD = 64


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether a per-experiment table is within the bounds, read no further than they reach."""
    rows, id_bytes = (
        dim.limit(BROADCAST_ROWS + 1)
        .agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("experiment_id")), F.lit(0)))
        .first()
    )
    return rows <= BROADCAST_ROWS and id_bytes <= BROADCAST_ID_BYTES


def lookup(
    facts: DataFrame,
    dim: DataFrame,
    spread_by: str = "user_id",
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Left join of a per-experiment table to facts, safe for an experiment of any size.

    ``dim`` has at most one row per experiment.  It is counted first (or
    ``sized_by`` is, a cheaper table with no fewer rows) and broadcast while
    it is small.  Otherwise both sides are shuffled, with a
    salt taken from ``spread_by`` in the key and ``dim`` repeated once per
    salt: one experiment's facts are spread over many tasks, and the adaptive
    planner may split those further.
    """
    if fits_broadcast(dim if sized_by is None else sized_by):
        return facts.join(F.broadcast(dim), "experiment_id", "left")
    salted = facts.selectExpr("*", f"pmod(xxhash64({spread_by}), {SPREAD}) AS _salt")
    repeated = dim.selectExpr("*", f"explode(sequence(0L, {SPREAD - 1}L)) AS _salt")
    return salted.join(repeated.hint("merge"), ["experiment_id", "_salt"], "left").drop("_salt")


def registry_window(registry: DataFrame) -> DataFrame | None:
    """(experiment_id, window_start, window_end), or None when the columns are absent."""
    start = next((c for c in START_NAMES if c in registry.columns), None)
    end = next((c for c in END_NAMES if c in registry.columns), None)
    if not (start and end):
        return None
    return registry.groupBy("experiment_id").agg(
        F.min(F.col(start).cast("timestamp")).alias("window_start"),
        F.max(F.col(end).cast("timestamp")).alias("window_end"),
    )


def window_filter(
    outcomes: DataFrame, registry: DataFrame, pre: Column | None = None
) -> DataFrame:
    """Cut post-period outcomes to their experiment's window, both ends included.

    Rows of a pre-period metric (``pre_`` prefix, or ``pre`` if given) always
    stay.  Experiments with no registry row, or with an open window, are not
    cut.  A post row without a time is dropped when there is a window to test.
    """
    window = registry_window(registry)
    if window is None:
        return outcomes
    pre = F.col("metric_name").startswith("pre_") if pre is None else pre
    unbounded = F.col("window_start").isNull() | F.col("window_end").isNull()
    inside = F.col("ts").between(F.col("window_start"), F.col("window_end"))
    return (
        lookup(outcomes, window, sized_by=registry)
        .where(pre | unbounded | inside)
        .drop("window_start", "window_end")
    )


def window_from_registry(registry: DataFrame, exposures: DataFrame) -> DataFrame:
    """(experiment_id, start_ts, end_ts, window_status) of every registered or exposed experiment.

    The registry's window if both of its ends are set (``REGISTRY``), else first
    and last exposure (``EXPOSURES``), else two NULLs (``NO_WINDOW``), which
    leaves the other experiments alone.  Exposures are reduced to two times per
    experiment before they meet the registry, so no row of them is joined.
    """
    columns = ["experiment_id", "start_ts", "end_ts", "window_status"]
    window = registry_window(registry)
    if window is None:
        window = registry.select("experiment_id").distinct().selectExpr(
            "experiment_id", "CAST(NULL AS TIMESTAMP) AS window_start", "CAST(NULL AS TIMESTAMP) AS window_end"
        )
    window = window.where("experiment_id IS NOT NULL")
    both_ends = "window_start IS NOT NULL AND window_end IS NOT NULL"
    closed = window.where(both_ends).selectExpr(
        "experiment_id", "window_start AS start_ts", "window_end AS end_ts", "'REGISTRY' AS window_status"
    )
    open_ids = window.where(f"NOT ({both_ends})").select("experiment_id")
    first_last = exposures.where("experiment_id IS NOT NULL").groupBy("experiment_id").agg(
        F.min("exposure_ts").cast("timestamp").alias("start_ts"),
        F.max("exposure_ts").cast("timestamp").alias("end_ts"),
    )
    seen = first_last.join(closed.select("experiment_id"), "experiment_id", "left_anti")
    logged = seen.join(open_ids, "experiment_id", "full_outer").withColumn(
        "window_status", F.when(F.col("start_ts").isNull(), "NO_WINDOW").otherwise("EXPOSURES")
    )
    return closed.unionByName(logged.select(*columns))


def event_window(
    outcomes: DataFrame,
    registry: DataFrame,
    grain: str = "day",
    pre_buckets: int = 28,
    post_buckets: int = 28,
) -> DataFrame:
    """Outcomes within a number of days or weeks of the registered start, with ``start_ts``."""
    window = registry_window(registry)
    if window is None:
        raise ValueError("an event window needs a start and an end column in the registry")
    days = {"day": 1, "week": 7}[grain]
    start = F.col("window_start")
    earliest = start - F.make_dt_interval(F.lit(pre_buckets * days))
    latest = start + F.make_dt_interval(F.lit(post_buckets * days))
    return (
        lookup(outcomes, window, sized_by=registry)
        .where(F.col("ts").between(earliest, latest))
        .withColumnRenamed("window_start", "start_ts")
        .drop("window_end")
    )
