"""Data-quality reports.  One pass per table, every experiment at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from armlift.operators.windows import lookup, registry_window
from armlift.sources.schemas import KEY
from armlift.sources.tables import table_counts

_CLOCK = "yyyy-MM-dd HH:mm:ss"


def dq_summary(exposures: DataFrame, outcomes: DataFrame, registry: DataFrame) -> DataFrame:
    """(experiment_id, check_name, value): row counts, missing users and the exposure range."""
    rows = F.count(F.lit(1)).cast("string")
    no_user = F.count_if(F.col("user_id").isNull()).cast("string")
    clock = lambda c: F.date_format(c, _CLOCK)
    checks = [
        (
            exposures,
            {
                "exposures_rows": rows,
                "exposures_null_user_id": no_user,
                "min_exposure_ts": clock(F.min("exposure_ts")),
                "max_exposure_ts": clock(F.max("exposure_ts")),
            },
        ),
        (outcomes, {"outcomes_rows": rows, "outcomes_null_user_id": no_user}),
        (registry, {"registry_rows": rows}),
    ]
    parts = [
        df.groupBy("experiment_id")
        .agg(*[value.alias(name) for name, value in found.items()])
        .unpivot("experiment_id", list(found), "check_name", "value")
        for df, found in checks
    ]
    return reduce(DataFrame.unionByName, parts)


def dq_variant_dist(exposures: DataFrame) -> DataFrame:
    return exposures.groupBy("experiment_id", "variant").agg(F.count(F.lit(1)).alias("rows"))


def dq_metric_dist(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("experiment_id", "metric_name").agg(F.count(F.lit(1)).alias("rows"))


def dq_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def dq_leakage(outcomes: DataFrame, exposures: DataFrame, registry: DataFrame) -> DataFrame:
    """Timestamp leakage per experiment and metric.

    Counts post outcomes before the user's exposure, pre outcomes at or after
    it, post outcomes outside the experiment window, and outcomes without a
    time.  The window is attached to the users, not to the outcomes.

    ``exposures`` holds one row per (experiment, user), so its shuffle feeds
    the join directly and a user with too many outcomes can be split.
    """
    users = exposures.select(*KEY, "exposure_ts")
    window = registry_window(registry)
    bounds = ["window_start", "window_end"]
    if window is None:
        users = users.selectExpr("*", *[f"CAST(NULL AS TIMESTAMP) AS {c}" for c in bounds])
    else:
        users = lookup(users, window, sized_by=registry)
    joined = outcomes.join(users, KEY)
    pre = F.col("metric_name").startswith("pre_")
    outside = ~F.col("ts").between(F.col("window_start"), F.col("window_end"))
    return joined.groupBy("experiment_id", "metric_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(~pre & (F.col("ts") < F.col("exposure_ts"))).alias("post_before_exposure"),
        F.count_if(pre & (F.col("ts") >= F.col("exposure_ts"))).alias("pre_after_exposure"),
        F.count_if(~pre & outside).alias("post_outside_window"),
        F.count_if(F.col("ts").isNull()).alias("undated"),
    )


def ingest_balance(
    logged: dict[str, DataFrame], canonical: dict[str, DataFrame], kept_out: dict[str, DataFrame]
) -> DataFrame:
    """(table_name, experiment_id, logged_rows, canonical_rows, quarantined_rows, repeated_rows).

    What was logged is in the table, in the quarantine, or a repeat of a row in the table: ``repeated_rows``
    is what remains, and not below zero unless rows were made up.  A missing id is an id like others.
    """
    places = {"logged_rows": logged, "canonical_rows": canonical, "quarantined_rows": kept_out}
    parts = [
        table_counts(found).select("table_name", "experiment_id", F.lit(place).alias("place"), "rows")
        for place, found in places.items()
    ]
    found = reduce(DataFrame.unionByName, parts).groupBy("table_name", "experiment_id").agg(
        *[F.expr(f"coalesce(sum(rows) FILTER (WHERE place = '{place}'), 0L) AS {place}") for place in places]
    )
    return found.withColumn("repeated_rows", F.expr("logged_rows - canonical_rows - quarantined_rows"))


def dq_rowcount_delta(raw: DataFrame, canonical: DataFrame) -> DataFrame:
    """Rows per experiment before and after canonicalisation."""
    counted = lambda df, name: df.groupBy("experiment_id").agg(F.count(F.lit(1)).alias(name))
    both = counted(raw, "raw_rows").join(
        counted(canonical, "canonical_rows"), "experiment_id", "full_outer"
    )
    filled = both.fillna(0, ["raw_rows", "canonical_rows"])
    return filled.withColumn("dropped_rows", F.col("raw_rows") - F.col("canonical_rows"))
