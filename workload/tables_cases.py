"""Ingest, contracts, writes (survey section 2.1)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from armlift.functions.scalars import TIMESTAMP_LAYOUTS, coerce_timestamp as coerce
from armlift.operators import ab, metrics, quality, replays, summary
from armlift.operators.exposure import dedup_exposures as dedup
from armlift.plans import experiment
from armlift.sources import contracts, readers, tables
from armlift.sources.schemas import MetricSpec
from workload import fixtures as fx
from workload.case import case


@case("SELECT * FROM exposures_raw")
def ingest_exposures(spark, sf):
    return fx.exposures_logged(spark, sf)


@case("SELECT * FROM outcomes", digits="value")
def ingest_outcomes(spark, sf):
    return readers.align_outcomes(fx.outcomes_raw(spark, sf))


def _raw_registry(spark, sf) -> DataFrame:
    """One experiment per order priority, logged without owner, guardrails or notes."""
    orders = fx.table(spark, sf, "orders")
    return orders.groupBy(F.concat(F.lit("exp_"), "o_orderpriority").alias("experiment_id")).agg(
        F.min("o_orderdate").alias("start_ts"),
        F.max("o_orderdate").alias("end_ts"),
        F.array(F.lit("control"), F.lit("treatment")).alias("variants"),
        F.array(F.lit("revenue")).alias("primary_metrics"),
        F.count(F.lit(1)).alias("unused_extra"),
    )


@case(
    """
    SELECT 'exp_' || o_orderpriority AS experiment_id, NULL::VARCHAR AS name, min(o_orderdate) AS start_ts,
           max(o_orderdate) AS end_ts, NULL::VARCHAR AS owner, 'control,treatment' AS variants,
           'revenue' AS primary_metrics, 0 AS guardrail_count, NULL::VARCHAR AS notes
    FROM orders GROUP BY ALL
    """
)
def ingest_registry(spark, sf):
    found = readers.align_registry(_raw_registry(spark, sf))
    return found.select(
        "experiment_id", "name", "start_ts", "end_ts", "owner",
        F.array_join("variants", ",").alias("variants"),
        F.array_join("primary_metrics", ",").alias("primary_metrics"),
        F.size("guardrail_metrics").alias("guardrail_count"),
        "notes",
    )


# Default scenario parameters.
PARAM_DEFAULTS = {
    "seed": 7,
    "start_date": "2026-01-01",
    "days": 14,
    "n_users": 50000,
    "exposure_rate": 0.85,
    "treatment_share": 0.5,
    "base_conversion": 0.10,
    "effect_lift_conversion": 0.05,
    "revenue_mean": 12.5,
    "revenue_sd": 3.0,
    "pre_period_days": 14,
}


@case(
    """
    SELECT 'exp_nation_' || c_nationkey AS experiment_id, 7 AS seed, '2026-01-01' AS start_date,
           CASE WHEN count(*) > (SELECT count(*) / 25 FROM customer) THEN 28 ELSE 14 END AS days,
           count(*)::INTEGER AS n_users, 0.85::DOUBLE AS exposure_rate, 0.5::DOUBLE AS treatment_share,
           0.10::DOUBLE AS base_conversion, 0.05::DOUBLE AS effect_lift_conversion,
           CASE WHEN avg(c_acctbal) > 4500 THEN avg(c_acctbal) / 1000 ELSE 12.5 END AS revenue_mean,
           3.0::DOUBLE AS revenue_sd, 14 AS pre_period_days
    FROM customer GROUP BY c_nationkey
    """,
    digits="exposure_rate treatment_share base_conversion effect_lift_conversion revenue_mean revenue_sd",
)
def experiment_params(spark, sf):
    customers = fx.table(spark, sf, "customer")
    share = customers.agg((F.count(F.lit(1)) / 25).alias("share"))
    sized = customers.groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("n_users"), F.avg("c_acctbal").alias("balance")
    )
    overrides = sized.join(F.broadcast(share)).select(
        F.concat(F.lit("exp_nation_"), F.col("c_nationkey")).alias("experiment_id"),
        "n_users",
        F.when(F.col("n_users") > F.col("share"), 28).alias("days"),
        F.when(F.col("balance") > 4500, F.col("balance") / 1000).alias("revenue_mean"),
    )
    return readers.resolve_params(overrides, PARAM_DEFAULTS)


def _arms_by_experiment(spark, path) -> DataFrame:
    stored = tables.read_table(spark, path)
    return stored.groupBy("experiment_id", "variant").agg(
        F.count(F.lit(1)).alias("rows"), F.count("user_id").alias("users")
    )


@case(
    """
    SELECT experiment_id, variant, count(*) AS rows, count(user_id) AS users FROM exposures_raw
    WHERE experiment_id = 'exp_orders_a' GROUP BY ALL
    UNION ALL
    SELECT experiment_id, variant, count(*), count(user_id) FROM exposures
    WHERE experiment_id = 'exp_orders_b' GROUP BY ALL
    """
)
def replace_partition(spark, sf):
    """Two experiments as logged and one that lost its rows since; one is replaced by its clean rows, twice."""
    path = tables.new_path(spark, "replace_partition")
    raw = fx.exposures_logged(spark, sf)
    lost = raw.where(F.col("experiment_id") == "exp_orders_b").withColumn("experiment_id", F.lit("exp_lost"))
    tables.replace_partitions(raw.unionByName(lost), path)
    tables.replace_partitions(raw, path, ["exp_orders_a", "exp_orders_b", "exp_lost"])
    clean = dedup(raw).where(F.col("experiment_id") == "exp_orders_b")
    for _ in range(2):
        tables.replace_partitions(clean, path)
    return _arms_by_experiment(spark, path)


@case(
    """
    SELECT experiment_id, variant, metric_name, count(*) AS n, avg(value) AS mean
    FROM joined JOIN registry USING (experiment_id)
    WHERE (experiment_id = 'exp_orders_a' OR metric_name = 'revenue')
      AND (metric_name = 'pre_revenue' OR ts BETWEEN start_ts AND end_ts) GROUP BY ALL
    """,
    digits="mean",
)
def delete_append(spark, sf):
    """Aggregates of both experiments, then one rewritten with a single metric."""
    path = tables.new_path(spark, "delete_append")
    inputs = fx.outcomes(spark, sf), fx.exposures(spark, sf), fx.registry(spark)
    tables.replace_partitions(metrics.metric_overall(*inputs), path)
    only_revenue = metrics.metric_overall(*inputs, [MetricSpec("revenue")])
    tables.delete_append(only_revenue, path, ["exp_orders_b"])
    return tables.read_table(spark, path).select(
        "experiment_id", "variant", "metric_name", "n", "mean"
    )


def _row_level_results(spark, sf) -> DataFrame:
    """A/B on raw rows: its counts differ from the user-level results it replaces."""
    return ab.ab_analysis(ab.ab_stats(fx.outcomes(spark, sf), fx.exposures(spark, sf)))


def _user_level_results(spark, sf) -> DataFrame:
    return ab.ab_analysis(
        ab.user_arm_stats(fx.outcomes(spark, sf), fx.exposures(spark, sf), fx.SPECS)
    )


_ROW_COUNTS = """
    SELECT experiment_id, metric_name, count(*) FILTER (variant = 'control') AS n_control,
           avg(value) FILTER (variant = 'treatment') - avg(value) FILTER (variant = 'control') AS delta
    FROM joined GROUP BY ALL
"""


@case(
    f"""
    SELECT experiment_id, metric_name, n_control, delta FROM ab
    WHERE NOT (experiment_id = 'exp_orders_b' AND metric_name IN ('revenue', 'pre_revenue'))
    UNION ALL
    SELECT * FROM ({_ROW_COUNTS}) WHERE experiment_id = 'exp_orders_b' AND metric_name = 'revenue'
    """,
    digits="delta",
)
def delete_append_by_metric(spark, sf):
    """Two metrics of one experiment deleted, one of them appended again."""
    path = tables.new_path(spark, "delete_append_by_metric")
    tables.replace_partitions(_user_level_results(spark, sf), path)
    update = _row_level_results(spark, sf).where(F.col("metric_name") == "revenue")
    tables.delete_append_by_metric(update, path, ["exp_orders_b"], ["revenue", "pre_revenue"])
    return tables.read_table(spark, path).select(
        "experiment_id", "metric_name", "n_control", "delta"
    )


@case(
    f"""
    SELECT experiment_id, metric_name, n_control, delta FROM ab WHERE metric_name <> 'revenue'
    UNION ALL SELECT * FROM ({_ROW_COUNTS}) WHERE metric_name = 'revenue'
    UNION ALL SELECT experiment_id, 'revenue_rows', n_control, delta FROM ({_ROW_COUNTS}) WHERE metric_name = 'revenue'
    """,
    digits="delta",
)
def merge_upsert(spark, sf):
    """Update one metric by key and insert another."""
    path = tables.new_path(spark, "merge_upsert")
    tables.replace_partitions(_user_level_results(spark, sf), path)
    names = F.explode(F.array(F.lit("revenue"), F.lit("revenue_rows")))
    rows = _row_level_results(spark, sf).where(F.col("metric_name") == "revenue")
    update = rows.withColumn("metric_name", names)
    tables.merge_upsert(update, path, ["experiment_id", "metric_name"])
    return tables.read_table(spark, path).select(
        "experiment_id", "metric_name", "n_control", "delta"
    )


@case(
    """
    SELECT experiment_id, metric_name, n_control, mean_control, std_control, n_treatment, mean_treatment,
           std_treatment, delta, se, z, p_value, ci_low, ci_high, NULL::DOUBLE AS rel_lift,
           TRUE AS computed_ts_filled, end_ts - INTERVAL 2 HOUR AS analysis_ts
    FROM ab JOIN registry USING (experiment_id)
    """,
    digits="mean_control std_control mean_treatment std_treatment delta se z p_value:8 ci_low ci_high rel_lift",
)
def normalize_results(spark, sf):
    """Rows without lift or computation time, analysis time as text with an offset, an extra column."""
    text = F.concat(F.date_format("end_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    rows = (
        _user_level_results(spark, sf)
        .join(fx.registry(spark).select("experiment_id", "end_ts"), "experiment_id")
        .withColumn("analysis_ts", text)
        .drop("rel_lift", "end_ts")
    )
    done = readers.normalize_results(rows)
    names = ["computed_ts_filled" if c == "computed_ts" else c for c in done.columns]
    return done.withColumn("computed_ts_filled", F.col("computed_ts").isNotNull()).select(*names)


@case(
    """
    SELECT layout, count(*) AS rows, count(ts) AS parsed, min(ts) AS first_ts, max(ts) AS last_ts
    FROM (SELECT o_orderkey % 8 AS layout,
                 CASE WHEN o_orderkey % 8 < 7 THEN o_orderdate + to_seconds(o_orderkey) END AS ts FROM orders)
    GROUP BY layout
    """
)
def coerce_timestamp(spark, sf):
    """Order times written in every accepted layout, as a timestamp cast to text, and as junk."""
    orders = fx.table(spark, sf, "orders")
    ts = (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_orderkey"))).cast("timestamp")
    layout = F.pmod("o_orderkey", F.lit(8))
    texts = [F.date_format(ts, pattern) for pattern in TIMESTAMP_LAYOUTS]
    texts += [ts.cast("string"), F.concat(F.lit("not a time "), F.col("o_orderkey"))]
    written = F.element_at(F.array(*texts), (layout + 1).cast("int"))
    return (
        orders.select(layout.alias("layout"), coerce(written).alias("ts"))
        .groupBy("layout")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("ts").alias("parsed"),
            F.min("ts").alias("first_ts"),
            F.max("ts").alias("last_ts"),
        )
    )


@case(
    """
    SELECT 'exposures' AS table_name, experiment_id, rule, count(*) AS violations
    FROM (SELECT experiment_id, unnest([CASE WHEN user_id IS NULL THEN 'user_id_missing' END,
                                        CASE WHEN variant NOT IN ('control', 'treatment') THEN 'variant_not_allowed' END,
                                        CASE WHEN unit <> 'user_id' THEN 'unit_not_allowed' END]) AS rule
          FROM exposures_raw)
    WHERE rule IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT 'outcomes', experiment_id, 'ts_column_absent', count(*) FROM outcomes GROUP BY ALL
    UNION ALL
    SELECT 'experiment_registry', 'exp_' || o_orderpriority, unnest(['name_missing', 'primary_metrics_too_few']), 1
    FROM (SELECT DISTINCT o_orderpriority FROM orders)
    """
)
def contract_violations(spark, sf):
    """Faulty exposures, outcomes without a time column, a registry without name and metrics."""
    registry = readers.align_registry(_raw_registry(spark, sf).drop("primary_metrics"))
    checked = [
        contracts.contract_violations(fx.exposures_raw(spark, sf), "exposures"),
        contracts.contract_violations(fx.outcomes(spark, sf).drop("ts"), "outcomes"),
        contracts.contract_violations(registry, "experiment_registry"),
    ]
    return reduce(DataFrame.unionByName, checked)


def _ingested(spark, sf, *logs: DataFrame) -> tuple[str, str]:
    """Folders of the raw and the ingested tables, after one ingest for each outcome log."""
    raw, root = tables.new_path(spark, "raw"), tables.new_path(spark, "ingested")
    fx.exposures_raw(spark, sf).write.parquet(f"{raw}/exposures.parquet")
    fx.registry(spark).write.parquet(f"{raw}/experiment_registry.parquet")
    for log in logs:
        log.write.mode("overwrite").parquet(f"{raw}/outcomes.parquet")
        experiment.ingest(spark, raw, root)
    return raw, root


@case(
    """
    SELECT 'exposures' AS table_name, experiment_id, user_id, variant, NULL::VARCHAR AS metric_name,
           CASE WHEN user_id IS NULL THEN 'user_id_missing' ELSE 'variant_not_allowed,unit_not_allowed' END AS rules,
           NULL::VARCHAR AS logged_value
    FROM exposures_raw WHERE user_id IS NULL OR variant = 'holdout'
    UNION ALL
    SELECT 'outcomes', experiment_id, CASE WHEN digit <> 0 THEN user_id END, NULL,
           CASE WHEN digit IN (0, 2) THEN metric_name END,
           CASE digit WHEN 0 THEN 'user_id_missing' WHEN 1 THEN 'metric_name_missing' WHEN 2 THEN 'value_missing'
             ELSE 'metric_name_missing,value_missing' END || CASE WHEN ts IS NULL THEN ',ts_missing' ELSE '' END,
           CASE digit WHEN 2 THEN 'n/a' WHEN 3 THEN NULL ELSE 'number' END
    FROM keyed WHERE experiment_id = 'exp_orders_a' AND digit < 4
    """
)
def quarantine_rows(spark, sf):
    """A faulty log, ingested; then again after one experiment's outcomes were mended."""
    faulty = fx.outcomes_faulty(spark, sf)
    sound = fx.outcomes_raw(spark, sf).withColumn("value", F.col("value").cast("string"))
    of = lambda df, e: df.where(F.col("experiment_id") == e).select(*faulty.columns)
    mended = of(faulty, "exp_orders_a").unionByName(of(sound, "exp_orders_b"))
    _, root = _ingested(spark, sf, faulty, mended)
    kept_out = experiment.quarantine(spark, root)
    value = F.get_json_object(readers.LOGGED, "$.value")
    shown = {
        "exposures": ("variant", F.lit(None).cast("string"), F.lit(None).cast("string")),
        "outcomes": (F.lit(None).cast("string"), "metric_name", F.when(value == "n/a", value).otherwise(F.nvl2(value, F.lit("number"), value))),
    }
    parts = [
        kept_out[name].select(
            F.lit(name).alias("table_name"), "experiment_id", "user_id",
            *[(F.col(c) if isinstance(c, str) else c).alias(to) for c, to in zip(columns, ("variant", "metric_name", "logged_value"))],
            F.array_join("broken_rules", ",").alias("rules"),
        )
        for name, columns in shown.items()
    ]
    return reduce(DataFrame.unionByName, parts)


@case(
    """
    SELECT 'exposures' AS table_name, experiment_id, count(*) AS logged_rows,
           count(DISTINCT user_id) FILTER (variant <> 'holdout') AS canonical_rows,
           count(*) FILTER (user_id IS NULL OR variant = 'holdout') AS quarantined_rows,
           count(user_id) FILTER (variant <> 'holdout') - count(DISTINCT user_id) FILTER (variant <> 'holdout') AS repeated_rows
    FROM exposures_raw GROUP BY ALL
    UNION ALL
    SELECT 'outcomes', experiment_id, count(*), count(*) FILTER (digit > 3), count(*) FILTER (digit < 4), 0
    FROM keyed GROUP BY ALL
    UNION ALL SELECT 'experiment_registry', experiment_id, 1, 1, 0, 0 FROM registry
    """
)
def ingest_balance(spark, sf):
    """Logged rows are in the table, in the quarantine, or repeats."""
    raw, root = _ingested(spark, sf, fx.outcomes_faulty(spark, sf))
    logged, stored = experiment.logged(spark, raw), experiment.open_tables(spark, root)
    return quality.ingest_balance(logged.by_name(), stored.by_name(), experiment.quarantine(spark, root))


def _replayed(spark, sf) -> DataFrame:
    return readers.align_outcomes(fx.outcomes_replayed(spark, sf), keep=[readers.EVENT_ID])


@case(
    """
    SELECT experiment_id, user_id, metric_name, value, ts
    FROM (SELECT *, unnest(range(kept)) FROM unrepeated)
    """,
    digits="value",
)
def dedup_outcomes(spark, sf):
    return replays.dedup_outcomes(_replayed(spark, sf), batch=F.trunc("ts", "month"))


@case(
    """
    SELECT experiment_id, metric_name, nullif(batch, DATE '0001-01-01') AS batch, sum(copies)::BIGINT AS logged, sum(kept)::BIGINT AS kept,
           coalesce(sum(copies - kept) FILTER (event_id IS NOT NULL), 0)::BIGINT AS event_copies,
           coalesce(sum(copies - kept) FILTER (event_id IS NULL), 0)::BIGINT AS replayed_rows,
           max(factor)::INTEGER AS factor, count(*) FILTER (conflicting) AS conflicting
    FROM unrepeated GROUP BY experiment_id, metric_name, batch HAVING sum(copies) > sum(kept)
    """
)
def dq_outcome_replays(spark, sf):
    return replays.outcome_replays(_replayed(spark, sf), batch=F.trunc("ts", "month"))


@case("SELECT * FROM exposures")
def dedup_exposures(spark, sf):
    return dedup(fx.exposures_logged(spark, sf))


@case("SELECT experiment_id, user_id, variant FROM exposures")
def assign_variants(spark, sf):
    return fx.exposures(spark, sf).select("experiment_id", "user_id", "variant")


@case(
    """
    SELECT experiment_id, 'ab' AS analysis, count(*) OVER (PARTITION BY experiment_id) AS results,
           metric_name, n_control, delta, p_value, method FROM ab
    """,
    digits="delta p_value:8",
)
def results_json(spark, sf):
    """Documents written and parsed back, one row per result."""
    documents = summary.results_json(_user_level_results(spark, sf))
    layout = (
        "experiment_id string, analysis string, results array<struct<"
        "metric_name string, n_control bigint, delta double, p_value double, method string>>"
    )
    return documents.select(F.from_json("document", layout).alias("d")).select(
        "d.experiment_id", "d.analysis", F.size("d.results").cast("bigint").alias("results"),
        F.inline("d.results"),
    )


@case(
    """
    SELECT 'exposures' AS table_name, experiment_id, count(*) AS rows FROM exposures GROUP BY ALL
    UNION ALL SELECT 'outcomes', experiment_id, count(*) FROM outcomes GROUP BY ALL
    UNION ALL SELECT 'experiment_registry', experiment_id, count(*) FROM registry GROUP BY ALL
    UNION ALL SELECT 'analysis_results', experiment_id, count(*) FROM ab GROUP BY ALL
    """
)
def table_counts(spark, sf):
    return tables.table_counts(
        {
            "exposures": fx.exposures(spark, sf),
            "outcomes": fx.outcomes(spark, sf),
            "experiment_registry": fx.registry(spark),
            "analysis_results": _user_level_results(spark, sf),
        }
    )
