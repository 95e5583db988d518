"""Experiment tables derived from the given star schema and event tables.

Customers are split into arms by hash, their orders are the outcomes.  The
derivation is narrow: an order row knows its customer's arm and exposure time
from the hash alone, so no join is needed to build either table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from armlift.operators.exposure import assign_variants
from armlift.sources.readers import align_exposures, align_outcomes
from armlift.sources.schemas import DEFAULT_METRICS

EXPOSURE_RATE = 0.85
TREATMENT_SHARE = 0.5
EXPOSURE_DAYS = 28

# (experiment_id, start, end)
EXPERIMENTS = (
    ("exp_orders_a", "1998-01-01", "1999-12-31"),
    ("exp_orders_b", "1999-06-01", "2000-05-31"),
)
SPECS = DEFAULT_METRICS


# Columns of the given tables; stating them spares the job that reads file footers.
TABLES = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,"
    " o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def registry(spark: SparkSession, cut_days: int = 0) -> DataFrame:
    """The two experiments, optionally closed ``cut_days`` earlier than their outcomes run."""
    rows = ", ".join(f"('{e}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for e, a, b in EXPERIMENTS)
    return spark.sql(
        f"""
        SELECT experiment_id, experiment_id AS name, start_ts,
               end_ts - make_dt_interval({cut_days}) AS end_ts, 'analytics' AS owner,
               array('control', 'treatment') AS variants, array('conversion') AS primary_metrics,
               array('revenue') AS guardrail_metrics, CAST(NULL AS STRING) AS notes
        FROM VALUES {rows} AS r(experiment_id, start_ts, end_ts)
        """
    )


def per_experiment(df: DataFrame) -> DataFrame:
    """Each row once per experiment, with the experiment's window."""
    windows = ", ".join(
        f"named_struct('experiment_id', '{e}', 'start_ts', TIMESTAMP_NTZ '{a}', 'end_ts', TIMESTAMP_NTZ '{b}')"
        for e, a, b in EXPERIMENTS
    )
    return df.selectExpr("*", f"inline(array({windows}))")


def _assigned(df: DataFrame, user: str, rate: float = EXPOSURE_RATE) -> DataFrame:
    """Rows of the users exposed at ``rate``, per experiment, with arm and time of exposure."""
    users = per_experiment(df.selectExpr("*", f"CAST({user} AS STRING) AS user_id"))
    offset = f"make_dt_interval(CAST(assignment_hash % {EXPOSURE_DAYS} AS INT))"
    return assign_variants(users, rate, TREATMENT_SHARE).selectExpr(
        "*", f"start_ts + {offset} AS exposure_ts", "'user_id' AS unit"
    )


def exposures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (experiment, exposed customer)."""
    return align_exposures(_assigned(table(spark, sf_dir, "customer"), "c_custkey"))


def exposures_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposures as logged, with the faults a log has.

    BUILDING customers are seen again a day later in the other arm, MACHINERY
    customers two days later under an unknown label and unit, and customers in
    debt also leave a row without a user.
    """
    def row(user, variant, ts, unit, when="TRUE"):
        fields = f"'user_id', {user}, 'variant', {variant}, 'exposure_ts', {ts}, 'unit', {unit}"
        return f"if({when}, named_struct({fields}), NULL)"

    later = "exposure_ts + make_dt_interval({})".format
    flipped = "if(variant = 'control', 'treatment', 'control')"
    copies = [
        row("c_custkey", "variant", "exposure_ts", "unit"),
        row("c_custkey", flipped, later(1), "unit", "c_mktsegment = 'BUILDING'"),
        row("c_custkey", "'holdout'", later(2), "'device_id'", "c_mktsegment = 'MACHINERY'"),
        row("CAST(NULL AS BIGINT)", "variant", "exposure_ts", "unit", "c_acctbal < 0"),
    ]
    return _assigned(table(spark, sf_dir, "customer"), "c_custkey").selectExpr(
        "experiment_id", f"inline(array_compact(array({', '.join(copies)})))"
    )


def exposures_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The faulty log in canonical columns: what every analysis has to cope with."""
    return align_exposures(exposures_raw(spark, sf_dir))


def outcomes_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of all customers as long outcome rows, under raw column names.

    Some customers were never exposed, some orders come after the end of the
    experiment, and every 97th has lost its time.
    """
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"
    )
    metric = "named_struct('metric_name', '{}', 'value', {})".format
    amount = "o_totalprice / 1000"
    fulfilled = "CAST(o_orderstatus = 'F' AS DOUBLE)"
    rows = (
        f"if(o_orderdate < exposure_ts, array({metric('pre_revenue', amount)}),"
        f" array({metric('revenue', amount)}, {metric('conversion', fulfilled)}))"
    )
    return _assigned(orders, "o_custkey", 1.0).selectExpr(
        "experiment_id",
        "o_custkey AS user_id",
        f"inline({rows})",
        "if(o_orderkey % 97 = 0, NULL, o_orderdate) AS outcome_ts",
        "o_orderkey",
    )


def outcomes_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes with values as text, of which some rows lost a field, by the last digits of the order.

    0: no user, 1: no metric, 2: a value that is no number, 3: no value and no metric.
    """
    digit = "o_orderkey % 100"
    return outcomes_raw(spark, sf_dir).selectExpr(
        "experiment_id",
        f"if({digit} = 0, NULL, user_id) AS user_id",
        f"if({digit} IN (1, 3), NULL, metric_name) AS metric_name",
        f"CASE {digit} WHEN 2 THEN 'n/a' WHEN 3 THEN NULL ELSE CAST(value AS STRING) END AS value",
        "outcome_ts",
        "o_orderkey",
    )


def outcomes_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes of which a log wrote some again; urgent and high-priority orders have event ids.

    Every fifth event is logged twice, every 25th the second time with a larger value.  Rows
    without an event id are logged three times in odd months.
    """
    urgent = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS key", "o_orderpriority < '3' AS urgent")
    rows = outcomes_raw(spark, sf_dir).join(urgent, F.col("o_orderkey") == F.col("key"))
    rows = rows.withColumn("event_id", F.expr("if(urgent, concat(o_orderkey, '/', metric_name), NULL)"))
    copies = "if(urgent, if(o_orderkey % 5 = 0, 2, 1), if(month(outcome_ts) % 2 = 1, 3, 1))"
    return rows.selectExpr("*", f"explode(sequence(1, {copies})) AS copy").selectExpr(
        "experiment_id", "user_id", "metric_name",
        "if(urgent AND copy = 2 AND o_orderkey % 25 = 0, value + 1, value) AS value", "outcome_ts", "event_id",
    )


def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_outcomes(outcomes_raw(spark, sf_dir))


def order_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order of every customer, exposed or not, as one metric over the whole time span."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS user_id",
        "'order_value' AS metric_name",
        "o_totalprice / 1000 AS value",
        "o_orderdate AS ts",
    )
    return align_outcomes(per_experiment(orders))


def event_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as outcomes of one experiment, a metric per event type."""
    return align_outcomes(
        table(spark, sf_dir, "events").selectExpr(
            "'exp_events' AS experiment_id", "user_id", "event_type AS metric_name", "value", "ts"
        )
    )
