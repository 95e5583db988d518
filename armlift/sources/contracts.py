"""Row contracts of the canonical tables, counted in one pass per table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from armlift.sources.schemas import require_columns

# Required fields and enumerations of the input contracts.
REQUIRED = {
    "exposures": ["experiment_id", "user_id", "variant", "exposure_ts", "unit"],
    "outcomes": ["experiment_id", "user_id", "metric_name", "value", "ts"],
    "experiment_registry": [
        "experiment_id", "name", "start_ts", "end_ts", "variants", "primary_metrics",
    ],
}
ARMS = ("control", "treatment")
UNITS = ("user_id",)
MIN_ITEMS = {"variants": 2, "primary_metrics": 1}


# Columns without which nothing can be computed from a table.
NEEDED = {
    "exposures": ["experiment_id", "user_id", "variant", "exposure_ts"],
    "outcomes": ["experiment_id", "user_id", "metric_name", "value"],
    "experiment_registry": ["experiment_id"],
}


def require_writable(raw: DataFrame, table: str) -> None:
    """Refuse a raw table that lacks a needed column, before anything is written."""
    require_columns(raw, NEEDED[table], table)


def contract_rules(df: DataFrame, table: str) -> dict[str, Column]:
    """Rule name -> condition that is true for a violating row."""
    rules: dict[str, Column] = {}
    for name in REQUIRED[table]:
        if name in df.columns:
            rules[f"{name}_missing"] = F.col(name).isNull()
        else:
            rules[f"{name}_column_absent"] = F.lit(True)
    if table == "exposures":
        for name, allowed in (("variant", ARMS), ("unit", UNITS)):
            if name in df.columns:
                rules[f"{name}_not_allowed"] = ~F.col(name).isin(*allowed)
    if table == "experiment_registry":
        for name, least in MIN_ITEMS.items():
            if name in df.columns:
                rules[f"{name}_too_few"] = F.size(name) < least
    return rules


def contract_violations(df: DataFrame, table: str) -> DataFrame:
    """(table_name, experiment_id, rule, violations) for every rule broken at least once."""
    rules = contract_rules(df, table)
    experiment = F.col("experiment_id") if "experiment_id" in df.columns else F.lit(None)
    counts = df.groupBy(experiment.cast("string").alias("experiment_id")).agg(
        *[F.count_if(condition).alias(rule) for rule, condition in rules.items()]
    )
    return (
        counts.unpivot("experiment_id", list(rules), "rule", "violations")
        .where("violations > 0")
        .select(F.lit(table).alias("table_name"), "experiment_id", "rule", "violations")
    )


# Rules a row cannot break and stay: it then belongs to no experiment, user, arm or metric, or adds nothing.
# The others are counted, and the row still takes part where it can.
BLOCKING = {
    "exposures": ("experiment_id_missing", "user_id_missing", "variant_missing", "variant_not_allowed"),
    "outcomes": ("experiment_id_missing", "user_id_missing", "metric_name_missing", "value_missing"),
    "experiment_registry": ("experiment_id_missing",),
}


def broken_rules(df: DataFrame, table: str) -> Column:
    """Names of the rules a row breaks, in the order of the contract."""
    rules = contract_rules(df, table)
    return F.array_compact(F.array(*[F.when(broken, F.lit(rule)) for rule, broken in rules.items()]))


def routed(df: DataFrame, table: str) -> DataFrame:
    """``df`` with ``broken_rules`` and ``kept_out``: every row goes to the table or to the quarantine."""
    blocking = F.array(*[F.lit(rule) for rule in BLOCKING[table]])
    return df.withColumn("broken_rules", broken_rules(df, table)).withColumn(
        "kept_out", F.arrays_overlap("broken_rules", blocking)
    )


def admitted(df: DataFrame, table: str) -> DataFrame:
    """The rows that go to the table."""
    return routed(df, table).where(~F.col("kept_out")).drop("broken_rules", "kept_out")


def quarantined(df: DataFrame, table: str) -> DataFrame:
    """The rows that are kept out, with all the rules they break."""
    return routed(df, table).where("kept_out").drop("kept_out")


def valid_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows that break no rule."""
    return routed(df, table).where(F.size("broken_rules") == 0).drop("broken_rules", "kept_out")
