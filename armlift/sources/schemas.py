"""Column names and types of every canonical input and output table, each stated once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

Columns = dict[str, str]

KEY = ["experiment_id", "user_id"]

EXPOSURES: Columns = {
    "experiment_id": "string",
    "user_id": "string",
    "variant": "string",
    "exposure_ts": "timestamp",
    "unit": "string",
}

OUTCOMES: Columns = {
    "experiment_id": "string",
    "user_id": "string",
    "metric_name": "string",
    "value": "double",
    "ts": "timestamp",
}

REGISTRY: Columns = {
    "experiment_id": "string",
    "name": "string",
    "start_ts": "timestamp",
    "end_ts": "timestamp",
    "owner": "string",
    "variants": "array<string>",
    "primary_metrics": "array<string>",
    "guardrail_metrics": "array<string>",
    "notes": "string",
}

PARAMS: Columns = {
    "experiment_id": "string",
    "seed": "int",
    "start_date": "string",
    "days": "int",
    "n_users": "int",
    "exposure_rate": "double",
    "treatment_share": "double",
    "base_conversion": "double",
    "effect_lift_conversion": "double",
    "revenue_mean": "double",
    "revenue_sd": "double",
    "pre_period_days": "int",
    "created_ts": "timestamp",
}

ANALYSIS_RESULTS: Columns = {
    "experiment_id": "string",
    "metric_name": "string",
    "n_control": "bigint",
    "mean_control": "double",
    "std_control": "double",
    "n_treatment": "bigint",
    "mean_treatment": "double",
    "std_treatment": "double",
    "delta": "double",
    "se": "double",
    "z": "double",
    "p_value": "double",
    "ci_low": "double",
    "ci_high": "double",
    "rel_lift": "double",
    "computed_ts": "timestamp",
    "analysis_ts": "timestamp",
}

CUPED_RESULTS: Columns = {
    "experiment_id": "string",
    "metric_name": "string",
    "covariate_name": "string",
    "theta": "double",
    "x_mean": "double",
    "n_control": "bigint",
    "mean_control_raw": "double",
    "mean_control_cuped": "double",
    "n_treatment": "bigint",
    "mean_treatment_raw": "double",
    "mean_treatment_cuped": "double",
    "delta_raw": "double",
    "se_raw": "double",
    "ci_low_raw": "double",
    "ci_high_raw": "double",
    "p_value_raw": "double",
    "delta_cuped": "double",
    "se_cuped": "double",
    "ci_low_cuped": "double",
    "ci_high_cuped": "double",
    "p_value_cuped": "double",
}

DID_RESULTS: Columns = {
    "experiment_id": "string",
    "metric_name": "string",
    "metric_pre": "string",
    "metric_post": "string",
    "start_ts": "timestamp",
    "end_ts": "timestamp",
    "y_treat_pre": "double",
    "y_treat_post": "double",
    "y_ctrl_pre": "double",
    "y_ctrl_post": "double",
    "did": "double",
    "se": "double",
    "z": "double",
    "p_value": "double",
    "ci_low": "double",
    "ci_high": "double",
    "confidence": "double",
    "analysis_ts": "timestamp",
}


# Metric names tested as proportions.
BINARY_METRICS = ("conversion", "converted", "purchase", "signup")


@dataclass(frozen=True)
class MetricSpec:
    """One metric: its per-user roll-up and which side of the exposure it lives on.

    ``window`` is ``pre`` (never cut by the experiment window), ``post`` (cut by
    it) or ``any``; left out, it follows from the ``pre_`` name prefix.
    ``missing`` says what a user without a value is: ``zero`` or ``drop``.  Left
    out, sums and 0/1 metrics count as zero and all other roll-ups drop the user.
    """

    name: str
    agg: str = "sum"
    window: str | None = None
    missing: str | None = None

    @property
    def period(self) -> str:
        return self.window or ("pre" if self.name.startswith("pre_") else "post")

    @property
    def zero_filled(self) -> bool:
        default = "zero" if self.agg == "sum" or self.name.lower() in BINARY_METRICS else "drop"
        return (self.missing or default) == "zero"


# The metric list of the platform.
DEFAULT_METRICS = (
    MetricSpec("conversion", agg="max", window="post"),
    MetricSpec("revenue", agg="sum", window="post"),
    MetricSpec("pre_revenue", agg="sum", window="pre"),
)


def require_columns(df: DataFrame, columns: list[str], name: str) -> None:
    absent = sorted(set(columns) - set(df.columns))
    if absent:
        raise ValueError(f"{name} cannot be used without {', '.join(absent)}")


def align(df: DataFrame, columns: Columns) -> DataFrame:
    """Exactly ``columns``, in order and typed.

    Extra columns are dropped.  A missing scalar becomes a typed NULL and a
    missing array an empty array; a value that cannot be cast becomes NULL.
    """

    def one(name: str, dtype: str) -> str:
        if name in df.columns:
            return f"try_cast(`{name}` AS {dtype}) AS `{name}`"
        blank = "array()" if dtype.startswith("array") else "NULL"
        return f"CAST({blank} AS {dtype}) AS `{name}`"

    return df.selectExpr(*[one(name, dtype) for name, dtype in columns.items()])
