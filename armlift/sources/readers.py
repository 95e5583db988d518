"""Raw Parquet to canonical frames, and experiment parameter resolution."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from armlift.functions.scalars import coerce_timestamp
from armlift.sources.schemas import (
    ANALYSIS_RESULTS,
    EXPOSURES,
    OUTCOMES,
    PARAMS,
    REGISTRY,
    Columns,
    align,
    require_columns,
)


def _location(path: str) -> str:
    path = path.rstrip("/")
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def _only(df: DataFrame, experiment_ids: Iterable[str] | None) -> DataFrame:
    if experiment_ids is None:
        return df
    return df.where(F.col("experiment_id").isin(list(experiment_ids)))


#: Text of a logged row, as it came.
LOGGED = "logged_row"
#: An outcome's own id in its log; optional.
EVENT_ID = "event_id"


def with_logged_row(raw: DataFrame) -> DataFrame:
    """``raw`` with every row's fields as JSON beside them, for rows that cannot be used as they are."""
    return raw.withColumn(LOGGED, F.to_json(F.struct("*")))


def _kept(columns: Columns, keep: Iterable[str]) -> Columns:
    return {**columns, **{name: "string" for name in keep}}


def align_exposures(
    raw: DataFrame, experiment_ids: Iterable[str] | None = None, keep: Iterable[str] = ()
) -> DataFrame:
    """Canonical exposures; ``keep`` names columns to carry along as text."""
    require_columns(raw, ["experiment_id"], "exposures")
    return _only(align(raw, _kept(EXPOSURES, keep)), experiment_ids)


def align_outcomes(
    raw: DataFrame, experiment_ids: Iterable[str] | None = None, keep: Iterable[str] = ()
) -> DataFrame:
    """Canonical outcomes; ``ts`` comes from ``ts``, else ``outcome_ts``, else NULL."""
    require_columns(raw, ["experiment_id"], "outcomes")
    if "ts" not in raw.columns and "outcome_ts" in raw.columns:
        raw = raw.withColumnRenamed("outcome_ts", "ts")
    return _only(align(raw, _kept(OUTCOMES, keep)), experiment_ids)


def align_registry(
    raw: DataFrame, experiment_ids: Iterable[str] | None = None, keep: Iterable[str] = ()
) -> DataFrame:
    require_columns(raw, ["experiment_id"], "experiment_registry")
    return _only(align(raw, _kept(REGISTRY, keep)), experiment_ids)


def unique_registry(registry: DataFrame) -> DataFrame:
    """One row per experiment id: of several, the one that sorts first by all columns, NULLs last."""
    order = F.struct(*[F.struct(F.col(c).isNull().alias("absent"), F.col(c).alias("value")) for c in registry.columns])
    first = registry.where("experiment_id IS NOT NULL").groupBy("experiment_id").agg(
        F.min_by(F.struct(*registry.columns), order).alias("row")
    )
    return first.select("row.*")


def read_exposures(spark: SparkSession, path: str, experiment_ids=None) -> DataFrame:
    return align_exposures(spark.read.parquet(_location(path)), experiment_ids)


def read_outcomes(spark: SparkSession, path: str, experiment_ids=None) -> DataFrame:
    return align_outcomes(spark.read.parquet(_location(path)), experiment_ids)


def read_registry(spark: SparkSession, path: str, experiment_ids=None) -> DataFrame:
    return align_registry(spark.read.parquet(_location(path)), experiment_ids)


def resolve_params(overrides: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Per-experiment parameters: each override, or the default where it is NULL or absent.

    An experiment for which nothing resolves fails the query.
    """
    require_columns(overrides, ["experiment_id"], "overrides")
    names = [c for c in PARAMS if c not in ("experiment_id", "created_ts")]
    given = align(overrides, {c: t for c, t in PARAMS.items() if c != "created_ts"})
    merged = given.select(
        "experiment_id",
        *[F.coalesce(F.col(c), F.lit(defaults.get(c)).cast(PARAMS[c])).alias(c) for c in names],
    )
    resolved = F.coalesce(*[F.col(c).cast("string") for c in names]).isNotNull()
    message = F.concat(F.lit("No parameters resolve for experiment_id="), F.col("experiment_id"))
    checked = F.when(resolved, F.col("experiment_id")).otherwise(F.raise_error(message))
    return merged.withColumn("experiment_id", checked)


def normalize_results(df: DataFrame, columns: Columns = ANALYSIS_RESULTS) -> DataFrame:
    """Result rows in the exact table layout, with both clocks filled.

    Clock columns may arrive as timestamps or as text in any accepted layout;
    a clock that is missing or unreadable is set to the current time.
    """
    clocks = [c for c in ("computed_ts", "analysis_ts") if c in columns]
    for name in clocks:
        given = coerce_timestamp(F.col(name)) if name in df.columns else F.lit(None)
        df = df.withColumn(name, F.coalesce(given, F.current_timestamp()))
    return align(df, columns)
