"""All analyses of all experiments, and the end-to-end batch that stores them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from armlift.operators import ab, cuped, did, event_study, metrics, pretrend, quality, rollup, summary
from armlift.operators.exposure import dedup_exposures
from armlift.operators.grain import user_columns
from armlift.operators.moments import COMPLETE, MOMENTS
from armlift.operators.replays import dedup_outcomes, outcome_replays
from armlift.operators.windows import window_from_registry
from armlift.sources import readers, tables
from armlift.sources.contracts import admitted, contract_violations, quarantined, require_writable
from armlift.sources.schemas import DEFAULT_METRICS, DID_RESULTS, EXPOSURES, KEY, OUTCOMES, REGISTRY, MetricSpec


@dataclass(frozen=True)
class Inputs:
    """The three tables; ``unique`` states that exposures hold one row per user."""

    exposures: DataFrame
    outcomes: DataFrame
    registry: DataFrame
    unique: bool = False

    def by_name(self) -> dict[str, DataFrame]:
        return {"exposures": self.exposures, "outcomes": self.outcomes, "experiment_registry": self.registry}


def logged(spark: SparkSession, raw: str, experiment_ids: Sequence[str] | None = None) -> Inputs:
    """The raw tables in canonical columns, rows as they were logged.

    Each row carries its fields as logged in one more column, and an outcome its event id if it has one.
    A table without a column it needs is refused here, before anything is written.
    """
    read = lambda name: spark.read.parquet(readers._location(f"{raw}/{name}.parquet"))
    found = {name: read(name) for name in ("exposures", "outcomes", "experiment_registry")}
    for name, df in found.items():
        require_writable(df, name)
    text = (readers.LOGGED,)
    event = (readers.EVENT_ID,) if readers.EVENT_ID in found["outcomes"].columns else ()
    carried = {name: readers.with_logged_row(df) for name, df in found.items()}
    return Inputs(
        readers.align_exposures(carried["exposures"], experiment_ids, text),
        readers.align_outcomes(carried["outcomes"], experiment_ids, text + event),
        readers.align_registry(carried["experiment_registry"], experiment_ids, text),
    )


def experiments_in(inputs: Inputs) -> list[str]:
    """Ids of all registered or exposed experiments; one string each reaches the driver."""
    ids = inputs.registry.select("experiment_id").unionByName(inputs.exposures.select("experiment_id"))
    return sorted(r[0] for r in ids.where("experiment_id IS NOT NULL").distinct().collect())


def ingest(
    spark: SparkSession,
    raw: str,
    root: str,
    experiment_ids: Sequence[str] | None = None,
) -> Inputs:
    """Raw Parquet to canonical partitioned tables, and what cannot go there to the quarantine.

    A row that breaks a blocking rule of its contract goes, as it was logged and with the rules it
    breaks, to ``quarantine_<table>``; exposures and registry rows are made unique, and copies of
    outcomes that a log wrote again are dropped.  A rerun replaces the same partitions, and empties
    those of experiments that the raw tables no longer have rows of: a mended row leaves the
    quarantine with the next run.
    """
    found = logged(spark, raw, experiment_ids)
    scope = experiments_in(found) if experiment_ids is None else list(experiment_ids)
    good = {name: admitted(df, name) for name, df in found.by_name().items()}
    canonical = {
        "exposures": dedup_exposures(good["exposures"].drop(readers.LOGGED)),
        "outcomes": dedup_outcomes(good["outcomes"]),
        "experiment_registry": readers.unique_registry(good["experiment_registry"].drop(readers.LOGGED)),
    }
    for name, df in canonical.items():
        tables.replace_partitions(df, f"{root}/{name}", scope)
    for name, df in found.by_name().items():
        tables.replace_partitions(quarantined(df, name), f"{root}/quarantine_{name}", scope)
    return open_tables(spark, root, experiment_ids)


def quarantine(
    spark: SparkSession, root: str, experiment_ids: Sequence[str] | None = None
) -> dict[str, DataFrame]:
    """The rows that :func:`ingest` kept out, per table: canonical columns, the row as logged, broken rules."""
    more = {readers.LOGGED: "string", "broken_rules": "array<string>"}
    return {
        name: _stored(spark, f"{root}/quarantine_{name}", {**columns, **more}, experiment_ids)
        for name, columns in CANONICAL.items()
    }


CANONICAL = {"exposures": EXPOSURES, "outcomes": OUTCOMES, "experiment_registry": REGISTRY}


def _stored(
    spark: SparkSession, path: str, columns: dict[str, str], experiment_ids: Sequence[str] | None
) -> DataFrame:
    """A stored table, with these columns if it never had a row."""
    layout = spark.createDataFrame([], ", ".join(f"{c} {t}" for c, t in columns.items())).schema
    return _only(tables.read_table(spark, path, layout), experiment_ids)


def _only(df: DataFrame, experiment_ids: Sequence[str] | None) -> DataFrame:
    """The listed experiments' partitions, or all."""
    return df if experiment_ids is None else df.where(F.col("experiment_id").isin(list(experiment_ids)))


def open_tables(
    spark: SparkSession, root: str, experiment_ids: Sequence[str] | None = None
) -> Inputs:
    read = lambda name: _stored(spark, f"{root}/{name}", CANONICAL[name], experiment_ids)
    return Inputs(read("exposures"), read("outcomes"), read("experiment_registry"), unique=True)


def with_metrics(specs: Sequence[MetricSpec], *names: str) -> list[MetricSpec]:
    """``specs`` and a default one for each name they lack."""
    known = {s.name for s in specs}
    return [*specs, *(MetricSpec(n) for n in dict.fromkeys(names) if n not in known)]


def arm_table(
    inputs: Inputs,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    target: str = "revenue",
    covariate: str = "pre_revenue",
) -> DataFrame:
    """Sufficient statistics of every arm in one pass over the users.

    One row per experiment and variant: per-metric statistics in ``stats`` and
    the joint moments of target and covariate.  A/B, CUPED and DiD results all
    follow from it without reading outcomes or exposures again.
    """
    specs = with_metrics(specs, target, covariate)
    names = [f"m{i}" for i in range(len(specs))]
    users = user_columns(inputs.outcomes, inputs.exposures, specs, names, unique=inputs.unique)
    return _arm_table(users, specs, names, target, covariate)


def _arm_table(
    users: DataFrame, specs: Sequence[MetricSpec], names: Sequence[str], target: str, covariate: str
) -> DataFrame:
    column = {s.name: n for s, n in zip(specs, names)}
    users = users.selectExpr("*", f"{column[target]} AS y", f"{column[covariate]} AS x")
    return users.groupBy("experiment_id", "variant").agg(
        F.array(*ab.stats_items(specs, names)).alias("stats"),
        *[F.expr(f"{value} {COMPLETE} AS {name}") for name, value in MOMENTS.items()],
    )


def shared_tables(
    inputs: Inputs,
    days: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    target: str = "revenue",
    covariate: str = "pre_revenue",
) -> dict[str, DataFrame]:
    """The aggregates everything else is computed from; ``days`` is :func:`rollup.user_days`, stored.

    None of them reads the outcomes.
    """
    exposures, unique = inputs.exposures, inputs.unique
    specs = with_metrics(specs, target, covariate)
    names = [f"m{i}" for i in range(len(specs))]
    users = rollup.user_values(days, exposures, specs, names, unique)
    return {
        "experiment_windows": window_from_registry(inputs.registry, exposures),
        "arm_statistics": _arm_table(users, specs, names, target, covariate),
        "other_arm_statistics": ab.other_arm_stats(rollup.totals(days), exposures, specs, unique),
        "daily_moments": rollup.daily_moments(days, specs),
        "did_pretrend_daily": rollup.pretrend_daily(days, covariate),
    }


def analysis_status(
    stats: DataFrame, window: DataFrame, cuped_result: DataFrame, did_result: DataFrame, slope: DataFrame,
    registry: DataFrame,
) -> DataFrame:
    """(experiment_id, analysis, metric_name, status): what was computed, and why not.

    A/B has a row per metric seen; every other analysis one per registered
    experiment, and A/B too where no metric was seen at all.
    """
    ids = registry.select("experiment_id").where("experiment_id IS NOT NULL").distinct()
    layout = ["experiment_id", "analysis", "metric_name", "status"]
    by_metric = ab.missing_arms(stats)

    def whole(name: str, found: DataFrame, status: str) -> DataFrame:
        known = found.selectExpr("experiment_id", f"{status} AS status").groupBy("experiment_id").agg(F.max("status").alias("status"))
        return ids.join(known, "experiment_id", "left").selectExpr(
            "experiment_id", f"'{name}' AS analysis", "CAST(NULL AS STRING) AS metric_name",
            f"coalesce(status, '{summary.NOT_EVALUATED}') AS status",
        )

    parts = [
        by_metric.selectExpr("experiment_id", "'ab' AS analysis", "metric_name", "status"),
        whole("ab", by_metric, "'OK'").where(f"status = '{summary.NOT_EVALUATED}'"),
        whole("cuped", cuped_result, "'OK'"),
        whole("did", did_result, "'OK'"),
        whole("pretrend", slope, "verdict"),
        whole("window", window, "window_status"),
    ]
    found = parts[0].select(*layout)
    for part in parts[1:]:
        found = found.unionByName(part.select(*layout))
    return found


def analyse(
    inputs: Inputs,
    shared: dict[str, DataFrame],
    target: str = "revenue",
    covariate: str = "pre_revenue",
    confidence: float = 0.95,
    lower_is_better: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Every result table as a lazy DataFrame; ``shared`` is :func:`shared_tables`, stored."""
    arms, moments = shared["arm_statistics"], shared["daily_moments"]
    daily, window = shared["did_pretrend_daily"], shared["experiment_windows"]
    stats = ab.unfold_stats(arms).unionByName(shared["other_arm_statistics"])
    results = ab.ab_analysis(stats)
    cuped_result = cuped.cuped(arms, target, covariate)
    did_result = did.did(arms, window, covariate, target, confidence=confidence)
    slope = pretrend.pretrend_slope(daily)
    flags = summary.guardrail_flags(results, inputs.registry, lower_is_better)
    computed = lambda df: df.withColumn("computed_ts", F.current_timestamp())
    analysed = lambda df: df.withColumn("analysis_ts", F.current_timestamp())
    return {
        "metric_aggregates_overall": computed(metrics.overall_table(moments)),
        "metric_aggregates_daily": computed(metrics.daily_table(moments)),
        "analysis_results": readers.normalize_results(ab.ab_results_table(results)),
        "analysis_results_cuped": cuped.cuped_results(cuped_result),
        "cuped_variance_reduction": cuped.cuped_variance_reduction(cuped_result),
        "balance_check": ab.balance_check(stats),
        "guardrail_flags": flags,
        "did_results": readers.normalize_results(did.did_results(did_result), DID_RESULTS),
        "did_pretrend_delta": analysed(pretrend.pretrend_delta(daily)),
        "did_pretrend_tests": slope,
        "analysis_status": analysis_status(stats, window, cuped_result, did_result, slope, inputs.registry),
        "decision_summary": summary.decision_summary(
            results, cuped_result, did_result, slope, flags, inputs.registry
        ),
    }


def quality_tables(raw: Inputs, canonical: Inputs, kept_out: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Quality reports and contract breaks of what was logged, before anything was dropped.

    ``kept_out`` is :func:`quarantine` of the same run.
    """
    broken = [contract_violations(df, name) for name, df in raw.by_name().items()]
    return {
        "ingest_balance": quality.ingest_balance(raw.by_name(), canonical.by_name(), kept_out),
        "dq_outcome_replays": outcome_replays(admitted(raw.outcomes, "outcomes")),
        "contract_violations": broken[0].unionByName(broken[1]).unionByName(broken[2]),
        "dq_summary": quality.dq_summary(raw.exposures, raw.outcomes, raw.registry),
        "dq_variant_dist": quality.dq_variant_dist(raw.exposures),
        "dq_metric_dist": quality.dq_metric_dist(raw.outcomes),
        "dq_duplicates": quality.dq_duplicates(raw.exposures, KEY),
        "dq_rowcount_delta": quality.dq_rowcount_delta(raw.exposures, canonical.exposures),
        "dq_leakage": quality.dq_leakage(canonical.outcomes, canonical.exposures, canonical.registry),
    }


def event_cells(inputs: Inputs, days: DataFrame, metric: str = "revenue", grain: str = "day") -> DataFrame:
    """Arm x bucket cells of the event study of one metric, from a roll-up made for its reach."""
    return event_study.bucket_cells(rollup.user_bucket_mean(days, inputs.registry, metric, grain))


def event_studies(
    cells: DataFrame, grain: str = "day", pre: int = 28, post: int = 28
) -> dict[str, DataFrame]:
    """Delta series, coefficients and verdict from stored :func:`event_cells`."""
    coefficients = event_study.event_study(cells, grain)
    return {
        "event_study_delta": event_study.bucket_delta(cells, grain),
        "event_study_coefficients": coefficients,
        "event_study_tests": event_study.event_study_verdict(
            coefficients, pre, post, joint=event_study.joint_leads(cells)
        ),
    }


# Results of one target metric, kept beside those of other targets; the rest replace experiments.
BY_TARGET = ("analysis_results_cuped", "did_results")


def run(
    spark: SparkSession,
    raw: str,
    root: str,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    experiment_ids: Sequence[str] | None = None,
    event_metric: str | None = None,
    event_grain: str = "day",
    event_buckets: tuple[int, int] = (28, 28),
    target: str = "revenue",
    covariate: str = "pre_revenue",
    confidence: float = 0.95,
    lower_is_better: Sequence[str] = (),
) -> dict[str, str]:
    """Ingest, check, analyse and store; returns the path of every table written.

    Every metric of the outcomes is tested; ``specs`` say how those they name are
    rolled up.  The outcomes are rolled up per user and day once, and all results
    follow from that table (``user_days``); the leakage check alone looks at their
    times again.  Quality and contracts look at the rows as logged.  Afterwards every table says about the
    experiments of this run what this run found, and nothing older; an experiment
    that cannot be analysed has a row in ``analysis_status`` and does not stop the
    others.  With ``event_metric`` the event study of that metric is stored too.
    """
    found = logged(spark, raw, experiment_ids)
    scope = experiments_in(found) if experiment_ids is None else list(experiment_ids)
    inputs = ingest(spark, raw, root, experiment_ids)
    written: dict[str, str] = {}

    def store(name: str, df: DataFrame) -> DataFrame:
        path = written[name] = f"{root}/{name}"
        if name in BY_TARGET:
            tables.delete_append_by_metric(df, path, scope, [target])
        else:
            tables.replace_partitions(df, path, scope)
        return _only(tables.read_table(spark, path, df.schema), experiment_ids)

    for name, df in quality_tables(found, inputs, quarantine(spark, root, experiment_ids)).items():
        store(name, df)
    event = (event_grain, *event_buckets) if event_metric is not None else None
    days = store(
        "user_days",
        rollup.user_days(
            inputs.outcomes, inputs.exposures, inputs.registry, with_metrics(specs, target, covariate), event, inputs.unique
        ),
    )
    shared = {n: store(n, df) for n, df in shared_tables(inputs, days, specs, target, covariate).items()}
    for name, df in analyse(inputs, shared, target, covariate, confidence, lower_is_better).items():
        store(name, df)
    if event_metric is not None:
        pre, post = event_buckets
        cells = store("event_study_cells", event_cells(inputs, days, event_metric, event_grain))
        for name, df in event_studies(cells, event_grain, pre, post).items():
            clocked = name != "event_study_tests"
            store(name, df.withColumn("analysis_ts", F.current_timestamp()) if clocked else df)
    return written
