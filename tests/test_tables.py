"""Writes, contracts, ingest and the end-to-end batch."""

import pytest

import builders as b
from armlift.operators import metrics
from armlift.plans import experiment
from armlift.sources import catalog, contracts, readers, tables
from armlift.sources.schemas import ANALYSIS_RESULTS, require_columns


@pytest.fixture
def path(spark, tmp_path):
    return str(tmp_path / "table")


def results(spark, rows):
    return spark.createDataFrame(rows, "experiment_id string, metric_name string, delta double")


def stored(spark, path):
    return sorted((r.experiment_id, r.metric_name, r.delta) for r in tables.read_table(spark, path).collect())


def test_replace_is_idempotent_and_local(spark, path):
    tables.replace_partitions(results(spark, [("a", "m", 1.0), ("b", "m", 2.0)]), path)
    for _ in range(2):
        tables.replace_partitions(results(spark, [("b", "m", 3.0), ("b", "k", 4.0)]), path)
    assert stored(spark, path) == [("a", "m", 1.0), ("b", "k", 4.0), ("b", "m", 3.0)]


def test_ids_that_look_like_numbers_stay_text(spark, path):
    tables.replace_partitions(results(spark, [("007", "m", 1.0), ("2026-01-01", "m", 2.0)]), path)
    assert [r[0] for r in stored(spark, path)] == ["007", "2026-01-01"]
    tables.merge_upsert(results(spark, [("007", "m", 5.0)]), path, ["experiment_id", "metric_name"])
    assert stored(spark, path) == [("007", "m", 5.0), ("2026-01-01", "m", 2.0)]


def test_delete_append_clears_an_experiment_without_new_rows(spark, path):
    tables.replace_partitions(results(spark, [("a", "m", 1.0), ("x/y=z", "m", 2.0)]), path)
    tables.delete_append(results(spark, [("a", "k", 9.0), ("c", "k", 9.0)]), path, ["a", "x/y=z"])
    assert stored(spark, path) == [("a", "k", 9.0)]


def test_delete_by_metric(spark, path):
    tables.replace_partitions(results(spark, [("a", "m", 1.0), ("a", "k", 2.0), ("b", "m", 3.0)]), path)
    tables.delete_append_by_metric(results(spark, [("a", "m", 7.0)]), path, ["a"], ["m"])
    assert stored(spark, path) == [("a", "k", 2.0), ("a", "m", 7.0), ("b", "m", 3.0)]
    tables.delete_append_by_metric(results(spark, [("a", "q", 8.0)]), path, ["a"])
    assert stored(spark, path) == [("a", "q", 8.0), ("b", "m", 3.0)]


def test_merge_creates_updates_inserts_and_rejects_ambiguity(spark, path):
    keys = ["experiment_id", "metric_name"]
    tables.merge_upsert(results(spark, [("a", "m", 1.0)]), path, keys)
    tables.merge_upsert(results(spark, [("a", "m", 2.0), ("a", "k", 3.0), ("b", "m", 4.0)]), path, keys)
    assert stored(spark, path) == [("a", "k", 3.0), ("a", "m", 2.0), ("b", "m", 4.0)]
    with pytest.raises(ValueError, match="several rows"):
        tables.merge_upsert(results(spark, [("a", "m", 1.0), ("a", "m", 2.0)]), path, keys)
    assert stored(spark, path) == [("a", "k", 3.0), ("a", "m", 2.0), ("b", "m", 4.0)]


def test_upserts_into_a_table_that_never_had_rows(spark, path):
    nothing = results(spark, [])
    tables.replace_partitions(nothing, path)
    tables.merge_upsert(nothing, path, ["experiment_id", "metric_name"])
    assert tables.read_table(spark, path, nothing.schema).isEmpty()
    tables.delete_append_by_metric(results(spark, [("a", "m", 1.0)]), path, ["a"], ["m"])
    assert stored(spark, path) == [("a", "m", 1.0)]


def test_catalog_names(spark, path):
    columns = {"metric_name": "string", "delta": "double", "experiment_id": "string"}
    tables.replace_partitions(results(spark, [("a", "m", 1.0)]), path)
    assert not catalog.table_exists(spark, "lab.results")
    catalog.ensure_table(spark, "lab.results", columns, path)
    tables.replace_partitions(results(spark, [("b", "m", 2.0)]), path)
    catalog.ensure_table(spark, "lab.results", columns, path)
    assert sorted(r.delta for r in spark.table("lab.results").collect()) == [1.0, 2.0]
    catalog.create_or_replace(results(spark, [("c", "m", 3.0)]), "lab.latest")
    catalog.create_or_replace(results(spark, [("d", "m", 4.0)]), "lab.latest")
    assert [r.delta for r in spark.table("lab.latest").collect()] == [4.0]
    catalog.publish_views({"stage_rows": spark.table("lab.latest")})
    assert spark.sql("SELECT experiment_id FROM stage_rows").first()[0] == "d"
    names = {r.table_name for r in catalog.list_tables(spark, "lab").where("NOT temporary").collect()}
    assert names == {"results", "latest"}


def test_align_fills_casts_and_drops(spark):
    raw = spark.sql("SELECT 7 AS experiment_id, 'x' AS start_ts, array(1, 2) AS variants, 1 AS extra")
    r = readers.align_registry(raw).first()
    assert (r.experiment_id, r.start_ts, r.variants, r.primary_metrics, r.owner) == ("7", None, ["1", "2"], [], None)
    with pytest.raises(ValueError, match="cannot be used without experiment_id"):
        readers.align_exposures(spark.sql("SELECT 1 AS user_id"))
    with pytest.raises(ValueError, match="outcomes cannot be used"):
        require_columns(raw, ["value"], "outcomes")


def test_outcome_time_prefers_ts(spark):
    both = spark.sql("SELECT 'e' AS experiment_id, timestamp'2026-01-01' AS ts, timestamp'2025-01-01' AS outcome_ts")
    assert readers.align_outcomes(both).first().ts.year == 2026
    assert readers.align_outcomes(both.drop("ts")).first().ts.year == 2025
    assert readers.align_outcomes(both.drop("ts", "outcome_ts")).first().ts is None


def test_normalize_layout(spark):
    done = readers.normalize_results(results(spark, [("a", "m", 1.0)]))
    assert dict(done.dtypes) == ANALYSIS_RESULTS and done.columns == list(ANALYSIS_RESULTS)
    r = done.first()
    assert r.computed_ts is not None and r.analysis_ts is not None and r.se is None


def test_params(spark):
    given = spark.createDataFrame([("a", 3, None), ("b", None, 0.5)], "experiment_id string, days int, treatment_share double")
    got = {r.experiment_id: r for r in readers.resolve_params(given, {"days": 14, "seed": 7}).collect()}
    assert (got["a"].days, got["a"].seed, got["a"].treatment_share) == (3, 7, None)
    assert (got["b"].days, got["b"].treatment_share) == (14, 0.5)
    with pytest.raises(Exception, match="No parameters resolve"):
        readers.resolve_params(spark.sql("SELECT 'z' AS experiment_id"), {}).collect()


def test_contracts(spark):
    exp = b.exposures(spark, [("u", "control", 0), (None, "blue", 1)])
    got = {r.rule: r.violations for r in contracts.contract_violations(exp, "exposures").collect()}
    assert got == {"user_id_missing": 1, "variant_not_allowed": 1}
    assert contracts.valid_rows(exp, "exposures").count() == 1
    got = {r.rule for r in contracts.contract_violations(exp.drop("unit"), "exposures").collect()}
    assert "unit_column_absent" in got


def test_end_to_end_twice(spark, tmp_path, rows):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    people = [(f"u{i}", "treatment" if i % 2 else "control", i % 5, e) for e in ("e1", "e2") for i in range(40)]
    b.exposures(spark, people + people[:3]).write.parquet(f"{raw}/exposures.parquet")
    out = []
    for e in ("e1", "e2"):
        for i in range(40):
            out += [(f"u{i}", "revenue", float(i % 7), 6, e), (f"u{i}", "conversion", float(i % 3 == 0), 6, e)]
            out += [(f"u{i}", "pre_revenue", float(i % 7 + d % 3), -1 - d, e) for d in range(6)]
    b.outcomes(spark, out).withColumnRenamed("ts", "outcome_ts").write.parquet(f"{raw}/outcomes.parquet")
    b.registry(spark, [("e1", b.START, b.END), ("e2", b.START, b.END)]).write.parquet(f"{raw}/experiment_registry.parquet")

    options = {"event_metric": "pre_revenue", "event_buckets": (7, 7)}
    first = experiment.run(spark, raw, root, **options)
    clocks = ("computed_ts", "analysis_ts")
    nothing = spark.createDataFrame([], "experiment_id string").schema
    snapshot = lambda: {n: rows(tables.read_table(spark, p, nothing).drop(*clocks)) for n, p in first.items()}
    before = snapshot()
    assert len(before["analysis_results"]) == 6
    assert len(before["decision_summary"]) == 2
    assert before["contract_violations"] == []
    experiment.run(spark, raw, root, experiment_ids=["e2"], **options)
    assert snapshot() == before
    counts = {(r.table_name, r.experiment_id): r.rows for r in tables.table_counts({"exposures": tables.read_table(spark, f"{root}/exposures")}).collect()}
    assert counts == {("exposures", "e1"): 40, ("exposures", "e2"): 40}
    assert len(before["event_study_coefficients"]) == 10
    assert {r["verdict"] for r in before["event_study_tests"]} <= {"PASS", "WARN", "FAIL"}
    inputs = experiment.open_tables(spark, root)
    overall = metrics.metric_overall(inputs.outcomes, inputs.exposures, inputs.registry)
    plain = {(r.experiment_id, r.variant, r.metric_name): r for r in overall.collect()}
    for r in before["metric_aggregates_overall"]:
        other = plain[r["experiment_id"], r["variant"], r["metric_name"]]
        assert (r["n"], r["min"], r["max"]) == (other.n, other["min"], other["max"])
        assert abs(r["stddev"] - other.stddev) < 1e-9 and abs(r["mean"] - other["mean"]) < 1e-9
