"""The end-to-end batch on faulty input: nothing silently dropped, nothing stale, nobody stopped by another."""

import pytest

import builders as b
from armlift.operators.exposure import dedup_exposures
from armlift.operators.grain import user_pivot, user_rollup
from armlift.plans import experiment
from armlift.sources import readers, tables


def write(spark, raw, people, out, registry):
    b.exposures(spark, people).write.mode("overwrite").parquet(f"{raw}/exposures.parquet")
    b.outcomes(spark, out).write.mode("overwrite").parquet(f"{raw}/outcomes.parquet")
    layout = (
        "experiment_id string, name string, start_ts timestamp, end_ts timestamp, owner string,"
        " variants array<string>, primary_metrics array<string>, guardrail_metrics array<string>, notes string"
    )
    full = [(e, e, start, end, "me", ["control", "treatment"], ["conversion"], guards, note) for e, start, end, guards, note in registry]
    spark.createDataFrame(full, layout).write.mode("overwrite").parquet(f"{raw}/experiment_registry.parquet")


def outcomes_of(e, n=40):
    rows = []
    for i in range(n):
        rows += [(f"u{i}", "revenue", float(i % 7), 6, e), (f"u{i}", "conversion", float(i % 3 == 0), 6, e)]
        rows += [(f"u{i}", "pre_revenue", float(i % 7 + d % 3), -1 - d, e) for d in range(6)]
        rows += [(f"u{i}", "errors", float(i % 2 * (5 + i % 3) + i % 4), 5, e)]
    return rows


@pytest.fixture
def folders(tmp_path):
    return str(tmp_path / "raw"), str(tmp_path / "out")


def read(spark, written, name):
    nothing = spark.createDataFrame([], "experiment_id string").schema
    return tables.read_table(spark, written[name], nothing).collect()


def test_faulty_input_is_reported_and_forgotten(spark, folders):
    raw, root = folders
    people = [(f"u{i}", "treatment" if i % 2 else "control", i % 5, e) for e in ("good", "undated") for i in range(40)]
    people = [(u, v, None if e == "undated" else d, e) for u, v, d, e in people]
    people += [(f"u{i}", "control", 1, "onearm") for i in range(20)]
    people += [("u1", "holdout", -1, "good"), (None, "control", 1, "good"), (None, "control", 2, "good"), ("u1", "treatment", 9, "good")]
    guards = ["revenue", "errors", "latency"]
    registry = [("good", b.START, b.END, guards, None), ("good", b.START, b.END, guards, "again"),
                ("undated", None, None, ["revenue"], None), ("onearm", b.START, b.END, ["revenue"], None), ("idle", None, None, [], None)]
    out = [r for e in ("good", "undated", "onearm") for r in outcomes_of(e)] + [("stranger", "revenue", 1e6, 6, "good")]
    write(spark, raw, people, out, registry)
    options = {"event_metric": "pre_revenue", "event_buckets": (7, 7), "lower_is_better": ["errors"]}
    written = experiment.run(spark, raw, root, **options)

    results = {(r.experiment_id, r.metric_name): r for r in read(spark, written, "analysis_results")}
    assert {m for e, m in results if e == "good"} == {"conversion", "revenue", "pre_revenue", "errors"}
    assert results["good", "revenue"].n_control + results["good", "revenue"].n_treatment == 40
    flags = {(r.experiment_id, r.metric_name): r.guardrail_status for r in read(spark, written, "guardrail_flags") if r.role == "guardrail"}
    assert flags["good", "latency"] == "NOT_EVALUATED" and flags["good", "errors"] == "FAIL" and flags["onearm", "revenue"] == "NOT_EVALUATED"
    memo = {r.experiment_id: r for r in read(spark, written, "decision_summary")}
    assert set(memo) == {"good", "undated", "onearm", "idle"}
    assert memo["good"].guardrail_status == "FAIL" and memo["good"].memo.count("| revenue |") == 1 and memo["good"].metrics == 4
    assert "latency" in memo["good"].memo and memo["idle"].guardrail_status == memo["onearm"].guardrail_status == "NOT_EVALUATED"
    status = {(r.experiment_id, r.analysis, r.metric_name): r.status for r in read(spark, written, "analysis_status")}
    assert status["onearm", "ab", "revenue"] == "MISSING_TREATMENT" and status["idle", "ab", None] == "NOT_EVALUATED"
    assert status["undated", "window", None] == status["idle", "window", None] == "NO_WINDOW"
    assert status["good", "did", None] == "OK" and status["onearm", "cuped", None] == "NOT_EVALUATED"

    quality = {(r.experiment_id, r.check_name): r.value for r in read(spark, written, "dq_summary")}
    assert quality["good", "exposures_null_user_id"] == "2" and quality["good", "exposures_rows"] == "44"
    broken = {(r.experiment_id, r.rule): r.violations for r in read(spark, written, "contract_violations") if r.table_name == "exposures"}
    assert broken["good", "user_id_missing"] == 2 and broken["good", "variant_not_allowed"] == 1 and broken["undated", "exposure_ts_missing"] == 40
    delta = {r.experiment_id: r.dropped_rows for r in read(spark, written, "dq_rowcount_delta")}
    assert delta["good"] == 4
    assert {r.user_id for r in read(spark, written, "dq_duplicates") if r.user_id} == {"u1"}
    assert {"computed_ts"} <= set(tables.read_table(spark, written["metric_aggregates_daily"]).columns)
    assert {"analysis_ts"} <= set(tables.read_table(spark, written["event_study_coefficients"]).columns)

    # The log is mended, one experiment is withdrawn: nothing of the first run is left.
    people = [(f"u{i}", "treatment" if i % 2 else "control", i % 5, "good") for i in range(40)]
    write(spark, raw, people, outcomes_of("good"), [("good", b.START, b.END, ["revenue"], "note")])
    again = experiment.run(spark, raw, root, experiment_ids=["good", "undated", "onearm", "idle"], **options)
    for name in again:
        assert {r.experiment_id for r in read(spark, again, name)} <= {"good"}, name
    assert read(spark, again, "contract_violations") == [] and read(spark, again, "dq_duplicates") == []
    assert {r.guardrail_status for r in read(spark, again, "decision_summary")} == {"PASS"}


def test_parameters_reach_the_batch(spark, folders):
    raw, root = folders
    people = [(f"u{i}", "treatment" if i % 2 else "control", i % 5, "e") for i in range(40)]
    out = [(u, {"revenue": "spend", "pre_revenue": "pre_spend"}.get(m, m), v, d, e) for u, m, v, d, e in outcomes_of("e")]
    write(spark, raw, people, out, [("e", b.START, b.END, ["spend"], None)])
    written = experiment.run(spark, raw, root, specs=[], target="spend", covariate="pre_spend", confidence=0.9)
    cuped = read(spark, written, "analysis_results_cuped")
    assert [(r.metric_name, r.covariate_name) for r in cuped] == [("spend", "pre_spend")]
    did = read(spark, written, "did_results")
    assert [(r.metric_post, r.metric_pre, r.confidence) for r in did] == [("spend", "pre_spend", 0.9)]
    experiment.run(spark, raw, root, specs=[], target="errors", covariate="pre_spend")
    assert {r.metric_name for r in read(spark, written, "analysis_results_cuped")} == {"spend", "errors"}


@pytest.mark.parametrize("table,column", [("exposures", "variant"), ("outcomes", "value"), ("experiment_registry", "experiment_id")])
def test_a_missing_column_refuses_the_write(spark, folders, table, column):
    raw, root = folders
    write(spark, raw, [("u", "control", 0, "e")], outcomes_of("e", 2), [("e", b.START, b.END, [], None)])
    spark.read.parquet(f"{raw}/{table}.parquet").drop(column).write.parquet(f"{raw}/copy")
    spark.read.parquet(f"{raw}/copy").write.mode("overwrite").parquet(f"{raw}/{table}.parquet")
    with pytest.raises(ValueError, match=f"{table} cannot be used without {column}"):
        experiment.run(spark, raw, root)
    assert not tables.exists(spark, root)


def test_registry_ids_become_unique(spark):
    twice = b.registry(spark, [("e", b.START, b.END), ("e", b.START, None), ("f", None, None)]).unionByName(
        b.registry(spark, [("e", b.START, b.END)])
    )
    got = sorted((r.experiment_id, r.end_ts) for r in readers.unique_registry(twice).collect())
    assert got == [("e", b.END), ("f", None)]


def test_state_is_hash_aggregated(spark):
    exp = b.exposures(spark, [("u", "control", 0)])
    out = b.outcomes(spark, [("u", "revenue", 1.0, 1)])
    forms = {a: a for a in ("sum", "mean", "max", "min", "first")}
    for df in (dedup_exposures(exp), user_pivot(out, exp), user_rollup(out, forms)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan
    canonical = user_pivot(out, exp, agg="sum")._jdf.queryExecution().executedPlan().toString()
    from armlift.operators.grain import user_columns
    from armlift.sources.schemas import MetricSpec

    unique = user_columns(out, exp, [MetricSpec("revenue")], ["m"], unique=True)._jdf.queryExecution().executedPlan().toString()
    assert unique.count("HashAggregate") == canonical.count("HashAggregate") - 2


def test_merge_reads_touched_partitions_and_takes_nulls_as_equal(spark, tmp_path):
    path = str(tmp_path / "table")
    layout = "experiment_id string, metric_name string, delta double"
    make = lambda rows: spark.createDataFrame(rows, layout)
    tables.replace_partitions(make([("a", None, 1.0), ("b", "m", 2.0), ("x y/z", "m", 3.0)]), path)
    files = lambda: sorted(f for f in spark.read.parquet(path).inputFiles() if "experiment_id=b/" in f)
    untouched = files()
    for _ in range(2):
        tables.merge_upsert(make([("a", None, 5.0), ("x y/z", "k", 6.0)]), path, ["experiment_id", "metric_name"])
    got = sorted((r.experiment_id, r.metric_name or "", r.delta) for r in tables.read_table(spark, path).collect())
    assert got == [("a", "", 5.0), ("b", "m", 2.0), ("x y/z", "k", 6.0), ("x y/z", "m", 3.0)]
    assert untouched and files() == untouched
    assert tables.partition_names(spark, path) == {"a", "b", "x y/z"}


def test_names_with_quotes(spark, tmp_path):
    from armlift.sources import catalog

    path = str(tmp_path / "it's here")
    df = spark.createDataFrame([("a", 1.0)], "experiment_id string, delta double")
    tables.replace_partitions(df, path)
    catalog.ensure_table(spark, "odd.results", {"delta": "double", "experiment_id": "string"}, path)
    assert spark.table("odd.results").first().delta == 1.0


def test_broken_rows_go_to_the_quarantine_and_come_back(spark, folders):
    raw, root = folders
    people = [(f"u{i}", "treatment" if i % 2 else "control", 0, "e") for i in range(6)]
    people += [(None, "control", 0, "e"), ("u9", "holdout", 0, "e"), ("u8", None, None, "e"), ("u1", "control", 3, "e")]
    out = [("u1", "revenue", 1.0, 2, "e"), (None, "revenue", 2.0, 2, "e"), ("u2", None, 3.0, 2, "e"), ("u3", "revenue", None, None, "e")]
    out += [("u4", "revenue", 4.0, None, "e"), ("u5", "revenue", 5.0, 2, None), ("u5", "revenue", 7.0, 2, "other")]
    write(spark, raw, people, out, [("e", b.START, b.END, [], None), (None, b.START, b.END, [], None)])
    stored = experiment.ingest(spark, raw, root)
    kept_out = experiment.quarantine(spark, root)
    rules = lambda name: sorted((r.experiment_id or "", r.user_id or "", *r.broken_rules) for r in kept_out[name].collect())
    assert rules("exposures") == [
        ("e", "", "user_id_missing"), ("e", "u8", "variant_missing", "exposure_ts_missing"), ("e", "u9", "variant_not_allowed"),
    ]
    assert rules("outcomes") == [
        ("", "u5", "experiment_id_missing"), ("e", "", "user_id_missing"), ("e", "u2", "metric_name_missing"),
        ("e", "u3", "value_missing", "ts_missing"),
    ]
    assert [r.broken_rules for r in kept_out["experiment_registry"].collect()] == [["experiment_id_missing", "name_missing"]]
    assert sorted(r.user_id for r in stored.outcomes.collect()) == ["u1", "u4", "u5"]
    assert '"metric_name":"revenue"' in kept_out["outcomes"].where("user_id = 'u3'").first().logged_row
    balance = experiment.quality.ingest_balance(
        experiment.logged(spark, raw).by_name(), stored.by_name(), kept_out
    ).collect()
    assert {(r.table_name, r.experiment_id): tuple(r)[2:] for r in balance} == {
        ("exposures", "e"): (10, 6, 3, 1), ("outcomes", "e"): (5, 2, 3, 0), ("outcomes", None): (1, 0, 1, 0),
        ("outcomes", "other"): (1, 1, 0, 0), ("experiment_registry", "e"): (1, 1, 0, 0), ("experiment_registry", None): (1, 0, 1, 0),
    }

    # The log is mended: the rows move from the quarantine to the tables.
    write(spark, raw, people[:6], [("u1", "revenue", 1.0, 2, "e"), ("u2", "revenue", 3.0, 2, "e")], [("e", b.START, b.END, [], None)])
    again = experiment.ingest(spark, raw, root, ["e", "other"])
    kept_out = experiment.quarantine(spark, root)
    assert all(df.count() == 0 for df in kept_out.values())
    assert sorted(r.user_id for r in again.outcomes.collect()) == ["u1", "u2"]


def test_a_value_that_is_no_number_keeps_its_text(spark, folders):
    raw, root = folders
    write(spark, raw, [("u", "control", 0, "e")], [("u", "revenue", 1.0, 2, "e")], [("e", b.START, b.END, [], None)])
    odd = spark.createDataFrame([("e", "u", "revenue", "12,5", b.day(1))], "experiment_id string, user_id string, metric_name string, value string, ts timestamp")
    odd.write.mode("overwrite").parquet(f"{raw}/outcomes.parquet")
    experiment.ingest(spark, raw, root)
    row = experiment.quarantine(spark, root)["outcomes"].first()
    assert row.value is None and '"value":"12,5"' in row.logged_row and row.broken_rules == ["value_missing"]


def test_replayed_logs(spark):
    from armlift.operators import replays

    layout = "experiment_id string, user_id string, metric_name string, value double, ts timestamp, event_id string"
    day = lambda rows, n: [("e", f"u{i}", "m", float(i), b.day(n), None) for i in range(rows)]
    rows = day(25, 1) * 3 + [("e", "u0", "m", 0.0, b.day(1), None)] * 3  # a day logged three times, u0 bought twice
    rows += day(25, 2) * 2 + [("e", "late", "m", 1.0, b.day(2), None)]  # one row stands once: no replay
    rows += day(5, 3) * 2  # too few rows to tell
    rows += [("e", "u", "m", v, b.day(4), "id1") for v in (2.0, 1.0, 1.0)] + [("e", "u", "m", 1.0, b.day(4), "id2")]
    rows += [("e", "u", "m", 1.0, None, "id1"), ("e", None, None, None, None, None), ("e", None, None, None, None, None)]
    df = spark.createDataFrame(rows, layout)
    got = replays.dedup_outcomes(df).groupBy("ts").count().collect()
    assert {r.ts: r["count"] for r in got} == {b.day(1): 26, b.day(2): 51, b.day(3): 10, b.day(4): 2, None: 3}
    report = {r.batch and r.batch.day: r for r in replays.outcome_replays(df).collect()}
    assert set(report) == {2, 5}
    assert (report[2].logged, report[2].kept, report[2].replayed_rows, report[2].factor) == (78, 26, 52, 3)
    assert (report[5].event_copies, report[5].conflicting, report[5].kept) == (2, 1, 2)
    assert replays.dedup_outcomes(df.drop("event_id").limit(0)).count() == 0
    low = replays.dedup_outcomes(df.where("event_id = 'id1' AND ts IS NOT NULL")).first()
    assert low.value == 1.0
    many = spark.createDataFrame(day(20, 1) * 62, layout)
    assert replays.dedup_outcomes(many).count() == 20
