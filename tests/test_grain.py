"""Deduplication, windows, roll-ups, merged moments."""

import numpy as np
import pytest

import builders as b
from armlift.operators import ab, grain, metrics, pretrend, profile, quality, windows
from armlift.operators.exposure import dedup_exposures
from armlift.sources.schemas import MetricSpec


def test_first_exposure_wins(spark):
    df = b.exposures(spark, [("u1", "treatment", 2), ("u1", "control", 1), ("u2", "treatment", 1), ("u2", "control", 1),
                             ("u3", "control", None), ("u3", "treatment", 5), (None, "control", 1), ("u4", "control", None)])
    got = {r.user_id: r.variant for r in dedup_exposures(df).collect()}
    assert got == {"u1": "control", "u2": "control", "u3": "treatment", "u4": "control"}


def test_window_is_closed_and_keeps_pre_rows(spark):
    out = b.outcomes(spark, [("u", "revenue", 1.0, 0), ("u", "revenue", 2.0, 14), ("u", "revenue", 4.0, 14.001),
                             ("u", "revenue", 8.0, None), ("u", "pre_revenue", 16.0, -5), ("u", "pre_revenue", 32.0, None)])
    kept = lambda reg: sum(r.value for r in windows.window_filter(out, reg).collect())
    assert kept(b.registry(spark)) == 1 + 2 + 16 + 32
    assert kept(b.registry(spark, [("e1", b.START, None)])) == 63
    assert kept(b.registry(spark, [("other", b.START, b.END)])) == 63
    assert kept(b.registry(spark).drop("end_ts")) == 63
    renamed = b.registry(spark).withColumnsRenamed({"start_ts": "start_time", "end_ts": "end_time"})
    assert kept(renamed) == 51


def test_lookup_beyond_the_broadcast_bound_gives_the_same_rows(spark, rows, monkeypatch):
    out = b.outcomes(spark, [(f"u{i % 50}", "revenue", float(i), i % 20) for i in range(300)])
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    small = windows.window_filter(out, b.registry(spark))
    assert "BroadcastHashJoin" in plan(small) and "_salt" not in plan(small)
    monkeypatch.setattr(windows, "BROADCAST_ROWS", 0)
    large = windows.window_filter(out, b.registry(spark))
    assert "SortMergeJoin" in plan(large) and "_salt" in plan(large)
    assert rows(large) == rows(small)


def test_long_ids_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(windows, "BROADCAST_ID_BYTES", 10)
    assert windows.fits_broadcast(spark.sql("SELECT 'short' AS experiment_id"))
    assert not windows.fits_broadcast(spark.sql("SELECT 'a longer one' AS experiment_id"))


def test_window_falls_back_to_exposures_and_has_a_status(spark):
    exp = b.exposures(spark, [("u1", "control", 3, "open"), ("u2", "control", 7, "open"), ("u3", "control", None, "undated"),
                              ("u4", "control", 2, "unlisted"), ("u5", "control", 5, "closed")])
    reg = b.registry(spark, [("open", b.START, None), ("undated", None, None), ("closed", b.START, b.END), ("unseen", None, b.END)])
    for registry in (reg, reg.drop("end_ts")):
        got = {r.experiment_id: (r.start_ts, r.end_ts, r.window_status) for r in windows.window_from_registry(registry, exp).collect()}
        closed = (b.START, b.END, "REGISTRY") if registry is reg else (b.day(5), b.day(5), "EXPOSURES")
        assert got == {"open": (b.day(3), b.day(7), "EXPOSURES"), "undated": (None, None, "NO_WINDOW"), "closed": closed,
                       "unlisted": (b.day(2), b.day(2), "EXPOSURES"), "unseen": (None, None, "NO_WINDOW")}


@pytest.mark.parametrize("offset", [0.0, 1e7])
def test_merged_moments_equal_plain_ones(spark, offset):
    """A hot user with a third of the rows, single-row users, and a large mean."""
    rng = np.random.default_rng(1)
    counts = [200] + [1] * 100 + [int(c) for c in rng.integers(2, 10, 60)]
    out, exp, values = [], [], {"control": [], "treatment": []}
    for i, c in enumerate(counts):
        v = "control" if i % 2 else "treatment"
        exp.append((f"u{i}", v, 0))
        for _ in range(c):
            value = float(rng.normal(offset + i, 2))
            out.append((f"u{i}", "revenue", value, 1))
            values[v].append(value)
    got = {r.variant: r for r in ab.ab_stats(b.outcomes(spark, out), b.exposures(spark, exp)).collect()}
    for v, xs in values.items():
        assert got[v].n == len(xs)
        assert abs(got[v]["mean"] / np.mean(xs) - 1) < 1e-12
        assert abs(got[v]["var"] / np.var(xs, ddof=1) - 1) < 1e-7


def test_single_row_has_no_variance(spark):
    r = ab.ab_stats(b.outcomes(spark, [("u", "revenue", 3.0, 1)]), b.exposures(spark, [("u", "control", 0)])).first()
    assert (r.n, r["mean"], r["var"], r["std"]) == (1, 3.0, None, None)


def test_null_values_count_as_rows_only(spark):
    out = b.outcomes(spark, [("u", "revenue", 2.0, 1), ("u", "revenue", None, 1), ("w", "revenue", None, 1)])
    exp = b.exposures(spark, [("u", "control", 0), ("w", "control", 0)])
    r = metrics.metric_overall(out, exp, b.registry(spark)).first()
    assert (r.n, r["mean"], r["sum"], r.stddev) == (3, 2.0, 2.0, None)


def test_duplicate_exposures_do_not_multiply_outcomes(spark):
    out = b.outcomes(spark, [("u", "revenue", 2.0, 1)])
    exp = b.exposures(spark, [("u", "control", 0), ("u", "treatment", 1)])
    assert [(r.variant, r.n) for r in metrics.metric_daily(out, exp, b.registry(spark)).collect()] == [("control", 1)]


def test_rollups(spark):
    out = b.outcomes(spark, [("u", "revenue", 5.0, 2), ("u", "revenue", 1.0, 3), ("u", "revenue", 9.0, None), ("u", "revenue", 4.0, 2)])
    forms = {a: a for a in ("sum", "mean", "max", "min", "first")}
    r = grain.user_rollup(out, forms).first()
    assert (r["sum"], r["mean"], r["max"], r["min"], r["first"]) == (19.0, 4.75, 9.0, 1.0, 4.0)


def test_pivots(spark):
    out = b.outcomes(spark, [("a", "revenue", 5.0, 2), ("a", "pre_revenue", 1.0, -2), ("b", "revenue", 3.0, 1), ("c", "revenue", -3.0, 1), ("c", "pre_revenue", 2.0, -1)])
    exp = b.exposures(spark, [("a", "control", 0), ("b", "treatment", 0), ("c", "control", 0), ("d", "control", 0)])
    complete = {r.user_id: (r.x, r.y) for r in grain.user_pivot(out, exp).collect()}
    assert complete == {"a": (1.0, 5.0), "c": (2.0, -3.0)}
    zero = {r.user_id: (r.x, r.y) for r in grain.user_pivot_zero(out, exp).collect()}
    assert zero == {"a": (1.0, 5.0), "b": (0.0, 3.0), "c": (2.0, 0.0)}


def test_metric_window_overrides_the_prefix(spark):
    """A pre-period metric whose name lacks the prefix is not cut by the window."""
    out = b.outcomes(spark, [("u", "history", 1.0, -9), ("u", "revenue", 1.0, -9)])
    specs = [MetricSpec("history", window="pre"), MetricSpec("revenue")]
    got = metrics.metric_overall(out, b.exposures(spark, [("u", "control", 0)]), b.registry(spark), specs)
    assert [r.metric_name for r in got.collect()] == ["history"]


def test_pretrend_daily_is_relative_to_exposure(spark):
    out = b.outcomes(spark, [("u", "pre_revenue", 2.0, -2), ("u", "pre_revenue", 4.0, -2.1), ("u", "pre_revenue", 8.0, 1), ("w", "pre_revenue", 5.0, 0)])
    exp = b.exposures(spark, [("u", "control", 0.5), ("w", "control", 2)])
    got = sorted((r.k_days, r["mean"]) for r in pretrend.pretrend_daily(out, exp).collect())
    assert got == [(-3, 4.0), (-2, 3.5)]


def test_leakage(spark):
    out = b.outcomes(spark, [("u", "revenue", 1.0, 1), ("u", "revenue", 1.0, 20), ("u", "pre_revenue", 1.0, 3), ("u", "pre_revenue", 1.0, None)])
    got = {r.metric_name: r for r in quality.dq_leakage(out, b.exposures(spark, [("u", "control", 2)]), b.registry(spark)).collect()}
    assert (got["revenue"].post_before_exposure, got["revenue"].post_outside_window) == (1, 1)
    assert (got["pre_revenue"].pre_after_exposure, got["pre_revenue"].undated) == (1, 1)


def test_quantiles_are_exact_in_a_large_group(spark):
    """Two million distinct values in one group, a group of few, one of equal values and one of NULLs."""
    n = 2_000_000
    df = spark.range(n).selectExpr("'g' AS g", "CAST((id * 7919) % 2000000 AS DOUBLE) AS value").unionByName(
        spark.sql("SELECT 'few' AS g, CAST(id AS DOUBLE) AS value FROM range(3) UNION ALL SELECT 'same', 5D FROM range(1000)"
                  " UNION ALL SELECT 'none', CAST(NULL AS DOUBLE) UNION ALL SELECT NULL, 1D"))
    got = {}
    for r in profile.quantiles(df, ["g"]).collect():
        got.setdefault(r.g, {})[r.q] = r.value
    assert got["g"] == {q: -(-q * n // 100) - 1 for q in range(1, 100)}
    assert got["few"] == {q: float(-(-q * 3 // 100) - 1) for q in range(1, 100)}
    assert set(got["same"].values()) == {5.0} and len(got["same"]) == 99
    assert set(got) == {"g", "few", "same", None}


def test_approximate_quantiles_are_within_their_bound(spark):
    n = 300_000
    df = spark.range(n).selectExpr("'g' AS g", "CAST(id AS DOUBLE) AS value")
    for r in profile.approximate_quantiles(df, ["g"]).collect():
        assert abs(r.value - r.q / 100 * n) <= n / profile.ACCURACY + 1


def test_an_unknown_label_never_wins(spark):
    df = b.exposures(spark, [("u", "holdout", 0), ("u", "control", 1), ("w", "holdout", 0)])
    assert [(r.user_id, r.variant, r.exposure_ts, r.unit) for r in dedup_exposures(df).collect()] == [("u", "control", b.day(1), "user_id")]


def test_users_are_counted_not_rows(spark):
    out = b.outcomes(spark, [("u", "conversion", 1.0, d) for d in range(3)] + [("w", "conversion", float(d == 2), d) for d in range(3)])
    joined = grain.join_inner_exposed(out, b.exposures(spark, [("u", "control", 0), ("w", "control", 0)]))
    r = ab.converted_users(joined).first()
    assert (r.total_users, r.converted_users, r.conversion_proportion, r["rows"]) == (2, 2, 1.0, 6)


def test_missing_users_follow_the_spec(spark):
    out = b.outcomes(spark, [("u", "latency", 100.0, 1), ("t", "latency", 100.0, 1), ("u", "revenue", 4.0, 1)])
    exp = b.exposures(spark, [("u", "control", 0), ("v", "control", 0), ("t", "treatment", 0)])
    specs = [MetricSpec("latency", "mean"), MetricSpec("revenue")]
    got = {(r.metric_name, r.variant): (r.n, r["mean"]) for r in ab.user_arm_stats(out, exp, specs).collect()}
    assert got["latency", "control"] == (1, 100.0) and got["revenue", "control"] == (2, 2.0)
    zero = ab.user_arm_stats(out, exp, [MetricSpec("latency", "mean", missing="zero")]).where("variant = 'control'").first()
    assert (zero.n, zero["mean"]) == (2, 50.0)


def test_other_metrics_equal_a_spec_of_their_own(spark, rows):
    out = b.outcomes(spark, [(f"u{i}", m, float(i % 5), d) for i in range(30) for m in ("clicks", "views") for d in range(i % 3)] + [("x", "clicks", 9.0, 1)])
    exp = b.exposures(spark, [(f"u{i}", "control" if i % 2 else "treatment", 0) for i in range(40)])
    mine = {(r["metric_name"], r["variant"]): r for r in rows(ab.other_arm_stats(out, exp, []))}
    plain = {(r["metric_name"], r["variant"]): r for r in rows(ab.user_arm_stats(out, exp, [MetricSpec("clicks"), MetricSpec("views")]))}
    assert set(mine) == set(plain) and len(mine) == 4
    for key, r in mine.items():
        assert r["n"] == plain[key]["n"] and abs(r["mean"] - plain[key]["mean"]) < 1e-12 and abs(r["var"] - plain[key]["var"]) < 1e-9


def test_approximate_distinct_users(spark):
    df = spark.range(50_000).selectExpr("'g' AS g", "CAST(id % 20000 AS STRING) AS user_id")
    assert profile.distinct_users(df, ["g"]).first().users == 20_000
    assert abs(profile.distinct_users(df, ["g"], approximate=True).first().users / 20_000 - 1) < 0.1
