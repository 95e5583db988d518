"""Closed forms against direct solves, published numbers, invariants and edge rows."""

import math

import numpy as np
import pytest

import builders as b
from armlift.operators import ab, cuped, did, event_study, pretrend
from armlift.operators.moments import arm_moments
from armlift.sources.schemas import MetricSpec


def one(df):
    found = df.collect()
    assert len(found) == 1
    return found[0]


# ---- published numbers -------------------------------------------------------

def test_two_proportion_golden(spark):
    stats = b.arm_stats(
        spark,
        [("conversion", "control", 424190, 42385 / 424190, None),
         ("conversion", "treatment", 425521, 63861 / 425521, None)],
    )
    r = one(ab.ab_analysis(stats))
    assert r.method == "two_proportion_z"
    assert f"{r.mean_control:.6g} {r.mean_treatment:.6g} {r.delta:.6g}" == "0.0999198 0.150077 0.0501574"
    assert f"{r.rel_lift:.6g} {r.ci_low:.6g} {r.ci_high:.6g}" == "0.501976 0.0487552 0.0515595"
    assert abs(r.z - 69.891502) < 1e-6
    assert 0 <= r.p_value < 1e-300


def test_newcombe_golden(spark):
    counts = spark.createDataFrame(
        [("e1", "control", "conversion", 424190, 42385), ("e1", "treatment", "conversion", 425521, 63861)],
        "experiment_id string, variant string, metric_name string, total_users bigint, converted_users bigint",
    )
    r = one(ab.newcombe_ci(counts))
    assert f"{r.ci_low:.6f} {r.ci_high:.6f}" == "0.048755 0.051560"
    assert abs(one(ab.ztest_pooled(counts)).z - 69.891502) < 1e-6


def test_did_cell_means_golden(spark):
    """Published cell means, four digits of the published estimate."""
    rows = [("c1", "control", 12.4993, 1.25252), ("c2", "control", 12.4993, 1.25252),
            ("t1", "treatment", 12.5042, 1.87712), ("t2", "treatment", 12.5042, 1.87712)]
    r = one(did.did_confidence(arm_moments(b.users(spark, rows))))
    assert abs(r.did - 0.61968) < 1e-4
    assert (r.se, r.z, r.p_value) == (0.0, None, None)
    assert r.ci_low == r.did == r.ci_high


@pytest.mark.parametrize(
    "estimate,se,p,printed",
    [(-0.0009732170492, 0.000535243494, 0.0690229, 5e-14), (0.127119, 0.15309678, 0.406358, 5e-7)],
)
def test_p_value_goldens(spark, estimate, se, p, printed):
    """``printed`` is the rounding of the published estimate; it carries over to p."""
    from armlift.functions.normal import two_sided_p

    frame = spark.createDataFrame([(estimate / se,)], "z double")
    carried = 2 * math.exp(-((estimate / se) ** 2) / 2) / math.sqrt(2 * math.pi) * printed / se
    assert abs(frame.selectExpr(two_sided_p("z")).first()[0] - p) < 5e-7 + carried


# ---- direct solves -----------------------------------------------------------

def ols(X, y):
    inv = np.linalg.inv(X.T @ X)
    beta = inv @ X.T @ y
    return beta, y - X @ beta, inv


def test_did_clustered_matches_sandwich(spark):
    rows = b.random_users(3)
    X, y, groups = [], [], []
    for i, (_, v, pre, post) in enumerate(rows):
        g = float(v == "treatment")
        X += [[1, g, 0, 0], [1, g, 1, g]]
        y += [pre, post]
        groups += [i, i]
    X, y, groups = np.array(X, float), np.array(y), np.array(groups)
    beta, e, inv = ols(X, y)
    scores = np.zeros((len(rows), 4))
    np.add.at(scores, groups, X * e[:, None])
    G, N, K = len(rows), len(y), 4
    cov = inv @ (scores.T @ scores) @ inv * (G / (G - 1)) * ((N - 1) / (N - K))
    got = {r.term: r for r in did.did_clustered(arm_moments(b.users(spark, rows))).collect()}
    for i, term in enumerate(["Intercept", "group", "period", "group:period"]):
        assert abs(got[term].coef - beta[i]) < 1e-9
        assert abs(got[term].se - math.sqrt(cov[i, i])) < 1e-9


def test_clustered_equals_plain_error_without_covariance(spark):
    """Pre and post uncorrelated within arms: only the small-sample factor is left."""
    rows = [(f"{a}{i}{j}", a, x, y) for a in ("control", "treatment")
            for i, x in enumerate((1.0, 3.0)) for j, y in enumerate((2.0, 6.0))]
    m = arm_moments(b.users(spark, rows))
    plain = one(did.did_confidence(m)).se
    clustered = {r.term: r.se for r in did.did_clustered(m).collect()}["group:period"]
    n, G = 4, 8
    factor = (G / (G - 1)) * ((2 * G - 1) / (2 * G - 4)) * (n - 1) / n
    assert abs(clustered - plain * math.sqrt(factor)) < 1e-12


def test_cuped_matches_two_pass(spark):
    rows = b.random_users(11)
    x = np.array([r[2] for r in rows]); y = np.array([r[3] for r in rows])
    t = np.array([r[1] == "treatment" for r in rows])
    theta = np.cov(y, x)[0, 1] / np.var(x, ddof=1)
    adj = y - theta * (x - x.mean())
    r = one(cuped.cuped(arm_moments(b.users(spark, rows))))
    assert abs(r.theta - theta) < 1e-10 and abs(r.x_mean - x.mean()) < 1e-10
    assert abs(r.delta_cuped - (adj[t].mean() - adj[~t].mean())) < 1e-9
    se = math.sqrt(adj[t].var(ddof=1) / t.sum() + adj[~t].var(ddof=1) / (~t).sum())
    assert abs(r.se_cuped - se) < 1e-9
    assert r.se_cuped < r.se_raw
    assert one(cuped.cuped_variance_reduction(cuped.cuped(arm_moments(b.users(spark, rows))))).status == "APPLIED"
    raw = one(cuped.theta_from_moments(b.users(spark, rows)))
    assert abs(raw.theta - theta) < 1e-9


def test_cuped_with_constant_covariate_is_raw(spark):
    rows = [(f"u{i}", v, 5.0, float(i)) for i, v in enumerate(["control", "treatment"] * 4)]
    result = cuped.cuped(arm_moments(b.users(spark, rows)))
    r = one(result)
    assert r.theta == 0.0
    assert (r.delta_cuped, r.se_cuped) == (r.delta_raw, r.se_raw)
    assert one(cuped.cuped_variance_reduction(result)).status == "SKIPPED"


def trend(spark, points):
    return spark.createDataFrame(
        [("e1", k, v, m) for k, c, t in points for v, m in (("control", c), ("treatment", t)) if m is not None],
        "experiment_id string, k_days int, variant string, mean double",
    )


def test_pretrend_slope_and_hc3_match_ols(spark):
    rng = np.random.default_rng(2)
    ks = np.arange(-30, 0)
    c, t = rng.normal(0, 1, 30), rng.normal(0.2, 1, 30)
    daily = trend(spark, [(int(k), float(a), float(d)) for k, a, d in zip(ks, c, t)])
    X = np.column_stack([np.ones(30), ks]); y = t - c
    beta, e, inv = ols(X, y)
    plain = math.sqrt(e @ e / 28 * inv[1, 1])
    h = np.einsum("ij,jk,ik->i", X, inv, X)
    hc3 = inv @ (X.T @ (X * ((e / (1 - h)) ** 2)[:, None])) @ inv
    r = one(pretrend.pretrend_slope(daily))
    assert abs(r.slope - beta[1]) < 1e-10 and abs(r.se - plain) < 1e-10
    got = {x.term: x for x in pretrend.pretrend_slope_hc3(pretrend.pretrend_delta(daily)).collect()}
    for i, term in enumerate(["Intercept", "k_days"]):
        assert abs(got[term].coef - beta[i]) < 1e-9
        assert abs(got[term].se_hc3 - math.sqrt(hc3[i, i])) < 1e-9
        assert abs(got[term].se_ols - math.sqrt(e @ e / 28 * inv[i, i])) < 1e-9


@pytest.mark.parametrize(
    "points,verdict,p",
    [
        ([(-3, 1.0, 1.0), (-2, 1.0, 2.0)], "INSUFFICIENT_DATA", None),
        ([(-3, 1.0, None), (-2, None, 2.0), (-1, 1.0, None)], "INSUFFICIENT_DATA", None),
        ([(-3, 1.0, 2.0), (-2, 1.0, 2.0), (-1, 1.0, 2.0)], "PASS", 1.0),
        ([(-3, 0.0, 1.0), (-2, 0.0, 2.0), (-1, 0.0, 3.0)], "FAIL", 0.0),
    ],
)
def test_pretrend_verdicts(spark, points, verdict, p):
    r = one(pretrend.pretrend_slope(trend(spark, points)))
    assert (r.verdict, r.p_value) == (verdict, p)


def test_event_study_matches_hc1(spark):
    rng = np.random.default_rng(9)
    rows, data = [], []
    ks = [-3, -2, -1, 0, 1]
    for v in ("control", "treatment"):
        for k in ks:
            for u in range(int(rng.integers(4, 9))):
                y = float(rng.normal(k, 1) + (v == "treatment") * 0.5)
                data.append((v, k, y))
                rows.append(("e1", "revenue", v, f"{v}{k}{u}", None, k, y))
    frame = spark.createDataFrame(
        rows,
        "experiment_id string, metric_name string, variant string, user_id string, bucket_ts timestamp, k int, y double",
    )
    used = [k for k in ks if k != -1]
    X = np.array([[1.0, v == "treatment"] + [k == j for j in used] + [(k == j) * (v == "treatment") for j in used] for v, k, _ in data], float)
    y = np.array([d[2] for d in data])
    beta, e, inv = ols(X, y)
    n, p = X.shape
    cov = n / (n - p) * inv @ (X.T @ (X * (e * e)[:, None])) @ inv
    cells = event_study.bucket_cells(frame)
    got = {r.k: r for r in event_study.event_study(cells).collect()}
    assert sorted(got) == used
    for j, k in enumerate(used):
        i = 2 + len(used) + j
        assert abs(got[k].beta - beta[i]) < 1e-9
        assert abs(got[k].se - math.sqrt(cov[i, i])) < 1e-9
    verdict = one(event_study.event_study_verdict(event_study.event_study(cells)))
    assert verdict.num_leads == 2 and verdict.joint_stat is None


def test_event_study_without_reference_is_empty(spark):
    frame = spark.createDataFrame(
        [("e1", "revenue", v, "u", None, k, 1.0) for v in ("control", "treatment") for k in (-2, 0)],
        "experiment_id string, metric_name string, variant string, user_id string, bucket_ts timestamp, k int, y double",
    )
    assert event_study.event_study(event_study.bucket_cells(frame)).isEmpty()


# ---- A/B edges and invariants --------------------------------------------------

def test_missing_arm_has_no_result(spark):
    assert ab.ab_analysis(b.arm_stats(spark, [("revenue", "control", 5, 1, 1)])).isEmpty()


def test_unknown_label_is_ignored_in_pairs(spark):
    rows = [("revenue", "control", 5, 1, 1), ("revenue", "treatment", 5, 2, 1), ("revenue", "holdout", 9, 9, 9)]
    assert one(ab.ab_analysis(b.arm_stats(spark, rows))).delta == 1.0


def test_missing_variance_falls_back(spark):
    rows = [("a", "control", 1, 0.5, None), ("a", "treatment", 4, 0.25, 1),
            ("b", "control", 1, 7, None), ("b", "treatment", 1, 9, None)]
    got = {r.metric_name: r for r in ab.ab_analysis(b.arm_stats(spark, rows)).collect()}
    assert abs(got["a"].se - math.sqrt(0.25 + 0.1875 / 4)) < 1e-12
    assert (got["b"].se, got["b"].z, got["b"].p_value) == (0.0, 0.0, 1.0)


def test_zero_control_mean_gives_null_lift(spark):
    rows = [("conversion", "control", 10, 0, 0), ("conversion", "treatment", 10, 0, 0)]
    r = one(ab.ab_analysis(b.arm_stats(spark, rows)))
    assert (r.rel_lift, r.z, r.p_value, r.se) == (None, 0.0, 1.0, 0.0)


def test_arm_swap_flips_sign_and_keeps_p(spark):
    rows = [("conversion", "control", 100, 0.2, 0.16), ("conversion", "treatment", 90, 0.3, 0.2),
            ("revenue", "control", 100, 5, 4), ("revenue", "treatment", 90, 6, 3)]
    other = {"control": "treatment", "treatment": "control"}
    plain = ab.ab_analysis(b.arm_stats(spark, rows)).collect()
    swapped = {r.metric_name: r for r in ab.ab_analysis(b.arm_stats(spark, [(m, other[v], *x) for m, v, *x in rows])).collect()}
    for r in plain:
        s = swapped[r.metric_name]
        assert abs(r.delta + s.delta) < 1e-15 and abs(r.p_value - s.p_value) < 1e-15


def test_shift_of_one_arm_shifts_delta(spark):
    rows = b.random_users(4)
    moved = [(u, v, x, y + (3.0 if v == "treatment" else 0.0)) for u, v, x, y in rows]
    before = one(did.did_confidence(arm_moments(b.users(spark, rows))))
    after = one(did.did_confidence(arm_moments(b.users(spark, moved))))
    assert abs(after.did - before.did - 3.0) < 1e-9 and abs(after.se - before.se) < 1e-9


def test_welch_t_of_two_small_samples(spark):
    c, t = [1.0, 2.0, 3.0, 4.0], [2.0, 4.0, 4.0, 5.0, 9.0]
    rows = [("revenue", "control", 4, np.mean(c), np.var(c, ddof=1)), ("revenue", "treatment", 5, np.mean(t), np.var(t, ddof=1))]
    r = one(ab.welch_t(b.arm_stats(spark, rows)))
    a, d = np.var(c, ddof=1) / 4, np.var(t, ddof=1) / 5
    df = (a + d) ** 2 / (a * a / 3 + d * d / 4)
    assert abs(r.df - df) < 1e-9
    from test_functions import t_tail

    assert abs(r.p_value - t_tail(r.t_stat, df)) < 1e-5
    # The tail beyond each end of the interval is 2.5%.
    edge = (r.ci_high - r.delta) / r.se
    assert abs(t_tail(edge, df) - 0.05) < 1e-4


def test_complete_cases_only(spark):
    frame = spark.createDataFrame(
        [("e1", "control", 1.0, None), ("e1", "control", 2.0, 3.0), ("e1", "treatment", None, 1.0)],
        "experiment_id string, variant string, x double, y double",
    )
    got = {r.variant: r.n for r in arm_moments(frame).collect()}
    assert got == {"control": 1, "treatment": 0}
    assert cuped.cuped(arm_moments(frame)).isEmpty()
    assert did.did_confidence(arm_moments(frame)).isEmpty()


def test_two_experiments_are_the_union_of_single_runs(spark, rows):
    exp = [(f"u{i}", "control" if i % 3 else "treatment", 0, e) for e in ("e1", "e2") for i in range(12)]
    out = [(f"u{i}", m, float(i * (2 if e == "e2" else 1)), 1, e) for e in ("e1", "e2") for i in range(12) for m in ("revenue", "pre_revenue")]
    specs = [MetricSpec("revenue"), MetricSpec("pre_revenue")]
    run = lambda keep: rows(ab.ab_analysis(ab.user_arm_stats(
        b.outcomes(spark, [o for o in out if o[4] in keep]), b.exposures(spark, [x for x in exp if x[3] in keep]), specs)))
    assert run(("e1", "e2")) == sorted(run(("e1",)) + run(("e2",)), key=repr)


def test_untestable_leads_are_no_pass(spark):
    layout = "experiment_id string, metric_name string, grain string, k int, p_value double"
    verdict = lambda rows: one(event_study.event_study_verdict(spark.createDataFrame([("e", "m", "day", k, p) for k, p in rows], layout)))
    assert verdict([(-2, None), (1, 0.001)]).verdict == "INSUFFICIENT_DATA"
    assert verdict([(1, 0.001)]).verdict == "INSUFFICIENT_DATA"
    assert verdict([(-2, None), (-3, 0.5)]).verdict == "PASS"


def test_missing_arm_has_a_status(spark):
    stats = b.arm_stats(spark, [("a", "control", 5, 1, 1), ("a", "treatment", 5, 1, 1), ("b", "control", 5, 1, 1), ("c", "treatment", 5, 1, 1)])
    assert {r.metric_name: r.status for r in ab.missing_arms(stats).collect()} == {"a": "OK", "b": "MISSING_TREATMENT", "c": "MISSING_CONTROL"}
