"""Joint lead test, clustered least squares, ratios, segments and sketches against direct computations."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import builders as b
from armlift.functions.chi_square import chi_square_tail
from armlift.operators import ab, did, event_study, grain, ratios, regression, segments, sketches
from armlift.operators.moments import arm_moments
from armlift.sources.schemas import MetricSpec

# Published upper tails of the chi-square distribution.
TAILS = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (18.307038053275146, 10, 0.05), (24.995790139728616, 15, 0.05),
         (63.69073973, 40, 0.01), (0.0, 7, 1.0), (2.705543454095404, 1, 0.1)]


def test_chi_square_tail(spark):
    rows = spark.createDataFrame([(s, m, p) for s, m, p in TAILS] + [(None, 3, None), (4.0, 0, None)], "s double, m int, want double")
    for r in rows.select("want", F.expr(chi_square_tail("s", "m")).alias("got")).collect():
        assert r.got is None if r.want is None else abs(r.got - r.want) < 1e-7


def test_joint_leads_against_a_direct_solve(spark):
    rng = np.random.default_rng(4)
    rows, data = [], {}
    for k in range(-5, 4):
        for arm in ("control", "treatment"):
            y = rng.normal(k * 0.1 * (arm == "treatment"), 1 + abs(k) / 4, 30 + k)
            data[k, arm] = y
            rows.append(("e", "m", arm, b.day(k), k, len(y), float(y.mean()), float(y.std(ddof=1)), 0.0))
    cells = spark.createDataFrame(
        rows, "experiment_id string, metric_name string, variant string, bucket_ts timestamp, k int, n_users long, mean_y double, std_y double, se_mean double"
    )
    got = event_study.joint_leads(cells).first()
    delta = {k: data[k, "treatment"].mean() - data[k, "control"].mean() for k in range(-5, 4)}
    term = {k: sum(data[k, a].var(ddof=1) * (len(data[k, a]) - 1) / len(data[k, a]) ** 2 for a in ("control", "treatment")) for k in delta}
    n = sum(map(len, data.values()))
    factor = n / (n - 2 * len(delta))
    leads = [k for k in delta if k < -1]
    beta = np.array([delta[k] - delta[-1] for k in leads])
    cov = factor * (np.diag([term[k] for k in leads]) + term[-1])
    stat = beta @ np.linalg.solve(cov, beta)
    assert abs(got.joint_stat - stat) < 1e-9 * stat
    half = stat / 2
    assert abs(got.joint_p_value - math.exp(-half) * (1 + half)) < 1e-9  # four leads
    verdict = event_study.event_study_verdict(event_study.event_study(cells), 5, 4, joint=event_study.joint_leads(cells)).first()
    assert verdict.num_leads == 4 and verdict.joint_stat == got.joint_stat
    flat = cells.withColumn("std_y", F.lit(0.0))
    assert event_study.joint_leads(flat).first().joint_p_value is None


def solve(x, y, groups):
    inverse = np.linalg.inv(x.T @ x)
    beta = inverse @ x.T @ y
    scores = {}
    for row, value, g in zip(x, y, groups):
        scores[g] = scores.get(g, 0) + row * (value - row @ beta)
    s = np.array(list(scores.values()))
    c = len(s) / (len(s) - 1) * (len(y) - 1) / (len(y) - x.shape[1])
    return beta, np.sqrt(np.diag(inverse @ (s.T @ s) @ inverse) * c)


def test_unbalanced_panel_against_a_direct_solve(spark):
    rng = random.Random(5)
    rows = []
    for i in range(60):
        for period in (0, 1):
            rows += [("e", f"u{i}", i % 2, period, rng.gauss(10 + period + i % 2 * 2, 3)) for _ in range(rng.choice([0, 1, 1, 3]))]
    rows += [("e", None, 0, 1, 4.0), ("e", "u1", 1, None, 4.0), ("e", "u2", 0, 0, None), ("one", "a", 0, 0, 1.0), ("one", "a", 0, 1, 2.0)]
    df = spark.createDataFrame(rows, "experiment_id string, user_id string, group int, period int, measure double")
    got = {(r.experiment_id, r.term): r for r in regression.did_clustered_long(df).collect()}
    kept = [r for r in rows if r[0] == "e" and r[3] is not None and r[4] is not None]
    x = np.array([[1, r[2], r[3], r[2] * r[3]] for r in kept], float)
    beta, se = solve(x, np.array([r[4] for r in kept]), [r[1] for r in kept])
    for term, c, e in zip(("Intercept", "group", "period", "group:period"), beta, se):
        assert abs(got["e", term].coef - c) < 1e-9 and abs(got["e", term].se - e) < 1e-9
        assert got["one", term].coef is None and got["one", term].se is None  # the terms are not told apart
    assert got["e", "period"].n_obs == len(kept) and got["e", "period"].n_clusters == len({r[1] for r in kept})


def test_more_terms(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 3)) * [1, 1e4, 1e-3]
    y = x @ [1.0, 2e-4, 3e3] + rng.normal(size=200)
    users = [f"u{i // 3}" for i in range(200)]
    df = spark.createDataFrame([("e", u, *map(float, r), float(v)) for u, r, v in zip(users, x, y)], "experiment_id string, user_id string, a double, b double, c double, y double")
    got = {r.term: r for r in regression.ols_clustered(df, "y", {t: F.col(t) for t in "abc"}).collect()}
    beta, se = solve(x, y, users)
    for term, c, e in zip("abc", beta, se):
        assert abs(got[term].coef / c - 1) < 1e-8 and abs(got[term].se / e - 1) < 1e-8
    double = regression.ols_clustered(df, "y", {"a": F.col("a"), "twice": 2 * F.col("a")}).collect()
    assert all(r.coef is None for r in double)


def test_pairs_have_the_closed_form(spark, rows):
    users = b.users(spark, b.random_users(7))
    closed = {r["term"]: r for r in rows(did.did_clustered(arm_moments(users)))}
    for r in rows(regression.did_clustered_long(did.did_long(users))):
        assert all(abs(r[c] - closed[r["term"]][c]) < 1e-9 for c in ("coef", "se", "z", "ci_low"))


def corpus(spark, n=80):
    rng = random.Random(2)
    people = [(f"u{i}", rng.choice(["control", "treatment"]), 0) for i in range(n)]
    out = [(f"u{rng.randrange(n)}", rng.choice(["revenue", "orders"]), float(rng.randint(1, 9)), rng.randint(0, 9)) for _ in range(500)]
    return b.exposures(spark, people), b.outcomes(spark, out), people, out


def test_ratio_equals_linearised_users(spark):
    exposures, outcomes, people, out = corpus(spark)
    got = ratios.ab_ratio(ratios.ratio_stats(outcomes, exposures, [ratios.RatioSpec("basket", "revenue", "orders"), ratios.RatioSpec("none", "revenue", "nothing")]))
    got = {r.metric_name: r for r in got.collect()}
    errors, share = [], {}
    for arm in ("control", "treatment"):
        ids = [u for u, v, _ in people if v == arm]
        x, y = (np.array([sum(o[2] for o in out if o[0] == u and o[1] == m) for u in ids]) for m in ("revenue", "orders"))
        share[arm] = x.sum() / y.sum()
        errors.append(((x - share[arm] * y) / y.mean()).var(ddof=1) / len(ids))
    r = got["basket"]
    assert abs(r.ratio_treatment - share["treatment"]) < 1e-12 and abs(r.se - math.sqrt(sum(errors))) < 1e-12
    assert got["none"].ratio_control is None and got["none"].p_value is None and got["none"].n_control == r.n_control


def test_segments_cover_all_users(spark, rows):
    exposures, outcomes, people, _ = corpus(spark)
    specs = [MetricSpec("revenue"), MetricSpec("orders", "max")]
    known = spark.createDataFrame(
        [("e1", u, "a" if i % 3 else "b", i % 4 or None) for i, (u, *_) in enumerate(people) if i % 5],
        "experiment_id string, user_id string, market string, tier int",
    )
    stats = segments.segment_stats(outcomes, exposures, known, ["market", "tier"], specs)
    found = [r for r in rows(segments.ab_segments(stats))]
    whole = {r["metric_name"]: r for r in rows(ab.ab_analysis(ab.user_arm_stats(outcomes, exposures, specs)))}
    for r in found:
        if r["segment"] == "all":
            assert all(abs(r[c] - whole[r["metric_name"]][c]) < 1e-9 for c in ("delta", "se", "p_value", "n_control"))
    for name in ("market", "tier"):
        held = [r for r in rows(stats) if r["segment"] == name and r["metric_name"] == "revenue"]
        assert sum(r["n"] for r in held) == len(people) and any(r["segment_value"] is None for r in held)
    some = [u for i, (u, *_) in enumerate(people) if i % 5 and not i % 3]
    alone = ab.ab_analysis(ab.user_arm_stats(outcomes, exposures.where(F.col("user_id").isin(some)), specs))
    one = next(r for r in rows(alone) if r["metric_name"] == "orders")
    two = next(r for r in found if r["segment_value"] == "b" and r["metric_name"] == "orders")
    assert all(abs(one[c] - two[c]) < 1e-9 for c in ("delta", "se", "mean_control"))


def test_sketches_shuffle_no_users(spark):
    out = b.outcomes(spark, [(f"u{i % 3000}", "m", 1.0, i % 7) for i in range(6000)] + [(None, "m", 1.0, None)])
    daily = sketches.daily_sketches(out)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(shuffled) == 1 and "user_id" not in shuffled[0]
    got = sketches.users_between(daily, "2026-01-01", "2026-01-07").first()
    assert got.rows == 6000 and abs(got.users - 3000) < 5 * sketches.error_of() * 3000
    assert sketches.united(daily.limit(0), ["metric_name"]).count() == 0


@pytest.mark.parametrize("name", ["first", "sum"])
def test_rollup_specs_are_known(name):
    from armlift.operators.rollup import _FROM_DAYS

    assert name in _FROM_DAYS and set(_FROM_DAYS) == set(grain._FROM_PARTS)
