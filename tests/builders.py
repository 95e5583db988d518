"""Small frames for tests."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2026, 1, 1)
END = datetime(2026, 1, 15)


def day(n: float) -> datetime:
    return START + timedelta(days=n)


def exposures(spark, rows):
    """rows: (user, variant, day) or (user, variant, day, experiment)."""
    full = [((r[3] if len(r) > 3 else "e1"), r[0], r[1], None if r[2] is None else day(r[2]), "user_id") for r in rows]
    return spark.createDataFrame(
        full, "experiment_id string, user_id string, variant string, exposure_ts timestamp, unit string"
    )


def outcomes(spark, rows):
    """rows: (user, metric, value, day) or with an experiment at the end."""
    full = [((r[4] if len(r) > 4 else "e1"), r[0], r[1], r[2], None if r[3] is None else day(r[3])) for r in rows]
    return spark.createDataFrame(
        full, "experiment_id string, user_id string, metric_name string, value double, ts timestamp"
    )


def registry(spark, rows=(("e1", START, END),)):
    full = [(e, e, a, b, "me", ["control", "treatment"], ["conversion"], ["revenue"], None) for e, a, b in rows]
    return spark.createDataFrame(
        full,
        "experiment_id string, name string, start_ts timestamp, end_ts timestamp, owner string,"
        " variants array<string>, primary_metrics array<string>, guardrail_metrics array<string>, notes string",
    )


def arm_stats(spark, rows):
    """rows: (metric, variant, n, mean, var)."""
    full = [("e1", m, v, n, float(mean), None if var is None else float(var)) for m, v, n, mean, var in rows]
    df = spark.createDataFrame(
        full, "experiment_id string, metric_name string, variant string, n bigint, mean double, var double"
    )
    return df.selectExpr("*", "sqrt(var) AS std")


def users(spark, rows):
    """rows: (user, variant, x, y)."""
    full = [("e1", u, v, float(x), float(y)) for u, v, x, y in rows]
    return spark.createDataFrame(
        full, "experiment_id string, user_id string, variant string, x double, y double"
    )


def random_users(seed: int, n: int = 80, correlated: bool = True):
    """(user, variant, x, y) rows with related pre and post values."""
    import numpy as np

    rng = np.random.default_rng(seed)
    x = rng.normal(10, 3, n)
    noise = rng.normal(0, 2, n)
    y = (0.7 * x if correlated else 5.0) + noise
    variant = ["treatment" if rng.random() < 0.45 else "control" for _ in range(n)]
    return [(f"u{i}", v, x[i], y[i] + (v == "treatment")) for i, v in enumerate(variant)]
