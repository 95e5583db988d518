"""Least squares on long rows with errors clustered by user, solved inside the plan.

Rows are combined per user into the user's Gram matrix and cross products.  The coefficients follow from
their sums over users; a user's score is what is left of its cross products at the coefficients, so the
sandwich needs no second pass over the rows.  Systems have as many equations as the model has terms, and
are solved by elimination on arrays, scaled so that a term that others determine is told from a small one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from armlift.functions.normal import ci_95, two_sided_p
from armlift.operators.windows import fits_broadcast

#: A scaled pivot below this means that the other terms determine the term.
SINGULAR = 1e-10


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _square(flat: str, k: int) -> Column:
    """Rows of a symmetric matrix from its upper triangle."""
    at = {pair: n for n, pair in enumerate(_pairs(k))}
    return F.array(
        *[F.array(*[F.get(F.col(flat), at[min(i, j), max(i, j)]) for j in range(k)]) for i in range(k)]
    )


def inverse(matrix: str, k: int) -> Column:
    """Inverse of a symmetric matrix (rows of doubles) with a positive diagonal; NULLs if it is singular."""
    scale = [F.sqrt(F.get(F.get(F.col(matrix), i), i)) for i in range(k)]
    scaled = F.array(
        *[
            F.array(
                *[F.try_divide(F.get(F.get(F.col(matrix), i), j), scale[i] * scale[j]) for j in range(k)],
                *[F.lit(1.0 if i == j else 0.0) for j in range(k)],
            )
            for i in range(k)
        ]
    )

    def step(rows: Column, p: Column) -> Column:
        pivot_row = F.get(rows, p)
        pivot = F.get(pivot_row, p)
        pivot = F.when(F.abs(pivot) > SINGULAR, pivot)
        return F.transform(
            rows,
            lambda row, i: F.when(i == p, F.transform(row, lambda x: x / pivot)).otherwise(
                F.zip_with(row, pivot_row, lambda x, y: x - y * F.get(row, p) / pivot)
            ),
        )

    solved = F.aggregate(F.sequence(F.lit(0), F.lit(k - 1)), scaled, step)
    return F.transform(
        solved,
        lambda row, i: F.transform(
            F.slice(row, k + 1, k), lambda x, j: F.try_divide(x, F.get(F.array(*scale), i) * F.get(F.array(*scale), j))
        ),
    )


def _dot(row: Column, vector: Column) -> Column:
    return F.aggregate(F.zip_with(row, vector, lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)


def ols_clustered(
    rows: DataFrame,
    measure: str,
    terms: dict[str, Column],
    by: str = "experiment_id",
    cluster: str = "user_id",
) -> DataFrame:
    """Coefficients of ``measure`` on ``terms`` per ``by``, with errors clustered by ``cluster``.

    Any number of rows a cluster.  Rows with a NULL in the measure or any term are left out.  The sandwich
    has the usual small-sample factor G / (G - 1) x (N - 1) / (N - K).  Where the terms do not determine
    the coefficients, or there are no more than K rows or one cluster, they or their errors are NULL.
    """
    names, k = list(terms), len(terms)
    design = rows.select(
        F.col(by), F.col(cluster), F.col(measure).cast("double").alias("_y"),
        *[term.cast("double").alias(f"_x{i}") for i, term in enumerate(terms.values())],
    ).dropna(subset=["_y", *[f"_x{i}" for i in range(k)]])
    sums = {f"_g{n}": F.col(f"_x{i}") * F.col(f"_x{j}") for n, (i, j) in enumerate(_pairs(k))}
    sums |= {f"_b{i}": F.col(f"_x{i}") * F.col("_y") for i in range(k)}
    users = design.groupBy(by, cluster).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(value).alias(name) for name, value in sums.items()]
    )
    whole = users.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_clusters"), F.sum("_rows").alias("n_obs"), *[F.sum(name).alias(name) for name in sums]
    )
    gram = F.array(*[F.col(f"_g{n}") for n in range(len(_pairs(k)))])
    cross = F.array(*[F.col(f"_b{i}") for i in range(k)])
    fit = (
        whole.select(by, "n_clusters", "n_obs", gram.alias("_flat"), cross.alias("_cross"))
        .withColumn("_gram", _square("_flat", k))
        .withColumn("_inverse", inverse("_gram", k))
        .withColumn("_coef", F.transform("_inverse", lambda row: _dot(row, F.col("_cross"))))
        .select(F.col(by).alias("_by"), "n_clusters", "n_obs", "_inverse", "_coef")
    )
    fitted = users.select(by, gram.alias("_flat"), cross.alias("_cross")).join(
        F.broadcast(fit) if fits_broadcast(whole.select(F.col(by).cast("string").alias("experiment_id"))) else fit,
        F.col(by).eqNullSafe(F.col("_by")),
    )
    scored = fitted.withColumn("_gram", _square("_flat", k)).withColumn(
        "_score", F.zip_with("_cross", F.transform("_gram", lambda row: _dot(row, F.col("_coef"))), lambda b, a: b - a)
    )
    meat = [F.sum(F.get("_score", i) * F.get("_score", j)).alias(f"_m{n}") for n, (i, j) in enumerate(_pairs(k))]
    shared = [F.first(c).alias(c) for c in ("n_clusters", "n_obs", "_inverse", "_coef")]
    found = scored.groupBy(by).agg(*meat, *shared)
    found = found.withColumn("_meat_flat", F.array(*[F.col(f"_m{n}") for n in range(len(meat))])).withColumn(
        "_meat", _square("_meat_flat", k)
    )
    free = (F.col("n_obs") > k) & (F.col("n_clusters") > 1)
    g, n = F.col("n_clusters"), F.col("n_obs")
    factor = F.when(free, (g / (g - 1)) * ((n - 1) / (n - k)))
    def error(i: int) -> Column:
        """Standard error of one coefficient: its row of the inverse on both sides of the scores' products."""
        mine = F.get("_inverse", i)
        variance = factor * _dot(F.transform("_meat", lambda row: _dot(row, mine)), mine)
        return F.sqrt(F.when(variance < 0, 0.0).otherwise(variance))  # below zero by rounding only

    each = [
        F.struct(F.lit(name).alias("term"), F.get("_coef", i).alias("coef"), error(i).alias("se"))
        for i, name in enumerate(names)
    ]
    return (
        found.select(by, "n_obs", "n_clusters", F.inline(F.array(*each)))
        .selectExpr("*", "try_divide(coef, se) AS z")
        .selectExpr("*", f"{two_sided_p('z')} AS p_value", *ci_95("coef", "se"))
    )


def did_clustered_long(rows: DataFrame) -> DataFrame:
    """``measure ~ group * period`` on long rows (group, period, measure) of any number a user and period.

    The panel may be unbalanced: users may miss a period or have many rows in it.  With one row each it
    is the closed form of :func:`armlift.operators.did.did_clustered`.
    """
    terms = {
        "Intercept": F.lit(1.0),
        "group": F.col("group"),
        "period": F.col("period"),
        "group:period": F.col("group") * F.col("period"),
    }
    return ols_clustered(rows, "measure", terms)


def did_rows(outcomes: DataFrame, exposures: DataFrame, pre: str, post: str) -> DataFrame:
    """Outcome rows of exposed users as (experiment_id, user_id, group, period, measure).

    ``exposures`` holds one row per user; rows of ``pre`` are period 0 and those of ``post`` period 1.
    """
    listed = outcomes.where(F.col("metric_name").isin(pre, post))
    return listed.join(exposures.select("experiment_id", "user_id", "variant"), ["experiment_id", "user_id"]).select(
        "experiment_id",
        "user_id",
        F.when(F.col("variant") == "treatment", 1).otherwise(0).alias("group"),
        F.when(F.col("metric_name") == post, 1).otherwise(0).alias("period"),
        F.col("value").alias("measure"),
    )
