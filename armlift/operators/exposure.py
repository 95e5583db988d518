"""Who is in which arm: assignment by hash and first-exposure deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from armlift.sources.contracts import ARMS
from armlift.sources.schemas import KEY

_DERIVED = ("variant", "exposure_ts", "unit")

# Stable 32-bit hash of (experiment, user) from md5, the same in any engine.
ASSIGNMENT_HASH = (
    "CAST(conv(substring(md5(concat(experiment_id, ':', user_id)), 1, 8), 16, 10) AS BIGINT)"
)


def assign_variants(
    users: DataFrame, exposure_rate: float = 0.85, treatment_share: float = 0.5
) -> DataFrame:
    """Exposed users with their arm and ``assignment_hash``.

    ``users`` has (experiment_id, user_id, ...); a user is exposed in an
    experiment at ``exposure_rate`` and treated at ``treatment_share``, both in
    steps of one percent.  Narrow: no shuffle, no state, repeatable.
    """
    exposed, treated = round(exposure_rate * 100), round(treatment_share * 100)
    # The one-element explode is a barrier: without it the filter is pushed
    # below the projection and the hash is computed twice per row.
    return (
        users.selectExpr("*", f"explode(array({ASSIGNMENT_HASH})) AS assignment_hash")
        .where(f"assignment_hash % 100 < {exposed}")
        .selectExpr(
            "*",
            f"if((assignment_hash DIV 100) % 100 < {treated}, 'treatment', 'control') AS variant",
        )
    )


def dedup_exposures(exposures: DataFrame) -> DataFrame:
    """One row per (experiment, user): the first exposure to a known arm wins.

    Rows without a key or under a label that is no arm take no part.  An unknown
    time sorts last, and equal times fall back to the variant name, so a rerun
    always gives the same row.  The state is one time and one flag per arm, which
    hash aggregation keeps in place and combines before the shuffle.
    """
    known = exposures.dropna(subset=KEY).where(F.col("variant").isin(*ARMS))
    first = {arm: f"min(exposure_ts) FILTER (WHERE variant = '{arm}')" for arm in ARMS}
    state = known.groupBy(*KEY).agg(
        *[F.expr(f"{first[arm]} AS _{arm}") for arm in ARMS],
        F.expr("bool_or(variant = 'control') AS _seen_control"),
        *([F.expr("bool_or(unit = 'user_id') AS _by_user")] if "unit" in exposures.columns else []),
        *[F.min(c).alias(c) for c in exposures.columns if c not in (*KEY, *_DERIVED)],
    )
    control_first = """
      CASE WHEN _control IS NOT NULL THEN _treatment IS NULL OR _control <= _treatment
           WHEN _treatment IS NOT NULL THEN false ELSE _seen_control END
    """
    derived = {
        "variant": f"if({control_first}, 'control', 'treatment') AS variant",
        "exposure_ts": "least(_control, _treatment) AS exposure_ts",
        "unit": "if(_by_user, 'user_id', NULL) AS unit",
    }
    return state.selectExpr(*[derived.get(c, f"`{c}`") for c in exposures.columns])
