"""A/B results per segment of users, all segmentations in one pass.

Users are aggregated once, at the finest cell of all segment columns.  Coarser cells follow from merged
moments by grouping sets over that small table, so neither users nor outcomes are read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from armlift.operators.ab import ab_analysis, stats_items
from armlift.operators.grain import MEAN, VARIANCE, _MERGED_M2, user_columns
from armlift.sources.schemas import DEFAULT_METRICS, KEY, MetricSpec

CELL = ["experiment_id", "metric_name", "variant"]
ALL = "all"


def segment_stats(
    outcomes: DataFrame,
    exposures: DataFrame,
    segments: DataFrame,
    columns: Sequence[str],
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    unique: bool = False,
) -> DataFrame:
    """n, mean, var and std over users per cell, segment column and value, and over ``all`` users.

    ``segments`` has one row per (experiment_id, user_id) with the ``columns``.  A user without one, or
    with a NULL, is in the segment NULL: every segmentation covers all exposed users.
    """
    names = [f"m{i}" for i in range(len(specs))]
    users = user_columns(outcomes, exposures, specs, names, unique=unique)
    shown = [F.col(c).cast("string").alias(f"_s{i}") for i, c in enumerate(columns)]
    keys = [f"_s{i}" for i in range(len(columns))]
    users = users.join(segments.select(*KEY, *shown), KEY, "left")
    fine = users.groupBy("experiment_id", "variant", *keys).agg(F.array(*stats_items(specs, names)).alias("stats"))
    parts = fine.selectExpr("experiment_id", "variant", *keys, "inline(stats)").selectExpr(
        *CELL, *keys, "n", "mean * n AS total", "coalesce(var, 0D) * (n - 1) AS m2"
    ).where("n > 0")
    sets = [[F.col(c) for c in CELL], *[[F.col(c) for c in (*CELL, key)] for key in keys]]
    merged = parts.groupingSets(sets, *[F.col(c) for c in (*CELL, *keys)]).agg(
        F.sum("n").alias("_n"), F.sum("total").alias("_total"), F.expr(_MERGED_M2), *[F.grouping(k).alias(f"_g{k}") for k in keys]
    )
    merged = merged.withColumnsRenamed({"_n": "n", "_total": "total"})
    named, value = F.lit(ALL), F.lit(ALL)
    for key, column in zip(keys, columns):
        here = F.col(f"_g{key}") == 0
        named = F.when(here, F.lit(column)).otherwise(named)
        value = F.when(here, F.col(key)).otherwise(value)
    return merged.select(
        *CELL, named.alias("segment"), value.alias("segment_value"), "n",
        F.expr(f"{MEAN} AS mean"), F.expr(f"{VARIANCE} AS var"),
    ).withColumn("std", F.sqrt("var"))


def ab_segments(stats: DataFrame) -> DataFrame:
    """The A/B result of every segment and metric; a segment with one arm only has none."""
    return ab_analysis(stats, ("experiment_id", "segment", "segment_value", "metric_name"))
