"""Late data: metric tables corrected from the changed days alone.

Every batch of outcomes leaves its own moments per experiment, day, arm and metric.  Moments merge, so a
day's are those of its batches; the outcomes of earlier batches are never read again.  A batch that is
sent again replaces what it left before, days it no longer has included.  Only partitions of days that a
batch has or had are read and written.

    absorb(spark, root, "2026-03-01", outcomes, exposures, registry)
    daily(spark, root), overall(spark, root)

A user's exposure has to be known when the outcomes arrive; exposures that come later change users of every
day, so their experiments are computed anew by :func:`armlift.plans.experiment.run`, as are results on
users.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from armlift.operators import metrics
from armlift.operators.grain import merge_moments
from armlift.operators.metrics import CELL
from armlift.operators.windows import fits_broadcast
from armlift.sources import tables
from armlift.sources.schemas import DEFAULT_METRICS, MetricSpec

PARTS, MOMENTS, PENDING = "metric_parts", "metric_moments", "metric_pending"
_STATE = "variant string, metric_name string, day date, rows bigint, n bigint, total double, m2 double, lowest double, highest double"
#: Partition columns; ``span`` is the day, month or year as text, for undated rows ``UNDATED``.
PLACE = ["experiment_id", "span"]
_PLACE = "experiment_id string, span string"
UNDATED = "undated"
_SPANS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def _read(spark: SparkSession, path: str, layout: str) -> DataFrame:
    if not tables.has_partitions(spark, path):
        return spark.createDataFrame([], layout)
    return spark.read.schema(layout).parquet(path)


def _write(df: DataFrame, path: str, *keys: str) -> None:
    writer = df.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def _parts(spark: SparkSession, root: str) -> DataFrame:
    return _read(spark, f"{root}/{PARTS}", f"{_STATE}, {_PLACE}, batch string")


def moments(spark: SparkSession, root: str) -> DataFrame:
    """Moments of all batches per experiment, arm, metric and day."""
    return _read(spark, f"{root}/{MOMENTS}", f"{_STATE}, {_PLACE}").drop("span")


def daily(spark: SparkSession, root: str) -> DataFrame:
    """The daily metric table of everything absorbed so far."""
    return metrics.daily_table(moments(spark, root))


def overall(spark: SparkSession, root: str) -> DataFrame:
    """The overall metric table of everything absorbed so far."""
    return metrics.overall_table(moments(spark, root))


def absorb(
    spark: SparkSession,
    root: str,
    batch: str,
    outcomes: DataFrame,
    exposures: DataFrame,
    registry: DataFrame,
    specs: Sequence[MetricSpec] = DEFAULT_METRICS,
    unique: bool = True,
    span: str = "day",
) -> None:
    """Take in a batch of canonical outcomes, or take it in again, and correct the days it touches.

    ``unique`` states that exposures hold one row per user.  ``span`` is what a partition holds, a ``day``
    or, for experiments of years, a ``month`` or ``year``; it is the same for all batches of a root.  What a failed call has begun is finished by
    the next one for the batch: the changed days are noted before anything is replaced.
    """
    new = metrics.daily_moments(outcomes, exposures, registry, specs, unique)
    new = new.where("experiment_id IS NOT NULL").withColumns(
        {"span": F.coalesce(F.date_format("day", _SPANS[span]), F.lit(UNDATED)), "batch": F.lit(batch)}
    )
    staged = tables.beside(f"{root}/{PARTS}")
    _write(new, staged, *PLACE, "batch")
    layout = f"{_STATE}, {_PLACE}, batch string"
    pending = f"{root}/{PENDING}/batch={tables.escaped(spark, batch)}"
    try:
        arrived = _read(spark, staged, layout)
        before = _parts(spark, root).where(F.col("batch") == batch)
        changed = arrived.select(*PLACE).unionByName(before.select(*PLACE))
        if tables.exists(spark, pending):
            changed = changed.unionByName(spark.read.parquet(pending).select(*PLACE))
        # The flag is a selective filter, by which partitions of other days are pruned in the join below.
        noted = tables.beside(f"{root}/{PENDING}")
        changed.distinct().withColumn("changed", F.lit(1)).write.parquet(noted)
        tables.move(spark, noted, pending)
        tables.drop_matching(spark, f"{root}/{PARTS}/*/*/batch={tables.escaped(spark, batch)}")
        if tables.has_partitions(spark, staged):
            _write(_read(spark, staged, layout), f"{root}/{PARTS}", *PLACE, "batch")
        refresh(spark, root, spark.read.parquet(pending))
        tables.drop_path(spark, pending)
    finally:
        tables.drop_path(spark, staged)


def touched_parts(spark: SparkSession, root: str, changed: DataFrame) -> DataFrame:
    """The moments all batches left for the changed days; other days' partitions are not read."""
    marked = changed.where("changed = 1").select(*PLACE)
    marked = F.broadcast(marked) if fits_broadcast(marked) else marked
    return _parts(spark, root).join(marked, PLACE)


def refresh(spark: SparkSession, root: str, changed: DataFrame) -> None:
    """Merge the batches of the changed days again; a day that no batch has any more is dropped."""
    merged = merge_moments(touched_parts(spark, root, changed), *CELL, "day", "span")
    staged = tables.beside(f"{root}/{MOMENTS}")
    _write(merged, staged, *PLACE)
    try:
        held = _read(spark, staged, f"{_STATE}, {_PLACE}").select(*PLACE).distinct()
        gone = changed.select(*PLACE).join(held, PLACE, "left_anti").collect()  # days a batch lost, of all it had
        tables.replace_folders(spark, staged, f"{root}/{MOMENTS}", 2)
        for row in gone:
            folder = "/".join(f"{c}={tables.escaped(spark, row[c])}" for c in PLACE)
            tables.drop_path(spark, f"{root}/{MOMENTS}/{folder}")
    finally:
        tables.drop_path(spark, staged)
    spark.catalog.refreshByPath(f"{root}/{MOMENTS}")
