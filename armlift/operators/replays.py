"""Outcomes that a log holds more than once because it, or a part of it, was written again.

Two cases.  A row with an ``event_id`` is one event however often it is logged.  Rows without one may
repeat for good reasons (two like purchases in one second), so a copy alone proves nothing; but where a
whole batch was logged r times, every row of it stands there r times as often as it happened.  A batch is
taken as replayed by the largest r that divides the multiplicities of all its rows, if it has at least
``LEAST`` different ones; each row then keeps its multiplicity divided by r.

Everything follows from multiplicities, counted by hash aggregation with a map-side combine: however many
copies a row has, one counter per task is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from armlift.sources.readers import EVENT_ID
from armlift.sources.schemas import KEY, OUTCOMES

#: Different rows a batch needs before their common factor counts as a replay.
LEAST = 20
#: The largest factor found; a batch logged more often keeps some copies.
MOST = 62
_NO_DAY = "DATE '0001-01-01'"
_ROW = [*KEY, "metric_name", "ts"]


def _event_id(outcomes: DataFrame) -> Column:
    return F.col(EVENT_ID) if EVENT_ID in outcomes.columns else F.lit(None).cast("string")


def multiplicities(outcomes: DataFrame, batch: Column | None = None) -> DataFrame:
    """One row per event, or per different row where there is no event id.

    ``copies`` is how often it was logged, ``value`` and ``other_value`` the least and greatest value
    logged for it, and ``batch`` the part of the log it belongs to: by default the day of ``ts``.
    """
    marked = outcomes.select(*_ROW, "value", _event_id(outcomes).alias(EVENT_ID)).withColumn(
        "_same", F.when(F.col(EVENT_ID).isNull(), F.col("value"))
    )
    counted = marked.groupBy(*_ROW, EVENT_ID, "_same").agg(
        F.count(F.lit(1)).alias("copies"), F.min("value").alias("value"), F.max("value").alias("other_value")
    )
    day = F.to_date("ts") if batch is None else batch
    return counted.drop("_same").withColumn("batch", F.coalesce(day, F.expr(_NO_DAY)))


def _divisors(copies: Column) -> Column:
    """The bits of all numbers up to ``MOST`` that divide ``copies``."""
    bit = lambda r: F.call_function("shiftleft", F.lit(1).cast("long"), r)
    many = F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST)),
        F.lit(0).cast("long"),
        lambda bits, r: F.when(copies % r == 0, bits.bitwiseOR(bit(r))).otherwise(bits),
    )
    return F.when(copies == 1, F.lit(2).cast("long")).otherwise(many)


def replayed_batches(counted: DataFrame, least: int = LEAST) -> DataFrame:
    """(experiment_id, batch, factor) of the batches logged ``factor`` times, from :func:`multiplicities`."""
    factor = F.length(F.bin("divisors")) - 1
    return (
        counted.where(F.col(EVENT_ID).isNull())
        .groupBy("experiment_id", "batch")
        .agg(F.bit_and(_divisors(F.col("copies"))).alias("divisors"), F.count(F.lit(1)).alias("_rows"))
        .select("experiment_id", "batch", F.when(F.col("_rows") >= least, factor).otherwise(1).alias("factor"))
        .where("factor > 1")
    )


def _kept(outcomes: DataFrame, least: int, batch: Column | None) -> DataFrame:
    counted = multiplicities(outcomes, batch)
    joined = counted.join(replayed_batches(counted, least), ["experiment_id", "batch"], "left")
    factor = F.coalesce("factor", F.lit(1))
    kept = F.when(F.col(EVENT_ID).isNotNull(), F.lit(1)).otherwise((F.col("copies") / factor).cast("int"))
    return joined.withColumn("factor", factor).withColumn("kept", kept)


def dedup_outcomes(outcomes: DataFrame, least: int = LEAST, batch: Column | None = None) -> DataFrame:
    """Outcomes as often as they happened, in canonical columns.

    An event logged with different values keeps the smallest.  Rows without an event id keep their
    repeats unless their batch was replayed.  A NULL in any column is a value like others here; an event
    without ``ts`` is told apart by its other columns.
    """
    kept = _kept(outcomes, least, batch)
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), "kept"))).select(*OUTCOMES)


def outcome_replays(outcomes: DataFrame, least: int = LEAST, batch: Column | None = None) -> DataFrame:
    """What :func:`dedup_outcomes` takes out, per experiment, metric and batch that has any.

    ``logged`` and ``kept`` rows, those ``dropped`` as copies of an event and as a batch's replay, the
    batch's ``factor``, and events that were logged with ``conflicting`` values.
    """
    is_event = F.col(EVENT_ID).isNotNull()
    gone = F.col("copies") - F.col("kept")
    return (
        _kept(outcomes, least, batch)
        .groupBy("experiment_id", "metric_name", F.expr(f"nullif(batch, {_NO_DAY})").alias("batch"))
        .agg(
            F.sum("copies").alias("logged"),
            F.sum("kept").cast("long").alias("kept"),
            F.sum(F.when(is_event, gone).otherwise(0)).alias("event_copies"),
            F.sum(F.when(is_event, F.lit(0)).otherwise(gone)).alias("replayed_rows"),
            F.max("factor").alias("factor"),
            F.count_if(is_event & (F.col("value") < F.col("other_value"))).alias("conflicting"),
        )
        .where("logged > kept")
    )
