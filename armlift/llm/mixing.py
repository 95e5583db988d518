"""Mixing sources by temperature, realised as budgeted permutations of blocks.

The weight of a source is its share of tokens to a power: 1 keeps the shares, 0 makes all sources
equal.  The power is bisected until the weights' entropy, or the most passes any source is given,
meets its target.  A source's budget is its weight of the total; it is spent on whole passes over the
source and one partial pass.  Each pass visits the source's blocks in an order of its own, given by a
keyed hash, and the partial pass ends at the block where the budget is spent.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from armlift.llm.common import small, stored

#: Blocks a source is dealt into; a budget is met to within one of them.
BLOCKS = 1024
STEPS = 100
HASH_BITS = 60
SALTS = 64


class Target(NamedTuple):
    """What the power is bisected for; one of the two.

    ``entropy``: of the weights, as a share of the greatest possible (0 to 1).
    ``passes``: the most any source is repeated when every source is used at least once.
    """

    entropy: float | None = None
    passes: float | None = None


def words_in(text: Column) -> Column:
    """Tokens of a text for shares and budgets: its words."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _source(column: Column) -> Column:
    """A key that tells a NULL source from the empty one."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _moments(sources: DataFrame, power: float) -> tuple[float, float]:
    """Sum of share^power, and of share^power * ln(share), over all sources."""
    raised = F.pow(F.col("share"), F.lit(power))
    row = sources.agg(F.sum(raised), F.sum(raised * F.ln("share"))).first()
    return row[0], row[1]


def power_for(sources: DataFrame, target: Target) -> float:
    """The largest power in 0 to 1 at which the target is met; 0 if none meets it.

    Entropy falls and passes grow with the distance from one side, so each step halves an interval.
    Passes need the extreme shares only.  Entropy sums over the sources where they are: a step sends
    two numbers to the driver.
    """
    row = sources.agg(F.count("*"), F.min("share"), F.max("share")).first()
    count, least, most = row
    if count < 2 or least == most:
        return 1.0

    def meets(power: float) -> bool:
        if target.passes is not None:
            return (most / least) ** (1 - power) <= target.passes
        norm, log = _moments(sources, power)
        return math.log(norm) - power * log / norm >= target.entropy * math.log(count)

    if target.passes is not None:  # fewer passes towards the shares themselves
        low, high = 0.0, 1.0
        if meets(0.0):
            return 0.0
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (low, middle) if meets(middle) else (middle, high)
        return high
    if meets(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(40):
        middle = (low + high) / 2
        low, high = (middle, high) if meets(middle) else (low, middle)
    return low


def budgets(totals: DataFrame, target: Target, total_tokens: int | None = None) -> DataFrame:
    """``_source``, ``tokens``, ``weight``, ``budget`` (tokens to draw) of every source.

    Without ``total_tokens`` the total is the least at which every source is used in full once.
    """
    whole = totals.agg(F.sum("tokens")).first()[0] or 0
    sources = totals.withColumn("share", F.col("tokens") / F.lit(float(whole or 1)))
    power = power_for(sources, target)
    raised = F.pow(F.col("share"), F.lit(power))
    norm, cover = sources.agg(F.sum(raised), F.max(F.col("share") / raised)).first()
    drawn = float(total_tokens) if total_tokens is not None else float(whole) * (cover or 0.0) * (norm or 0.0)
    weighted = sources.withColumn("weight", raised / F.lit(norm or 1.0))
    budget = F.round(F.col("weight") * F.lit(drawn)).cast("long")
    if total_tokens is None:
        budget = F.greatest(budget, F.col("tokens"))  # rounding never cuts a full pass
    return weighted.select("_source", "tokens", "weight", budget.alias("budget"), F.lit(power).alias("power"))


def _order(seed: int, *keys: Column) -> Column:
    """A hash of ``HASH_BITS`` bits, the place in a keyed permutation; the same in any SQL engine."""
    text = F.concat_ws(":", F.lit(str(seed)), *(k.cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def _cuts(mass: DataFrame, budget: DataFrame, seed: int) -> DataFrame:
    """``_source``, ``weight``, ``passes`` (whole), ``cut``: the last block hash in the partial pass.

    A source's blocks are at most ``BLOCKS`` rows.  The partial pass takes blocks while less than the
    rest of the budget is drawn, the last one only if that comes nearer to the budget.
    """
    whole = (F.col("budget") / F.col("tokens")).cast("long")
    plan = budget.select("*", whole.alias("passes"), (F.col("budget") - whole * F.col("tokens")).alias("rest"))
    placed = mass.join(plan, "_source").withColumn("place", _order(seed, F.col("_source"), F.col("passes"), F.col("_block")))
    before = Window.partitionBy("_source").orderBy("place", "_block").rowsBetween(Window.unboundedPreceding, -1)
    drawn = placed.withColumn("before", F.coalesce(F.sum("_mass").over(before), F.lit(0)))
    taken = (F.col("rest") - F.col("before")) * 2 > F.col("_mass")
    return drawn.groupBy("_source").agg(
        F.first("weight").alias("weight"),
        F.first("passes").alias("passes"),
        F.coalesce(F.max(F.when(taken, F.col("place"))), F.lit(-1)).alias("cut"),
    )


def _drawn(rows: DataFrame, target: Target, total_tokens: int | None, seed: int) -> DataFrame:
    """``rows`` (with ``_id``, ``_source``, ``_tokens``) once per pass that draws them."""
    keyed = rows.withColumn("_block", F.pmod(_order(seed, F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit("block")), F.lit(BLOCKS)))
    mass = stored(keyed.groupBy("_source", "_block").agg(F.sum("_tokens").alias("_mass")), "mix-mass")
    totals = mass.groupBy("_source").agg(F.sum("_mass").alias("tokens")).where("tokens > 0")
    plan = stored(_cuts(mass, budgets(totals, target, total_tokens), seed), "mix-plan")
    narrow = small(plan)
    if narrow is plan:  # too many sources to broadcast: deal each over salts
        salted = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("_salt", F.pmod(F.xxhash64("_id", "_tokens"), F.lit(SALTS)).cast("int")).join(
            salted, ["_source", "_salt"]
        )
    else:
        joined = keyed.join(narrow, "_source")
    last = _order(seed, F.col("_source"), F.col("passes"), F.col("_block")) <= F.col("cut")
    times = F.col("passes") + last.cast("long")
    return (
        joined.where(times > 0)
        .withColumn("_pass", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
        .withColumn("_place", _order(seed, F.col("_source"), F.col("_pass"), F.col("_block")) / F.lit(float(1 << HASH_BITS)))
    )


def draw(docs: DataFrame, target: Target, total_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """``doc_id``, ``source``, ``n_tokens``, ``weight``, ``pass``, ``block``, ``slot`` of every draw.

    ``slot`` orders the mixture: a source's draws are spread evenly over 0 to 1, pass by pass and block
    by block.  A NULL source is a source of its own.  A NULL or empty text has no tokens and is drawn
    with its block; a source without any tokens has no weight and is not drawn.  Documents of NULL or
    equal id share a block and are drawn alike.  An empty table gives none, further columns are
    ignored.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("_id"),
        F.col("source").alias("_name"),
        _source(F.col("source")).alias("_source"),
        words_in(F.coalesce("text", F.lit(""))).alias("_tokens"),
    )
    drawn = _drawn(rows, target, total_tokens, seed)
    slot = (F.col("_pass") + F.col("_place")) / (F.col("passes") + (F.col("cut") >= 0).cast("int"))
    return drawn.select(
        F.col("_id").alias("doc_id"),
        F.col("_name").alias("source"),
        F.col("_tokens").alias("n_tokens"),
        "weight",
        F.col("_pass").alias("pass"),
        F.col("_block").cast("long").alias("block"),
        slot.alias("slot"),
    )


def mixed(docs: DataFrame, target: Target, total_tokens: int | None = None, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``draw`` draws it."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        _source(F.col("source")).alias("_source"),
        words_in(text).alias("_tokens"),
    )
    return _drawn(rows, target, total_tokens, seed).select("_row.*")
