"""The one roll-up and the late batches give what the outcomes themselves give."""

import glob
import random

import pytest

import builders as b
from armlift.operators import event_study, metrics, pretrend, rollup
from armlift.operators.grain import user_columns
from armlift.plans import experiment, late
from armlift.sources.schemas import MetricSpec

SPECS = (
    MetricSpec("conversion", "max", "post"), MetricSpec("revenue", "sum", "post"), MetricSpec("pre_revenue", "sum", "pre"),
    MetricSpec("speed", "mean"), MetricSpec("low", "min"), MetricSpec("start", "first", "any"),
)


def corpus(spark, seed=3, n=40):
    rng = random.Random(seed)
    people = [(f"u{i}", rng.choice(["control", "treatment"]), rng.randint(0, 5), e) for e in ("e1", "e2") for i in range(n)]
    names = [s.name for s in SPECS] + ["other"]
    out = [
        (f"u{rng.randrange(n + 10)}", rng.choice(names), rng.choice([None, float(rng.randint(0, 9))]),
         rng.choice([None, rng.uniform(-9, 25), rng.randint(-9, 25)]), rng.choice(["e1", "e2", "e3"]))
        for _ in range(1500)
    ]
    registry = b.registry(spark, [("e1", b.START, b.END), ("e2", b.day(2), None)])
    return b.exposures(spark, people), b.outcomes(spark, out), registry


def same(rows, left, right):
    shown = lambda df: [
        {k: round(v, 9) if isinstance(v, float) else v for k, v in r.items()} for r in rows(df.select(*sorted(left.columns)))
    ]
    assert shown(left) == shown(right) and shown(left)


def test_every_table_follows_from_the_rollup(spark, rows):
    exposures, outcomes, registry = corpus(spark)
    days = rollup.user_days(outcomes, exposures, registry, SPECS, ("week", 2, 3)).cache()
    names = [f"m{i}" for i in range(len(SPECS))]
    same(rows, rollup.user_values(days, exposures, SPECS, names), user_columns(outcomes, exposures, SPECS, names))
    same(rows, rollup.daily_moments(days, SPECS), metrics.daily_moments(outcomes, exposures, registry, SPECS))
    same(rows, rollup.pretrend_daily(days), pretrend.pretrend_daily(outcomes, exposures))
    same(
        rows,
        rollup.user_bucket_mean(days, registry, "revenue", "week"),
        event_study.user_bucket_mean(outcomes, exposures, registry, "revenue", "week", 2, 3),
    )
    from armlift.operators.ab import other_arm_stats

    same(rows, other_arm_stats(rollup.totals(days), exposures, SPECS), other_arm_stats(outcomes, exposures, SPECS))
    days.unpersist()


def test_outcomes_are_read_and_exchanged_once(spark, tmp_path):
    exposures, outcomes, registry = corpus(spark)
    for name, df in (("exposures", exposures), ("outcomes", outcomes), ("user_days", None)):
        if df is not None:
            df.write.parquet(str(tmp_path / name))
    read = lambda name: spark.read.parquet(str(tmp_path / name))
    inputs = experiment.Inputs(read("exposures"), read("outcomes"), registry, unique=True)
    days = rollup.user_days(inputs.outcomes, inputs.exposures, registry, SPECS[:3], ("day", 3, 3), unique=True)
    plan = days._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "value#" in line]
    assert len(scans) == 1 and any("/outcomes/" in f for f in days.inputFiles())
    scan = scans[0]
    between = [i for i, line in enumerate(lines[:scan]) if "Exchange hashpartitioning" in line][-1]
    assert any("HashAggregate" in line and "partial" in line for line in lines[between:scan])  # combined before it
    days.write.parquet(str(tmp_path / "user_days"))
    for name, df in experiment.shared_tables(inputs, read("user_days"), SPECS[:3]).items():
        assert not any("/outcomes/" in f for f in df.inputFiles()), name
    cells = experiment.event_cells(inputs, read("user_days"))
    assert not any("/outcomes/" in f for f in cells.inputFiles())


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "late")


def test_late_batches_equal_one(spark, rows, root):
    exposures, outcomes, registry = corpus(spark)
    parts = outcomes.randomSplit([0.6, 0.2, 0.2], 5)
    full = metrics.metric_daily(outcomes, exposures, registry, SPECS)
    for batch, part in zip(("a", "b/2", "c"), parts):
        late.absorb(spark, root, batch, part.withColumn("value", part.value + 1), exposures, registry, SPECS)
        late.absorb(spark, root, batch, part, exposures, registry, SPECS)
    same(rows, late.daily(spark, root), full)
    same(rows, late.overall(spark, root), metrics.metric_overall(outcomes, exposures, registry, SPECS))
    late.absorb(spark, root, "c", parts[2].limit(0), exposures, registry, SPECS)  # the batch is withdrawn
    first_two = parts[0].unionByName(parts[1])
    same(rows, late.daily(spark, root), metrics.metric_daily(first_two, exposures, registry, SPECS))
    for batch in ("a", "b/2"):
        late.absorb(spark, root, batch, outcomes.limit(0), exposures, registry, SPECS)
    assert late.daily(spark, root).count() == 0


def test_only_changed_days_are_read(spark, root):
    """Files of other days may be unreadable: a late batch does not touch them."""
    exposures, outcomes, registry = corpus(spark)
    late.absorb(spark, root, "a", outcomes.where("ts IS NOT NULL"), exposures, registry, SPECS)
    day = b.day(3)
    one = b.outcomes(spark, [("u1", "revenue", 5.0, 3.5, "e1"), ("u2", "pre_revenue", 5.0, 3.25, "e1")])
    untouched = [f for f in glob.glob(f"{root}/{late.PARTS}/*/*/*/*.parquet") if f"span={day.date()}" not in f or "experiment_id=e1/" not in f]
    assert len(untouched) > 20
    before = {f: open(f, "rb").read() for f in untouched}
    for f in untouched:
        open(f, "wb").write(b"not parquet")
    spark.catalog.clearCache()
    late.absorb(spark, root, "b", one, exposures, registry, SPECS)
    for f, content in before.items():
        open(f, "wb").write(content)
    spark.catalog.refreshByPath(root)
    got = late.daily(spark, root).where(f"experiment_id = 'e1' AND day = '{day.date()}'").agg({"n": "sum"}).first()[0]
    whole = outcomes.where("ts IS NOT NULL").unionByName(one)
    want = metrics.metric_daily(whole, exposures, registry, SPECS)
    assert got == want.where(f"experiment_id = 'e1' AND day = '{day.date()}'").agg({"n": "sum"}).first()[0]


def test_a_failed_call_is_finished_by_the_next(spark, rows, root, monkeypatch):
    exposures, outcomes, registry = corpus(spark)
    early, rest = outcomes.randomSplit([0.7, 0.3], 2)
    late.absorb(spark, root, "a", early, exposures, registry, SPECS)
    late.absorb(spark, root, "b", rest, exposures, registry, SPECS)
    refresh = late.refresh
    monkeypatch.setattr(late, "refresh", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        late.absorb(spark, root, "b", rest.limit(0), exposures, registry, SPECS)
    monkeypatch.setattr(late, "refresh", refresh)
    late.absorb(spark, root, "b", rest.limit(0), exposures, registry, SPECS)
    same(rows, late.daily(spark, root), metrics.metric_daily(early, exposures, registry, SPECS))
