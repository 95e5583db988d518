import math
from collections import Counter

import pytest

from armlift.llm import mixing
from armlift.llm.mixing import Target

SCHEMA = "doc_id long, text string, source string, weight int, _pass string"


def corpus():
    rows, doc = [], 0
    for source, n in (("hot", 900), ("mid", 300), ("", 90), (None, 90), ("none", 0)):
        for _ in range(n):
            rows.append((doc, "w " * (doc % 13), source, 1, "x"))
            doc += 1
    return rows + [(doc, None, "none", 2, "y"), (None, "a b c", "mid", 3, "z"), (5, "a b c", "mid", 3, "z"), (5, "a b c", "mid", 3, "z")]


def tokens(rows):
    total = Counter()
    for r in rows:
        total[r[2]] += len((r[1] or "").split())
    return total


def test_passes(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = mixing.draw(docs, Target(passes=3.0)).collect()
    total, drawn, weight = tokens(rows), Counter(), {}
    for r in got:
        drawn[r.source] += r.n_tokens
        weight[r.source] = r.weight
        assert 0 <= r.slot <= 1 and 0 <= r.block < mixing.BLOCKS
    assert set(drawn) == {"hot", "mid", "", None}
    assert drawn["hot"] == total["hot"]
    assert abs(drawn[""] / total[""] - 3) < 0.1 and abs(drawn[None] / total[None] - 3) < 0.1
    assert math.isclose(sum(weight.values()), 1)
    budget = {s: weight[s] / weight["hot"] * total["hot"] for s in weight}
    block = max(Counter((r.source, r.block) for r in got).values()) * 13
    assert all(abs(drawn[s] - budget[s]) <= block for s in budget)
    first = Counter((r.doc_id, r.source) for r in got if r["pass"] == 0)
    assert first == Counter((r[0], r[2]) for r in rows if total[r[2]])
    assert {r.block for r in got if r.doc_id == 5} == {next(r.block for r in got if r.doc_id == 5)}


@pytest.mark.parametrize("target", [0.8, 0.95, 1.0])
def test_entropy_and_budget(spark, target):
    rows = corpus()
    got = mixing.draw(spark.createDataFrame(rows, SCHEMA), Target(entropy=target), total_tokens=4000).collect()
    weight = {r.source: r.weight for r in got}
    entropy = -sum(w * math.log(w) for w in weight.values())
    assert entropy >= target * math.log(4) - 1e-6
    share = {s: n / sum(tokens(rows).values()) for s, n in tokens(rows).items() if n}
    natural = -sum(w * math.log(w) for w in share.values())
    if natural < target * math.log(4):
        assert entropy <= target * math.log(4) + 1e-6
    assert abs(sum(r.n_tokens for r in got) - 4000) < 4 * 40


def test_permutations_differ_by_pass_and_seed(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    order = lambda rows, n: [r.block for r in sorted(rows, key=lambda r: r.slot) if r.source == "" and r["pass"] == n]
    one, two = (mixing.draw(docs, Target(passes=3.0), seed=s).collect() for s in (1, 2))
    assert order(one, 0) != order(one, 1) and sorted(order(one, 0)) == sorted(order(one, 1))
    assert order(one, 0) != order(two, 0)


def test_rows_salted_join_and_empty(spark, monkeypatch):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    want = Counter((r.doc_id, r.source) for r in mixing.draw(docs, Target(passes=2.0)).collect())
    kept = mixing.mixed(docs, Target(passes=2.0))
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.source) for r in kept.collect()) == want
    monkeypatch.setattr(mixing, "small", lambda df: df)
    assert Counter((r.doc_id, r.source) for r in mixing.draw(docs, Target(passes=2.0)).collect()) == want
    assert mixing.draw(docs.limit(0), Target(passes=2.0)).count() == 0
    assert mixing.draw(docs.limit(0), Target(entropy=0.9), total_tokens=10).count() == 0
