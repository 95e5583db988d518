import math
import random

import numpy as np
import pyarrow as pa
import pytest

from armlift.llm import top_k, vectors

SCHEMA = "vec_id long, embedding array<float>, rank int, score long, part long"


def sound(rows, factor):
    """Distinct (id, whole-number vector, ...) of the rows that take part."""
    out = {}
    dims = max([len(r[1]) for r in rows if r[1] is not None], default=0)
    for r in rows:
        if r[0] is None or r[1] is None or any(x is None or not math.isfinite(x) for x in r[1]):
            continue
        v = tuple(math.floor(factor * float(np.float32(x))) for x in r[1])
        out[(r[0], v + (0,) * (dims - len(v)), *r[2:])] = True
    return list(out)


def brute(rows, k=20, every=20):
    found = sound([r[:2] for r in rows], 64)
    out = []
    for q, v in found:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in found if i != q)[:k]
            out += [(q, at + 1, i, -s) for at, (s, i) in enumerate(scored)]
    return sorted(out)


def answer(spark, rows, **args):
    full = [(*r, 1, 2, 3) for r in rows]
    return sorted(tuple(r) for r in top_k.top_k(spark.createDataFrame(full, SCHEMA), **args).collect())


def clustered(n, dims=8, seed=5, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    return [(i, (middle[i % centres] + 0.2 * rng.normal(size=dims)).tolist()) for i in range(n)]


def test_clustered_against_brute_force(spark, monkeypatch):
    """Many parts and chunks, so that floors and pruned parts count."""
    monkeypatch.setattr(vectors, "PART", 200)
    monkeypatch.setattr(vectors, "CHUNK", 7)
    monkeypatch.setattr(top_k, "BLOCK", 16)
    monkeypatch.setattr(vectors, "SPAN", 2)
    rows = clustered(900)
    assert answer(spark, rows, every=10) == brute(rows, every=10)
    assert answer(spark, rows, k=3, every=30) == brute(rows, 3, 30)


def test_faulty_rows_and_ties(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25]) for _ in range(4)]) for i in range(-40, 60)]
    rows += [(20, [0.5] * 4), (20, [0.5] * 4), (20, [0.25] * 4), (None, [1.0] * 4), (100, None), (101, []), (102, [0.5])]
    rows += [(103, [math.nan] * 4), (104, [math.inf, 0.0, 0.0, 0.0]), (105, [None, 1.0, 1.0, 1.0]), (120, [0.0] * 4)]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, []) == []
    assert answer(spark, [(20, [1.0])]) == []
    assert answer(spark, [(None, [1.0]), (3, None)]) == []


def test_a_third_of_the_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 100)
    rows = clustered(300, dims=5) + [(1000 + i, [0.5, 0.1, -0.3, 0.2, 0.0]) for i in range(150)]
    assert answer(spark, rows) == brute(rows)


def test_large_components(spark):
    """Beyond what floats hold exactly, and beyond a long, where scores count as its end."""
    rows = [(i, [1e6 * (i - 5), 3e5 + i, 1.0]) for i in range(25)]
    assert answer(spark, rows, every=5) == brute(rows, every=5)
    wide = [(i, [1e12 * (i + 1)] * 3) for i in range(21)]
    got = answer(spark, wide, every=20)
    assert [r[2] for r in got if r[0] == 0][:3] == [1, 2, 3] and all(r[3] == vectors.HIGH for r in got)


def test_only_what_may_count_is_visited():
    """Blocks whose bound is below the k-th score are not scored."""
    rng = np.random.default_rng(0)
    near, far = rng.integers(90, 100, (64, 4)), rng.integers(-100, -90, (64, 4))
    blocks = [(np.arange(64), None, near), (np.arange(64, 128), None, far)]
    seen = []

    class Watched(list):
        def __getitem__(self, at):
            seen.append(at)
            return list.__getitem__(self, at)

    ends = np.full((1, 1), vectors.HIGH)
    orders = [iter([(4 * 100 * 100, 0), (-4 * 90 * 90, 1)])]
    group, score, number = vectors.visit(
        Watched(blocks), orders, np.full((1, 4), 100), np.array([-1]), None, -ends, ends, 20, "any"
    )
    assert seen == [0] and len(score) == 20 and number.max() < 64


@pytest.mark.parametrize("values", [[], [0], [-128, 127], [128], [-(1 << 40)]])
def test_narrow_round_trip(values):
    raw, width = vectors.narrow(np.array(values, np.int64))
    assert vectors.widen(raw, width, 1).ravel().tolist() == values


def test_matrix():
    column = pa.chunked_array([pa.array([[1, 2], [3, 4]]), pa.array([[5, 6]])], pa.list_(pa.int64()))
    assert vectors.matrix(column, 2).tolist() == [[1, 2], [3, 4], [5, 6]]
