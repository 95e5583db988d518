import math

import numpy as np
from test_top_k import clustered, sound

from armlift.llm import hard_negatives, vectors

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, code long"


def brute(rows, every=50):
    moved = [(i, v, (label + 1) % 10 if i is not None and label is not None and i % 7 == 0 else label) for i, v, label in rows]
    found = sound([r for r in moved if r[2] is not None], 256)
    out = []
    for a, v, label in found:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, t) for i, w, t in found if i != a)
        for p, positive, _ in [s for s in scored if s[2] == label][:5]:
            held = [(-s, i) for s, i, t in scored if t != label and 50 * -p <= 100 * -s <= 95 * -p][:3]
            out += [(a, positive, at + 1, i, -p, s) for at, (s, i) in enumerate(held)]
    return sorted(out)


def answer(spark, rows, **args):
    full = [(*r, 1, 2) for r in rows]
    return sorted(tuple(r) for r in hard_negatives.mine(spark.createDataFrame(full, SCHEMA), **args).collect())


def labelled(n, **args):
    return [(i, v, i * 7 % 11 % 5) for i, v in clustered(n, **args)]


def test_clustered_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 150)
    monkeypatch.setattr(vectors, "CHUNK", 5)
    monkeypatch.setattr(hard_negatives, "CELL", 4)
    rows = labelled(700, dims=6)
    want = brute(rows, 20)
    assert answer(spark, rows, every=20) == want and len(want) > 300


def test_codebooks_of_a_sample_lose_nothing(spark):
    """The codebooks see few rows; radii are those of all, so results are exact."""
    rows = labelled(400) + [(5000 + i, [40.0 + i, -30.0] + [1.0] * 6, i % 3) for i in range(30)]
    assert answer(spark, rows, sample=20) == brute(rows)


def test_faulty_rows_and_ties(spark):
    rows = [(i, [float(i % 3), float(i % 2), 0.5], i % 4) for i in range(-50, 120)]
    rows += [(0, [1.0, 1.0, 1.0], 2), (0, [1.0, 1.0, 1.0], 2), (0, [1.0, 1.0, 1.0], 3), (50, [2.0, 0.0, 0.0], None)]
    rows += [(None, [1.0] * 3, 1), (150, None, 1), (200, [math.nan] * 3, 1), (250, [None, 1.0, 1.0], 1), (300, [1.0], 1)]
    rows += [(350, [], 1), (400, [math.inf, 0.0, 0.0], 1), (450, [-5.0, -5.0, 0.0], 7)]
    assert answer(spark, rows) == brute(rows)
    assert answer(spark, []) == []
    assert answer(spark, [(50, [1.0, 2.0], 1)]) == []


def test_a_third_of_the_rows_alike(spark, monkeypatch):
    monkeypatch.setattr(vectors, "PART", 100)
    rows = labelled(300, dims=5) + [(1000 + i, [0.5, 0.1, -0.3, 0.2, 0.0], i % 2) for i in range(150)]
    assert answer(spark, rows) == brute(rows)


def test_cells_come_by_falling_sum():
    first, second = [(9.0, 4), (5.0, 1), (1.0, 7)], [(3.0, 0), (2.5, 2), (-8.0, 1)]
    cells = {(4, 0): 10, (4, 1): 11, (1, 2): 12, (7, 0): 13, (7, 2): 14}
    got = list(hard_negatives.cells_by_bound(first, second, cells))
    assert got == [(12.0, 10), (7.5, 12), (4.0, 13), (3.5, 14), (1.0, 11)]
    assert list(hard_negatives.cells_by_bound([], second, cells)) == []


def test_bounds_hold():
    rng = np.random.default_rng(3)
    rows = rng.integers(-256, 257, (500, 10))
    books = hard_negatives.Codebooks(rows[:60].astype(float), 4)
    codes = hard_negatives.nearest(rows[:, :5], books.books[0]) * 4 + hard_negatives.nearest(rows[:, 5:], books.books[1])
    held = np.unique(codes)
    sides = (slice(None, 5), 0), (slice(5, None), 1)
    radii = np.array([
        [np.linalg.norm(rows[codes == c][:, s] - books.books[k][(c // 4, c % 4)[k]], axis=1).max() for s, k in sides] for c in held
    ])
    queries = rng.integers(-256, 257, (20, 10))
    (_, i, one), (_, j, two) = books.sides(held, radii, queries)
    for at, c in enumerate(held):
        assert (one[:, i[at]] + two[:, j[at]] >= (queries @ rows[codes == c].T).max(axis=1)).all()
