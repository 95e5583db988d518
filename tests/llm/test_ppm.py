import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from armlift.llm import ppm

SCHEMA = "doc_id long, text string, block int, score double"


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


class Model:
    """The predictor as defined: symbol by symbol, escapes and exclusions carried along."""

    def __init__(self, texts):
        self.counts = defaultdict(Counter)
        for text in texts:
            data = bytes([ppm.START]) * ppm.ORDER + low(text).encode() + bytes([ppm.END])
            for i in range(ppm.ORDER, len(data)):
                for k in range(ppm.ORDER + 1):
                    self.counts[data[i - k : i]][data[i]] += 1

    def p(self, context, symbol):
        paid, excluded = 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            seen = {s: n for s, n in self.counts[context[len(context) - k :]].items() if s not in excluded}
            total, kinds = sum(seen.values()), len(seen)
            if symbol in seen:
                return paid * seen[symbol] / (total + kinds)
            if kinds:
                paid *= kinds / (total + kinds)
            excluded |= set(seen)
        return paid / (ppm.ALPHABET - len(excluded))

    def score(self, text):
        data = bytes([ppm.START]) * ppm.ORDER + low(text).encode() + bytes([ppm.END])
        return sum(math.log10(self.p(data[i - ppm.ORDER : i], data[i])) for i in range(ppm.ORDER, len(data)))


def corpus():
    rng = random.Random(2)
    words = ["the", "Then", "thing", "other", "\u00e9t\u00e9", "a", "zz"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) + rng.choice([".", "\n", ""]), 0, 0.0) for i in range(80)]
    return rows + [(100, None, 1, 1.0), (101, "", 1, 1.0), (None, "no id the", 2, 1.0), (7, "twice the", 2, 0.0), (7, "twice the", 2, 0.0),
                   (102, "\u6f22\u5b57 qqq Q", 0, 0.0), (103, "x" * 3000, 0, 0.0)]


@pytest.mark.parametrize("size", [400, 1 << 25])
def test_against_the_definition(spark, monkeypatch, size):
    monkeypatch.setattr(ppm, "BLOCK_CHARACTERS", size)
    rows = corpus()
    held = [r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 2 for r in rows]
    assert any(held)
    model = Model([r[1] for r, h in zip(rows, held) if not h])
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", low(r[1])), None] for r in rows]
    c = Counter(t for ts, h in zip(tokens, held) if not h for t in ts)
    n, v = sum(c.values()), len(c)
    got = ppm.score(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows) and {r.train_tokens for r in got} == {n}
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    want = sorted(
        (
            (r[0], h, len(ts), sum(c[t] > 0 for t in ts), sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts), model.score(r[1]))
            for r, h, ts in zip(rows, held, tokens)
        ),
        key=key,
    )
    for mine, theirs in zip(sorted(map(tuple, got), key=key), want):
        assert mine[:4] == theirs[:4]
        assert math.isclose(mine[4], theirs[4], rel_tol=1e-9) and math.isclose(mine[5], theirs[5], rel_tol=1e-9)
    assert abs(sum(model.p(b"the ", s) for s in range(256)) - 1) < 1e-9


def test_nothing_learnt_and_empty(spark):
    docs = spark.createDataFrame([(d, "only held out") for d in range(200) if zlib.crc32(str(d).encode()) % 7 == 2][:2], "doc_id long, text string")
    for r in ppm.score(docs).collect():
        assert r.held_out and r.n_known == 0 and r.train_tokens == 0
        assert math.isclose(r.score, 14 * math.log10(1 / 256)) and math.isclose(r.base_score, 0, abs_tol=1e-12)
    assert ppm.score(docs.limit(0)).count() == 0


def test_lookup():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000))
    table = ppm._lookup(keys, keys * 0.5)
    asked = np.random.default_rng(2).choice(keys, 20_000)
    assert np.array_equal(ppm._find(asked, table), asked * 0.5)
