import random
import re

from pyspark.sql import functions as F

from armlift.llm import decontaminate as dc

SCHEMA = "doc_id long, text string, item_id int, words string"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def similarity(a, b):
    shingle = lambda w: [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    x, y = shingle(a), shingle(b)
    common = sum(min(x.count(s), y.count(s)) for s in set(x) & set(y))
    return common / (len(x) + len(y) - common)


def brute(rows, items):
    """Best similarity of any item-sized window, laid at every word of every text."""
    out = {}
    for doc, text, *_ in rows:
        found = words(text)
        for item, wording in items:
            want = words(wording)
            if len(want) < 5 or len(found) < 5:
                continue
            ends = range(max(1, len(found) - len(want) + 1))
            best = max(similarity(found[i : i + len(want)], want) for i in ends)
            if best >= 0.8:
                out[doc, item] = max(best, out.get((doc, item), 0))
    return out


def corpus():
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(80)] + ["the", "of"] * 10
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(draw(rng.choice([8, 20, 40, 70])))) for i in range(25)]
    items += [(100, "too short"), (101, None), (None, "item without a number that leaks somewhere"), (102, items[3][1].upper())]
    rows = []
    for i in range(60):
        leak = words(items[i % 25][1])
        edits = rng.choice([0, 0, 1, 2, 6])
        for _ in range(edits):
            at = rng.choice([0, len(leak) - 1, rng.randrange(len(leak))])
            leak[at] = "edited"
        rows.append((i, " ".join(draw(rng.randint(0, 50)) + leak + draw(rng.randint(0, 50))).capitalize() + ".", 1, "x"))
    rows += [(200 + i, " ".join(draw(100)), 1, "x") for i in range(20)]
    rows += [(300, None, 1, "x"), (301, "", 1, "x"), (302, "one two", 1, "x"), (303, items[0][1] + " " + items[0][1], 1, "x")]
    rows += [(304, items[1][1], 1, "x")] * 2 + [(305, items[5][1].replace(" ", ", ") + "!", 1, "x")]
    return rows + [(None, "An item without a number that leaks somewhere!", 1, "x")], items


def test_against_brute_force(spark, monkeypatch):
    rows, items = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = brute(rows, items)
    for patched in (False, True):
        if patched:
            monkeypatch.setattr(dc, "small", lambda df: df)
        got = {(r.doc_id, r.item_id): r for r in dc.leaks(docs, benchmark).collect()}
        missed = [k for k in want if k not in got]
        assert set(got) <= set(want) and not missed
        for key, r in got.items():
            text = next(t for d, t, *_ in rows if d == key[0])
            item = next(t for i, t in items if i == key[1])
            found = similarity(words(text)[r.first_word : r.first_word + r.length], words(item))
            assert abs(found - r.similarity) < 1e-12
    dirty = {d for d, _ in want}
    clean = dc.clean(docs, benchmark)
    assert clean.columns == docs.columns
    key = lambda x: (x is None, x or 0)
    assert sorted((r.doc_id for r in clean.collect()), key=key) == sorted((r[0] for r in rows if r[0] not in dirty), key=key)
    assert dc.leaks(docs.limit(0), benchmark).count() == 0 and dc.leaks(docs, benchmark.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    rows, items = corpus()
    plan = dc.leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().toString() and "Arrow" not in plan._jdf.queryExecution().toString()


def test_replaced_tenths(spark):
    """Items whose first or last tenth is replaced keep a similarity of 0.8 and are all found."""
    rng = random.Random(21)
    draw = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    items, rows = [], []
    for i in range(200):
        item = draw(50)
        leak = item[:45] + draw(5) if i % 2 else draw(5) + item[5:]
        items.append((i, " ".join(item)))
        rows.append((i, " ".join(draw(20) + leak + draw(20)), 1, "x"))
    assert all(similarity(words(t)[20:70], words(w)) >= 0.8 for (_, t, *_), (_, w) in zip(rows, items))
    found = dc.leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in range(200)}


def test_radius_is_guaranteed(spark):
    """Fingerprints of every distance up to the radius meet in a block, wherever the bits are."""
    rng = random.Random(4)
    rows = []
    for i in range(3000):
        fp = rng.getrandbits(64)
        other = fp
        for bit in rng.sample(range(64), rng.randint(0, dc.RADIUS)):
            other ^= 1 << bit
        rows.append((i, *(x - 2**64 if x >> 63 else x for x in (fp, other))))
    pairs = spark.createDataFrame(rows, "i long, fp long, other long")
    near = [F.bit_count(dc._block("fp", b).bitwiseXOR(dc._block("other", b))) <= 1 for b in dc.BLOCKS]
    assert pairs.where(~F.greatest(*near)).count() == 0
    assert sorted(bit for at, width in dc.BLOCKS for bit in range(at, at + width)) == list(range(64))


def test_fingerprints_alone_recall(spark):
    """Of edits that leave a similarity of just 0.8, the radius alone holds more than nine in ten."""
    rng = random.Random(33)
    draw = lambda n: [f"u{rng.randrange(10**6)}" for _ in range(n)]
    for way in ("head", "tail", "scattered"):
        windows, items = [], []
        for i in range(400):
            item = draw(rng.choice([30, 50, 80]))
            edits = max(1, (len(item) - 4) // (45 if way == "scattered" else 9))
            copy = list(item)
            if way == "scattered":
                for at in rng.sample(range(5, len(item) - 5), edits):
                    copy[at] = draw(1)[0]
            else:
                copy[slice(0, edits) if way == "head" else slice(-edits, None)] = draw(edits)
            windows.append((i, copy))
            items.append((i, item))
        windows = spark.createDataFrame(windows, "window long, words array<string>").withColumn("fp", dc._simhash("words"))
        found = dc._by_fingerprint(windows, spark.createDataFrame(items, "item long, item_words array<string>"))
        met = {r.window for r in found.where("window = item").collect()}
        assert len(met) > 0.9 * 400, (way, len(met))


def test_very_long_text(spark):
    rng = random.Random(6)
    item = " ".join(f"i{n}" for n in range(40))
    text = " ".join(f"w{rng.randrange(10**5)}" for _ in range(60_000)) + " " + item + " " + "z" * 300_000
    rows = [(1, text, 1, "x"), (2, text.replace("i3 ", "other "), 1, "x"), (3, "z" * 500_000, 1, "x")]
    got = dc.leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert {(r.doc_id, r.first_word, r.length) for r in got} == {(1, 60_000, 40), (2, 60_000, 40)}


def test_ties_go_to_the_first_window(spark):
    item = "one two three four five six seven eight"
    rows = [(1, f"x {item} y {item} z", 1, "x"), (1, f"x {item} y {item} z", 1, "x")]
    got = dc.leaks(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([(7, item), (8, item)], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.first_word, r.length) for r in got) == [(1, 7, 1, 8), (1, 8, 1, 8)]
