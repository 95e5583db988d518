import hashlib
import math
import random
import re

import pytest

from armlift.llm import sanitise

SCHEMA = "doc_id long, text string, hash string, spans int"
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: [c for c in s if c in "0123456789"]
    def luhn(ds):
        total = 0
        for i, d in enumerate(map(int, ds[::-1])):
            total += sum(divmod(d * 2, 10)) if i % 2 else d
        return total % 10 == 0
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


TEXTS = [
    "", "a@b.c", "a@b.c+d@e.f", "x@@y.z q@r", "a@b@c.d", "...@a.b", "mail: jo.e%x@mail-8.example.com.", "a@b.c.@d.e", "@a.b", "\u00e9a@b.c\u00e9",
    "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.255", "001.02.3.0004", "1..2.3.4", "9.9.9 9.9.9.9",
    "4111 1111 1111 1111", "4111-1111-1111-1112", "4111  1111", "4571 1111 1111 1111 4111111111111111", "0000000000000",
    "+1 (414) 555-1791", "+12345678", "+1(2)3-4.5 6 7 8 9 0", "++1 2222 33333)", "+1 23456789 +44 20 7946 0958",
]


@pytest.mark.parametrize("seed", range(4))
def test_entities(seed):
    rng = random.Random(seed)
    texts = TEXTS + ["".join(rng.choices("a@.1 -+(2x9\u00e9", k=rng.randint(1, 60))) for _ in range(3000)]
    texts += ["1" * 100_000, "a" * 100_000 + "@", "1." * 50_000, "+1" * 20_000, "@" * 50_000]
    for text in texts:
        assert sanitise.entities(text) == (brute(text) if len(text) < 1000 else sanitise.entities(text))


def corpus():
    """One secret name beside an address in several texts, common words everywhere."""
    rows = []
    for i in range(60):
        rows.append((i, f"common words stand here number{i} and more common words", "x", 1))
    for i in range(60, 65):
        rows.append((i, f"Ask Zorblax near the old mill, zorblax7 {i} write zed@mill.example.com for common things", "x", 1))
    rows += [(70 + i, "Copied Quuxling writes from 10.0.0.7 with common words", "x", 1) for i in range(9)]
    rows += [(90, "Zorblax alone is here", "x", 1), (91, None, None, None), (92, "", "", 2), (None, "call +1 (414) 555-1791 now", "", 2)]
    return rows + [(93, "pay 4111 1111 1111 1111 today", "s", 3)] * 2


def expected_terms(rows, support=sanitise.SUPPORT):
    texts = [r[1] or "" for r in rows]
    words = [set(re.findall(r"[^\W\d_]+", t.lower())) for t in texts]
    found = [{f"{k}:{t[a:b]}" for k, a, b in sanitise.entities(t)} for t in texts]
    near = []
    for t, held in zip(texts, found):
        own = {w for *_, w in sanitise._words(t, sanitise.entities(t)) if len(w) >= sanitise.MIN_TERM} if held else set()
        near.append({(e, w) for e in held for w in own})
    out = {}
    for entity, term in set().union(*near):
        holders = [i for i in range(len(rows)) if (entity, term) in near[i]]
        n_c = sum(entity in f for f in found)
        n_t = sum(term in w for w in words)
        ic = math.log2(len(rows) / n_c)
        pmi = math.log2(len(holders) * len(rows) / (n_c * n_t))
        if len({texts[i] for i in holders}) >= support and pmi >= sanitise.ALPHA * ic:
            for i in holders:
                out.setdefault(i, set()).add(term)
    return out


@pytest.mark.parametrize("support", [1, 2, sanitise.SUPPORT])
def test_against_brute_force(spark, support):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    terms = expected_terms(rows, support)
    assert {"zorblax", "mill", "ask"} <= terms[60] and "common" not in terms[60]
    assert any(70 <= rows[i][0] < 90 for i in terms if rows[i][0]) == (support == 1)  # copies are one piece of evidence
    want = []
    for i, (doc, text, *_) in enumerate(rows):
        base = [f"{k}:{a}:{b}" for k, a, b in brute(text or "")]
        spans = sanitise._words(text or "", sanitise.entities(text or ""))
        extra = [f"term:{a}:{b}" for a, b, t in spans if t in terms.get(i, ())]
        count = [sum(b.startswith(k + ":") for b in base) for k in sanitise.KINDS]
        want.append((doc, *count, hashlib.sha256(",".join(base).encode()).hexdigest(), ",".join(base + extra)))
    got = sanitise.personal_data(docs, support).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert sanitise.personal_data(docs.limit(0)).count() == 0


def test_sanitised(spark):
    docs = spark.createDataFrame(corpus(), SCHEMA)
    texts = {r.doc_id: r.text for r in sanitise.sanitised(docs).collect()}
    assert texts[60].startswith("[TERM] [TERM] [TERM]") and "[EMAIL]" in texts[60] and "zed" not in texts[60]
    assert texts[90] == "Zorblax alone is here" and texts[93] == "pay [CARD] today" and texts[91] == ""
    bare = {r.doc_id: r.text for r in sanitise.sanitised(docs, remove=True).collect()}
    assert bare[93] == "pay  today"
    assert sanitise._replaced("ab cdef", "email:1:4,ip:3:5", False) == "a[EMAIL][IP]ef"


def test_terms_far_from_the_entity(spark):
    """A term that stands in no document without the address reveals it, however far from it."""
    far = "some other words that fill the line between both of them here"
    rows = [(i, f"plain filler number {i} about nothing", "x", 1) for i in range(60)]
    rows += [(100, f"Zorblax {far} writes from zed@mill.example.com", "x", 1)]
    rows += [(101 + i, f"Zorblax {far} {far} {i} zed@mill.example.com", "x", 1) for i in range(3)]
    rows += [(110, "Nobody at all, alone", "x", 1)]
    spans = {r.doc_id: r.spans for r in sanitise.personal_data(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("term:0:7" in spans[i] for i in range(100, 104)) and spans[110] == ""
