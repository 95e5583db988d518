import random
import re
import zlib
from collections import Counter, defaultdict

from armlift.llm import spelling

SCHEMA = "doc_id long, text string, word string, n long, len int"


def brute(docs, slip=199, least=5):
    counts = Counter()
    for doc_id, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % slip == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            counts[low] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= least}
    near = brute_near(words)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= 5 * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def brute_near(words):
    """Pairs at one edit, by trying every pair."""
    near = defaultdict(set)
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) <= 1:
                s, t = sorted((a, b), key=len)
                if len(s) == len(t):
                    one = sum(x != y for x, y in zip(s, t)) == 1
                else:
                    one = any(t[:i] + t[i + 1 :] == s for i in range(len(t)))
                if one:
                    near[a].add(b)
                    near[b].add(a)
    return near


def test_pairs_against_brute_force(spark):
    """Random words over few letters: edits at every place, repeated letters, all lengths from four."""
    rng = random.Random(2)
    words = {"".join(rng.choices("abÿ", k=rng.randint(4, 8))) for _ in range(250)}
    words |= {"abcdefgh", "xabcdefgh", "abcdefghx", "abcdxefgh", "abcdefg", "bcdefgh", "abcdefgi", "bbcdefgh", "aabcdefgh"}
    rows = [(w, i) for i, w in enumerate(sorted(words))]
    got = spelling.near_pairs(spark.createDataFrame(rows, "word string, n long")).collect()
    want = {(a, b) for a, others in brute_near(words).items() for b in others if a < b}
    assert {tuple(sorted((r.a, r.b))) for r in got} == want and len(got) == len(want)
    n = dict(rows)
    assert all(r.na == n[r.a] and r.nb == n[r.b] for r in got)


def test_a_crowd_around_one_word(spark):
    """Hundreds of variants share a chunk: few rows meet, and no pair is lost."""
    base, letters = "ordentlichkeit", "abcdefghijklmnopqrstuvwxyzàéîõü"
    words = {base} | {base[:i] + c + base[i + 1 :] for i in range(7, 14) for c in letters}
    words |= {base[:i] + c + base[i:] for i in range(7, 15) for c in letters} | {base[:i] + base[i + 1 :] for i in range(14)}
    got = spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long")).collect()
    want = {(a, b) for a, others in brute_near(words).items() for b in others if a < b}
    assert {tuple(sorted((r.a, r.b))) for r in got} == want


def test_documents_against_brute_force(spark):
    rng = random.Random(3)
    words = ["Öffnung", "oeffnung", "letters", "LETTERS", "letterss", "lettrs", "leters", "words", "naïveté", "naivete"]
    docs = [(i, " ".join(rng.choices(words, [9, 1, 30, 20, 3, 3, 2, 9, 9, 2], k=60)), "x", 1, 2) for i in range(40)]
    docs += [(None, "letters letters", None, 1, 2), (7, None, "x", 1, 2), (8, "", "x", 1, 2), (9, "12 34 ß_", "x", 1, 2)]
    docs += [(41, "Wiederholt, wiederholt! " * 3, "x", 1, 2)] * 2
    docs += [(42, "verylongword" * 5000 + " " + "letters " * 50_000, "x", 1, 2)]
    got = spelling.variants(spark.createDataFrame(docs, SCHEMA)).collect()
    assert {tuple(r) for r in got} == brute(docs) and len(got) == len(brute(docs))


def test_chain_of_forms(spark):
    docs = [(i, text, "x", 1, 2) for i, text in enumerate(["aaaaaabbb " * 150, "aaaaaabb " * 30, "aaaaaab " * 6])]
    found = {r.word: r for r in spelling.variants(spark.createDataFrame(docs, SCHEMA), slip=None).collect()}
    assert found["aaaaaab"].form == "aaaaaabb" and found["aaaaaab"].root == "aaaaaabbb"
    assert found["aaaaaabb"].form_n == 150 and found["aaaaaabbb"].form is None


def test_ties_go_to_the_smaller_word(spark):
    docs = [(1, "zahlené " * 50 + "zahlena " * 50 + "zahlen " * 10, "x", 1, 2)]
    found = {r.word: r.form for r in spelling.variants(spark.createDataFrame(docs, SCHEMA), slip=None).collect()}
    assert found == {"zahlené": None, "zahlena": None, "zahlen": "zahlena"}


def test_empty(spark):
    assert spelling.variants(spark.createDataFrame([], SCHEMA)).count() == 0
