import random
import re
import time
import zlib

from armlift.llm import sentence_spans as ss
from armlift.llm.sentence_spans import CUT_WINDOW, SENTENCES, WORDS, Pieces

SCHEMA = "doc_id long, text string, span string, doc int"


def sentences(text):
    """Pieces by the rule, word by word: (as they stand, in lower case with single spaces, words)."""
    raws, out = re.findall(r"[^.!?\n]*[.!?\n]+[\"')\]]*\s*|[^.!?\n]+\Z", text), []
    for raw in raws:
        words = [(m.end(), m[0]) for m in re.finditer(r"\S+", raw)]
        hashes = [zlib.crc32(w.lower().encode()) for _, w in words]
        cuts = set()
        for end in range(CUT_WINDOW, len(hashes) + 1):
            window = range(end - CUT_WINDOW, end)
            cuts.add(max(i for i in window if hashes[i] == min(hashes[k] for k in window)))
        at = 0
        for place in [words[i][0] for i in sorted(cuts) if i < len(words) - 1] + [len(raw)]:
            part = raw[at:place]
            if part.split() or not out:
                out.append(part)
            else:
                out[-1] += part
            at = place
    merged = []
    for part in out:  # blanks before the first word belong to it
        if merged and not merged[-1].split():
            merged[-1] += part
        else:
            merged.append(part)
    return merged, [" ".join(p.lower().split()) for p in merged], [len(p.split()) for p in merged]


def brute(rows):
    """Every span of every text compared with all texts before it, by wording."""
    def runs(norms, sizes, raws):
        full = lambda i, j: j - i >= SENTENCES and sum(sizes[i:j]) >= WORDS
        for i in range(len(norms)):
            for j in range(i + SENTENCES, len(norms) + 1):
                if full(i, j):
                    yield i, j, " ".join(norms[i:j])
                    break
        for j in range(1, len(norms) + 1):
            if j == len(norms) or "\n" in raws[j - 1]:
                for i in range(j - SENTENCES, -1, -1):
                    if full(i, j):
                        yield i, j, " ".join(norms[i:j])
                        break

    texts = [(r[0], r[1] or "") for r in rows]
    cut = [sentences(t) for _, t in texts]
    out = []
    for (doc, _), (raws, norms, sizes) in zip(texts, cut):
        before = set()
        for (other, _), (other_raws, n, s) in zip(texts, cut):
            if other is not None and (doc is None or other < doc):
                before |= {r for _, _, r in runs(n, s, other_raws)}
        gone, met = set(), set()
        for i, j, run in sorted(set(runs(norms, sizes, raws))):
            if run in before or run in met:
                gone |= set(range(i, j))
            met.add(run)
        out.append((doc, "".join(r for k, r in enumerate(raws) if k not in gone), len(raws), len(gone)))
    return out


def corpus():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "delta", "\u00e9t\u00e9", "zeta", "eta", "theta"]
    sentence = lambda n: " ".join(rng.choice(words) + str(rng.randint(0, 30)) for _ in range(n)) + rng.choice([".", "!", "?\n", "...", ".\n\n"])
    own = lambda k: [sentence(rng.randint(1, 9)) for _ in range(k)]
    shared = own(8)
    unmarked = " ".join(f"word{i}" for i in range(90))
    rows = [(i * 7 % 23, " ".join(own(3) + shared[: rng.randint(2, 8)] + own(2)), "x", 1) for i in range(20)]
    rows += [(50, " ".join(own(2) + shared + own(1) + shared), "x", 1), (51, f"Lead {unmarked} tail.", "x", 1), (52, f"Other {unmarked}", "x", 1)]
    rows += [(60, rows[0][1].upper(), "x", 1), (61, None, None, None), (62, "", "", 2), (63, " \n ", "", 2), (64, "x" * 5000, "", 2)]
    rows += [(70, "One two three. Four five six seven. Eight nine ten eleven twelve thirteen.", "", 3)] * 2
    return rows + [(None, rows[0][1], "x", 1)]


def test_against_brute_force(spark):
    rows = corpus()
    got = ss.deduplicate(spark.createDataFrame(rows, SCHEMA)).collect()
    want = brute(rows)
    assert sorted(map(repr, [tuple(r)[:4] for r in got])) == sorted(map(repr, want))
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        before = texts[r.doc_id] or ""
        left, at = "", 0
        for span in filter(None, r.removed.split(",")):
            a, b = map(int, span.split(":"))
            left, at = left + before[at:a], b
        assert left + before[at:] == r.text
    by_id = {r.doc_id: r for r in got}
    assert by_id[52].n_removed and "word45" not in by_id[52].text and "word45" in by_id[51].text
    assert by_id[None].text == "" and by_id[60].text == ""
    assert ss.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_pieces_are_lossless_and_by_the_rule():
    rng = random.Random(3)
    texts = ["", "\n\n", "a.b. c", " lead. x", "no end", "q? (yes!) 'ok.' end ", "w " * 200, "...", "a\n\n\nb", "  \n x y"]
    texts += ["".join(rng.choice([". ", " ", " ", " ", "\n", "  "]) + rng.choice("abcdef") * 2 for _ in range(80)) for _ in range(200)]
    for text in texts:
        pieces = Pieces(text)
        raws, norms, sizes = sentences(text)
        assert "".join(pieces.texts()) == text and pieces.texts() == raws
        if any(sizes):
            assert pieces.sizes.tolist() == sizes and pieces.joined.decode() == " ".join(norms)
    assert max(Pieces(" ".join(f"w{i}" for i in range(4000))).sizes) <= 2 * CUT_WINDOW


def test_passage_in_short_and_long_sentences():
    """One passage, once in a sentence of its own length and once inside a longer one."""
    rng = random.Random(19)
    draw = lambda n: [f"p{rng.randrange(5000)}" for _ in range(n)]
    met = 0
    for _ in range(300):
        sentences_ = [draw(14) for _ in range(4)]
        one = ". ".join(" ".join(s) for s in sentences_) + "."
        two = "Once " + " ".join(draw(6)) + " " + " ".join(w for s in sentences_ for w in s).replace(" ", " ") + " " + " ".join(draw(6))
        two_marked = ". ".join(" ".join(s) for s in [draw(6) + sentences_[0], *sentences_[1:3], sentences_[3] + draw(6)]) + "."
        spans = [{s[0] for s in Pieces(t).spans()} for t in (one, two, two_marked)]
        met += bool(spans[0] & spans[2])
    assert met == 300


def test_a_megabyte_of_blanks_is_linear():
    begun = time.perf_counter()
    for text in (" " * 10**6, "word" + " " * 10**6 + "end", "\n" * 10**6, "x" * 10**6, "a. " * 300_000, ". " * 10**5):
        assert "".join(Pieces(text).texts()) == text
        Pieces(text).spans()
    assert time.perf_counter() - begun < 60


def test_passages_in_run_on_text():
    """Any 51 equal words in text without end marks hold a full span."""
    rng = random.Random(13)
    draw = lambda n: [f"r{rng.randrange(5000)}" for _ in range(n)]
    for length in (46, 51, 55, 60):
        for _ in range(500):
            passage = draw(length)
            one, two = (" ".join(draw(rng.randint(0, 60)) + passage + draw(rng.randint(0, 60))) for _ in range(2))
            both = [{s[0] for s in Pieces(t).spans()} for t in (one, two)]
            assert both[0] & both[1]
