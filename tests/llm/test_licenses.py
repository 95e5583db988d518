import random
import re

import pytest

from armlift.llm import licenses
from armlift.llm.licenses import TEMPLATES, compile_template, scan_text


def pattern(template):
    """The template as a regular expression over words each followed by a space."""
    out = []
    for piece in re.split(r"(\[\[|\]\]|\{\{\d+-\d+\}\})", template):
        if piece == "[[":
            out.append("(?:")
        elif piece == "]]":
            out.append(")?")
        elif piece.startswith("{{"):
            least, most = piece[2:-2].split("-")
            out.append(rf"(?:\S+ ){{{least},{most}}}")
        else:
            out += [re.escape(w) + " " for w in brute_words(piece)]
    return "".join(out)


def brute_words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text):
    words = brute_words(text or "")
    starts, base = [], set()
    for label, phrase in licenses.PHRASES.items():
        want = phrase.split()
        for i in range(len(words) - len(want) + 1):
            if words[i : i + len(want)] == want:
                starts.append(i)
                base.add(label)
    joined = " " + "".join(w + " " for w in words)
    labels = base | {label for label, t in TEMPLATES if re.search(" " + pattern(t), joined)}
    ends = (min(starts, default=None), max(starts, default=None))
    return len(words), len(starts), *ends, ",".join(sorted(base)), ",".join(sorted(labels))


def variants(template, rng):
    """The template's wording with regions filled, dropped, or a mandatory word broken."""
    text = template
    while "[[" in text:
        text = re.sub(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", lambda m: rng.choice([m[1], ""]), text, flags=re.S)
    fill = lambda m: " ".join(["Some Name"] * 1 if int(m[1]) < 2 <= int(m[2]) else ["x"] * int(m[1]))
    text = re.sub(r"\{\{(\d+)-(\d+)\}\}", fill, text)
    if rng.random() < 0.4:
        words = text.split()
        words[rng.randrange(len(words))] = "broken"
        text = " ".join(words)
    return text


TEXTS = [None, "", "...", "Released under the MIT License.", "Licensed under CC BY-NC 4.0. cc by nc", "under the\nMIT\tlicense " * 3,
         "underthe mit license", "\u00e9under the mit license", "Apache License, Version 2", "permission is hereby granted, free of"]


def test_against_brute_force(spark):
    rng = random.Random(3)
    texts = TEXTS + [f"lead {variants(t, rng)} tail" for _, t in TEMPLATES for _ in range(8)]
    rows = [(i if i else None, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    got = licenses.scan(docs).collect()
    assert sorted(repr(tuple(r)[:-1]) for r in got) == sorted(repr((r[0], *brute(r[1]))) for r in rows)
    for r in got:
        assert 0 <= r.score <= 1 and (r.score == 1) == bool(r.labels)
    assert {label for label, _ in TEMPLATES} <= {x for r in got for x in r.labels.split(",")}
    partial = next(r for r in got if r.doc_id == 9)
    assert 0 < partial.score < 0.2 and not partial.labels
    assert licenses.scan(docs.limit(0)).count() == 0


def test_very_long_text():
    automata = [compile_template(*t) for t in TEMPLATES]
    found = scan_text(b"cc by nc permission is hereby granted free of " * 50_000, automata)
    assert found[1] == 50_000 and found[3] == 49_999 * 9


def test_broken_template():
    with pytest.raises(ValueError):
        compile_template("x", "[[only]]")
    with pytest.raises(ValueError):
        compile_template("x", "open [[region")


NOTICES = {
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa": "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc": "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nc-nd": "licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "gpl-3": "Released under the GNU General Public License v3.0 or later",
    "lgpl-2.1": "GNU Lesser General Public License v2.1",
    "apache-2": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance',
}


@pytest.mark.parametrize("label", sorted(NOTICES))
def test_usual_notices(spark, label):
    docs = spark.createDataFrame([(1, NOTICES[label])], "doc_id long, text string")
    assert label in licenses.scan(docs).first().labels.split(",")


def plain(template):
    """The template's wording with all optional regions and a word for each replaceable one."""
    text = re.sub(r"\[\[|\]\]", "", template)
    return re.sub(r"\{\{(\d+)-\d+\}\}", lambda m: " ".join(["x"] * int(m[1])), text)


def mandatory_only(template):
    while "[[" in template:
        template = re.sub(r"\[\[((?:(?!\[\[|\]\]).)*)\]\]", "", template, flags=re.S)
    return plain(template)


def test_one_mandatory_word_changed():
    """Every template is accepted as published, and not with any tenth mandatory word changed."""
    for label, template in TEMPLATES:
        automaton = compile_template(label, template)
        for text in (plain(template), mandatory_only(template)):
            assert automaton.read(licenses.words_of(text.encode()))[0], (label, text)
        words = brute_words(mandatory_only(template))
        for at in range(0, len(words), 10):
            if words[at] != "x":
                broken = [*words[:at], "changed", *words[at + 1 :]]
                assert not automaton.read(licenses.words_of(" ".join(broken).encode()))[0], (label, at)
