import random
import time

import numpy as np
import pyarrow as pa

from armlift.llm import prefix_counts
from armlift.llm.queries import vocabulary
from armlift.llm.tokens import load

PATH = vocabulary("word_bpe_49k.json")
TEXTS = [
    "",
    "  ",
    "It's A plain Sentence, isn't it? | mark|inside || x",
    "<|endoftext|> special<|startoftext|>inside <|endoftext|>",
    "e\u0301t\u00e9 \u0301lead \u0130stanbul \u03a3\u03a3 \x1cctl\x1c x\u00a0y \u3000z",
    "line\none\r\ntwo\tthree  double",
    "z" * 5000 + " 1234567890 " + "\u6f22\u5b57" * 300,
    "again again again",
]


def test_counts_and_prefixes(spark):
    tokenizer = load(PATH)
    rows = [(i, t, i) for i, t in enumerate(TEXTS)] + [(None, None, 1), (3, "twice", 2), (3, "twice", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    count = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    got = prefix_counts.count_tokens(docs, PATH, 10).collect()
    want = [(r[0], len((r[1] or "").encode()), count(r[1] or ""), count(r[1] or "") > 10) for r in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    table = {r.doc_id: r for r in prefix_counts.prefix_table(docs, PATH).collect()}
    for i, text in enumerate(TEXTS):
        if i == 3:
            continue  # the id is used by other rows too
        raw = text.encode()
        step = max(1, len(raw) // 90)
        for cut in range(0, len(raw) + 1, step):  # any byte, also inside a character
            assert prefix_counts.tokens_of_prefix(table[i], cut) == count(raw[:cut].decode(errors="ignore"))
        for budget in (0, 1, 3, 8, 10_000):
            end = prefix_counts.truncation(table[i], budget)
            assert count(raw[:end].decode()) <= budget
            rest = raw[end:].split()
            assert not rest or count(raw[: raw.index(rest[0], end) + len(rest[0])].decode()) > budget
    cuts = prefix_counts.truncated(docs, PATH, [3]).where("doc_id = 7").first()
    assert cuts.cut_bytes == prefix_counts.truncation(table[7], 3)
    assert prefix_counts.count_tokens(docs.limit(0), PATH).count() == 0


def odd_words(n):
    rng = random.Random(9)
    letters = ["abcdefghijklmnopqrstuvwxyz", "etaoin", "aA", "éÉßüñÑöàœ", "漢字かなкириллица", "'sStTrReEvVmMlLdD", "0123456789"]
    letters += ["!?.,;:-_()[]{}<>|/\\@#$%^&*+=~`\"'", "ΣσςİıŞ", "e\u0301a\u0308=\u0338", "\x1c\x85\u00a0"]
    return ["".join(rng.choice(rng.choice(letters[: rng.randint(1, len(letters))])) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_every_prefix_of_odd_words():
    counter, words = prefix_counts.WordCounts(PATH), odd_words(3000) + ["it's", "we'll", "a<|endoftext|>b", "<|endoftext", "aaaaaaa"]
    assert counter.split is not None
    asked = [counter._asked(w) for w in words]
    assert counter.of(words) == asked
    assert [c[-1] for c in counter.whole(words)] == [a[-1] for a in asked]


def test_the_recurrence_asks_nothing():
    """Plain words are counted without the library; a file of other pieces has all words asked."""
    counter = prefix_counts.WordCounts(PATH)
    counter.tokenizer = None
    assert counter.whole(["There", "therefore", "x;;"]) and len(counter.of(["Therefore"])[0]) == 9
    other = prefix_counts.WordCounts(vocabulary("byte_bpe_50k.json"))
    assert other.of(["there's"]) == [other._asked("there's")]


def test_long_piece_is_linear():
    counter = prefix_counts.WordCounts(PATH)
    begun = time.perf_counter()
    found = counter.of(["abcdefghij" * 20_000, "-+" * 50_000])
    assert len(found[0]) == 200_000 and time.perf_counter() - begun < 60
    assert found[0][999] == len(load(PATH).encode("abcdefghij" * 100, add_special_tokens=False).ids)


def test_small_cache_gives_the_same():
    words = [w for t in TEXTS for w in t.split() if w]
    whole, tiny = prefix_counts.WordCounts(PATH), prefix_counts.WordCounts(PATH, cache_words=2)
    for group in (words, words[::-1], words[:3]):
        column = pa.array(group, pa.large_string())
        for counter in (whole, tiny):
            numbers = counter.numbers(column)
            assert counter.totals()[numbers].tolist() == [c[-1] for c in whole.of(group)]


def at_bytes(word, counts):
    """Counts at all bytes by those at all code points."""
    ends = [len(word[:i].encode()) for i in range(len(word) + 1)]
    return [([0] + counts)[max(i for i, end in enumerate(ends) if end <= cut)] for cut in range(1, ends[-1] + 1)]


def test_known_counts_at_all_bytes():
    """Words counted from their pieces, in batches that share some, and those that are not."""
    words = list(dict.fromkeys(odd_words(1500) + ["\u212aelvin", "\u023abc", "caf\u00e9", "caf\u00e9s", "it's", "A<|endoftext|>b"]))
    counter = prefix_counts.WordCounts(PATH)
    words = [w for w in words if not set(w) & set(" \t\n")]
    for group in (words[::3], words[1::2], words):
        numbers = counter.numbers(pa.array(group, pa.large_string()))
        for word, number in zip(group, numbers.tolist()):
            begin = counter.places[number]
            got = counter.flat[begin : begin + counter.sizes[number]].tolist()
            assert got == at_bytes(word, counter._asked(word)), word


def test_words_asked_in_parts():
    counter = prefix_counts.WordCounts(PATH)
    words = odd_words(2000) + ["!!<|endoftext|>a<|endoftext|>", "<|a<|startoftext|>9", "1\u0301a", "=\u0338b", "'9's"]
    assert all(counter._asked_in_parts(w) == counter._asked(w) for w in words)
    begun = time.perf_counter()
    long = "\u6f22\u5b57\u3002" * 20_000 + "e\u0301"
    found = counter.of([long])[0]
    assert len(found) == len(long) and time.perf_counter() - begun < 60
    assert [found[i] for i in (599, 60_001)] == [
        len(counter.tokenizer.encode(long[: i + 1], add_special_tokens=False).ids) for i in (599, 60_001)
    ]


def test_counts_are_asked_of_the_table(spark, monkeypatch):
    """The query's counts are those stored for the longest prefixes, not a count beside them."""
    packed = prefix_counts.packed

    def doubled(path):
        def each(parts):
            for part in packed(path)(parts):
                at = part.schema.get_field_index("prefix_counts")
                counts = [(2 * np.frombuffer(c, "<u4")).astype("<u4").tobytes() for c in part.column(at).to_pylist()]
                yield part.set_column(at, "prefix_counts", pa.array(counts, pa.binary()))

        return each

    monkeypatch.setattr(prefix_counts, "packed", doubled)
    docs = spark.createDataFrame([(1, "some more words here"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in prefix_counts.count_tokens(docs, PATH).collect()}
    assert got == {1: 8, 2: 0}
