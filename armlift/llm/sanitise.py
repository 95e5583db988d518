"""Personal data: detected entities, and terms that give them away by corpus co-occurrence.

1. Detection.  Addresses, numbers and cards are found in every whole text.  All words of a text that
   holds any are candidate terms, wherever in it they stand.
2. Co-occurrence.  With documents as trials, an entity ``c`` has information ``IC = -log2 p(c)`` and a
   term ``t`` reveals ``PMI = log2 p(c, t) / (p(c) p(t))`` of it, at most ``IC``.  A candidate's
   frequencies, alone and with the entity, count whole documents of the whole corpus, wherever in them
   it stands.
3. Disclosure.  A candidate held with its entity by at least ``SUPPORT`` distinct texts whose ``PMI`` is
   at least ``ALPHA`` of ``IC`` gives the entity away, and is a span of its own wherever it stands in a
   document that holds the entity.
4. Sanitisation.  Entities are generalised to their kind and revealing terms to ``[TERM]``, or both
   are removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from armlift.llm.common import small, stored, texts

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
SUPPORT = 3
ALPHA = 0.9
MIN_TERM = 3

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]\.[0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from each ``@``: every step looks at a character once."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            past = domain.end()
        at = text.find("@", max(past, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def entities(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of every entity, by kind as listed and then start; code points."""
    found: list[tuple[str, int, int]] = []
    if "@" in text:
        found += [("email", *span) for span in _emails(text)]
    if _DOTTED.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                found.append(("ip", *m.span()))
    if _DIGITS.search(text):
        for m in _CARD.finditer(text):
            if m.end() - m.start() <= 37:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.findall(m[0])) <= 15:
                found.append(("phone", *m.span()))
    return found


def _words(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, str]]:
    """(start, end, lower case) of the letter runs outside all spans."""
    import regex

    taken = sorted((a, b) for _, a, b in spans)
    words, k = [], 0
    for m in regex.finditer(r"\p{L}+", text):
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or m.end() <= taken[k][0]:
            words.append((m.start(), m.end(), m[0].lower()))
    return words


_FOUND = (
    "doc_id long, hash long, n_email long, n_ip long, n_card long, n_phone long, base string, "
    "entities array<string>, words array<string>"
)
_NAMES = ["doc_id", "hash", *(f"n_{kind}" for kind in KINDS), "base", "entities", "words"]
_TYPES = [
    *[pa.int64()] * 6,
    pa.string(),
    pa.list_(pa.string()),
    pa.list_(pa.string()),
]


def _found_in(doc_id: int | None, text: str, digest: int) -> tuple:
    spans = entities(text)
    words = _words(text, spans) if spans else []
    return (
        doc_id,
        digest,
        *(sum(s[0] == kind for s in spans) for kind in KINDS),
        ",".join(f"{k}:{a}:{b}" for k, a, b in spans),
        sorted({f"{k}:{text[a:b]}" for k, a, b in spans}),
        sorted({t for _, _, t in words if len(t) >= MIN_TERM}),
    )


def _scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its entities, and the words of texts that hold any."""

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 500):
                group = part.slice(at, 500)
                rows = [_found_in(*row) for row in zip(*(group.column(i).to_pylist() for i in range(3)))]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], _NAMES)

    return texts(docs).withColumn("_hash", F.xxhash64("_text")).mapInArrow(each, _FOUND)


def _documents_with(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``term`` and ``n_t``: documents that hold each of ``terms``, over the whole corpus.

    All words are counted, with map-side combine, before the terms (distinct) are looked up: common
    ones among them would else carry a row of nearly every document through the join.  An inner join
    stays above the count, where the planner would move a semi-join below it.
    """
    held = texts(docs).select(F.explode(F.array_distinct(F.split(F.lower("_text"), r"[^\p{L}]+"))).alias("term"))
    return held.groupBy("term").agg(F.count("*").alias("n_t")).join(terms, "term")


def _together(found: DataFrame, support: int) -> DataFrame:
    """``entity`` and ``term`` that stand together in so many distinct texts, wherever in them.

    Entities of fewer texts, which most are, are left out before words are paired with them; a pair is
    one row a text, counted with map-side combine.
    """
    different = found.where("base <> ''").select("hash", "entities", "words").dropDuplicates(["hash"])
    different = stored(different, "sanitise-texts")
    held = different.select("hash", F.explode("entities").alias("entity"))
    often = held.groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= support).select("entity")
    words = different.select("hash", F.explode("words").alias("term"))
    both = held.join(often, "entity", "left_semi").join(words, "hash").groupBy("entity", "term").agg(F.count("*").alias("n"))
    return both.where(F.col("n") >= support).select("entity", "term")


def revealing(found: DataFrame, docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """``entity``, ``term``, ``pmi`` and ``ic`` (bits) of the terms that give an entity away.

    ``support`` counts distinct texts, so copies of one text are one piece of evidence.
    """
    total = found.count()
    held = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_c"))
    near = stored(_together(found, support), "sanitise-near")
    counts = _documents_with(docs, near.select("term").distinct())
    n = F.lit(float(total))
    ic = F.log2(n / F.col("n_c"))
    # Not even in all of the entity's documents would the other terms reach ALPHA.
    most = F.log2(n / F.greatest("n_c", F.coalesce("n_t", F.lit(0))))
    pairs = near.join(held, "entity").join(counts, "term", "left").where((ic > 0) & (most >= ALPHA * ic - 1e-9))
    pairs = stored(pairs, "sanitise-pairs")
    n_t = F.greatest(F.coalesce("n_t", "n_ct"), F.col("n_ct"))
    return (
        _met(found, pairs)
        .groupBy("entity", "term")
        .agg(F.sum("n").alias("n_ct"), F.count("*").alias("n_texts"))
        .where(F.col("n_texts") >= support)
        .join(pairs, ["entity", "term"])
        .select("entity", "term", F.log2(F.col("n_ct") * n / (F.col("n_c") * n_t)).alias("pmi"), ic.alias("ic"))
        .where(F.col("pmi") >= ALPHA * F.col("ic"))
    )


def _met(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """``entity``, ``term``, ``hash``, ``n``: the texts, and their rows, that hold both of a pair."""
    copies = found.where("base <> ''").groupBy("hash").agg(F.count("*").alias("n"))
    words = found.select("hash", F.explode("words").alias("term"))
    words = words.join(pairs.select("term").distinct(), "term", "left_semi").distinct()
    entities_ = found.select("hash", F.explode("entities").alias("entity"))
    entities_ = entities_.join(pairs.select("entity").distinct(), "entity", "left_semi").distinct()
    both = words.join(pairs.select("entity", "term"), "term").join(entities_, ["hash", "entity"])
    return both.join(copies, "hash").select("entity", "term", "hash", "n")


def _extra(docs: DataFrame, given: DataFrame) -> DataFrame:
    """``hash`` and ``extra``: the spans of the terms given to each text."""

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            extra = []
            for text, terms in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                wanted = set(terms)
                words = _words(text, entities(text))
                extra.append(",".join(f"{TERM}:{a}:{b}" for a, b, t in words if t in wanted))
            yield pa.record_batch([part.column(0), pa.array(extra, pa.string())], ["hash", "extra"])

    rows = texts(docs).select(F.xxhash64("_text").alias("hash"), "_text")
    rows = rows.join(small(given.select("hash")), "hash", "left_semi")  # texts without such terms are not shuffled
    return rows.join(given, "hash").mapInArrow(each, "hash long, extra string").dropDuplicates(["hash"])


def _judged(docs: DataFrame, support: int) -> DataFrame:
    """The scan's rows with ``spans``, the base spans and those of revealing terms."""
    found = stored(_scan(docs), "sanitise-found")
    terms = stored(revealing(found, docs, support).select("entity", "term"), "sanitise-terms")
    given = stored(_met(found, terms).groupBy("hash").agg(F.collect_set("term").alias("given")), "sanitise-given")
    extra = _extra(docs, given)
    return (
        found.join(extra, "hash", "left")
        .withColumn("spans", F.concat_ws(",", F.nullif("base", F.lit("")), F.nullif("extra", F.lit(""))))
    )


def personal_data(docs: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Counts, digest of the base spans, and all spans of every row of ``docs``.

    Spans are ``kind:start:end`` in code points, by kind and then start, revealing terms last.  A term
    needs ``support`` distinct texts that hold it with the entity: with few, a term that stands only
    there is not told from chance.  Texts of any length are searched in full.  A NULL or empty text has none; NULL ids and equal rows are returned as they are, a text equal to another
    adds no support, an empty table gives no rows, and further columns are ignored.
    """
    return _judged(docs, support).select(
        "doc_id", *(f"n_{kind}" for kind in KINDS), F.sha2("base", 256).alias("base_sha256"), "spans"
    )


def _replaced(text: str, spans: str, remove: bool) -> str:
    cut = sorted((int(a), -int(b), kind) for kind, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at = [], 0
    for start, end, kind in cut:
        if start >= at:  # an entity inside another one goes with it
            out += [text[at:start], "" if remove else f"[{kind.upper()}]"]
        elif -end > at and not remove:
            out.append(f"[{kind.upper()}]")
        at = max(at, -end)
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, remove: bool = False, support: int = SUPPORT) -> DataFrame:
    """``doc_id`` and ``text`` with every span generalised to its kind, or removed."""

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = zip(*(part.column(i).to_pylist() for i in (1, 2)))
            cleaned = [_replaced(text, spans, remove) if spans else text for text, spans in rows]
            yield pa.record_batch([part.column(0), pa.array(cleaned, pa.string())], ["doc_id", "text"])

    spans = _judged(docs, support).select("doc_id", "hash", "spans").where("spans <> ''").distinct()
    rows = texts(docs).withColumn("_hash", F.xxhash64("_text")).alias("r")
    same = F.col("r._id").eqNullSafe(F.col("s.doc_id")) & (F.col("r._hash") == F.col("s.hash"))
    joined = rows.join(spans.alias("s"), same, "left").select("r._id", "r._text", "spans")
    return joined.mapInArrow(each, "doc_id long, text string")
