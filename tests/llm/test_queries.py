"""The registered queries over the whole smallest tables: against DuckDB, or against plain versions."""

import hashlib
import math
import zlib

import check
import numpy as np
import pytest
from test_licenses import brute as brute_license
from test_sanitise import brute as brute_entities
from test_simhash import brute_components, brute_print

from armlift.llm.queries import QUERIES, SQL, vocabulary
from armlift.llm.tokens import load

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    found = check.duck(SF).execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()
    assert len(found) == len({d for d, _ in found}) >= 200
    return dict(found)


def by_id(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, name):
    assert check.compare(spark, check.duck(SF), name, SF, QUERIES[name], SQL[name]) == ""


def test_shards(spark, docs):
    got, start, tokenizer = by_id(spark, "op2_wavelet_shards"), 0, load(vocabulary("byte_bpe_50k.json"))
    for doc, text in docs.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [2]
        assert tuple(got[doc]) == (doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert len(got) == len(docs)


def test_simhash(spark, docs):
    prints = {d: brute_print(t) for d, t in docs.items()}
    group = brute_components(dict.fromkeys(prints.values()))
    least = {}
    for d, p in prints.items():
        least[group[p]] = min(d, least.get(group[p], d))
    want = {d: (d, f"{p:016x}", least[group[p]]) for d, p in prints.items()}
    assert {d: tuple(r) for d, r in by_id(spark, "op6_simhash_variants").items()} == want


def test_licenses(spark, docs):
    got = by_id(spark, "op7_license_templates")
    assert {d: tuple(r)[1:-1] for d, r in got.items()} == {d: brute_license(t) for d, t in docs.items()}


def test_entities(spark, docs):
    got = by_id(spark, "op8_disclosing_terms")
    for d, text in docs.items():
        base = [f"{k}:{a}:{b}" for k, a, b in brute_entities(text)]
        assert got[d].base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = got[d].spans.split(",") if got[d].spans else []
        assert spans[: len(base)] == base and all(s.startswith("term:") for s in spans[len(base) :])
    assert len(got) == len(docs)


def test_held_out_texts_are_compressed(spark, docs):
    """Far below 8 bits a byte, and below what the corpus's byte frequencies alone give."""
    got = by_id(spark, "op9_partial_matching")
    out = [r for r in got.values() if r.held_out]
    assert len(got) == len(docs) and {r.doc_id for r in out} == {d for d in docs if zlib.crc32(str(d).encode()) % 7 == 2}
    data = b"".join(docs[r.doc_id].lower().encode() + b"\xff" for r in out)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts[counts > 0] / len(data)
    bits = -sum(r.score for r in out) / len(data) / math.log10(2)
    assert bits < 0.7 * -(share * np.log2(share)).sum() and bits < 2.5


def test_token_counts(spark, docs):
    tokenizer, got = load(vocabulary("word_bpe_49k.json")), by_id(spark, "op10_prefix_counts")
    for d, text in docs.items():
        n = len(tokenizer.encode(text, add_special_tokens=False).ids)
        assert tuple(got[d]) == (d, len(text.encode()), n, n > 2048)
    assert len(got) == len(docs)


def test_other_queries_have_rows(spark, docs):
    assert {d for d, t in docs.items()} == set(by_id(spark, "op3_sentence_spans"))
    leaks = QUERIES["op4_benchmark_windows"](spark, SF).collect()
    items = dict(check.duck(SF).execute("SELECT item_id, text FROM benchmark").fetchall())
    plain = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert plain and plain <= {(r.doc_id, r.item_id) for r in leaks}
