import zlib

import numpy as np
import pyarrow as pa
import pytest

from armlift.llm import wavelet
from armlift.llm.queries import vocabulary
from armlift.llm.tokens import ByteBpe, batches, load

PATH = vocabulary("byte_bpe_50k.json")
TEXTS = [
    "",
    " lead and  double   triple",
    "tab\tand \n newline \n\nends ",
    "plain words, it's fine: 12 345 <|endoftext|> after",
    "a" * 300 + " b",
    "été ñandú 　 wide space 漢字かな",
    "x\n",
    "word " * 50,
]


def direct(text):
    return load(PATH).encode(text, add_special_tokens=False).ids


def test_cached_encoding_equals_the_library():
    bpe = ByteBpe(PATH, cache_words=5)
    for group in (TEXTS, TEXTS[::-1], TEXTS, ["x"] + TEXTS, [" "], [""], []):
        texts = pa.array(group, pa.string()).slice(1) if group[:1] == ["x"] else pa.array(group, pa.string())
        ids, lengths = bpe.encode(texts)
        cuts = np.split(ids, np.cumsum(lengths)[:-1]) if group else []
        assert [c.tolist() for c in cuts] == [direct(t) for t in texts.to_pylist()]


def test_batches_are_bounded():
    texts = ["a" * 40, "b" * 70, None, "", "c" * 500, "d" * 30, "e" * 30]
    part = pa.record_batch([pa.array(range(7)), pa.array([t or "" for t in texts])], ["_id", "_text"])
    got = [b.column("_id").to_pylist() for b in batches([part, part.slice(0, 0)], "_text", 100)]
    assert got == [[0], [1, 2, 3], [4], [5, 6]]


def test_very_long_text():
    rng = np.random.default_rng(2)
    long = " ".join(f"word{n}" for n in rng.integers(0, 3000, 200_000)) + " " * 1000 + "x" * 100_000
    ids, lengths = ByteBpe(PATH).encode(pa.array([long, "end"]))
    assert ids[: lengths[0]].tolist() == direct(long) and ids[lengths[0] :].tolist() == direct("end")


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
def test_matrix_against_plain_list(n):
    ids = np.random.default_rng(n).integers(0, 40, n).astype(np.uint16)
    m = wavelet.WaveletMatrix.build(ids, 6)
    assert m.decode().tolist() == ids.tolist()
    for i in range(0, n, 97):
        assert m.access(i) == ids[i]
    for token in (0, 7, 39, 63, 64):
        places = np.flatnonzero(ids == token).tolist()
        assert m.rank(token) == len(places)
        assert m.rank(token, n // 2) == sum(p < n // 2 for p in places)
        assert [m.select(token, k) for k in range(len(places))] == places
    with pytest.raises(IndexError):
        m.select(63, 0)


def test_shards_round_trip(spark, tmp_path):
    rows = [(i * 3 % 11, text, "x", 1) for i, text in enumerate(TEXTS)]
    rows += [(None, "no id", "x", 1), (5, None, None, None), (5, "five", "a", 2), (5, "five", "a", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, part string, start long")
    path = str(tmp_path / "shards")
    wavelet.write(docs, path, PATH, shard_tokens=20)
    assert wavelet.shards(spark, path).count() > 3
    got = sorted(wavelet.documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got][0] is None and len(got) == len(rows)
    known = [r.doc_id for r in got][1:]
    assert known == sorted(known)
    want = sorted(
        ((-1 if r[0] is None else r[0]), zlib.crc32(np.array([*direct(r[1] or ""), 2], "<u4").tobytes())) for r in rows
    )
    assert sorted(((-1 if r.doc_id is None else r.doc_id), r.ids_crc32) for r in got) == want
    start = 0
    for r in got:
        assert r.start == start
        start += r.n_tokens
    whole = {r.place: r.token for r in wavelet.tokens_at(spark, path, range(start + 5)).collect()}
    assert len(whole) == start
    tokens = [whole[i] for i in range(start)]
    assert {r.token: r.n for r in wavelet.counts(spark, path, [2, 220, 50300]).collect()} == {
        2: tokens.count(2), 220: tokens.count(220), 50300: 0,
    }
    ends = {(r.doc_id, r.place) for r in wavelet.occurrences(spark, path, 2).collect()}
    assert ends >= {(r.doc_id, r.n_tokens - 1) for r in got}


def test_many_equal_rows_fill_several_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wavelet, "PARTITION_CHARACTERS", 500)
    rows = [(None, "one text many times")] * 300 + [(7, "seven")]
    path = str(tmp_path / "equal")
    wavelet.write(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, PATH)
    assert wavelet.shards(spark, path).select("part").distinct().count() > 5
    got = sorted(wavelet.documents(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [None] * 300 + [7] and len({r.ids_crc32 for r in got}) == 2
    assert got[-1].start == 300 * got[0].n_tokens


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    path = str(tmp_path / "none")
    wavelet.write(docs, path, PATH)
    assert wavelet.documents(spark, path).count() == 0
    assert wavelet.counts(spark, path, [2]).collect() == []
