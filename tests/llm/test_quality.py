from armlift.llm import quality

SCHEMA = "doc_id long, text string, lang string, kept int, n_words string"
ENGLISH = "The committee met on Monday and was asked to report on the state of its work in the autumn."
POLISH = "Komitet zebrał się w poniedziałek i został poproszony o przedstawienie stanu swoich prac jesienią tego roku."
JAPANESE = "委員会は 月曜日に 集まりました 秋の 作業状況を 報告するよう 求められました 会議は 三時間 続いて 夕方に 終わりました"
JUNK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def judged(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = quality.assess(docs).collect()
    kept = quality.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in kept.collect()) == sorted(repr(r.doc_id) for r in got if r.kept)
    return got


def test_stop_words_by_language(spark):
    rows = [(1, ENGLISH, "en"), (2, POLISH, "pl"), (3, JAPANESE, "ja"), (4, JUNK, "en"), (5, JUNK, None), (6, ENGLISH.upper(), "en")]
    rows += [(7, "«Der» " + JUNK, "de"), (8, "«Der» " + JUNK, "en")]
    assert {r.doc_id: r.kept for r in judged(spark, rows)} == {
        1: True, 2: True, 3: True, 4: False, 5: True, 6: True, 7: True, 8: False,
    }


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", None), (3, " \n\t ", "en"), (None, ENGLISH, "en"), (None, ENGLISH, "en"), (4, ENGLISH, "xx")]
    got = judged(spark, rows)
    assert sorted((r.doc_id or 0, r.n_words, r.base_failed, r.kept) for r in got) == [
        (0, 19, False, True), (0, 19, False, True), (1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (4, 19, False, True),
    ]
    assert quality.assess(spark.createDataFrame([], SCHEMA)).count() == 0
    assert quality.keep(spark.createDataFrame([], SCHEMA)).count() == 0
    bare = spark.createDataFrame([(1, ENGLISH)], "doc_id long, text string")
    assert quality.assess(bare).first().kept


def test_bounds_are_included(spark):
    """Exactly the largest share of symbols passes, one more does not."""
    words = ["the"] + [f"word{i}" for i in range(39)]
    at, over = " ".join(words) + "#" * 10, " ".join(words) + "#" * 11
    assert {r.doc_id: r.kept for r in judged(spark, [(1, at, "en"), (2, over, "en")])} == {1: True, 2: False}


def test_very_long_text(spark):
    text = " ".join(f"w{i} the" for i in range(100_000))
    got = judged(spark, [(1, text, "en"), (2, "x" * 1_000_000, "en"), (3, "same words again and again " * 40_000, "en")])
    assert {r.doc_id: (r.n_words, r.kept) for r in got} == {1: (200_000, True), 2: (1, False), 3: (200_000, False)}


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame([(1, ENGLISH, "en", 1, "x")], SCHEMA)
    for df in (quality.assess(docs), quality.keep(docs)):
        text = df._jdf.queryExecution().toString()
        assert "Python" not in text and "Arrow" not in text and "Exchange" not in text
