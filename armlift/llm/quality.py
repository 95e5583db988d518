"""Quality rules: a table of thresholds compiled into one projection of SQL expressions.

Every measure is an expression over the text, every rule a pair of bounds on a ratio of two
measures.  ``assess`` builds all of them into one projection per row: no user function, no shuffle,
and a rule is added by adding a line to ``RULES``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from armlift.llm.common import words


class Rule(NamedTuple):
    """``low <= numerator / denominator <= high``, both included; an empty denominator passes."""

    name: str
    numerator: str
    denominator: str
    low: float | None
    high: float | None


#: Frequent function words by language, in lower case (fixed values).
STOP_WORDS = {
    "en": "the of and to in that is was for it with as on be at by this from or are an not".split(),
    "de": "der die und das den von zu mit sich des auf für ist im dem nicht ein eine als auch".split(),
    "es": "de la que el en y los se del las un por con una su para al lo como más".split(),
    "fr": "le les et des est dans qui pas une sur au ce il du pour par plus avec de la un en".split(),
}
#: What is stripped from both ends of a word before it is looked up.
MARKS = ".,;:!?\"'()[]«»„“”…-"

MIN_WORDS = 10
#: Percent of words in repeated windows above which a text fails.
MAX_REPEAT_PERCENT = 20
WINDOW = 5

RULES = (
    Rule("word_length", "word_chars", "n_words", 2.0, 25.0),
    Rule("symbols", "n_symbols", "n_words", None, 0.25),
    Rule("stop_words", "n_stop_words", "n_served_words", 0.02, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 0.5),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 0.9),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 0.3),
)


def _repeat_words() -> Column:
    """Words inside windows that occur twice or more, from the window hashes ``_grams``.

    Equal hashes become neighbours when sorted with their places; the places of windows that have
    an equal neighbour, in order, then give the covered words as a running sum of gaps of at most
    a window.  n log n in the words of one text; texts without a repeated window stop at the count.
    """
    covered = F.expr(
        f"""
        element_at(transform(
          array(array_sort(flatten(transform(
            array(sort_array(transform(_grams, (h, i) -> struct(h AS h, i AS i)))),
            s -> transform(
              filter(s, (e, k) -> (get(s, k - 1).h <=> e.h) OR (get(s, k + 1).h <=> e.h)),
              e -> e.i))))),
          p -> aggregate(p, struct(0L AS n, -{WINDOW} AS last),
                 (a, i) -> struct(a.n + least({WINDOW}, i - a.last) AS n, i AS last), a -> a.n)), 1)
        """
    )
    return F.when(F.size(F.array_distinct("_grams")) == F.size("_grams"), F.lit(0)).otherwise(covered)


def _is_stop_word(word: Column, lang: Column) -> Column:
    """Whether a word, without marks and case, is a function word of the language."""
    bare = F.lower(F.btrim(word, F.lit(MARKS)))
    found = F.lit(False)
    for language, listed in STOP_WORDS.items():
        found = found | ((lang == language) & bare.isin(*listed))
    return found


def measures(rows: DataFrame) -> DataFrame:
    """``_carry`` as it is and every measure the rules use, per row of (``_carry``, ``_text``, ``_lang``).

    ``n_stop_words`` are function words of the row's language; ``n_served_words`` are its words if that
    language has a list, else none.
    """
    split = rows.select(
        "_carry",
        "_text",
        "_lang",
        words(F.col("_text")).alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    hashed = split.withColumn(
        "_grams",
        F.when(F.size("_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), F.size("_words") - WINDOW),
                lambda i: F.xxhash64(*(F.get(F.col("_words"), i + k) for k in range(WINDOW))),
            )
        ),
    )
    count = {
        "n_words": F.size("_words"),
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": F.regexp_count("_text", F.lit(r"[#*$%&|<>]")),
        "n_stop_words": F.size(F.filter("_words", lambda w: _is_stop_word(w, F.col("_lang")))),
        "n_served_words": F.when(F.col("_lang").isin(*STOP_WORDS), F.size("_words")).otherwise(0),
        "n_lines": F.size("_lines"),
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_bullet_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"^\s*[-*•]"))),
        "n_ellipsis_lines": F.size(F.filter("_lines", lambda x: x.rlike(r"(\.\.\.|…)\s*$"))),
        "n_repeat_words": _repeat_words(),
    }
    return hashed.select("_carry", *(c.cast("long").alias(n) for n, c in count.items()))


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True where every rule of the table holds."""
    holds = F.lit(True)
    for rule in rules:
        top, bottom = F.col(rule.numerator), F.col(rule.denominator)
        ratio = top / F.nullif(bottom, F.lit(0))
        if rule.low is not None:
            holds &= F.coalesce(ratio >= rule.low, F.lit(True))
        if rule.high is not None:
            holds &= F.coalesce(ratio <= rule.high, F.lit(True))
    return holds


def _judged(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        measures(rows)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & verdict(rules))
    )


def _read(docs: DataFrame) -> list[Column]:
    """The text, and the language where the table has one."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")
    return [F.coalesce("text", F.lit("")).alias("_text"), lang.alias("_lang")]


def assess(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs``: the measures, ``base_failed`` and ``kept``.

    The rule of function words holds for rows whose ``lang`` has a list in ``STOP_WORDS``; others, and rows
    or tables without a language, pass it.  A NULL or empty text has no words, fails the length base
    and is not kept.  A NULL id is returned as it is, equal rows are judged alike, a text of any length
    is measured in full, a ratio that ties with a bound passes, an empty table gives no rows, and further
    columns are ignored.  Windows are compared by 64-bit hash within one text.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("_carry"), *_read(docs))
    return _judged(rows, rules).withColumnRenamed("_carry", "doc_id")


def keep(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that ``assess`` keeps, with all their columns; otherwise as there.

    The one-element explode is a barrier: a filter right on the measures would be pushed below them
    and take their expressions along, to be evaluated again for every word.
    """
    rows = docs.select(F.struct(*docs.columns).alias("_carry"), *_read(docs))
    judged = _judged(rows, rules).select("_carry", F.explode(F.array("kept")).alias("_kept"))
    return judged.where("_kept").select("_carry.*")
