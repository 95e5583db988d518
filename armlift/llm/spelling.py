"""Grouping of spelling variants by asymmetric chunks, in SQL expressions only.

Two words are near if one inserted, deleted or replaced letter makes one of the other.  To find such
pairs, a word of L letters contributes two disjoint chunks, its first and its last L // 2 letters; a word
of L or L + 1 letters contributes its positional grams of that size.  One edit leaves one of the two
chunks whole, and moves it by one place at most; so near words meet in an equality join of chunk and gram
within a shift of one, and those that meet are verified by their edit distance.

Words that share a chunk differ in the rest.  Where a chunk is so common that its pairs would outnumber
the letters of its words, its words are joined by what an edit leaves of that rest instead (a letter
masked, or left out of the longer word): as many rows as the words have letters, and only near pairs
meet.  Neither way loses a pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from armlift.llm.common import lower_ascii, stored

#: Letters of a word: A-Z, a-z and U+00C0 to U+00FF.
RUN = "[A-Za-zÀ-ÿ]+"
MIN_LETTERS = 6
MIN_COUNT = 5
#: A form has at least so many times the occurrences of the word it corrects.
DOMINANCE = 5
#: One run in so many, by its checksum, loses a letter before words are counted.
SLIP = 199
#: Stands for a shared chunk or a masked letter; no letter of a word.
CHUNK, MASK = "\u0001", "\u0002"


def word_counts(docs: DataFrame, slip: int | None = SLIP) -> DataFrame:
    """``word`` and ``n`` (occurrences) of all runs of letters of all texts, A-Z lower-cased.

    With ``slip`` a run whose CRC-32 of ``<doc_id>:<run>`` it divides loses the letter at that checksum
    modulo the run's length.  A NULL text holds no run, a NULL ``doc_id`` is written as nothing.
    """
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    runs = docs.select(
        name.alias("_doc"), F.explode(F.regexp_extract_all(lower_ascii(F.col("text")), F.lit(RUN), F.lit(0))).alias("run")
    )
    if slip is None:
        return runs.groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n"))
    marked = runs.select("run", F.crc32(F.concat("_doc", F.lit(":"), "run")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    return (
        marked.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("run")).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def _piece(begin: Column, size: Column) -> Column:
    """Key and rest of a word that has a chunk or gram of ``size`` letters after ``begin`` others."""
    tail = begin + size + 1
    return F.struct(
        F.substring("word", begin + 1, size).alias("gram"),
        F.concat(F.substring("word", F.lit(1), begin), F.lit(CHUNK), F.substring("word", tail, F.col("len"))).alias("rest"),
    )


def _labelled(side: Column, chunk_len: Column, which: int) -> Column:
    return F.struct(chunk_len.alias("size"), F.lit(which).alias("which"), side.gram.alias("gram"), side.rest.alias("rest"))


def _chunks(words: DataFrame) -> DataFrame:
    """Two disjoint chunks of every word."""
    half = F.floor(F.col("len") / 2).cast("int")
    first, last = _piece(F.lit(0), half), _piece(F.col("len") - half, half)
    both = F.array(_labelled(first, F.col("len"), 0), _labelled(last, F.col("len"), 1))
    return words.select("word", "n", "len", F.explode(both).alias("c")).select("word", "n", "len", "c.*")


def _grams(words: DataFrame) -> DataFrame:
    """The positional grams within a shift of one of the chunks of words as long, or shorter by a letter."""
    found = []
    for less, shifts in ((0, (0,)), (1, (0, 1))):
        chunk_len = F.col("len") - less
        half = F.floor(chunk_len / 2).cast("int")
        for shift in shifts:
            for which, begin in ((0, F.lit(shift)), (1, chunk_len - half + shift)):
                found.append(_labelled(_piece(begin, half), chunk_len, which))
    rows = words.select("word", "n", "len", F.explode(F.array(*found)).alias("c")).select("word", "n", "len", "c.*")
    return rows.where(F.col("size") >= 2)


KEY = ["size", "which", "gram"]


def _edits(rest: Column, longer: Column) -> Column:
    """What one edit leaves of a rest: a letter masked, or left out of the longer word's."""
    places = F.sequence(F.lit(1), F.length(rest))
    masked = F.transform(
        places,
        lambda i: F.concat(
            F.substring(rest, F.lit(1), i - 1), F.when(longer, F.lit("")).otherwise(F.lit(MASK)), F.substring(rest, i + 1, F.length(rest))
        ),
    )
    return F.array_distinct(F.filter(masked, lambda edit: F.instr(edit, CHUNK) > 0))


def near_pairs(words: DataFrame) -> DataFrame:
    """``a`` and ``b`` of ``word`` (distinct, with ``n``) at one edit, each pair once, with ``na`` and ``nb``."""
    words = words.select("word", "n", F.length("word").alias("len"))
    chunks = stored(_chunks(words), "spelling-chunks")
    met = chunks.groupBy(*KEY).agg(F.count("*").alias("chunks"))
    grams = stored(_grams(words).join(met.select(*KEY), KEY, "left_semi"), "spelling-grams")
    sizes = met.join(grams.groupBy(*KEY).agg(F.count("*").alias("grams")), KEY)
    pairs, letters = F.col("chunks") * F.col("grams"), (F.col("chunks") + F.col("grams")) * F.col("size")
    buckets = stored(sizes.select(*KEY, (pairs > letters).alias("crowded")), "spelling-buckets")
    a = chunks.select(*KEY, F.col("word").alias("a"), F.col("n").alias("na"), F.col("len").alias("la"), F.col("rest").alias("ra"))
    b = grams.select(*KEY, F.col("word").alias("b"), F.col("n").alias("nb"), F.col("len").alias("lb"), F.col("rest").alias("rb"))
    once = (F.col("la") < F.col("lb")) | (F.col("a") < F.col("b"))
    few, crowd = buckets.where("NOT crowded").select(*KEY), buckets.where("crowded").select(*KEY)
    sparse = (
        a.join(few, KEY, "left_semi")
        .join(b, KEY)
        .where(once)
        .where(F.levenshtein("a", "b", 1) == 1)
        .select("a", "b", "na", "nb")
    )
    same = [a.join(crowd, KEY, "left_semi"), b.join(crowd, KEY, "left_semi")]
    whole = F.array("ra")
    left = same[0].select(
        *KEY, "a", "na", "la", F.explode(F.concat(_edits(F.col("ra"), F.lit(False)), whole)).alias("edit")
    )
    right = same[1].select(
        *KEY, "b", "nb", "lb", F.explode(_edits(F.col("rb"), F.col("lb") > F.col("size"))).alias("edit")
    )
    dense = left.join(right, [*KEY, "edit"]).where(once).select("a", "b", "na", "nb")
    return sparse.unionByName(dense).dropDuplicates(["a", "b"])


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root`` for every word with a form: forms followed to the last, by doubling steps.

    A form has several times the occurrences of its word, so no chain is longer than the logarithm of the
    most frequent word's occurrences and none closes.
    """
    steps = stored(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        steps = stored(
            steps.join(ahead, "root", "left").select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "spelling-steps",
        )
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def variants(
    docs: DataFrame,
    min_letters: int = MIN_LETTERS,
    min_count: int = MIN_COUNT,
    dominance: int = DOMINANCE,
    slip: int | None = SLIP,
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every word of ``docs``.

    Words are the distinct runs of letters of whole texts with at least so many letters (four or more)
    and occurrences; counts are over all documents.  ``form`` is the near word with most occurrences (ties:
    the smallest in code-point order) if it has ``dominance`` times the word's, else NULL; ``root`` follows
    forms to the last.  NULL and empty texts hold no words, rows repeated in full count as often as they
    stand there, a text of any length is read in full, an empty table gives no rows, and further columns
    are ignored.
    """
    if min_letters < 4:
        raise ValueError("two chunks need words of at least four letters")
    words = word_counts(docs, slip).where((F.length("word") >= min_letters) & (F.col("n") >= min_count))
    words = stored(words, "spelling-words")
    pairs = stored(near_pairs(words), "spelling-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    found = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.col("best.near").alias("near"), (-F.col("best.col1")).alias("near_n"),
    )
    rules = F.col("near_n") >= dominance * F.col("n")
    judged = found.select(
        "word", "n", "n_near", F.when(rules, F.col("near")).alias("form"), F.when(rules, F.col("near_n")).alias("form_n")
    )
    judged = stored(judged, "spelling-judged")
    roots = _roots(judged.where("form IS NOT NULL").select("word", "form"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
