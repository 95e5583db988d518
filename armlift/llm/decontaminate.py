"""Benchmark decontamination by SimHash over item-sized windows, in SQL expressions only.

1. Windows.  A text's five-word shingles meet the items' by hash; each meeting lays a window as long
   as the item where the item would begin.  A window that shares no shingle has similarity zero.
2. Fingerprints.  Windows and items get a 64-bit SimHash of their words.
3. Multi-index.  Fingerprints are cut into ``BLOCKS``; of two within ``RADIUS`` bits at least one block
   differs by at most one bit, so items are keyed by each block and its one-bit changes, and windows
   by their blocks alone.  No pair within the radius is missed.  It holds more than nine in ten of the
   windows at a similarity of just 0.8 (``tests/llm/test_decontaminate.py`` measures it), and nearly all
   closer ones.
4. Completion.  A window of the wanted similarity holds so many of an item's shingles that it holds at
   least one of any few of them (a fifth at 0.8).  Items are keyed by the few that the fewest items
   have, and windows by all of theirs.  That finds the pairs beyond the radius too, so none is missed.
5. Verification.  Candidates are compared by their shingles with multiplicities: the sum of the lesser
   counts over the sum of the larger ones.  Windows of equal words are fingerprinted and compared once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from armlift.llm.common import small, stored

SHINGLE = 5
SIMILARITY = 0.8
#: First bit and bits of each block of a fingerprint.
BLOCKS = ((0, 10), (10, 9), (19, 9), (28, 9), (37, 9), (46, 9), (55, 9))
#: With two differing bits in every block but one, and one in that, some block has at most one.
RADIUS = 2 * len(BLOCKS) - 1


def _words(text: Column) -> Column:
    """Letter and digit runs of the lower-cased text."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _shingle_hashes(words: str) -> Column:
    n = F.size(words)
    return F.when(n < SHINGLE, F.array().cast("array<bigint>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), n - SHINGLE),
            lambda i: F.xxhash64(*(F.get(F.col(words), i + k) for k in range(SHINGLE))),
        )
    )


def _shingles(words: Column) -> Column:
    """The shingles themselves, of at least ``SHINGLE`` words."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - SHINGLE + 1), lambda i: F.array_join(F.slice(words, i, SHINGLE), " ")
    )


def _simhash(words: str) -> Column:
    """64-bit SimHash of the words, each weighing as often as it occurs."""
    return F.expr(
        f"""
        element_at(transform(array(transform({words}, w -> xxhash64(w))), hs ->
          aggregate(sequence(0, 63), 0L, (fp, b) -> fp | CASE WHEN
            2 * aggregate(hs, 0, (n, h) -> n + cast(shiftright(h, b) & 1L AS int)) > size(hs)
            THEN shiftleft(1L, b) ELSE 0L END)), 1)
        """
    )


def _block(fp: str, block: tuple[int, int]) -> Column:
    at, width = block
    return F.expr(f"shiftrightunsigned({fp}, {at}) & {(1 << width) - 1}L")


def _key(number: int, value: Column) -> Column:
    return F.lit(number).cast("long") * 4096 + value


def items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id``, ``item_words``, ``n`` and ``item`` (a hash of the words) of items with at least one shingle."""
    return (
        benchmark.select(F.col("item_id"), _words(F.col("text")).alias("item_words"))
        .withColumn("n", F.size("item_words"))
        .where(F.col("n") >= SHINGLE)
        .withColumn("item", F.xxhash64("item_words"))
    )


def _keys(items: DataFrame, similarity: float) -> DataFrame:
    """``h``, ``item``: of each item the rarest shingles, as many as no similar window lacks all of.

    A window of similarity s has at least s t of the item's t shingles, counted as often as they occur
    there, so of any t - s t + 1 it has one.
    """
    places = items.dropDuplicates(["item"]).select("item", "n", F.explode(_shingle_hashes("item_words")).alias("h"))
    held = places.groupBy("h").agg(F.countDistinct("item").alias("held"))
    rare = Window.partitionBy("item").orderBy("held", "h")
    t = F.col("n") - (SHINGLE - 1)
    least = F.ceil(F.lit(similarity) * t - F.lit(1e-9))
    ranked = places.join(held, "h").withColumn("at", F.row_number().over(rare))
    return ranked.where(F.col("at") <= t - least + 1).select("h", "item").distinct()


def _by_fingerprint(windows: DataFrame, items: DataFrame) -> DataFrame:
    """``window`` and ``item`` of all pairs whose fingerprints are within the radius."""
    flips = [
        _key(k, _block("item_fp", block).bitwiseXOR(F.lit(flip)))
        for k, block in enumerate(BLOCKS)
        for flip in (0, *(1 << b for b in range(block[1])))
    ]
    keyed = items.dropDuplicates(["item"]).select("item", _simhash("item_words").alias("item_fp"))
    keyed = stored(keyed.select("item", "item_fp", F.explode(F.array(*flips)).alias("key")), "benchmark-blocks")
    own = F.array(*(_key(k, _block("fp", block)) for k, block in enumerate(BLOCKS)))
    return (
        windows.select("window", "fp", F.explode(own).alias("key"))
        .join(small(keyed), "key")
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= RADIUS)
        .select("window", "item")
    )


def _by_rare_shingles(windows: DataFrame, items: DataFrame, similarity: float) -> DataFrame:
    """``window`` and ``item`` of all pairs that share one of the item's rarest shingles."""
    keys = stored(_keys(items, similarity), "benchmark-keys")
    held = windows.select("window", F.explode(F.array_distinct(_shingle_hashes("words"))).alias("h"))
    return held.join(small(keys), "h").select("window", "item")


def _windows(rows: DataFrame, items: DataFrame) -> DataFrame:
    """``_id``, ``_hash``, ``windows`` (first word and length) of the rows that share a shingle."""
    places = items.select("n", F.posexplode(_shingle_hashes("item_words")).alias("offset", "h")).distinct()
    seen = rows.select("_id", "_hash", _words(F.col("_text")).alias("_words")).select(
        "_id", "_hash", F.size("_words").alias("size"), F.posexplode(_shingle_hashes("_words")).alias("at", "h")
    )
    begin = F.greatest(F.lit(0), F.least(F.col("at") - F.col("offset"), F.col("size") - F.col("n")))
    return (
        seen.join(small(places), "h")
        .select("_id", "_hash", begin.alias("begin"), F.col("n").alias("length"))
        .groupBy("_id", "_hash")
        .agg(F.collect_set(F.struct("begin", "length")).alias("windows"))
    )


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(text).alias("_hash"), text.alias("_text"))


def _leaks(docs: DataFrame, benchmark: DataFrame, similarity: float) -> DataFrame:
    rows, items = _rows(docs), stored(items_of(benchmark), "benchmark-items")
    windows = stored(_windows(rows, items), "benchmark-windows")
    same = F.col("r._id").eqNullSafe(F.col("w._id")) & (F.col("r._hash") == F.col("w._hash"))
    touched = rows.alias("r").join(small(windows.select("_id", "_hash")).alias("w"), same, "left_semi")
    laid = (
        touched.alias("r")
        .join(windows.alias("w"), same)
        .select("r._id", "r._hash", "windows", _words(F.col("_text")).alias("_words"))
        .select(
            "_id",
            "_hash",
            F.explode(
                F.transform(
                    "windows",
                    lambda w: F.struct(w.begin.alias("begin"), F.slice("_words", w.begin + 1, w.length).alias("words")),
                )
            ).alias("window"),
        )
        .select("_id", "_hash", "window.begin", F.size("window.words").alias("length"), "window.words")
        .withColumn("window", F.xxhash64("words"))
    )
    laid = stored(laid, "benchmark-laid")
    different = laid.select("window", "words").dropDuplicates(["window"]).withColumn("fp", _simhash("words"))
    different = stored(different, "benchmark-different")
    met = _by_fingerprint(different, items).unionByName(_by_rare_shingles(different, items, similarity)).distinct()
    mine, theirs = _shingles(F.col("words")), _shingles(F.col("item_words"))
    common = F.expr(
        "aggregate(array_intersect(mine, theirs), 0, (n, x) -> n + "
        "least(size(filter(mine, y -> y = x)), size(filter(theirs, y -> y = x))))"
    )
    # No more can be common than what either side has of shingles that the other has too.
    bound = F.least(
        F.size("mine") - F.size(F.array_except("mine", "theirs")), F.size("theirs") - F.size(F.array_except("theirs", "mine"))
    )
    likes = (
        met.join(different.select("window", "words"), "window")
        .join(items.dropDuplicates(["item"]).select("item", "item_words"), "item")
        .select("window", "item", mine.alias("mine"), theirs.alias("theirs"))
        .where(bound >= similarity * (F.size("mine") + F.size("theirs") - bound))
        .withColumn("common", common)
        .withColumn("similarity", F.col("common") / (F.size("mine") + F.size("theirs") - F.col("common")))
        .where(F.col("similarity") >= similarity)
        .select("window", "item", "similarity")
    )
    likes = stored(likes, "benchmark-likes")
    return (
        laid.select("_id", "_hash", "begin", "length", "window")
        .join(small(likes), "window")
        .groupBy("_id", "_hash", "item")
        .agg(F.max(F.struct("similarity", -F.col("begin"), "length")).alias("best"))
        .join(items.select("item", "item_id").distinct(), "item")
        .select("_id", "_hash", "item_id", "best.similarity", (-F.col("best.col2")).alias("first_word"), "best.length")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id``, ``item_id``, ``similarity``, ``first_word`` and ``length`` of each item's best window.

    Words are letter and digit runs of the lower-cased text, counted from 0.  Texts and items of
    fewer than five words have no shingle and match nothing; a NULL text is empty.  Rows equal in
    id and text are one document, rows of one id with other texts are told apart; a NULL ``doc_id``
    or ``item_id`` is returned as it is.  Of windows with the same best similarity the first wins, and
    the longer of two there.  Texts of any length are read in full.  Empty tables give no rows, further
    columns are ignored.
    """
    found = _leaks(docs, benchmark, similarity)
    return found.select(F.col("_id").alias("doc_id"), "item_id", "similarity", "first_word", "length")


def clean(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item leaks (:func:`leaks`, also for odd rows)."""
    dirty = stored(_leaks(docs, benchmark, similarity).select("_id", "_hash").distinct(), "benchmark-dirty")
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"),
        F.col("doc_id").cast("long").alias("_id"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash"),
    )
    same = F.col("r._id").eqNullSafe(F.col("d._id")) & (F.col("r._hash") == F.col("d._hash"))
    return rows.alias("r").join(small(dirty).alias("d"), same, "left_anti").select("_row.*")
