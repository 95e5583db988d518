"""Language-model scores by prediction by partial matching over bytes.

The model is a trie of byte contexts up to ``ORDER`` bytes, trained on part of the corpus.  A byte is
predicted in its longest context; if that never led to it, the escape probability is paid (method C:
distinct successors over occurrences plus distinct successors) and the next shorter context is asked,
with the successors of the longer one excluded.  Below order 0 all byte values not yet excluded are
equally likely.  A text starts behind ``ORDER`` start marks and ends with an end mark.

Because counts of a context contain those of every longer one, a context's exclusions are exactly the
successors of the context one byte longer.  So a probability depends on the last ``ORDER`` bytes and
the byte alone, and on three sums a context: occurrences, distinct successors, and occurrences of the
excluded ones.  Spark computes it once for every distinct gram of the corpus, by joins on contexts.

Documents are dealt to blocks by hash, each of a bounded number of characters.  A block's distinct
grams and words are joined with the corpus's figures and come back to the block as a table of its own,
in front of its documents.  No model or vocabulary is broadcast or collected, a task holds what one
block needs, and all of it counts over the whole corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from armlift.llm.common import stored, texts
from armlift.sources.tables import drop_path, new_path

ORDER = 4
START, END = 0xFE, 0xFF  # bytes that UTF-8 never contains
ALPHABET = 256
BLOCK_CHARACTERS = 20_000_000
FOLD = 1 << 22
FOLDS, HELD_OUT = 7, 2
#: Stands for the end token among a block's words; no word holds a space.
END_TOKEN = b" "


def held_out(doc_id: Column) -> Column:
    """Documents the model never learns from: crc32 of the id as text, modulo ``FOLDS``."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def grams(text: bytes) -> np.ndarray:
    """The last ``ORDER`` bytes and the byte, packed into an integer, at every place of a text."""
    whole = np.frombuffer(bytes([START]) * ORDER + text + bytes([END]), np.uint8)
    n = len(text) + 1
    packed = np.zeros(n, np.int64)
    for k in range(ORDER + 1):
        packed <<= 8
        packed |= whole[k : k + n]
    return packed


def _blocks(docs: DataFrame) -> int:
    size = texts(docs).agg(F.sum(F.char_length("_text"))).first()[0] or 0
    return max(1, -(-size // BLOCK_CHARACTERS))


def _blocked(docs: DataFrame, blocks: int) -> DataFrame:
    """``block``, ``doc_id``, ``held``, ``text`` (bytes) of every row."""
    return texts(docs).select(
        F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)).cast("int").alias("block"),
        F.col("_id").alias("doc_id"),
        held_out(F.col("_id")).alias("held"),
        F.col("_text").cast("binary").alias("text"),
    )


class _Grams:
    """Distinct grams and their counts, folded together every ``FOLD`` places."""

    def __init__(self) -> None:
        self.keys, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.held: list[np.ndarray] = []
        self.size = 0

    def add(self, found: np.ndarray) -> None:
        self.held.append(found)
        self.size += len(found)
        if self.size >= FOLD:
            self.fold()

    def fold(self) -> None:
        new, n = np.unique(np.concatenate([self.keys[:0], *self.held]), return_counts=True)
        self.held, self.size = [], 0
        keys, at = np.unique(np.concatenate([self.keys, new]), return_inverse=True)
        self.counts = np.bincount(at, np.concatenate([self.counts, n]), len(keys)).astype(np.int64)
        self.keys = keys


def _inventory(dealt: DataFrame) -> DataFrame:
    """Per block: its distinct ``word`` or ``gram``, with ``n`` occurrences in documents learnt from."""
    names = ["block", "word", "gram", "n"]

    def batch(block: int, words: list, packed: np.ndarray, n) -> pa.RecordBatch:
        size = len(words) + len(packed)
        columns = [
            pa.array(np.full(size, block, np.int32)),
            pa.array(words, pa.binary()) if words else pa.nulls(size, pa.binary()),
            pa.nulls(size, pa.int64()) if words else pa.array(packed, pa.int64()),
            pa.array(n, pa.int64()),
        ]
        return pa.record_batch(columns, names)

    def emit(block: int, words: list[Counter], packed: list[_Grams]) -> Iterator[pa.RecordBatch]:
        learnt, none = words[0], np.zeros(0, np.int64)
        yield batch(block, list(learnt), none, list(learnt.values()))
        other = list(words[1].keys() - learnt.keys())
        yield batch(block, other, none, [0] * len(other))
        for grams_ in packed:
            grams_.fold()
        yield batch(block, [], packed[0].keys, packed[0].counts)
        other = np.setdiff1d(packed[1].keys, packed[0].keys, assume_unique=True)
        yield batch(block, [], other, np.zeros(len(other), np.int64))

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, packed = None, [], []
        for part in parts:
            numbers, held = part.column("block").to_pylist(), part.column("held").to_pylist()
            for number, out, text in zip(numbers, held, part.column("text")):
                if number != block:
                    if block is not None:
                        yield from emit(block, words, packed)
                    block, words, packed = number, [Counter(), Counter()], [_Grams(), _Grams()]
                low = text.as_py().lower()
                words[out].update(low.split())
                packed[out].add(grams(low))
        if block is not None:
            yield from emit(block, words, packed)

    return dealt.mapInArrow(each, "block int, word binary, gram long, n long")


def _suffix(gram: str, order: int) -> Column:
    """The gram less its oldest bytes: ``order`` context bytes and the byte."""
    return F.col(gram).bitwiseAND(F.lit((1 << (8 * (order + 1))) - 1))


def _context(gram: str) -> Column:
    return F.shiftrightunsigned(gram, 8)


def _bounded(df: DataFrame, size: int) -> DataFrame:
    """For broadcast if its keys have at most two bytes, so at most 65,536 rows."""
    return F.broadcast(df) if size <= 2 else df


def probabilities(seen: DataFrame) -> DataFrame:
    """``gram`` and ``log10`` for every row of ``seen`` (``gram``, ``n`` in texts learnt from).

    Sums of every order come from the counts of the order above; orders join on the context's bytes.
    """
    counts: dict[int, DataFrame] = {}
    sums: dict[int, DataFrame] = {}
    level = seen.where("n > 0").select("gram", "n")
    for order in range(ORDER, -1, -1):
        if order < ORDER:
            level = level.select(_suffix("gram", order).alias("gram"), "n").groupBy("gram").agg(F.sum("n").alias("n"))
            level = stored(level, f"ppm-order{order}")
        counts[order] = level
        sums[order] = level.groupBy(_context("gram").alias("context")).agg(
            F.sum("n").alias(f"t{order}"), F.count("*").alias(f"d{order}")
        )
    for order in range(ORDER, 0, -1):
        # Occurrences, one order down, of the successors of a context of this order.
        down = counts[order - 1].select(F.col("gram").alias("short"), F.col("n").alias("m"))
        excluded = (
            counts[order]
            .select(_context("gram").alias("context"), _suffix("gram", order - 1).alias("short"))
            .join(down, "short")
            .groupBy("context")
            .agg(F.sum("m").alias(f"x{order}"))
        )
        sums[order] = sums[order].join(excluded, "context")
    table = seen.select("gram", F.col("n").alias(f"c{ORDER}"))
    for order in range(ORDER, -1, -1):
        short = _suffix("gram", order)
        if order < ORDER:
            own = counts[order].select(F.col("gram").alias("short"), F.col("n").alias(f"c{order}"))
            table = table.join(_bounded(own, order + 1), short == F.col("short"), "left").drop("short")
        context = F.shiftrightunsigned(short, 8)
        table = table.join(_bounded(sums[order], order), context == F.col("context"), "left").drop("context")

    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).cast("double")
    paid, answer = F.lit(0.0), None
    cases: list[tuple[Column, Column]] = []
    for order in range(ORDER, -1, -1):
        # What is left of the context's successors once those of the longer context are excluded.
        left = zero(f"t{order}") - (zero(f"x{order + 1}") if order < ORDER else F.lit(0.0))
        kinds = zero(f"d{order}") - (zero(f"d{order + 1}") if order < ORDER else F.lit(0.0))
        hit = F.log10(zero(f"c{order}")) - F.log10(left + kinds)
        cases.append((zero(f"c{order}") > 0, paid + hit))
        escape = F.when(kinds > 0, F.log10(kinds) - F.log10(left + kinds)).otherwise(F.lit(0.0))
        paid = paid + escape
    floor = paid - F.log10(F.greatest(F.lit(float(ALPHABET)) - zero("d0"), F.lit(1.0)))
    for test, value in cases:
        answer = F.when(test, value) if answer is None else answer.when(test, value)
    return table.select("gram", answer.otherwise(floor).alias("log10"))


def _lookup(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """An open-addressing table of at least twice the keys' size, filled in rounds."""
    bits = max(4, int(2 * len(keys)).bit_length())
    slots, held = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits)
    todo, at = np.arange(len(keys)), _slot(keys, bits)
    while len(todo):
        free = slots[at] < 0
        slots[at[free]] = keys[todo[free]]
        held[at[free]] = values[todo[free]]
        lost = slots[at] != keys[todo]
        todo, at = todo[lost], (at[lost] + 1) & ((1 << bits) - 1)
    return slots, held, bits


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    mixed = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def _find(keys: np.ndarray, table: tuple[np.ndarray, np.ndarray, int]) -> np.ndarray:
    slots, held, bits = table
    at = _slot(keys, bits)
    wrong = np.flatnonzero(slots[at] != keys)
    while len(wrong):
        at[wrong] = (at[wrong] + 1) & ((1 << bits) - 1)
        wrong = wrong[slots[at[wrong]] != keys[wrong]]
    return held[at]


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scorer(floor: float):
    """``floor``: the price of a word that was never learnt."""
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"]
    types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, keys, prices, table = None, {}, [], [], None
        for part in parts:
            kinds, blocks = part.column("kind").to_numpy(), part.column("block").to_numpy()
            cuts = np.flatnonzero((np.diff(kinds) != 0) | (np.diff(blocks) != 0)) + 1
            rows = []
            for at, upto in zip([0, *cuts], [*cuts, part.num_rows]):
                if at == upto:
                    continue
                run = part.slice(at, upto - at)
                if blocks[at] != block:
                    block, words, keys, prices, table = blocks[at], {}, [], [], None
                if kinds[at] == WORD:
                    words.update(zip(run.column("text").to_pylist(), run.column("price").to_pylist()))
                elif kinds[at] == GRAM:
                    keys.append(run.column("number").to_numpy())
                    prices.append(run.column("price").to_numpy())
                else:
                    if table is None:
                        table = _lookup(np.concatenate(keys), np.concatenate(prices))
                        keys, prices = [], []
                    for doc_id, out, text in zip(*(run.column(n) for n in ("number", "held", "text"))):
                        low = text.as_py().lower()
                        paid = np.array([*map(words.__getitem__, low.split()), words[END_TOKEN]])
                        known = int((paid != floor).sum())
                        score = float(_find(grams(low), table).sum())
                        rows.append((doc_id.as_py(), out.as_py(), len(paid), known, float(paid.sum()), score))
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    return each


WORD, GRAM, DOCUMENT = range(3)


def score(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``held_out``, token counts, unigram ``base_score`` and the model's ``score``.

    Tokens are the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased and one end.  ``score`` is the
    model's log10 probability of the text's bytes and its end.  A NULL or empty text is one end token;
    a NULL id is never held out; equal rows score alike, an empty table gives no rows, and further
    columns are ignored.
    """
    spark = docs.sparkSession
    blocks = _blocks(docs)
    blocked = _blocked(docs, blocks)
    dealt = blocked.select("block", "held", "text").repartitionById(blocks, "block")
    path = new_path(spark, "ppm-inventory")
    _inventory(dealt).withColumn("is_word", F.col("word").isNotNull()).write.partitionBy("is_word").parquet(path)
    inventory = spark.read.schema("block int, word binary, gram long, n long, is_word boolean").parquet(path)
    learnt = blocked.where("NOT held").count()

    everywhere = Window.partitionBy("word")  # one row a block
    counted = inventory.where("is_word").select(
        "block",
        "word",
        "n",
        F.sum("n").over(everywhere).alias("c"),
        (F.min("block").over(everywhere) == F.col("block")).alias("first"),
    )
    counted = stored(counted, "ppm-words")
    drop_path(spark, f"{path}/is_word=true")
    row = counted.agg(F.sum("n"), F.count_if(F.col("first") & (F.col("c") > 0))).first()
    tokens, distinct = (row[0] or 0) + learnt, row[1] + (learnt > 0)
    scale = F.lit(float(tokens + distinct + 1))
    floor = float(np.log10(1 / (tokens + distinct + 1)))
    price = F.when(F.col("c") == 0, F.lit(floor)).otherwise(F.log10((F.col("c") + 1) / scale))
    ends = blocked.select("block").distinct().select("block", F.lit(END_TOKEN).alias("word"), F.lit(learnt).cast("long").alias("c"))

    packed = inventory.where("NOT is_word").select("block", "gram", "n")
    seen = stored(packed.groupBy("gram").agg(F.sum("n").alias("n")), "ppm-grams")
    prices = stored(probabilities(seen), "ppm-prices")

    def rows(df: DataFrame, kind: int, **have: Column) -> DataFrame:
        types = {"number": "long", "price": "double", "held": "boolean", "text": "binary"}
        columns = (have.get(n, F.lit(None)).cast(t).alias(n) for n, t in types.items())
        return df.select("block", F.lit(kind).alias("kind"), *columns)

    word_rows = counted.select("block", "word", "c").unionByName(ends)
    parts = (
        rows(word_rows, WORD, text=F.col("word"), price=price)
        .unionByName(rows(packed.join(prices, "gram"), GRAM, number=F.col("gram"), price=F.col("log10")))
        .unionByName(rows(blocked, DOCUMENT, number=F.col("doc_id"), held=F.col("held"), text=F.col("text")))
    )
    dealt = parts.repartitionById(blocks, "block").sortWithinPartitions("block", "kind")
    scored = dealt.mapInArrow(_scorer(floor), SCHEMA)
    return scored.withColumn("train_tokens", F.lit(tokens).cast("long"))
