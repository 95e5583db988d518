"""Substring dedup over sliding spans of sentences.

Every run of several consecutive sentences, or pieces of long ones, is hashed.  Hashes meet in one aggregation with map-side
combine, which keeps the least and greatest document of each; a hash with two documents is repeated,
and its first document is the least.  Documents are joined with the repeated hashes they are not the
first of, and lose every sentence that such a span covers.  A second occurrence inside one document
is seen without any shuffle and goes as well.

A hot passage is one row per map task in the aggregation, and in the join its occurrences stay spread:
the repeated side has one row per hash, so adaptive execution can split the other.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from armlift.llm.common import stored

#: A span is the shortest run from a piece on with so many pieces and so many words.
SENTENCES = 3
WORDS = 12
#: A piece is a sentence, cut after the word of the least hash of any ``CUT_WINDOW`` words of it in a row, however
#: long it is.  So no piece is longer than two windows, like wording is cut alike from ``CUT_WINDOW`` words
#: inside its edges on, and any 46 equal words hold a span: a cut by word 15, 24 words of pieces, 7 at the end.
CUT_WINDOW = 8
#: Documents without an id stand at the end of the order, each at its text's hash below this.
LAST = (1 << 63) - 1

_SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+[\"')\]]*\s*|[^.!?\n]+\Z")
_WORD = re.compile(r"\S+")


class Pieces:
    """A text's pieces: their words in lower case, in one buffer with single spaces."""

    def __init__(self, text: str) -> None:
        self.raws = _SENTENCE.findall(text)
        words: list[str] = []
        self.held = []  # words of each sentence
        for raw in self.raws:
            own = raw.lower().split()
            words += own
            self.held.append(len(own))
        coded = [w.encode() for w in words]
        self.joined = b" ".join(coded)
        self.edges = np.cumsum(np.fromiter((len(w) + 1 for w in coded), np.int64, len(coded)))
        ends = np.cumsum(np.array(self.held, np.int64))
        cuts = self._cuts(np.fromiter(map(zlib.crc32, coded), np.int64, len(coded)), ends)
        #: Words before the end of each piece; sentences without words belong to the piece before them.
        self.ends = np.union1d(ends[ends > 0], cuts)
        self.sizes = np.diff(self.ends, prepend=0)
        lines = [e for e, raw in zip(ends.tolist(), self.raws) if e and "\n" in raw]
        #: Pieces that end a line or the text.
        self.last = np.searchsorted(self.ends, np.unique([*lines, len(words)]))[: len(self.ends)].tolist() if words else []

    @staticmethod
    def _cuts(hashes: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words before each cut: after the last least hash of every window inside one sentence."""
        if len(hashes) < CUT_WINDOW:
            return np.zeros(0, np.int64)
        windows = np.lib.stride_tricks.sliding_window_view(hashes, CUT_WINDOW)
        least = np.arange(len(windows)) + CUT_WINDOW - 1 - windows[:, ::-1].argmin(axis=1)
        sentence = np.searchsorted(ends, np.arange(len(hashes)), side="right")
        return np.unique(least[sentence[: len(windows)] == sentence[CUT_WINDOW - 1 :]]) + 1

    def spans(self) -> list[tuple[int, int, int]]:
        """(hash, first piece, end) of the shortest span from each piece on, and of that up to each line's end."""
        import xxhash

        n, before = len(self.ends), np.concatenate([[0], self.ends])
        if n < SENTENCES or before[-1] < WORDS:
            return []
        first = np.arange(n)
        end = np.maximum(first + SENTENCES, np.searchsorted(before, before[:-1] + WORDS))
        runs = [(a, b) for a, b in zip(first.tolist(), end.tolist()) if b <= n]
        for at in self.last:
            a = min(at + 1 - SENTENCES, int(np.searchsorted(before, before[at + 1] - WORDS, side="right")) - 1)
            if a >= 0 and end[a] != at + 1:
                runs.append((a, at + 1))
        runs.sort()
        begin = np.concatenate([[0], self.edges])[before[:-1]].tolist()
        close = (self.edges[self.ends - 1] - 1).tolist()
        digest = xxhash.xxh64_intdigest
        return [(digest(self.joined[begin[a] : close[b - 1]]) - (1 << 63), a, b) for a, b in runs]

    def texts(self) -> list[str]:
        """The pieces as they stand in the text; they concatenate to it."""
        if not len(self.ends):
            return ["".join(self.raws)] if self.raws else []
        ends, words, at = set(self.ends.tolist()), 0, 0
        places = []  # where, in the text, each piece ends
        for raw, held in zip(self.raws, self.held):
            own = [m.end() for m in _WORD.finditer(raw)]
            places += [at + end for k, end in enumerate(own[:-1], words + 1) if k in ends]
            at += len(raw)
            if held:
                places.append(at)
            elif places:  # no words: with the piece before
                places[-1] = at
            words += held
        text = "".join(self.raws)
        return [text[a:b] for a, b in zip([0, *places[:-1]], places)]


def _occurrences(docs: DataFrame) -> DataFrame:
    """``doc`` and ``span`` hash, once per row of ``docs`` and distinct span."""

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 200):
                ids: list[int] = []
                hashes: list[int] = []
                group = part.slice(at, 200)
                for doc, text in zip(group.column(0).to_pylist(), group.column(1).to_pylist()):
                    own = {s[0] for s in Pieces(text).spans()}
                    ids += [doc] * len(own)
                    hashes += own
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(hashes, pa.int64())], ["doc", "span"])

    return docs.select("_doc", "_text").mapInArrow(each, "doc long, span long")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    unnamed = F.lit(LAST) - F.pmod(F.xxhash64(text), F.lit(1 << 60))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), unnamed).alias("_doc"),
        F.col("doc_id").cast("long").alias("_id"),
        text.alias("_text"),
    )


def repeated(docs: DataFrame) -> DataFrame:
    """``doc`` and ``spans``: per document, the hashes of spans of which an earlier document is first."""
    seen = stored(_occurrences(_keyed(docs)), "span-occurrences")
    first = (
        seen.groupBy("span")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
        .where("first < last")
        .select("span", "first")
    )
    later = seen.join(first, "span").where("doc > first")
    return later.groupBy("doc").agg(F.collect_set("span").alias("spans"))


def _strip(text: str, gone: set[int]) -> tuple[str, int, int, str]:
    """(text left, pieces, pieces removed, removed ranges of code points) of one document."""
    pieces = Pieces(text)
    n = len(pieces.ends) or int(text != "")
    covered = bytearray(n)
    met: set[int] = set()
    for span, first, end in pieces.spans():
        if span in gone or span in met:
            covered[first:end] = b"\1" * (end - first)
        met.add(span)
    if not any(covered):
        return text, n, 0, ""
    ranges, at, start, left = [], 0, None, []
    for raw, out in zip([*pieces.texts(), ""], [*covered, 0]):
        if out and start is None:
            start = at
        elif not out and start is not None:
            ranges.append(f"{start}:{at}")
            start = None
        if not out:
            left.append(raw)
        at += len(raw)
    return "".join(left), n, sum(covered), ",".join(ranges)


def deduplicate(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` (what is left), ``n_sentences``, ``n_removed``, ``removed`` of every row.

    ``removed`` lists ``start:end`` code points of the text as it was.  Order is by ``doc_id``, NULL
    last in the order of a hash of the text.  Rows of one id, or of none and one text, are one document,
    so what only they share stays in each, while a span that one text repeats goes from its second
    place on.  A NULL or empty text stays empty, texts too short for a span stay whole, texts of any
    length are cut in full, in time that grows with their length, an empty table gives no rows, and
    further columns are ignored.
    """
    names = ["doc_id", "text", "n_sentences", "n_removed", "removed"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for at in range(0, part.num_rows, 200):
                group = part.slice(at, 200)
                rows = [
                    (doc_id, *_strip(text, set(gone or ())))
                    for doc_id, text, gone in zip(*(group.column(i).to_pylist() for i in range(3)))
                ]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    marked = _keyed(docs).join(repeated(docs), F.col("_doc") == F.col("doc"), "left").select("_id", "_text", "spans")
    return marked.mapInArrow(each, "doc_id long, text string, n_sentences long, n_removed long, removed string")
