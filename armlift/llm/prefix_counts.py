"""Token counts of every prefix by dynamic programming, stored once and asked without encoding again.

Pair merging has two properties.  Taking the last token off an encoding leaves the encoding of what is
before it; and two tokens stand side by side exactly if merging their joint text gives them back.  So the
encoding of a prefix follows from those of shorter ones: its last token is the one suffix that is a token
and can stand after the last token of the rest, and ``count[i] = count[i - len(token)] + 1``.  That runs
once along every distinct piece of text (``PieceCounts``).  Where pieces end differently from how they go
on, as with a mark for a word's end, every prefix has its last token in both forms.

A piece never spans white space, so a text's prefixes are those of its words, summed.  A table row keeps,
packed, where each word ends, which of the row's distinct words it is, and every distinct word's counts at
all its bytes.  Truncation to any byte and budgets are a cumulative sum and two lookups.
"""

from __future__ import annotations

import functools
import json
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from armlift.llm.common import texts
from armlift.llm.tokens import batches, load

SCHEMA = (
    "doc_id long, n_bytes long, n_tokens long, word_ends binary, word_refs binary, "
    "count_places binary, prefix_counts binary"
)
#: Known words and pieces are forgotten beyond these numbers.
CACHE_WORDS, CACHE_PIECES = 1_000_000, 300_000
#: Bytes of text that are counted at once, and characters of prefixes that the library is asked at once.
AT_ONCE, ASKED_AT_ONCE = 4_000_000, 1_000_000
#: Words whose counts are right in this form are counted by the recurrence; a file that fails has all asked.
PROBES = ("Hello", "worldwide", "ab12c", "a,b;;c", "--x--", "été", "ÑANDÚ", "它们words", "it's", "we'll've", "'sabc", "!!'re")


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level files: itself if printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte) if byte in plain else chr(spare))
        spare += byte not in plain
    return out


class PieceCounts:
    """Counts at all prefixes of a piece under the merges of a tokenizer file."""

    def __init__(self, model: dict) -> None:
        self.end = model.get("end_of_word_suffix") or ""
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank = {}
        for at, pair in enumerate(merges):
            self.rank.setdefault(pair, at)
        self.made: dict[str, tuple[int, str, str]] = {}  # token: when it is merged, and of what
        for pair, at in self.rank.items():
            self.made.setdefault("".join(pair), (at, *pair))
        whole = [t for t in model["vocab"] if t in self.made or len(t.removesuffix(self.end)) == 1]
        self.open = {t for t in whole if not self.end or not t.endswith(self.end)}
        self.closed = {t.removesuffix(self.end) for t in whole if t.endswith(self.end)}
        self.longest = max(map(len, self.open | self.closed), default=1)
        self.beside = functools.lru_cache(1 << 17)(self._beside)

    def _beside(self, left: str, right: str) -> bool:
        """Whether merging the joint text of two tokens gives just them back.

        The merges inside both are undone from the latest on.  At each state the pieces at the seam
        must not be a pair that is merged before what was just undone, as that is when they met.
        """
        made, rank = self.made, self.rank
        before = len(rank)  # merges made so late or later come after the seam's pieces have met
        while True:
            met = rank.get((left, right))
            if met is not None and met < before:
                return False
            a, b = made.get(left), made.get(right)
            if a is None and b is None:
                return True
            if b is None or (a is not None and a[0] > b[0]):
                before, left = a[0], a[2]
            else:  # of like pairs the left one is merged first, so one at the seam would have come before
                before, right = b[0] + 1, b[1]

    def runs(self, pieces: Iterable[str]) -> Iterator[list[int]]:
        """Tokens of each prefix of each piece, as if it ended there.

        What a piece shares with the one before it is not run through again, so sorted ones cost least.
        """
        last, inner, ended, before = [""], [0], [], ""
        beside, longest, opened, closed, end = self.beside, self.longest, self.open, self.closed, self.end
        for symbols in pieces:
            same, most = 0, min(len(before), len(symbols))
            while same < most and before[same] == symbols[same]:
                same += 1
            del last[same + 1 :], inner[same + 1 :], ended[same:]
            for i in range(same + 1, len(symbols) + 1):
                least = i - longest if i > longest else 0
                for begin in range(least, i):
                    token = symbols[begin:i]
                    if token in opened and (not begin or beside(last[begin], token)):
                        break
                else:
                    raise ValueError(f"no token for {symbols[i - 1]!r}")
                last.append(token)
                inner.append(inner[begin] + 1)
                if not end:
                    ended.append(inner[i])
                    continue
                for begin in range(least, i):
                    token = symbols[begin:i]
                    if token in closed and (not begin or beside(last[begin], token + end)):
                        break
                else:
                    raise ValueError(f"no token for {symbols[i - 1]!r}")
                ended.append(inner[begin] + 1)
            before = symbols
            yield ended[:]


class WordCounts:
    """Counts at all prefixes of words (runs without ASCII white space) under a tokenizer file.

    The file's pieces hold no white space and its characters are lower-cased one by one, or not at all;
    otherwise, and for words that Unicode composition changes or that hold a special string, every prefix
    is asked of the library, once a distinct word.  Such a word is asked in parts, cut where letters or
    digits follow a mark or a digit; a part takes time that grows with the square of its length.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        import regex

        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.pieces = PieceCounts(config["model"])
        self.lowers = "Lowercase" in json.dumps(config["normalizer"])
        patterns = [p["pattern"]["Regex"] for p in _flat(config["pre_tokenizer"]) if p["type"] == "Split" and p["invert"]]
        self.split = regex.compile(patterns[0]) if len(patterns) == 1 else None
        self.specials = [t["content"] for t in config["added_tokens"]]
        self.symbols = byte_symbols()
        self.cache_words = cache_words
        self._clear()
        if self.split and any(found != self._asked(w) for w, found in zip(PROBES, self.of(list(PROBES)))):
            self.split = None

    def _clear(self) -> None:
        """No known words; counts at all bytes of the known ones lie one after the other."""
        self.known = pa.array([], pa.large_string())
        self.places = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.uint32)
        self._clear_pieces()

    def _clear_pieces(self) -> None:
        """No known pieces; theirs lie one after the other too."""
        self.number_of: dict[str, int] = {}
        self.piece_sizes = np.zeros(0, np.int64)
        self.piece_flat = np.zeros(0, np.uint32)

    def _asked(self, word: str) -> list[int]:
        """Counts at all code points of a word from the library."""
        counts, ask = [], self.tokenizer.encode_batch_fast
        while len(counts) < len(word):
            at = len(counts)
            ends = range(at + 1, min(len(word), at + max(1, ASKED_AT_ONCE // (at + 100))) + 1)
            counts += [len(e.ids) for e in ask([word[:end] for end in ends], add_special_tokens=False)]
        return counts

    def _cuts(self, word: str) -> list[int]:
        """Where no piece, composition or special string of the word or of a prefix reaches over."""
        if self.split is None:
            return []
        kinds = [unicodedata.category(c)[0] for c in word]
        cuts = [i for i in range(1, len(word)) if kinds[i] in "LN" and kinds[i - 1] in "NPS" and word[i - 1] != "'"]
        for special in self.specials:
            at = word.find(special)
            while at >= 0:
                cuts = [c for c in cuts if not at < c < at + len(special)]
                at = word.find(special, at + 1)
        return cuts

    def _asked_in_parts(self, word: str) -> list[int]:
        """The same, each part between two cuts asked alone."""
        counts, edges = [], [0, *self._cuts(word), len(word)]
        for begin, end in zip(edges, edges[1:]):
            before = counts[-1] if counts else 0
            counts += [before + n for n in self._asked(word[begin:end])]
        return counts

    def _shown(self, word: str) -> str | None:
        """The word as the file's pieces have it; None if its prefixes are to be asked."""
        if self.split is None or any(s in word for s in self.specials):
            return None
        if word.isascii():
            return word.lower() if self.lowers else word
        shown = word.lower() if self.lowers else word  # character by character: the final sigma is none
        settled = unicodedata.is_normalized("NFC", word) and len(shown) == len(word) and "ς" not in shown
        return shown if settled else None

    def _symbols(self, piece: str) -> str:
        return piece if piece.isascii() and piece.isprintable() else "".join(self.symbols[b] for b in piece.encode())

    def _pieces(self, shown: Iterable[str]) -> dict[str, list[int]]:
        """Counts at all characters of all pieces of these words and of cut contractions."""
        found = {p for word in shown for p in self.split.findall(word)}
        cut = {p[:i] for p in found if p[0] == "'" for i in range(1, len(p))}
        found.update(p for head in cut for p in self.split.findall(head))
        written = sorted((self._symbols(p), p) for p in found)
        out = {}
        for (_, piece), counts in zip(written, self.pieces.runs(s for s, _ in written)):
            if not piece.isascii():
                counts = [counts[end - 1] for end in np.cumsum([len(c.encode()) for c in piece]).tolist()]
            out[piece] = counts
        return out

    def _recurred(self, shown: str, pieces: dict[str, list[int]]) -> list[int]:
        """Counts at all code points of a word, by those of its pieces."""
        counts, before = [], 0
        for found in self.split.finditer(shown):
            piece = found.group()
            counts += [before] * (found.start() - len(counts))  # white space that is not ASCII
            mine = pieces[piece]
            if piece[0] == "'" and len(piece) > 1 and piece[1].isalpha():  # cut, it is other pieces
                heads = [self.split.findall(piece[:i]) for i in range(1, len(piece))]
                mine = [sum(pieces[p][-1] for p in head) for head in heads] + mine[-1:]
            counts += [before + n for n in mine]
            before += mine[-1]
        return counts + [before] * (len(shown) - len(counts))

    def of(self, words: list[str]) -> list[list[int]]:
        """Counts at all code points of each word."""
        shown = [self._shown(w) for w in words]
        pieces = self._pieces([s for s in shown if s is not None])
        return [self._asked_in_parts(w) if s is None else self._recurred(s, pieces) for w, s in zip(words, shown)]

    def whole(self, words: list[str]) -> list[list[int]]:
        """The count of each whole word alone."""
        return [counts[-1:] for counts in self.of(words)]

    def _piece_numbers(self, pieces: list[str]) -> np.ndarray:
        """The known number of each of these pieces; new ones are counted at all bytes.

        A cut inside a character counts what is before it.
        """
        number_of = self.number_of
        new = sorted((self._symbols(p), p) for p in {p for p in pieces if p not in number_of})
        if new:
            sizes = np.array([len(s) for s, _ in new], np.int64)
            runs = self.pieces.runs(s for s, _ in new)
            counts = np.fromiter((n for run in runs for n in run), np.uint32, int(sizes.sum()))
            raw = np.frombuffer("".join(p for _, p in new).encode() + b"\0", np.uint8)
            at = np.arange(len(counts))
            ends = np.maximum.accumulate(np.where(raw[1:] & 0xC0 != 0x80, at, -1))
            counts = np.where(ends < np.repeat(np.cumsum(sizes) - sizes, sizes), 0, counts[ends]).astype(np.uint32)
            number_of.update((p, number) for number, (_, p) in enumerate(new, len(number_of)))
            self.piece_sizes = np.concatenate([self.piece_sizes, sizes])
            self.piece_flat = np.concatenate([self.piece_flat, counts])
        return np.fromiter(map(number_of.__getitem__, pieces), np.int64, len(pieces))

    def _by_pieces(self, split: list[list[str]]) -> np.ndarray:
        """Counts at all bytes of words that are these pieces, one word after the other."""
        numbers = self._piece_numbers([p for pieces in split for p in pieces])
        held = np.fromiter(map(len, split), np.int64, len(split))
        places = np.cumsum(self.piece_sizes) - self.piece_sizes
        sizes = self.piece_sizes[numbers]
        totals = self.piece_flat[places[numbers] + sizes - 1].astype(np.int64)
        before = np.cumsum(totals) - totals
        before -= np.repeat(before[np.cumsum(held) - held], held)
        shift = places[numbers] - (np.cumsum(sizes) - sizes)
        inside = self.piece_flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]
        return inside + np.repeat(before, sizes).astype(np.uint32)

    def _by_characters(self, words: list[str]) -> Iterator[np.ndarray]:
        """Counts at all bytes of each word; a cut inside a character counts what is before it."""
        for word, found in zip(words, self.of(words)):
            counts = np.array(found, np.uint32)
            widths = np.array([len(c.encode()) for c in word])
            held = np.repeat(np.concatenate([[0], counts[:-1]]), widths)
            held[np.cumsum(widths) - 1] = counts
            yield held.astype(np.uint32)

    def _learn(self, new: pa.Array) -> None:
        """Counts at all bytes of new words: of most, that is those without contractions, from their pieces' counts."""
        if len(self.number_of) > CACHE_PIECES:
            self._clear_pieces()
        words = new.to_pylist()
        split: list[list[str]] = [[]] * len(words)
        if self.split:
            even = lambda w: w.isascii() or not self.lowers or _uneven().isdisjoint(w)
            shown = [self._shown(w) if "'" not in w and even(w) else None for w in words]
            split = [[] if form is None else self.split.findall(form) for form in shown]
        plain = np.fromiter((sum(map(len, p)) == len(w) for w, p in zip(words, split)), bool, len(words))
        sizes = pc.binary_length(new).to_numpy().astype(np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])  # of their counts
        found = [self._by_pieces([p for p, easy in zip(split, plain.tolist()) if easy])] if plain.any() else []
        found += self._by_characters([w for w, easy in zip(words, plain.tolist()) if not easy])
        places = np.empty(len(words), np.int64)
        places[order] = len(self.flat) + np.cumsum(sizes[order]) - sizes[order]
        self.places = np.concatenate([self.places, places])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat = np.concatenate([self.flat, *found])
        self.known = pa.concat_arrays([self.known, new])

    def numbers(self, words: pa.Array) -> np.ndarray:
        """The known number of each word (large strings, none empty); new ones are counted."""
        if len(self.known) > self.cache_words:
            self._clear()
        found = pc.index_in(words, value_set=self.known)
        if not found.null_count:
            return found.to_numpy().astype(np.int64)
        missing = pc.is_null(found)
        new = words.filter(missing).dictionary_encode()
        known = len(self.known)
        self._learn(new.dictionary)
        numbers = pc.fill_null(found, 0).to_numpy().astype(np.int64)
        numbers[missing.to_numpy(zero_copy_only=False)] = new.indices.to_numpy() + known
        return numbers

    def totals(self) -> np.ndarray:
        """Tokens of each known word."""
        return self.flat[self.places + self.sizes - 1].astype(np.int64)


@functools.cache
def _uneven() -> frozenset[str]:
    """Characters that are lower-cased to a form of other bytes."""
    width = lambda c: len(c.encode(errors="surrogatepass"))
    return frozenset(c for c in map(chr, range(sys.maxunicode + 1)) if c.lower() != c and width(c.lower()) != width(c))


def _flat(node: dict) -> list[dict]:
    """The steps of a pre-tokenizer."""
    return node["pretokenizers"] if node["type"] == "Sequence" else [node]


@functools.lru_cache(maxsize=2)
def word_counts(path: str) -> WordCounts:
    """One table of words per worker process."""
    return WordCounts(path)


def _words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of all texts, and how many each text has."""
    parts = pc.ascii_split_whitespace(column.cast(pa.large_string()))
    edges = parts.offsets.to_numpy()
    found = parts.flatten()
    real = pc.not_equal(pc.binary_length(found), 0)
    running = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    return found.filter(real), np.diff(running[edges - edges[0]])


def _row(text: bytes, numbers: np.ndarray, counter: WordCounts) -> list[bytes]:
    """The packed columns of a text whose words have these numbers."""
    distinct, refs = np.unique(numbers, return_inverse=True)
    sizes = counter.sizes[distinct]
    places = np.cumsum(sizes) - sizes
    flat = counter.flat[np.repeat(counter.places[distinct] - places, sizes) + np.arange(int(sizes.sum()))]
    blank = np.isin(np.frombuffer(text, np.uint8), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
    ends = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1 if len(text) else np.zeros(0, np.int64)
    return [a.astype("<u4").tobytes() for a in (ends, refs, places, flat)]


def packed(tokenizer_path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The table's rows (``SCHEMA``) for batches of ``_id`` and ``_text``, a bounded number of bytes at a time."""
    names = ["doc_id", "n_bytes", "n_tokens", "word_ends", "word_refs", "count_places", "prefix_counts"]

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = word_counts(tokenizer_path)
        for part in batches(parts, "_text", AT_ONCE):
            column = part.column("_text")
            words, held = _words(column)
            numbers = counter.numbers(words)
            edges = np.concatenate([[0], np.cumsum(held)])
            running = np.concatenate([[0], np.cumsum(counter.totals()[numbers])])
            tokens = running[edges[1:]] - running[edges[:-1]]
            raw = column.cast(pa.binary()).to_pylist()
            rows = [_row(t, numbers[a:b], counter) for t, a, b in zip(raw, edges[:-1], edges[1:])]
            columns = [part.column("_id"), pc.binary_length(column).cast(pa.int64()), pa.array(tokens, pa.int64())]
            yield pa.record_batch(columns + [pa.array(list(c), pa.binary()) for c in zip(*rows)], names)

    return each


def prefix_table(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Per row of ``docs``: its counts, and the packed counts of all its prefixes.

    ``word_ends`` are the UTF-8 bytes up to each word's end, ``word_refs`` which distinct word it is, and
    ``prefix_counts`` from ``count_places`` on the tokens of that word's first byte, two bytes and so on,
    all as unsigned 32-bit little-endian integers.  A word is a run without ASCII white space; a cut inside
    a character counts what is before the character.  Special strings in a text count as the library
    counts them by default.  A NULL or empty text has no words and no tokens, a text of any length is
    counted in full, NULL ids and equal rows are returned as they are, an empty table gives none, and
    further columns are ignored.
    """
    return texts(docs).mapInArrow(packed(tokenizer_path), SCHEMA)


def _unpacked(row) -> tuple[np.ndarray, ...]:
    """Word ends, every word's place among the counts and its bytes, the counts, tokens up to each word's end."""
    ends, refs, places, counts = (
        np.frombuffer(row[c], "<u4").astype(np.int64) for c in ("word_ends", "word_refs", "count_places", "prefix_counts")
    )
    sizes = np.diff(places, append=len(counts))
    return ends, places[refs], sizes[refs], counts, np.cumsum(counts[places[refs] + sizes[refs] - 1])


def tokens_of_prefix(row, n_bytes: int) -> int:
    """Tokens of the first ``n_bytes`` bytes of a row's text, from the row alone."""
    ends, places, sizes, counts, totals = _unpacked(row)
    word = int(np.searchsorted(ends, n_bytes, side="right"))
    found = int(totals[word - 1]) if word else 0
    if word < len(ends):
        inside = n_bytes - int(ends[word] - sizes[word])
        found += int(counts[places[word] + inside - 1]) if inside > 0 else 0
    return found


def truncation(row, budget: int) -> int:
    """Bytes of the longest prefix of whole words with at most ``budget`` tokens."""
    ends, *_, totals = _unpacked(row)
    words = int(np.searchsorted(totals, budget, side="right"))
    return int(ends[words - 1]) if words else 0


def truncated(docs: DataFrame, tokenizer_path: str, budgets: list[int]) -> DataFrame:
    """Per row of ``docs`` and budget: ``cut_bytes``, the longest prefix of whole words within it."""

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = part.to_pylist()
            yield pa.record_batch(
                [
                    pa.array([r["doc_id"] for r in rows for _ in budgets], pa.int64()),
                    pa.array([b for _ in rows for b in budgets], pa.int64()),
                    pa.array([truncation(r, b) for r in rows for b in budgets], pa.int64()),
                ],
                ["doc_id", "budget", "cut_bytes"],
            )

    return prefix_table(docs, tokenizer_path).mapInArrow(ask, "doc_id long, budget long, cut_bytes long")


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 2048) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row: its longest prefix, asked of its table row.

    The rows are those of :func:`prefix_table`, whose docstring says how odd ones count.  They are asked
    in the task that makes them, as they are some four times as large as the texts.
    """
    table = packed(tokenizer_path)

    def ask(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in table(parts):
            sizes, stored = part.column("n_bytes"), part.to_pylist()
            counts = [tokens_of_prefix(row, size) for row, size in zip(stored, sizes.to_pylist())]
            yield pa.record_batch([part.column("doc_id"), sizes, pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    asked = texts(docs).mapInArrow(ask, "doc_id long, n_bytes long, n_tokens long")
    return asked.withColumn("over_limit", F.col("n_tokens") > limit)
