"""Encoding of whole texts inside tasks, with memory bounded by a cache of words.

A tokenizer whose pieces never reach over a single space between two visible characters can be
applied to the stretches between spaces one by one.  The library encodes each distinct stretch,
many in one call; a text is then the concatenation of what its stretches gave.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Known stretches and ids are forgotten beyond these numbers.
CACHE_WORDS, CACHE_IDS = 400_000, 8_000_000
#: Texts that the library is given in one call.
AT_ONCE = 16


def load(path: str):
    """The tokenizer of a ``tokenizers`` file, on one thread: Spark's tasks are the parallelism."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class ByteBpe:
    """Unsigned 16- or 32-bit ids of texts under a byte-level BPE file.

    Its pieces are a letter, digit or symbol run with at most one space before it, or a run of
    white space less its last character; so a stretch that starts after a single space and neither
    starts nor ends with white space is encoded alike inside its text and alone behind a space.
    Texts with any other stretch are encoded whole.

    Stretches are split and looked up by Arrow, the ids of each known one lie in one flat array, and a
    batch's ids are gathered from there, so Python meets new stretches only.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS) -> None:
        self.tokenizer = load(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.starts = np.zeros(max(vocabulary.values()) + 1, bool)
        for piece, number in vocabulary.items():
            self.starts[number] = piece.startswith("Ġ")
        self.cache_words = cache_words
        self._clear()

    def _clear(self) -> None:
        """No known stretches: their sizes (-1: can't stand alone) and ids one after the other."""
        self.known = pa.array([], pa.large_string())
        self.sizes = np.zeros(0, np.int64)
        self.flat = np.zeros(0, self.dtype)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of whole texts, straight from the library; few at a time, since its answers are large."""
        out = []
        for at in range(0, len(texts), AT_ONCE):
            found = self.tokenizer.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
            out += [np.array(one.ids, self.dtype) for one in found]
        return out

    def _learn(self, new: pa.Array) -> None:
        """Ids that each new stretch has behind a space; many in one call of the library."""
        stretches = new.to_pylist()
        alone = np.fromiter((bool(s) and not s[0].isspace() and not s[-1].isspace() for s in stretches), bool, len(stretches))
        joinable = [s for s, a in zip(stretches, alone.tolist()) if a]
        sizes, flat = [np.zeros(0, np.int64)], [self.flat]
        groups = [joinable[i : i + 500] for i in range(0, len(joinable), 500)]
        for group, ids in zip(groups, self.whole([" " + " ".join(g) for g in groups])):
            cuts = np.flatnonzero(self.starts[ids])
            if len(cuts) == len(group) and cuts[0] == 0:
                sizes.append(np.diff(cuts, append=len(ids)))
            else:  # a stretch with a space mark of its own inside
                each = self.whole([" " + s for s in group])
                sizes.append(np.array([len(e) for e in each], np.int64))
                ids = np.concatenate(each)
            flat.append(ids)
        found = np.full(len(stretches), -1, np.int64)
        found[alone] = np.concatenate(sizes)
        self.sizes, self.flat = np.concatenate([self.sizes, found]), np.concatenate(flat)
        self.known = pa.concat_arrays([self.known, new])

    def _numbers(self, stretches: pa.Array) -> np.ndarray:
        """The known number of each stretch; new ones are learnt."""
        numbers = pc.index_in(stretches, value_set=self.known)
        if not numbers.null_count:
            return numbers.to_numpy()
        missing = pc.is_null(numbers)
        new = stretches.filter(missing).dictionary_encode()
        known = len(self.known)
        self._learn(new.dictionary)
        numbers = pc.fill_null(numbers, 0).to_numpy().copy()
        numbers[missing.to_numpy(zero_copy_only=False)] = new.indices.to_numpy() + known
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string array in one array, as the library gives them for whole texts, and their counts."""
        if not len(texts):
            return np.zeros(0, self.dtype), np.zeros(0, np.int64)
        if len(self.known) > self.cache_words or len(self.flat) > CACHE_IDS:
            self._clear()
        parts = pc.split_pattern(texts.cast(pa.large_string()), " ")
        edges = parts.offsets.to_numpy()
        first, held = edges[:-1] - edges[0], np.diff(edges)
        stretches = parts.flatten()
        tail = np.ones(len(stretches), bool)
        tail[first] = False
        numbers = np.zeros(len(stretches), np.int64)
        numbers[tail] = self._numbers(stretches.filter(pa.array(tail)))
        known = np.concatenate([self.sizes, [0]])
        places = np.cumsum(np.maximum(known, 0)) - np.maximum(known, 0)
        sizes, begins = known[numbers], places[numbers]
        sizes[first] = 0

        heads = stretches.take(pa.array(first)).to_pylist()
        opens = np.fromiter((not h or h[-1].isspace() for h in heads), bool, len(heads))
        odd = (held > 1) & (opens | (np.minimum.reduceat(sizes, first) < 0))
        for i, text in zip(np.flatnonzero(odd).tolist(), texts.filter(pa.array(odd)).to_pylist()):
            heads[i] = text
        ahead = self.whole(heads)
        if odd.any():
            sizes[np.repeat(odd, held)] = 0
        sizes[first] = [len(a) for a in ahead]
        begins[first] = len(self.flat) + np.cumsum(sizes[first]) - sizes[first]
        flat = np.concatenate([self.flat, *ahead])
        shift = begins - (np.cumsum(sizes) - sizes)
        return flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))], np.add.reduceat(sizes, first)


@functools.lru_cache(maxsize=2)
def byte_bpe(path: str) -> ByteBpe:
    """One encoder per worker process, so that its cache serves all its tasks."""
    return ByteBpe(path)


def batches(parts: Iterator[pa.RecordBatch], text: str, most: int = 3_000_000) -> Iterator[pa.RecordBatch]:
    """The rows in batches of at most about so many bytes of text; a longer text is a batch of its own."""
    for part in parts:
        sizes = pc.binary_length(part.column(text)).to_numpy(zero_copy_only=False)
        at = held = 0
        for i, size in enumerate(sizes.tolist()):
            if held and held + size > most:
                yield part.slice(at, i - at)
                at, held = i, 0
            held += size
        if at < part.num_rows:
            yield part.slice(at)
