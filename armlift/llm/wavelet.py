"""Token shards as wavelet matrices: one compressed file per shard, answering queries as it lies.

A shard holds the ids of consecutive documents.  Bit plane 0 is the ids' highest bit in text order;
each further plane is the next bit after a stable partition by the bit before.  With the number of
ones before every 512th bit kept beside a plane, ``access``, ``rank`` (count) and ``select``
(occurrence lookup) take one step a plane and never decode the shard.

The table of shards is Parquet, zstd-compressed, with one shard a file: Spark's commit makes a
retried or lost task harmless, and any store Spark can write to will do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from armlift.llm.common import texts
from armlift.llm.tokens import batches, byte_bpe

BLOCK = 512
SHARD_TOKENS = 1 << 21
#: Characters of a task's range of documents at least, and ranges at most; a range is written as several shards.
PARTITION_CHARACTERS, PARTITIONS = 24_000_000, 20_000


class WaveletMatrix:
    """Planes of one shard: ``bits`` packed big-endian, ``ranks`` ones before each block, ``zeros``."""

    def __init__(self, n: int, bits: list[np.ndarray], ranks: list[np.ndarray], zeros: list[int]) -> None:
        self.n, self.bits, self.ranks, self.zeros = n, bits, ranks, zeros

    @classmethod
    def build(cls, ids: np.ndarray, width: int) -> WaveletMatrix:
        bits, ranks, zeros = [], [], []
        for level in range(width):
            ones = (ids & ids.dtype.type(1 << (width - 1 - level))) != 0
            packed = np.packbits(ones)
            padded = np.zeros(-(-len(packed) * 8 // BLOCK) * BLOCK // 8, np.uint8)
            padded[: len(packed)] = packed
            per_block = np.bitwise_count(padded).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.uint32)
            bits.append(packed)
            ranks.append(np.concatenate([[0], np.cumsum(per_block)]).astype("<u4"))
            low = np.compress(~ones, ids)
            zeros.append(len(low))
            ids = np.concatenate([low, np.compress(ones, ids)])
        return cls(len(ids), bits, ranks, zeros)

    def _ones(self, level: int, i: int) -> int:
        """Ones before place ``i`` of a plane."""
        block = i // BLOCK
        found = int(self.ranks[level][block])
        for k in range(block * BLOCK // 8, i // 8):
            found += int(self.bits[level][k]).bit_count()
        if i % 8:
            found += (int(self.bits[level][i // 8]) >> (8 - i % 8)).bit_count()
        return found

    def _bit(self, level: int, i: int) -> int:
        return int(self.bits[level][i // 8]) >> (7 - i % 8) & 1

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value, i = value << 1 | bit, zeros + ones if bit else i - ones
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where, after the last plane, the occurrences of ``token`` before place ``end`` lie."""
        begin, width = 0, len(self.zeros)
        if token >> width:
            return 0, 0
        for level, zeros in enumerate(self.zeros):
            if token >> (width - 1 - level) & 1:
                begin, end = zeros + self._ones(level, begin), zeros + self._ones(level, end)
            else:
                begin, end = begin - self._ones(level, begin), end - self._ones(level, end)
        return begin, end

    def rank(self, token: int, end: int | None = None) -> int:
        """Occurrences of ``token`` before place ``end`` (default: in the shard)."""
        begin, end = self._range(token, self.n if end is None else end)
        return end - begin

    def _place(self, level: int, k: int, bit: int) -> int:
        """Place of the ``k``-th (from 0) ``bit`` of a plane."""
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK - ranks
        block = int(np.searchsorted(before, k, side="right")) - 1
        plane = np.unpackbits(self.bits[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(plane == bit)[k - int(before[block])])

    def select(self, token: int, k: int) -> int:
        """Place of the ``k``-th (from 0) occurrence of ``token``."""
        begin, end = self._range(token, self.n)
        if not 0 <= k < end - begin:
            raise IndexError(k)
        i, width = begin + k, len(self.zeros)
        for level in range(width - 1, -1, -1):
            bit = token >> (width - 1 - level) & 1
            i = self._place(level, i - self.zeros[level] if bit else i, bit)
        return i

    def decode(self) -> np.ndarray:
        """All ids in text order: the partitions undone from the last plane up."""
        ids = np.zeros(self.n, np.uint16 if len(self.zeros) <= 16 else np.uint32)
        for level in range(len(self.zeros) - 1, -1, -1):
            ones = np.unpackbits(self.bits[level], count=self.n).view(bool)
            before = np.empty_like(ids)
            before[np.flatnonzero(~ones)] = ids[: self.zeros[level]]
            before[np.flatnonzero(ones)] = ids[self.zeros[level] :] | ids.dtype.type(1 << (len(self.zeros) - 1 - level))
            ids = before
        return ids


SCHEMA = (
    "seq long, n_docs long, n_tokens long, doc_ids array<bigint>, lengths binary, "
    "width int, zeros array<bigint>, planes binary, ranks binary"
)
_ARROW = pa.schema(
    [
        ("seq", pa.int64()),
        ("n_docs", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.binary()),
        ("width", pa.int32()),
        ("zeros", pa.list_(pa.int64())),
        ("planes", pa.binary()),
        ("ranks", pa.binary()),
    ]
)


def _shard(seq: int, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray, width: int) -> pa.RecordBatch:
    matrix = WaveletMatrix.build(ids, width)
    planes, ranks = b"".join(b.tobytes() for b in matrix.bits), b"".join(r.tobytes() for r in matrix.ranks)
    counts = lengths.astype("<u4").tobytes()
    row = [seq, len(doc_ids), len(ids), doc_ids.to_pylist(), counts, width, matrix.zeros, planes, ranks]
    return pa.record_batch([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)


def _ended(ids: np.ndarray, lengths: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the end id after every document, and their counts."""
    return np.insert(ids, np.cumsum(lengths), end_id), lengths + 1


def _encoder(tokenizer_path: str, end_id: int, shard_tokens: int):
    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = byte_bpe(tokenizer_path)
        width = max(1, max(len(bpe.starts) - 1, end_id).bit_length())
        seq, kept = 0, []  # what the open shard holds: (document ids, ids, counts)

        def closed() -> pa.RecordBatch:
            docs = pa.concat_arrays([k[0] for k in kept])
            ids, lengths = (np.concatenate([k[i] for k in kept]) for i in (1, 2))
            return _shard(seq, docs, ids, lengths, width)

        for batch in batches(parts, "_text"):
            docs, (ids, lengths) = batch.column("_id"), bpe.encode(batch.column("_text"))
            ids, lengths = _ended(ids, lengths, end_id)
            while len(docs):
                held = sum(len(k[1]) for k in kept)
                ends = np.cumsum(lengths)
                fills = int(np.searchsorted(ends, shard_tokens - held)) + 1  # documents up to the one that fills it
                take = min(fills, len(docs))
                cut = int(ends[take - 1])
                kept.append((docs[:take], ids[:cut], lengths[:take]))
                docs, ids, lengths = docs[take:], ids[cut:], lengths[take:]
                if take == fills:
                    yield closed()
                    seq, kept = seq + 1, []
        if kept:
            yield closed()

    return encode


def write(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode every text of ``docs`` and write the shards, in ascending ``doc_id`` order.

    Each document is its whole text's ids and ``end_id``; a NULL or empty text is the end id alone,
    a NULL ``doc_id`` comes first, rows of one id follow in the order of a hash of their text, and
    an empty table gives a table without shards.  A shard closes after the document that fills it,
    so a very long text is never cut.  Further columns are ignored.
    """
    rows = texts(docs)
    size = rows.agg(F.sum(F.char_length("_text"))).first()[0] or 0
    ordered = (
        rows.withColumn("_tie", F.xxhash64("_text"))
        # Rows equal in both are told apart by where they were read, so that many of them fill several ranges.
        .withColumn("_read", F.monotonically_increasing_id())
        .repartitionByRange(min(PARTITIONS, max(1, -(-size // PARTITION_CHARACTERS))), "_id", "_tie", "_read")
        .sortWithinPartitions("_id", "_tie", "_read")
        .select("_id", "_text")
    )
    ordered.mapInArrow(_encoder(tokenizer_path, end_id, shard_tokens), SCHEMA).select(
        F.spark_partition_id().alias("part"), "*"
    ).write.option("maxRecordsPerFile", 1).option("compression", "zstd").parquet(path)


def shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"part int, {SCHEMA}").parquet(path)


def matrix_of(row) -> WaveletMatrix:
    """The matrix in a shard's row (any mapping with the table's columns)."""
    n, width = row["n_tokens"], row["width"]
    step, blocks = -(-n // 8), -(-n // BLOCK) + 1
    planes, ranks = np.frombuffer(row["planes"], np.uint8), np.frombuffer(row["ranks"], "<u4")
    return WaveletMatrix(
        n,
        [planes[i * step : (i + 1) * step] for i in range(width)],
        [ranks[i * blocks : (i + 1) * blocks] for i in range(width)],
        list(row["zeros"]),
    )


def starts(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``seq`` and ``offset``: tokens in all shards before each; reads the counts only.

    Sums run within a writing task and then over one row per task, of which there are at most ``PARTITIONS``.
    """
    sizes = shards(spark, path).select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(parts, "part").select(
        "part", "seq", (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).alias("offset")
    )


def documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``."""
    schema = "part int, seq long, doc_id long, local long, n_tokens long, ids_crc32 long"
    names = ["part", "seq", "doc_id", "local", "n_tokens", "ids_crc32"]

    def decode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = part.slice(i, 1).to_pylist()[0]
                ids = matrix_of(row).decode().astype("<u4", copy=False)
                lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
                ends = np.cumsum(lengths)
                edges = zip((ends - lengths).tolist(), ends.tolist())
                crcs = [zlib.crc32(ids[a:b]) for a, b in edges]
                columns = [[row["part"]] * len(crcs), [row["seq"]] * len(crcs), row["doc_ids"], ends - lengths, lengths, crcs]
                types = [pa.int32(), *[pa.int64()] * 5]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names)

    found = shards(spark, path).mapInArrow(decode, schema)
    return found.join(starts(spark, path), ["part", "seq"]).select(
        "doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def counts(spark: SparkSession, path: str, tokens: Sequence[int]) -> DataFrame:
    """``token`` and ``n``: its occurrences in all shards, by rank on the planes."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                matrix = matrix_of(part.slice(i, 1).to_pylist()[0])
                yield pa.record_batch(
                    [pa.array(list(tokens), pa.int64()), pa.array([matrix.rank(t) for t in tokens], pa.int64())],
                    ["token", "n"],
                )

    found = shards(spark, path).mapInArrow(count, "token long, n long")
    return found.groupBy("token").agg(F.sum("n").alias("n"))


def occurrences(spark: SparkSession, path: str, token: int) -> DataFrame:
    """``doc_id`` and ``place`` (from 0, in the document) of every occurrence, by select."""

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = part.slice(i, 1).to_pylist()[0]
                matrix = matrix_of(row)
                ends = np.cumsum(np.frombuffer(row["lengths"], "<u4").astype(np.int64))
                places = np.array([matrix.select(token, k) for k in range(matrix.rank(token))], np.int64)
                docs = np.searchsorted(ends, places, side="right")
                begins = np.concatenate([[0], ends])[docs]
                yield pa.record_batch(
                    [pa.array([row["doc_ids"][d] for d in docs], pa.int64()), pa.array(places - begins, pa.int64())],
                    ["doc_id", "place"],
                )

    return shards(spark, path).mapInArrow(find, "doc_id long, place long")


def tokens_at(spark: SparkSession, path: str, places: Sequence[int]) -> DataFrame:
    """``place`` and ``token`` for a list of global token places, by access; none beyond the corpus."""
    wanted = np.array(sorted(set(places)), np.int64)

    def look(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                row = part.slice(i, 1).to_pylist()[0]
                matrix, begin = matrix_of(row), row["offset"]
                mine = wanted[(wanted >= begin) & (wanted < begin + matrix.n)]
                found = [matrix.access(int(p) - begin) for p in mine]
                yield pa.record_batch([pa.array(mine, pa.int64()), pa.array(found, pa.int64())], ["place", "token"])

    held = starts(spark, path).join(shards(spark, path).select("part", "seq", "n_tokens"), ["part", "seq"])
    touched = held.where(
        F.exists(
            F.array(*(F.lit(int(p)) for p in wanted)).cast("array<bigint>"),
            lambda p: (p >= F.col("offset")) & (p < F.col("offset") + F.col("n_tokens")),
        )
    ).select("part", "seq", "offset")
    return shards(spark, path).join(touched, ["part", "seq"]).mapInArrow(look, "place long, token long")
