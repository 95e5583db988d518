"""Hard negatives by an inverted multi-index with certified windows.

Each half of the vectors has a codebook; a row belongs to the cell of its two nearest codewords.  No row of
a cell scores more than the sum of two half-score bounds, one a codeword: the query half's product with
it plus the half's length times the codeword's radius.  A query takes codewords of each half by falling
bound, and a multi-sequence heap gives the cells by falling sum.  It stops when the next sum is below what
all its windows still need, so the window's first rows are certain (``vectors`` deals rows and queries
over tasks and merges what they found).

The codebooks only decide how many cells are visited.  They are fitted to a bounded sample; every row is
indexed, and radii are those of all rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from armlift.llm import vectors
from armlift.llm.common import stored

#: Rows that the codebooks are fitted to, at most about.
SAMPLE = 8192
#: Rows that a cell should hold on average; codewords of a half at least and at most.
CELL, FEWEST, MOST = 256, 4, 256
ROUNDS = 8
#: A bound's relative room for rounding.
ROOM = 1e-9


def codebook(sample: np.ndarray, size: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of the rows after some rounds of nearest-centroid averaging, from evenly spaced rows on."""
    found = np.unique(sample, axis=0)
    centres = found[np.linspace(0, len(found) - 1, min(size, len(found))).astype(int)].astype(np.float64)
    for _ in range(rounds):
        near = nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        held = np.bincount(near, minlength=len(centres))
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmax(rows @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)


def _half_bounds(queries: np.ndarray, centres: np.ndarray, radii: np.ndarray) -> np.ndarray:
    """Queries x codewords: what a half can score at most, with room for rounding."""
    lengths = np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1))[:, None]
    sizes = np.sqrt((centres**2).sum(axis=1))[None, :] + radii[None, :]
    return queries @ centres.T + lengths * radii[None, :] + lengths * sizes * ROOM + ROOM


def cells_by_bound(first: list[tuple[float, int]], second: list[tuple[float, int]], cells: dict) -> Iterator[tuple[float, int]]:
    """The multi-sequence heap: (bound, cell) by falling sum of the two falling sequences.

    ``cells`` names the cell of a pair of codewords where one holds rows.  A pair enters the heap once, after
    the one before it in the second sequence, or in the first where it begins the second.
    """
    heap = [(-(first[0][0] + second[0][0]), 0, 0)] if first and second else []
    while heap:
        bound, u, v = heapq.heappop(heap)
        cell = cells.get((first[u][1], second[v][1]))
        if cell is not None:
            yield -bound, cell
        if v + 1 < len(second):
            heapq.heappush(heap, (-(first[u][0] + second[v + 1][0]), u, v + 1))
        if v == 0 and u + 1 < len(first):
            heapq.heappush(heap, (-(first[u + 1][0] + second[0][0]), u + 1, 0))


class Codebooks:
    """Both halves' codewords, and what cells made of them bound."""

    def __init__(self, sample: np.ndarray, size: int) -> None:
        self.dims, self.half = sample.shape[1], sample.shape[1] // 2
        self.books = codebook(sample[:, : self.half], size), codebook(sample[:, self.half :], size)

    def sides(self, codes: np.ndarray, radii: np.ndarray, queries: np.ndarray):
        """Per half: the codewords of these cells, and the queries' bounds for them by the greatest radius."""
        out = []
        for side, (book, mine) in enumerate(zip(self.books, (slice(None, self.half), slice(self.half, None)))):
            words = codes // len(self.books[1]) if side == 0 else codes % len(self.books[1])
            used, at = np.unique(words, return_inverse=True)
            greatest = np.zeros(len(used))
            np.maximum.at(greatest, at, radii[:, side])
            out.append((used, at, _half_bounds(queries[:, mine], book[used], greatest)))
        return out

    def part_bounds(self, parts: pa.Table, queries: np.ndarray) -> np.ndarray:
        bounds = []
        for cells in parts["cells"].to_pylist():
            codes, radii = np.array([c["code"] for c in cells]), np.array([c["radii"] for c in cells])
            (_, i, first), (_, j, second) = self.sides(codes, radii, queries)
            bounds.append((first[:, i] + second[:, j]).max(axis=1))
        return np.stack(bounds, axis=1)

    def unpack(self, part: pa.Table, queries: np.ndarray):
        codes, radii = part["code"].to_numpy(), np.array(part["radii"].to_pylist())
        blocks = [
            (np.array(i.as_py(), np.int64), np.array(t.as_py(), np.int64), vectors.widen(r.as_py(), w.as_py(), self.dims))
            for i, t, r, w in zip(part["ids"], part["labels"], part["rows"], part["width"])
        ]
        (firsts, _, one), (seconds, _, two) = self.sides(codes, radii, queries)
        cells = {divmod(int(c), len(self.books[1])): at for at, c in enumerate(codes)}
        falling = lambda words, bounds: sorted(zip(bounds.tolist(), words.tolist()), reverse=True)
        return blocks, [
            cells_by_bound(falling(firsts, one[q]), falling(seconds, two[q]), cells) for q in range(len(queries))
        ]


def _coded(rows: DataFrame, by: Codebooks) -> DataFrame:
    """``rows`` with ``code``, the cell: the first half's codeword times the second's number and the second's."""
    books, half, dims = by.books, by.half, by.dims

    def each(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            found = vectors.matrix(part.column("_v"), dims).astype(np.float64)
            cell = nearest(found[:, :half], books[0]) * len(books[1]) + nearest(found[:, half:], books[1])
            yield part.append_column("code", pa.array(cell, pa.int64()))

    return rows.mapInArrow(each, "_id long, _v array<bigint>, label long, code long")


def _packed(rows: DataFrame, by: Codebooks) -> DataFrame:
    """One row a cell and part: ``code``, both ``radii``, ``ids``, ``labels`` and ``rows``."""
    books, half, dims = by.books, by.half, by.dims

    def each(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["_id"].to_numpy(), table["code"].to_numpy()))
        table = table.take(pa.array(order))
        ids, labels, codes = (table[c].to_numpy() for c in ("_id", "label", "code"))
        found = vectors.matrix(table["_v"], dims)
        edges = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1], [True]]))
        out = []
        for a, b in zip(edges[:-1], edges[1:]):
            i, j = divmod(int(codes[a]), len(books[1]))
            block = found[a:b]
            radii = [
                float(np.sqrt(((side - centre) ** 2).sum(axis=1)).max()) * (1 + ROOM)
                for side, centre in ((block[:, :half], books[0][i]), (block[:, half:], books[1][j]))
            ]
            raw, width = vectors.narrow(block)
            out.append((int(codes[a]), radii, ids[a:b], labels[a:b], raw, width))
        part = table["part"][0].as_py()
        kinds = [pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int32()]
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
        return pa.table(
            [pa.array([part] * len(out), pa.int64()), *columns],
            ["part", "code", "radii", "ids", "labels", "rows", "width"],
        )

    schema = "part long, code long, radii array<double>, ids array<bigint>, labels array<bigint>, rows binary, width int"
    return rows.select("part", "code", "_id", "label", "_v").groupBy("part").applyInArrow(each, schema)


class MultiIndex:
    """The index over all rows of a table and searches in it."""

    def __init__(self, rows: DataFrame, sample: int = SAMPLE) -> None:
        self.rows = stored(rows, "negatives-rows")
        found, dims = self.rows.agg(F.count("*"), F.max(F.size("_v"))).first()
        self.dims = max(2, dims or 0)
        rows = vectors.filled(self.rows, self.dims)
        one_in = max(1, -(-found // sample))
        chosen = rows.where(F.pmod(F.xxhash64("_id", F.lit(2)), F.lit(one_in)) == 0).select("_v")
        drawn = vectors.matrix(chosen.toArrow()["_v"], self.dims).astype(np.float64)
        if not len(drawn):
            drawn = np.zeros((1, self.dims))
        size = min(MOST, max(FEWEST, math.isqrt(found // CELL)))
        self.books = Codebooks(drawn, size)
        self.coded = stored(_coded(rows, self.books), "negatives-coded")
        placed, self.parts = vectors.dealt(self.coded, "code", vectors.PART, "part")
        self.cells = stored(_packed(placed, self.books), "negatives-cells")
        self.summary = self.cells.groupBy("part").agg(
            F.collect_list(F.struct("code", "radii")).alias("cells")
        )

    def first(self, asked: DataFrame, chunks: int, k: int, wanted: str) -> DataFrame:
        """The first ``k`` rows of the wanted label in each window of each query (``vectors.search``)."""
        return vectors.search(
            asked, chunks, self.cells, self.summary, self.parts, self.dims, k,
            self.books.part_bounds, self.books.unpack, wanted,
        )


def mine(
    table: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    every: int = 50,
    relabel: int | None = 7,
    labels: int = 10,
    low: int = 50,
    high: int = 95,
    factor: int = 256,
    sample: int = SAMPLE,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and ``negative_score``.

    Anchors are the rows whose ``vec_id`` is divisible by ``every``.  Their positives are the first other
    rows of their label, their negatives per positive the first rows of another label that score from
    ``low`` to ``high`` hundredths of the positive's score; higher scores come first, equal ones by the
    smaller ``vec_id``.  ``relabel`` moves the label of rows whose ``vec_id`` it divides on by one, modulo
    ``labels``, beforehand.  A positive without such a row, as any with a negative score, has no rows.

    The score is the inner product of the vectors floor(``factor`` x component).  A row without ``vec_id``,
    label or vector, or with a NULL or non-finite component, takes no part; shorter vectors are filled up
    with zeros.  Rows equal in id, label and vector are one row; rows of one id that differ are told
    apart, and none is found for another.  Scores beyond a long count as its end.  An empty table gives
    no rows; further columns are ignored.
    """
    columns = {"id": "vec_id", "vector": "embedding", "label": "label"}
    rows = vectors.whole_numbers(table, factor, columns).where("label IS NOT NULL")
    label = F.col("label").cast("long")
    if relabel is not None:
        label = F.when(F.col("_id") % relabel == 0, (label + 1) % labels).otherwise(label)
    index = MultiIndex(rows.select("_id", "_v", label.alias("label")), sample)
    ends = [F.array(F.lit(end).cast("long")) for end in (-vectors.HIGH, vectors.HIGH)]
    anchors = index.coded.where(F.col("_id") % every == 0)
    asked, chunks = vectors.queries_of(anchors, "code", ["label"])
    asked = stored(asked, "negatives-anchors")
    found = index.first(asked.withColumns({"lows": ends[0], "highs": ends[1]}), chunks, positives, "same")
    share = lambda percent: F.col("score").cast("decimal(38,0)") * percent / 100
    windows = (
        found.where("score >= 0")
        .withColumn("low", F.ceil(share(low)).cast("long"))
        .withColumn("high", F.floor(share(high)).cast("long"))
        .where("low <= high")
        .groupBy(F.col("_id").alias("a_id"), F.col("tag").alias("a_tag"))
        .agg(F.array_sort(F.collect_list(F.struct("rank", "number", "score", "low", "high"))).alias("windows"))
    )
    windows = stored(windows, "negatives-windows")
    most = max(positives, 1)
    # Every query has as many windows; those it lacks are empty.
    end = lambda name, empty: F.transform(
        F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.coalesce(F.get("windows", i)[name], F.lit(empty).cast("long"))
    )
    queries = asked.join(windows, (F.col("_id") == F.col("a_id")) & (F.col("tag") == F.col("a_tag"))).select(
        "chunk", "_id", "tag", "_v", "label", end("low", vectors.HIGH).alias("lows"), end("high", -vectors.HIGH).alias("highs")
    )
    mined = index.first(queries, chunks, negatives, "different")
    same = (F.col("_id") == F.col("a_id")) & (F.col("tag") == F.col("a_tag"))
    return mined.join(windows, same).select(
        F.col("_id").alias("anchor_id"),
        F.get("windows", F.col("w"))["number"].alias("positive_id"),
        "rank",
        F.col("number").alias("negative_id"),
        F.get("windows", F.col("w"))["score"].alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
