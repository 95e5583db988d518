"""Exact pruned search over vectors of whole numbers, shared by top-k search and negative mining.

Rows are dealt into parts and queries into chunks by their place in an order that keeps like vectors
together; both have a bounded number of rows, however many are alike.  A part is packed once into blocks
that a bound can be given for.  A search runs in two visits of (chunk, part) cells:

1. Every query visits its home, the part with the highest bound.
2. The k-th score found there is a floor; the query then visits every other part whose bound is not below.

Inside a cell each query takes the blocks by falling bound and stops when the next bound is below its
k-th score so far.  What a visit leaves out is out of the result for certain, so nothing is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from armlift.llm.common import stored

LOW, HIGH = -(1 << 63), (1 << 63) - 1
#: Components are held within these ends, so that they can be negated and summed in pairs.
END = 1 << 61
#: Rows of a part and queries of a chunk, at most; a small table is dealt into about ``PARTS`` parts.
PART, CHUNK, PARTS, LEAST = 8192, 1024, 64, 256
#: Parts whose summaries are looked through in one cell.
SPAN = 64


def whole_numbers(table: DataFrame, factor: int, columns: dict[str, str]) -> DataFrame:
    """``_id``, ``_v`` (floor of ``factor`` times each component) and the named columns of rows that take part.

    Left out are rows without id or vector, or with a NULL or non-finite component.  Rows equal in all of
    these columns are one row.  Shorter vectors are filled up with zeros to the longest one's length.
    """
    x = F.transform("_x", lambda c: c.cast("double"))
    sound = F.forall("_x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = table.select(
        F.col(columns["id"]).cast("long").alias("_id"),
        F.col(columns["vector"]).alias("_x"),
        *[F.col(source).alias(name) for name, source in columns.items() if name not in ("id", "vector")],
    ).withColumn("_x", x).where(F.col("_id").isNotNull() & F.col("_x").isNotNull() & F.coalesce(sound, F.lit(False)))
    held = F.transform("_x", lambda c: F.greatest(F.lit(-END), F.least(F.lit(END), F.floor(c * factor))))
    return kept.withColumn("_x", held).withColumnRenamed("_x", "_v").dropDuplicates()


def filled(rows: DataFrame, dims: int) -> DataFrame:
    return rows.withColumn("_v", F.slice(F.concat("_v", F.array_repeat(F.lit(0).cast("long"), dims)), 1, dims))


def unit(key: Column) -> Column:
    """A number in [0, 1) by the key's hash."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 11) / F.lit(float(1 << 53))


def dealt(rows: DataFrame, code: str, size: int, name: str) -> tuple[DataFrame, int]:
    """``rows`` with ``name``, the number of the part of at most about ``size`` rows they belong to, and the parts' number.

    Parts follow the order of ``code``, of which there are few distinct values; rows of one code are
    spread over the parts it reaches by their id's hash, so no code is too common.
    """
    counts = rows.groupBy(code).agg(F.count("*").alias("_held")).collect()
    before, at = {}, 0
    for value, held in sorted((r[0], r[1]) for r in counts):
        before[value] = (at, held)
        at += held
    size = min(size, max(LEAST, -(-at // PARTS)))
    parts = max(1, -(-at // size))
    if not before:
        return rows.withColumn(name, F.lit(0).cast("long")), parts
    table = rows.sparkSession.createDataFrame(
        [(value, *found) for value, found in before.items()], f"{code} long, _before long, _held long"
    )
    place = F.col("_before") + F.floor(unit(F.col("_id")) * F.col("_held"))
    return rows.join(F.broadcast(table), code).withColumn(name, F.floor(place / size)).drop("_before", "_held"), parts


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    """Rows of equally long lists of whole numbers."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def narrow(values: np.ndarray) -> tuple[bytes, int]:
    """Bytes of the values as whole numbers of the smallest fitting width, and that width."""
    low, high = (int(values.min()), int(values.max())) if values.size else (0, 0)
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return values.astype(f"<i{width}").tobytes(), width


def widen(raw: bytes, width: int, dims: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{width}").astype(np.int64).reshape(-1, dims)


def _most(a: np.ndarray) -> int:
    return max(int(a.max()), -int(a.min()), 1) if a.size else 1


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of ``a`` with those of ``b``, exact; beyond a long they count as its end."""
    bound = a.shape[1] * _most(a) * _most(b)
    if bound < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, -HIGH, HIGH).astype(np.int64)


class Kept:
    """The first ``k`` (score, then smaller id) of every group among all that was offered and settled."""

    def __init__(self, floors: np.ndarray, k: int) -> None:
        self.k, self.floors = k, floors.astype(np.int64).copy()
        self.held = [np.zeros(0, np.int64) for _ in range(3)]
        self.new: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def offer(self, group: np.ndarray, score: np.ndarray, number: np.ndarray) -> None:
        if len(group):
            self.new.append((group, score, number))

    def settle(self) -> None:
        """Cut every group to its first ``k``; a full group's last score becomes its floor."""
        if not self.new:
            return
        group, score, number = (np.concatenate([h, *c]) for h, c in zip(self.held, zip(*self.new)))
        self.new = []
        order = np.lexsort((number, -score, group))
        group, score, number = group[order], score[order], number[order]
        begins = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        rank = np.arange(len(group)) - np.repeat(begins, np.diff(np.concatenate([begins, [len(group)]])))
        full = rank == self.k - 1
        self.floors[group[full]] = np.maximum(self.floors[group[full]], score[full])
        first = rank < self.k
        self.held = [group[first], score[first], number[first]]


#: What a cell's packed part offers: blocks with ``ids``, ``labels`` (or None) and ``rows``.
Block = tuple[np.ndarray, np.ndarray | None, np.ndarray]
#: Per query the blocks by falling bound, as pairs (bound, number of the block).
Orders = list[Iterable[tuple[float, int]]]


def visit(
    blocks: list[Block], orders: Orders, queries: np.ndarray, ids: np.ndarray, labels: np.ndarray | None,
    lows: np.ndarray, highs: np.ndarray, k: int, wanted: str,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group (query x windows + window), score and id of the first ``k`` rows of every window of every query.

    A row is in a window if its score is from ``lows`` to ``highs``; ``wanted`` is ``any`` other row, or
    those of the ``same`` or of a ``different`` label.  In each turn every query that is not done takes
    its next block, and queries at the same block are scored together.
    """
    windows = lows.shape[1]
    kept = Kept(lows.ravel(), k)
    paths = [iter(order) for order in orders]
    alive = list(range(len(queries)))
    while alive:
        least = kept.floors.reshape(-1, windows).min(axis=1)
        meets: dict[int, list[int]] = {}
        going = []
        for q in alive:
            bound, block = next(paths[q], (None, -1))
            if bound is not None and bound >= least[q]:
                meets.setdefault(block, []).append(q)
                going.append(q)
        alive = going
        for block, members in meets.items():
            found, tags, rows = blocks[block]
            at = np.array(members)
            scores = products(queries[at], rows)
            other = found[None, :] != ids[at][:, None]
            if wanted != "any":
                same = tags[None, :] == labels[at][:, None]
                other &= same if wanted == "same" else ~same
            for w in range(windows):
                group = at * windows + w
                held = other & (scores >= kept.floors[group][:, None]) & (scores <= highs[at, w][:, None])
                i, j = np.nonzero(held)
                kept.offer(group[i], scores[i, j], found[j])
        kept.settle()
    return tuple(kept.held)


_HITS = "chunk long, _id long, tag long, w int, score long, number long"
_QUERY = ["chunk", "_id", "tag"]


def queries_of(rows: DataFrame, code: str, extra: list[str]) -> tuple[DataFrame, int]:
    """Query rows in chunks, with ``tag`` (a hash of all else) that tells rows of one id apart, and the chunks' number."""
    found, chunks = dealt(rows, code, CHUNK, "chunk")
    return found.select("chunk", "_id", F.xxhash64("_v", *extra).alias("tag"), "_v", *extra), chunks


def search(
    queries: DataFrame,
    chunks: int,
    cells: DataFrame,
    summaries: DataFrame,
    parts: int,
    dims: int,
    k: int,
    part_bounds: Callable[[pa.Table, np.ndarray], np.ndarray],
    unpack: Callable[[pa.Table, np.ndarray], tuple[list[Block], Orders]],
    wanted: str = "any",
) -> DataFrame:
    """The first ``k`` rows of every window (``lows``, ``highs``: arrays) of every query, with their ``rank``.

    ``cells`` holds the packed blocks by ``part``, ``summaries`` one row a part that ``part_bounds`` turns
    into bounds (queries x parts), and ``unpack`` gives a part's blocks and each query's order of them.
    """
    spans = -(-parts // SPAN)
    labelled = wanted != "any"
    numbered = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    wide = summaries.select(
        numbered(chunks).alias("chunk"),
        F.floor(F.col("part") / SPAN).alias("span"),
        *summaries.columns,
    )

    def bounds(rows: DataFrame, home: bool) -> DataFrame:
        """The best part of each span, or every part but the home that is not below the floor."""

        def each(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                names = [*_QUERY, "part", "bound"]
                return pa.table([pa.array([], t) for t in [pa.int64()] * 4 + [pa.float64()]], names)
            found = part_bounds(left, matrix(right["_v"], dims)).astype(np.float64)
            numbers = left["part"].to_numpy()
            if home:
                q, p = np.arange(len(found)), found.argmax(axis=1)
            else:
                least = right["least"].to_numpy()
                q, p = np.nonzero((found >= least[:, None]) & (numbers[None, :] != right["home"].to_numpy()[:, None]))
            held = [right[c].to_numpy()[q] for c in _QUERY]
            return pa.table([*held, numbers[p], found[q, p]], [*_QUERY, "part", "bound"])

        columns = [*_QUERY, "_v"] + ([] if home else ["least", "home"])
        asked = rows.select(*columns, numbered(spans).alias("span"))
        # Floats of bounds beyond 2^53 are rounded; both sides of the comparison are floats then.
        return wide.groupBy("chunk", "span").cogroup(asked.groupBy("chunk", "span")).applyInArrow(
            each, "chunk long, _id long, tag long, part long, bound double"
        )

    def look(rows: DataFrame) -> DataFrame:
        def each(left: pa.Table, right: pa.Table) -> pa.Table:
            held = [np.zeros(0, np.int64)] * 3
            windows, n = 1, right.num_rows
            if n and left.num_rows:
                asked = matrix(right["_v"], dims)
                windows = len(right["lows"][0])
                lows, highs = matrix(right["lows"], windows), matrix(right["highs"], windows)
                blocks, orders = unpack(left, asked)
                tags = right["label"].to_numpy() if labelled else None
                held = visit(blocks, orders, asked, right["_id"].to_numpy(), tags, lows, highs, k, wanted)
            group, score, number = held
            q = group // windows
            out = [right[c].to_numpy()[q] if n else group for c in _QUERY]
            return pa.table(
                [*out, (group % windows).astype(np.int32), score, number], [*_QUERY, "w", "score", "number"]
            )

        met = rows.select(F.col("chunk").alias("at_chunk"), F.col("part").alias("at_part")).distinct()
        left = cells.join(met, F.col("part") == F.col("at_part"))
        return left.groupBy("at_chunk", "at_part").cogroup(rows.groupBy("chunk", "part")).applyInArrow(each, _HITS)

    best = bounds(queries, True).groupBy(*_QUERY).agg(F.max_by("part", F.struct("bound", -F.col("part"))).alias("part"))
    homes = stored(queries.join(best, _QUERY), "search-homes")
    first = stored(look(homes), "search-first")
    floors = (
        first.groupBy(*_QUERY, "w")
        .agg(F.count("*").alias("n"), F.min("score").alias("score"))
        .where(F.col("n") >= k)
        .groupBy(*_QUERY)
        .agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("floors"))
    )
    raised = F.transform("lows", lambda low, w: F.greatest(low, F.coalesce(F.try_element_at("floors", w), low)))
    known = (
        homes.join(floors, _QUERY, "left")
        .withColumn("lows", F.when(F.col("floors").isNull(), F.col("lows")).otherwise(raised))
        .drop("floors")
        .withColumnRenamed("part", "home")
        .withColumn("least", F.array_min("lows").cast("double"))
    )
    known = stored(known, "search-known")
    others = bounds(known, False).select(*_QUERY, "part")
    second = look(known.drop("home", "least").join(others, _QUERY))
    order = Window.partitionBy("_id", "tag", "w").orderBy(F.desc("score"), "number")
    hits = first.unionByName(second).withColumn("rank", F.row_number().over(order))
    return hits.where(F.col("rank") <= k).select("_id", "tag", "w", "rank", "number", "score")
