"""Exact top-k inner products by block-at-a-time pruning.

A vector is a document whose terms are its signed components.  Documents are ordered by their heaviest
term and cut into ranges, the blocks.  A block has a forward index (its rows) and every term's maximum in
it.  A query's bound for a block is the sum of its own weights times these maxima; it scores blocks through
their forward indexes by falling bound until the next bound is below its k-th score (``vectors``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from armlift.llm import vectors
from armlift.llm.common import stored

#: Documents of a block.
BLOCK = 128


def _heaviest() -> Column:
    """The term of a vector's largest component by amount: twice its place, and one more if it is negative."""
    high, low = F.array_max("_v"), F.array_min("_v")
    place = F.when(high >= -low, F.array_position("_v", high) * 2).otherwise(F.array_position("_v", low) * 2 + 1)
    return F.coalesce(place, F.lit(0)).cast("long")


def _packed(rows: DataFrame, dims: int) -> DataFrame:
    """One row a block: ``part``, ``ids``, ``rows`` and ``maxima`` (of the components, then of their opposites)."""

    def each(table: pa.Table) -> pa.Table:
        ids, found = table["_id"].to_numpy(), vectors.matrix(table["_v"], dims)
        # Like vectors side by side: by the signs of the components, the first counting most, then by id.
        signs = np.packbits(found > 0, axis=1)
        order = np.lexsort((ids, *signs.T[::-1], table["code"].to_numpy()))
        ids, found = ids[order], found[order]
        out = []
        for at in range(0, len(ids), BLOCK):
            block = found[at : at + BLOCK]
            raw, width = vectors.narrow(block)
            maxima = np.concatenate([block.max(axis=0), (-block).max(axis=0)])
            out.append((ids[at : at + BLOCK], raw, width, maxima))
        part = table["part"][0].as_py()
        return pa.table(
            [
                pa.array([part] * len(out), pa.int64()),
                pa.array([o[0] for o in out], pa.list_(pa.int64())),
                pa.array([o[1] for o in out], pa.binary()),
                pa.array([o[2] for o in out], pa.int32()),
                pa.array([o[3] for o in out], pa.list_(pa.int64())),
            ],
            ["part", "ids", "rows", "width", "maxima"],
        )

    schema = "part long, ids array<bigint>, rows binary, width int, maxima array<bigint>"
    return rows.select("part", "code", "_id", "_v").groupBy("part").applyInArrow(each, schema)


def _bounds(maxima: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Queries x blocks: what no document of a block can be above."""
    weights = np.concatenate([np.maximum(queries, 0), np.maximum(-queries, 0)], axis=1)
    return vectors.products(weights, maxima)


def top_k(table: DataFrame, k: int = 20, every: int = 20, factor: int = 64) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's ``k`` best rows.

    Queries are the rows whose ``vec_id`` is divisible by ``every``; candidates are all rows with another
    ``vec_id``.  The score is the inner product of the vectors floor(``factor`` x component); equal
    scores go to the smaller ``vec_id``.  A row without ``vec_id`` or vector, or with a NULL or non-finite
    component, takes no part; an empty vector has score 0 with all, and shorter vectors are filled up with
    zeros.  Rows equal in id and vector are one row; rows of one id with different vectors are told
    apart, as queries too, but none is found for another.  Scores beyond a long count as its end.  An
    empty table gives no rows; further columns are ignored.
    """
    rows = vectors.whole_numbers(table, factor, {"id": "vec_id", "vector": "embedding"})
    rows = stored(rows.withColumn("code", _heaviest()), "top-k-rows")
    dims = rows.agg(F.max(F.size("_v"))).first()[0]
    if dims is None:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dims = max(1, dims)
    rows = vectors.filled(rows, dims)
    placed, parts = vectors.dealt(rows, "code", vectors.PART, "part")
    blocks = stored(_packed(placed, dims), "top-k-blocks")
    ends = [F.array(F.lit(end).cast("long")) for end in (-vectors.HIGH, vectors.HIGH)]
    asked = rows.where(F.col("_id") % every == 0).withColumns({"lows": ends[0], "highs": ends[1]})
    queries, chunks = vectors.queries_of(asked, "code", ["lows", "highs"])
    queries = stored(queries, "top-k-queries")
    summary = blocks.groupBy("part").agg(F.collect_list("maxima").alias("maxima"))

    def part_bounds(parts_: pa.Table, asked_: np.ndarray) -> np.ndarray:
        return np.stack(
            [_bounds(np.array(m, np.int64), asked_).max(axis=1) for m in parts_["maxima"].to_pylist()], axis=1
        )

    def unpack(part: pa.Table, asked_: np.ndarray):
        blocks_ = [
            (np.array(ids.as_py(), np.int64), None, vectors.widen(raw.as_py(), width.as_py(), dims))
            for ids, raw, width in zip(part["ids"], part["rows"], part["width"])
        ]
        bounds = _bounds(vectors.matrix(part["maxima"], 2 * dims), asked_)
        order = np.argsort(-bounds, axis=1, kind="stable")
        return blocks_, [zip(bounds[q, o].tolist(), o.tolist()) for q, o in enumerate(order)]

    hits = vectors.search(queries, chunks, blocks, summary, parts, dims, k, part_bounds, unpack)
    return hits.select(F.col("_id").alias("query_id"), "rank", F.col("number").alias("vec_id"), "score")
