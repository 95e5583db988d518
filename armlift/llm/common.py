"""Helpers shared by the training-data operators.

Operators read the columns they need under names of their own (``_id``, ``_text``), so further
columns of the input, whatever they are called, are neither read nor in the way.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from armlift.sources.tables import drop_path, new_path

#: White space of the word rule ``[^\x20\x09-\x0D]+``.
SPACE = " \t\n\x0b\x0c\r"
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 8 << 20
#: Folders of this program's stored tables that still stand.
_STORED: list[str] = []


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``_text`` of every row; a NULL text is the empty text."""
    return docs.select(
        F.col(id_col).cast("long").alias("_id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
    )


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z lower-cased and all other characters as they are."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: Column) -> Column:
    """The words ``[^\x20\x09-\x0D]+`` of a text as an array."""
    bare = F.btrim(text, F.lit(SPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[\x20\x09-\x0D]+")
    )


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back, for plans that use it again."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    _STORED.append(path)
    return table


def drop(*tables: DataFrame) -> None:
    """Remove tables that :func:`stored` returned, once nothing reads them any more."""
    for table in tables:
        drop_path(table.sparkSession, table._stored_at)
        _STORED.remove(table._stored_at)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is :func:`stored` inside is removed at the end, for work whose result is written by then."""
    held, _STORED[:] = list(_STORED), []
    try:
        yield
    finally:
        for path in _STORED:
            drop_path(spark, path)
        _STORED[:] = held


def small(df: DataFrame, rows: int = BROADCAST_ROWS, text_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if it has at most so many rows and bytes of text, else as it is.

    Other columns have a fixed width, so both bounds together bound its size.  Without the mark the
    same join shuffles, and adaptive execution splits its hot keys.
    """
    texts_ = [c for c, kind in df.dtypes if kind == "string"]
    wide = [c for c, kind in df.dtypes if kind == "binary" or kind.startswith(("array", "map", "struct"))]
    if wide:
        raise ValueError(f"no bound on the size of {wide}")
    held = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts_), F.lit(0))
    found, size = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(held), F.lit(0))).first()
    return F.broadcast(df) if found <= rows and size <= text_bytes else df


def spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """``df`` dealt by ``key`` over as many tasks as give each about so many rows, before they multiply."""
    return df.repartition(max(1, -(-df.count() // rows)), key)
