"""Partitioned Parquet tables with replace and upsert by experiment.

A table is a directory partitioned by ``experiment_id``.  Replacement is
Spark's dynamic partition overwrite: a rerun gives the same table and leaves
other experiments alone.  An upsert reads the partitions it touches, writes
the merged rows to a staging table beside the table, and then moves the staged
folders into place, so no plan reads a path it overwrites and rows are written
once.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import urllib.parse
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

PARTITION = "experiment_id"


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without the setting falls back to a temporary folder,
    which goes when the program ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="armlift-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` computed now and kept in the shared folder, for plans that use it several times."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    handle = spark._jvm.org.apache.hadoop.fs.Path(path)
    return handle, handle.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    handle, fs = _hadoop_path(spark, path)
    return fs.exists(handle)


def drop_path(spark: SparkSession, path: str) -> None:
    handle, fs = _hadoop_path(spark, path)
    fs.delete(handle, True)


def escaped(spark: SparkSession, value: str) -> str:
    """A partition value as it stands in a folder name."""
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, which is dropped."""
    handle, fs = _hadoop_path(spark, target)
    fs.delete(handle, True)
    fs.mkdirs(handle.getParent())
    if not fs.rename(_hadoop_path(spark, source)[0], handle):
        raise OSError(f"cannot move {source} to {target}")


def drop_matching(spark: SparkSession, pattern: str) -> None:
    """Drop all folders that a pattern names."""
    handle, fs = _hadoop_path(spark, pattern)
    for found in fs.globStatus(handle) or ():
        fs.delete(found.getPath(), True)


def replace_folders(spark: SparkSession, staged: str, path: str, depth: int = 1) -> None:
    """Put a staged table's partition folders in the place of those of a table; other folders stay.

    Both lie in one file system.  Nothing is written again: a folder takes two calls.  A failure
    between them leaves that partition out until the next run.
    """
    root, fs = _hadoop_path(spark, staged)
    below = len(fs.makeQualified(root).toString()) + 1
    for found in fs.globStatus(_hadoop_path(spark, staged + "/*=*" * depth)[0]) or ():
        folder = found.getPath()
        move(spark, folder.toString(), f"{path}/{folder.toString()[below:]}")


def partition_names(spark: SparkSession, path: str) -> set[str]:
    """Experiments that have a partition, from one listing of the table's folder.

    The folder name of a missing id is left out; others are percent-encoded.
    """
    handle, fs = _hadoop_path(spark, f"{path}/{PARTITION}=*")
    names = (s.getPath().getName().partition("=")[2] for s in fs.globStatus(handle) or ())
    return {urllib.parse.unquote(n) for n in names if n != _NO_ID}


_NO_ID = "__HIVE_DEFAULT_PARTITION__"


def has_partitions(spark: SparkSession, path: str) -> bool:
    """Whether anything was ever stored: writing no rows leaves a folder without a schema."""
    handle, fs = _hadoop_path(spark, f"{path}/{PARTITION}=*")
    return bool(fs.globStatus(handle))


def read_table(spark: SparkSession, path: str, layout: StructType | None = None) -> DataFrame:
    """The table with ``experiment_id`` as text, whatever the ids look like.

    ``layout`` is the schema to report when nothing was ever stored.
    """
    if layout is not None and not has_partitions(spark, path):
        return spark.createDataFrame([], layout)
    found = spark.read.parquet(path).schema
    fields = [StructField(PARTITION, StringType()) if f.name == PARTITION else f for f in found]
    return spark.read.schema(StructType(fields)).parquet(path)


def replace_partitions(
    df: DataFrame, path: str, experiment_ids: Iterable[str] | None = None, staged: bool = True
) -> None:
    """Replace every experiment present in ``df``; other experiments keep their files.

    With ``experiment_ids``, those of them that ``df`` has no row of are emptied
    too: what is left afterwards is what ``df`` says about them.  The new rows
    are then staged first, so that ``df`` is computed once and may read the table
    it replaces.  A fact read straight from its files is better not ``staged``:
    its ids are then read again, and only those that might be left over.

    The rebalance hint lets the adaptive planner split a large experiment over
    many writers and merge small ones, so file sizes follow data, not keys.
    """
    if experiment_ids is not None and staged:
        return _swap_in(df, path, experiment_ids)
    spark = df.sparkSession
    stale = set() if experiment_ids is None else set(experiment_ids) & partition_names(spark, path)
    if stale:
        kept = df.where(F.col(PARTITION).isin(sorted(stale))).select(PARTITION).distinct()
        stale -= {r[0] for r in kept.collect()}
    (
        df.hint("rebalance", PARTITION)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(PARTITION)
        .parquet(path)
    )
    _drop_partitions(spark, path, stale)
    spark.catalog.refreshByPath(path)


def _drop_partitions(spark: SparkSession, path: str, experiment_ids: Iterable[str]) -> None:
    for experiment_id in experiment_ids:
        drop_path(spark, f"{path}/{PARTITION}={escaped(spark, experiment_id)}")


def beside(table: str) -> str:
    """A new folder in the file system of a table, to move folders from."""
    return f"{table.rstrip('/')}-staged-{uuid.uuid4().hex}"


def _stage(df: DataFrame, table: str) -> str:
    """``df`` as a partitioned table in a new folder beside ``table``."""
    path = beside(table)
    df.hint("rebalance", PARTITION).write.partitionBy(PARTITION).parquet(path)
    return path


def _swap_in(rows: DataFrame, path: str, cleared: Iterable[str] = ()) -> None:
    """Stage ``rows``, replace their partitions, drop ``cleared`` ones left with no row.

    Rows are written once: the staged folders, beside the table, are moved into their places.
    """
    spark = rows.sparkSession
    staged = _stage(rows, path)
    try:
        empty = set(cleared) - partition_names(spark, staged)
        unnamed = exists(spark, f"{staged}/{PARTITION}={_NO_ID}")
        replace_folders(spark, staged, path)
        _drop_partitions(spark, path, empty & partition_names(spark, path))
        if empty and not unnamed:
            drop_path(spark, f"{path}/{PARTITION}={_NO_ID}")  # rows without an id belong to every run
        spark.catalog.refreshByPath(path)
    finally:
        drop_path(spark, staged)


def delete_append(df: DataFrame, path: str, experiment_ids: Sequence[str]) -> None:
    """Drop the listed experiments and append their new rows; rows of others are ignored."""
    _swap_in(df.where(F.col(PARTITION).isin(list(experiment_ids))), path, experiment_ids)


def _same_layout(existing: DataFrame, df: DataFrame) -> DataFrame:
    """Stored rows with the column order and types of ``df``."""
    return existing.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in df.schema])


def delete_append_by_metric(
    df: DataFrame,
    path: str,
    experiment_ids: Sequence[str],
    metric_names: Sequence[str] | None = None,
) -> None:
    """Drop (experiment, metric) rows for the listed metrics, or whole experiments, then append."""
    if not metric_names or not has_partitions(df.sparkSession, path):
        return delete_append(df, path, experiment_ids)
    mine = F.col(PARTITION).isin(list(experiment_ids))
    kept = read_table(df.sparkSession, path).where(
        mine & ~F.coalesce(F.col("metric_name").isin(list(metric_names)), F.lit(False))
    )
    _swap_in(_same_layout(kept, df).unionByName(df.where(mine)), path, experiment_ids)


def merge_upsert(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Insert or overwrite by key.  A key given twice in ``df`` is an error; NULLs are equal.

    ``df`` is computed once, into a staging table that the checks and the
    merge then read.  Only the partitions it has rows for are read and written.
    """
    spark, keys = df.sparkSession, list(keys)
    staged = _stage(df, path)
    try:
        rows = spark.read.schema(df.schema).parquet(staged)
        if not rows.groupBy(*keys).count().where("count > 1").isEmpty():
            raise ValueError(f"merge source has several rows for one key {keys}")
        if not has_partitions(spark, path):
            return replace_partitions(rows, path)
        old, new = read_table(spark, path).alias("old"), rows.select(*keys).alias("new")
        touched = F.col(PARTITION).isin(sorted(partition_names(spark, staged)))
        if not rows.where(F.col(PARTITION).isNull()).isEmpty():
            touched |= F.col(PARTITION).isNull()
        same = reduce(and_, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
        kept = old.where(touched).join(new, same, "left_anti").select("old.*")
        _swap_in(_same_layout(kept, df).unionByName(rows), path)
    finally:
        drop_path(spark, staged)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, experiment_id, rows) over any set of tables."""
    counts = [
        df.groupBy(PARTITION)
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("table_name"), PARTITION, "rows")
        for name, df in tables.items()
    ]
    first, *rest = counts
    for other in rest:
        first = first.unionByName(other)
    return first
