"""Names for stored tables: namespaces, external tables, views and listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from armlift.sources.schemas import Columns
from armlift.sources.tables import PARTITION


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _quoted(name: str) -> str:
    return ".".join(_identifier(part) for part in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def ensure_table(spark: SparkSession, name: str, columns: Columns, path: str) -> None:
    """Create namespace and partitioned table over ``path`` unless they exist.

    Run again after a write, it makes new experiments visible under the name.
    """
    namespace = name.rpartition(".")[0]
    if namespace:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {_quoted(namespace)}")
    layout = ", ".join(f"{_identifier(c)} {t}" for c, t in columns.items())
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({layout}) "
        f"USING parquet PARTITIONED BY ({PARTITION}) LOCATION {_text(path)}"
    )
    spark.catalog.recoverPartitions(name)


def create_or_replace(df: DataFrame, name: str) -> None:
    """The table as a whole, replaced by ``df``."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def publish_views(frames: dict[str, DataFrame]) -> None:
    """Temporary views by name, for SQL on intermediate results."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, namespace: str) -> DataFrame:
    """(table_name, temporary) of a namespace."""
    return spark.sql(f"SHOW TABLES IN {_quoted(namespace)}").select(
        F.col("tableName").alias("table_name"), F.col("isTemporary").alias("temporary")
    )
