"""Catalog-table sinks: the typed target DDL, positional inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorekeep.fixed_values import DETAIL_TARGET_COLUMNS


def create_table(spark: SparkSession, name: str, columns, location: str | None = None,
                 partitioned_by: list[str] | None = None, clustered_by: tuple[str, int] | None = None) -> None:
    cols = ",\n  ".join(f"`{c}` {t}" for c, t in columns)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} (\n  {cols}\n) USING parquet"
    if partitioned_by:
        ddl += f" PARTITIONED BY ({', '.join(partitioned_by)})"
    if clustered_by:
        key, buckets = clustered_by
        ddl += f" CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS"
    if location:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def create_detail_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    create_table(spark, name, DETAIL_TARGET_COLUMNS, location)


def insert_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by column position (names are not matched); values are cast to
    the table's types under the session's store-assignment rules."""
    df.write.insertInto(table, overwrite=overwrite)


def insert_select(spark: SparkSession, table: str, view: str) -> None:
    spark.sql(f"INSERT INTO {table} SELECT * FROM {view}")
