"""Catalog views and tables, plain file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_views(tables, prefix: str = "") -> list[str]:
    """Register every exam table as a temp view (``prefix + name``)."""
    names = []
    for table in tables.NAMES:
        name = prefix + table
        getattr(tables, table).createOrReplaceTempView(name)
        names.append(name)
    return names


def table_scan(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def partition_count(df: DataFrame) -> int:
    return df.rdd.getNumPartitions()


def text_scan(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files as a one-column (``value``) DataFrame."""
    return spark.read.text(path)
