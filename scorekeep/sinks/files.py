"""File sinks.  Output is written by all tasks in parallel; nothing is
funnelled through one partition."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
