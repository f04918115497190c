"""Audit columns added on export: a random id and load timestamps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_audit_columns(df: DataFrame, id_col: str = "id", time_cols=("createDate",),
                       constants: dict | None = None) -> DataFrame:
    """Add a random UUID id, current-timestamp columns and constant columns.

    ``uuid()`` is evaluated per row on the executors; ``current_timestamp()``
    is fixed once per query, so every row of one write shares the same time.
    """
    cols = {id_col: F.expr("uuid()")}
    for name in time_cols:
        cols[name] = F.current_timestamp()
    for name, value in (constants or {}).items():
        cols[name] = F.lit(value)
    return df.withColumns(cols)
