"""Broadcast a join side only when its size is proven small.

A side is hinted for broadcast only when one aggregate over it proves both
bounds: at most ``scorekeep.broadcast.maxRows`` rows, and at most
``scorekeep.broadcast.maxBytes`` bytes, counted as rows x the fixed-width
bytes of its columns plus the exact byte length of every text value (and of
the JSON form of nested values).  The aggregate is an ordinary distributed
one (each task sums its split, only per-task sums are shuffled), so probing
a side that turns out to be large costs one scan and never funnels rows
into one task.  A side over a bound is returned unhinted: the join is then
a shuffle (sort-merge) join on its keys, where AQE can still split skewed
partitions or switch to a broadcast once real shuffle sizes are known.

A size once measured is kept for the session as long as the source files stay
the same.  The checks of one operator run concurrently (one Spark job each, submitted
from separate driver threads), so their latency is that of the slowest.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorekeep.session import files_state

CONF_MAX_ROWS = "scorekeep.broadcast.maxRows"
CONF_MAX_BYTES = "scorekeep.broadcast.maxBytes"
DEFAULT_MAX_ROWS = 500_000
DEFAULT_MAX_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 16            # per-row header of an unsafe row / hash-map entry
TEXT_SLOT = 8                # offset and length word of a variable-length value

_FIXED = {T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
          T.IntegerType: 4, T.FloatType: 4, T.DateType: 4, T.ShortType: 2, T.ByteType: 1,
          T.BooleanType: 1, T.DecimalType: 16, T.NullType: 1}


def max_broadcast_rows(spark) -> int:
    value = spark.conf.get(CONF_MAX_ROWS, None)
    return int(value) if value else DEFAULT_MAX_ROWS


def max_broadcast_bytes(spark) -> int:
    value = spark.conf.get(CONF_MAX_BYTES, None)
    return int(value) if value else DEFAULT_MAX_BYTES


def _layout(df: DataFrame):
    """(fixed bytes per row, columns whose byte length must be measured)."""
    fixed, variable = ROW_OVERHEAD, []
    for field in df.schema.fields:
        width = next((w for t, w in _FIXED.items() if isinstance(field.dataType, t)), None)
        if width is not None:
            fixed += width
        else:
            fixed += TEXT_SLOT
            variable.append(field)
    return fixed, variable


def _value_bytes(field) -> F.Column:
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(c)), F.lit(0))


def within_bounds(spark, size: tuple[int, int], max_rows: int | None = None) -> bool:
    rows = max_broadcast_rows(spark) if max_rows is None else max_rows
    return size[0] <= rows and size[1] <= max_broadcast_bytes(spark)


#: Estimates this many times over the byte bound are taken as too large without a look: they count compressed files.
SURELY_TOO_LARGE = 64
_probed: dict[tuple, tuple[int, int]] = {}


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size of df where it says something: one file scan and projections of it.  Joins multiply
    their sides' estimates, and filters and aggregates leave fewer rows than it knows.  No job runs."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
        nodes = re.findall(r"^[\s:+-]*(\w+)", plan.toString(), flags=re.M)
        if not df.inputFiles() or set(nodes) - {"Project", "Relation"} or nodes.count("Relation") != 1:
            return None
        return int(str(plan.stats().sizeInBytes()))
    except Exception:   # a session without access to the plan: measure
        return None


def size_probe(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``.

    For a plain scan the optimizer's estimate comes first: far over the byte
    bound it is returned as it is, with a row count over any bound.  Otherwise
    one distributed aggregate measures, and the result is remembered for the same
    plan over the same unchanged files, so queries of one session that share
    a side measure it once."""
    estimate = estimated_bytes(df)
    if estimate is not None and estimate > SURELY_TOO_LARGE * max_broadcast_bytes(df.sparkSession):
        return 1 << 62, estimate
    state = files_state(df)
    if state is not None:
        state = (df.sparkSession.sparkContext.applicationId, df.semanticHash(), df.schema.json(), state)
    if state is not None and state in _probed:
        return _probed[state]
    size = measured_size(df)
    if state is not None:
        _probed[state] = size
    return size


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` from one distributed aggregate."""
    fixed, variable = _layout(df)
    aggs = [F.count(F.lit(1)).alias("n")]
    if variable:
        total = None
        for f in variable:
            b = _value_bytes(f).cast("bigint")
            total = b if total is None else total + b
        aggs.append(F.sum(total).alias("b"))
    row = df.agg(*aggs).first()
    n = int(row["n"])
    text = int(row["b"] or 0) if variable else 0
    return n, n * fixed + text


def bounded_broadcast(df: DataFrame, max_rows: int | None = None,
                      bound_by: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its size is proven under the bounds.

    ``bound_by`` may name a cheaper frame whose rows and bytes bound
    ``df``'s (for example the dimension scan a projection was made from).
    """
    return bounded_broadcasts((df, bound_by), max_rows=max_rows)[0]


def bounded_broadcasts(*sides, max_rows: int | None = None) -> list[DataFrame]:
    """Check several sides at once.  Each side is a DataFrame, or a pair
    ``(df, bound)`` where ``bound`` is a frame whose size bounds ``df``'s,
    or a proven ``(rows, bytes)`` size (see ``size_probe``)."""
    return counted_broadcasts(*sides, max_rows=max_rows)[0]


def counted_broadcasts(*sides, max_rows: int | None = None):
    """As ``bounded_broadcasts``, also returning each side's proven
    ``(rows, bytes)`` size (callers derive sizes of joins of these sides)."""
    items = [s if isinstance(s, tuple) else (s, None) for s in sides]
    if not items:
        return [], []
    spark = items[0][0].sparkSession
    row_limit = max_broadcast_rows(spark) if max_rows is None else max_rows
    byte_limit = max_broadcast_bytes(spark)

    def probe(item) -> tuple[int, int]:
        df, bound = item
        if isinstance(bound, tuple):
            return bound
        if bound is None or isinstance(bound, int):   # a row count alone proves no bytes
            return size_probe(df)
        return size_probe(bound)

    if len(items) == 1:
        sizes = [probe(items[0])]
    else:
        with ThreadPoolExecutor(max_workers=len(items)) as pool:
            sizes = list(pool.map(probe, items))
    out = [F.broadcast(df) if n <= row_limit and b <= byte_limit else df
           for (df, _), (n, b) in zip(items, sizes)]
    return out, sizes


def fixed_row_bytes(df: DataFrame) -> int:
    """Fixed-width bytes of one row of ``df`` (text values not included)."""
    return _layout(df)[0]
