"""Splitting hot keys out of a join that cannot be re-partitioned.

Shuffle joins get skew handling from AQE, which splits an oversized shuffle
partition.  A join of bucketed tables has no shuffle, so a key that holds a
large share of the rows makes one oversized task.  ``split_hot_join`` finds
the hot keys and joins them separately:

* a key is hot when it has more rows than an average bucket
  (``rows / buckets``), so there are fewer hot keys than buckets -- a
  proven bound, which makes the hot-key list safe to collect and use as a
  filter (filters keep the bucketed layout);
* rows with a hot key join the matching right rows by broadcast (the right
  side is expected to be a dimension, a few rows per key; the hot subset
  is size-checked);
* all other rows keep the bucketed, exchange-free join.

Counting per key on a table bucketed by that key needs no shuffle either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.plans.broadcast import bounded_broadcast


def hot_keys(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Keys with more rows than ``rows / buckets`` (fewer than ``buckets`` of them)."""
    threshold = max(1, df.count() // max(1, buckets))
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
            .where(F.col("__n") > threshold).select(key))


def split_hot_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   buckets: int, how: str = "inner") -> DataFrame:
    if how not in ("inner", "left"):
        raise ValueError("hot-key splitting keeps inner and left join semantics only")
    hot = [r[0] for r in hot_keys(left, left_key, buckets).limit(buckets).collect()]
    if not hot:                                   # < buckets keys by construction
        return left.join(right, left[left_key] == right[right_key], how)
    # plain filters keep the bucketed layout of both scans; a null key is not hot
    is_hot = F.col(left_key).isin(hot)
    left_hot = left.where(is_hot)
    left_cold = left.where(F.coalesce(~is_hot, F.lit(True)))
    right_hot = bounded_broadcast(right.where(F.col(right_key).isin(hot)))
    return (left_cold.join(right, left_cold[left_key] == right[right_key], how)
            .unionByName(left_hot.join(right_hot, left_hot[left_key] == right_hot[right_key],
                                       how)))
