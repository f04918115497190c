"""Keep rows that surely match nothing out of a join's shuffle.

When the right side of a join is over the broadcast bound, every row of the
fact is shuffled, also those whose key is nowhere on the right.  Here the
right keys are hashed into bits (``BITS_PER_KEY`` for each key or up to twice
as many, never over the broadcast byte bound), packed into bitmaps of 32,768
bits and broadcast; each key sets two bits of one bitmap.  A row without both
bits matches nothing: a left join leaves it where it is, an inner join drops
it.  The others -- the matching rows and a few that share the bits by chance --
go through the join.  So the result is that of the plain join whatever the
hashes do; only the number of shuffled rows depends on them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorekeep.plans.broadcast import max_broadcast_bytes, measured_size

CONF_MIN_ROWS = "scorekeep.keyfilter.minRows"
DEFAULT_MIN_ROWS = 100_000   # fewer right rows are shuffled in less than AQE's own broadcast bound
BITS_PER_KEY = 8
BITMAP_BITS = 32_768         # the span of one bitmap_construct_agg
UNKNOWN = 1 << 40            # "rows" of a size probe that went by an estimate

# equal values of one of these types have equal hashes
_HASHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)

# the bitmap's bytes as 512 words; a word's first byte is its highest, so bit p of it is at 56 - p + 2 * (p % 8)
_WORDS = """transform(sequence(0, 511), i ->
    shiftleft(cast(conv(hex(substring(kf_bits, 8 * i + 1, 4)), 16, 10) AS bigint), 32)
    | cast(conv(hex(substring(kf_bits, 8 * i + 5, 4)), 16, 10) AS bigint))"""
_IS_SET = " AND ".join(
    f"coalesce(getbit(get(kf_words, cast({at} div 64 AS int)), cast(56 - {at} % 64 + 2 * ({at} % 8) AS int)) = 1, false)"
    for at in ("kf_at", "kf_also"))


def _hashable(left: T.DataType, right: T.DataType) -> bool:
    return left == right and (isinstance(left, _HASHED) or left == T.StringType())


def _slots(columns: list[str], bits: int) -> tuple[Column, Column, Column]:
    """(bitmap, bit, other bit) of a key: the lowest bits of its hash, and others of it.  None is ever null, so the
    join on the bitmap adds no filter to the keys' scan."""
    digest, last = F.xxhash64(*columns), F.lit(BITMAP_BITS - 1).cast("long")
    slot = digest.bitwiseAND(F.lit(bits - 1).cast("long"))
    return (F.shiftright(slot, BITMAP_BITS.bit_length() - 1), slot.bitwiseAND(last),
            F.shiftrightunsigned(digest, 40).bitwiseAND(last))


def _bits(spark, n_keys: int) -> int:
    """The power of two that gives each key its bits, within the byte bound of a broadcast."""
    most = max(BITMAP_BITS, max_broadcast_bytes(spark) * 8)
    bits = BITMAP_BITS
    while bits < n_keys * BITS_PER_KEY and bits * 2 <= most:
        bits *= 2
    return bits


def key_bitmaps(keys: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """(kf_bucket, kf_words): two set bits for every key."""
    bucket, at, also = _slots(columns, bits)
    return (keys.select(bucket.alias("kf_bucket"), F.explode(F.array(at, also)).alias("kf_pos"))
            .groupBy("kf_bucket").agg(F.bitmap_construct_agg("kf_pos").alias("kf_bits"))
            .select("kf_bucket", F.expr(_WORDS).alias("kf_words")))


def _looked_up(rows: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str],
               n_keys: int) -> DataFrame | None:
    """The rows, each with the bitmap and the bits of its key, or None where that does not pay: few keys, so many
    that most of the bits would be set, keys whose equality is not that of their hashes, or a stream."""
    spark = rows.sparkSession
    types = [(rows.schema[c].dataType, keys.schema[k].dataType) for c, k in zip(columns, key_columns, strict=True)]
    if rows.isStreaming or not all(_hashable(a, b) for a, b in types):
        return None
    if n_keys >= UNKNOWN:
        n_keys = measured_size(keys.select(*key_columns))[0]
    bits = _bits(spark, n_keys)
    if n_keys < int(spark.conf.get(CONF_MIN_ROWS, None) or DEFAULT_MIN_ROWS) or 2 * n_keys > bits:
        return None
    bucket, at, also = _slots(columns, bits)
    maps = F.broadcast(key_bitmaps(keys, key_columns, bits).withColumnRenamed("kf_bucket", "kf_right"))
    return (rows.select("*", bucket.alias("kf_bucket"), at.alias("kf_at"), also.alias("kf_also"))
            .join(maps, F.col("kf_bucket") == F.col("kf_right"), "left"))


def split_by_keys(rows: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str],
                  n_keys: int) -> tuple[DataFrame, DataFrame] | None:
    """(rows that may have a match among the keys, rows that have none), or None where a split does not pay."""
    looked_up = _looked_up(rows, columns, keys, key_columns, n_keys)
    if looked_up is None:
        return None
    may_match = F.expr(_IS_SET)
    return (looked_up.where(may_match).select(*rows.columns), looked_up.where(~may_match).select(*rows.columns))


def rows_that_may_match(rows: DataFrame, columns: list[str], keys: DataFrame, key_columns: list[str],
                        n_keys: int) -> DataFrame:
    """The rows without those that surely match no key, for an inner join; all of them where telling does not pay."""
    parts = split_by_keys(rows, columns, keys, key_columns, n_keys)
    return rows if parts is None else parts[0]
