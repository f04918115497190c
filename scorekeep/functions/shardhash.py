"""Shard routing hash, equal to the Java ``String.hashCode`` modulo rule.

A shard of a string key is ``abs(h) % n`` where ``h`` is Java's 32-bit
``String.hashCode`` (``h = 31*h + unit`` over UTF-16 code units, wrapping)
and ``abs`` is Java's ``Math.abs`` on int (so ``abs(MIN_VALUE)`` stays
negative).  Spark's own ``hash()`` is Murmur3 and cannot be used.

Computed as one JVM expression: ``aggregate`` folds the key's code points
(``ascii`` of each one-character substring gives the code point).  A code
point above U+FFFF is two UTF-16 units in Java, a high and a low surrogate,
so it is folded in as ``h*31*31 + high*31 + low``; an all-ASCII key (the
usual id or UUID) takes a shorter fold without that test.  The fold is reduced
modulo 2^32 at each step, so it never overflows a bigint, and the sign is
restored once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_TWO_32 = 4294967296
_TWO_31 = 2147483648


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def java_string_hash(col) -> Column:
    """Java ``String.hashCode`` of a string column, as int (null for null)."""
    key = _c(col).cast("string")

    def step(acc, i):
        cp = F.ascii(F.substring(key, i, 1)).cast("bigint")
        supplementary = cp - 65536
        high = F.shiftright(supplementary, 10) + 0xD800
        low = supplementary.bitwiseAND(0x3FF) + 0xDC00
        return F.when(cp > 0xFFFF, (acc * 961 + high * 31 + low) % _TWO_32).otherwise(
            (acc * 31 + cp) % _TWO_32)

    def ascii_step(acc, i):
        return (acc * 31 + F.ascii(F.substring(key, i, 1))) % _TWO_32

    positions = F.sequence(F.lit(1), F.length(key))
    zero = F.lit(0).cast("bigint")
    unsigned = (F.when(F.length(key) == 0, zero)
                # ASCII keys (ids, UUIDs): one byte per character, no surrogates
                .when(F.octet_length(key) == F.length(key), F.aggregate(positions, zero, ascii_step))
                .otherwise(F.aggregate(positions, zero, step)))
    return (((unsigned + _TWO_31) % _TWO_32) - _TWO_31).cast("int")


def shard_index(col, n: int) -> Column:
    """``Math.abs(key.hashCode()) % n`` with Java int semantics.  A null or
    empty key names no shard: the job that meets one fails."""
    if n <= 0:
        raise ValueError("shard count must be positive")
    key = _c(col).cast("string")
    h = java_string_hash(key).cast("bigint")
    return (F.when(F.coalesce(F.length(key), F.lit(0)) == 0,
                   F.raise_error(F.lit("a shard key is null or empty")).cast("bigint"))
            .when(h == -_TWO_31, F.lit(-(_TWO_31 % n)))
            .otherwise(F.abs(h) % n)).cast("int")


def java_string_hash_py(key: str) -> int:
    """Plain-Python twin, used by the driver-side router for literal keys."""
    h = 0
    data = key.encode("utf-16-be")
    for i in range(0, len(data), 2):
        h = (h * 31 + ((data[i] << 8) | data[i + 1])) % _TWO_32
    return h - _TWO_32 if h >= _TWO_31 else h


def shard_index_py(key: str, n: int) -> int:
    if not key:
        raise ValueError("a shard key is null or empty")
    h = java_string_hash_py(key)
    if h == -_TWO_31:
        return -(_TWO_31 % n)
    return abs(h) % n
