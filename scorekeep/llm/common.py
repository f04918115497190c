"""Helpers shared by the operators: shared-folder tables, size-checked broadcast, batch walking."""

from __future__ import annotations

from array import array
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.session import scratch_path

#: Ids are broadcast up to this many rows of at most 16 bytes (16 MB); beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000
#: Bytes of text in a slice for work that needs 60 bytes or more of arrays for each of them.
SMALL = 500_000


def written(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet into the folder of spark.checkpoint.dir, which executors share, and read it back: later steps start from whole files,
    so a lost executor costs only the step at hand."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(ids: DataFrame, rows: int) -> DataFrame:
    """Mark ids (fixed-width columns only) for broadcast if its counted rows are within the bound."""
    return F.broadcast(ids) if rows <= BROADCAST_ROWS else ids


def slices(table: pa.RecordBatch, column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Runs of consecutive rows whose texts have about `most` bytes together (one row at least)."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(table.column(column)), 0).to_numpy(zero_copy_only=False)
    begin = total = 0
    for i, n in enumerate(sizes):
        if i > begin and total + n > most:
            yield table.slice(begin, i - begin)
            begin, total = i, 0
        total += n
    if len(sizes) > begin:
        yield table.slice(begin)


def release_memory() -> None:
    """Give memory that a task has left over back to the system: a Python worker lives on for other stages."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def released(run: Callable, after: Callable | None = None) -> Callable:
    """A function for mapInArrow that calls after() and gives memory back when its partition ends."""

    def whole(batches):
        try:
            yield from run(batches)
        finally:
            if after is not None:
                after()
            release_memory()

    return whole


def over_slices(f: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], column: str = "text", after: Callable | None = None,
                most: int = 2_000_000):
    """A function for mapInArrow that applies f to slices of each batch, of about `most` bytes of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, column, most):
                yield from f(part)

    return released(run, after)


def numbered(texts: Iterable[list]) -> tuple[np.ndarray, np.ndarray, list]:
    """The words of all texts one after the other, as numbers of distinct words; where each text's begin, with the end; the
    distinct words."""
    place: defaultdict = defaultdict()
    place.default_factory = place.__len__
    found, held = array("q"), [0]
    for words in texts:
        found.extend(map(place.__getitem__, words))
        held.append(len(found))
    return np.array(found), np.array(held), list(place)


def gathered(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The stretches of flat that begin at begin and have count items, one after the other."""
    before = np.cumsum(count) - count
    return flat[np.repeat(begin - before, count) + np.arange(count.sum())]


class Remembered(dict):
    """Byte strings that make() gave for keys, in about `most` bytes: when half of that is used, what was not asked for
    since the last time is forgotten."""

    def __init__(self, make: Callable, most: int):
        self.make, self.room, self.used, self.older = make, most // 2, 0, {}

    def __missing__(self, key):
        out = self.older.pop(key, None)
        return self.put(key, self.make(key) if out is None else out)

    def put(self, key, out):
        if self.used >= self.room:
            self.older = dict(self)
            self.clear()
            self.used = 0
        self.used += len(key) + len(out) + 190  # two objects and the entry
        self[key] = out
        return out

    def forget(self) -> None:
        self.clear()
        self.used, self.older = 0, {}
