"""Embedding near-dedup by cross-polytope hashing (Andoni et al., 2015).

A hash turns the unit vector by three rounds of random signs and a fast Hadamard transform and takes the
coordinate of largest size with its sign.  A table's bucket joins `hashes` of these.  Multiprobe: a vector
also visits the buckets that take the second-largest coordinate of one of the hashes; two vectors meet in a table if
the home bucket of one is the home or a visited bucket of the other.  Pairs that meet are verified by cosine in double
precision.

Equal vectors of a label are one node with a weight, hashed once.  Rows are sorted by bucket; tasks multiply the vectors of
many small buckets at a time, or of one large one, and give back sums and one row per node, never pairs.  A pair that meets in several buckets
counts in the first only, which both vectors' codes tell.  A bucket of more than BLOCK rows is dealt to
blocks that are compared two by two in different tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import written
from scorekeep.llm.components import components
from scorekeep.llm.words import U, mix

TABLES = 5
#: Hashes of a bucket, whatever the size of the table, so that it doesn't decide which pairs are found.
HASHES = 2
BLOCK = 512
#: Small buckets share one product of up to this many rows.
PASS = 256


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2)
        h *= 2
    return x.reshape(n, d)


def codes(unit: np.ndarray, hashes: int, tables: int = TABLES) -> tuple[np.ndarray, np.ndarray]:
    """Per vector and table, the home bucket and the visited ones (1 + hashes numbers), by rows of unit vectors."""
    n, d = unit.shape
    wide = 1 << max(1, (d - 1).bit_length())
    padded = np.zeros((n, wide))
    padded[:, :d] = unit
    draw = np.random.Generator(np.random.PCG64(20150901))
    first, second = (np.zeros((n, tables, hashes), np.int64) for _ in "ab")
    for t in range(tables):
        for k in range(hashes):
            x = padded
            for _ in range(3):
                x = hadamard(x * draw.choice((-1.0, 1.0), wide))
            size = np.abs(x)
            rows = np.arange(n)
            for out in (first, second):
                top = size.argmax(axis=1)
                out[:, t, k] = 2 * top + (x[rows, top] > 0)
                size[rows, top] = -1
    place = np.array([(2 * wide) ** k for k in range(hashes)], np.int64)
    home = (first * place).sum(axis=2)
    probes = np.stack([home] + [home + (second[:, :, k] - first[:, :, k]) * place[k] for k in range(hashes)], axis=2)
    return home, probes


def _unit(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("embedding").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(batch.num_rows, -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hashing(hashes: int):
    """Rows of nodes with their codes: the visited buckets of every table as bytes of int64, the home first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                _, probes = codes(_unit(part), hashes)
                made = pa.array([p.tobytes() for p in probes], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, made], names=[*part.schema.names, "codes"])

    return run


def _probes(batch: pa.RecordBatch, hashes: int) -> np.ndarray:
    """Per row and table, the visited buckets of its codes."""
    flat = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.int64)
    return flat.reshape(batch.num_rows, TABLES, 1 + hashes)


def _salt(batch: pa.RecordBatch) -> np.ndarray:
    """What sets the buckets of a label and a dimension apart, by rows."""
    label, dim = (batch.column(c).to_numpy().astype(np.int64).astype(U) for c in ("label", "dim"))
    return mix(label) + mix(dim + U(5))


def _buckets(hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                probes = _probes(part, hashes)
                n, tables, width = probes.shape
                keys = mix(probes.astype(U) * U(tables) + np.arange(tables, dtype=U)[None, :, None] + _salt(part)[:, None, None])
                row = np.repeat(np.arange(n), tables * width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.tile(np.arange(width) == 0, n * tables)),
                     part.column("node").take(pa.array(row))], names=["bucket", "home", "node"])

    return run


def _meetings(hashes: int, least: float):
    def first_met(home: np.ndarray, probes: np.ndarray, salt: np.ndarray, node: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The bucket where each pair of positions meets first, from the codes of both."""
        met = np.concatenate(((probes[j] == home[i][:, :, None]).any(axis=2), (probes[i] == home[j][:, :, None]).any(axis=2)), axis=1)
        tables = home.shape[1]
        met = met[:, :tables] | met[:, tables:]
        t = met.argmax(axis=1)  # the first table where the pair meets
        one, two = home[i, t], home[j, t]
        # there, the bucket of the smaller node's home if the other is in it, else the other's home
        low_first = node[i] < node[j]
        low, high = np.where(low_first, one, two), np.where(low_first, two, one)
        of_high = np.where(low_first[:, None], probes[j, t], probes[i, t])
        chosen = np.where((of_high == low[:, None]).any(axis=1), low, high)
        return mix(chosen.astype(U) * U(tables) + t.astype(U) + salt[i]).view(np.int64)

    def of_groups(rows: pa.RecordBatch, edge: np.ndarray) -> pa.RecordBatch | None:
        """Sum of linked weights and smallest linked node of each node in whole buckets (or pairs of blocks), which begin at
        edge; all of them in one product."""
        n = rows.num_rows
        group = np.repeat(np.arange(len(edge) - 1), np.diff(edge))
        side, bucket, node, dim = (rows.column(c).to_numpy() for c in ("side", "bucket", "node", "dim"))
        at_home = rows.column("home").to_numpy(zero_copy_only=False)
        x = _unit(rows)
        a, b = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        i, j = np.nonzero((x[a] @ x[b].T >= least) & (group[a][:, None] == group[b][None, :]))
        i, j = a[i], b[j]
        # rows of side 0 meet rows of side 0 only, and one side the other
        keep = (node[i] != node[j]) & (at_home[i] | at_home[j]) & (dim[i] == dim[j]) & ((side[i] == 0) == (side[j] == 0))
        i, j = i[keep], j[keep]
        if not len(i):
            return None
        probes = _probes(rows, hashes)
        here = first_met(probes[:, :, 0], probes, _salt(rows), node, i, j) == bucket[i]
        i, j = i[here], j[here]
        two = side[i] != 0  # two blocks: the links count for both sides
        i, j = np.concatenate((i, j[two])), np.concatenate((j, i[two]))
        linked = np.bincount(i, rows.column("weight").to_numpy()[j], n).astype(np.int64)
        least_node, before = node.copy(), None
        while before is None or (least_node != before).any():  # the smallest node reachable within the rows at hand
            before = least_node.copy()
            np.minimum.at(least_node, i, before[j])
        at = np.flatnonzero(linked)
        return pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(linked[at]), pa.array(least_node[at])],
                                          names=["node", "linked", "near"])

    def passes(rows: pa.RecordBatch, edge: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Whole groups together up to PASS rows, a larger one by itself."""
        low = 0
        while low < len(edge) - 1:
            high = max(low + 1, int(np.searchsorted(edge, edge[low] + PASS, "right")) - 1)
            if edge[high] - edge[low] > 1:
                out = of_groups(rows.slice(edge[low], edge[high] - edge[low]), edge[low:high + 1])
                if out is not None and out.num_rows:
                    yield out
            low = high

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def groups(batch: pa.RecordBatch) -> np.ndarray:
            keys = np.stack([batch.column(c).to_numpy() for c in ("bucket", "x", "y")])
            return np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0), [True])))

        for batch in batches:
            if not batch.num_rows:
                continue
            merged = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            edge = groups(merged)
            yield from passes(merged, edge[:-1])
            held = [merged.slice(edge[-2])]
        if held:
            yield from passes(held[0], np.array([0, held[0].num_rows]))

    return run


def near_embeddings(embeddings: DataFrame, least: float = 0.98, id_col: str = "vec_id",
                    embedding_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Rows of equal, non-null labels and equal dimension link if their cosine is at least `least` and the hashing finds them;
    equal vectors always link.  n_links counts the other rows linked directly, component_id is the
    smallest id reachable, kept is vec_id = component_id.  A vector that is null, empty or zero, or holds a
    null or non-finite component, links with nothing, and so does a null label.  A row with a null id links
    with nothing and has a null component and kept false.  Identical repeated rows are one row of the result.
    """
    rows = embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
                             F.col(embedding_col).cast("array<double>").alias("embedding")).distinct()
    sound = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
             & F.exists("embedding", lambda v: v != 0))
    rows = written(rows.withColumn("sound", F.coalesce(sound, F.lit(False))), "vectors")
    good = rows.where("sound")
    nodes = written(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight"))
                    .withColumn("dim", F.size("embedding")), "nodes")
    # vectors of one dimension at a time, since a task's matrix has one width
    dims = [r[0] for r in nodes.select("dim").distinct().orderBy("dim").collect()]
    found = [_links(nodes.where(F.col("dim") == d), HASHES, least) for d in dims]
    if not found:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.col("vec_id").isNotNull().alias("kept"))
    links = found[0]
    for more in found[1:]:
        links = links.unionAll(more)
    links = written(links, "links")
    counts = links.groupBy("node").agg(F.sum("linked").alias("linked"))
    reach = written(components(links, "node", "near"), "reach")
    per_node = written(nodes.select("label", "embedding", "node", "weight").join(counts, "node", "left").join(reach, "node", "left")
                       .select("label", "embedding", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                               F.coalesce("component", "node").alias("component_id")), "nodes")
    single = rows.where("not sound").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return (good.join(per_node, ["label", "embedding"]).select("vec_id", "n_links", "component_id").unionAll(single)
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))


def _links(nodes: DataFrame, hashes: int, least: float) -> DataFrame:
    """Rows node, linked (weight of nodes linked in a bucket) and near (the smallest node reached there)."""
    # every vector is hashed once; its codes go with it
    nodes = written(nodes.select("node", "label", "dim", "weight", "embedding").mapInArrow(
        _hashing(hashes), "node long, label long, dim int, weight long, embedding array<double>, codes binary"), "codes")
    spread = nodes.select("node", "label", "dim", "codes").mapInArrow(_buckets(hashes), "bucket long, home boolean, node long")
    spread = written(spread, "buckets")
    size = spread.groupBy("bucket").agg(F.count("*").alias("n"), F.max("home").alias("homes")).where("n > 1 and homes")
    size = written(size.select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks")), "sizes")
    placed = spread.join(size, "bucket").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    # block i is compared with every block j: the row goes to (min(i, j), max(i, j))
    placed = placed.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")).select(
        "bucket", "home", "node", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
        F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"))
    full = placed.join(nodes, "node")
    return (full.repartition("bucket", "x", "y").sortWithinPartitions("bucket", "x", "y")
            .select("bucket", "x", "y", "side", "home", "node", "label", "dim", "weight", "embedding", "codes")
            .mapInArrow(_meetings(hashes, least), "node long, linked long, near long"))


def op5_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Near copies among all embeddings of a label, at cosine 0.98."""
    return near_embeddings(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
