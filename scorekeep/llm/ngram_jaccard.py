"""N-gram Jaccard join by PartEnum signatures (Arasu, Ganti and Kaushik, 2006).

A document's set holds its distinct n-word shingles as 64-bit hashes.  Sizes fall into bands; sets of a band
that are similar enough differ in at most k elements, k fixed by the band.  The domain is cut into n1
partitions of three cells each.  With n1 = k // 2 + 1 + spare partitions, more than `spare` of them differ in
one element at most, and there two of the three cells agree: each set signs every pair of cells of each
partition, so similar sets share a signature.  A set near its band's upper end signs for the next band too.
Partitions with nearly empty pairs of cells would meet by chance; a set with no more than `spare` of these
leaves them out, which loses nothing, as one good partition with full cells is left.

Sets that share a signature are compared in two steps, neither of which lists the pairs of a group: every set
with the smallest set of each of its signatures, whose links give components; then, inside each signature, sets
that are still in different components.  A parity sketch (a bit per hash class: whether the set has an odd number
of elements there) goes with each set: sketches differ in no more bits than sets in elements, so most pairs
are ruled out by it, exactly, and only the others fetch their sets.  Further links inside a component can't change it.
Equal sets are one node from the start, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import SMALL, over_slices, released, small_or_shuffled, written
from scorekeep.llm.components import block_stars, components
from scorekeep.llm.words import U, mix, scan, shingles

#: Ratio of neighbouring bands' upper ends, and the size up to which sets must be equal.
BAND_RATIO = 1.5
#: Rows of a signature that is met by partial minima, and hash classes of nodes, one of which tells them.
HOT = 50_000
CLASSES = 64
#: Up to this many of these signatures (800 kB) are sent to the tasks that sign, by way of the driver; beyond it they are joined.
HOT_SENT = 100_000
#: Sets of a signature that are compared in one block.
BLOCK = 1024
#: Sets on either side of a block of verified pairs.
VERIFIED = 256
#: Signatures that a task packs at a time, buckets of them to a shuffle partition, bytes of each beside its bucket.
PACK, BUCKETS, SHORT = 500_000, 8, 5
#: Pairs of cells with fewer elements count as nearly empty.
THIN = 2


class Bands:
    """Size bands and PartEnum's parameters for links at `percent` per cent Jaccard similarity or more."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("percent must be 50 to 100")
        self.percent = percent
        self.tops = [1]

    def band(self, size: int) -> int:
        while self.tops[-1] < size:
            self.tops.append(max(self.tops[-1] + 1, int(self.tops[-1] * BAND_RATIO)))
        return int(np.searchsorted(self.tops, size))

    def of(self, size: int) -> list[int]:
        """The bands that a set of this size signs for."""
        b = self.band(size)
        return [b, b + 1] if 100 * size >= self.percent * (self.tops[b] + 1) else [b]

    def differ(self, b: int) -> int:
        """Elements that similar sets of band b, or of bands b - 1 and b, can differ in.

        Of a union u, similar sets share i >= percent / 100 * u, so that they differ in u - i <= (100 - percent)
        / (100 + percent) * (u + i) elements; u + i, the sum of their sizes, is at most twice the band's top.
        """
        self.band(b + 2) if b >= len(self.tops) else None
        while len(self.tops) <= b:
            self.band(self.tops[-1] + 1)
        return 2 * (100 - self.percent) * self.tops[b] // (100 + self.percent)

    def signatures(self, items: np.ndarray) -> np.ndarray:
        out = []
        for b in self.of(len(items)):
            k = self.differ(b)
            seed = mix(np.array([b + 1], U) * U(0x8CB92BA72F3D8DD7))
            h = mix(items ^ seed)
            if not k:
                out.append(mix(h.sum(keepdims=True) + U(len(h)) + seed))
                continue
            spare = 1 + k // 50
            n1 = k // 2 + 1 + spare
            cell = ((h >> U(33)) % U(n1) * U(3) + (h & U(0xFFFF)) % U(3)).astype(np.int64)
            h = mix(h + U(0x632BE59BD9B4E019))
            count = np.bincount(cell, minlength=3 * n1).reshape(n1, 3)
            low, high = (np.bincount(cell, part.astype(np.float64), 3 * n1).astype(U).reshape(n1, 3)
                         for part in (h & U(0xFFFFFFFF), h >> U(32)))
            total = mix(low + (high << U(32)) + count.astype(U))  # of each cell; exact: sums stay under 2**53
            pairs = np.stack([mix(total[:, i] * U(3) + total[:, j] * U(5) + U(o)) for i, j, o in
                              ((1, 2, 0), (0, 2, 1), (0, 1, 2))], axis=1)
            thin = (count.sum(axis=1, keepdims=True) - count < THIN).any(axis=1)
            pairs = mix(pairs + (np.arange(n1, dtype=U)[:, None] * U(0xD1342543DE82EF95) + seed))
            out.append((pairs[~thin] if thin.sum() <= spare else pairs).ravel())
        return np.concatenate(out).view(np.int64)


def _sets(part: pa.RecordBatch, n: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """Row, set and node of each text of the slice; the node is a hash of the set, 0 for the empty set."""
    found, first = shingles(scan(part.column("text")), n)
    for i in range(part.num_rows):
        items = np.unique(found[first[i]:first[i + 1]])
        node = 0
        if len(items):
            node = int(mix(mix(items + U(0x2545F4914F6CDD1D)).sum(keepdims=True) + U(len(items))).view(np.int64)[0]) or 1
        yield i, items, node


def _nested(rows: list[np.ndarray]) -> pa.Array:
    edge = np.concatenate(([0], np.cumsum([len(r) for r in rows]))).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(flat.view(np.int64)))


def parity(items: np.ndarray) -> bytes:
    """A bit for each of as many hash classes as the set has elements (rounded up to a power of two, 64 at least)."""
    m = max(64, 1 << (len(items) - 1).bit_length())
    return np.packbits(np.bincount((mix(items) & U(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1, bitorder="little").tobytes()


def _classifier(n: int, percent: int):
    """Size, node and sketch of every text, and the signatures of one node in CLASSES, which tell hot ones."""
    def classify(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bands, sizes, nodes, sketches, signed = Bands(percent), [], [], [], []
        for _, items, node in _sets(part, n):
            sizes.append(len(items))
            nodes.append(node)
            sketches.append(parity(items) if node else None)
            signed.append(bands.signatures(items) if node and node % CLASSES == 0 else np.zeros(0, np.int64))
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sketches, pa.binary()), _nested(signed)],
            names=["doc_id", "n_shingles", "node", "sketch", "signatures"])

    return over_slices(classify, most=SMALL)


def _signer(n: int, percent: int):
    def sign(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        found = [(bands.signatures(items), node) for _, items, node in _sets(part, n) if node]
        if found:
            signatures = np.concatenate([x for x, _ in found])
            nodes = np.repeat(np.array([x for _, x in found]), [len(x) for x, _ in found])
            yield pa.RecordBatch.from_arrays([pa.array(signatures), pa.array(nodes)], names=["signature", "node"])

    return over_slices(sign, most=SMALL)


def _packer(buckets: int):
    """Rows of signature and node as a row per bucket: SHORT bytes of each signature, and the nodes.

    A bucket's signatures are told apart by SHORT bytes; where two meet by chance, their sets are compared in vain.
    """
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACK:
                yield packed(held)
                held, rows = [], 0
        if rows:
            yield packed(held)

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        signature, node = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("signature", "node"))
        spread = mix(signature.view(U))
        bucket = ((spread >> U(40)) % U(buckets)).astype(np.int32)
        order = np.lexsort((node, bucket))
        bucket, node = bucket[order], node[order]
        short = spread[order].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SHORT]
        cut = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket))
        runs = list(zip(cut[:-1], cut[1:], strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(bucket[cut[:-1]]), pa.array([short[i:j].tobytes() for i, j in runs], pa.binary()),
             pa.array([node[i:j].tobytes() for i, j in runs], pa.binary())], names=["bucket", "short", "nodes"])

    return pack


def _packing_signer(n: int, percent: int, buckets: int, away: np.ndarray):
    """The texts' signatures but those in `away`, packed by the worker that makes them."""
    sign, pack = _signer(n, percent), _packer(buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signed = sign(batches)
        if len(away):
            signed = (b.filter(pa.array(~np.isin(b.column("signature").to_numpy(), away))) for b in signed)
        return pack(signed)

    return released(run)


def _fetcher(n: int):
    def fetch(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        got = [(items, node) for _, items, node in _sets(part, n)]
        yield pa.RecordBatch.from_arrays([part.column("want"), pa.array([x[1] for x in got], pa.int64()),
                                          _nested([x[0] for x in got])], names=["want", "node", "items"])

    return over_slices(fetch, most=SMALL)


def _centers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of packed rows sorted by bucket: signatures that several nodes have, each node, the smallest one and their count."""
    def shared(bucket: int, held: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
        short = np.zeros((sum(len(x) for x, _ in held) // SHORT, 8), np.uint8)
        short[:, :SHORT] = np.frombuffer(b"".join(x for x, _ in held), np.uint8).reshape(-1, SHORT)
        signature, node = short.view("<u8").ravel(), np.frombuffer(b"".join(x for _, x in held), np.int64)
        order = np.lexsort((node, signature))
        signature, node = signature[order], node[order]
        new = np.append(True, (signature[1:] != signature[:-1]) | (node[1:] != node[:-1]))
        signature, node = signature[new], node[new]
        start = np.flatnonzero(np.append(True, signature[1:] != signature[:-1]))
        size = np.diff(np.append(start, len(node)))
        many = np.repeat(size > 1, size)
        full = signature | (U(bucket) << U(8 * SHORT))
        return pa.RecordBatch.from_arrays(
            [pa.array(x[many]) for x in (full.view(np.int64), node, np.repeat(node[start], size), np.repeat(size, size))],
            names=["signature", "node", "center", "n"])

    now, held = None, []
    for batch in batches:
        for bucket, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "short", "nodes")), strict=True):
            if held and bucket != now:
                yield shared(now, held)
                held = []
            now = bucket
            held.append(row)
    if held:
        yield shared(now, held)


def _members(docs: DataFrame, classes: DataFrame, n: int, percent: int) -> DataFrame:
    """signature, node, center (the signature's smallest node) and n (its nodes) of signatures that several nodes share.

    Signatures meet by one shuffle, packed.  Those of more than about HOT rows, told by the nodes of a hash
    class, would make a hot task; their centers come from partial minima that are joined to their rows.
    """
    spark = docs.sparkSession
    buckets = min(BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << 8 * (7 - SHORT))
    texts = docs.where("doc_id is not null").select("text")
    signed = texts.mapInArrow(released(_signer(n, percent)), "signature long, node long")
    often = classes.where("doc_id is not null").select(F.explode("signatures").alias("signature")).groupBy("signature").count()
    hot = written(often.where(F.col("count") > HOT // CLASSES).select("signature"), "hot")
    several = hot.count()
    few, schema = small_or_shuffled(hot, several), "bucket int, short binary, nodes binary"
    if several <= HOT_SENT:
        away = np.array([row["signature"] for row in hot.collect()], np.int64)
        cold = texts.mapInArrow(_packing_signer(n, percent, buckets, away), schema)
    else:
        cold = (signed.join(few, "signature", "left_anti").select("signature", "node")
                .mapInArrow(released(_packer(buckets)), schema))
    cold = (cold.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(released(_centers), "signature long, node long, center long, n long"))
    if not several:
        return cold
    crowd = written(signed.join(few, "signature", "left_semi").select("signature", "node").distinct(), "crowd")
    center = crowd.groupBy("signature").agg(F.min("node").alias("center"), F.count("*").alias("n")).where("n > 1")
    crowded = crowd.join(written(center, "centers"), "signature").select(
        (-1 - F.shiftrightunsigned("signature", 1)).alias("signature"), "node", "center", "n")
    return cold.unionAll(crowded)


def _folded(sketches: pa.Array, rows: np.ndarray, width: int) -> np.ndarray:
    """Sketches of equal length as rows of `width` words, halves laid over each other as often as needed."""
    words = np.frombuffer(b"".join(sketches.take(pa.array(rows)).to_pylist()), U).reshape(len(rows), -1)
    while words.shape[1] > width:
        words = words[:, :words.shape[1] // 2] ^ words[:, words.shape[1] // 2:]
    return words


def _widths(sketches: pa.Array) -> np.ndarray:
    return pc.binary_length(sketches).to_numpy(zero_copy_only=False) // 8


def _may_link(percent: int):
    """The pairs (a, b) whose sketches don't rule a link out."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right, total = (batch.column(c) for c in ("a_sketch", "b_sketch", "total"))
            widths, keep = np.stack((_widths(left), _widths(right)), axis=1), np.zeros(batch.num_rows, bool)
            for x, y in np.unique(widths, axis=0):
                rows = np.flatnonzero((widths == (x, y)).all(axis=1))
                far = np.bitwise_count(_folded(left, rows, min(x, y)) ^ _folded(right, rows, min(x, y))).sum(axis=1, dtype=np.int64)
                keep[rows] = far * (100 + percent) <= (100 - percent) * total.to_numpy()[rows]
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return check


def _blocks(percent: int):
    """Of rows sorted by signature, x and y: stars that hold together the pairs of different components that may link."""
    def compare(rows: dict[str, np.ndarray], words: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> list[np.ndarray]:
        node, component, size, width, first = (rows[c] for c in ("node", "component", "size", "width", "first"))
        out, of = [], {w: right[width[right] == w] for w in set(width[right].tolist())}
        for w in set(width[left].tolist()):
            i = left[width[left] == w]
            for v in (w // 2, w, 2 * w):
                if v not in of or (same and v < w):  # inside one part, a wider set has met a narrower one already
                    continue
                j = of[v]
                a, b = (words[first[r][:, None] + np.arange(x)] for r, x in ((i, w), (j, v)))
                if v != w:
                    a, b = (x if x.shape[1] == min(w, v) else x[:, :min(w, v)] ^ x[:, min(w, v):] for x in (a, b))
                step = max(1, (1 << 20) // b.size)
                for k in range(0, len(i), step):
                    p, q = i[k:k + step, None], j[None]
                    near = component[p] != component[q]
                    near &= 100 * np.minimum(size[p], size[q]) >= percent * np.maximum(size[p], size[q])
                    if same and v == w:
                        near &= p < q
                    p, q = np.nonzero(near)
                    if not len(p):
                        continue
                    far = np.bitwise_count(a[k + p] ^ b[q]).sum(axis=1, dtype=np.int64)
                    p, q = i[k + p], j[q]
                    near = far * (100 + percent) <= (100 - percent) * (size[p] + size[q])
                    out.append(np.stack((node[p[near]], node[q[near]])))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
            cut = starts(table)
            yield from pairs(table.slice(0, cut[-1]), cut)
            held = table.slice(cut[-1])
        if held is not None:
            yield from pairs(held, np.array([0, held.num_rows]))

    def starts(table: pa.Table) -> np.ndarray:
        keys = np.stack([table.column(c).to_numpy() for c in ("signature", "x", "y")])
        return np.append(0, np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1)

    def pairs(table: pa.Table, cut: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not table.num_rows:
            return
        rows = {c: table.column(c).to_numpy() for c in ("node", "component", "size", "own", "x", "y")}
        sketch = table.column("sketch").combine_chunks()
        rows["width"] = _widths(sketch)
        rows["first"] = np.cumsum(rows["width"]) - rows["width"]
        words, out = np.frombuffer(b"".join(sketch.to_pylist()), U), []
        for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            here = np.arange(i, j)
            if rows["x"][i] == rows["y"][i]:
                out += compare(rows, words, here, here, True)
            else:
                own = rows["own"][i:j]
                out += compare(rows, words, here[own == rows["x"][i]], here[own == rows["y"][i]], False)
        if out:
            a, b = np.concatenate(out, axis=1)
            yield block_stars([pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])])

    return run


def _fetched(pairs: DataFrame, about: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """node and items of the nodes of pairs (a, b); each set is made anew from one text."""
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    wanted = written(about.join(ends, "node").select("doc_id", F.col("node").alias("want")), "wanted")
    return written(docs.join(small_or_shuffled(wanted, wanted.count()), "doc_id")
                   .mapInArrow(released(_fetcher(n)), "want long, node long, items array<long>")
                   .where("want = node").dropDuplicates(["node"]).select("node", "items"), "sets")


def _linked(pairs: DataFrame, about: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough, by their sets."""
    pairs = written(pairs, "pairs")
    sets = _fetched(pairs, about, docs, n)
    left, right = (sets.select(F.col("node").alias(x), F.col("items").alias(f"{x}_items")) for x in "ab")
    shared = F.size(F.array_intersect("a_items", "b_items")).cast("long")
    union = F.size("a_items") + F.size("b_items") - F.col("shared")
    return written(pairs.join(left, "a").join(right, "b").withColumn("shared", shared)
                   .where(F.col("shared") * 100 >= union * percent).select("a", "b"), "links")


def _placed(found: DataFrame, node: str, component: str) -> DataFrame:
    return found.select(F.col("node").alias(node), F.col("component").alias(component))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different components."""
    placed = pairs.join(_placed(found, "a", "x"), "a", "left").join(_placed(found, "b", "y"), "b", "left")
    return placed.where("coalesce(x, a) <> coalesce(y, b)").select("a", "b")


def _late_pairs(members: DataFrame, found: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """Stars that hold together the pairs that share a signature, are in different components and that sketches don't rule out.

    Each signature's center has been compared with all its sets.  Signatures of more than BLOCK sets are
    cut into parts, and every two parts meet in a task of their own.
    """
    placed = members.where("n > 2 and node <> center").join(_placed(found, "node", "component"), "node", "left").select(
        "signature", "node", "n", F.coalesce("component", "node").alias("component"))
    open_ = (placed.groupBy("signature").agg(F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("signature"))
    parts = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("node"), parts)
    rows = (placed.join(open_, "signature", "left_semi").join(about.select("node", "size", "sketch"), "node")
            .select("signature", "node", "component", "size", "sketch", own.alias("own"),
                    F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
            .withColumn("x", F.least("own", "other")).withColumn("y", F.greatest("own", "other")).drop("other"))
    return (rows.repartition("signature", "x", "y").sortWithinPartitions("signature", "x", "y")
            .mapInArrow(released(_blocks(percent)), "a long, b long").distinct())


def _block_links(percent: int):
    def link(table: pa.Table) -> pa.Table:
        """Links of a block of probes with a block of targets, one per probe and component."""
        table = table.combine_chunks()
        node, component, probe = (table.column(c).to_numpy() for c in ("node", "component", "probe"))
        items = table.column("items").combine_chunks()
        size = np.diff(items.offsets.to_numpy())
        _, at = np.unique(items.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(node)), size)
        left, right = np.flatnonzero(probe), np.flatnonzero(~probe)
        if not len(left) or not len(right):
            return pa.table({"a": node[:0], "b": node[:0]})
        rank = np.empty(len(node), np.int64)
        rank[left], rank[right] = np.arange(len(left)), np.arange(len(right))
        shared = np.zeros((len(left), len(right)), np.float32)
        for low in range(0, int(at.max()) + 1, 4096):  # 0/1 matrices of 4096 shingles at a time
            here = (at >= low) & (at < low + 4096)
            own, col = owner[here], at[here] - low
            p, t = (np.zeros((len(x), 4096), np.float32) for x in (left, right))
            of_probe = probe[own]
            p[rank[own[of_probe]], col[of_probe]] = 1
            t[rank[own[~of_probe]], col[~of_probe]] = 1
            shared += p @ t.T
        shared = shared.astype(np.int64)  # exact: counts stay under 2**24
        near = (100 * shared >= percent * (size[left][:, None] + size[right][None, :] - shared)) & (
            component[left][:, None] != component[right][None, :])
        i, j = np.nonzero(near)
        one = np.unique(np.stack((i, component[right][j])), axis=1, return_index=True)[1] if len(i) else i
        return pa.table({"a": node[left[i[one]]], "b": node[right[j[one]]]})

    return link


def _late_links(pairs: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between sets that could share a signature but are still in different components.

    Pairs that sketches don't rule out make clusters.  Sets outside a cluster's largest component are verified
    against all of the cluster, in blocks of VERIFIED by VERIFIED that go to different tasks; no pair of sets
    becomes a row unless it is a link.
    """
    clusters = components(pairs, "a", "b").select("node", F.col("component").alias("cluster"))
    placed = written(clusters.join(found, "node", "left").select(
        "cluster", "node", F.coalesce("component", "node").alias("component")), "placed")
    sized = written(placed.groupBy("cluster", "component").count().groupBy("cluster").agg(
        F.sum("count").alias("n"), F.max("count").alias("most"), F.max_by("component", F.struct("count", "component"))
        .alias("main")).where("n > most")
        .select("cluster", "main", F.ceil(F.col("n") / VERIFIED).alias("blocks"),
                F.ceil((F.col("n") - F.col("most")) / VERIFIED).alias("probe_blocks")), "sized")
    rows = placed.join(sized, "cluster").join(sets, "node")
    own = lambda blocks: F.pmod(F.xxhash64("node"), blocks)
    every = lambda blocks: F.explode(F.sequence(F.lit(0).cast("long"), F.col(blocks) - 1))
    columns = ["cluster", "x", "y", "node", "component", "items", "probe"]
    targets = rows.select("*", own("blocks").alias("y"), F.lit(False).alias("probe"), every("probe_blocks").alias("x"))
    probes = rows.where("component <> main").select(
        "*", own("probe_blocks").alias("x"), F.lit(True).alias("probe"), every("blocks").alias("y"))
    return (targets.select(columns).unionAll(probes.select(columns)).groupBy("cluster", "x", "y")
            .applyInArrow(_block_links(percent), "a long, b long"))


def ngram_jaccard_join(documents: DataFrame, n: int = 5, percent: int = 80,
                       id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Components of documents whose sets of n-word shingles have Jaccard similarity >= percent / 100.

    Returns per row of documents: the id, n_shingles (size of the set) and component_id (smallest id
    reachable by links, itself included).  Words are runs without ASCII white space, A-Z lower-cased; a text
    of fewer than n words has its whole sequence as its one shingle.  A null, empty or blank text has an
    empty set and links with nothing.  A row with a null id links with nothing and has a null component.
    Repeated rows are each returned and share a component.  Columns other than id and text are not read.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    classes = written(docs.mapInArrow(released(_classifier(n, percent)), "doc_id long, n_shingles long, node long, sketch binary, "
                                      "signatures array<long>"), "classes")
    members = written(_members(docs, classes, n, percent), "members")
    several = members.select("node").distinct()
    about = written(classes.where("doc_id is not null and node <> 0").join(several, "node").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("size"), F.first("sketch").alias("sketch")), "about")

    pairs = members.where("node <> center").select(F.col("node").alias("a"), F.col("center").alias("b")).distinct()
    left, right = (about.select(F.col("node").alias(x), F.col("size").alias(f"{x}_size"), F.col("sketch").alias(f"{x}_sketch"))
                   for x in "ab")
    pairs = (pairs.join(left, "a").join(right, "b").where(F.least("a_size", "b_size") * 100 >= F.greatest("a_size", "b_size") * percent)
             .select("a", "b", "a_sketch", "b_sketch", (F.col("a_size") + F.col("b_size")).alias("total")))
    pairs = written(pairs.mapInArrow(released(_may_link(percent)), "a long, b long"), "pairs")
    # each set with one center first; of the other pairs, only those that this leaves apart
    links = _linked(pairs.groupBy("a").agg(F.min("b").alias("b")), about, docs, n, percent)
    found = written(components(links, "a", "b"), "found")
    links = links.unionAll(_linked(_apart(pairs, found), about, docs, n, percent))
    found = written(components(links, "a", "b"), "found")

    late = written(_late_pairs(members, found, about, percent), "late")
    if not late.isEmpty():
        links = links.unionAll(written(_late_links(late, found, _fetched(late, about, docs, n), percent), "links"))
        found = written(components(links, "a", "b"), "found")

    # the smallest id of each component; one row per node that has a link or a copy
    per_node = classes.where("doc_id is not null and node <> 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    grouped = per_node.join(found, "node", "left").select(
        "node", "least", F.coalesce("component", "node").alias("component"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    known = written(grouped.join(least, "component").select("node", "component_id"), "known")
    return (classes.select("doc_id", "n_shingles", "node").join(known, "node", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
                    .alias("component_id")))


def op7_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """3-word shingles, similarity 0.9 or more, over all documents."""
    return ngram_jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), n=3, percent=90)
