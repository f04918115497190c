"""Document fingerprints by randomised edit embedding (Chakraborty, Goldenberg and Koucky, 2016).

A walk reads a text from the left and writes y: at step j it writes the character it stands on, and a random
bit that depends on j and the character, the same for all texts, says whether it moves on.  Two texts that
differ by few edits fall into step again soon after each, so their y differ in few places.  The functions
repeat after PERIOD steps.  The fingerprint samples one bit at each of BITS random places of y.  A place is
drawn so that it is uniform over the length of y and moves only rarely as that length grows (the last record
of a random sequence), so texts of nearly equal length are sampled at the same places.  Likeness is
1 - 2 * (differing bits) / BITS, not below 0: the expected share of equal characters in y.

Walks of many texts advance together, one character a numpy step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import written
from scorekeep.llm.components import block_stars, components
from scorekeep.llm.words import U, mix

BITS = 512
PERIOD = 1 << 15
CLASSES = 64
#: Bits of a band, sampled from the fingerprint's.
BAND_BITS = 24
BANDS = 32
#: Nodes of a band's value that are compared in one block.
BLOCK = 2048


def _step_lengths() -> np.ndarray:
    """For each class of characters and step modulo PERIOD, the steps until the walk leaves the character."""
    moves = mix(np.arange(CLASSES * PERIOD, dtype=U) + U(0x5851F42D4C957F2D)) >> U(63) == 1
    moves = moves.reshape(CLASSES, PERIOD)
    moves[:, -1] = True  # bounds the table; one step in PERIOD
    at = np.where(moves, np.arange(PERIOD), PERIOD)
    return (np.minimum.accumulate(at[:, ::-1], axis=1)[:, ::-1] - np.arange(PERIOD) + 1).astype(np.int64).ravel()


def _records() -> np.ndarray:
    """For each sampled bit, rising places: the bit is taken at the last one below the length of y."""
    draw = np.random.Generator(np.random.PCG64(20240229))
    out = np.zeros((BITS, 160), np.int64)
    for k in range(1, out.shape[1]):
        out[:, k] = np.minimum(out[:, k - 1] / draw.random(BITS), 2.0**52).astype(np.int64) + 1
    return out


class Walker:
    def __init__(self):
        self.steps, self.records = _step_lengths(), _records()

    def walk(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray, began: np.ndarray) -> np.ndarray:
        """Step at which the walk leaves each character; text i is codes[first[i]:first[i] + size[i]], and its
        walk begins at step began[i]."""
        kinds = (mix(codes.astype(U) + U(77)) >> U(58)).astype(np.int64) * PERIOD
        left = np.zeros(len(codes), np.int64)
        order = np.argsort(-size, kind="stable")
        at, now, sizes = first[order].copy(), began[order].astype(np.int64), -size[order]
        active = np.searchsorted(sizes, 0)
        for i in range(int(size.max(initial=0))):
            while active and -sizes[active - 1] <= i:
                active -= 1
            here, t = at[:active], now[:active]
            t += self.steps[kinds[here] + (t & (PERIOD - 1))]
            left[here] = t
            here += 1
        return left

    def bits(self, codes: np.ndarray, left: np.ndarray) -> np.ndarray:
        """The sampled bits of one text."""
        if not len(codes):
            return np.zeros(BITS, bool)
        last = (self.records < left[-1]).sum(axis=1) - 1
        place = self.records[np.arange(BITS), last]
        char = codes[np.searchsorted(left, place, "right")]
        return mix(char.astype(U) * U(BITS) + np.arange(BITS, dtype=U)) >> U(63) == 1


def _hex(bits: np.ndarray) -> str:
    return np.packbits(bits).tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return max(0.0, 1 - 2 * int((a != b).sum()) / BITS)


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) for t in texts], np.int64)
    return codes, np.cumsum(size) - size, size


_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _block(walker: Walker, rows: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """Results of all rows but the last, whose text is the next one's of the row before it."""
    texts = [t for _, t in rows]
    codes, first, size = _codes(texts)
    left = walker.walk(codes, first, size, np.zeros(len(texts), np.int64))
    own = [walker.bits(codes[a:a + n], left[a:a + n]) for a, n in zip(first, size, strict=True)]
    # an edited text keeps the first half of its walk and goes on with the next text's beginning
    half = size[:-1] // 2
    kept = size[:-1] - half
    tails = [texts[i + 1][:half[i]] for i in range(len(rows) - 1)]
    t_codes, t_first, t_size = _codes(tails)
    began = np.where(kept > 0, left[np.maximum(first[:-1] + kept - 1, 0)] if len(left) else 0, 0)
    t_left = walker.walk(t_codes, t_first, t_size, began)
    out: list[list] = [[] for _ in _NAMES]
    for i in range(len(rows) - 1):
        a, k, ta, tn = first[i], kept[i], t_first[i], t_size[i]
        edited = walker.bits(np.concatenate((codes[a:a + k], t_codes[ta:ta + tn])),
                             np.concatenate((left[a:a + k], t_left[ta:ta + tn])))
        sha = hashlib.sha256((texts[i][:k] + tails[i]).encode("utf-8", "surrogatepass")).hexdigest()
        for column, value in zip(out, (rows[i][0], int(size[i]), sha, _hex(own[i]), _hex(edited),
                                       likeness(own[i], edited), likeness(own[i], own[i + 1])), strict=True):
            column.append(value)
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=_NAMES)


def _along(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket and id; each bucket ends with a row that only serves as the next of the one before."""
    walker, rows, chars = Walker(), [], 0

    def done(keep: int) -> Iterator[pa.RecordBatch]:
        nonlocal rows, chars
        if len(rows) > 1:
            yield _block(walker, rows)
        rows, chars = rows[len(rows) - keep:], 0

    for batch in batches:
        for i, tail in enumerate(batch.column("tail").to_pylist()):
            text = batch.column("text")[i].as_py() or ""
            rows.append((batch.column("doc_id")[i].as_py(), text))
            chars += len(text)
            if tail:
                yield from done(0)
            elif chars > 2_000_000:
                yield from done(1)


def _bucket(key, bounds: list[int]):
    """How many of the sorted bounds are at most the key, by binary search."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(cuts, at + step - 1) <= key, at + step).otherwise(at))


def edit_fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, and of its edit that ends with the beginning of the next document.

    Next is by ascending id (null ids come first; rows of an id by text); the last row's next is the first
    row.  The edited text is the text with its last n_chars // 2 code points replaced by as many from the
    start of the next text (or all of it).  Returns doc_id, n_chars (code points), edited_sha256, fingerprint
    and edited_fingerprint (hex of BITS bits), near_edited and near_next (likeness, 0 to 1).  A null text
    counts as empty; an empty text's fingerprint is all zeros.  An empty table gives no rows.  Other columns
    are not read.

    Ids are cut at their quantiles into as many buckets as there are shuffle partitions.  Each bucket is
    sorted in one task, and the first row of each also goes to the end of the bucket before, so that one
    shuffle of the texts is enough.
    """
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    spark = docs.sparkSession
    key = F.coalesce("doc_id", F.lit(-(2**63)))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.select(F.percentile_approx(key, [i / buckets for i in range(1, buckets)] or [0.5], 50 * buckets)
                        .alias("q")).first()["q"]
    if found is None:
        return spark.createDataFrame([], _SCHEMA)
    numbered = docs.withColumn("bucket", _bucket(key, sorted(set(found))))
    heads = numbered.groupBy("bucket").agg(F.min(key).alias("head")).orderBy("bucket").collect()
    before = {row["head"]: heads[i - 1]["bucket"] for i, row in enumerate(heads)}
    to = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    firsts = (numbered.where(key.isin(list(before))).withColumn("target", to[key])
              .groupBy("doc_id", "target").agg(F.min("text").alias("text")))
    rows = numbered.select("bucket", F.lit(False).alias("tail"), "doc_id", "text").unionAll(
        firsts.select(F.col("target").alias("bucket"), F.lit(True).alias("tail"), "doc_id", "text"))
    return (rows.repartition("bucket").sortWithinPartitions("bucket", "tail", "doc_id", "text")
            .select("tail", "doc_id", "text").mapInArrow(_along, _SCHEMA))


def _sampled() -> np.ndarray:
    """The places of each band's bits in the fingerprint."""
    draw = np.random.Generator(np.random.PCG64(11))
    return np.stack([np.sort(draw.choice(BITS, BAND_BITS, replace=False)) for _ in range(BANDS)])


def _banding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each band of each fingerprint, the band and its sampled bits as one number."""
    sampled = _sampled()
    weights = 1 << np.arange(BAND_BITS)
    for batch in batches:
        n = batch.num_rows
        packed = np.frombuffer(b"".join(batch.column("bits").to_pylist()), np.uint8)
        bits = np.unpackbits(packed.reshape(n, BITS // 8), axis=1)
        keys = np.stack([(bits[:, places] @ weights) + (band << BAND_BITS) for band, places in enumerate(sampled)], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)), pa.array(keys.ravel())],
                                         names=["node", "key"])


def _meetings(most: int):
    """Links between nodes of a key (or pair of its blocks) that differ in at most `most` bits, as stars.

    Rows come sorted by key, x and y.  Each row is compared with those 1, 2, ... rows on, while any is of its group."""
    def stars(rows: pa.RecordBatch, group: np.ndarray) -> Iterator[pa.RecordBatch]:
        node, side = rows.column("node").to_numpy(), rows.column("side").to_numpy()
        bits = np.frombuffer(b"".join(rows.column("bits").to_pylist()), U).reshape(len(node), BITS // 64)
        at, found, links = np.arange(len(node)), [], 0

        def linked() -> pa.RecordBatch:
            a, b = (np.concatenate(x) for x in zip(*found, strict=True))
            return block_stars([pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])])

        for d in range(1, len(node)):
            at = at[: np.searchsorted(at, len(node) - d)]
            at = at[group[at] == group[at + d]]
            if not len(at):
                break
            i = at[(side[at] == 0) | (side[at] != side[at + d])]
            i = i[np.bitwise_count(bits[i] ^ bits[i + d]).sum(axis=1, dtype=np.int64) <= most]
            found.append((node[i], node[i + d]))
            links += len(i)
            if links >= 1_000_000:
                yield linked()
                found, links = [], 0
        if links:
            yield linked()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
            keys = np.stack([rows.column(c).to_numpy() for c in ("key", "x", "y")])
            group = np.concatenate(([0], np.cumsum((keys[:, 1:] != keys[:, :-1]).any(axis=0))))
            last = int(np.searchsorted(group, group[-1]))
            yield from stars(rows.slice(0, last), group[:last])
            held = [rows.slice(last)]
        if held:
            yield from stars(held[0], np.zeros(held[0].num_rows, np.int64))

    return run


def near_duplicates(fingerprints: DataFrame, least: float = 0.8) -> DataFrame:
    """Components of documents whose fingerprints' likeness is at least `least`, found by bit-sampled bands.

    fingerprints has doc_id and fingerprint.  Equal fingerprints are one node.  Each of BANDS bands samples
    BAND_BITS of the bits; all nodes that share a band's value are verified against each other, those of a value
    with more than BLOCK nodes in blocks that go to different tasks, and links make components.  Returns the
    columns of fingerprints and component_id (smallest doc_id reachable).  The search is probabilistic: at
    likeness 0.8 a pair shares a band with probability 0.93, at 0.9 with 0.9999, whatever else is in the table.
    Null ids or fingerprints and empty texts (all zeros) link with nothing.
    """
    real = F.col("doc_id").isNotNull() & F.col("fingerprint").rlike("[1-9a-f]")
    # as bytes, which are half of their hex, wherever they are shuffled or written
    bits = F.unhex("fingerprint")
    nodes = written(fingerprints.where(real).groupBy(bits.alias("bits")).agg(F.min("doc_id").alias("node"), F.count("*").alias("copies")), "nodes")
    banded = nodes.mapInArrow(_banding, "node long, key long")
    shared = written(banded.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.count("*").alias("n"))
                     .where("n > 1").drop("n"), "shared")
    # block i is compared with every block j: the row goes to (min(i, j), max(i, j))
    placed = (banded.join(shared, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("key", "node", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"),
                      F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side")))
    links = (placed.join(nodes, "node").repartition("key", "x", "y").sortWithinPartitions("key", "x", "y")
             .mapInArrow(_meetings(int(BITS * (1 - least) / 2)), "a long, b long"))
    found = components(links, "a", "b")
    # a node of one row without links is its own component and needs no row here
    of = written(nodes.join(found, "node", "left").where("copies > 1 OR component IS NOT NULL").select(
        "bits", F.coalesce("component", "node").alias("component_id")), "components")
    return (fingerprints.join(of, F.when(real, bits) == of["bits"], "left")
            .select(*[fingerprints[c] for c in fingerprints.columns], F.coalesce(of["component_id"], "doc_id").alias("component_id")))


def op9_document_fingerprints(spark, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and the component of near copies."""
    return near_duplicates(written(edit_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet")), "fingerprints"))
