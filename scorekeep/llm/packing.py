"""Packing of tokenised documents into sequences by swap-based local search.

Pieces are dealt at random to groups of about GROUP pieces.  A group starts from best fit decreasing; while it
has more sequences than its tokens need, the emptiest ones give documents away: a move, a one-for-one, a
two-for-one or a one-for-two exchange with another underfull sequence, whichever raises the sum of squared
fills most, until a sequence is empty or nothing raises the sum.  Sequences that stay loosely filled are
opened again and packed with those of the other groups, round after round, until one group is left or more than half
of a round's pieces stay loose (then few fit together, as with pieces of over half the capacity, and no round would end).
"""

from __future__ import annotations

import heapq
import itertools
import json
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import gathered, numbered, over_slices, written

CAPACITY = 4096
GROUP = 20_000
#: A sequence with less than this share of its capacity is packed again with other groups' sequences.
LOOSE = 15 / 16
#: Bytes of text that a task encodes at a time: frequent words of it are merged once.
SLICE = 16_000_000


def flattened(rows: Iterable[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all rows one after the other, and how many each has."""
    rows = list(rows)
    count = np.fromiter(map(len, rows), np.int64, len(rows))
    return np.fromiter(itertools.chain.from_iterable(rows), "<u4", count.sum()), count


def joined(rows: Iterable[Sequence], encode: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Ids of rows of parts one after the other, and how many each row has; encode gives those of the distinct parts."""
    of, held, parts = numbered(rows)
    ids, count = encode(parts)
    total = np.concatenate(([0], np.cumsum(count[of])))
    return gathered(ids, (np.cumsum(count) - count)[of], count[of]), np.diff(total[held])


class WordEncoder:
    """Token ids of a text as little-endian uint32 bytes, as the tokenizers library gives them.

    For a tokenizer that drops white space, ids of a text are those of its words one after the other, so
    each distinct word of several texts is encoded once.  Words of Latin letters and plain marks are cut where the
    tokenizer cuts them, and each distinct part goes straight to its merges; any other word goes through the whole
    library.  A tokenizer of another kind gets whole texts.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        about = json.loads(self.tokenizer.to_str())
        steps = [(s.get("type"), s.get("pattern"), s.get("content")) for s in (about["normalizer"] or {}).get("normalizers", ())]
        cuts = (about["pre_tokenizer"] or {}).get("pretokenizers", ())
        self.by_word = steps == [("NFC", None, None), ("Replace", {"Regex": r"\s+"}, " "), ("Lowercase", None, None)] and bool(
            cuts) and cuts[0].get("behavior") == "Removed" and r"[^\s\p{L}\p{N}]+" in cuts[0]["pattern"]["Regex"] and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] for t in about["added_tokens"])
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in set(printed)]
        self.chars = {b: b for b in printed} | {b: 256 + i for i, b in enumerate(others)}
        self.plain = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ!-&(-/:;=-@\[-`{-~]*")
        self.run = re.compile(r"[a-zß-öø-ÿ]+|[^a-zß-öø-ÿ]+")

    def _library(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _run(self, run: str) -> list[int]:
        spelt = run if run.isascii() else run.encode().decode("latin-1").translate(self.chars)
        return [t.id for t in self.tokenizer.model.tokenize(spelt)]

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has."""
        texts, plain = [w.decode("utf-8", "replace") for w in words], self.plain.fullmatch
        other = {w for w in texts if not plain(w)}  # none of them is a part of a plain word
        return joined(((w,) if w in other else self.run.findall(w.lower()) for w in texts), lambda runs: flattened(
            self._library(run) if run in other else self._run(run) for run in runs))

    def encode_all(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts one after the other, and how many each has."""
        if not self.by_word:
            return flattened(self._library(t.decode("utf-8", "replace")) for t in texts)
        return joined(map(bytes.split, texts), self._words)


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutting(path: str, capacity: int, end_id: int):
    def cut(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = part.column("text").fill_null("").cast(pa.binary()).to_pylist()
        found, count = _encoder(path).encode_all(texts)
        edge = np.concatenate(([0], np.cumsum(count + 1)))
        ids = np.full(edge[-1], end_id, "<u4")
        inside = np.ones(len(ids), bool)
        inside[edge[1:] - 1] = False
        ids[inside] = found
        data, rows = memoryview(ids.tobytes()), []
        for doc, low, high in zip(part.column("doc_id").to_pylist(), edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            for k, at in enumerate(range(low, high, capacity)):
                end = min(at + capacity, high)
                rows.append((doc, k, at - low, end - at, zlib.crc32(data[4 * at:4 * end])))
        columns = list(zip(*rows, strict=True)) if rows else [()] * 5
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                         names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return over_slices(cut, most=SLICE)


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most `capacity` tokens of every text's ids followed by end_id (null text: only end_id)."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_cutting(tokenizer, capacity, end_id), _PIECE)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices by best fit decreasing."""
    bins: list[list[int]] = []
    by_room: dict[int, list[int]] = {}
    rooms = 0  # bit r is set if some bin has room r
    for i in sorted(range(len(lengths)), key=lengths.__getitem__, reverse=True):
        n = lengths[i]
        if fitting := rooms >> n:
            room = n + (fitting & -fitting).bit_length() - 1
            b = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
        else:
            room, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if room > n:
            by_room.setdefault(room - n, []).append(b)
            rooms |= 1 << (room - n)
    return bins


def fewest(lengths: list[int], capacity: int) -> int:
    """A number of bins that no packing goes below: what all tokens fill, and what the large items need, of which k at
    most share a bin if each is over capacity / (k + 1)."""
    sizes = np.sort(np.asarray(lengths, np.int64))
    if not len(sizes):
        return 0
    k = np.arange(1, max(2, min(capacity // max(int(sizes[0]), 1), 64)) + 1)
    large = len(sizes) - np.searchsorted(sizes, capacity // (k + 1), "right")
    return int(max(-(-int(sizes.sum()) // capacity), (-(-large // k)).max()))


class _Search:
    """Underfull bins, and two sorted indexes of what each can give away: nothing, an item or (in the second) two items.

    An index entry is the bin's room, the unit's size and the bin in one number, so that one search tells, for a unit
    to place, the best partner in the bins of each room.  An exchange renews the entries of the two bins that it touches."""

    def __init__(self, bins: list[list[int]], lengths: list[int], capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = np.array([sum(lengths[i] for i in b) for b in bins], np.int64)
        self.rooms = np.bincount(capacity - self.fill, minlength=capacity + 1)  # bins of each room
        keys = [self._keys(b) for b in range(len(bins)) if self.fill[b] < capacity]
        self.index = [np.sort(np.concatenate([k[two] for k in keys] or [np.zeros(0, np.int64)])) for two in (0, 1)]

    def units(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Sizes of single items and of pairs of items of a bin, each once."""
        sizes = np.sort(np.array([self.lengths[i] for i in self.bins[b]], np.int64))
        if not len(sizes):
            return sizes, sizes
        single, count = np.unique(sizes, return_counts=True)
        low, high = np.triu_indices(len(single), 1)
        return single, np.unique(np.concatenate((single[low] + single[high], 2 * single[count > 1])))

    def _keys(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        single, pair = self.units(b)
        base = (self.capacity - self.fill[b]) * (self.capacity + 1)
        one = np.concatenate(([0], single))
        return tuple(np.sort((base + u) * len(self.bins) + b) for u in (one, np.unique(np.concatenate((one, pair)))))

    def take_out(self, b: int) -> None:
        self.rooms[self.capacity - self.fill[b]] -= 1
        if self.fill[b] < self.capacity:
            for n, keys in enumerate(self._keys(b)):
                self.index[n] = np.delete(self.index[n], np.searchsorted(self.index[n], keys))

    def put_in(self, b: int) -> None:
        self.fill[b] = sum(self.lengths[i] for i in self.bins[b])
        self.rooms[self.capacity - self.fill[b]] += 1
        if self.fill[b] < self.capacity:
            for n, keys in enumerate(self._keys(b)):
                self.index[n] = np.insert(self.index[n], np.searchsorted(self.index[n], keys), keys)

    def best(self, a: int) -> tuple[int, int, int, int] | None:
        """The exchange of bin a (taken out) that raises the sum of squared fills most: size and number of items to give
        (one or two), the other bin, and the size that comes back; None if nothing raises it."""
        room = np.flatnonzero(self.rooms[1:]) + 1
        found = None
        for n, gives in enumerate(self.units(a)):
            index = self.index[1 - n]  # three items at most change places
            if not len(gives) or not len(room) or not len(index):
                continue
            give, other = np.repeat(gives, len(room)), np.tile(room, len(gives))
            # the more goes over the better, up to the room: the smallest unit to come back that leaves it enough
            least = (other * (self.capacity + 1) + np.maximum(give - other, 0)) * len(self.bins)
            at = np.minimum(np.searchsorted(index, least), len(index) - 1)
            partner = index[at]
            back = partner // len(self.bins) % (self.capacity + 1)
            moved = give - back
            right = (partner >= least) & (partner // len(self.bins) // (self.capacity + 1) == other) & (moved > 0)
            gain = np.where(right, moved * (self.capacity - other + moved - self.fill[a]), 0)
            k = int(gain.argmax())
            if gain[k] > 0 and (found is None or gain[k] > found[0]):
                found = (int(gain[k]), int(give[k]), n + 1, int(partner[k] % len(self.bins)), int(back[k]))
        return found and found[1:]

    def pick(self, b: int, size: int, most: int) -> list[int]:
        """Items of a bin, as few as can be and at most `most`, that have this size together."""
        if not size:
            return []
        by_size: dict[int, list[int]] = {}
        for i in self.bins[b]:
            by_size.setdefault(self.lengths[i], []).append(i)
        if size in by_size:
            return by_size[size][:1]
        for n, items in by_size.items():
            if most > 1 and (rest := by_size.get(size - n)) and (n != size - n or len(items) > 1):
                return [items[0], rest[-1]]
        raise AssertionError("a unit of the index is gone")

    def step(self, a: int) -> int | None:
        """The best exchange of bin a: the other bin, or None."""
        self.take_out(a)
        chosen = self.best(a)
        if chosen is not None:
            give, n, b, back = chosen
            out, into = self.pick(a, give, n), self.pick(b, back, 3 - n)
            self.take_out(b)
            self.bins[a] = [i for i in self.bins[a] if i not in out] + into
            self.bins[b] = [i for i in self.bins[b] if i not in into] + out
            self.put_in(b)
        if self.bins[a]:
            self.put_in(a)
        else:
            self.fill[a] = 0
        return None if chosen is None else chosen[2]


def local_search(bins: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Exchange items of underfull bins, from the emptiest on, while that raises the sum of squared fills; drop bins that get
    empty.  It ends at `fewest` bins, or with a round over all bins in which none got empty."""
    needed = fewest(lengths, capacity)
    held = sum(map(bool, bins))
    if held <= needed:
        return [b for b in bins if b]
    search = _Search(bins, lengths, capacity)
    emptied = True
    while emptied and held > needed:
        emptied = False
        queue = [(int(search.fill[b]), b) for b in range(len(bins)) if bins[b] and search.fill[b] < capacity]
        heapq.heapify(queue)
        while queue and held > needed:
            fill, a = heapq.heappop(queue)
            if not bins[a] or search.fill[a] != fill:  # it has changed since
                continue
            other = search.step(a)
            if other is None:
                continue
            if not bins[a]:
                held, emptied = held - 1, True
            for b in (a, other):
                if bins[b] and search.fill[b] < capacity:
                    heapq.heappush(queue, (int(search.fill[b]), b))
    return [b for b in bins if b]


_PACKED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, loose boolean"


def _packing(capacity: int, turn: int):
    def pack(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_pylist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        base = (turn << 56) + (table.column("group")[0].as_py() << 20)
        order, sequence, offset, loose = [], [], [], []
        for s, b in enumerate(bins):
            at, total = 0, sum(lengths[i] for i in b)
            for i in b:
                order.append(i)
                sequence.append(base + s)
                offset.append(at)
                loose.append(total < LOOSE * capacity)
                at += lengths[i]
        out = table.drop_columns(["group"]).take(pa.array(order))
        for name, column in (("sequence_id", pa.array(sequence, pa.int64())), ("offset", pa.array(offset, pa.int64())),
                             ("loose", pa.array(loose))):
            out = out.append_column(name, column)
        return out

    return pack


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Give every piece (a length from 1 to capacity) a sequence_id and an offset.

    pieces: doc_id, piece, start, length, ids_crc32; equal rows are pieces of their own.  Within a sequence
    the pieces follow each other from offset 0 without gaps and end at capacity at most.  No rows give none.
    """
    now, done, turn = written(pieces, "pieces"), [], 0
    n = now.count()
    while n:
        groups = -(-n // group)
        dealt = now.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
        packed = written(dealt.groupBy("group").applyInArrow(_packing(capacity, turn), _PACKED), "packed")
        again = packed.where("loose")
        left = again.count() if groups > 1 else 0
        if left > n // 2:  # too few fit together for another round to gain
            left = 0
        done.append((packed.where("not loose") if left else packed).drop("loose"))
        now, n, turn = again.select(pieces.columns), left, turn + 1
    if not done:
        return now.select("*", F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return out


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pack all documents: doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    A document's ids are its text's (null: none) and a final id 1; only a document of more than capacity ids is
    cut.  Rows with a null or repeated id are packed like others.  Extra columns are not read.
    """
    return pack_pieces(token_pieces(documents, tokenizer, capacity), capacity)


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
