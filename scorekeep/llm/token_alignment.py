"""Alignment of two tokenizers' tokens by products of sparse incidence matrices.

A text's tokens and bytes make a 0/1 matrix for each tokenizer, in compressed rows.  The product of the one with the
other's transpose, row by row as Gustavson computes it, has an entry for every two tokens that share bytes, with
their number: the overlap links.  Bytes where tokens of both end cut the tokens into groups; the product of the two
group matrices has an entry for every two tokens of one group: the shared-group links.

How many documents hold a pair of ids linked is counted in three steps.  Each task makes the matrix of texts and
linked pairs of a block of documents, the blocks' column counts are added up by pair, and every block gets back the
totals of its own pairs, so that no task holds all of them.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorekeep.llm.byte_bpe import PrefixCodec, all_characters
from scorekeep.llm.common import Remembered, over_slices, slices, written

SPACE = "▁"
#: Texts whose pairs are counted together (bytes).
BLOCK_BYTES = 8_000_000
#: Bytes whose products are formed at a time, unless one group has more.
PART_BYTES = 250_000
#: Bytes of memory for remembered pieces of text of the second tokenizer, in each Python worker.
UNIT_BYTES = 100_000_000
#: A pair of ids as one number: the first one's times this, and the second one's.
PAIR = 1 << 20


class Csr:
    """A sparse matrix of numbers in compressed rows: row i has the columns indices[indptr[i]:indptr[i + 1]]."""

    def __init__(self, indptr: np.ndarray, indices: np.ndarray, width: int, data: np.ndarray | None = None):
        self.indptr, self.indices, self.width = indptr, indices, width
        self.data = np.ones(len(indices), np.int64) if data is None else data

    @classmethod
    def of_spans(cls, ends: np.ndarray, width: int) -> Csr:
        """Row i has ones from the end of row i - 1 to ends[i]."""
        return cls(np.concatenate(([0], ends)), np.arange(width), width)

    @classmethod
    def of_members(cls, column: np.ndarray, width: int) -> Csr:
        """Row i has a one in column[i]."""
        return cls(np.arange(len(column) + 1), column, width)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        order = np.argsort(self.indices, kind="stable")
        edge = np.concatenate(([0], np.cumsum(np.bincount(self.indices, minlength=self.width))))
        return Csr(edge, self.rows()[order], len(self.indptr) - 1, self.data[order])

    def times(self, other: Csr) -> Csr:
        """The product, row by row: the rows of other that a row's entries name are scaled and added up."""
        size = np.diff(other.indptr)[self.indices]
        begin = np.cumsum(size) - size
        at = np.repeat(other.indptr[self.indices] - begin, size) + np.arange(size.sum())
        row, column = np.repeat(self.rows(), size), other.indices[at]
        value = np.repeat(self.data, size) * other.data[at]
        key = row * other.width + column
        if len(key) and (key[1:] < key[:-1]).any():
            order = np.argsort(key, kind="stable")
            key, row, column, value = key[order], row[order], column[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        total = np.add.reduceat(value, first) if len(first) else value
        edge = np.concatenate(([0], np.cumsum(np.bincount(row[first], minlength=len(self.indptr) - 1))))
        return Csr(edge, column[first], other.width, total)


def engine_matches(pattern: str) -> set[str]:
    """Characters that match a class in the regular expressions of the first tokenizer's library."""
    from tokenizers import Regex, pre_tokenizers

    split = pre_tokenizers.Split(Regex(pattern + "+"), "removed", invert=True)
    text = all_characters()
    return {c for i in range(0, len(text), 2000) for piece, _ in split.pre_tokenize_str(text[i:i + 2000]) for c in piece}


def byte_level_codec(path: str, pattern: str) -> PrefixCodec:
    """The codec of a byte-level BPE file whose merges come in the order of the ids."""
    with open(path, encoding="utf-8") as f:
        about = json.load(f)
    model, before = about["model"], about["pre_tokenizer"]
    if about["normalizer"] or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"]:
        raise ValueError("only byte-level tokenizers without normalisation and prefix are supported")
    joined = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if joined != sorted(joined):
        raise ValueError("the merges must come in the order of the ids")
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    others = [b for b in range(256) if b not in set(printed)]
    spelt = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}
    special = {t["content"] for t in about["added_tokens"]}
    ranks = {bytes(map(spelt.__getitem__, token)): i for token, i in model["vocab"].items() if token not in special}
    return PrefixCodec(ranks, pattern, whole_matches=False, matches=engine_matches)


class PieceCodec:
    """Ids of texts by a SentencePiece model that keeps texts as they are.

    Where no piece holds a space mark after another character, no piece crosses the begin of a word, so words are
    encoded once each; otherwise texts are encoded whole."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        how = model.normalizer_spec
        if how.precompiled_charsmap or how.remove_extra_whitespaces or not how.add_dummy_prefix:
            raise ValueError("only models with identity normalisation and a prefix are supported")
        kinds = proto.ModelProto.SentencePiece
        self.library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.spelt = [bytes([int(p.piece[3:5], 16)]) if p.type == kinds.BYTE else p.piece.replace(SPACE, " ").encode()
                      for p in model.pieces]
        plain = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
        self.mark = plain.get(SPACE)
        self.by_word = self.mark is not None and not any(SPACE in p.lstrip(SPACE) for p in plain)
        self.find = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.words = Remembered(lambda unit: self.encode_units([unit])[0], UNIT_BYTES)
        self.sizes = np.array([len(s) for s in self.spelt], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(self.spelt), np.uint8)

    def encode_units(self, units: list[str]) -> list[bytes]:
        """Ids (int32) of texts that begin with the prefix's mark."""
        found = self.library.encode([u[1:].replace(SPACE, " ") for u in units], num_threads=1)
        return [np.array([self.mark] if u == SPACE else ids, np.int32).tobytes() for u, ids in zip(units, found, strict=True)]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(ids, np.int32) for ids in self.library.encode(texts, num_threads=1)]
        units = [self.find.findall(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        pick, new, again = {}, [], []
        for u in set().union(*units):
            if (ids := self.words.get(u)) is None:
                ids = self.words.older.get(u)
                (new if ids is None else again).append(u)
            pick[u] = ids
        pick |= zip(new, self.encode_units(new), strict=True)
        for u in again + new:
            self.words.put(u, pick[u])
        return [np.frombuffer(b"".join(map(pick.__getitem__, u)), np.int32) for u in units]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other (uint8)."""
        sizes = self.sizes[ids]
        return self.bytes[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


@lru_cache
def decimals(bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every number of so many bits: its decimal digits and a place for a mark (uint8), which of these it has,
    and how many."""
    rest = np.arange(1 << bits)
    width = len(str(len(rest) - 1))
    digits, used = np.zeros((len(rest), width + 1), np.uint8), np.ones((len(rest), width + 1), bool)
    for d in range(width - 1, -1, -1):
        used[:, d] = rest > 0
        digits[:, d] = 48 + rest % 10
        rest = rest // 10
    used[:, width - 1] = True
    return digits, used, used.sum(axis=1)


class Aligned:
    """Tokens, groups and overlap links of several texts, one after the other on one axis of bytes."""

    def __init__(self, a_ids: list[np.ndarray], b_ids: list[np.ndarray], a_sizes: np.ndarray, b_sizes: np.ndarray):
        none = np.zeros(0, np.int32)
        self.a, self.b = np.concatenate([*a_ids, none]).astype(np.int64), np.concatenate([*b_ids, none]).astype(np.int64)
        self.a_edge, self.b_edge = (np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int64) for ids in (a_ids, b_ids))
        self.a_end, self.b_end = np.cumsum(a_sizes[self.a]), np.cumsum(b_sizes[self.b])
        at = np.searchsorted(self.b_end, self.a_end)
        a_cut, b_cut = np.append(self.b_end, -1)[at] == self.a_end, np.zeros(len(self.b), bool)
        b_cut[at[a_cut]] = True
        self.cuts = self.a_end[a_cut]
        self.a_group, self.b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut  # cuts before a token's end
        self.group_edge = np.append(self.a_group, len(self.cuts))[self.a_edge]  # a text's groups

    def _parts(self) -> Iterator[tuple[int, int]]:
        """Runs of groups of about PART_BYTES."""
        at = 0
        while at < len(self.cuts):
            begin = self.cuts[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(self.cuts, begin + PART_BYTES)))
            yield at, to
            at = to

    def _products(self, matrices: Callable[..., tuple[Csr, Csr]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and values of the product of two matrices, part by part: no entry lies across groups."""
        found = [(np.zeros(0, np.int64),) * 3]
        for low, high in self._parts():
            a0, a1 = np.searchsorted(self.a_group, (low, high))
            b0, b1 = np.searchsorted(self.b_group, (low, high))
            left, right = matrices(low, high, a0, a1, b0, b1)
            product = left.times(right.transposed())
            found.append((product.rows() + a0, product.indices + b0, product.data))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True))

    def overlaps(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the two tokens of every overlap link, and the bytes that they share."""

        def incidence(low, high, a0, a1, b0, b1):
            begin = self.cuts[low - 1] if low else 0
            width = int(self.cuts[high - 1] - begin)
            return Csr.of_spans(self.a_end[a0:a1] - begin, width), Csr.of_spans(self.b_end[b0:b1] - begin, width)

        return self._products(incidence)

    def shared_groups(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the two tokens of every shared-group link."""

        def membership(low, high, a0, a1, b0, b1):
            return (Csr.of_members(self.a_group[a0:a1] - low, high - low), Csr.of_members(self.b_group[b0:b1] - low, high - low))

        return self._products(membership)[:2]

    def spelt_groups(self) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` of every text: the ids of each group's row in the two group matrices."""
        texts = len(self.a_edge) - 1
        if not len(self.a):
            return [b""] * texts
        groups = len(self.cuts)
        a_rows, b_rows = (Csr.of_members(g, groups).transposed() for g in (self.a_group, self.b_group))
        n = len(self.a) + len(self.b)
        a_at = np.arange(len(self.a)) + b_rows.indptr[self.a_group]
        b_at = np.arange(len(self.b)) + a_rows.indptr[self.b_group + 1]
        ids = np.empty(n, np.int64)
        ids[a_at], ids[b_at] = self.a[a_rows.indices], self.b[b_rows.indices]
        mark = np.full(n, ord(","), np.uint8)
        mark[a_at[a_rows.indptr[1:] - 1]] = ord("|")
        mark[b_at[b_rows.indptr[1:] - 1]] = ord(";")
        digits, used, size = decimals(int(ids.max()).bit_length())
        spelt = digits[ids]
        spelt[:, -1] = mark
        data = spelt[used[ids]].tobytes()
        edge = np.concatenate(([0], np.cumsum(size[ids])))[self.a_edge + self.b_edge]
        return [data[edge[i]:max(edge[i], edge[i + 1] - 1)] for i in range(texts)]


class Pair:
    """Two tokenizers that align texts."""

    def __init__(self, byte_path: str, piece_path: str, pattern: str):
        self.first, self.second = byte_level_codec(byte_path, pattern), PieceCodec(piece_path)

    def align(self, texts: list[str | None]) -> Aligned:
        """A text without tokens: null, empty, or spelt otherwise by the tokens of one of the two."""
        texts = [t or "" for t in texts]
        a_ids = self.first.encode_texts([" " + t if t else "" for t in texts])
        b_ids = self.second.encode_texts(texts)
        none = np.zeros(0, np.int32)
        for i, t in enumerate(texts):
            data = (" " + t).encode("utf-8", "replace")
            if t and not (self.first.decode(a_ids[i]).tobytes() == data == self.second.decode(b_ids[i]).tobytes()):
                a_ids[i] = b_ids[i] = none
        return Aligned(a_ids, b_ids, self.first.sizes, self.second.sizes)


_pairs: dict[tuple[str, str, str], Pair] = {}


def _pair(*paths: str) -> Pair:
    if paths not in _pairs:
        _pairs[paths] = Pair(*paths)
    return _pairs[paths]


def _chosen(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def aligned_tokens(documents: DataFrame, byte_path: str, piece_path: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Per row: doc_id, a_ids and b_ids, overlaps (places of two tokens, bytes shared) and shared (places of two
    tokens of one group), both in order, places from 0 within the text."""

    def align(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        own = _pair(byte_path, piece_path, pattern).align(part.column("text").to_pylist())
        columns = {"doc_id": part.column("doc_id")}
        for name, ids, edge in (("a_ids", own.a, own.a_edge), ("b_ids", own.b, own.b_edge)):
            columns[name] = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int32()))
        for name, (a, b, *value) in (("overlaps", own.overlaps()), ("shared", own.shared_groups())):
            text = np.searchsorted(own.a_edge, a, side="right") - 1
            fields = [pa.array(a - own.a_edge[text], pa.int32()), pa.array(b - own.b_edge[text], pa.int32()),
                      *(pa.array(v, pa.int32()) for v in value)]
            structs = pa.StructArray.from_arrays(fields, names=["a", "b", "bytes"][: len(fields)])
            columns[name] = pa.ListArray.from_arrays(pa.array(np.searchsorted(a, own.a_edge), pa.int32()), structs)
        yield pa.RecordBatch.from_pydict(columns)

    return _chosen(documents, id_col, text_col).mapInArrow(
        over_slices(align), "doc_id long, a_ids array<int>, b_ids array<int>, overlaps array<struct<a:int,b:int,bytes:int>>, "
        "shared array<struct<a:int,b:int>>")


def _linked(own: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text, the pair of ids and the number of links of every pair that a text holds linked, in order, and
    where each text's links begin among all."""
    a, b, _ = own.overlaps()
    edge = np.searchsorted(a, own.a_edge)
    key = np.repeat(np.arange(len(edge) - 1), np.diff(edge)) * (PAIR * PAIR) + own.a[a] * PAIR + own.b[b]
    key.sort()
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first] // (PAIR * PAIR), key[first] % (PAIR * PAIR), np.diff(np.append(first, len(key))), edge


def packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers from 0 on as bytes of seven bits, the lowest first, all but a number's last one marked; and the sizes."""
    most = max(1, -(-int(values.max(initial=0)).bit_length() // 7))
    parts = (values[:, None] >> (7 * np.arange(most))) & 127
    size = 1 + (values[:, None] >> (7 * np.arange(1, most)) > 0).sum(axis=1)
    place = np.arange(most)
    parts |= np.where(place < size[:, None] - 1, 128, 0)
    return parts.astype(np.uint8)[place < size[:, None]], size


def unpacked(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(0, np.int64)
    first = np.concatenate(([0], np.flatnonzero(data[:-1] < 128) + 1))
    place = np.arange(len(data)) - np.repeat(first, np.diff(np.append(first, len(data))))
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * place), first)


_BLOCK = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, entries binary, "
          "pairs array<long>, n array<long>")
_ROW = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def _counted(pair: Pair, part: pa.RecordBatch, block: int) -> pa.RecordBatch:
    """A block: per row its counts and, packed, its row of the matrix of texts and pairs (column steps and values);
    in the block's first row the pairs, and how many texts hold each."""
    columns: dict[str, list] = {"n_a": [], "n_b": [], "n_groups": [], "n_links": [], "groups_sha256": []}
    texts, pairs, links, before = [], [], [], 0
    for piece in slices(part, "text"):
        own = pair.align(piece.column("text").to_pylist())
        text, which, n, edge = _linked(own)
        texts.append(text + before)
        pairs.append(which)
        links.append(n)
        before += piece.num_rows
        for name, found in (("n_a", own.a_edge), ("n_b", own.b_edge), ("n_groups", own.group_edge), ("n_links", edge)):
            columns[name].append(np.diff(found))
        columns["groups_sha256"] += [hashlib.sha256(s).hexdigest() if s else "" for s in own.spelt_groups()]
    text, links = np.concatenate(texts), np.concatenate(links)
    pairs, slot = np.unique(np.concatenate(pairs), return_inverse=True)
    matrix = Csr(np.searchsorted(text, np.arange(part.num_rows + 1)), slot, len(pairs), links)
    step = np.diff(matrix.indices, prepend=0)
    begins = matrix.indptr[:-1][np.diff(matrix.indptr) > 0]
    step[begins] = matrix.indices[begins]
    data, size = packed(np.stack((step, matrix.data), axis=1).ravel())
    to = np.concatenate(([0], np.cumsum(size)))[2 * matrix.indptr].astype(np.int32)
    rows = part.num_rows
    edge = pa.array([0] + [len(pairs)] * rows, pa.int32())  # the first row's, none for the others
    held = np.bincount(slot, minlength=len(pairs)).astype(np.int64)
    return pa.RecordBatch.from_pydict({
        "block": pa.array(np.full(rows, block)), "doc_id": part.column("doc_id"),
        **{k: pa.array(v if k == "groups_sha256" else np.concatenate(v)) for k, v in columns.items()},
        "entries": pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer(to), pa.py_buffer(data)]),
        "pairs": pa.ListArray.from_arrays(edge, pa.array(pairs)), "n": pa.ListArray.from_arrays(edge, pa.array(held))})


def _blocks(paths: tuple[str, str, str]):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = _pair(*paths)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", BLOCK_BYTES):
                yield _counted(pair, part, block)
                block += 1

    return cut


def _scored(rows: pa.Table, totals: pa.Table) -> pa.Table:
    """The rows of a block: products of its matrix with the totals of its pairs."""
    order = np.argsort(totals.column("pair").to_numpy())  # slots are numbered by pair
    count, best = (totals.column(c).to_numpy()[order].astype(np.int64) for c in ("count", "best"))
    entries = rows.column("entries").to_pylist()
    sums = np.zeros((2, len(entries)), np.int64)
    for i, data in enumerate(entries):
        step, links = unpacked(np.frombuffer(data, np.uint8)).reshape(-1, 2).T
        slot = np.cumsum(step)
        sums[:, i] = (links * best[slot]).sum(), (links * count[slot]).sum()
    return pa.table({n: rows.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
                    | {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1]), "groups_sha256": rows.column("groups_sha256")})


def alignment_counts(documents: DataFrame, byte_path: str, piece_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A pair's count is the number of rows that hold its ids linked.  A null or empty text, or one that the tokens
    spell otherwise, has zeros and an empty digest.  Rows with null or repeated ids count like others; other columns
    are not read; an empty table gives no rows."""
    paths = (byte_path, piece_path, pattern)
    blocks = written(_chosen(documents, id_col, text_col).mapInArrow(_blocks(paths), _BLOCK), "blocks")
    asked = blocks.where("size(pairs) > 0").select("block", F.explode(F.arrays_zip("pairs", "n")).alias("p")).select(
        "block", F.col("p.pairs").alias("pair"), F.col("p.n").alias("n"))
    total = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.expr(f"pair div {PAIR}")))  # of one id at most the other's vocabulary
    total = total.withColumn("best", F.col("count") == most)
    answers = asked.select("block", "pair").join(total, "pair").select(F.col("block").alias("asker"), "pair", "count", "best")
    return blocks.drop("pairs", "n").groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_scored, _ROW)


def op11_cross_tokenizer(spark, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of all documents by two public tokenizers."""
    import public_tokenizers

    return alignment_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"),
                            public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)
