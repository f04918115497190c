"""SentencePiece encoding and decoding, by an Aho-Corasick automaton over the pieces and a Viterbi pass.

The automaton reads a text once.  At every position its output links name the pieces that end there, from
the longest on; each relaxes the best score of the position with its own score and that of the position
where it begins.  Tracing back gives the segmentation of the highest total score.  As in the library, a
character that no piece covers costs the lowest score less a penalty and becomes its UTF-8 byte pieces.

Where no piece holds a space mark after another character, no segmentation crosses a space, so texts are cut
into words.  The distinct words of a slice of texts go through the automaton together, one character of each at a
time: every step follows one edge and then one output link after the other for all of them.  Long words and those
with a character that no piece covers go through it alone.  Scores come from the model file; ties go to the longer
last piece.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import gathered, numbered, over_slices, released

SPACE = "▁"
#: Below the lowest score, for a character without a piece (the library's value).
UNKNOWN_PENALTY = 10.0
#: Words of up to so many characters go through the automaton together, so many at a time.
TOGETHER, BATCH = 40, 8192
#: Bytes of text that a task encodes at a time: frequent words of it are segmented once.
SLICE = 4_000_000


class Tables:
    """The automaton as arrays, for words that walk through it side by side.

    States are numbered from the root, 0, by depth.  An edge is the number state * alphabet + character; `longest` is the
    state of the longest piece that ends where a state does (0: none), `shorter` that of the next one (the output link)."""

    def __init__(self, pieces: list[tuple[str, int, float]]):
        letters = sorted(set("".join(p for p, _, _ in pieces)))
        self.rank = {c: k for k, c in enumerate(letters)}
        self.codes = np.full(max(map(ord, letters), default=0) + 2, -1, np.int32)  # the last one: any other character
        for c, k in self.rank.items():
            self.codes[ord(c)] = k
        goes: list[dict[int, int]] = [{}]
        depth, ends, score, back, parent = [0], [-1], [0.0], [0], [0]
        level = {(0, ""): [(p, i, s) for p, i, s in pieces]}
        while level:  # the states of one depth after the other
            deeper: dict[tuple[int, str], list] = {}
            for (state, _), own in level.items():
                for p, i, s in own:
                    if len(p) == depth[state]:
                        ends[state], score[state] = i, s
                    else:
                        deeper.setdefault((state, p[depth[state]]), []).append((p, i, s))
            level = {}
            for (state, c), own in deeper.items():
                k, at = self.rank[c], back[state]
                while at and k not in goes[at]:
                    at = back[at]
                back.append(goes[at].get(k, 0) if state else 0)
                goes[state][k] = len(goes)
                goes.append({})
                depth.append(depth[state] + 1)
                ends.append(-1)
                score.append(0.0)
                parent.append(state)
                level[len(goes) - 1, c] = own
        self.back, self.depth = np.array(back, np.int32), np.array(depth, np.int32)
        self.ends, self.score = np.array(ends, np.int32), np.array(score)
        longest = [0] * len(goes)
        for state in range(1, len(goes)):
            longest[state] = state if ends[state] >= 0 else longest[back[state]]
        self.longest = np.array(longest, np.int32)
        self.shorter = self.longest[self.back]
        edges = sorted((state * len(letters) + k, to) for state, own in enumerate(goes) for k, to in own.items())
        self.edge = np.array([e for e, _ in edges] + [len(goes) * len(letters)], np.int64)
        self.target = np.array([t for _, t in edges] + [0], np.int32)
        self.alone = np.zeros(len(letters) + 1, bool)  # characters that are pieces themselves; the last one: any other
        for p, _, _ in pieces:
            if len(p) == 1:
                self.alone[self.rank[p]] = True

    def spelt(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters of all words one after the other, as numbers (-1: in no piece), and the sizes of the words."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.codes[np.minimum(points, len(self.codes) - 1)], np.fromiter(map(len, words), np.int64, len(words))

    def step(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after one more letter each."""
        out = np.zeros_like(state)
        left = np.arange(len(state))
        while len(left):
            key = state[left].astype(np.int64) * len(self.rank) + letter[left]
            at = np.searchsorted(self.edge, key)
            found = self.edge[at] == key
            out[left[found]] = self.target[at[found]]
            left = left[~found & (state[left] > 0)]
            state[left] = self.back[state[left]]
        return out

    def segment(self, letters: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has; rows of letters are words, longest first."""
        n, most = letters.shape
        best = np.full((most + 1, n), -np.inf)
        best[0] = 0
        came = np.zeros((most + 1, n), np.int32)  # the state of the best last piece
        state = np.zeros(n, np.int32)
        going = np.searchsorted(-size, -np.arange(most), "left")  # words with more letters than this
        for at in range(most):
            now = going[at]
            state = self.step(state[:now], letters[:now, at])
            piece = self.longest[state]
            of = np.flatnonzero(piece)
            piece = piece[of]
            while len(of):
                total = best[at + 1 - self.depth[piece], of] + self.score[piece]
                more = total > best[at + 1, of]
                best[at + 1, of[more]] = total[more]
                came[at + 1, of[more]] = piece[more]
                piece = self.shorter[piece]
                of, piece = of[piece > 0], piece[piece > 0]
        count, turns = np.zeros(n, np.int64), []
        of, at = np.arange(n), size.copy()
        while len(of):
            piece = came[at, of]
            turns.append((of, self.ends[piece]))
            count[of] += 1
            at = at - self.depth[piece]
            of, at = of[at > 0], at[at > 0]
        place, found = np.cumsum(count), np.empty(count.sum(), np.int32)
        for k, (of, ids) in enumerate(turns, 1):  # from the last piece of each word on
            found[place[of] - k] = ids
        return found, count


class Codec:
    def __init__(self, path: str):
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        if model.normalizer_spec.precompiled_charsmap or model.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("only models with identity normalisation, which decode exactly, are supported")
        self.prefix = SPACE if model.normalizer_spec.add_dummy_prefix else ""
        kinds = proto.ModelProto.SentencePiece
        self.automaton = ahocorasick.Automaton()
        self.bytes, self.unknown, normal = {}, 0, []
        self.out: list[bytes] = []  # what each id decodes to, a space for the mark
        for i, p in enumerate(model.pieces):
            self.out.append(p.piece.replace(SPACE, " ").encode() if p.type in (kinds.NORMAL, kinds.USER_DEFINED) else b"")
            if p.type == kinds.BYTE:
                self.bytes[int(p.piece[3:5], 16)] = i
                self.out[i] = bytes([int(p.piece[3:5], 16)])
            elif p.type == kinds.UNKNOWN:
                self.unknown = i
            elif p.type in (kinds.NORMAL, kinds.USER_DEFINED):
                self.automaton.add_word(p.piece, (i, len(p.piece), p.score))
                normal.append(p)
        self.automaton.make_automaton()
        self.lowest = min((p.score for p in normal), default=0.0) - UNKNOWN_PENALTY
        crosses = any(SPACE in p.piece.lstrip(SPACE) for p in normal)
        line = "" if any("\n" in p.piece for p in normal) else "\n"  # without a piece, it stands alone in any case
        self.words = None if crosses else re.compile(f"{line}+|{SPACE}*[^{SPACE}{line}]+|{SPACE}+"[0 if line else 2:])
        self.tables = Tables([(p.piece, i, p.score) for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)])
        self.sizes = np.array([len(b) for b in self.out], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.spelling = np.frombuffer(b"".join(self.out), np.uint8)

    def viterbi(self, text: str) -> tuple[int, ...]:
        n = len(text)
        best = [0.0] + [float("-inf")] * n
        last: list[tuple[int, int]] = [(0, -1)] * (n + 1)  # begin of the best last piece, and its id
        matches = self.automaton.iter(text)
        end, piece = next(matches, (n, None))
        for at in range(n):
            while end == at:  # all pieces that end here, by output links
                i, size, score = piece
                begin = at + 1 - size
                if (total := best[begin] + score) > best[at + 1]:
                    best[at + 1], last[at + 1] = total, (begin, i)
                end, piece = next(matches, (n, None))
            if (total := best[at] + self.lowest) > best[at + 1] and text[at] not in self.automaton:
                best[at + 1], last[at + 1] = total, (at, -1)
        found: list[int] = []
        at = n
        while at:
            begin, i = last[at]
            if i >= 0:
                found.append(i)
            elif self.bytes:
                found += [self.bytes[b] for b in reversed(text[begin:at].encode("utf-8", "replace"))]
            elif not found or found[-1] != self.unknown:
                found.append(self.unknown)
            at = begin
        return tuple(reversed(found))

    def _segmented(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words one after the other, and how many each has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        flat, size = self.tables.spelt(words)
        begin = np.cumsum(size) - size
        covered = np.concatenate(([0], np.cumsum(~self.tables.alone[flat])))
        plain = (size <= TOGETHER) & (covered[begin + size] == covered[begin])
        together = np.flatnonzero(plain)
        together = together[np.argsort(-size[together], kind="stable")]
        count, parts = np.zeros(len(words), np.int64), []
        for low in range(0, len(together), BATCH):
            of = together[low:low + BATCH]
            spread = np.minimum(begin[of][:, None] + np.arange(size[of[0]]), len(flat) - 1)
            ids, count[of] = self.tables.segment(flat[spread], size[of])
            parts.append((of, ids))
        for i in np.flatnonzero(~plain):
            ids = np.array(self.viterbi(words[i]), np.int32)
            count[i] = len(ids)
            parts.append((np.array([i]), ids))
        place, found = np.cumsum(count) - count, np.empty(count.sum(), np.int32)
        for of, ids in parts:
            before = np.cumsum(count[of]) - count[of]
            found[np.repeat(place[of] - before, count[of]) + np.arange(len(ids))] = ids
        return found, count

    def encode_all(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has (null: none)."""
        marked = ("" if not t else self.prefix + t.replace(" ", SPACE) for t in texts)
        cut = self.words.findall if self.words is not None else lambda t: [t] if t else []
        of, held, words = numbered(map(cut, marked))
        ids, count = self._segmented(words)
        total = np.concatenate(([0], np.cumsum(count[of])))[held]
        return gathered(ids, (np.cumsum(count) - count)[of], count[of]), np.diff(total)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text (int32)."""
        return self.encode_all([text])[0]

    def decode(self, ids) -> str:
        out = b"".join(map(self.out.__getitem__, ids))
        if self.prefix and out[:1] == b" ":
            out = out[1:]
        return out.decode("utf-8", "replace")

    def decode_all(self, ids: np.ndarray, edge: np.ndarray) -> pa.Array:
        """The texts whose ids are those from one edge to the next."""
        data = gathered(self.spelling, self.begins[ids], self.sizes[ids])
        ends = np.concatenate(([0], np.cumsum(self.sizes[ids])))[edge]
        if self.prefix and len(data):  # a leading space comes from the mark that encoding put there
            first = ends[:-1][np.diff(ends) > 0]
            first = first[data[first] == 32]
            data = np.delete(data, first)
            ends = ends - np.searchsorted(first, ends)
        texts = pa.Array.from_buffers(pa.large_string(), len(edge) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:  # bytes that are no text
            return pa.array([self.decode(ids[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)], pa.large_string())
        return texts


_codecs: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _put(part: pa.RecordBatch, name: str, column: pa.Array) -> pa.RecordBatch:
    columns = [c for n, c in zip(part.schema.names, part.columns, strict=True) if n != name]
    return pa.RecordBatch.from_arrays([*columns, column], names=[*(n for n in part.schema.names if n != name), name])


def _listed(flat: np.ndarray, count: np.ndarray, texts: pa.Array) -> pa.Array:
    edge = np.concatenate(([0], np.cumsum(count))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(flat), mask=texts.is_null())


def _encoding(path: str):
    def encode(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = part.column("text")
        yield _put(part, "ids", _listed(*_codec(path).encode_all(texts.to_pylist()), texts))

    return over_slices(encode, most=SLICE)


def _checking(path: str):
    def check(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = part.column("text")
        flat, count = _codec(path).encode_all(texts.to_pylist())
        decoded = pc.if_else(texts.is_null(), None, _codec(path).decode_all(flat, np.concatenate(([0], np.cumsum(count)))))
        hashes = [None if t is None else hashlib.sha256(t).hexdigest() for t in decoded.cast(pa.large_binary()).to_pylist()]
        same = pc.equal(decoded, texts.cast(pa.large_string())).fill_null(True)
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), _listed(flat, count, texts), pa.array(hashes, pa.string()), same],
                                         names=["doc_id", "ids", "decoded_sha256", "exact"])

    return over_slices(check, most=SLICE)


def _decoding(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                ids = part.column("ids")
                count = ids.value_lengths().fill_null(0).to_numpy()
                texts = codec.decode_all(ids.flatten().to_numpy(), np.concatenate(([0], np.cumsum(count, dtype=np.int64))))
                yield _put(part, "decoded", pc.if_else(ids.is_null(), None, texts).cast(pa.string()))

    return released(decode)


def encode_pieces(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text and ids (array of int) of every row; a null text has null ids, an empty one none."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_encoding(model), "doc_id long, text string, ids array<int>")


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of encoded, with the column decoded: the text that its ids stand for (null ids: null)."""
    rest = encoded.drop("decoded")
    return rest.mapInArrow(_decoding(model), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema)
                           + ", decoded string")


def checked_pieces(documents: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, decoded_sha256 (of the text that the ids stand for) and exact (whether it is the row's) of every row.

    A null text has null ids and a null hash, and is exact.  Both ways are gone in one pass, so that texts
    go to Python once and don't come back."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return docs.mapInArrow(_checking(model), "doc_id long, ids array<int>, decoded_sha256 string, exact boolean")


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of all documents, and whether they decode to the same text."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return checked_pieces(docs, public_tokenizers.path("piece_bpe_32k.model")).select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "decoded_sha256", "exact")
