"""Byte-level BPE encoding and decoding by dynamic programming over byte prefixes.

Merging the bytes of a string leaves one sequence of tokens, and the tokens of a prefix of it are those of a
shorter prefix and one token more.  So a table with the last token of every prefix holds the encodings of all
prefixes.  A token is the last one of a prefix if it is a suffix of it, its own bytes merge into it, and it stays
apart from the last token of the prefix before it; exactly one is.  An Aho-Corasick automaton names the suffixes.

Appending bytes adds entries and changes none.  After an edit inside, the entries before it stand, and as soon as
as many entries as the longest token has bytes equal those of the old text, all later ones do.

As in the library, a match of the pattern that is a token itself is not merged, and the classes of the pattern are
those of the library's own engine, whose Unicode version may differ from Python's.
"""

from __future__ import annotations

import base64
import bisect
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import Remembered, over_slices
from scorekeep.llm.words import BASE, U, mix, powers

#: Bytes of memory for remembered words, and places for remembered pairs of tokens, in each Python worker.
WORD_BYTES = 100_000_000
PAIRS = 1 << 22
#: Words of up to so many bytes get their tables together, position by position.
LEVELS = 48
#: How far past its end the pattern looks to end a match: "'r" may become "'re".
LOOKAHEAD = 2
CLASSES = (r"\p{L}", r"\p{N}", r"\s")
_ASTRAL = re.compile("[\U00010000-\U0010ffff]")


def all_characters() -> str:
    return "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))


def library_matches(pattern: str) -> set[str]:
    """Characters that match a class in the library's regular expressions."""
    import tiktoken

    single = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    return set(bytes(single.encode_ordinary(all_characters())).decode())


def explicit_classes(pattern: str, classes: dict[str, set[str]]) -> str:
    """The pattern with the classes written as ranges of characters, for the re module."""
    out = pattern.replace(r"\S", r"[^\s]")
    for name, members in classes.items():
        codes = np.array(sorted(map(ord, members)))
        starts = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
        stops = np.append(starts[1:], len(codes)) - 1
        ranges = "".join(f"\\U{codes[a]:08x}-\\U{codes[b]:08x}" for a, b in zip(starts, stops, strict=True))
        # inside a class the ranges stand alone, outside they need brackets
        out = re.sub(r"\[[^\]]*\]", lambda m, n=name, r=ranges: m[0].replace(n, r), out).replace(name, f"[{ranges}]")
    return out


def rank_file(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Kept(dict):
    """make(key) of every key asked for; for keys that are tokens of one vocabulary."""

    def __init__(self, make: Callable):
        self.make = make

    def __missing__(self, key):
        self[key] = out = self.make(key)
        return out


class PrefixCodec:
    """Encodes and decodes by the ranks of a vocabulary that has every single byte.

    Byte strings are held as Latin-1 text, which the automaton reads."""

    def __init__(self, ranks: dict[bytes, int], pattern: str | None = None, whole_matches: bool = True,
                 matches: Callable[[str], set[str]] = library_matches):
        import ahocorasick

        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.spelt = {rank: token for token, rank in self.ranks.items()}
        self.longest = max(map(len, self.ranks))
        self.whole_matches = whole_matches
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token, (rank, len(token)))
        self.automaton.make_automaton()
        classes = {name: matches(name) for name in CLASSES} if pattern else {}
        self.find = re.compile(explicit_classes(pattern, classes) if pattern else r"(?s:.+)")
        # the same matches in a text of the Basic Multilingual Plane, where the shorter classes are found faster
        self.find_plain = re.compile(explicit_classes(pattern, {n: {c for c in m if c < "\U00010000"} for n, m in classes.items()})
                                     if pattern else r"(?s:.+)")
        self.splits = Kept(self._split)
        self.pairs = np.full(PAIRS, -1, np.int64)  # by the pair's hash: the pair, and whether it stays apart
        self.pairs_apart = np.zeros(PAIRS, bool)
        self.words = Remembered(lambda word: np.array(self.encode_bytes(word.encode("utf-8", "replace")), np.int32).tobytes(), WORD_BYTES)
        size = max(self.spelt) + 1
        self.sizes = np.zeros(size, np.int64)
        for rank, token in self.spelt.items():
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.names = np.fromiter(self.spelt, np.int64, len(self.spelt))
        spelt = [np.frombuffer(self.spelt[r].encode("latin-1"), np.uint8) for r in self.names]
        hashed = np.array([((t.astype(U) + U(1)) * powers(self.longest + 1)[: len(t)]).sum() for t in spelt], U)
        order = np.argsort(hashed)
        self.names, self.hashes = self.names[order], hashed[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes >> U(44)] = True
        self.bytes = np.frombuffer("".join(self.spelt.get(r, "") for r in range(size)).encode("latin-1"), np.uint8)

    def _split(self, token: int) -> tuple[int, int] | bool | None:
        """The two tokens whose merge makes this one last; None for a byte, False if merging its bytes doesn't end in it."""
        parts, last = list(self.spelt[token]), None
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, np.inf), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))  # noqa: B905
            if rank == np.inf:
                return False
            last = self.ranks[parts[at]], self.ranks[parts[at + 1]]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return last

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether a and b, each merged from its own bytes, stay two tokens where they meet.

        Undoes their merges from the latest on: had the tokens at the border been one token of a lower rank
        than the next merge, that would have come first."""
        splits, spelt, rank = self.splits, self.spelt, self.ranks.get
        left, right, limit = splits[a], splits[b], len(self.sizes)
        if right is False:
            return False
        while rank(spelt[a] + spelt[b], limit) >= limit:
            if left and (not right or a > b):
                limit, a = a, left[1]
                left = splits[a]
            elif right:
                limit, b = b + 1, right[0]  # of equal ranks the left one is merged first
                right = splits[b]
            else:
                return True
        return False

    def apart(self, pair: int) -> bool:
        """_stay_apart of a pair of tokens (the first in the upper half), remembered."""
        at = hash(pair * 0x9E3779B1) % PAIRS
        if self.pairs[at] != pair:
            self.pairs[at], self.pairs_apart[at] = pair, self._stay_apart(pair >> 32, pair & 0xFFFFFFFF)
        return bool(self.pairs_apart[at])

    def all_apart(self, pairs: np.ndarray) -> np.ndarray:
        at = (mix(pairs.astype(U)) >> U(8)).astype(np.int64) % PAIRS
        out = self.pairs_apart[at]
        if len(new := np.flatnonzero(self.pairs[at] != pairs)):
            own, where = np.unique(pairs[new], return_inverse=True)
            found = np.array([self._stay_apart(x >> 32, x & 0xFFFFFFFF) for x in own.tolist()], bool)
            out[new] = found[where]
            # of pairs with one place, both halves of the last one written are kept
            at = at[new]
            _, once = np.unique(at, return_index=True)
            self.pairs[at[once]], self.pairs_apart[at[once]] = pairs[new][once], out[new][once]
        return out

    def _suffixes(self, data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends and tokens of all tokens inside words; place: each byte's number in its word."""
        shift, back = powers(LEVELS + 1), powers(LEVELS + 1, pow(BASE, -1, 1 << 64))
        total = np.concatenate((np.zeros(1, U), np.cumsum((data.astype(U) + U(1)) * shift[place])))
        ends, tokens = [], []
        at = np.arange(len(data))  # last bytes of substrings that lie in one word
        for size in range(1, self.longest + 1):
            at = at[place[at] >= size - 1]
            if not len(at):
                break
            hashed = (total[at + 1] - total[at + 1 - size]) * back[place[at + 1 - size]]
            likely = np.flatnonzero(self.maybe[hashed >> U(44)])
            i = np.minimum(np.searchsorted(self.hashes, hashed[likely]), len(self.hashes) - 1)
            is_token = self.hashes[i] == hashed[likely]
            token = self.names[i[is_token]]
            own = at[likely[is_token]]
            own, token = own[self.sizes[token] == size], token[self.sizes[token] == size]
            ends.append(own)
            tokens.append(token)
        return np.concatenate(ends), np.concatenate(tokens)

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Tokens of many matches (int32), by their tables, all filled position by position."""
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= LEVELS), key=lambda i: -len(words[i]))
        out = [b"" if 0 < len(w) <= LEVELS else np.array(self.encode_bytes(w), np.int32).tobytes() for w in words]
        if not order:
            return out
        size = np.array([len(words[i]) for i in order])
        data = np.frombuffer(b"".join([words[i] for i in order]), np.uint8)
        first = np.cumsum(size) - size
        place = np.arange(len(data)) - np.repeat(first, size)
        ends, tokens = self._suffixes(data, place)
        by_place = np.argsort(place[ends], kind="stable")
        ends, tokens = ends[by_place], tokens[by_place]
        edge = np.searchsorted(place[ends], np.arange(int(size[0]) + 1))
        last = np.full(len(data), -1, np.int64)
        whole = np.full(len(data), -1, np.int64)  # by a word's last byte: the token that is the word
        for level in range(int(size[0])):
            at, token = ends[edge[level]:edge[level + 1]], tokens[edge[level]:edge[level + 1]]
            inner = self.sizes[token] <= level
            own, add = at[inner], token[inner]
            ok = self.all_apart(last[own - self.sizes[add]] << 32 | add)
            last[own[ok]] = add[ok]
            own, add = at[~inner], token[~inner]
            proper = np.array([self.splits[t] is not False for t in add.tolist()], bool) if len(add) else np.zeros(0, bool)
            last[own[proper]] = add[proper]
            whole[own] = add
        if self.whole_matches:
            tail = first + size - 1
            last[tail] = np.where(whole[tail] >= 0, whole[tail], last[tail])
        found, who = [], []
        rows, at = np.arange(len(order)), first + size - 1
        while len(rows):
            token = last[at]
            found.append(token)
            who.append(rows)
            at = at - self.sizes[token]
            more = at >= first[rows]
            rows, at = rows[more], at[more]
        who_all = np.concatenate(who[::-1])
        ids = np.concatenate(found[::-1])[np.argsort(who_all, kind="stable")].astype(np.int32)
        if not np.array_equal(self.decode(ids), data):
            return [np.array(self.encode_bytes(w), np.int32).tobytes() for w in words]  # two strings had one hash
        flat, cut = ids.tobytes(), 4 * np.concatenate(([0], np.cumsum(np.bincount(who_all, minlength=len(order)))))
        for k, i in enumerate(order):
            out[i] = flat[cut[k]:cut[k + 1]]
        return out

    def table(self, data: str, begun: list[int] | None = None, old: list[int] | None = None, shift: int = 0, same_from: int = 0) -> list[int]:
        """The last token of every prefix of data (entry i: of its first i bytes; entry 0: -1).

        begun: entries that are known.  old, shift: a table whose bytes from same_from on are those of data from
        same_from + shift on; once enough entries agree, the rest is taken from it."""
        last = list(begun or [-1])
        known, agreed = len(last) - 1, 0
        last += [-1] * (len(data) - known)
        for end, (token, size) in self.automaton.iter(data, max(0, known + 1 - self.longest)):
            at = end + 1
            if last[at] >= 0:
                continue
            if (before := last[at - size]) >= 0:
                if not self.apart(before << 32 | token):
                    continue
            elif self.splits[token] is False:
                continue
            last[at] = token
            if old is not None and at - shift > same_from:
                agreed = agreed + 1 if old[at - shift] == token else 0
                if agreed >= self.longest and at - shift >= same_from + self.longest:
                    last[at + 1:] = old[at - shift + 1:]
                    break
        return last

    def trace(self, data: str, last: list[int]) -> list[int]:
        """The tokens of the whole of data, by its table."""
        if self.whole_matches and data in self.ranks:
            return [self.ranks[data]]
        found, at = [], len(data)
        while at:
            found.append(last[at])
            at -= len(self.spelt[last[at]])
        return found[::-1]

    def encode_bytes(self, data: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        spelt = data.decode("latin-1")
        if self.whole_matches and spelt in self.ranks:
            return [self.ranks[spelt]]
        return self.trace(spelt, self.table(spelt))

    def matches(self, text: str) -> list[str]:
        """The matches of the pattern, which are encoded one by one."""
        return (self.find_plain if text.isascii() or not _ASTRAL.search(text) else self.find).findall(text)

    def encode(self, text: str) -> np.ndarray:
        """Tokens of a text (int32)."""
        return self.encode_texts([text])[0]

    def encode_texts(self, texts: list[str]) -> list[np.ndarray]:
        """Tokens of every text (int32); each distinct match is encoded once."""
        matches = [self.matches(t) for t in texts]
        pick, new, again = {}, [], []
        for w in set().union(*matches):
            if (ids := self.words.get(w)) is None:
                ids = self.words.older.get(w)
                (new if ids is None else again).append(w)
            pick[w] = ids
        pick |= zip(new, self.encode_words([w.encode("utf-8", "replace") for w in new]), strict=True)
        for w in again + new:
            self.words.put(w, pick[w])
        return [np.frombuffer(b"".join(map(pick.__getitem__, m)), np.int32) for m in matches]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids, one after the other (uint8)."""
        sizes = self.sizes[ids]
        return self.bytes[np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]


class EditableText:
    """A text with the tables of its matches: appends and edits redo only what they change.

    The ids are at all times those of encoding the whole text anew."""

    def __init__(self, codec: PrefixCodec, text: str = ""):
        self.codec, self.text = codec, ""
        self.edges: list[int] = [0]  # match k is text[edges[k]:edges[k + 1]]
        self.tables: list[list[int]] = []
        self.replace(0, 0, text)

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, stop: int, new: str) -> None:
        """Put new in the place of text[start:stop]."""
        if not 0 <= start <= stop <= len(self.text):
            raise ValueError("start and stop must lie in the text, in order")
        old_text, old_edges, old_tables = self.text, self.edges, self.tables
        grown = len(new) - (stop - start)
        self.text = old_text[:start] + new + old_text[stop:]
        kept = max(0, bisect.bisect_right(old_edges, start - LOOKAHEAD) - 1)
        edges, tables = old_edges[:kept + 1], old_tables[:kept]
        for match in self.codec.find.finditer(self.text, edges[-1]):
            begin = match.start()
            if begin != edges[-1]:
                raise ValueError("the pattern leaves characters out; only patterns that cover every text can be edited")
            same = bisect.bisect_left(old_edges, begin - grown)
            if begin >= start + len(new) and same < len(old_edges) and old_edges[same] == begin - grown:
                edges += [e + grown for e in old_edges[same + 1:]]  # from a common edge on, matches are the same
                tables += old_tables[same:]
                break
            tables.append(self._table(match, old_text, old_edges, old_tables, start, stop, grown))
            edges.append(match.end())
        self.edges, self.tables = edges, tables

    def _table(self, match: re.Match, old_text: str, old_edges: list[int], old_tables: list[list[int]],
               start: int, stop: int, grown: int) -> list[int]:
        """The table of a match, with what it shares with the old match that began or ended at its place."""
        data = match[0].encode("utf-8", "replace").decode("latin-1")
        begin, k = match.start(), bisect.bisect_left(old_edges, match.start())
        if begin <= start and k < len(old_tables) and old_edges[k] == begin:  # same bytes up to the edit
            common = len(self.text[begin:min(start, match.end())].encode("utf-8", "replace"))
            begun = old_tables[k][:common + 1]
            if match.end() == old_edges[k + 1] + grown and stop <= old_edges[k + 1]:  # and after it
                tail = len(old_text[stop:old_edges[k + 1]].encode("utf-8", "replace"))
                size = len(old_tables[k]) - 1
                return self.codec.table(data, begun, old_tables[k], len(data) - size, size - tail)
            return self.codec.table(data, begun)
        return self.codec.table(data)

    def ids(self) -> list[int]:
        out = []
        for a, b, last in zip(self.edges, self.edges[1:], self.tables, strict=False):
            out += self.codec.trace(self.text[a:b].encode("utf-8", "replace").decode("latin-1"), last)
        return out


_codecs: dict[tuple[str, str], PrefixCodec] = {}


def codec_of(path: str, pattern: str) -> PrefixCodec:
    """The codec of a rank file; its tables stay with the Python worker."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = PrefixCodec(rank_file(path), pattern)
    return _codecs[path, pattern]


def _lists(found: list[np.ndarray]) -> pa.ListArray:
    edge = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edge), pa.array(np.concatenate([*found, np.zeros(0, np.int32)])))


def _decoded(codec: PrefixCodec, found: list[np.ndarray]) -> pa.Array:
    ids = np.concatenate([*found, np.zeros(0, np.int32)])
    to = np.concatenate(([0], np.cumsum(codec.sizes[ids])))[np.concatenate(([0], np.cumsum([len(f) for f in found])))]
    return pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(codec.decode(ids))])


def encode_documents(documents: DataFrame, ranks: str, pattern: str, decoded: bool = False, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every row; with decoded, also the bytes that the ids decode to.

    A null text counts as empty and has no ids.  Every row counts, also those with null or repeated ids; other
    columns are not read.  An empty table gives no rows."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def encode(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, pattern)
        found = codec.encode_texts([t or "" for t in part.column("text").to_pylist()])
        columns = {"doc_id": part.column("doc_id"), "ids": _lists(found)}
        if decoded:
            columns["decoded"] = _decoded(codec, found)
        yield pa.RecordBatch.from_pydict(columns)

    return docs.mapInArrow(over_slices(encode), "doc_id long, ids array<int>" + (", decoded binary" if decoded else ""))


def decode_documents(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id and decoded (the bytes of ids) of every row; null ids count as none."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, pattern)
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                found = [np.asarray(i or (), np.int32) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "decoded": _decoded(codec, found)})

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        decode, "doc_id long, decoded binary")


def edited_documents(edits: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """doc_id, text and ids after an edit of every row of edits: doc_id, text, start, stop (code points) and new.

    Null or outside places are moved to the nearest place in the text; null texts count as empty.  Only the
    matches near the edit are encoded anew."""

    def edit(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks, pattern)
        texts, found = [], []
        for row in part.to_pylist():
            own = EditableText(codec, row["text"] or "")
            start = min(max(row["start"] or 0, 0), len(own.text))
            own.replace(start, min(max(row["stop"] or 0, start), len(own.text)), row["new"] or "")
            texts.append(own.text)
            found.append(np.array(own.ids(), np.int32))
        yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "text": pa.array(texts, pa.string()), "ids": _lists(found)})

    rows = edits.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("start").cast("int").alias("start"), F.col("stop").cast("int").alias("stop"),
                        F.col("new").cast("string").alias("new"))
    return rows.mapInArrow(over_slices(edit), "doc_id long, text string, ids array<int>")


def op13_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Number and digests of the ids of every document, and of the bytes that they decode to."""
    import public_tokenizers

    coded = encode_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))
