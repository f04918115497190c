"""Word and shingle hashes of a batch of texts, as numpy arrays over its bytes.

A word is a run without the bytes 0x20 and 0x09-0x0D; A-Z counts as a-z.  A word's hash is a polynomial of
its bytes modulo 2**64, mixed with its length, so that it depends on nothing but the word.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
_tables: dict[int, np.ndarray] = {}


def powers(n: int, base: int = BASE) -> np.ndarray:
    """1, base, base**2, ... modulo 2**64 (n of them at least)."""
    if len(_tables.get(base, ())) < n:
        steps = np.full(1 << int(n - 1).bit_length(), base, U)
        steps[0] = U(1)
        _tables[base] = np.multiply.accumulate(steps)
    return _tables[base]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@dataclass
class Words:
    """Words of several texts, in order: text i has the words first[i] to first[i + 1]."""

    data: np.ndarray  # all bytes, A-Z lower-cased
    edge: np.ndarray  # text i has the bytes edge[i] to edge[i + 1]
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins and ends (null: empty)."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    n = len(texts)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edge = np.frombuffer(texts.buffers()[1], np.int64, n + 1, texts.offset * 8)
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[edge[0]:edge[-1]], edge - edge[0]


def scan(texts: pa.Array) -> Words:
    data, edge = raw_bytes(texts)
    data = data + (((data >= 65) & (data <= 90)) * np.uint8(32)).astype(np.uint8)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    cut = np.zeros(len(data) + 1, bool)
    cut[edge] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    start = np.flatnonzero(inside & (cut[:-1] | ~before))
    end = np.flatnonzero(inside & (cut[1:] | ~after)) + 1
    size = end - start
    if len(start):
        at = np.flatnonzero(inside)
        begins = np.cumsum(size) - size
        in_word = np.arange(len(at)) - np.repeat(begins, size)
        terms = (data[at].astype(U) + U(1)) * powers(int(size.max()) + 1)[in_word]
        hashed = mix(np.add.reduceat(terms, begins) + size.astype(U) * U(0xD6E8FEB86659FD93))
    else:
        hashed = np.zeros(0, U)
    return Words(data, edge, start, end, hashed, np.searchsorted(start, edge))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles, in order, and the first of each text; a text of fewer words (but one
    at least) has its whole sequence as its only shingle."""
    count = np.diff(words.first)
    many = np.where(count >= n, count - n + 1, (count > 0).astype(count.dtype))
    first = np.concatenate(([0], np.cumsum(many)))
    begins = np.repeat(words.first[:-1] - first[:-1], many) + np.arange(first[-1])
    length = np.repeat(np.minimum(count, n), many)
    total = length.astype(U) * U(0xA24BAED4963EE407)
    for j in range(n):
        at = begins[length > j] + j
        total[length > j] += mix(words.hash[at] + U(j + 1)) * powers(n + 2)[j + 1]
    return mix(total), first
