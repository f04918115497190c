"""Periodic runs of words by suffix-tree LCE queries on Lyndon roots.

A run is a longest stretch of words that repeats with a smallest period, twice at least.  Every run holds a root
that is the longest Lyndon word from its place on, in one of the two orders of the alphabet (Bannai et al., 2017).
Those words follow from the order of the suffixes: a longest Lyndon word ends where the next smaller suffix begins.
Ukkonen's algorithm builds the suffix trees of the words and of their reversal; an Euler tour over a tree and a
sparse table of its least depths answer longest common extensions in constant time, all of a text's at once.  Each
root is extended to both sides by one query on each tree.

A run of period q and at least 4q words (the kind sought here) repeats a word at distance q at most in each place
but the first q ones.  So trees are built only of zones where that holds for long enough stretches, found by arrays
for every power of two as the bound of q; no run is cut by a zone's end, and none lies outside.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorekeep.llm.common import over_slices
from scorekeep.llm.words import scan

#: A run has at least this many words, and at least this many of its periods.
LEAST_WORDS, LEAST_POWER = 6, 4
WORD = re.compile("[^\x20\x09-\x0d]+")
#: Entries of a tour that a query walks one by one; between blocks of so many a sparse table decides.
_BLOCK = 16


class SuffixTree:
    """Ukkonen's suffix tree of a sequence of integers from 1 on; 0 is put at its end and ends it."""

    def __init__(self, symbols: list[int]):
        text = [*symbols, 0]
        n = len(text)
        width = max(text) + 1
        start, stop, link, parent = [0], [0], [0], [-1]  # node v's edge is text[start[v]:stop[v]]
        child: dict[int, int] = {}  # node * width + first symbol of an edge
        node = edge = length = left = 0  # the active point, and the suffixes still to be put in
        for at in range(n):
            symbol = text[at]
            left += 1
            behind = 0
            while left:
                if not length:
                    edge = at
                key = node * width + text[edge]
                down = child.get(key)
                if down is None:
                    child[key] = len(start)
                    start.append(at)
                    stop.append(n)
                    link.append(0)
                    parent.append(node)
                    if behind:
                        link[behind] = node
                    behind = 0
                else:
                    begin = start[down]
                    size = (stop[down] if stop[down] <= at else at + 1) - begin
                    if length >= size:
                        edge += size
                        length -= size
                        node = down
                        continue
                    if text[begin + length] == symbol:
                        length += 1
                        if behind:
                            link[behind] = node
                        break
                    middle = len(start)
                    child[key] = middle
                    start += (begin, at)
                    stop += (begin + length, n)
                    link += (0, 0)
                    parent += (node, middle)
                    start[down] = begin + length
                    parent[down] = middle
                    child[middle * width + text[begin + length]] = down
                    child[middle * width + symbol] = middle + 1
                    if behind:
                        link[behind] = middle
                    behind = middle
                left -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = at - left + 1
        self.size, self.text = n, np.array(text)
        self.start, self.stop, self.parent = np.array(start), np.array(stop), np.array(parent)
        self._number()

    def _number(self) -> None:
        """Depths of all nodes, and for every leaf the suffix that it stands for."""
        up = self.parent.copy()
        up[0] = 0
        depth = self.stop - self.start
        steps = (up != np.arange(len(up))).astype(np.int64)
        total, hops = depth.copy(), steps
        while up.any():  # pointer jumping: sums over ever longer ways to the root
            total = total + np.where(up > 0, total[up], 0)
            hops = hops + np.where(up > 0, hops[up], 0)
            up = up[up]
        self.depth, self.level = total, hops
        self.leaves = np.flatnonzero(self.stop == self.size)
        self.leaves = self.leaves[self.leaves > 0]
        self.suffix = self.size - self.depth[self.leaves]

    def children_order(self, descending: bool = False) -> np.ndarray:
        """Nodes but the root by parent, then first symbol (the end of the text is least in both orders)."""
        first = self.text[self.start[1:]]
        if descending:
            first = np.where(first > 0, -first, -self.text.max() - 1)
        return 1 + np.lexsort((first, self.parent[1:]))

    def suffix_ranks(self, descending: bool = False) -> np.ndarray:
        """Rank of every suffix (the empty one first), for the order of the symbols or its reverse."""
        visits = self._preorder(self.children_order(descending))
        by_visit = np.argsort(visits[self.leaves])
        ranks = np.empty(self.size, np.int64)
        ranks[self.suffix[by_visit]] = np.arange(self.size)
        return ranks

    def _preorder(self, order: np.ndarray) -> np.ndarray:
        """Number of each node in a tour that takes children in the given order."""
        weight = self._weights()
        before = np.cumsum(weight[order]) - weight[order]  # nodes under earlier siblings
        first = np.flatnonzero(np.diff(self.parent[order], prepend=-2))
        base = np.repeat(before[first], np.diff(np.append(first, len(order))))
        step = np.zeros(len(weight), np.int64)
        step[order] = before - base + 1
        up = np.maximum(self.parent, 0)
        while up.any():
            step = step + np.where(up > 0, step[up], 0)
            up = up[up]
        return step

    def _weights(self) -> np.ndarray:
        """Number of nodes in each node's subtree, from the deepest level up."""
        weight = np.ones(len(self.parent), np.int64)
        order = np.argsort(-self.level, kind="stable")
        edge = np.flatnonzero(np.diff(self.level[order], prepend=-1))
        if len(edge) > 2000:  # long paths: node by node
            for v in order[:-1].tolist():
                weight[self.parent[v]] += weight[v]
            return weight
        for a, b in zip(edge, np.append(edge[1:], len(order)), strict=True):
            nodes = order[a:b]
            if self.level[nodes[0]]:
                np.add.at(weight, self.parent[nodes], weight[nodes])
        return weight

    def tour(self) -> None:
        """Euler tour of the tree by levels, with a sparse table over the blocks' least entries."""
        order = self.children_order()
        visit, weight = self._preorder(order), self._weights()
        nodes = len(visit)
        # node v is entered at place 2 * visit - level; its parent is met again after each child's subtree
        place = 2 * visit - self.level
        tour = np.zeros(2 * nodes - 1, np.int64)
        tour[place] = np.arange(nodes)
        inner = np.arange(1, nodes)
        tour[place[inner] + 2 * weight[inner] - 1] = self.parent[inner]
        self.place = place
        # the least level decides; level and node fit one number, so that a minimum carries the node along
        keyed = self.level[tour] * nodes + tour
        pad = -len(keyed) % _BLOCK
        self.keyed = np.concatenate((keyed, np.full(pad, np.iinfo(np.int64).max)))
        self.nodes = nodes
        rows = [self.keyed.reshape(-1, _BLOCK).min(axis=1)]
        while len(rows[-1]) > (half := 1 << (len(rows) - 1)):
            rows.append(np.minimum(rows[-1][:-half], rows[-1][half:]))
        self.blocks = rows
        self.leaf_of = np.empty(self.size, np.int64)
        self.leaf_of[self.suffix] = self.leaves

    def lce(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix of the suffixes from i and from j on (up to the text's end)."""
        a, b = self.place[self.leaf_of[i]], self.place[self.leaf_of[j]]
        a, b = np.minimum(a, b), np.maximum(a, b)
        least = np.minimum(self.keyed[a], self.keyed[b])
        first, last = a // _BLOCK + 1, b // _BLOCK  # whole blocks between
        whole = last - first
        for k in range(_BLOCK):
            least = np.minimum(least, np.where(a + k <= b, self.keyed[np.minimum(a + k, b)], least))
            least = np.minimum(least, self.keyed[np.maximum(b - k, a)])
        some = np.flatnonzero(whole > 0)
        if len(some):
            high = np.frexp(whole[some].astype(float))[1] - 1  # the greatest power of two that fits
            for h in np.unique(high):
                own = some[high == h]
                row = self.blocks[h]
                least[own] = np.minimum(least[own], np.minimum(row[first[own]], row[last[own] - (1 << h)]))
        return np.where(i == j, self.size - 1 - i, self.depth[least % self.nodes])


def next_smaller(ranks: np.ndarray) -> np.ndarray:
    """For every place the next one of a smaller rank (there is one: the empty suffix has the least)."""
    values = ranks.tolist()
    out = [0] * (len(values) - 1)
    stack: list[int] = []
    for i, r in enumerate(values):
        while stack and values[stack[-1]] > r:
            out[stack.pop()] = i
        stack.append(i)
    return np.array(out, np.int64)


def runs(symbols: np.ndarray, least_words: int = 2, least_power: int = 2) -> np.ndarray:
    """Start, length and smallest period of every run of a sequence of numbers, one a row, in order.

    least_power is 2 at least: shorter stretches are no runs."""
    n = len(symbols)
    if n < max(least_words, 2):
        return np.zeros((0, 3), np.int64)
    _, symbols = np.unique(symbols, return_inverse=True)
    symbols = (symbols + 1).tolist()
    ahead, back = SuffixTree(symbols), SuffixTree(symbols[::-1])
    ahead.tour()
    back.tour()
    found = []
    for descending in (False, True):
        i = np.arange(n)
        j = next_smaller(ahead.suffix_ranks(descending))
        period = j - i
        right = np.zeros(n, np.int64)
        inside = j < n
        right[inside] = ahead.lce(i[inside], j[inside])
        left = np.zeros(n, np.int64)
        inner = i > 0
        # suffixes of the reversal that begin where the words before i and before j stand
        left[inner] = back.lce(n - i[inner], n - j[inner])
        start, length = i - left, left + period + right
        keep = (length >= np.maximum(least_words, least_power * period)) & (length >= 2 * period)
        found.append(np.stack((start[keep], length[keep], period[keep]), axis=1))
    return np.unique(np.concatenate(found), axis=0)[:, [0, 1, 2]]


def zones(symbols: np.ndarray, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> list[tuple[int, int]]:
    """Stretches that hold all runs of least_words words and least_power periods, with the words next to them.

    In such a run of period q all places but the first q, so (least_power - 1) * q places together, have their
    word at most q places earlier."""
    n = len(symbols)
    if n < least_words:
        return []
    order = np.argsort(symbols, kind="stable")
    far = np.full(n, n + 1, np.int64)  # how far back each place's word stood last
    same = symbols[order[1:]] == symbols[order[:-1]]
    far[order[1:][same]] = (order[1:] - order[:-1])[same]
    found = []
    q = 1
    while least_power * (q // 2 + 1) <= n:  # periods from q // 2 + 1 to q
        near = np.concatenate(([False], far <= q, [False]))
        edge = np.flatnonzero(near[1:] != near[:-1])
        begin, end = edge[::2], edge[1::2]
        low = q // 2 + 1
        long = end - begin >= max((least_power - 1) * low, least_words - q)
        found += zip(np.maximum(0, begin[long] - q - 1).tolist(), np.minimum(n, end[long] + 1).tolist(), strict=True)
        q *= 2
    out: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def long_runs(symbols: np.ndarray, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER) -> np.ndarray:
    """runs() of at least so many words and periods, by trees of their zones only."""
    found = [np.zeros((0, 3), np.int64)]
    for a, b in zones(symbols, least_words, least_power):
        own = runs(symbols[a:b], least_words, least_power)
        own[:, 0] += a
        found.append(own)
    out = np.concatenate(found)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def kept_words(n: int, found: np.ndarray) -> np.ndarray:
    """Which words stay: of every run only the first period does."""
    gone = np.zeros(n + 1, np.int64)
    np.add.at(gone, found[:, 0] + found[:, 2], 1)
    np.add.at(gone, found[:, 0] + found[:, 1], -1)
    return np.cumsum(gone[:-1]) == 0


def planted(doc_id: int, n: int) -> np.ndarray:
    """Which word stands in each of n places: in a tenth of the documents, a tail repeats its beginning."""
    places = np.arange(n)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        places[a:] = a + (places[a:] - a) % p
    return places


_FOUND = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _finding(plant: bool, least_words: int, least_power: int):
    def find(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        texts = part.column("text").cast(pa.string())
        words = scan(texts)
        docs = part.column("doc_id").to_pylist()
        counts, edges, found, collapsed = [], [0], [], []
        for k, (doc, text) in enumerate(zip(docs, texts.to_pylist(), strict=True)):
            n = int(words.first[k + 1] - words.first[k])
            places = planted(doc, n) if plant and doc is not None else np.arange(n)
            changed = plant and not np.array_equal(places, np.arange(n))
            likely = words.hash[words.first[k]:words.first[k + 1]][places]
            # equal words have equal hashes, so where no zone shows there is none; the trees read the words
            spelt = WORD.findall(text or "") if n else []
            if zones(likely, least_words, least_power):
                numbers: dict[str, int] = {}
                symbols = np.array([numbers.setdefault(w, len(numbers)) for w in spelt], np.int64)[places]
                own = long_runs(symbols, least_words, least_power)
            else:
                own = np.zeros((0, 3), np.int64)
            if changed:
                spelt = [spelt[i] for i in places.tolist()]
            if len(own):
                spelt = [spelt[i] for i in np.flatnonzero(kept_words(n, own)).tolist()]
            counts.append(n)
            edges.append(edges[-1] + len(own))
            found.append(own)
            collapsed.append(" ".join(spelt))
        flat = np.concatenate([*found, np.zeros((0, 3), np.int64)])
        structs = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], names=["start", "length", "period"])
        yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "n_words": pa.array(counts, pa.int64()),
                                          "runs": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), structs),
                                          "collapsed": pa.array(collapsed, pa.string())})

    return over_slices(find)


def periodic_runs(documents: DataFrame, plant: bool = False, least_words: int = LEAST_WORDS, least_power: int = LEAST_POWER,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (by start, then period) and collapsed of every row.

    Words are runs without white space, as they are spelt; collapsed joins by spaces those that no run holds after
    its first period.  A null text counts as empty and has no words.  Every row counts, also those with null or
    repeated ids; other columns are not read; an empty table gives no rows.  plant: look for runs in texts with
    planted() repeats (none where the id is null).  Memory in a task goes with the longest zone: about 500 bytes
    a word."""
    docs = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_finding(plant, least_words, least_power), _FOUND)


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, with their planted repeats: number, the longest, digests of the list and of the kept words."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), plant=True)
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    return found.select("doc_id", listed.alias("listed"), "collapsed", F.size("runs").cast("long").alias("n_runs"), best.alias("b")).select(
        "doc_id", "n_runs", F.col("b.s").alias("start"), (-F.col("b.l")).alias("length"), F.col("b.p").alias("period"),
        F.expr("1000 * -b.l div b.p").alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))
