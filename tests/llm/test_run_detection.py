"""Runs against brute force, on sequences, tables and the query."""

import hashlib
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from scorekeep.llm.run_detection import SuffixTree, kept_words, long_runs, op12_periodic_runs, periodic_runs, runs, zones
from tests.conftest import SF_SMALL


def plain_runs(words, least=2, power=2):
    """For every period, the maximal stretches that keep it; those with a smaller period are no runs of it."""
    n, found = len(words), set()
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            s = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            length = i + p - s
            part = words[s:s + length]
            if i > s and length >= max(2 * p, least, power * p) and not any(part[q:] == part[:-q] for q in range(1, p)):
                found.add((s, length, p))
            i += 1
    return sorted(found)


def plain_row(doc, text):
    words = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(words), zlib.crc32(str(doc).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = plain_runs(words, 6, 4)
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc, len(found), *best, 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{ln},{q}\n" for s, ln, q in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


SEQUENCES = st.one_of(
    st.lists(st.integers(0, 3), max_size=40),
    st.tuples(st.lists(st.integers(0, 5), max_size=9), st.lists(st.integers(0, 5), min_size=1, max_size=6), st.integers(1, 9),
              st.lists(st.integers(0, 5), max_size=9)).map(lambda t: t[0] + t[1] * t[2] + t[3]))


@settings(max_examples=400, deadline=None)
@given(SEQUENCES)
def test_runs_as_brute_force(words):
    assert [tuple(r) for r in runs(np.array(words, np.int64)).tolist()] == plain_runs(words)
    assert [tuple(r) for r in long_runs(np.array(words, np.int64)).tolist()] == plain_runs(words, 6, 4)


@settings(max_examples=150, deadline=None)
@given(SEQUENCES.filter(len))
def test_tree_answers_as_brute_force(words):
    tree = SuffixTree([w + 1 for w in words])
    tree.tour()
    n = len(words)
    suffixes = [words[i:] for i in range(n + 1)]
    ranks = tree.suffix_ranks().tolist()
    assert sorted(range(n + 1), key=suffixes.__getitem__) == sorted(range(n + 1), key=ranks.__getitem__)
    ranks = tree.suffix_ranks(descending=True).tolist()
    assert sorted(range(n + 1), key=lambda i: [-w for w in suffixes[i]]) == sorted(range(n + 1), key=ranks.__getitem__)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(n), np.arange(n)))
    for a, b, got in zip(i, j, tree.lce(i, j), strict=True):
        k = 0
        while max(a, b) + k < n and words[a + k] == words[b + k]:
            k += 1
        assert got == k


def test_zones_hold_runs_with_their_neighbours():
    words = np.arange(3000)
    words[1000:1400] = 1000 + np.arange(400) % 90
    (a, b), = zones(words)
    assert a <= 999 and b >= 1401 and b - a < 800
    assert long_runs(words).tolist() == [[1000, 400, 90]]
    assert kept_words(3000, long_runs(words)).sum() == 3000 - 310


def test_tables(spark, docs_of):
    rows = [(1, "a b " * 20), (2, None), (3, ""), (None, "x x x x x x y"), (1, "a b " * 20), (4, "tail " * 60_000), (5, "A a A a A a a"),
            (6, "\x1c  \t " * 9)]
    got = {(r["doc_id"], r["n_words"], tuple(map(tuple, r["runs"])), r["collapsed"]) for r in periodic_runs(docs_of(rows)).collect()}
    assert got == {(1, 40, ((0, 40, 2),), "a b"), (2, 0, (), ""), (3, 0, (), ""), (None, 7, ((0, 6, 1),), "x y"),
                   (4, 60_000, ((0, 60_000, 1),), "tail"), (5, 7, (), "A a A a A a a"), (6, 9, ((0, 9, 1),), "\x1c ")}
    assert periodic_runs(docs_of(rows)).count() == len(rows)
    assert periodic_runs(docs_of(rows).where("false")).count() == 0


def test_query_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = op12_periodic_runs(spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert [t for _, t in got.dtypes] == ["bigint"] * 6 + ["string"] * 2
    short = [i for i, t in texts.items() if len(t or "") < 6000]
    assert len(short) > 50
    rows = {r["doc_id"]: tuple(r) for r in got.collect()}
    assert len(rows) == len(texts) and sum(r[1] > 0 for r in rows.values()) > 0
    for i in short:
        assert rows[i] == plain_row(i, texts[i])
