"""Joins and searches against brute force."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from scorekeep.llm import substring_dedup as sd
from scorekeep.llm.components import components
from scorekeep.llm.embedding_dedup import near_embeddings
from scorekeep.llm.ngram_jaccard import Bands, ngram_jaccard_join
from tests.llm.conftest import words


def _shingles(text, n):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) or frozenset([tuple(w)] if w else [])


def _components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_ngram_join_is_exact(spark, docs_of):
    r, rows = random.Random(4), []
    for family in range(12):
        base = words(family, r.choice([1, 2, 4, 11, 30, 60, 200]))
        for _ in range(r.choice([1, 4, 12])):
            w = list(base)
            for _ in range(r.randrange(2 + len(w) // 30)):
                w[r.randrange(len(w))] = f"x{r.randrange(9999)}"
            rows.append((len(rows) * 3 % 1009, " ".join(w)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "A b"), (2004, "a B"), (2005, "z" * 60_000)]
    got = {x.doc_id: x for x in ngram_jaccard_join(docs_of([*rows, (None, "lost")]), 3, 90).collect()}
    assert got.pop(None).component_id is None and len(got) == len(rows)
    sets = {i: _shingles(t, 3) for i, t in rows}
    near = lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b])
    expected = _components(sorted(sets), near)
    assert {i: x.component_id for i, x in got.items()} == expected
    assert {i: x.n_shingles for i, x in got.items()} == {i: len(s) for i, s in sets.items()}


def test_ngram_join_of_nothing(docs_of):
    assert ngram_jaccard_join(docs_of([])).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 400), st.integers(0, 10**6), st.sampled_from([80, 90]))
def test_similar_sets_share_a_signature(size, seed, percent):
    r = np.random.default_rng(seed)
    a = r.integers(0, 2**63, size).astype(np.uint64)
    k = (100 - percent) * size // percent // 2
    b = np.concatenate((a[: size - k], r.integers(0, 2**63, k).astype(np.uint64)))
    a, b = np.unique(a), np.unique(b)
    shared = len(np.intersect1d(a, b))
    bands = Bands(percent)
    if 100 * shared >= percent * (len(a) + len(b) - shared):
        assert len(np.intersect1d(bands.signatures(a), bands.signatures(b)))


def test_components_of_chains(spark, monkeypatch):
    import scorekeep.llm.components as c
    monkeypatch.setattr(c, "BLOCK", 40)
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(100)] + [(r.randrange(200, 400), r.randrange(200, 400)) for _ in range(120)]
    got = {x.node: x.component for x in components(spark.createDataFrame([*edges, (7, 7), (None, 3)], "x long, y long"), "x", "y").collect()}
    nodes = sorted({n for e in edges for n in e if e[0] != e[1]})
    both = {e for a, b in edges for e in ((a, b), (b, a))}
    assert got == _components(nodes, lambda a, b: (a, b) in both)


def test_embeddings_against_brute_force(spark):
    r = np.random.default_rng(3)
    rows = []
    for label in (1, 1, 2, None):
        base = r.normal(size=(20, 24))
        for v in base:
            for _ in range(r.integers(1, 6)):
                rows.append((len(rows), (v + r.normal(size=24) * 0.11).astype(float).tolist(), label))
    rows += [(1000 + i, rows[0][1], rows[0][2]) for i in range(5)]
    rows += [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 24, 1), (2003, [float("nan")] * 24, 1), (2004, [None] * 24, 1),
             (2005, [float("inf")] * 24, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1), (None, rows[0][1], 1), (2007, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x.vec_id: x for x in near_embeddings(df).collect()}
    good = {i: (np.array(v), y) for i, v, y in rows if i is not None and y is not None and v and None not in v
            and np.isfinite(v).all() and any(v)}

    def near(a, b):
        (x, i), (y, j) = good[a], good[b]
        return i == j and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98

    expected = _components(sorted(good), near)
    links = {i: sum(near(i, j) for j in good if j != i) for i in good}
    assert sum(links.values()) > 50
    found = sum(got[i].n_links for i in good)
    assert 0.97 * sum(links.values()) <= found <= sum(links.values())
    assert all(got[i].n_links <= links[i] for i in good)
    assert sum(got[i].component_id != expected[i] for i in good) <= 2
    assert all(got[i].n_links == 0 and got[i].component_id == i and got[i].kept for i in range(2000, 2006))
    assert got[None].component_id is None and not got[None].kept
    assert got[2007].component_id == 2006 and got[2006].n_links == 1
    assert near_embeddings(df.where("false")).collect() == []


def _plain_spans(rows):
    """Substring dedup without hash cuts, word by word."""
    seen, out = {}, {}
    for i, text in sorted(rows):
        found = [(m.group(), m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0d]+", text)]
        sentences, now = [], []
        for k, (w, a, b) in enumerate(found):
            now.append((w.lower(), a))
            if re.search(r"[.!?][^A-Za-z0-9]*$", w) or (k + 1 < len(found) and "\n" in text[b:found[k + 1][1]]):
                sentences.append(now)
                now = []
        sentences += [now] if now else []
        cover, own = [False] * len(sentences), []
        for a in range(len(sentences)):
            b = n = 0
            for b in range(a, len(sentences)):
                n += len(sentences[b])
                if b - a + 1 >= sd.SENTENCES and n >= sd.WORDS:
                    own.append((tuple(w for s in sentences[a:b + 1] for w, _ in s), a, b + 1))
                    break
        for key, a, b in own:
            if key in seen:
                cover[a:b] = [True] * (b - a)
            seen.setdefault(key, i)
        cut = [s[0][1] for s in sentences] + [len(text)]
        cut[0] = 0
        out[i] = "".join(text[cut[j]:cut[j + 1]] for j in range(len(sentences)) if not cover[j]) if any(cover) else text
    return out


def test_substring_dedup_against_plain(docs_of):
    r, rows = random.Random(9), []
    passage = " ".join(" ".join(words(s, 7)).capitalize() + "." for s in range(9))
    for i in range(30):
        own = [" ".join(words(100 + i * 20 + s, r.randrange(1, 9))) + r.choice([".", "!", "?!", "\n"]) for s in range(12)]
        if i % 3 == 0:
            own.insert(r.randrange(12), passage)
        rows.append((i, " ".join(own)))
    rows += [(40, rows[0][1]), (41, "One. Two. Three. "), (42, "Ä b.\n" * 30), (43, "x " * 30_000), (44, "."), (45, " ")]
    got = {x.doc_id: x for x in sd.substring_dedup(docs_of([*rows, (50, None), (51, ""), (None, passage)]), long_words=10**9).collect()}
    expected = _plain_spans(rows)
    assert {i: got[i].text for i in expected} == expected
    assert got[40].text == "" and sum(passage[60:200] in x.text for x in got.values() if x.doc_id is not None and x.text) == 1
    assert got[50].text is None and got[51].text == "" and got[None].text == passage


def test_passages_in_long_sentences_are_found(docs_of):
    passage = " ".join(words(77, 160))
    rows = [(i, " ".join(words(i, 30)) + " " + passage + " " + " ".join(words(50 + i, 30))) for i in range(3)]
    got = {x.doc_id: x for x in sd.substring_dedup(docs_of(rows)).collect()}
    assert got[0].n_removed == 0 and all(got[i].n_removed > 3 and words(77, 160)[80] not in got[i].text.split() for i in (1, 2))
    assert sd.substring_dedup(docs_of([])).collect() == []
