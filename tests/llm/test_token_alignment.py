"""Matrix products and alignments against brute force and the libraries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from scorekeep.llm import token_alignment
from scorekeep.llm.token_alignment import Aligned, Csr, Pair, aligned_tokens, alignment_counts, op11_cross_tokenizer, packed, unpacked
from tests.conftest import SF_SMALL

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN
ODD = "aab'rsl  \n\t  \x1c eéßñ中文字日本🙂՘⾡ةع1२Ⅷ.,;-=𝔘<s>▁\x00"


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


@pytest.fixture(scope="module")
def pair():
    return Pair(*PATHS)


def plain(libraries, text):
    """Ids, groups and links of one text: two pointers over the tokens' bytes as the libraries give them."""
    first, second = libraries
    text = text or ""
    data = (" " + text).encode()
    byte_of = {c: b for b, c in byte_letters().items()}
    a = first.encode(" " + text, add_special_tokens=False).ids if text else []
    b = second.encode(text) if text else []
    spelt_a = [bytes(byte_of[c] for c in first.id_to_token(i)) for i in a]
    spelt_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
    if b"".join(spelt_a) != data or b"".join(spelt_b) != data:
        return [], [], [], []
    spans = [[], []]
    for out, spelt in zip(spans, (spelt_a, spelt_b), strict=True):
        at = 0
        for s in spelt:
            out.append((at, at + len(s)))
            at += len(s)
    links, groups, i, j, now = [], [], 0, 0, ([], [])
    while i < len(a) and j < len(b):
        (x, x_end), (y, y_end) = spans[0][i], spans[1][j]
        links.append((i, j, min(x_end, y_end) - max(x, y)))
        if x_end <= y_end:
            now[0].append(i)
            i += 1
        if y_end <= x_end:
            now[1].append(j)
            j += 1
        if x_end == y_end:
            groups.append(now)
            now = ([], [])
    return a, b, links, groups


def byte_letters():
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printed]
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(rest)}


def spelt(a, b, groups):
    return ";".join(",".join(str(a[i]) for i in x) + "|" + ",".join(str(b[j]) for j in y) for x, y in groups)


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 7), st.integers(1, 6), st.integers(1, 7))
def test_products_as_dense_matrices(seed, n, m, k):
    r = np.random.default_rng(seed)
    x, y = r.integers(0, 3, (n, m)), r.integers(0, 3, (m, k))

    def sparse(d):
        i, j = np.nonzero(d)
        return Csr(np.concatenate(([0], np.cumsum(np.bincount(i, minlength=len(d))))).astype(int), j, d.shape[1], d[i, j])

    def dense(s):
        out = np.zeros((len(s.indptr) - 1, s.width), int)
        out[s.rows(), s.indices] = s.data
        return out

    assert (dense(sparse(x).transposed()) == x.T).all()
    assert (dense(sparse(x).times(sparse(y))) == x @ y).all()


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(ODD, max_size=40), max_size=4))
def test_alignments_as_brute_force(libraries, pair, texts):
    own = pair.align(texts)
    a, b, size = own.overlaps()
    shared = set(zip(*(x.tolist() for x in own.shared_groups()), strict=True))
    digests = own.spelt_groups()
    for t, text in enumerate(texts):
        ids_a, ids_b, links, groups = plain(libraries, text)
        low, high, low_b, high_b = *own.a_edge[t:t + 2], *own.b_edge[t:t + 2]
        assert own.a[low:high].tolist() == ids_a and own.b[low_b:high_b].tolist() == ids_b
        here = (a >= low) & (a < high)
        assert list(zip(a[here] - low, b[here] - low_b, size[here], strict=True)) == links
        assert {(i - low, j - low_b) for i, j in shared if low <= i < high} == {(i, j) for x, y in groups for i in x for j in y}
        assert own.group_edge[t + 1] - own.group_edge[t] == len(groups)
        assert digests[t].decode() == spelt(ids_a, ids_b, groups)


def test_long_texts_go_in_parts(libraries, pair, monkeypatch):
    text = "words and a few more, nächste Zeile\n" * 3000
    whole = pair.align([text, "x", text])
    before = whole.overlaps()
    monkeypatch.setattr(token_alignment, "PART_BYTES", 777)
    again = pair.align([text, "x", text])
    assert all((x == y).all() for x, y in zip(before, again.overlaps(), strict=True))
    assert isinstance(whole, Aligned) and len(before[0]) >= len(whole.a)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1 << 40)))
def test_packed_numbers(values):
    data, size = packed(np.array(values, np.int64))
    assert unpacked(data).tolist() == values and size.sum() == len(data)


ROWS = [(1, "the cat and the dog"), (2, None), (3, ""), (None, "the cat"), (1, "the cat and the dog"), (4, "▁ not kept"),
        (5, "中文 <|endoftext|> <s> the"), (6, "the old " * 20_000)]


def expected(libraries, rows):
    found = [(i, *plain(libraries, t)) for i, t in rows]
    count = Counter(p for _, a, b, links, _ in found for p in {(a[i], b[j]) for i, j, _ in links})
    most = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    return [(doc, len(a), len(b), len(groups), len(links), sum(count[a[i], b[j]] == most[a[i]] for i, j, _ in links),
             sum(count[a[i], b[j]] for i, j, _ in links), hashlib.sha256(spelt(a, b, groups).encode()).hexdigest() if a else "")
            for doc, a, b, links, groups in found]


def test_tables(spark, docs_of, libraries):
    rows = ROWS[:-1] + [(6, "the old " * 40)]
    got = [tuple(r) for r in alignment_counts(docs_of(rows), *PATHS).collect()]
    assert sorted(got, key=str) == sorted(expected(libraries, rows), key=str)
    assert alignment_counts(docs_of(rows).where("false"), *PATHS).count() == 0
    assert alignment_counts(docs_of([(2, None)]), *PATHS).collect()[0][1:] == (0, 0, 0, 0, 0, 0, "")


def test_long_document(spark, docs_of):
    row, = alignment_counts(docs_of(ROWS[-1:]), *PATHS).collect()
    assert row["n_a"] == 40_001 and row["n_links"] == row["n_best"] >= row["n_groups"]


def test_links_of_tables(spark, docs_of, libraries):
    got = aligned_tokens(docs_of(ROWS[:-1]), *PATHS).collect()
    for r, (doc, text) in zip(got, ROWS[:-1], strict=True):
        a, b, links, groups = plain(libraries, text)
        assert (r["doc_id"], r["a_ids"], r["b_ids"]) == (doc, a, b)
        assert [tuple(x) for x in r["overlaps"]] == links
        assert [tuple(x) for x in r["shared"]] == sorted((i, j) for x, y in groups for i in x for j in y)


def test_query_as_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    big = [i for i, t in rows if len(t or "") > 8000]
    got = op11_cross_tokenizer(spark, SF_SMALL)
    assert [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    assert len(big) < len(rows)
    assert sorted(map(tuple, got.collect())) == sorted(expected(libraries, rows))


def test_decimals_spell_every_number():
    from scorekeep.llm.token_alignment import decimals
    digits, used, size = decimals(10)
    spelt = [bytes(d[:-1][u[:-1]]).decode() for d, u in zip(digits, used, strict=True)]
    assert spelt == [str(i) for i in range(1024)] and used[:, -1].all()
    assert size.tolist() == [len(s) + 1 for s in spelt]


def test_groups_end_where_both_tokenizers_tokens_end():
    import numpy as np

    from scorekeep.llm.token_alignment import Aligned
    r = np.random.default_rng(5)
    sizes = np.array([1, 2, 3, 5, 7])
    a, b = r.integers(0, 5, 400), r.integers(0, 5, 400)
    total = min(sizes[a].sum(), sizes[b].sum())
    a, b = (i[:np.searchsorted(np.cumsum(sizes[i]), total, side="right")] for i in (a, b))
    own = Aligned([a[:0], a], [b[:0], b], sizes, sizes)
    cuts = np.intersect1d(np.cumsum(sizes[a]), np.cumsum(sizes[b]))
    assert own.cuts.tolist() == cuts.tolist()
    for group, ids in ((own.a_group, a), (own.b_group, b)):
        assert group.tolist() == [int((cuts < e).sum()) for e in np.cumsum(sizes[ids])]
