"""The prefix codec against plain merging and against the library, whole texts and edits."""

import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from scorekeep.llm.byte_bpe import (EditableText, PrefixCodec, codec_of, decode_documents, edited_documents, encode_documents,
                                    op13_byte_bpe, rank_file)
from tests.conftest import SF_SMALL

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
#: Letters and digits of several Unicode versions, marks, spaces of all kinds and characters beyond the first plane.
ODD = "aab'rsl  \n\t  \x1c eéßñ中文字日本🙂՘⾡ةع1२Ⅷ²⃝.,;-=𝔘𐓏ꟍ᱀"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=rank_file(PATH), special_tokens={})


def merged(ranks, data):
    """Tokens of data by its definition: the leftmost pair of the lowest rank is merged, again and again."""
    parts = [bytes([b]) for b in data]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
        if rank == 1 << 40:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


def random_ranks(seed, letters=b"abc", merges=40):
    """A vocabulary of single bytes and tokens that join two earlier ones, some by more ways than one."""
    r, ranks = random.Random(seed), {bytes([b]): i for i, b in enumerate(range(256))}
    tokens = [bytes([b]) for b in letters]
    while len(ranks) < 256 + merges:
        new = r.choice(tokens) + r.choice(tokens)
        if new not in ranks:
            ranks[new] = len(ranks)
            tokens.append(new)
    return ranks


@settings(max_examples=60, deadline=None)
@given(seed=st.integers(0, 10**6), text=st.text("abcd", max_size=60))
def test_tables_hold_the_encoding_of_every_prefix(seed, text):
    ranks = random_ranks(seed)
    codec = PrefixCodec(ranks, whole_matches=False)
    last = codec.table(text)
    for i in range(len(text) + 1):
        assert codec.trace(text[:i], last[:i + 1]) == merged(ranks, text[:i].encode())
    words = [w.encode() for w in text.split("d")]
    assert [list(memoryview(w).cast("i")) for w in codec.encode_words(words)] == [merged(ranks, w) for w in words]


@settings(max_examples=150, deadline=None)
@given(text=st.text(ODD, max_size=80))
def test_texts_as_the_library(library, text):
    codec = codec_of(PATH, PATTERN)
    ids = codec.encode(text)
    assert ids.tolist() == library.encode_ordinary(text)
    assert codec.decode(ids).tobytes() == text.encode()


def test_long_matches_as_the_library(library):
    codec = codec_of(PATH, PATTERN)
    letters = "".join(random.Random(3).choices("abcdefgh", k=30_000))
    for text in (letters, "=" * 20_000, " " * 20_000 + "a", "ab" * 9000, "中" * 9000, "<|endoftext|>" * 30):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(text=st.text(ODD + " the and", max_size=120),
       edits=st.lists(st.tuples(st.integers(0, 130), st.integers(0, 9), st.text(ODD, max_size=6)), max_size=6))
def test_edits_and_appends_as_encoding_anew(library, text, edits):
    own = EditableText(codec_of(PATH, PATTERN), text)
    for start, gone, new in edits:
        start = min(start, len(text))
        stop = min(start + gone, len(text))
        own.replace(start, stop, new)
        text = text[:start] + new + text[stop:]
        assert own.text == text and own.ids() == library.encode_ordinary(text)
    own.append("'re it")
    assert own.ids() == library.encode_ordinary(text + "'re it")


def test_an_edit_redoes_only_what_is_near(library):
    codec = codec_of(PATH, PATTERN)
    text = "".join(random.Random(4).choices("abcdefgh", k=50_000))
    own = EditableText(codec, text)
    fed = []

    class Counting:
        def iter(self, *args):
            return ((fed.append(end), (end, value))[1] for end, value in real.iter(*args))

    real = codec.automaton
    codec.automaton = Counting()
    try:
        own.replace(20_000, 20_003, "xyzw")
    finally:
        codec.automaton = real
    assert max(fed) - min(fed) < 500
    assert own.ids() == library.encode_ordinary(text[:20_000] + "xyzw" + text[20_003:])


def test_tables_of_documents(spark, docs_of, library):
    rows = [(1, "a b"), (2, None), (3, ""), (None, "no id"), (1, "a b"), (4, "x" * 300_000), (5, ODD)]
    df = docs_of(rows)
    coded = encode_documents(df, PATH, PATTERN)
    got = sorted((r["doc_id"] or -1, r["ids"]) for r in coded.collect())
    assert got == sorted((i or -1, library.encode_ordinary(t or "")) for i, t in rows)
    back = sorted((r["doc_id"] or -1, bytes(r["decoded"]).decode()) for r in decode_documents(coded, PATH, PATTERN).collect())
    assert back == sorted((i or -1, t or "") for i, t in rows)
    assert encode_documents(df.where("false"), PATH, PATTERN).count() == 0


def test_edited_documents(spark, library):
    rows = [(1, "the old words", 4, 7, "new"), (2, None, None, None, "x"), (3, "abc", 9, 1, "!"), (4, "abc", -5, 2, None)]
    got = edited_documents(spark.createDataFrame(rows, "doc_id long, text string, start int, stop int, new string"), PATH, PATTERN)
    assert [(r["doc_id"], r["text"], r["ids"]) for r in got.orderBy("doc_id").collect()] == [
        (i, t, library.encode_ordinary(t)) for i, t in ((1, "the new words"), (2, "x"), (3, "abc!"), (4, "c"))]


def test_query_as_the_library(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = op13_byte_bpe(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest())
