"""Rows of the pipeline that have no doc_id of their own."""

from collections import Counter

import corpus_pipeline
from tests.llm.conftest import words

A, B, C = (" ".join(words(seed, 60)) + "." for seed in (1, 2, 3))


def _rows(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_rows_without_an_id_of_their_own_are_documents(spark, docs_of):
    docs = docs_of([(1, A), (1, B), (None, C), (None, "another text of a few words"), (5, "one more of them, all by itself"), (5, None)])
    lettered = Counter({(1, A): 1, (1, B): 1, (None, C): 1, (None, "another text of a few words"): 1,
                        (5, "one more of them, all by itself"): 1})
    for stage in (corpus_pipeline.keep_known_languages, corpus_pipeline.drop_near_copies, corpus_pipeline.drop_repeated_spans,
                  corpus_pipeline.mask_personal_data):
        docs = stage(spark, docs, "")
        assert +(_rows(docs) - Counter({(5, None): 1})) == lettered
        assert docs.columns == docs_of([]).columns


def test_copies_without_ids(spark, docs_of):
    docs = docs_of([(None, A), (None, A), (7, A), (7, B), (8, B), (8, B), (9, C), (9, C)])
    got = _rows(corpus_pipeline.drop_near_copies(spark, docs, ""))
    assert sorted(t for _, t in got.elements()) == sorted([A, B, C]) and (8, B) in got and (9, C) in got


def test_repeated_rows_are_not_multiplied(spark, docs_of):
    mail = "write to someone@example.org or to no one"
    docs = docs_of([(3, mail), (3, mail), (None, mail), (None, mail), (4, A), (4, A)])
    assert sum(_rows(corpus_pipeline.mask_personal_data(spark, docs, "")).values()) == 6
    assert all("@" not in t for _, t in _rows(corpus_pipeline.mask_personal_data(spark, docs, "")))
    assert sum(_rows(corpus_pipeline.drop_repeated_spans(spark, docs, "")).values()) == 6


def test_passages_go_from_rows_without_ids(spark, docs_of):
    shared = ". ".join(" ".join(words(seed, 12)).capitalize() for seed in range(30, 36)) + ". "
    docs = docs_of([(1, shared + A), (None, shared + B), (None, shared + C)])
    got = _rows(corpus_pipeline.drop_repeated_spans(spark, docs, ""))
    assert sum(shared.split(". ")[2] in t for _, t in got) == 1 and (1, shared + A) in got and sum(got.values()) == 3


def test_an_empty_corpus(spark, docs_of):
    docs = docs_of([])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.count() == 0 and docs.columns == docs_of([]).columns
