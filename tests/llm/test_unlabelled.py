"""A corpus without labels."""

import corpus_pipeline


def test_texts_stay_where_no_language_was_learned(spark, docs_of):
    docs = docs_of([(1, "the cat", None), (2, "12 %", None), (3, None, None), (4, "ein Hund", None)])
    assert {r.doc_id for r in corpus_pipeline.keep_known_languages(spark, docs, "").collect()} == {1, 4}
