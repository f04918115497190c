"""What is held at once: by a worker, and in a batch sent to it."""

import tracemalloc

import pyarrow as pa
import pytest

import corpus_pipeline
from scorekeep.llm import ngram_jaccard, substring_dedup
from tests.llm.conftest import words


@pytest.mark.parametrize("work", [substring_dedup._listing(3, 12, 20), substring_dedup._removal(3, 12, 20),
                                  ngram_jaccard._classifier(5, 80), ngram_jaccard._fetcher(5)])
def test_arrays_of_a_few_texts_at_a_time(work):
    text = pa.array([" ".join(words(seed, 8000)) + "." for seed in range(60)])  # 2.8 MB
    ids = pa.array(range(60), pa.int64())
    part = pa.RecordBatch.from_arrays([ids, ids, text, pa.array([None] * 60, pa.list_(pa.int64()))], names=["doc_id", "want", "text", "repeats"])
    most, rows = 0, 0
    tracemalloc.start()
    try:
        for out in work(iter([part])):
            most, rows = max(most, tracemalloc.get_traced_memory()[1]), rows + out.num_rows
    finally:
        tracemalloc.stop()
    assert most < 64 << 20 and rows >= 60


def test_batches_of_long_texts_are_short(spark, docs_of):
    keyed, _ = corpus_pipeline._keyed(docs_of([(i, "word " * 20_000) for i in range(40)]).coalesce(1))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64()), pa.array([batch.num_rows], pa.int64())], names=["size", "n"])

    got = keyed.select("text").mapInArrow(sizes, "size long, n long").collect()
    assert sum(r.n for r in got) == 40 and max(r.size for r in got) < 1_300_000
