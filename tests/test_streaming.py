"""Incremental scoring over arriving answer files equals the batch result."""

import os
import shutil

from pyspark.sql import functions as F

from scorekeep import queries
from scorekeep.sources import fixtures
from scorekeep.streaming.incremental import (answer_stream, score_stream,
                                             start_incremental_scoring)
from tests.conftest import SF_SMALL


def test_stream_scores_match_batch(spark, workdir):
    src = workdir + "/incoming"
    os.makedirs(src)
    shutil.copy(os.path.join(SF_SMALL, "lineitem.parquet"), src + "/lineitem-0001.parquet")
    t = fixtures.load(spark, SF_SMALL)
    scores = score_stream(answer_stream(spark, src, SF_SMALL), t.question, t.absent)
    q = start_incremental_scoring(scores, workdir + "/scores", workdir + "/ckpt")
    q.awaitTermination(120)
    got = spark.read.parquet(workdir + "/scores")
    batch = queries.score_answers(spark, SF_SMALL)
    assert got.count() == batch.count()
    assert got.agg(F.sum("stuScore")).collect()[0][0] == batch.agg(F.sum("stuScore")).collect()[0][0]


def test_stream_scores_only_new_files(spark, workdir):
    """Two files arrive one after the other: each trigger scores only the
    rows of the new file, and the sum over both equals the batch result."""
    import pyarrow.parquet as pq
    src = workdir + "/incoming2"
    os.makedirs(src)
    table = pq.read_table(os.path.join(SF_SMALL, "lineitem.parquet"))
    half = table.num_rows // 2
    pq.write_table(table.slice(0, half), src + "/lineitem-a.parquet")
    t = fixtures.load(spark, SF_SMALL)
    scores = score_stream(answer_stream(spark, src, SF_SMALL), t.question, t.absent)
    q = start_incremental_scoring(scores, workdir + "/scores2", workdir + "/ckpt2")
    q.awaitTermination(120)
    first = spark.read.parquet(workdir + "/scores2").count()
    pq.write_table(table.slice(half), src + "/lineitem-b.parquet")
    q = start_incremental_scoring(scores, workdir + "/scores2", workdir + "/ckpt2")
    q.awaitTermination(120)
    got = spark.read.parquet(workdir + "/scores2")
    batch = queries.score_answers(spark, SF_SMALL)
    assert 0 < first < got.count() == batch.count()
    assert got.agg(F.sum("stuScore")).collect()[0][0] == batch.agg(F.sum("stuScore")).collect()[0][0]
