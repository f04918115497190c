"""The hashes of the embedding search don't depend on the size of the table."""

import pytest

from scorekeep.llm import embedding_dedup as ed


class Stop(Exception):
    pass


def test_a_large_table_has_the_same_hashes(spark, monkeypatch):
    df = spark.createDataFrame([(i, 1, [1.0, float(i)]) for i in range(3)], "vec_id long, label int, embedding array<float>")

    def links(nodes, hashes, least):
        raise Stop(hashes)

    monkeypatch.setattr(ed, "_links", links)
    monkeypatch.setattr(type(df), "count", lambda self: 117_000_000)
    with pytest.raises(Stop, match="^2$"):
        ed.near_embeddings(df)
