import pytest

CLASH = {"label": 1, "node": 2, "spans": "x", "bucket": 3, "held_out": "y", "signature": 4}


@pytest.fixture(scope="session")
def docs_of(spark):
    """Makes documents of (doc_id, text[, lang]) rows, with extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "en", "src", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        return df.withColumns({k: F.lit(v) for k, v in CLASH.items()})

    return make


def words(seed, n, vocabulary=3000):
    import random
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]
