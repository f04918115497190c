"""Every registered query against its DuckDB SQL (rows, columns, values)."""

import pytest

from scorekeep import compare, oracle, queries
from tests.conftest import SF_MEDIUM, SF_SMALL

SQL = oracle.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle_small(spark, name):
    df = queries.QUERIES[name](spark, SF_SMALL)
    r = compare.compare(df, SQL[name], SF_SMALL)
    assert r["cols_match"], (r["cols_spark"], r["cols_oracle"])
    assert r["rows_match"], (r["rows_spark"], r["rows_oracle"])
    assert r["values_match"]


@pytest.mark.parametrize("name", ["score_answers", "question_detail", "wide_scores",
                                  "wide_scores_strict"])
def test_headline_matches_oracle_medium(spark, name):
    df = queries.QUERIES[name](spark, SF_MEDIUM)
    r = compare.compare(df, SQL[name], SF_MEDIUM)
    assert r["rows_match"] and r["cols_match"] and r["values_match"], r["rows_spark"]


def test_every_query_has_oracle():
    # every registered query is value-checked
    assert set(queries.QUERIES) == set(SQL)


def test_known_counts_medium(spark):
    from pyspark.sql import functions as F
    scores = queries.score_answers(spark, SF_MEDIUM)
    assert scores.count() == 40927
    assert queries.paper_totals(spark, SF_MEDIUM).count() == 53
    detail = queries.question_detail(spark, SF_MEDIUM)
    assert detail.count() == 13246
    w = queries.wide_scores(spark, SF_MEDIUM)
    assert w.count() == 11621
    assert queries.wide_scores_strict(spark, SF_MEDIUM).count() == 2137
    # pivot cells sum to the total when every position is in the list
    total = w.agg(F.sum("total")).collect()[0][0]
    cells = w.select(*[F.coalesce(F.col(f"c{i}"), F.lit(0.0)).alias(f"x{i}") for i in range(1, 21)])
    s = cells.agg(*[F.sum(c) for c in cells.columns]).collect()[0]
    assert abs(sum(s) - total) < 1e-6
    assert abs(detail.agg(F.sum("stuScore")).collect()[0][0] - total) < 1e-6


@pytest.mark.parametrize("name", ["score_answers", "paper_totals", "question_detail",
                                  "wide_scores", "student_batch_load", "question_dimension",
                                  "score_multichoice", "left_join_on_pred"])
def test_shuffle_join_fallback_matches_oracle(spark, name):
    """With every broadcast refused (the large-dimension case), the
    sort-merge fallback plans give the same results."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("scorekeep.broadcast.maxRows", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = queries.QUERIES[name](spark, SF_SMALL)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan
        r = compare.compare(df, SQL[name], SF_SMALL)
        assert r["rows_match"] and r["cols_match"] and r["values_match"]
    finally:
        spark.conf.unset("scorekeep.broadcast.maxRows")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


SPARK_TO_DUCKDB = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
                   "string": "VARCHAR", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP"}


def test_column_types_match_oracle(spark):
    """Every query's column types equal its DuckDB twin's (analysis only)."""
    import os

    import duckdb
    con = duckdb.connect()
    for t in compare.RAW_TABLES:
        path = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    bad = {}
    for name, sql in SQL.items():
        spark_types = dict(queries.QUERIES[name](spark, SF_SMALL).dtypes)
        rel = con.sql(sql)
        duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
        diff = {c: (t, duck_types.get(c)) for c, t in spark_types.items()
                if SPARK_TO_DUCKDB.get(t, t) != duck_types.get(c)}
        if diff:
            bad[name] = diff
    assert not bad, bad
