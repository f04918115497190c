"""Sources and sinks without a server: in-process Derby JDBC, local folders."""

import uuid

import pytest
from pyspark.sql import functions as F

from scorekeep.operators.sharding import ShardLayout
from scorekeep.sinks.files import write_files
from scorekeep.sinks.jdbc import write_jdbc
from scorekeep.sinks.sharded import save_sharded_jdbc
from scorekeep.sinks.tables import create_detail_table, insert_into, insert_select
from scorekeep.sources.catalog import partition_count, table_scan, text_scan
from scorekeep.sources.jdbc import jdbc_query

DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


def derby_url(name=None):
    return f"jdbc:derby:memory:{name or 'db' + uuid.uuid4().hex[:8]};create=true"


@pytest.fixture()
def small(spark):
    return spark.createDataFrame([(i, f"s{i}", i * 0.5) for i in range(20)],
                                 "id int, name string, score double")


def read_table(spark, url, table):
    return jdbc_query(spark, url, f"SELECT * FROM {table}", driver=DERBY)


def test_jdbc_append_and_query_scan(spark, small):
    url = derby_url()
    write_jdbc(small, url, "scores", mode="append", driver=DERBY)
    write_jdbc(small, url, "scores", mode="append", driver=DERBY)
    df = read_table(spark, url, "scores")
    assert df.count() == 40
    # a filter on the derived table still works (and is pushed into the query)
    assert df.where(F.col("ID") < 5).count() == 10


def test_jdbc_save_modes(spark, small):
    url = derby_url()
    write_jdbc(small, url, "t", mode="error", driver=DERBY)      # absent: create + insert
    with pytest.raises(Exception):
        write_jdbc(small, url, "t", mode="error", driver=DERBY)
    write_jdbc(small.limit(3), url, "t", mode="ignore", driver=DERBY)
    assert read_table(spark, url, "t").count() == 20
    write_jdbc(small.limit(5), url, "t", mode="overwrite", truncate=True, driver=DERBY)
    assert read_table(spark, url, "t").count() == 5
    write_jdbc(small.limit(7), url, "t", mode="overwrite", driver=DERBY)
    assert read_table(spark, url, "t").count() == 7


def test_jdbc_partitioned_scan(spark, small):
    url = derby_url()
    write_jdbc(small, url, "p", driver=DERBY)
    df = jdbc_query(spark, url, "SELECT * FROM p", driver=DERBY, partition_column="ID",
                    lower_bound=0, upper_bound=20, num_partitions=4)
    assert partition_count(df) == 4
    assert df.count() == 20
    one = jdbc_query(spark, url, "SELECT * FROM p", driver=DERBY)
    assert partition_count(one) == 1


def test_jdbc_partial_partitioning_rejected(spark):
    with pytest.raises(ValueError):
        jdbc_query(spark, derby_url(), "SELECT 1", lower_bound=0, upper_bound=10)


def test_insert_into_by_position_and_ddl(spark, tables_small, workdir):
    from scorekeep import queries
    from tests.conftest import SF_SMALL
    name = "detail_target_" + uuid.uuid4().hex[:8]
    create_detail_table(spark, name, workdir + "/target")
    detail = queries.question_detail(spark, SF_SMALL)
    insert_into(detail, name)
    target = table_scan(spark, name)
    assert target.count() == detail.count()
    assert dict(target.dtypes)["stuScore"] == "decimal(12,4)"
    assert "stuAnswer" in target.columns and "userName" in target.columns
    total = target.agg(F.sum("stuScore")).collect()[0][0]
    assert float(total) == detail.agg(F.sum("stuScore")).collect()[0][0]
    detail.createOrReplaceTempView("detail_view_for_insert")
    insert_select(spark, name, "detail_view_for_insert")
    assert table_scan(spark, name).count() == 2 * detail.count()


def test_sharded_jdbc_sink(spark):
    layout = ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=4)
    rows = [(f"P{i % 3}", str(i), i) for i in range(60)]
    df = spark.createDataFrame(rows, "paperId string, questionId string, v int")
    urls = {0: derby_url(), 1: derby_url()}
    save_sharded_jdbc(df, layout, lambda db: urls[db], "obj", mode="append", driver=DERBY)
    from scorekeep.functions.shardhash import shard_index_py
    seen = 0
    for db in range(2):
        for tb in range(4):
            got = read_table(spark, urls[db], f"obj_{tb}").collect()
            for r in got:
                assert shard_index_py(r["paperId"], 2) == db
                assert shard_index_py(r["questionId"], 4) == tb
            seen += len(got)
    assert seen == 60
    # overwrite replaces each physical table
    save_sharded_jdbc(df.limit(10), layout, lambda db: urls[db], "obj", mode="overwrite",
                      driver=DERBY)
    total = sum(read_table(spark, urls[db], f"obj_{tb}").count()
                for db in range(2) for tb in range(4))
    assert total == 10


def test_sharded_layout_modes(spark, workdir):
    from scorekeep.operators.sharding import read_sharded, write_sharded
    layout = ShardLayout(n_db=2, n_tb=8)
    df = spark.createDataFrame([(f"P{i % 2}", i) for i in range(50)],
                               "paperId string, questionId long")
    path = workdir + "/sharded"
    write_sharded(df, path, layout, "error")
    write_sharded(df, path, layout, "ignore")
    assert read_sharded(spark, path).count() == 50
    write_sharded(df, path, layout, "append")
    assert read_sharded(spark, path).count() == 100
    write_sharded(df.limit(5), path, layout, "overwrite")
    assert read_sharded(spark, path).count() == 5
    with pytest.raises(Exception):
        write_sharded(df, path, layout, "error")


def test_routing_errors():
    from scorekeep.operators.sharding import RoutingError, route_predicate
    layout = ShardLayout(n_db=2, n_tb=8)
    with pytest.raises(RoutingError):
        route_predicate(layout, paperId="")
    with pytest.raises(RoutingError):
        route_predicate(layout, paperId=None)
    with pytest.raises(RoutingError):
        route_predicate(layout, questionId=range(1, 5))
    with pytest.raises(RoutingError):
        route_predicate(layout, stuId="1")
    route_predicate(layout, paperId=["", "P0"])   # IN accepts the empty string


def test_text_scan_and_file_sink(spark, workdir):
    p = workdir + "/lines.txt"
    with open(p, "w") as f:
        f.write("first\nsecond\nthird\n")
    lines = text_scan(spark, p)
    assert [r.value for r in lines.collect()] == ["first", "second", "third"]
    write_files(lines.withColumn("n", F.length("value")), workdir + "/out", partition_by=["n"])
    assert spark.read.parquet(workdir + "/out").count() == 3


def test_param_query_binds_values(spark):
    from scorekeep.sources.params import param_query
    df = spark.range(10)
    assert param_query(spark, "SELECT * FROM {t} WHERE id > ?", [6], t=df).count() == 3
    assert param_query(spark, "SELECT * FROM {t} WHERE id < :n", {"n": 2}, t=df).count() == 2
    with pytest.raises(Exception):
        param_query(spark, "SELECT * FROM {t} WHERE id > ? AND id < ?", [1], t=df).count()


def test_routed_jdbc_read(spark):
    from scorekeep.operators.sharding import RoutingError, route_target, routed_jdbc_read
    layout = ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=4)
    rows = [(f"P{i % 3}", str(i % 7), i) for i in range(84)]
    df = spark.createDataFrame(rows, "paperId string, questionId string, v int")
    urls = {0: derby_url(), 1: derby_url()}
    save_sharded_jdbc(df, layout, lambda db: urls[db], "obj", mode="append", driver=DERBY,
                      create_table_column_types="paperId VARCHAR(16), questionId VARCHAR(16)")
    got = routed_jdbc_read(spark, layout, lambda db: urls[db], "obj", driver=DERBY,
                           paperId="P1", questionId="3")
    expected = sorted(v for p, q, v in rows if p == "P1" and q == "3")
    assert sorted(r["v"] for r in got.collect()) == expected
    assert "PushedFilters" in got._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(RoutingError):
        route_target(layout, paperId="P1")
    with pytest.raises(RoutingError):
        route_target(layout, paperId="P1", questionId=["1", "2"])


def test_gather_jdbc_reads_only_routed_tables(spark):
    from scorekeep.operators.sharding import gather_jdbc
    from scorekeep.functions.shardhash import shard_index_py
    layout = ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=4)
    rows = [(f"P{i % 3}", str(i % 11), i) for i in range(110)]
    df = spark.createDataFrame(rows, "paperId string, questionId string, v int")
    urls = {0: derby_url(), 1: derby_url()}
    save_sharded_jdbc(df, layout, lambda db: urls[db], "g", mode="append", driver=DERBY,
                      create_table_column_types="paperId VARCHAR(16), questionId VARCHAR(16)")
    wanted = ["1", "2", "5"]
    keys = spark.createDataFrame([(w,) for w in wanted], "questionId string")
    got = gather_jdbc(spark, layout, lambda db: urls[db], "g", keys, driver=DERBY)
    assert sorted(r["v"] for r in got.collect()) == sorted(v for p, q, v in rows if q in wanted)
    empty = gather_jdbc(spark, layout, lambda db: urls[db], "g",
                        keys.where("questionId = 'none'"), driver=DERBY)
    assert empty.count() == 0 and set(empty.columns) == {"paperId", "questionId", "v"}
    import re
    plan = got._jdf.queryExecution().executedPlan().toString()
    read = set(re.findall(r"JDBCRelation\((g_\d+)\)", plan))
    assert read == {f"g_{shard_index_py(w, 4)}" for w in wanted}
    # the keys are in the databases' queries, one partition a chunk
    got = gather_jdbc(spark, layout, lambda db: urls[db], "g", keys, driver=DERBY, chunk=1)
    clauses = _where_clauses(got)
    assert len(clauses) == 2 * len(wanted)
    assert all(sum(f"IN ('{w}')" in c for c in clauses) == 2 for w in wanted)
    # more keys than may pass the driver: the routed tables are read and semi-joined
    whole = gather_jdbc(spark, layout, lambda db: urls[db], "g", keys, driver=DERBY, max_pushed=1)
    assert sorted(r["v"] for r in whole.collect()) == sorted(r["v"] for r in got.collect())


def _where_clauses(df):
    """The conditions of all JDBC partitions that df reads."""
    def scans(plan):
        if "JDBCRelation" in plan.nodeName():
            yield plan
        for i in range(plan.children().size()):
            yield from scans(plan.children().apply(i))
    found = []
    for scan in scans(df._jdf.queryExecution().sparkPlan()):
        found += [p.whereClause() for p in scan.rdd().partitions()]
    return found


def test_gather_by_both_keys_reads_only_routed_databases(spark):
    """An unrouted database is not touched: its address leads nowhere."""
    from scorekeep.functions.shardhash import shard_index_py
    from scorekeep.operators.sharding import gather_jdbc
    layout = ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=4)
    rows = [(f"P{i % 3}", str(i % 11), i) for i in range(110)]
    df = spark.createDataFrame(rows, "paperId string, questionId string, v int")
    urls = {0: derby_url(), 1: derby_url()}
    save_sharded_jdbc(df, layout, lambda db: urls[db], "b", driver=DERBY,
                      create_table_column_types="paperId VARCHAR(16), questionId VARCHAR(16)")
    wanted = [("P1", "2"), ("P1", "o'k"), ("P1", "7")]
    keys = spark.createDataFrame(wanted, "paperId string, questionId string")
    own = shard_index_py("P1", 2)
    got = gather_jdbc(spark, layout, lambda db: urls[db] if db == own else "jdbc:derby:memory:nowhere", "b", keys, driver=DERBY)
    assert sorted(r["v"] for r in got.collect()) == sorted(v for p, q, v in rows if (p, q) in wanted)


def test_sharded_sink_checks_all_targets_first(spark, workdir):
    layout = ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=4)
    df = spark.createDataFrame([(f"P{i % 3}", str(i), i) for i in range(60)], "paperId string, questionId string, v int")
    urls = {0: derby_url(), 1: derby_url()}
    write_jdbc(df.limit(1), urls[1], "obj_3", driver=DERBY)
    with pytest.raises(ValueError, match="nothing was written"):
        save_sharded_jdbc(df, layout, lambda db: urls[db], "obj", mode="error", driver=DERBY)
    from scorekeep.sinks.jdbc import Connection
    for db in (0, 1):
        with Connection(spark, urls[db], DERBY) as c:
            assert [tb for tb in range(4) if c.has_table(f"obj_{tb}")] == ([3] if db else [])
    got = save_sharded_jdbc(df, layout, lambda db: urls[db], "obj", mode="ignore", driver=DERBY)
    from scorekeep.functions.shardhash import shard_index_py
    left_out = [i for i in range(60) if shard_index_py(f"P{i % 3}", 2) == 1 and shard_index_py(str(i), 4) == 3]
    assert got.count() == 60 - len(left_out) + 1 and left_out


def test_sharded_append_goes_on_where_it_stopped(spark, workdir, monkeypatch):
    from scorekeep.sinks import sharded
    layout = ShardLayout(db_key="paperId", tb_key="questionId", n_db=2, n_tb=4)
    df = spark.createDataFrame([(f"P{i % 3}", str(i), i) for i in range(60)], "paperId string, questionId string, v int")
    urls = {0: derby_url(), 1: derby_url()}

    def save():
        return save_sharded_jdbc(df, layout, lambda db: urls[db], "obj", staging=workdir + "/stage", driver=DERBY, parallel_writes=1)

    real, calls = sharded.publish_staged, []

    def failing(*args, **kwargs):
        calls.append(args)
        done = real(*args, **kwargs)
        if len(calls) == 3:
            raise ConnectionError   # after the move, before the note
        return done

    monkeypatch.setattr(sharded, "publish_staged", failing)
    with pytest.raises(ConnectionError):
        save()
    monkeypatch.setattr(sharded, "publish_staged", real)
    assert sorted(r["v"] for r in save().collect()) == list(range(60))
    assert save().count() == 60   # a finished write is not done again
    monkeypatch.undo()
    assert save_sharded_jdbc(df, layout, lambda db: urls[db], "obj", driver=DERBY).count() == 120


def test_layouts_are_written_once(spark, workdir):
    import os

    from scorekeep import queries
    from scorekeep.operators import sharding
    from tests.conftest import SF_SMALL
    spark.conf.set("scorekeep.layouts.dir", workdir + "/layouts")

    def files():
        return {(d, f, os.path.getmtime(os.path.join(d, f))) for d, _, names in os.walk(workdir) for f in names}

    try:
        first = queries.shard_routed_read(spark, SF_SMALL).count()
        queries.colocated_join(spark, SF_SMALL).count()
        seen = files()
        assert seen
        for _ in range(2):
            assert queries.shard_routed_read(spark, SF_SMALL).count() == first
            queries.shard_gather(spark, SF_SMALL)
            assert "Exchange hashpartitioning" not in queries.colocated_join(
                spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert files() == seen
        assert len(sharding.drop_layouts(spark)) == 3 and not sharding.drop_layouts(spark)
        assert queries.shard_routed_read(spark, SF_SMALL).count() == first   # written anew
    finally:
        spark.conf.unset("scorekeep.layouts.dir")
