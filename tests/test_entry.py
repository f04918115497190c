"""The driver contract of __spark_entry__.py."""

import importlib.util
import os

from tests.conftest import ROOT


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_with_rows_and_stable_schema(spark):
    m = _entry_module()
    first, second = m.entry(spark), m.entry(spark)
    assert first.count() > 0
    assert first.schema == second.schema


def test_queries_and_oracle_keys_agree():
    m = _entry_module()
    qs, sqls = m.queries(), m.oracle_sql()
    own = {n for n in qs if n != "pipeline" and not n.startswith("op")}
    assert len(own) >= 32 and own <= set(sqls) <= set(qs)
    assert all(callable(f) for f in qs.values())
    assert all(isinstance(s, str) and s.strip() for s in sqls.values())


def test_oracle_sql_binds_in_duckdb():
    import duckdb

    from scorekeep import compare
    from tests.conftest import SF_SMALL
    con = duckdb.connect()
    for t in compare.RAW_TABLES:
        path = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    for name, sql in _entry_module().oracle_sql().items():
        assert con.sql(sql).columns, name
