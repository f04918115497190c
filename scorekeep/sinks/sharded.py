"""Sharded JDBC sink: every row goes to table ``<name>_<tb_shard>`` of
database ``db_shard``.

The input is written once as the sharded parquet layout under the shared
scratch folder (one pass over the data, rebalanced on the shard columns);
each physical table is then written from its own partition directory, so
every per-table job reads only its rows, and several tables are written at
once.

Writing has two phases.  First the save mode is checked on all targets: with
error, one existing table refuses the whole write before a row is written;
with ignore, existing tables are left out.  Then each target is written and
noted as finished beside the staged rows, so a write that failed goes on
where it stopped when it is called again with the same staging folder.
Appends go through a staging table and one transaction in the database (see
``sinks.jdbc``), so a target is never filled twice or by half.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekeep.operators.sharding import SHARD_COLUMNS, ShardLayout, read_sharded, write_sharded
from scorekeep.plans.publish import Folder
from scorekeep.session import scratch_path
from scorekeep.sinks.jdbc import Connection, publish_staged, write_jdbc
from scorekeep.sources.jdbc import jdbc_options


def sharded_targets(layout: ShardLayout) -> list[tuple[int, int]]:
    """The regular (database, table) shards."""
    return [(db, tb) for db in range(layout.n_db) for tb in range(layout.n_tb)]


def read_sharded_jdbc(spark: SparkSession, layout: ShardLayout, url_for_db: Callable[[int], str], table: str,
                      targets=None, parallel: int = 8, **access) -> DataFrame:
    """One relation over all physical tables (or the given targets)."""
    def read(target):
        db, tb = target
        return spark.read.format("jdbc").options(**jdbc_options(url_for_db(db), **access, dbtable=f"{table}_{tb}")).load()

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        parts = list(pool.map(read, targets or sharded_targets(layout)))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    return rows


def save_sharded_jdbc(df: DataFrame, layout: ShardLayout, url_for_db: Callable[[int], str],
                      table: str, mode: str = "append", truncate: bool = False,
                      staging: str | None = None, parallel_writes: int = 8,
                      **jdbc) -> DataFrame:
    """Returns the relation over all shards, read from the databases.  ``parallel_writes`` physical
    tables are written at a time (each write is its own distributed job);
    pass ``num_partitions`` to cap the connections of each write, and the
    ``staging`` folder of a failed call to go on with it."""
    spark = df.sparkSession
    access = {k: jdbc[k] for k in ("driver", "user", "password") if k in jdbc}
    staging = staging or scratch_path(spark, f"shard-stage-{table}")
    notes = Folder(spark, f"{staging.rstrip('/')}_progress")
    if not notes.exists("staged"):
        keys = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in (layout.db_key, layout.tb_key)]
        homeless = df.where((keys[0] == "") | (keys[1] == "")).count()
        if homeless:
            raise ValueError(f"{homeless} rows have a null or empty shard key; nothing was written")
        staged = write_sharded(df, staging, layout, "overwrite")
        # every shard that has rows (a hash of the int minimum gives a negative one)
        # besides the regular ones, so that no row is left out
        targets = {(r[0], r[1]) for r in staged.select(*SHARD_COLUMNS).distinct().collect()} | set(sharded_targets(layout))
        there = _existing(spark, targets, url_for_db, table, parallel_writes, access)
        if there and mode in ("error", "errorifexists"):
            raise ValueError(f"{len(there)} target tables exist, {table}_{there[0][1]} of database {there[0][0]} first; "
                             "nothing was written")
        # what the mode decides is decided once, for this call and for one that goes on with it
        todo = sorted(targets - set(there) if mode == "ignore" else targets)
        notes.write("staged", json.dumps({"run": uuid.uuid4().hex, "all": sorted(targets), "todo": todo}))
    plan = json.loads(notes.read("staged"))
    staged = read_sharded(spark, staging)

    def write_one(target):
        db, tb = target
        if notes.exists(f"done_{db}_{tb}"):
            return
        part = (staged.where((F.col("db_shard") == db) & (F.col("tb_shard") == tb)).drop(*SHARD_COLUMNS))
        url, name = url_for_db(db), f"{table}_{tb}"
        if mode == "overwrite":
            write_jdbc(part, url, name, mode=mode, truncate=truncate, **jdbc)
        else:
            own = f"{name}_{plan['run'][:8]}"
            write_jdbc(part.where("false"), url, name, mode="append", **jdbc)   # creates a missing table
            write_jdbc(part, url, own, mode="overwrite", **jdbc)
            publish_staged(spark, url, name, own, plan["run"], part.columns, **access)
        notes.write(f"done_{db}_{tb}", "")

    with ThreadPoolExecutor(max_workers=max(1, parallel_writes)) as pool:
        list(pool.map(write_one, map(tuple, plan["todo"])))
    return read_sharded_jdbc(spark, layout, url_for_db, table, [tuple(t) for t in plan["all"]], parallel_writes, **access)


def _existing(spark, targets, url_for_db, table, parallel, access) -> list[tuple[int, int]]:
    """Targets whose table is there; one connection a database."""
    def look(db):
        with Connection(spark, url_for_db(db), **access) as c:
            return [(db, tb) for d, tb in sorted(targets) if d == db and c.has_table(f"{table}_{tb}")]

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return [t for found in pool.map(look, sorted({db for db, _ in targets})) for t in found]
