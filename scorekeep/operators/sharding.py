"""Sharded layout: shard columns, sharded writes, routed reads, gathers and
co-located (bucketed) joins.

A logical table is spread over ``n_db`` databases by one key and ``n_tb``
tables by another, each shard being ``abs(javaHash(key)) % n``.  On Spark
the layout is a parquet table partitioned by ``db_shard``/``tb_shard``:

* a routed read (equality or IN on the shard keys) becomes a predicate on
  the partition columns, so the scan lists only the matching directories
  (``PartitionFilters`` in the plan), plus the key predicate itself;
* a gather over a key set (the original: one routed read per key, unioned
  on the driver) is one scan semi-joined to the key set on the key and its
  shard columns, so dynamic partition pruning skips shards with no key;
* a write partitions the output by shard, one directory per physical table.
  With few shards every task writes its own rows of each, without a shuffle;
  with many it first rebalances rows on the shard columns (AQE splits a hot
  shard over several tasks and merges cold ones), so that files stay few.

Tables sharded alike ("binding tables") are written bucketed on their join
key with the same bucket count, so joining them needs no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorekeep.fixed_values import SHARD_DATABASES, SHARD_TABLES
from scorekeep.functions.shardhash import shard_index, shard_index_py

SHARD_COLUMNS = ("db_shard", "tb_shard")


@dataclass(frozen=True)
class ShardLayout:
    """Database shards by ``db_key``; table shards by ``tb_key``.  The
    original layout is 2 databases x 256 tables; tests use 2 x 8."""

    db_key: str = "paperId"
    tb_key: str = "questionId"
    n_db: int = SHARD_DATABASES
    n_tb: int = SHARD_TABLES


class RoutingError(ValueError):
    """A predicate on a shard key that cannot be routed."""


def with_shards(df: DataFrame, layout: ShardLayout) -> DataFrame:
    return df.withColumns({
        "db_shard": shard_index(F.col(layout.db_key).cast("string"), layout.n_db),
        "tb_shard": shard_index(F.col(layout.tb_key).cast("string"), layout.n_tb),
    })


#: Up to this many shards a task keeps a file of each open, and rows are neither shuffled nor sorted for the write.
#: A hash of the int minimum has a negative shard, so twice as many as the regular ones may come.
DIRECT_SHARDS = 32
_CONCURRENT_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def shard_rows(df: DataFrame, layout: ShardLayout) -> DataFrame:
    """The rows to write, with their shards: as they lie if the shards are few, else rebalanced on the shards."""
    rows = with_shards(df, layout)
    return rows if layout.n_db * layout.n_tb <= DIRECT_SHARDS else rows.hint("rebalance", *SHARD_COLUMNS)


def write_sharded(df: DataFrame, path: str, layout: ShardLayout, mode: str = "append") -> DataFrame:
    """Write ``df`` as the sharded layout and return it re-read (lazily).
    ``mode`` is Spark's save mode: append, overwrite, error(ifexists) or ignore."""
    spark = df.sparkSession
    before = spark.conf.get(_CONCURRENT_WRITERS)
    if layout.n_db * layout.n_tb <= DIRECT_SHARDS:
        spark.conf.set(_CONCURRENT_WRITERS, str(max(int(before), 2 * DIRECT_SHARDS)))
    try:
        shard_rows(df, layout).write.mode(mode).partitionBy(*SHARD_COLUMNS).parquet(path)
    finally:
        spark.conf.set(_CONCURRENT_WRITERS, before)
    return read_sharded(spark, path)


def _literal_key(value) -> str:
    if value is None or str(value) == "":
        raise RoutingError("shard key must be a non-empty value for an equality route")
    return str(value)


def route_predicate(layout: ShardLayout, **keys) -> Column:
    """Predicate for a routed read.  Each key is ``db_key`` or ``tb_key``
    with a scalar (equality) or a list/tuple/set (IN).  Range (BETWEEN)
    routing does not exist: pass a ``range`` or ``slice`` and it is refused."""
    pred = None
    for key, value in keys.items():
        if key not in (layout.db_key, layout.tb_key):
            raise RoutingError(f"{key} is not a shard key of this layout")
        shard_col, n = (("db_shard", layout.n_db) if key == layout.db_key
                        else ("tb_shard", layout.n_tb))
        if isinstance(value, (range, slice)):
            raise RoutingError("BETWEEN is not supported on a shard key")
        if isinstance(value, (list, tuple, set, frozenset)):
            # IN: de-duplicated targets; no row has a null or empty key
            # the literals go to the column's type, so that the scan can push them
            values = [v for v in value if v is not None and str(v) != ""]
            shards = sorted({shard_index_py(str(v), n) for v in values})
            cond = F.col(shard_col).isin(shards) & F.col(key).isin(values)
        else:
            v = _literal_key(value)
            cond = (F.col(shard_col) == shard_index_py(v, n)) & (F.col(key) == F.lit(value))
        pred = cond if pred is None else pred & cond
    if pred is None:
        raise RoutingError("a routed read needs at least one shard key")
    return pred


def read_sharded(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def routed_read(spark: SparkSession, path: str, layout: ShardLayout, **keys) -> DataFrame:
    return read_sharded(spark, path).where(route_predicate(layout, **keys))


def gather(sharded: DataFrame, keys: DataFrame, layout: ShardLayout,
           key: str | None = None) -> DataFrame:
    """Rows of ``sharded`` whose ``key`` (default: the table-shard key) is in
    ``keys``; the key set carries its shard column so the semi-join prunes
    partitions dynamically."""
    key = key or layout.tb_key
    shard_col, n = (("tb_shard", layout.n_tb) if key == layout.tb_key
                    else ("db_shard", layout.n_db))
    from scorekeep.plans.broadcast import bounded_broadcast
    k = (keys.select(F.col(key)).where(F.col(key).cast("string") != "").distinct()
         .withColumn(shard_col, shard_index(F.col(key).cast("string"), n)))
    return sharded.join(bounded_broadcast(k), [key, shard_col], "left_semi")


def shard_targets(df: DataFrame, layout: ShardLayout, group: str | None = None) -> DataFrame:
    """The de-duplicated physical targets (db_shard, tb_shard) that the rows
    of ``df`` route to, optionally per ``group`` value."""
    cols = ([group] if group else []) + list(SHARD_COLUMNS)
    return with_shards(df, layout).select(*cols).distinct()


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int,
                   mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table bucketed (and sorted) on ``key``.

    The rows are rebalanced on the key into ``buckets`` partitions first --
    the same hash bucketing uses -- so a task writes one bucket's file
    instead of one file per bucket per task, while AQE may still split an
    oversized (hot-key) bucket over several writers (several files of the
    same bucket) or merge small ones."""
    (df.hint("rebalance", buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(name))
    return df.sparkSession.table(name)


def colocated_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                   how: str = "inner", buckets: int | None = None) -> DataFrame:
    """Join two tables bucketed alike on their keys: Spark reads bucket i of
    both sides in task i, with no exchange on either side.  With
    ``buckets`` given, keys of ``left`` holding more than an average bucket
    are joined separately by broadcast (see ``plans.skew``)."""
    if buckets:
        from scorekeep.plans.skew import split_hot_join
        return split_hot_join(left, right, left_key, right_key, buckets, how)
    return left.join(right, left[left_key] == right[right_key], how)


def route_target(layout: ShardLayout, **keys) -> tuple[int, int]:
    """The one (db_shard, tb_shard) that equality values on both shard keys
    route to; anything that does not name exactly one target is refused."""
    if set(keys) != {layout.db_key, layout.tb_key}:
        raise RoutingError("a routed read needs equality on both shard keys to find one table")
    db = shard_index_py(_literal_key(_scalar(keys[layout.db_key])), layout.n_db)
    tb = shard_index_py(_literal_key(_scalar(keys[layout.tb_key])), layout.n_tb)
    return db, tb


def _scalar(value):
    if isinstance(value, (list, tuple, set, frozenset, range, slice)):
        raise RoutingError("a routed read to one table needs single values, not a set or range")
    return value


def routed_jdbc_read(spark: SparkSession, layout: ShardLayout, url_for_db, table: str,
                     driver: str | None = None, user: str | None = None,
                     password: str | None = None, **keys) -> DataFrame:
    """Read the one physical table ``<table>_<tb_shard>`` of database
    ``db_shard`` that the key values route to, filtered to those values.
    The filters are DataFrame predicates, which the JDBC source sends to the
    database as its WHERE clause (with properly escaped literals)."""
    from scorekeep.sources.jdbc import jdbc_options
    db, tb = route_target(layout, **keys)
    opts = jdbc_options(url_for_db(db), driver, user, password, dbtable=f"{table}_{tb}")
    df = spark.read.format("jdbc").options(**opts).load()
    for key, value in keys.items():
        df = df.where(F.col(key) == F.lit(str(value)))
    return df


#: Up to this many keys go to the databases as conditions (at most about 20 MB of them pass the driver).
MAX_PUSHED_KEYS = 200_000


def _key_conditions(c, column: str, clob: bool, keys: list[str], chunk: int) -> list[str]:
    name = c.quoted(column)
    name = f"CAST({name} AS VARCHAR(256))" if clob else name
    return [f"{name} IN ({', '.join(chr(39) + k.replace(chr(39), chr(39) * 2) + chr(39) for k in keys[i:i + chunk])})"
            for i in range(0, len(keys), chunk)]


def gather_jdbc(spark: SparkSession, layout: ShardLayout, url_for_db, table: str,
                keys: DataFrame, driver: str | None = None, user: str | None = None,
                password: str | None = None, chunk: int = 500, max_pushed: int = MAX_PUSHED_KEYS,
                parallel: int = 8) -> DataFrame:
    """Rows of the JDBC-sharded ``table`` whose table-shard key is in ``keys``.

    Only physical tables that some key routes to are read; where ``keys`` has the
    database key as well, only databases that one routes to.  Up to
    ``max_pushed`` keys go to the database: each read of a table has one
    partition per ``chunk`` keys, with these as its condition, so rows of other
    keys never leave the database.  More keys than that: the tables are read
    whole and semi-joined (a broadcast when the keys are proven small).  The
    text form of a key is compared, as the shard hash uses it."""
    from concurrent.futures import ThreadPoolExecutor

    from scorekeep.plans.broadcast import bounded_broadcast
    from scorekeep.sinks.jdbc import _CLOB, Connection
    from scorekeep.sources.jdbc import jdbc_options
    key, access = layout.tb_key, {"driver": driver, "user": user, "password": password}
    routed = layout.db_key in keys.columns
    chosen = [key, layout.db_key] if routed else [key]
    k = keys.select(*[F.col(c).cast("string").alias(c) for c in chosen]).where(
        " AND ".join(f"`{c}` <> ''" for c in chosen)).distinct()
    shards = k.withColumn("tb_shard", shard_index(F.col(key), layout.n_tb)).withColumn(
        "db_shard", shard_index(F.col(layout.db_key), layout.n_db) if routed else F.lit(None).cast("int"))
    found = shards.limit(max_pushed + 1).collect()
    pushed = len(found) <= max_pushed
    if not pushed:   # at most n_db x n_tb targets
        found = shards.select("tb_shard", "db_shard").distinct().collect()
    targets: dict[tuple[int, int], set[str]] = {}
    for r in found:
        for db in ([r["db_shard"]] if routed else range(layout.n_db)):
            targets.setdefault((r["tb_shard"], db), set()).update([r[key]] if pushed else [])
    none = not targets
    if none:
        # no keys: an empty result with the table's columns (the filter is
        # sent to the database, so no rows are read)
        targets = {(0, 0): set()}

    def read(target) -> DataFrame:
        (tb, db), own = target
        url, name = url_for_db(int(db)), f"{table}_{tb}"
        opts = jdbc_options(url, **access)
        if none or not pushed:
            df = spark.read.format("jdbc").options(**opts, dbtable=name).load()
            return df.where(F.lit(False)) if none else df
        with Connection(spark, url, **access) as c:
            column, kind = next((n, t) for n, t in c.column_types(name).items() if n.lower() == key.lower())
            conditions = _key_conditions(c, column, kind == _CLOB, sorted(own), chunk)
        opts.pop("url")
        return spark.read.jdbc(url, name, predicates=conditions, properties=opts)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        parts = list(pool.map(read, sorted(targets.items())))
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    if pushed and not routed:
        return rows
    # a database holds rows of other pairs of its keys as well
    same = rows[key].cast("string") == k[key]
    if routed:
        same = same & (rows[layout.db_key].cast("string") == k[layout.db_key])
    return rows.join(bounded_broadcast(k), same, "left_semi")


# ------------------------------------------------------------ written-once layouts
LAYOUT_FILE = "layout.json"


def source_version(spark: SparkSession, df: DataFrame, *parts) -> str:
    """A digest of the files that df reads (name, size, time of change), its plan's shape and further parts."""
    import hashlib
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    digest = hashlib.sha256(repr((df.schema.json(), parts)).encode())
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for name in sorted(df.inputFiles()):
        path = path_of(spark.sparkContext._jvm.java.net.URI(name))
        status = path.getFileSystem(conf).getFileStatus(path)
        digest.update(f"{name},{status.getLen()},{status.getModificationTime()};".encode())
    return digest.hexdigest()[:20]


def layouts_folder(spark: SparkSession) -> str:
    """Where layouts are kept: ``scorekeep.layouts.dir``, else a folder beside the shared scratch folder's files."""
    from scorekeep.session import ensure_checkpoint_dir
    return spark.conf.get("scorekeep.layouts.dir", None) or f"{ensure_checkpoint_dir(spark).rstrip('/')}/layouts"


def kept_layout(spark: SparkSession, name: str, df: DataFrame, version: str, write) -> str:
    """Path of the layout of this name and version, written by ``write(path)`` if it is not there yet.

    A layout counts once its metadata file is there; what a failed writer left is in another folder and is not
    seen.  Versions of changed sources get their own folders; ``drop_layouts`` deletes old ones."""
    import json
    import uuid

    from scorekeep.plans.publish import Folder
    base = Folder(spark, f"{layouts_folder(spark)}/{name}-{version}")
    if not base.exists(LAYOUT_FILE):
        own = f"data-{uuid.uuid4().hex}"
        write(f"{base.root}/{own}")
        base.write(LAYOUT_FILE, json.dumps({"data": own, "columns": df.columns}))
    return f"{base.root}/{json.loads(base.read(LAYOUT_FILE))['data']}"


def sharded_layout(df: DataFrame, name: str, layout: ShardLayout) -> str:
    """Path of df as a sharded layout, written once for each state of its source files."""
    spark = df.sparkSession
    version = source_version(spark, df, layout.db_key, layout.tb_key, layout.n_db, layout.n_tb)
    return kept_layout(spark, name, df, version, lambda path: write_sharded(df, path, layout, "error"))


def bucketed_layout(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """df as a catalog table bucketed on key, written once for each state of its source files."""
    from scorekeep.sinks.tables import create_table
    spark = df.sparkSession
    version = source_version(spark, df, key, buckets)
    table = f"{name}_{version}"

    def write(path):
        write_bucketed(df, f"{table}_new", path, key, buckets, "error")
        spark.sql(f"DROP TABLE {table}_new")   # external: the files stay

    path = kept_layout(spark, name, df, version, write)
    if not spark.catalog.tableExists(table):
        create_table(spark, table, df.dtypes, path, clustered_by=(key, buckets))
    return spark.table(table)


def drop_layouts(spark: SparkSession, keep: list[str] = ()) -> list[str]:
    """Delete all layouts but those whose folder names are given; returns the deleted names."""
    from scorekeep.plans.publish import Folder
    folder = Folder(spark, layouts_folder(spark))
    gone = [n for n in folder.folders() if n not in keep]
    for n in gone:
        folder.delete(n)
    return gone
