"""Land an intermediate table in the shared folder and read it back."""

from __future__ import annotations

import contextlib
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapse.session import shared_dir

# Called with (name, DataFrame) before a table is landed, by plan reports and
# tests that look at the landing jobs.
observers: list = []

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def _shuffle_cleanup(spark: SparkSession):
    """Plans built inside drop their shuffle files when their query ends."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def landing_root(spark: SparkSession) -> str:
    """The folder of this application's landed tables."""
    return f"{shared_dir(spark)}/lapse-tables/{spark.sparkContext.applicationId}"


def land(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet under the shared folder and return a scan of it.

    Used where a reduced table feeds several branches of a plan: the
    branches then read the landed table instead of each recomputing it from
    the (much larger) source, and a lost executor re-reads it instead of
    replaying the lineage. Every call writes a fresh folder, so DataFrames
    built earlier keep reading their own copy. The shuffle files of the
    writing query go as soon as it has ended. ``compression``: the codec, for
    tables of long texts (default: the session's).
    """
    spark = df.sparkSession
    path = f"{landing_root(spark)}/{name}-{uuid.uuid4().hex}"
    for observer in observers:
        observer(name, df)
    with _shuffle_cleanup(spark):
        writer = df.select("*").write.mode("overwrite")
        (writer.option("compression", compression) if compression else writer).parquet(path)
    # The schema is known; reading it back needs no footer inference.
    out = spark.read.schema(df.schema).parquet(path)
    out.landed_path = path
    return out


def land_bucketed(df: DataFrame, name: str, keys, buckets: int | None = None) -> DataFrame:
    """``land``, in buckets of ``keys``: rows of a key lie in one file, sorted.

    Scans of tables bucketed alike keep that partitioning, so aggregations and
    joins on the keys need no exchange, however often the tables are read. The
    rows are dealt once, here. ``buckets``: default the session's shuffle
    partitions, so tables of one session fit together.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    unique = uuid.uuid4().hex
    path, table = f"{landing_root(spark)}/{name}-{unique}", f"lapse_{name.replace('-', '_')}_{unique}"
    dealt = df.repartition(n, *keys)
    for observer in observers:
        observer(name, dealt)
    with _shuffle_cleanup(spark):
        dealt.write.mode("overwrite").bucketBy(n, *keys).sortBy(*keys).format("parquet").option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.landed_path, out.landed_table = path, table
    return out


def land_all(tables: list[tuple[DataFrame, str]]) -> list[DataFrame]:
    """``land`` several independent tables, their jobs submitted concurrently."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        return list(pool.map(lambda t: land(*t), tables))


def land_all_bucketed(tables: list[tuple[DataFrame, str]], keys) -> list[DataFrame]:
    """``land_bucketed`` several independent tables, their jobs submitted concurrently."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        return list(pool.map(lambda t: land_bucketed(*t, keys), tables))


def join_small(left: DataFrame, right: DataFrame, on, how: str = "left", limit: int = 100_000) -> DataFrame:
    """Join a landed table, broadcast only when it has at most ``limit`` rows;
    beyond that the join is left to the optimizer (shuffle, skew splitting)."""
    if right.limit(limit + 1).count() <= limit:
        right = F.broadcast(right)
    return left.join(right, on, how)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def release(*tables: DataFrame) -> None:
    """Delete landed tables that nothing reads any more."""
    for df in tables:
        if hasattr(df, "landed_table"):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.landed_table}")
        _delete(df.sparkSession, df.landed_path)


def release_all(spark: SparkSession) -> None:
    """Delete every table this application landed; frames built on them end."""
    for table in spark.catalog.listTables(pattern="lapse_*"):
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")
    _delete(spark, landing_root(spark))
