"""Activity features over an event log that goes on arriving.

Each micro-batch of new event files is reduced to slot partials (per user, date,
day number, hour, type: counts and sums). The state of all earlier batches is a
snapshot of merged slots in buckets of users; ``compact`` merges the batches
that it does not hold yet, bucket by bucket, and publishes the next version. So
a run reads one snapshot and the new batches only, whatever came before.

Folders of a state::

    deltas/batch=<id>/bucket=<b>/   partials of a micro-batch not yet merged
    slots/version=<v>/bucket=<b>/   merged slots, of the buckets that v changed
    versions/version=<v>/           which version holds each bucket, and the
                                    last batch merged; valid once written whole
    checkpoint/                     the stream's own

A replayed batch overwrites its folder, or is left out if the snapshot holds it
already; a compaction that dies leaves the version before it in force, and its
successor writes the same folders again. Only what no valid version names is
deleted.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapse.operators.materialize import landing_root
from lapse.operators.spine import USER_KEY
from lapse.plans.activity import activity_from_slots, activity_slots, merge_slots

BUCKETS = 16
_VERSION = "bucket int, holder long, last_batch long"


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _children(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """Number -> folder of the subfolders ``<prefix><number>``."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return {}
    names = [s.getPath().getName() for s in fs.listStatus(where) if s.isDirectory()]
    return {int(n.removeprefix(prefix)): f"{path}/{n}" for n in names if n.startswith(prefix)}


def _remove(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.getFileStatus(where).isDirectory()


@dataclass(frozen=True)
class Version:
    """A published snapshot: which version's folder holds each bucket."""

    number: int
    holders: dict[int, int]
    last_batch: int


def current(spark: SparkSession, state: str) -> Version:
    """The last version written whole (0: nothing merged yet)."""
    done = {v: p for v, p in _children(spark, f"{state}/versions", "version=").items() if _exists(spark, f"{p}/_SUCCESS")}
    if not done:
        return Version(0, {}, -1)
    number = max(done)
    rows = spark.read.schema(_VERSION).parquet(done[number]).collect()
    return Version(number, {r["bucket"]: r["holder"] for r in rows if r["bucket"] >= 0}, rows[0]["last_batch"])


def _bucket() -> F.Column:
    return F.pmod(F.xxhash64(*USER_KEY), F.lit(BUCKETS)).cast("int")


def _write_slots(slots: DataFrame, path: str) -> None:
    dealt = slots.withColumn("bucket", _bucket()).repartition("bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def land_batch(batch: DataFrame, batch_id: int, state: str, calendar: bool = False) -> bool:
    """Slot partials of one micro-batch, in its own folder; nothing if the
    snapshot holds the batch already."""
    if batch_id <= current(batch.sparkSession, state).last_batch:
        return False
    _write_slots(activity_slots(batch, calendar), f"{state}/deltas/batch={batch_id}")
    return True


def _slot_schema(spark: SparkSession, paths: list[str]) -> T.StructType:
    return T.StructType([f for f in spark.read.parquet(*paths).schema.fields if f.name not in ("bucket", "batch", "version")])


def _read_buckets(spark: SparkSession, state: str, version: Version, buckets=None) -> DataFrame | None:
    """Merged slots of a version, of some buckets or all."""
    paths = [f"{state}/slots/version={v}/bucket={b}" for b, v in sorted(version.holders.items()) if buckets is None or b in buckets]
    return spark.read.schema(_slot_schema(spark, paths[:1])).parquet(*paths) if paths else None


def compact(spark: SparkSession, state: str) -> Version:
    """Merge the batches that the snapshot lacks and publish the next version.

    Only buckets that these batches touch are read and rewritten; the others
    stay where they are. Folders that the new version does not name go.
    """
    version = current(spark, state)
    deltas = _children(spark, f"{state}/deltas", "batch=")
    fresh = {b: p for b, p in deltas.items() if b > version.last_batch and _exists(spark, f"{p}/_SUCCESS")}
    if not fresh:
        return version
    touched = {b for p in fresh.values() for b in _children(spark, p, "bucket=")}
    number = version.number + 1
    if touched:
        paths = [f"{p}/bucket={b}" for p in fresh.values() for b in _children(spark, p, "bucket=")]
        new = spark.read.schema(_slot_schema(spark, paths[:1])).parquet(*paths)
        old = _read_buckets(spark, state, version, touched)
        _write_slots(merge_slots(new if old is None else old.unionByName(new)), f"{state}/slots/version={number}")
    holders = {**version.holders, **dict.fromkeys(touched, number)}
    after = Version(number, holders, max(fresh))
    # A row of its own says which batch was merged last, also if no slot exists.
    rows = [(-1, number, after.last_batch), *((b, v, after.last_batch) for b, v in sorted(holders.items()))]
    spark.createDataFrame(rows, _VERSION).coalesce(1).write.mode("overwrite").parquet(f"{state}/versions/version={number}")
    _clean(spark, state, after)
    return after


def _clean(spark: SparkSession, state: str, version: Version) -> None:
    """Delete merged batches, older versions' lists, and replaced buckets."""
    for batch, path in _children(spark, f"{state}/deltas", "batch=").items():
        if batch <= version.last_batch:
            _remove(spark, path)
    for number, path in _children(spark, f"{state}/versions", "version=").items():
        if number < version.number:
            _remove(spark, path)
    for number, path in _children(spark, f"{state}/slots", "version=").items():
        held = _children(spark, path, "bucket=")
        kept = {b for b in held if version.holders.get(b) == number}
        if not kept:
            _remove(spark, path)
        for b in held.keys() - kept if kept else ():
            _remove(spark, held[b])


def merged_slots(spark: SparkSession, state: str) -> DataFrame | None:
    """All merged slots, from one snapshot; None before the first event."""
    return _read_buckets(spark, state, current(spark, state))


def slot_partials_stream(
    spark: SparkSession,
    events_path: str,
    schema,
    state: str,
    view: Callable[[DataFrame], DataFrame] | None = None,
    calendar: bool = False,
):
    """Start the streaming query that lands slot partials per micro-batch.

    A micro-batch takes all files that have arrived since the last one.
    ``view`` maps the stream to the usage-event columns.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        land_batch(batch, batch_id, state, calendar)

    folder, name = events_path.rstrip("/").rsplit("/", 1)
    reader = spark.readStream.schema(schema)
    if is_folder(spark, events_path):
        stream = reader.parquet(events_path)
    else:  # a stream reads folders: one file of a folder by its name
        stream = reader.option("pathGlobFilter", name).parquet(folder)
    stream = view(stream) if view else stream
    return (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", f"{state}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )


def advance(
    spark: SparkSession, events_path: str, schema, state: str, view: Callable[[DataFrame], DataFrame] | None = None, calendar: bool = False
) -> Version:
    """Take in all event files that have arrived since the last call."""
    slot_partials_stream(spark, events_path, schema, state, view, calendar).awaitTermination()
    return compact(spark, state)


def new_state(spark: SparkSession, name: str = "activity-stream") -> str:
    """A folder for a state among this application's landed tables; a state
    that outlives applications lies wherever its owner puts it."""
    return f"{landing_root(spark)}/{name}-{uuid.uuid4().hex}"


def activity_incremental(
    spark: SparkSession, events_path: str, users: DataFrame, schema, state: str | None = None,
    view: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Advance the state (default: a new one) by all new event files, and the
    user features of all events so far."""
    state = state or new_state(spark)
    advance(spark, events_path, schema, state, view)
    slots = merged_slots(spark, state)
    if slots is None:
        events = spark.createDataFrame([], schema)
        slots = activity_slots(view(events) if view else events)
    return activity_from_slots(slots, users)
