"""The contacts table as change deltas: appended per batch, merged on read, compacted now and then.

    <table>/delta/b=<batch>   one row per changed master id: (id, seq, contacts array), with audit marks of a timed feed
    <table>/base/v=<batch>    everything up to that batch, one row per id, clustered by id
    <table>/counts/b=<batch>  what the batch did (role, action, row_count), for a timed feed

An id's row holds the fan-out of its NEW image, or no contacts after a delete (a tombstone).  The row with the largest
``seq`` counts, so events may arrive in any order and in any batch, and a batch that is replayed or retried overwrites
its own folder.  A batch writes what it changed and nothing else; only compaction rewrites the table, sorted by id into
as many parts as its size asks for (no bucket count to outgrow), and leaves the state before it for open readers.

A feed with a ``ts`` column is *timed* (M10, M12).  Its events say by their images what they do to each contact: it
appears, goes, changes or stays.  The last appearance and the last appearance or change, each with its ``seq``, are carried
in the delta rows and merged by the larger ``seq``: the insert and update time of a contact, whatever order the events come
in.  The counts are observed in the stage that writes the delta, behind its shuffle, and so taken once per batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rsvpflow.operators.audit import contact_rows, count_columns, time_columns, timed_rows
from rsvpflow.operators.merge import keep_per_key
from rsvpflow.roles import CONTACT_COLS, ROLE_ORDER

__all__ = ["delta_rows", "append_changes", "change_counts", "completed", "current_contacts", "compact", "drop_replaced"]


def delta_rows(changes: DataFrame, roles: Sequence[str] = ROLE_ORDER) -> DataFrame:
    """(id, seq, contacts): the last event of each id in a batch of changes."""
    return contact_rows(keep_per_key(changes.select("seq", "op", "id", "new"), "id", "seq", "last", null_safe=True), roles)


def _numbers(spark: SparkSession, path: str, prefix: str, done: bool = False) -> list[int]:
    """Numbers of the folders ``<prefix><n>`` (names only); with ``done`` those whose write was completed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith(prefix)]
    return sorted(int(p.getName()[len(prefix):]) for p in found
                  if not done or fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))


def append_changes(spark: SparkSession, table: str, changes: DataFrame, batch_id: int, roles: Sequence[str] = ROLE_ORDER) -> None:
    """Write one batch of changes (and of a timed one the counts); the same batch again replaces itself."""
    table = table.rstrip("/")
    if "ts" not in changes.columns:
        delta_rows(changes, roles).write.mode("overwrite").parquet(f"{table}/delta/b={batch_id}")
        return
    names = count_columns(roles)
    seen = Observation()
    rows = timed_rows(changes, roles).observe(seen, *[F.sum(n).alias(n) for _, _, n in names])
    rows.drop(*[n for _, _, n in names]).write.mode("overwrite").parquet(f"{table}/delta/b={batch_id}")
    got = seen.get
    counts = spark.createDataFrame([(r, k, int(got[n] or 0)) for r, k, n in names], "role string, action string, row_count long")
    counts.coalesce(1).write.mode("overwrite").parquet(f"{table}/counts/b={batch_id}")


def change_counts(spark: SparkSession, table: str) -> DataFrame:
    """(batch, role, action, row_count) of the batches written so far."""
    table = table.rstrip("/")
    out = spark.createDataFrame([], "batch long, role string, action string, row_count long")
    paths = [f"{table}/counts/b={b}" for b in _numbers(spark, f"{table}/counts", "b=", done=True)]
    if not paths:
        return out
    got = spark.read.option("basePath", f"{table}/counts").parquet(*paths)
    return got.select(F.col("b").cast("long").alias("batch"), "role", "action", "row_count")


def completed(spark: SparkSession, table: str, upto: int | None = None) -> tuple[list[str], int]:
    """Folders that make up the table now (the newest base and the deltas after it), and the number of the last."""
    table = table.rstrip("/")
    bases = _numbers(spark, f"{table}/base", "v=", done=True)
    base = bases[-1] if bases else -1
    deltas = [b for b in _numbers(spark, f"{table}/delta", "b=", done=True) if b > base and (upto is None or b <= upto)]
    return ([f"{table}/base/v={base}"] if bases else []) + [f"{table}/delta/b={b}" for b in deltas], max([base, *deltas])


def drop_replaced(spark: SparkSession, table: str, number: int) -> None:
    """Remove what the base *before* ``number`` has replaced.  That base and the deltas after it stay: a reader may have
    taken them up before base ``number`` was there."""
    table = table.rstrip("/")
    before = [n for n in _numbers(spark, f"{table}/base", "v=", done=True) if n < number]
    if not before:
        return
    jvm = spark.sparkContext._jvm
    old = [f"{table}/base/v={n}" for n in _numbers(spark, f"{table}/base", "v=") if n < before[-1]]
    old += [f"{table}/delta/b={n}" for n in _numbers(spark, f"{table}/delta", "b=") if n <= before[-1]]
    for path in old:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _merged(spark: SparkSession, table: str, upto: int | None = None) -> tuple[DataFrame | None, int]:
    paths, number = completed(spark, table, upto)
    if not paths:
        return None, number
    rows = spark.read.parquet(*paths)
    if len(paths) == 1:
        return rows, number
    marks = [c for c in rows.columns if c[:4] in ("ins_", "upd_")]
    if not marks:
        return keep_per_key(rows, "id", "seq", "last", null_safe=True), number
    g = rows.groupBy("id").agg(F.max("seq").alias("seq"), F.max_by("contacts", "seq").alias("contacts"), *[F.max(c).alias(c) for c in marks])
    return g, number


def current_contacts(spark: SparkSession, table: str) -> DataFrame:
    """The long contacts table as of the batches written so far; of a timed feed with Data_Insert_Time and Last_Updated;
    empty before the first batch."""
    rows, _ = _merged(spark, table)
    if rows is None:
        return spark.createDataFrame([], ", ".join(f"{c} {'long' if c == 'id' else 'string'}" for c in CONTACT_COLS))
    roles = [c[4:] for c in rows.columns if c.startswith("ins_")]
    times = time_columns(roles) if roles else []
    marks = [F.col(f"{k}_{r}") for r in roles for k in ("ins", "upd")]
    return rows.select(F.explode("contacts").alias("c"), *marks).select(*[F.col(f"c.{c}").alias(c) for c in CONTACT_COLS], *times)


def compact(spark: SparkSession, table: str, upto: int | None = None) -> int:
    """Merge base and deltas into a new base; returns its number.

    Readers take the newest completed base, so a failure on the way leaves the table whole, and what the table was made of
    before stays until the next compaction (``drop_replaced``).  Tombstones stay: an older event of a deleted id may still
    arrive.
    """
    table = table.rstrip("/")
    rows, number = _merged(spark, table, upto)
    if rows is None or number in _numbers(spark, f"{table}/base", "v=", done=True):
        return number
    rows.repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{table}/base/v={number}")
    drop_replaced(spark, table, number)
    return number
