"""Streaming jobs.

* T1 ``start_change_stream`` / ``stream_apply_changes``: master rows arrive as a file stream; each row's change
  events are generated in-stream (narrow), and every micro-batch appends what it changed to a delta table
  (``deltas.py``), which is merged on read by the largest ``seq`` of an id and compacted every few batches.
* T3 ``stream_reports_on_changes``: reports that follow inserts, updates and deletes of the feed (``views.py``).
* T3 ``stream_invite_trend``: the daily invite trend kept up to date by a streaming aggregation in complete mode;
  ``stream_invite_trend_windowed``: the same with a watermark and one-day windows, so that state is bounded by the
  watermark and a trigger writes only the days that changed.
* T2/T4: ``trigger`` is a parameter (``processingTime="60 seconds"`` in service, where ``start_change_stream`` returns
  the running ``StreamingQuery``; ``availableNow`` in tests); a replayed batch rewrites its own folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rsvpflow.functions.scalars import parse_date
from rsvpflow.operators import contacts as C
from rsvpflow.operators import reports as R
from rsvpflow.operators.grain import reports_from
from rsvpflow.operators.joins import materialized
from rsvpflow.plans import fixtures as X
from rsvpflow.session import work_dir
from rsvpflow.sources.tables import path_exists, read_table
from rsvpflow.streaming.deltas import append_changes, change_counts, compact, current_contacts
from rsvpflow.streaming.views import current_grain, start_report_stream


def stream_table(spark: SparkSession, base: str, name: str, files_per_trigger: int = 1) -> DataFrame:
    """A parquet table as a file stream."""
    schema = read_table(spark, base, name).schema
    # a glob of this one name: a file and a folder of files are both found, ``<name>_old.parquet`` is not
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
            .parquet(f"{base.rstrip('/')}/{{{name}}}.parquet"))


def streaming_master(spark: SparkSession, base: str) -> DataFrame:
    """Master fixture over streaming orders (stream–static joins to customer and nation)."""
    return X.master_from(spark, stream_table(spark, base, "orders"), read_table(spark, base, "customer"),
                         read_table(spark, base, "nation"))


def _run(query_builder, root: str, trigger: dict) -> None:
    q = query_builder.option("checkpointLocation", f"{root}/_checkpoint").trigger(**trigger).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def _write_snapshot(spark: SparkSession, batch: DataFrame, folder: str, batch_id: int) -> None:
    """Write ``v=<batchId>`` and remove all but it and the one before (a reader may still hold that)."""
    batch.write.mode("overwrite").parquet(f"{folder}/v={batch_id}")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(conf)
    for st in fs.listStatus(root):
        name = st.getPath().getName()
        if name.startswith("v=") and int(name[2:]) < batch_id - 1:
            fs.delete(st.getPath(), True)


def _latest(spark: SparkSession, root: str, schema) -> DataFrame:
    """The newest snapshot, empty when no batch has come (driver-side listing of folder names only)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root}/snapshots")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(path) if fs.exists(path) else []
    versions = [int(st.getPath().getName()[2:]) for st in found if st.getPath().getName().startswith("v=")]
    return spark.read.parquet(f"{root}/snapshots/v={max(versions)}") if versions else spark.createDataFrame([], schema)


def start_change_stream(spark: SparkSession, events: DataFrame, root: str, trigger: dict | None = None,
                        compact_every: int = 50) -> StreamingQuery:
    """Apply a streaming change feed ``(seq, op, id, old, new)`` to the delta table ``<root>/table``.

    Returns the running query; by default it triggers every 60 seconds until it is stopped.  Work per trigger follows
    the batch; every ``compact_every`` batches the deltas are merged into the base.
    """
    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        append_changes(spark, f"{root}/table", batch, batch_id)
        if batch_id % compact_every == compact_every - 1:
            compact(spark, f"{root}/table", batch_id)

    return (events.writeStream.foreachBatch(apply_batch).option("checkpointLocation", f"{root}/_checkpoint")
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())


def stream_apply_changes(spark: SparkSession, base: str, events: DataFrame | None = None, compact_every: int = 50) -> DataFrame:
    """All changes that are there now, applied in micro-batches; returns the contacts table."""
    root = work_dir(spark, "stream-changes")
    feed = X.change_feed(streaming_master(spark, base)) if events is None else events
    q = start_change_stream(spark, feed, root, {"availableNow": True}, compact_every)
    q.awaitTermination()
    return current_contacts(spark, f"{root}/table")


def stream_change_counts(spark: SparkSession, events: DataFrame) -> DataFrame:
    """M12 under T1: per role and action the events of a timed feed, from the counts kept beside the batches."""
    root = work_dir(spark, "stream-counts")
    start_change_stream(spark, events, root, {"availableNow": True}, 2).awaitTermination()
    return change_counts(spark, f"{root}/table").groupBy("role", "action").agg(F.sum("row_count").alias("row_count"))


def stream_reports_on_changes(spark: SparkSession, events: DataFrame, compact_every: int = 50) -> dict[str, DataFrame]:
    """T3 under a change feed: the reports after all changes that are there now, updates and deletes followed."""
    root = work_dir(spark, "stream-reports")
    start_report_stream(spark, events, root, {"availableNow": True}, compact_every).awaitTermination()
    return reports_from(materialized(current_grain(spark, f"{root}/grain")), cascade=False)  # added up once for all reports


def stream_invite_trend_windowed(spark: SparkSession, base: str, delay: str = "36500 days", master: DataFrame | None = None) -> DataFrame:
    """Invites per day with a watermark and one-day windows (update mode).

    State is one counter per day not older than ``delay`` before the latest invite; a row that comes later than that is
    dropped by the watermark, as is its purpose.  ``master`` is a streaming master other than that of ``base``.  Each trigger writes the days it changed to ``b=<batchId>``; of a
    day's rows the one of the last batch counts.
    """
    root = work_dir(spark, "stream-trend-windowed")
    days = C.standardize_master(streaming_master(spark, base) if master is None else master).select(parse_date("Invite_Dt").cast("timestamp").alias("ts"))
    counted = (days.filter("ts is not null").withWatermark("ts", delay).groupBy(F.window("ts", "1 day"))
               .agg(F.count(F.lit(1)).alias("invites")).select(F.to_date("window.start").alias("invite_date"), "invites"))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(f"{root}/days/b={batch_id}")

    _run(counted.writeStream.outputMode("update").foreachBatch(write_batch), root, {"availableNow": True})
    if not path_exists(spark, f"{root}/days"):
        return spark.createDataFrame([], counted.schema)
    rows = spark.read.parquet(f"{root}/days/b=*")
    return rows.groupBy("invite_date").agg(F.max_by("invites", "batch").alias("invites"))


def stream_report(spark: SparkSession, base: str, report, trigger: dict | None = None,
                  source: str = "master") -> DataFrame:
    """Any aggregate report of ``operators.reports`` over the streaming master
    (``source="master"``) or its streaming contact fan-out (``source="contacts"``), kept current
    in complete mode; each trigger writes snapshot ``v=<batchId>``.  State is one row per report
    group (a handful for the KPI, distribution and region reports)."""
    root = work_dir(spark, "stream-report")
    sm = streaming_master(spark, base)
    agg = report(C.standardize_master(sm) if source == "master" else C.standardize_contacts(C.fan_out(sm)))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _write_snapshot(spark, batch, f"{root}/snapshots", batch_id)

    _run(agg.writeStream.outputMode("complete").foreachBatch(write_batch), root, trigger or {"availableNow": True})
    return _latest(spark, root, agg.schema)


def stream_invite_trend(spark: SparkSession, base: str, trigger: dict | None = None) -> DataFrame:
    """Streaming daily invite trend (complete mode; state bounded by the number of days)."""
    root = work_dir(spark, "stream-trend")
    trend = R.invite_trend(C.standardize_master(streaming_master(spark, base)))

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        _write_snapshot(spark, batch, f"{root}/snapshots", batch_id)

    _run(trend.writeStream.outputMode("complete").foreachBatch(write_batch), root,
         trigger or {"availableNow": True})
    return _latest(spark, root, trend.schema)
