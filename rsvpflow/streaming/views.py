"""Reports that follow a change feed: signed grains, appended per batch and added up on read (T3 over T1).

    <table>/delta/b=<batch>   the batch's signed grain: what its OLD images take away and its NEW images add
    <table>/base/v=<batch>    the sum of everything up to that batch

A change ``(seq, op, id, old, new)`` subtracts the group values of its OLD image and adds those of its NEW image, so no row
is ever looked up and events may come in any order (an update before its insert leaves negative counts until that has
come).  Work and output of a batch follow its events; a replayed batch replaces its own folder, so nothing counts twice.
An event that a *later* batch delivers again would: the feed's source has to hand out each event once, as file and log
sources do under a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rsvpflow.operators.contacts import standardize_master
from rsvpflow.operators.grain import DIMS, MEASURES, image_rows, merged
from rsvpflow.streaming.deltas import completed, drop_replaced

__all__ = ["signed_grain", "append_signed", "current_grain", "compact_grain", "start_report_stream"]


def signed_grain(changes: DataFrame) -> DataFrame:
    """The grain that a batch of changes adds to the reports' grain."""
    images = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))
    rows = changes.select(F.explode(images).alias("i")).filter("i.row is not null").select(F.col("i.sign").alias("__sign"), "i.row.*")
    return merged(image_rows(standardize_master(rows), sign=F.col("__sign")))


def append_signed(spark: SparkSession, table: str, changes: DataFrame, batch_id: int) -> None:
    """Write one batch's signed grain; the same batch again replaces itself."""
    signed_grain(changes).write.mode("overwrite").parquet(f"{table.rstrip('/')}/delta/b={batch_id}")


def current_grain(spark: SparkSession, table: str) -> DataFrame:
    """The grain after the batches written so far; empty before the first."""
    paths, _ = completed(spark, table)
    if not paths:
        text, day = ("string", "date")
        return spark.createDataFrame([], ", ".join([f"{d} {day if d == 'day' else text}" for d in DIMS] + [f"{m} long" for m in MEASURES]))
    return merged(spark.read.parquet(*paths))


def compact_grain(spark: SparkSession, table: str, upto: int | None = None) -> int:
    """Add base and deltas up into a new base; what the one before it was made of goes."""
    paths, number = completed(spark, table, upto)
    if len(paths) > 1:
        merged(spark.read.parquet(*paths)).write.mode("overwrite").parquet(f"{table.rstrip('/')}/base/v={number}")
        drop_replaced(spark, table, number)
    return number


def start_report_stream(spark: SparkSession, events: DataFrame, root: str, trigger: dict | None = None, compact_every: int = 50) -> StreamingQuery:
    """Keep ``<root>/grain`` current under a streaming change feed; reports are ``grain.reports_from(current_grain(...))``."""
    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        append_signed(spark, f"{root}/grain", batch, batch_id)
        if batch_id % compact_every == compact_every - 1:
            compact_grain(spark, f"{root}/grain", batch_id)

    return (events.writeStream.foreachBatch(apply_batch).option("checkpointLocation", f"{root}/_checkpoint")
            .trigger(**(trigger or {"processingTime": "60 seconds"})).start())
