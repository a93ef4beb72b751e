"""Order-dependent folds of a key's rows without one task that sorts them all.

Rows are dealt over range partitions by (key, order) and written once; a key with many rows then lies in several
neighbouring partitions.  A fold is taken per (key, partition) first, and over the few results of a key's partitions next:
running counts as offsets plus local counts, "the next event" as the first one behind in the own or a later partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rsvpflow.operators.joins import materialized

__all__ = ["PART", "ranged", "running_count", "next_value"]

PART = "__part"


def ranged(df: DataFrame, *order: str) -> DataFrame:
    """``df`` over range partitions in ``order``, computed once, with the partition's number ``PART``.  Rows that are equal
    in ``order`` lie in one partition."""
    return materialized(df.repartitionByRange(*order).withColumn(PART, F.spark_partition_id()))


def running_count(rows: DataFrame, key: Sequence[str], order: Sequence[str], flag: Column, name: str) -> DataFrame:
    """``ranged`` rows with the number of flagged rows of the key up to each row, itself included (``key`` not NULL)."""
    key = list(key)
    marked = rows.withColumn("__flag", flag.cast("bigint"))
    local = F.sum("__flag").over(Window.partitionBy(*key, PART).orderBy(*order))
    counts = marked.groupBy(*key, PART).agg(F.sum("__flag").alias("__c"))
    before = F.sum("__c").over(Window.partitionBy(*key).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select(*key, PART, F.coalesce(before, F.lit(0)).alias("__before"))
    j = marked.withColumn("__local", local).join(offsets, [*key, PART])
    return j.select(*rows.columns, (F.col("__local") + F.col("__before")).alias(name))


def next_value(rows: DataFrame, key: Sequence[str], order: str, value: Column, name: str) -> DataFrame:
    """``ranged`` rows with the first non-NULL ``value`` of the key at a strictly larger ``order`` (``key`` not NULL)."""
    key = list(key)
    marked = rows.withColumn("__v", value)
    behind = Window.partitionBy(*key, PART).orderBy(order).rangeBetween(1, Window.unboundedFollowing)
    firsts = marked.groupBy(*key, PART).agg(F.min_by("__v", F.when(F.col("__v").isNotNull(), F.col(order))).alias("__first"))
    later = F.first("__first", ignorenulls=True).over(Window.partitionBy(*key).orderBy(PART).rowsBetween(1, Window.unboundedFollowing))
    carried = firsts.select(*key, PART, later.alias("__later"))
    j = marked.withColumn("__own", F.first("__v", ignorenulls=True).over(behind)).join(carried, [*key, PART])
    return j.select(*rows.columns, F.coalesce("__own", "__later").alias(name))
