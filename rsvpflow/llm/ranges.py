"""Global order without one sorting task: range partitions in key order, written once, numbered by the sums of their counts.

``ranged`` writes the rows in key order over range partitions and says of each row in which partition and at which place
it lies; ``numbered`` adds the place within a group (and the group's size) from the counts of (partition, group);
``placed`` deals written rows, with others that belong to a partition, back to one task per partition, in order.
Everything goes through tables in the shared folder, so a lost executor repeats reads, not shuffles of changed order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rsvpflow.operators.joins import fits_broadcast
from rsvpflow.session import work_dir

_PLACE = (1 << 33) - 1


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a folder of its own below the shared one, and read from there."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranged(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows of ``df`` in ``order`` over range partitions, with ``part`` and ``at`` (place in the partition), written.

    ``df`` is written first with a number per row that ends the order: the partitioner's sample does not compute it twice,
    and equal rows, however many, are spread over partitions.
    """
    rows = stored(df.withColumn("tie", F.monotonically_increasing_id()), name)
    keys = [*order, F.col("tie").asc()]
    out = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stored(out.select(*df.columns, F.spark_partition_id().alias("part"),
                             F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("at")), f"{name}-ranged")


def numbered(rows: DataFrame, group: str) -> DataFrame:
    """``ranged`` rows with ``pos`` (0, 1, ... within ``group``, which leads their order) and ``n``, the group's size.

    The running sums are taken over one row per (partition, group); a group has at most one row a partition there.
    """
    counts = rows.groupBy("part", group).agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("first"))
    whole = Window.partitionBy(group)
    before = F.sum("m").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.select(F.col("part").alias("_p"), F.col(group).alias("_g"), (F.coalesce(before, F.lit(0)) - F.col("first")).alias("_s"),
                          F.sum("m").over(whole).alias("n"))
    kept, small = fits_broadcast(shift)
    j = rows.join(F.broadcast(kept) if small else kept, (F.col("part") == F.col("_p")) & (F.col(group) == F.col("_g")))
    return j.withColumn("pos", F.col("at") + F.col("_s")).drop("_p", "_g", "_s")


def placed(rows: DataFrame, like: DataFrame, *order: str) -> DataFrame:
    """One task per value of ``part`` in the table ``like`` (0, 1, ...), each value's rows sorted by ``order``."""
    last = like.agg(F.max("part")).first()[0]
    return rows.repartitionById((last or 0) + 1, F.col("part").cast("int")).sortWithinPartitions("part", *order)
