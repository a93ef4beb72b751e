"""Size-checked joins against key sets.

A semi / anti join of a large table against a key set is broadcast only after the
key set's size is *checked*: rows and bytes are observed by the job that checkpoints the key set into the shared folder
(no extra pass, no single task); beyond the bound it falls back to a shuffled join, where AQE's skew-join handling
splits hot keys.  Broadcasting avoids shuffling the large side at all —
important when the join key is low-cardinality (a handful of practice heads would
otherwise send a fifth of all rows to one reducer each).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rsvpflow.session import checkpoint_root, work_dir

__all__ = ["BROADCAST_MAX_ROWS_CONF", "BROADCAST_MAX_BYTES_CONF", "beyond_broadcast", "fits_broadcast", "key_join", "materialized", "shuffles_dropped",
           "written"]

BROADCAST_MAX_ROWS_CONF = "rsvpflow.broadcast.maxRows"
DEFAULT_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES_CONF = "rsvpflow.broadcast.maxBytes"
DEFAULT_MAX_BYTES = 64 << 20
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _row_bytes(df: DataFrame) -> Column:
    """Size of a row: its texts and binaries, the text of its nested values, and 16 bytes for every column."""
    total = F.lit(16 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            total = total + F.coalesce(F.octet_length(c.cast("string")), F.lit(0))
    return total


def fits_broadcast(keys: DataFrame, max_rows: int | None = None, materialize: bool = True
                   ) -> tuple[DataFrame, bool]:
    """Checkpoint ``keys`` and check that it is within the row and byte bounds.

    Returns the checkpointed frame and the verdict.  Rows and bytes are observed while the key set is written (or,
    for one that is written already, in a pass that keeps nothing); only the two numbers reach the driver.
    """
    conf = keys.sparkSession.conf
    if max_rows is None:
        max_rows = int(conf.get(BROADCAST_MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))
    max_bytes = int(conf.get(BROADCAST_MAX_BYTES_CONF, str(DEFAULT_MAX_BYTES)))
    seen = Observation()
    watched = keys.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(keys)).alias("bytes"))
    if materialize:
        kept = materialized(watched)
    else:
        kept = keys
        watched.write.format("noop").mode("overwrite").save()
    got = seen.get
    return kept, got["n"] <= max_rows and (got["bytes"] or 0) <= max_bytes


def beyond_broadcast(df: DataFrame, key: Sequence[str]) -> bool:
    """Whether ``df`` has by far (twice, of an estimate within a few per cent) more distinct keys than a key set may have to be
    broadcast: seen by one pass over the key columns that keeps nothing."""
    most = int(df.sparkSession.conf.get(BROADCAST_MAX_ROWS_CONF, str(DEFAULT_MAX_ROWS)))
    with shuffles_dropped(df.sparkSession):
        about = df.agg(F.approx_count_distinct(F.xxhash64(*[F.col(k) for k in key]), 0.02).alias("n"))
        return about.first()["n"] > 2 * most


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Plans made in here delete their shuffle files when an action on them ends: for what is computed once and kept elsewhere.
    By default the files lie on disk as long as the driver holds the plan."""
    before = spark.conf.get(SHUFFLE_CLEANUP_CONF, "false")
    spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def materialized(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder (lineage cut; survives executor loss); its shuffle files go."""
    checkpoint_root(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once into Parquet files under the shared checkpoint folder, as ``materialized``: for wide rows, which take
    a fraction of a checkpoint's bytes by columns and are read again by a few of them."""
    path = work_dir(df.sparkSession, "rows")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def key_join(big: DataFrame, keys: DataFrame, on: Column | Sequence[str] | str, how: str = "left_semi",
             max_rows: int | None = None, materialize: bool = True) -> DataFrame:
    """``big`` semi/anti/inner-joined with a key set, broadcasting the key set only when its
    size is checked to be within bound.  ``materialize=False`` when ``keys`` already reads
    from a checkpoint / written table."""
    kept, small = fits_broadcast(keys, max_rows, materialize)
    out = big.join(F.broadcast(kept) if small else kept, on, how)
    # a USING join moves the key columns first; keep the large side's column order
    return out.select(*[big[c] for c in big.columns]) if how in ("left_semi", "left_anti") else out
