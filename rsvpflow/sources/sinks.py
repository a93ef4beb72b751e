"""Sinks: replica copy (S10), contact-card text files (S11), report export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rsvpflow.operators.bags import _remove, bucket_digests, bucket_of, differing_buckets
from rsvpflow.operators.joins import materialized
from rsvpflow.operators.merge import free_name

__all__ = ["replicate_table", "replicate_changed", "replicate", "write_cards", "export_report"]


def _existing_columns(spark: SparkSession, path: str) -> list[str] | None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return None  # target does not exist yet
    return spark.read.parquet(path).columns


def replicate_table(spark: SparkSession, src: DataFrame, dst_path: str, name: str,
                    exclude: Sequence[str] = ("id",)) -> DataFrame:
    """Copy one table to a replica location.

    * columns = source ∩ existing target columns (all source columns for a new target), minus ``exclude``
    * an empty source leaves the target untouched (status ``skipped_empty``)
    * the copy is a partition-parallel overwrite; an ``Observation`` counts the rows written
      in the same pass, and the copied count is checked against the source count.
    Returns a one-row status DataFrame ``(table_name, status, source_rows, copied_rows)``.
    """
    target_cols = _existing_columns(spark, dst_path)
    cols = [c for c in src.columns if c not in set(exclude) and (target_cols is None or c in target_cols)]
    schema = "table_name string, status string, source_rows bigint, copied_rows bigint"
    if src.isEmpty():  # reads at most one row
        return spark.createDataFrame([(name, "skipped_empty", 0, None)], schema)
    obs = Observation(f"replicate_{name}")
    src.select(*cols).observe(obs, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(dst_path)
    written = obs.get["n"]
    copied = spark.read.parquet(dst_path).count()
    status = "ok" if copied == written else "count_mismatch"
    return spark.createDataFrame([(name, status, int(written), int(copied))], schema)


def _numbers(spark: SparkSession, path: str, prefix: str, mark: str = "") -> list[int]:
    """Numbers of the folders ``<prefix><n>`` (that hold the file ``mark``)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = [st.getPath() for st in fs.listStatus(root) if st.getPath().getName().startswith(prefix)]
    return sorted(int(p.getName()[len(prefix):]) for p in found if not mark or fs.exists(jvm.org.apache.hadoop.fs.Path(p, mark)))


def replicate_changed(spark: SparkSession, src: DataFrame, dst_path: str, name: str, key: Sequence[str], buckets: int = 256, rows_per_file: int = 1 << 20,
                      exclude: Sequence[str] = ("id",)) -> DataFrame:
    """S10, only what differs: the replica lies in ``bucket=<n>`` folders (another name where the table has a column so
    called) by the key's hash, and a digest of each bucket is
    kept from the copy before; buckets whose digest of the source is the same are not written.

    Columns as in ``replicate_table``; a change of columns rewrites all.  Buckets are replaced folder by folder, what the
    source no longer has is removed, and the digests of the buckets written are taken again from the replica and compared
    with the source's.  The new digests are stored last, so that a copy that broke off is made again.
    Returns ``(table_name, status, buckets, buckets_written, source_rows, copied_rows)``; an empty source leaves the replica
    untouched.  ``key`` may be an excluded column.
    """
    dst, schema = dst_path.rstrip("/"), "table_name string, status string, buckets int, buckets_written int, source_rows bigint, copied_rows bigint"
    if src.isEmpty():
        return spark.createDataFrame([(name, "skipped_empty", 0, 0, 0, None)], schema)
    place = free_name("bucket", src.columns)
    done = _numbers(spark, f"{dst}/_digests", "v=", "_SUCCESS")
    had = _existing_columns(spark, dst) if done else None
    cols = [c for c in src.columns if c not in set(exclude) and (had is None or c in had)]
    rows = src.select(*cols, bucket_of(list(key), buckets).alias(place))
    digest = lambda df: bucket_digests(df, cols, [place]).withColumn("cols", F.lit(",".join(cols))).withColumn("of", F.lit(buckets))
    now = materialized(digest(rows))
    before = now.limit(0)
    whole = not done
    if done:
        before = spark.read.schema(now.schema).parquet(f"{dst}/_digests/v={done[-1]}")
        mark = before.select("cols", "of").first()
        whole = mark is None or (mark["cols"], mark["of"]) != (",".join(cols), buckets)
    have = {n for n in _numbers(spark, dst, f"{place}=")}
    sizes = {r[0]: r[1] for r in now.select(place, "n").collect()}  # at most `buckets` numbers
    live = set(sizes)
    off = live if whole else {r[0] for r in differing_buckets(now, before, [place]).collect()} & live | (live - have)
    if off:
        big = {b: -(-n // rows_per_file) for b, n in sizes.items() if n > rows_per_file}  # a hot bucket has many writers
        spread = F.lit(0).cast("bigint")
        if big:
            writers = F.create_map(*[F.lit(x) for b, w in big.items() for x in (b, w)])
            spread = F.pmod(F.xxhash64(*cols), F.coalesce(writers[F.col(place)], F.lit(1)))
        (rows.filter(F.col(place).isin(sorted(off))).repartition(place, spread).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(place).parquet(dst))
    for n in have - live:
        _remove(spark, f"{dst}/{place}={n}")
    copied = digest(spark.read.parquet(dst).filter(F.col(place).isin(sorted(off)))) if off else now.limit(0)
    wrong = differing_buckets(copied, now.filter(F.col(place).isin(sorted(off))), [place]).count() if off else 0
    now.coalesce(1).write.mode("overwrite").parquet(f"{dst}/_digests/v={(done[-1] + 1) if done else 0}")
    total = int(now.agg(F.sum("n")).first()[0])
    written = int(now.filter(F.col(place).isin(sorted(off))).agg(F.sum("n")).first()[0] or 0) if off else 0
    return spark.createDataFrame([(name, "ok" if not wrong else "digest_mismatch", len(live), len(off), total, written)], schema)


def replicate(spark: SparkSession, tables: dict[str, DataFrame], dst_root: str) -> DataFrame:
    """K8: replicate several tables; one status row per table (failures reported, not raised)."""
    schema = "table_name string, status string, source_rows bigint, copied_rows bigint"
    out = []
    for name, df in tables.items():
        try:
            out.append(replicate_table(spark, df, f"{dst_root.rstrip('/')}/{name}", name))
        except Exception as e:  # keep going, like the reference's success/failed lists
            out.append(spark.createDataFrame([(name, f"failed: {type(e).__name__}", None, None)], schema))
    res = spark.createDataFrame([], schema)
    for o in out:
        res = res.unionByName(o)
    return res


def write_cards(cards: DataFrame, path: str, card_col: str = "card", partition_col: str | None = "role") -> None:
    """Write card text, cards separated by a blank line, one part file per task.

    ``partitionBy(role)`` gives one folder per role (the reference writes one file per role);
    the write is partition-parallel — no single-file collect.
    """
    w = cards.select(*( [partition_col] if partition_col else []), F.col(card_col).alias("value"))
    writer = w.write.mode("overwrite").option("lineSep", "\n\n")
    if partition_col:
        writer = writer.partitionBy(partition_col)
    writer.text(path)


def export_report(df: DataFrame, path: str, fmt: str = "csv", null_value: str = "\\N") -> None:
    """Report export (header row, parallel parts); values are written verbatim
    (no whitespace trimming; NULL written as ``null_value`` so it stays distinct from '')."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = (w.option("header", True).option("ignoreLeadingWhiteSpace", False)
              .option("ignoreTrailingWhiteSpace", False).option("nullValue", null_value))
    w.save(path)
