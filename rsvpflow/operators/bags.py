"""Comparing and copying tables as bags of rows: digests of key buckets first, rows only where those differ.

A row's two 64-bit hashes (NULLs marked, so that a value in another column is another row) are added up per bucket of the
key's hash, in pieces small enough that no sum overflows.  Sums do not depend on order and count copies, so two buckets with
equal digests hold the same rows as often (but for a clash of 128 bits).  A first pass over both sides compares a bounded
number of buckets, a second one splits those that differ; only rows of buckets that still differ are grouped and compared
whole.  Which of the split buckets differ is sent as bits, of bounded size however many they are, so no other row is
shuffled for it.  Equal tables shuffle nothing but digests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpflow.operators.joins import key_join, materialized

__all__ = ["row_hash", "bucket_of", "bucket_digests", "differing_buckets", "bag_differences", "maybe_among"]

_SUMS = [f"h{k}" for k in range(8)]

#: Bits that the split buckets of all first buckets have together (16 MB when sent).
MARK_BITS = 1 << 27


def row_hash(cols: Sequence[str], salt: int = 0) -> Column:
    """64 bits of a row; a NULL counts, and where it stands."""
    marks = []
    for at in range(0, len(cols), 60):
        bits = F.lit(0).cast("bigint")
        for k, c in enumerate(cols[at:at + 60]):
            bits = bits + F.col(c).isNull().cast("bigint") * F.lit(1 << k)
        marks.append(bits)
    return F.xxhash64(F.lit(salt), *marks, *[F.col(c) for c in cols])


def bucket_of(key: Sequence[str], buckets: int, salt: int = 0) -> Column:
    return F.pmod(row_hash(key, salt), F.lit(buckets)).cast("int")


def bucket_digests(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by..., n, h0 ... h7): rows and hash sums per bucket (``by`` columns of ``df``), aggregated map-side first."""
    hashed = df.select(*by, row_hash(cols, 1).alias("__h1"), row_hash(cols, 2).alias("__h2"))
    pieces = [F.shiftright(h, 16 * k).bitwiseAND(F.lit(0xFFFF)) for h in ("__h1", "__h2") for k in range(4)]
    return hashed.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(c) for p, c in zip(pieces, _SUMS)])


def differing_buckets(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets (``by`` columns) whose digests differ or that one side lacks."""
    both = a.select(*by, *[F.col(c) for c in ("n", *_SUMS)]).unionByName(b.select(*by, *[(-F.col(c)).alias(c) for c in ("n", *_SUMS)]))
    g = both.groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("n", *_SUMS)])
    off = F.lit(False)
    for c in ("n", *_SUMS):
        off = off | (F.col(c) != 0)
    return g.filter(off).select(*by)


def _marks(off: DataFrame, first: str, second: str, words: int) -> DataFrame:
    """(first, bits): one row per first bucket, the numbers ``second`` it is listed with as bits of ``words`` longs."""
    some = off.groupBy(first, F.shiftright(second, 6).alias("__w")).agg(F.bit_or(F.expr(f"shiftleft(1L, {second} & 63)")).alias("__o"))
    found = some.groupBy(first).agg(F.map_from_entries(F.collect_list(F.struct("__w", "__o"))).alias("__m"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda w: F.coalesce(F.element_at("__m", w), F.lit(0).cast("bigint")))
    return found.select(first, dense.alias("__bits"))


def _marked(df: DataFrame, marks: DataFrame, first: str, second: str) -> DataFrame:
    """The rows of ``df`` whose bit is set in ``marks``; ``df`` is not shuffled."""
    return df.join(F.broadcast(marks), first).filter(f"shiftright(__bits[{second} >> 6], {second} & 63) & 1L = 1L")


def maybe_among(df: DataFrame, keys: DataFrame, key: Sequence[str], buckets: int = 4096) -> DataFrame:
    """The rows of ``df`` whose ``key`` is in ``keys`` (NULLs are equal) and some others: those that share a bit of ``MARK_BITS``
    with a key, one in four when there are 34 million keys.  Nothing but bits is shuffled or sent."""
    cols, first, second = list(df.columns), "__b1", "__b2"
    words = max(1, MARK_BITS // 64 // buckets)
    at = [bucket_of(key, buckets).alias(first), bucket_of(key, 64 * words, 3).alias(second)]
    return _marked(df.select(*cols, *at), materialized(_marks(keys.select(*at), first, second, words)), first, second).select(*cols)


def bag_differences(expected: DataFrame, derived: DataFrame, key: Sequence[str], buckets: int = 4096) -> DataFrame:
    """Rows (the columns of ``expected``) that the tables hold a different number of times, with n_expected and n_derived.

    Both tables need the columns of ``expected``; NULLs are equal to NULLs.
    """
    cols = list(expected.columns)
    first, second = "__b1", "__b2"
    sides = [df.select(*cols, bucket_of(key, buckets).alias(first)) for df in (expected, derived)]
    off = materialized(differing_buckets(*[bucket_digests(s, cols, [first]) for s in sides], [first]))  # at most `buckets` rows
    words = max(1, MARK_BITS // 64 // max(4096, buckets))
    sides = [key_join(s, off, [first], "left_semi", materialize=False).withColumn(second, bucket_of(key, 64 * words, 3)) for s in sides]
    fine = [first, second]
    off = materialized(_marks(differing_buckets(*[bucket_digests(s, cols, fine) for s in sides], fine), first, second, words))
    sides = [_marked(s, off, first, second).select(*cols) for s in sides]
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = sides[0].select(*cols, one.alias("__e"), none.alias("__d")).unionByName(sides[1].select(*cols, none.alias("__e"), one.alias("__d")))
    return both.groupBy(*cols).agg(F.sum("__e").alias("n_expected"), F.sum("__d").alias("n_derived")).filter("n_expected <> n_derived")


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
