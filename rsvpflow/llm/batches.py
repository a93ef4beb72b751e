"""Arrow batches in tasks: bounded slices of a partition as Python lists, results as record batches."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ATOMS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(),
          "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}

#: ASCII blanks that separate words; every other character belongs to a word.
BLANKS = " \t\n\v\f\r"


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat DDL string such as ``doc_id long, ids array<long>``."""
    fields = []
    for part in ddl.split(","):
        name, kind = part.split()
        kind = pa.list_(_ATOMS[kind[6:-1]]) if kind.startswith("array<") else _ATOMS[kind]
        fields.append(pa.field(name, kind))
    return pa.schema(fields)


def slices(batch: pa.RecordBatch, chars: int, rows: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``chars`` bytes of text; one row is never split."""
    size = np.ones(batch.num_rows, dtype=np.int64)
    for col in batch.columns:
        if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) or pa.types.is_binary(col.type):
            size += np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
        elif pa.types.is_list(col.type) or pa.types.is_large_list(col.type):
            length = np.asarray(pc.fill_null(pc.list_value_length(col), 0), dtype=np.int64)
            size += length * (1 + col.nbytes // max(1, int(length.sum())))
    lo = 0
    total = np.cumsum(size)
    while lo < batch.num_rows:
        done = int(total[lo - 1]) if lo else 0
        hi = int(np.searchsorted(total, done + chars, side="right"))
        hi = min(max(hi, lo + 1), lo + rows, batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi


def map_slices(df: DataFrame, fn: Callable, ddl: str, setup: Callable | None = None,
               chars: int = 1 << 20, rows: int = 4096) -> DataFrame:
    """``fn(columns, state) -> columns`` on bounded slices of every partition of ``df``.

    ``columns`` maps names to Python lists; ``state`` is what ``setup()`` returned, made once per task.
    The result may have any number of rows.  No row is cut, so memory follows the longest row.
    """
    def run(batches):
        out = arrow_schema(ddl)
        state = setup() if setup else None
        for batch in batches:
            for part in slices(batch, chars, rows):
                got = fn({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)}, state)
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)

    return df.mapInArrow(run, ddl)


def share(spark: SparkSession, value) -> Callable:
    """Send a bounded value to the tasks once per executor; the result is a ``setup`` that gives it back.

    It travels as bytes that carry their classes, so executors need not have this package.
    """
    box = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(box.value)


def keep_rows(df: DataFrame, keep: Callable, column: str, setup: Callable | None = None, chars: int = 1 << 20) -> DataFrame:
    """The rows of ``df``, all columns as they are, for which ``keep(values of column, state)`` is true.

    Columns are taken by place, so names that clash only in case do no harm.
    """
    at = df.columns.index(column)

    def run(batches):
        state = setup() if setup else None
        for batch in batches:
            for part in slices(batch, chars, 4096):
                yield part.filter(pa.array(keep(part.column(at).to_pylist(), state), pa.bool_()))

    return df.mapInArrow(run, df.schema)


def words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes; ``bytes.split`` cuts at exactly the ASCII blanks."""
    return text.encode("utf-8", "replace").split() if text else []


def fold_ascii(text: str) -> bytes:
    """UTF-8 bytes with A-Z lowered and nothing else changed (``bytes.lower`` touches ASCII only)."""
    return text.encode("utf-8", "replace").lower()


def starts_of(lengths: np.ndarray) -> np.ndarray:
    """Offsets of consecutive runs of the given lengths."""
    return np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64) if len(lengths) else np.zeros(0, np.int64)


def crc_mod(doc_id, m: int):
    """crc32 of the id as text, modulo ``m``; a null id counts as the empty string."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(m)


def id_text(docs: DataFrame) -> DataFrame:
    """Just ``doc_id`` and ``text``; other columns, whatever their names, play no part."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
