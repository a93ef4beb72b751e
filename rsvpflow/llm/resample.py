"""Target-distribution importance resampling over hashed word n-grams.

Each document is scanned once.  Its bytes become a separator-normalised stream (words joined by one space) whose running
CRC registers are stored per byte; the CRC of any n-gram then follows from two of them: the register at its end XOR the one
at its start, shifted over the n-gram's length in GF(2) (a product of precomputed maps for powers of two).  So all orders
of n-grams come from the same scan, and none is hashed by itself.

The scan writes the bucket numbers of each document (2 bytes a feature) and per task the counts of the buckets; the counts
of source and target, ``buckets`` numbers each, are all that reaches the driver.  Weights read the stored numbers, not the
texts.  The draw is a Gumbel top-k: documents in order of (score, id) over range partitions, numbered by running sums.

Defined cases: a null or wordless text has no features, weight 0 and is never drawn where ``min_words`` > 0; null ids count
as the empty text in the seed and as smallest in ties; rows equal in score and id are drawn in order of their feature count,
equal rows count each; an empty target or source gives counts of 0; no rows give no rows; other columns play no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import arrow_schema, share, slices
from rsvpflow.llm.ranges import numbered, ranged, stored

_POLY = np.uint32(0xEDB88320)
_ONES = np.uint32(0xFFFFFFFF)
_LANE = 512
#: Bytes of the normalised stream whose registers are held at a time.
_WINDOW = 1 << 22


def _table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ _POLY, t >> np.uint32(1))
    return t


def _shifts(bits: int = 32) -> np.ndarray:
    """``[k][j][v]``: the register ``v << 8 j`` after 2**k zero bytes."""
    byte = _table()
    zero = lambda x: byte[x & np.uint32(255)] ^ (x >> np.uint32(8))
    basis = np.array([[np.uint32(v) << np.uint32(8 * j) for v in range(256)] for j in range(4)], dtype=np.uint32)
    out = [zero(basis)]
    for _ in range(bits - 1):
        out.append(_moved(out[-1], out[-1]))
    return np.array(out)


def _moved(x: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Registers after the zero bytes of one map."""
    return (tables[0][x & np.uint32(255)] ^ tables[1][(x >> np.uint32(8)) & np.uint32(255)]
            ^ tables[2][(x >> np.uint32(16)) & np.uint32(255)] ^ tables[3][x >> np.uint32(24)])


class Crc:
    """Running registers and the CRC-32 of substrings from two of them."""

    def __init__(self):
        self.byte, self.shift = _table(), _shifts()

    def shifted(self, x: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Each register after its own number of zero bytes."""
        x = x.copy()
        for k in range(int(lengths.max(initial=0)).bit_length()):
            at = np.flatnonzero((lengths >> k) & 1)
            x[at] = _moved(x[at], self.shift[k])
        return x

    def running(self, data: np.ndarray) -> np.ndarray:
        """Register before the first byte (0) and after each byte: lanes side by side, then the lanes' starts carried on."""
        n = len(data)
        lanes = max(1, -(-n // _LANE))
        steps = np.zeros(lanes * _LANE, dtype=np.uint8)
        steps[:n] = data
        steps = np.ascontiguousarray(steps.reshape(lanes, _LANE).T).astype(np.uint32)
        out = np.empty((_LANE, lanes), dtype=np.uint32)
        r = np.zeros(lanes, dtype=np.uint32)
        low, eight = np.uint32(255), np.uint32(8)
        for i in range(_LANE):
            r = self.byte[(r ^ steps[i]) & low] ^ (r >> eight)
            out[i] = r
        carry, span = np.concatenate([np.zeros(1, np.uint32), r[:-1]]), 1
        while span < lanes:  # carry[j] covers `span` lanes before j; double that
            carry[span:] ^= _moved(carry[:-span], self.shift[(span * _LANE).bit_length() - 1])
            span *= 2
        for i in range(_LANE):
            carry = self.byte[carry & low] ^ (carry >> eight)
            out[i] ^= carry
        return np.concatenate([np.zeros(1, np.uint32), out.T.reshape(-1)[:n]])

    def substrings(self, run: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """CRC-32 of the bytes ``start .. end - 1`` of the stream that ``run`` was taken over."""
        return run[end] ^ self.shifted(run[start] ^ _ONES, end - start) ^ _ONES


_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def features(texts: list[bytes | None], lo: int, hi: int, buckets: int, crc: Crc) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words per text, and per text the buckets of its runs of ``lo`` to ``hi`` words."""
    raw = np.frombuffer(b" ".join(t or b"" for t in texts).translate(_KEEP) + b" ", dtype=np.uint8)
    word = raw != 32
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & ~before)
    bounds = np.cumsum([len(t or b"") + 1 for t in texts])
    doc = np.searchsorted(bounds, starts, side="right")
    n_words = np.bincount(doc, minlength=len(texts))
    kept = word | before  # the words and one blank after each
    data = raw[kept]
    ends = np.flatnonzero(data == 32)
    begins = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else ends
    last = np.repeat(np.cumsum(n_words), n_words)  # first word after the word's document
    found, of = [], []
    i = 0
    while i < len(begins):
        j = max(i + 1, int(np.searchsorted(begins, begins[i] + _WINDOW)))
        run = crc.running(data[begins[i]: ends[min(j + hi - 2, len(ends) - 1)]])
        for g in range(lo, hi + 1):
            first = np.arange(i, min(j, len(begins) - g + 1))
            first = first[first + g <= last[first]]
            if len(first):
                found.append(crc.substrings(run, begins[first] - begins[i], ends[first + g - 1] - begins[i]).astype(np.int64) % buckets)
                of.append(doc[first])
        i = j
    if not found:
        return n_words, [np.zeros(0, np.int64)] * len(texts)
    number, of = np.concatenate(found), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    cuts = np.cumsum(np.bincount(of, minlength=len(texts)))[:-1]
    return n_words, np.split(number[order], cuts)


_SCAN = "doc_id long, n_words long, feats binary, counts binary"


def scan(rows: DataFrame, lo: int, hi: int, buckets: int, name: str) -> DataFrame:
    """Stored: (doc_id, n_words, feats) per row, and per task one row with just ``counts``, its buckets' totals."""
    kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def run(batches):
        out, crc, total = arrow_schema(_SCAN), Crc(), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in slices(batch, 1 << 20, 4096):
                n_words, feats = features(part.column(1).to_pylist(), lo, hi, buckets, crc)
                total += np.bincount(np.concatenate(feats) if feats else [], minlength=buckets).astype(np.int64)
                cols = [part.column(0), pa.array(n_words, pa.int64()), pa.array([f.astype(kind).tobytes() for f in feats], pa.binary()),
                        pa.nulls(part.num_rows, pa.binary())]
                yield pa.RecordBatch.from_arrays(cols, schema=out)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([total.tobytes()], pa.binary())], schema=out)

    return stored(rows.mapInArrow(run, _SCAN), name)


def totals(scanned: DataFrame, buckets: int) -> np.ndarray:
    """Counts of the buckets over all rows: tasks' counts added up in tasks, then by bucket; ``buckets`` numbers come back."""
    def add(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for b in batch.column(0).to_pylist():
                total += np.frombuffer(b, dtype=np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["bucket", "n"])

    got = scanned.filter("counts is not null").select("counts").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, dtype=np.int64)
    for r in got.collect():
        out[r.bucket] = r.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of smoothed shares, per bucket."""
    b = len(source)
    s_all, t_all = float(int(source.sum()) + b), float(int(target.sum()) + b)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * s_all / ((float(s) + 1) * t_all))) for s, t in zip(source.tolist(), target.tolist())],
                    dtype=np.int64)


def weighted(scanned: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight): the floored mean gain of a document's features, 0 without any."""
    get = share(scanned.sparkSession, gain)
    kind = np.uint16 if len(gain) <= 1 << 16 else np.uint32
    ddl = "doc_id long, n_words long, n_features long, weight long"

    def run(batches):
        out, table = arrow_schema(ddl), get()
        for batch in batches:
            for part in slices(batch, 1 << 22, 1 << 16):
                feats = part.column(2).to_pylist()
                n = np.array([len(f) // kind().itemsize for f in feats], dtype=np.int64)
                cum = np.concatenate([[0], np.cumsum(table[np.frombuffer(b"".join(feats), dtype=kind)])])
                end = np.cumsum(n)
                weight = (cum[end] - cum[end - n]) // np.maximum(n, 1)  # numpy's // floors, below 0 too
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(weight)], schema=out)

    return scanned.filter("counts is null").select("doc_id", "n_words", "feats").mapInArrow(run, ddl)


def gumbel(doc_id: Column, seed: int) -> Column:
    """Thousandths of a standard Gumbel number, fixed by seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def resample(docs: DataFrame, target: DataFrame, lo: int = 1, hi: int = 1, buckets: int = 10000, percent: int = 10, min_words: int = 20,
             seed: int = 2024) -> DataFrame:
    """All rows of ``docs`` with n_features, weight, score and rank (1, 2, ... among the drawn, else null).

    ``target`` (column text) is what the drawn should be like; ``percent`` of the documents with ``min_words`` words are drawn.
    """
    text = F.col("text").cast("string").cast("binary")
    ours = scan(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")), lo, hi, buckets, "resample-source")
    theirs = scan(target.select(F.lit(None).cast("long").alias("doc_id"), text.alias("text")), lo, hi, buckets, "resample-target")
    gain = gains(totals(ours, buckets), totals(theirs, buckets))
    rows = weighted(ours, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    rows = rows.withColumn("late", (F.col("n_words") < min_words).cast("int"))
    order = [F.col("late").asc(), F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("n_features").asc()]
    lined = ranged(rows, order, "resample-order")
    drawn = lined.filter("late = 0").count() * percent // 100
    out = numbered(lined, "late")
    rank = F.when((F.col("late") == 0) & (F.col("pos") < drawn), F.col("pos") + 1)
    return out.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))
