"""Packing along a space-filling curve (operator 7).

A document's tokens give a hashed vector, a fixed random projection takes it to three dimensions, and the Hilbert index
of that point is its place on the curve.  Documents are range-sorted by (Hilbert key, id), so that a key shared by very
many documents is still dealt over many partitions, and each partition is cut into sequences of ``length`` tokens from
one running offset.  The rest of a partition is cut into powers of two, so nothing is padded.

Defined cases: null text is empty and has only the closing token; null ids sort first and are packed like any other;
repeated rows are packed each; extra columns are ignored; an empty table gives no pieces.  A task holds the ids of one
document and the pieces of one open sequence.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from operator import attrgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from rsvpflow.llm.batches import arrow_schema, id_text, map_slices, slices, starts_of, words
from rsvpflow.session import checkpoint_root

CLOSE = 1
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_VECTOR, _DIMS, _BITS = 256, 3, 16


def hilbert_key(points: np.ndarray, bits: int = _BITS) -> np.ndarray:
    """Hilbert index of integer points, one row each, by the transpose method (Skilling, 2004)."""
    x = [points[:, i].astype(np.int64).copy() for i in range(points.shape[1])]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            inv = (x[i] & q) != 0
            t = np.where(inv, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(inv, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = x[i] ^ t
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[-1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for xi in x:
            key = (key << 1) | (((xi ^ t) >> b) & 1)
    return key


def curve_position(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents whose token ids lie end to end in ``ids``."""
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    slot = (mixed >> np.uint64(56)).astype(np.int64)
    sign = 1.0 - 2.0 * ((mixed >> np.uint64(40)) & np.uint64(1)).astype(np.float64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    vec = np.bincount(doc * _VECTOR + slot, weights=sign, minlength=len(lengths) * _VECTOR).reshape(-1, _VECTOR)
    vec = np.sign(vec) * np.log1p(np.abs(vec))
    vec /= np.maximum(np.linalg.norm(vec, axis=1, keepdims=True), 1e-9)
    axes = np.random.Generator(np.random.Philox(7)).standard_normal((_VECTOR, _DIMS))
    cells = (np.clip(vec @ axes, -4, 3.9999) + 4) * ((1 << _BITS) / 8)
    return hilbert_key(cells.astype(np.int64))


class Memo(dict):
    """``make(key)`` of the keys seen last: when ``most`` are held they become the old generation, looked up before making."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) if b in plain else chr(256 + b - sum(p < b for p in plain)) for b in range(256)}


def chunk_encoder(blob: str, most: int = 500_000):
    """A memo from a blank-delimited chunk (UTF-8) to its token ids as little-endian uint32 bytes.

    This vocabulary's tokenizer lower-cases, splits by its pattern and encodes the pieces one by one; it never joins
    across blanks.  So a chunk of letters below U+0130, where lower-casing and normalization depend on no neighbour, is
    split by the same pattern here and its pieces go to the library's model; other chunks, and those that may spell a
    special token, go through the whole library tokenizer.
    """
    import json

    import regex
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(blob)
    pattern = json.loads(blob)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    split, letters, model = regex.compile(pattern).findall, _byte_letters(), tok.model
    pack = lambda ids: struct.pack(f"<{len(ids)}I", *ids)
    number = attrgetter("id")

    def piece(p: str) -> bytes:
        got = model.tokenize(p if p.isascii() and p.isprintable() else p.encode("utf-8").decode("latin-1").translate(letters))
        return pack(list(map(number, got)))

    pieces = Memo(piece, most // 10)  # of chunks that are not a word, or a word and a mark

    def chunk(c: bytes) -> bytes:
        text = c.decode("utf-8", "replace")
        if c.isascii() or (max(text) < "\u0130" and "<|" not in text):
            low = text.lower()
            if low.isalpha():
                return piece(low) if low == text else chunks[low.encode()]
            word, mark = low[:-1], low[-1]
            if word.isalpha() and " " < mark < "\x7f" and not mark.isdigit():
                return chunks[word.encode()] + pieces[mark]
            if "<|" not in low:
                return b"".join([pieces[p] for p in split(low)])
        return pack(tok.encode(text, add_special_tokens=False).ids)

    chunks = Memo(chunk, most)
    return chunks


def _tokenize(cols: dict, encode: Memo) -> dict:
    close = np.array([CLOSE], dtype="<u4").tobytes()
    raw = [b"".join(map(encode.__getitem__, words(t))) + close for t in cols["text"]]
    lengths = np.array([len(r) // 4 for r in raw], dtype=np.int64)
    ids = np.frombuffer(b"".join(raw), dtype="<u4")
    narrow = ids.astype("<u2") if int(ids.max(initial=0)) < 65536 else ids
    at = starts_of(lengths)
    return {"doc_id": cols["doc_id"], "hkey": curve_position(ids, lengths), "wide": [narrow.itemsize] * len(raw),
            "ids": [narrow[a:a + n].tobytes() for a, n in zip(at.tolist(), lengths.tolist())]}


def tokens_on_curve(docs: DataFrame, tokenizer_json: str) -> DataFrame:
    """(doc_id, hkey, wide, ids): token ids as little-endian integers of ``wide`` bytes, closing id included."""
    blob = docs.sparkSession.sparkContext.broadcast(Path(tokenizer_json).read_text(encoding="utf-8"))
    return map_slices(id_text(docs), _tokenize, "doc_id long, hkey long, wide int, ids binary", setup=lambda: chunk_encoder(blob.value))


def cut(documents: Iterator[tuple], length: int) -> Iterator[tuple]:
    """Pieces (doc_id, start, doc_tokens, sequence, offset, ids) of a run of (doc_id, ids).

    Only the last, unfilled sequence is held back; it is cut anew into powers of two, largest first.
    """
    seq, used, held = 0, 0, []
    for doc, ids in documents:
        pos = 0
        while pos < len(ids):
            take = min(len(ids) - pos, length - used)
            held.append((doc, pos, len(ids), seq, used, ids[pos:pos + take]))
            pos, used = pos + take, used + take
            if used == length:
                yield from held
                seq, used, held = seq + 1, 0, []
    rest, room, at = used, 0, 0
    for doc, start, total, _, _, ids in held:
        pos = 0
        while pos < len(ids):
            if at == room:
                seq += bool(room)
                room, at = 1 << (rest.bit_length() - 1), 0
                rest -= room
            take = min(len(ids) - pos, room - at)
            yield doc, start + pos, total, seq, at, ids[pos:pos + take]
            pos, at = pos + take, at + take


def pack(docs: DataFrame, tokenizer_json: str, length: int = 2048) -> DataFrame:
    """One row per piece; ``ids`` holds its ids as little-endian unsigned 32-bit integers."""
    checkpoint_root(docs.sparkSession)
    # tokenized once: the range sort below reads its input twice, to find the bounds and to deal the rows
    tokens = tokens_on_curve(docs, tokenizer_json).checkpoint()
    ordered = tokens.repartitionByRange("hkey", "doc_id").sortWithinPartitions("hkey", "doc_id", "ids")

    def run(batches):
        out = arrow_schema(PIECES)
        base = TaskContext.get().partitionId() << 40

        def documents():
            for b in batches:
                for part in slices(b, 1 << 21, 4096):
                    for doc, wide, ids in zip(*(part.column(c).to_pylist() for c in ("doc_id", "wide", "ids"))):
                        yield doc, np.frombuffer(ids, dtype=f"<u{wide}")

        buf, size = [], 0
        for doc, start, total, seq, off, ids in cut(documents(), length):
            buf.append((doc, start, len(ids), total, base + seq, off, ids.astype("<u4").tobytes()))
            size += len(ids)
            if size >= 1 << 18 or len(buf) >= 8192:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*buf), out)], schema=out)
                buf, size = [], 0
        if buf:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*buf), out)], schema=out)

    return ordered.select("doc_id", "wide", "ids").mapInArrow(run, PIECES)
