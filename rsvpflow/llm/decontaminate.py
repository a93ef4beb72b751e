"""Benchmark decontamination by size-partitioned MinHash containment search (operator 5).

Benchmark items are partitioned by size class (powers of two of their distinct five-word shingles).  An item's sketch
is its ``k`` smallest shingle hashes, where ``k`` follows from the upper size bound of its class: a document that
contains at least ``threshold`` of the item lacks at most ``(1 - threshold) * size`` of its shingles, which is fewer
than ``k``, so it holds at least one of the ``k`` minima, however long it is.  Banded signatures of the documents would
lose that certainty: a short item is a vanishing part of a long document's signature.  Candidates found through the
minima are verified by exact shingle containment.

Words are runs of letters, digits and underscores in lower case.  Items go to the tasks in blocks of at most
``block_shingles`` shingles (an item is never split), each block against all documents, so a benchmark of any size is
searched whole.

Defined cases: an item with null text or fewer than ``size`` words has no shingle and matches nothing; likewise a
document; null ids and repeated rows of documents give their own pairs; items that share an id are one item each;
extra columns are ignored; an empty table on either side gives no pair.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import id_text, keep_rows, map_slices, share, starts_of

PAIRS = "doc_id long, item_id long, n_shared long, n_item long, containment double"
_WORD = re.compile(r"\w+")
_MUL = np.uint64(0x9E3779B97F4A7C15)


def word_list(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def shingle_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """64-bit hashes of all windows of ``size`` word numbers."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    x = ids.astype(np.uint64) + np.uint64(1)
    h = np.zeros(n, np.uint64)
    for j in range(size):
        h = (h ^ x[j:j + n]) * _MUL
        h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Index:
    """Sketches of one block of items; built on the driver from a bounded block, read-only in tasks."""

    def __init__(self, items: list[tuple[int | None, str | None]], size: int, threshold: float):
        self.size, self.threshold = size, threshold
        self.vocab: dict[str, int] = {}
        self.sets: list[tuple[int | None, np.ndarray]] = []
        posting: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in word_list(text)], dtype=np.int64)
            own = np.unique(shingle_hashes(ids, size))
            if not len(own):
                continue
            upper = (1 << int(len(own)).bit_length()) - 1  # of the size class
            k = min(len(own), int((1 - threshold) * upper + 1e-9) + 1)
            for h in own[:k].tolist():
                posting[h].append(len(self.sets))
            self.sets.append((item_id, own))
        self.minima = np.array(sorted(posting), dtype=np.uint64)
        self.posting = [posting[h] for h in sorted(posting)]

    def search(self, texts: list[str | None]) -> list[tuple[int, int, int]]:
        """(row, item, shared shingles) of all verified pairs."""
        if not len(self.minima):
            return []
        get = self.vocab.get
        rows = [np.fromiter((get(w, -1) for w in word_list(t)), dtype=np.int64) for t in texts]
        lens = np.array([len(r) for r in rows], dtype=np.int64)
        ids = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        if len(ids) < self.size:
            return []
        doc = np.repeat(np.arange(len(rows)), lens)
        n = len(ids) - self.size + 1
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        full = (known[self.size:] - known[:-self.size] == self.size) & (doc[:n] == doc[self.size - 1:])
        at = np.flatnonzero(full)
        if not len(at):
            return []
        h, d = shingle_hashes(ids, self.size)[at], doc[at]
        place = np.minimum(np.searchsorted(self.minima, h), len(self.minima) - 1)
        hit = self.minima[place] == h
        cand = {(int(r), i) for r, p in set(zip(d[hit].tolist(), place[hit].tolist())) for i in self.posting[p]}
        out, lo = [], starts_of(np.bincount(d, minlength=len(rows)))
        own: dict[int, np.ndarray] = {}
        for r, i in sorted(cand):
            if r not in own:
                own = {r: np.unique(h[lo[r]:lo[r + 1] if r + 1 < len(rows) else len(h)])}
            item = self.sets[i][1]
            shared = int(np.isin(item, own[r], assume_unique=True).sum())
            if shared >= self.threshold * len(item) - 1e-9:
                out.append((r, i, shared))
        return out


def _blocks(benchmark: DataFrame, block_shingles: int):
    """Items in blocks of about ``block_shingles`` words, one block at a time on the driver."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    total = items.select(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    n = max(1, -(-int(total) // (4 * block_shingles)))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    for b in range(n):
        yield [(r["item_id"], r["text"]) for r in items.filter(part == b).toLocalIterator()]


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 5, threshold: float = 0.8,
                  block_shingles: int = 1_000_000) -> DataFrame:
    """One row per (document, item) where the document holds ``threshold`` of the item's shingles or more."""
    spark, rows, out = docs.sparkSession, id_text(docs), None
    for items in _blocks(benchmark, block_shingles):
        index = share(spark, Index(items, size, threshold))

        def find(cols, state):
            got = [(cols["doc_id"][r], state.sets[i][0], n, len(state.sets[i][1]), n / len(state.sets[i][1]))
                   for r, i, n in state.search(cols["text"])]
            return {f.split()[0]: [g[j] for g in got] for j, f in enumerate(PAIRS.split(", "))}

        found = map_slices(rows, find, PAIRS, setup=index)
        out = found if out is None else out.unionByName(found)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = 5, threshold: float = 0.8,
                  block_shingles: int = 1_000_000) -> DataFrame:
    """The documents, all columns, that contain no item."""
    for items in _blocks(benchmark, block_shingles):
        index = share(docs.sparkSession, Index(items, size, threshold))

        def clean(texts, state):
            dirty = {r for r, _, _ in state.search(texts)}
            return [i not in dirty for i in range(len(texts))]

        docs = keep_rows(docs, clean, "text", setup=index)
    return docs
