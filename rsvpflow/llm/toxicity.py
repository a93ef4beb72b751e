"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index (operator 3).

Labelled examples are a bounded sample (about ``per_class`` of each class, by a hash of the id).  Seven tenths of them
are the index, the rest calibrates.  Every word of the index part is a feature, and so are the first four to seven letters
of words where their presence depends on the label (likelihood ratio of ``least`` or more).  The dependence is a weight
besides the TF-IDF, from ``FLOOR`` for none to 1 at ``least``.  Document frequencies are counted over all documents.

A query adds up the short posting lists of its terms first.  Lists of common terms are held by blocks of examples: the
bound of a block is its best partial similarity plus the sum over the common terms of query weight times the term's largest
weight in the block.  The blocks with the highest bounds are scored, then all blocks whose bound reaches the k-th best
similarity, so the neighbours are exact.  Neighbours vote by squared similarity; a logistic curve fitted to the
calibration part, weighted back to the classes' shares among all labels, turns the vote and the nearest similarity into a
probability.  A text with the vector of labelled examples gets the mean of their labels, drawn to the share of toxic labels.

Defined cases: null or empty text, and any text without a feature, has no neighbour and gets the share of toxic labels
among calibration texts without features; without labels of both classes every score is the share of toxic labels
(0 if none); several labels of one id count as the largest; null ids and repeated rows give one result row each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import arrow_schema, id_text, keep_rows, map_slices, share, slices
from rsvpflow.llm.packing import Memo

SCHEMA = "doc_id long, score double, predicted int, similarity double, evidence array<long>"
BLOCK = 64
#: Blocks scored before the others are compared with the k-th best similarity.
AHEAD = 8
#: Postings a block, on average, from which a term is common and its list is held by blocks.
COMMON = 4
#: Least weight of a word whose presence does not depend on the label.
FLOOR = 0.05
PREFIXES = (4, 5, 6, 7)
#: Maps every ASCII byte but letters to a blank; bytes of longer characters stay.
_TO_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def tokens(text: str | None) -> list[bytes]:
    """Lower-cased words: runs of ASCII letters and of characters beyond ASCII, as UTF-8."""
    return text.lower().encode("utf-8", "replace").translate(_TO_BLANK).split() if text else []


def names(word: bytes) -> list[str]:
    """The features of a word: itself (w:) and, of longer ones, the first four to seven letters (p:)."""
    s = word.decode("utf-8", "replace")
    return ["w:" + s] + ["p:" + s[:n] for n in PREFIXES if len(s) > n]


Counts = tuple[np.ndarray, np.ndarray]  # feature numbers, how often each


class Features:
    """Feature numbers of texts.  Prefix features of the words seen last are remembered, of about ``most`` of them."""

    def __init__(self, vocab: dict[str, int], most: int = 100_000):
        self.plain = {t[2:].encode("utf-8"): i for t, i in vocab.items() if t.startswith("w:")}
        self.stems = {t[2:].encode("utf-8")[:4] for t in vocab if t.startswith("p:")}
        self.prefixes = Memo(lambda word: tuple(vocab[t] for t in names(word)[1:] if t in vocab), most)

    def present(self, text: str | None) -> set[int]:
        ws, stems = set(tokens(text)), self.stems
        out = set(map(self.plain.get, ws))
        out.discard(None)
        out.update(chain.from_iterable(self.prefixes[w] for w in ws if w[:4] in stems))
        return out

    def __call__(self, text: str | None) -> Counts:
        count, get, stems = Counter(tokens(text)), self.plain.get, self.stems
        more: dict[int, int] = {}
        for w in count:
            if w[:4] in stems:
                for t in self.prefixes[w]:
                    more[t] = more.get(t, 0) + count[w]
        t = np.array([get(w, -1) for w in count] + list(more), dtype=np.int64)
        n = np.array(list(count.values()) + list(more.values()), dtype=np.int64)
        order = np.argsort(t)[np.count_nonzero(t < 0):]
        return t[order], n[order]


def _pair(counts: dict[int, int] | Counts) -> Counts:
    if isinstance(counts, dict):
        return np.array(list(counts), dtype=np.int64), np.array(list(counts.values()), dtype=np.int64)
    return counts


class Index:
    """Block-max inverted index of unit TF-IDF vectors; the lists of common terms are laid out by block."""

    def __init__(self, vectors: list[dict[int, int] | Counts], ids: list[int], labels: list[int], idf: np.ndarray):
        self.idf = idf
        pairs = [_pair(v) for v in vectors]
        key = [np.sort(t).astype(">i4").tobytes() for t, _ in pairs]
        order = sorted(range(len(pairs)), key=lambda i: (key[i], ids[i]))  # like examples share blocks
        self.ids, self.labels = [ids[i] for i in order], np.array([labels[i] for i in order], dtype=float)
        self.blocks = -(-len(order) // BLOCK)
        none = [np.zeros(0, dtype=np.int64)]
        term = np.concatenate(none + [pairs[i][0] for i in order])
        at = np.repeat(np.arange(len(order), dtype=np.int32), [len(pairs[i][0]) for i in order])
        w = np.concatenate([np.zeros(0)] + [self.unit(*pairs[i]) for i in order])
        by = np.lexsort((at, term))
        term, self.at, self.w = term[by], at[by], w[by]
        self.cut = np.searchsorted(term, np.arange(len(idf) + 1))
        self.by_block = None

    def __getstate__(self):
        return {**self.__dict__, "by_block": None}  # laid out anew where it is used

    def _common(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of each common term (-1 for the others), its weights by block, its largest weight in each block."""
        if self.by_block is None:
            common = np.flatnonzero(np.diff(self.cut) >= COMMON * max(self.blocks, 1))
            row = np.full(len(self.idf), -1, dtype=np.int64)
            row[common] = np.arange(len(common))
            p, of = _ranges(self.cut[common], self.cut[common + 1])
            weights = np.zeros((len(common), self.blocks * BLOCK))
            weights[of, self.at[p]] = self.w[p]
            weights = weights.reshape(len(common), self.blocks, BLOCK)
            self.by_block = row, weights, weights.max(axis=2) if self.blocks else np.zeros((len(common), 0))
        return self.by_block

    def unit(self, t: np.ndarray, n: np.ndarray) -> np.ndarray:
        raw = (1 + np.log(n)) * self.idf[t]
        norm = math.sqrt(raw @ raw)
        return raw / norm if norm else raw

    def weigh(self, counts: dict[int, int]) -> dict[int, float]:
        return dict(zip(counts, self.unit(*_pair(counts)).tolist()))

    def nearest(self, counts: dict[int, int] | Counts, k: int) -> list[tuple[float, int]]:
        """The k most similar examples as (similarity, place), ties by place; only similarities above zero."""
        t, n = _pair(counts)
        if not len(t) or not self.blocks:
            return []
        w, (row, weights, most) = self.unit(t, n), self._common()
        row = row[t]
        rare = row < 0
        p, of = _ranges(self.cut[t[rare]], self.cut[t[rare] + 1])
        score = np.bincount(self.at[p], w[rare][of] * self.w[p], minlength=self.blocks * BLOCK).astype(float).reshape(self.blocks, BLOCK)
        row, w = row[~rare], w[~rare]
        if len(row):
            bound = score.max(axis=1) + w @ most[row]
            order = np.argsort(-bound, kind="stable")
            ahead, rest = order[:AHEAD], order[AHEAD:]
            _add(score, weights, row, w, ahead)
            if len(rest):
                kth = np.partition(score, -k, axis=None)[-k] if k <= score.size else 0.0
                _add(score, weights, row, w, rest[bound[rest] >= kth - 1e-9])
        score = np.round(score.ravel(), 12)
        kth = np.partition(score, -k)[-k] if k <= len(score) else 0.0
        found = np.flatnonzero((score >= kth) & (score > 0))
        found = found[np.lexsort((found, -score[found]))][:k]
        return [(float(score[i]), i) for i in found.tolist()]


def _add(score: np.ndarray, weights: np.ndarray, row: np.ndarray, w: np.ndarray, blocks: np.ndarray) -> None:
    """Add the common terms' part to the similarities of some blocks."""
    if len(blocks):
        score[blocks] += np.tensordot(w, weights[row[:, None], blocks], 1)


def _ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of the ranges [lo, hi), one after another, and the number of the range of each."""
    n = hi - lo
    of = np.repeat(np.arange(len(n)), n)
    return np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + lo[of], of


class Model:
    """Index, feature numbers and calibration; ``prior`` is the score of a text without features."""

    def __init__(self, vocab: dict[str, int], index: Index | None, k: int, prior: float, curve: np.ndarray):
        self.vocab, self.index, self.k, self.prior, self.curve = vocab, index, k, prior, curve
        self.base = prior  # share of toxic labels

    def vote(self, near: list[tuple[float, int]]) -> np.ndarray:
        w = np.array([s * s for s, _ in near])
        y = self.index.labels[[i for _, i in near]]
        v = (w @ y + 0.02) / (w.sum() + 0.04)
        return np.array([1.0, np.log(v / (1 - v)), near[0][0]])

    def score(self, counts: Counts) -> tuple[float, float, list[int]]:
        near = self.index.nearest(counts, self.k) if self.index else []
        if not near:
            return self.prior, 0.0, []
        same = [self.index.labels[i] for s, i in near if s > 1 - 1e-9]
        if same:
            p = (sum(same) + self.base) / (len(same) + 1)
            return float(p), 1.0, [self.index.ids[i] for _, i in near[:5]]
        p = 1 / (1 + np.exp(-np.clip(self.vote(near) @ self.curve, -30, 30)))
        return float(p), min(1.0, near[0][0]), [self.index.ids[i] for _, i in near[:5]]


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (y - q)) - ridge * w
        hess = (x * (weight * q * (1 - q) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        w = w + np.linalg.solve(hess, grad)
    return w


def fit(docs: DataFrame, labels: DataFrame, trainable: Column, per_class: int = 2000, k: int = 15,
        least: float = 24.0, floor: float = FLOOR) -> Model:
    """A model of the labelled documents that ``trainable`` (over the labels' doc_id) allows.

    ``floor`` is the least weight of a word by its dependence on the label; 1 gives plain TF-IDF.
    """
    spark, rows = docs.sparkSession, id_text(docs)
    known = (labels.filter(trainable & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
             .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") != 0).cast("int")).alias("y")))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    base_rate = sizes.get(1, 0) / total if total else 0.0
    if len(sizes) < 2:
        return Model({}, None, k, base_rate, np.zeros(3))
    unit = F.shiftrightunsigned(F.xxhash64("doc_id"), 11).cast("double") / float(1 << 53)
    rate = F.when(F.col("y") == 1, F.lit(per_class / sizes[1])).otherwise(F.lit(per_class / sizes[0]))
    chosen = known.filter(unit < rate)  # about 2 * per_class rows
    sample = rows.join(F.broadcast(chosen), "doc_id").withColumn("index", F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(10)) < 7)

    def presence(cols, _):
        yes, no, n1, n0 = Counter(), Counter(), 0, 0
        for t, y in zip(cols["text"], cols["y"]):
            (yes if y else no).update({x for w in set(tokens(t)) for x in names(w)})
            n1, n0 = n1 + (y == 1), n0 + (y == 0)
        yes[""], no[""] = n1, n0
        keys = list(yes.keys() | no.keys())
        return {"t": keys, "a": [yes[t] for t in keys], "b": [no[t] for t in keys]}

    seen = (map_slices(sample.filter("index").select("text", "y"), presence, "t string, a long, b long")
            .groupBy("t").agg(F.sum("a").alias("a"), F.sum("b").alias("b")))
    base = seen.filter("t = ''").first()
    n1, n0 = float(base["a"]) if base else 0.0, float(base["b"]) if base else 0.0
    if not n1 or not n0:
        return Model({}, None, k, base_rate, np.zeros(3))
    cell = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(F.lit(0.0))
    a, b, n = F.col("a").cast("double"), F.col("b").cast("double"), n1 + n0
    g2 = 2 * (cell(a, (a + b) * n1 / n) + cell(b, (a + b) * n0 / n) + cell(n1 - a, (n - a - b) * n1 / n) + cell(n0 - b, (n - a - b) * n0 / n))
    picked = (seen.filter("t != ''").withColumn("g", g2).filter(F.col("t").startswith("w:") | (F.col("g") >= least)).select("t", "g")
              .toArrow().sort_by([("g", "descending"), ("t", "ascending")]))  # bounded by the sample
    vocab = {t: i for i, t in enumerate(picked["t"].to_pylist())}
    label_share = np.clip((picked["g"].to_numpy() / least) ** 2, floor, 1.0)
    del picked
    shared, width = share(spark, vocab), len(vocab)

    def frequencies(batches):
        out, features = arrow_schema("t long, n long"), Features(shared())
        total = np.zeros(width + 1, dtype=np.int64)  # the last one counts documents
        for batch in batches:
            for part in slices(batch, 1 << 20, 4096):
                got = [features.present(t) for t in part.column(0).to_pylist()]
                total += np.bincount(np.fromiter(chain.from_iterable(got), dtype=np.int64), minlength=width + 1)
                total[width] += len(got)
        t = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(total[t])], schema=out)

    def vectors(cols, features):
        got = [features(t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "y": cols["y"], "index": cols["index"],
                "t": [t.astype("<i4").tobytes() for t, _ in got], "n": [n.astype("<i4").tobytes() for _, n in got]}

    counted = rows.select("text").mapInArrow(frequencies, "t long, n long").groupBy("t").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(width + 1)
    df[counted["t"].to_numpy()] = counted["n"].to_numpy()
    idf = (1 + np.log((1 + df[-1]) / (1 + df[:-1]))) * label_share
    packed = (map_slices(sample.select("doc_id", "text", "y", "index"), vectors, "doc_id long, y int, index boolean, t binary, n binary",
                         setup=lambda: Features(shared())).toArrow().sort_by([("doc_id", "ascending"), ("t", "ascending"), ("n", "ascending")]))
    ids, ys, inside = packed["doc_id"].to_pylist(), packed["y"].to_pylist(), packed["index"].to_pylist()
    got = [tuple(np.frombuffer(x, dtype="<i4").astype(np.int64) for x in pair) for pair in zip(packed["t"].to_pylist(), packed["n"].to_pylist())]
    del packed, counted
    pick = lambda values: [v for v, i in zip(values, inside) if i]
    model = Model(vocab, Index(pick(got), pick(ids), pick(ys), idf), k, base_rate, np.zeros(3))
    x, y, w, empty = [], [], [], [0.0, 0.0]
    for counts, label, indexed in zip(got, ys, inside):
        if not indexed:
            weight = sizes[label] / min(sizes[label], per_class)
            near = model.index.nearest(counts, k)
            if near:
                x.append(model.vote(near))
                y.append(label)
                w.append(weight)
            else:
                empty[label] += weight
    model.prior = float((empty[1] + base_rate) / (sum(empty) + 1))
    model.curve = _logistic(np.array(x), np.array(y, dtype=float), np.array(w) / np.mean(w)) if x else np.array([0.0, 1.0, 0.0])
    return model


def _scorer(model: Model):
    return Features(model.vocab), model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: score, predicted, similarity of the nearest example, ids of the nearest examples."""
    shared = share(docs.sparkSession, model)  # bounded by per_class

    def run(cols, state):
        features, m = state
        got = [m.score(features(t)) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "score": [g[0] for g in got], "predicted": [int(g[0] >= 0.5) for g in got],
                "similarity": [g[1] for g in got], "evidence": [g[2] for g in got]}

    return map_slices(id_text(docs), run, SCHEMA, setup=lambda: _scorer(shared()))


def drop_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, all columns, scored below 0.5."""
    shared = share(docs.sparkSession, model)
    return keep_rows(docs, lambda texts, state: [state[1].score(state[0](t))[0] < 0.5 for t in texts], "text", setup=lambda: _scorer(shared()))
