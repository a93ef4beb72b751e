"""Language identification: averaged hashed subword embeddings, linear softmax, calibrated rejection (operator 1).

Words (letters only, lower case) are read as bytes with a blank on either side; their 2-, 3- and 4-byte subwords are
hashed to ``2 ** 16`` rows of an embedding table.  A text is the mean of its subwords' embeddings, a linear softmax gives
the languages.  Table and softmax are trained by stochastic gradient descent in numpy on a bounded sample; a temperature
and a rejection threshold come from a part of the sample that training doesn't see.

Training takes about ``per_language`` documents of each of the ``max_languages`` most frequent languages, chosen by a
hash of id and text, each as at most ``sample_windows`` of its subwords and once more as a short run of words.
Prediction reads every text whole.

Defined cases: text that is null or has no letter is ``und`` with score 0; if no row is labelled, every text is; null
ids and repeated rows give one result row each; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import id_text, map_slices, share, starts_of

UND = "und"
BUCKETS = 1 << 16
SCHEMA = "doc_id long, lang_pred string, score double, accepted boolean"
_LETTER = re.compile(r"[^\W\d_]")  # also takes digits in other shapes, such as superscripts and fractions
#: Maps every ASCII byte but letters to a blank; bytes of longer characters stay.
_TO_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _LETTER.finditer(text))


def clean(text: str) -> bytes:
    """Lower-cased words of letters as bytes, one blank before, between and after them."""
    return b" " + b" ".join(text.lower().encode("utf-8", "replace").translate(_TO_BLANK).split()) + b" "


def subwords(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text number) of every 2-, 3- and 4-byte window that crosses no inner blank."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), [len(t) for t in texts])
    blank = np.concatenate([[0], np.cumsum(raw == 32, dtype=np.int32)])
    buckets, docs = [], []
    packed = raw.astype(np.uint32)
    for size in (2, 3, 4):
        n = len(raw) - size + 1
        if n <= 0:
            break
        packed = packed[:n] | (raw[size - 1:].astype(np.uint32) << np.uint32(8 * (size - 1)))
        inner = blank[size - 1:size - 1 + n] - blank[1:n + 1] if size > 2 else (raw[:n] == 32) & (raw[1:] == 32)
        at = np.flatnonzero((inner == 0) & (doc[:n] == doc[size - 1:]))
        buckets.append(((packed[at] + np.uint32(size * 0x01000193)) * np.uint32(0x9E3779B1)) >> np.uint32(16))
        docs.append(doc[at])
    if not buckets:
        return np.zeros(0, np.uint32), np.zeros(0, np.int32)
    return np.concatenate(buckets), np.concatenate(docs)


class Model:
    """Languages, logits of every bucket, bias, temperature and rejection threshold."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, threshold: float):
        self.languages, self.table, self.bias = languages, table.astype(np.float32), bias
        self.temperature, self.threshold = temperature, threshold

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        bucket, doc = subwords(texts)
        order = np.argsort(doc, kind="stable")
        counts = np.bincount(doc, minlength=len(texts))
        logits = np.zeros((len(texts), len(self.languages)))
        full = np.flatnonzero(counts)
        if len(full):
            logits[full] = np.add.reduceat(self.table[bucket[order]], starts_of(counts[full]), axis=0, dtype=np.float64)
        return softmax((logits / np.maximum(counts, 1)[:, None] + self.bias) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(bags: list[np.ndarray], labels: np.ndarray, languages: list[str], dims: int = 16, epochs: int = 6, rate: float = 0.5,
          target: float = 0.99) -> Model:
    """Stochastic gradient descent over bags of buckets; every fifth bag is kept for calibration."""
    rng = np.random.Generator(np.random.Philox(3))
    k = len(languages)
    emb, out, bias = rng.normal(0, 0.1, (BUCKETS, dims)), np.zeros((dims, k)), np.zeros(k)
    held = np.arange(len(bags)) % 10 // 2 == 0  # both bags of a document fall on the same side
    fit = np.flatnonzero(~held) if (~held).any() else np.arange(len(bags))
    weight = len(labels) / (k * np.maximum(np.bincount(labels, minlength=k), 1))
    total, step = epochs * len(fit), 0
    packed = [np.unique(b, return_counts=True) for b in bags]
    for _ in range(epochs):
        for i in rng.permutation(fit):
            bucket, count = packed[i]
            share = count / count.sum()
            h = share @ emb[bucket]
            g = softmax(h @ out + bias)
            g[labels[i]] -= 1
            g *= rate * (1 - step / total) * weight[labels[i]]
            step += 1
            back = out @ g
            out -= np.outer(h, g)
            bias -= 0.1 * g
            emb[bucket] -= 10 * share[:, None] * back[None, :]
    table = emb @ out
    check = np.flatnonzero(held) if held.any() else fit
    raw = np.stack([(packed[i][1] / packed[i][1].sum()) @ table[packed[i][0]] + bias for i in check])
    y = labels[check]
    loss = {t: -np.log(softmax(raw / t)[np.arange(len(y)), y] + 1e-12).mean() for t in np.geomspace(0.05, 20, 60)}
    temperature = float(min(loss, key=loss.get))
    p = softmax(raw / temperature)
    top, right = p.max(axis=1), p.argmax(axis=1) == y
    order = np.argsort(-top, kind="stable")
    good = np.cumsum(right[order]) >= target * np.arange(1, len(order) + 1)
    threshold = float(top[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(languages, table, bias, temperature, threshold)


def fit(docs: DataFrame, trainable: Column, per_language: int = 600, sample_windows: int = 2048, max_languages: int = 256) -> Model | None:
    """A model of the labelled rows that ``trainable`` allows; None if there is none."""
    rows = docs.filter(trainable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"), F.xxhash64("doc_id", "text").alias("h"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(max_languages).collect()}
    if not counts:
        return None
    spark = docs.sparkSession
    rates = spark.createDataFrame([(c, per_language / n) for c, n in counts.items()], "lang string, rate double")  # at most max_languages rows
    unit = (F.shiftrightunsigned("h", 11)).cast("double") / float(1 << 53)
    chosen = rows.join(F.broadcast(rates), "lang").filter(unit < F.col("rate")).select("lang", "text", "h")

    def bags(cols, _):
        out = {"h": [], "lang": [], "whole": [], "short": []}
        for lang, text, h in zip(cols["lang"], cols["text"], cols["h"]):
            if not has_letter(text):
                continue
            rng = np.random.Generator(np.random.Philox(h & 0xFFFFFFFF))
            body = clean(text)
            ws = body.split()
            at, n = int(rng.integers(0, len(ws))), int(rng.integers(1, 9))
            two = []
            for part in (body, b" " + b" ".join(ws[at:at + n]) + b" "):
                b = subwords([part])[0]
                two.append((rng.choice(b, sample_windows, replace=False) if len(b) > sample_windows else b).astype("<u2").tobytes())
            for k, v in zip(out, (h, lang, *two)):
                out[k].append(v)
        return out

    sample = map_slices(chosen, bags, "h long, lang string, whole binary, short binary").orderBy("h", "lang").collect()
    if not sample:
        return None
    languages = sorted({r["lang"] for r in sample})
    packed = [np.frombuffer(r[c], "<u2") for r in sample for c in ("whole", "short")]
    labels = np.array([languages.index(r["lang"]) for r in sample for _ in range(2)])
    use = [i for i, b in enumerate(packed) if len(b)]
    return train([packed[i] for i in use], labels[use], languages)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, lang_pred, score, accepted (score at or above the model's threshold)."""
    spark = docs.sparkSession
    shared = share(spark, model)  # 65,536 floats per language
    wide = len(model.languages) if model else 1

    def predict(cols, m):
        n = len(cols["doc_id"])
        lang, score = [UND] * n, np.zeros(n)
        has = [i for i, t in enumerate(cols["text"]) if t and m and has_letter(t)]
        if has:
            p = m.probabilities([clean(cols["text"][i]) for i in has])
            for i, row in zip(has, p):
                lang[i], score[i] = m.languages[int(row.argmax())], float(row.max())
        return {"doc_id": cols["doc_id"], "lang_pred": lang, "score": score, "accepted": [bool(m and x != UND and s >= m.threshold) for x, s in zip(lang, score)]}

    return map_slices(id_text(docs), predict, SCHEMA, setup=shared, chars=max(1 << 15, (1 << 21) // max(4, wide)))
