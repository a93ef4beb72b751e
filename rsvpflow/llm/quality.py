"""Quality rules by line-first cleaning (operator 8).

Every line is judged on its own by punctuation, navigation and boilerplate rules; lines that fail are removed and the
document is rejected when the removed lines held more than ``max_lost`` of its words.  Fixed document-level counts
(words, symbols, repeated lines, repeated eight-word windows) are returned beside the verdict, and a document failing
them is never kept.

Defined cases: null or empty text has no words, fails the base rule and is not kept; a null id or a repeated row gives
one result row each; extra columns are ignored; an empty table gives an empty result; a text is read whole, however
long, one slice of rows at a time.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame

from rsvpflow.llm.batches import BLANKS, id_text, map_slices, starts_of, words

SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, n_lines long, n_bad_lines long, lost_words long, text string")

SYMBOLS = "#*$%&|<>"
SEPARATORS = {b"|", b">", b"<", "»".encode(), "›".encode(), "·".encode(), "•".encode(), b"/", b"-", b"::"}
#: Phrases of notices around an article, not of an article.
BOILERPLATE = re.compile(
    r"all rights reserved|©|\(c\) ?\d{4}|copyright|licensed under|released under|cookie|privacy policy|terms of (?:use|service)"
    r"|subscribe|sign (?:in|up)|log ?in|click here|read more|share (?:this|on)|javascript|follow us|newsletter", re.I)
SENTENCE_END = tuple(".!?…:;\"”»')]。！？")


def repeat_words(docs: list[list[bytes]], size: int = 8) -> np.ndarray:
    """Per document, the words inside windows of ``size`` words found twice or more in it.

    Windows are ranked by prefix doubling (1, 2, 4, 8 words), so equal ranks mean equal windows, not equal hashes.
    """
    lens = np.array([len(d) for d in docs], dtype=np.int64)
    out = np.zeros(len(docs), dtype=np.int64)
    n = int(lens.sum())
    if n < size:
        return out
    seen: dict[bytes, int] = {}
    rank = np.fromiter((seen.setdefault(w, len(seen)) for d in docs for w in d), dtype=np.int64, count=n)
    doc = np.repeat(np.arange(len(docs)), lens)
    width = 1
    while width < size:  # the last doubling makes windows of exactly ``size`` when it is a power of two
        step = min(width, size - width)
        pair = rank[:-step] * (int(rank.max(initial=0)) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1].astype(np.int64)
        width += step
    inside = doc[:len(rank)] == doc[size - 1:]
    at = np.flatnonzero(inside)
    key = rank[at] * len(docs) + doc[at]
    _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[cnt[inv] > 1]
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + size, -1)
    hit = np.cumsum(cover[:-1]) > 0
    np.add.at(out, doc[hit], 1)
    return out


def bad_line(line: str, ws: list[bytes]) -> bool:
    """True if a line with words fails a punctuation, navigation or boilerplate rule."""
    body = line.strip()
    n = len(ws)
    letters = sum(c.isalpha() for c in body)
    if letters == 0:
        return True
    # punctuation: symbols instead of sentences, doubled marks after many words
    if 10 * sum(body.count(c) for c in "#*$%&|<>~^=_{}\\") > len(body):
        return True
    if n >= 4 and 3 * sum(w.endswith((b"!!", b"??", b"***", b"###", b"%%%", b"$$$", b"&&&")) for w in ws) > n:
        return True
    if n >= 6 and 5 * sum(a == b for a, b in zip(ws, ws[1:])) > 2 * n:  # stuttering
        return True
    # navigation: items between separators, or a short line that ends no sentence
    if n >= 3 and 4 * sum(w in SEPARATORS for w in ws) >= n:
        return True
    if n < 6 and not body.endswith(SENTENCE_END):
        return True
    # boilerplate: a short notice
    return n <= 20 and BOILERPLATE.search(body) is not None


def _judge(cols: dict, max_lost: float) -> dict:
    texts = [t or "" for t in cols["text"]]
    split = [words(t) for t in texts]
    repeated = repeat_words(split)
    out: dict[str, list] = {f.split()[0]: [] for f in SCHEMA.split(", ")}
    for i, (t, ws) in enumerate(zip(texts, split)):
        n = len(ws)
        seen: set[str] = set()
        dup = bad = lost = lines = 0
        keep = []
        for line in t.split("\n"):
            if not line.strip(BLANKS):
                keep.append(line)
                continue
            lines += 1
            dup += line in seen
            seen.add(line)
            lw = words(line)
            if bad_line(line, lw):
                bad += 1
                lost += len(lw)
            else:
                keep.append(line)
        failed = n < 20 or 100 * int(repeated[i]) > 30 * n
        for k, v in (("doc_id", cols["doc_id"][i]), ("n_words", n), ("word_chars", len(t) - sum(t.count(c) for c in BLANKS)),
                     ("n_symbols", sum(t.count(c) for c in SYMBOLS)), ("n_dup_lines", dup),
                     ("n_repeat_words", int(repeated[i])), ("base_failed", failed),
                     ("kept", not failed and lost <= max_lost * n), ("n_lines", lines), ("n_bad_lines", bad),
                     ("lost_words", lost), ("text", "\n".join(keep))):
            out[k].append(v)
    return out


def quality_rules(docs: DataFrame, max_lost: float = 0.4) -> DataFrame:
    """One row per document: base counts, ``kept``, and ``text`` without the lines that failed."""
    return map_slices(id_text(docs), lambda cols, _: _judge(cols, max_lost), SCHEMA)
