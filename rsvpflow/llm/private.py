"""Personal data by weak supervision (operator 4).

Exact patterns give the base spans (email, ip, card, phone).  Wider patterns propose further candidates; five labelers
(pattern, check, gazetteer, context, boundary) vote on every candidate.  The votes of all documents are counted by
pattern of votes, expectation-maximisation estimates each labeler's reliability per kind from those counts, and a
logistic span classifier is fitted to the resulting soft labels.  Candidates it accepts are added to the base spans,
which always stay.

What reaches the driver is one counter per vote pattern, at most ``4 * 3 ** 5`` rows whatever the input.

Defined cases: null text counts as empty and has no spans; a null id or a repeated row gives one result row each;
extra columns are ignored; an empty table gives an empty result.  Texts are read whole; every scan is linear in them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import id_text, map_slices

KINDS = ("email", "ip", "card", "phone")
LABELERS = 5
SCHEMA = ("doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_spans long")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_WIDE = (
    ("email", re.compile(r"(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63} ?[\[({] ?(?:at|AT|@) ?[\])}] ?[A-Za-z0-9-]{1,63}"
                         r"(?: ?(?:\.|[\[({] ?(?:dot|DOT) ?[\])}]) ?[A-Za-z0-9-]{1,63}){1,8}")),
    ("ip", re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Za-z:])")),
    ("card", re.compile(r"(?<![0-9])[0-9]{4}([./_ ])[0-9]{4}\1[0-9]{4}\1[0-9]{2,7}(?![0-9])")),
    ("phone", re.compile(r"(?<![0-9+])(?:00[1-9][0-9]{0,2}[ .-])?(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])[0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])")),
)

#: Words beside personal data, words beside other numbers, and common top-level domains.
_NEAR = {
    "email": re.compile(r"e-?mail|contact|write|reach|correo|courriel|schreib", re.I),
    "ip": re.compile(r"\bip\b|host|server|address|login|ping", re.I),
    "card": re.compile(r"card|visa|master|amex|credit|payment|karte|carte|tarjeta", re.I),
    "phone": re.compile(r"tel|phone|call|fax|mobile|cell|whatsapp|ruf|appel|llam", re.I),
}
_OTHER = re.compile(r"version|release|isbn|issn|order|invoice|serial|ticket|article|part no", re.I)
_TLD = frozenset("com org net edu gov mil int info biz io co uk de fr es it nl eu ch at be se no dk fi pl ru jp cn in br "
                 "au ca us mx ar".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the exact patterns, leftmost and non-overlapping per kind."""
    out = []
    last, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at)
        start = at
        while m and start > last and text[start - 1] in _LOCAL:
            start -= 1
        if m and start < at:
            out.append((start, 0, m.end()))
            last = m.end()
        at = text.find("@", max(at + 1, last))
    if not _DIGIT.search(text):  # the other kinds consist of digits
        return out
    for m in _DOTTED.finditer(text):  # a maximal dotted number: addresses are its parts, four at a time
        if m.group().count(".") < 3:
            continue
        ends = [x.span() for x in re.finditer(r"[0-9]+", m.group())]
        for i in range(0, len(ends) - 3, 4):
            four = [m.group()[a:b].lstrip("0") for a, b in ends[i:i + 4]]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in four):
                out.append((m.start() + ends[i][0], 1, m.start() + ends[i + 3][1]))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            d = _digits(m.group())
            if 14 <= len(d) <= 19 and luhn(d):
                out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def wide_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates of the wider patterns that touch no base span."""
    out = []
    digit = _DIGIT.search(text) is not None
    may = {"email": any(c in text for c in "[({"), "ip": text.count(":") >= 7, "card": digit, "phone": digit}
    for name, pattern in _WIDE:
        if not may[name]:  # the pattern needs what the text lacks
            continue
        for m in pattern.finditer(text):
            out.append((m.start(), KINDS.index(name), m.end()))
    out.sort()
    keep, b = [], 0
    for s, k, e in out:
        while b < len(base) and base[b][2] <= s:
            b += 1
        if (b == len(base) or base[b][0] >= e) and not (keep and keep[-1][2] > s):
            keep.append((s, k, e))
    return keep


def votes(text: str, span: tuple[int, int, int], exact: bool) -> tuple[int, ...]:
    """Each labeler's vote on a span: 1 personal, 0 not, 2 abstains."""
    s, k, e = span
    body, d = text[s:e], _digits(text[s:e])
    near = text[max(0, s - 40):s] + " " + text[e:e + 20]
    if k == 0:
        check = 1 if re.search(r"[A-Za-z0-9]", body) else 0
        tail = re.sub(r"[^a-z]", " ", body.lower()).split()
        place = 1 if tail and tail[-1] in _TLD else 2
    elif k == 1:
        check = 1 if exact or len(set(body.lower().split(":"))) > 2 else 0
        place = 2 if exact else 1
    elif k == 2:
        check = int(14 <= len(d) <= 19 and luhn(d))
        place = 1 if d[:1] in ("3", "4", "5", "6") else 0
    else:
        check = int(7 <= len(d) <= 15 and len(set(d)) > 2)
        place = 1 if body[0] in "+(" or body.startswith("00") else 2
    context = 1 if _NEAR[KINDS[k]].search(near) else 0 if _OTHER.search(near) else 2
    glued = (s > 0 and (text[s - 1].isalnum() or text[s - 1] in "_/=")) or (e < len(text) and (text[e].isalnum() or text[e] in "_/="))
    return (1 if exact else 2, check, place, context, 0 if glued else 1)


def encode(kind: int, v: tuple[int, ...]) -> int:
    for x in v:
        kind = kind * 3 + x
    return kind


def decode(code: int) -> tuple[int, tuple[int, ...]]:
    v = []
    for _ in range(LABELERS):
        code, x = divmod(code, 3)
        v.append(x)
    return code, tuple(reversed(v))


def _count(cols: dict, _) -> dict:
    seen: Counter = Counter()
    for t in cols["text"]:
        if t:
            base = base_spans(t)
            for sp in base:
                seen[encode(sp[1], votes(t, sp, True))] += 1
            for sp in wide_spans(t, base):
                seen[encode(sp[1], votes(t, sp, False))] += 1
    return {"code": list(seen), "n": list(seen.values())}


def reliabilities(patterns: dict[int, int], rounds: int = 50) -> dict[int, float]:
    """Expectation-maximisation over counted vote patterns: the chance that each pattern marks personal data.

    Two classes per kind; a labeler has its own vote distribution in each class (add-one smoothed), the start is the
    share of yes votes, so that the classes keep their meaning.
    """
    out: dict[int, float] = {}
    for kind in range(len(KINDS)):
        codes = sorted(c for c in patterns if decode(c)[0] == kind)
        if not codes:
            continue
        v = np.array([decode(c)[1] for c in codes])
        n = np.array([patterns[c] for c in codes], dtype=float)
        yes, no = (v == 1).sum(axis=1), (v == 0).sum(axis=1)
        p = (yes + 0.5) / (yes + no + 1.0)
        hot = np.stack([v == x for x in range(3)], axis=2).astype(float)
        for _ in range(rounds):
            prior = (1 + (n * p).sum()) / (2 + n.sum())
            like = []
            for w in (n * p, n * (1 - p)):
                t = 1 + np.einsum("i,ijk->jk", w, hot)
                like.append(np.einsum("ijk,jk->i", hot, np.log(t / t.sum(axis=1, keepdims=True))))
            odds = np.log(prior) + like[0] - np.log(1 - prior) - like[1]
            p = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
        out.update(zip(codes, p.tolist()))
    return out


def _features(code: int) -> np.ndarray:
    kind, v = decode(code)
    x = np.zeros(1 + len(KINDS) + 2 * LABELERS)
    x[0] = 1
    x[1 + kind] = 1
    for j, y in enumerate(v):
        if y != 2:
            x[1 + len(KINDS) + 2 * j + y] = 1
    return x


def span_classifier(patterns: dict[int, int], steps: int = 30, ridge: float = 1.0) -> np.ndarray:
    """Logistic weights fitted by Newton steps to the soft labels of all counted candidates."""
    p = reliabilities(patterns)
    width = len(_features(0))
    w = np.zeros(width)
    if not p:
        return w
    x = np.stack([_features(c) for c in p])
    y = np.array(list(p.values()))
    n = np.log1p(np.array([patterns[c] for c in p], dtype=float))  # frequent patterns don't drown the rest
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (n * (y - q)) - ridge * w
        hess = (x * (n * q * (1 - q))[:, None]).T @ x + ridge * np.eye(width)
        w = w + np.linalg.solve(hess, grad)
    return w


def _spans(cols: dict, weights: np.ndarray) -> dict:
    out = {f.split()[0]: [] for f in SCHEMA.split(", ")}
    for doc, t in zip(cols["doc_id"], cols["text"]):
        t = t or ""
        base = base_spans(t)
        more = [sp for sp in wide_spans(t, base) if _features(encode(sp[1], votes(t, sp, False))) @ weights > 0]
        text_of = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)
        both = sorted(base + more)
        kinds = Counter(k for _, k, _ in base)
        row = (doc, kinds[0], kinds[1], kinds[2], kinds[3], hashlib.sha256(text_of(base).encode()).hexdigest(), text_of(both), len(both))
        for k, v in zip(out, row):
            out[k].append(v)
    return out


def personal_data(docs: DataFrame) -> DataFrame:
    """One row per document: counts and digest of the base spans, and all spans as ``kind:start:end``."""
    rows = id_text(docs)
    counted = map_slices(rows.select("text"), _count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    weights = span_classifier({r["code"]: r["n"] for r in counted.collect()})  # at most 4 * 3 ** 5 rows
    return map_slices(rows, lambda cols, _: _spans(cols, weights), SCHEMA)
