"""Small tables and plain reference versions for the tests of the training-data operators."""

import random
import re
import zlib

DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = ", id long, h long, key string, sig string, score double, kept string, component_id long, bucket long, host string, _drop string"


def docs_table(spark, rows, clash=False):
    """Rows (doc_id, text[, lang]) as a documents table; with ``clash`` also columns named like the operators' own."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
    if not clash:
        return spark.createDataFrame(full, DOC)
    return spark.createDataFrame([f + (1, 2, "k", "s", 0.5, "x", 3, 4, "h", "d") for f in full], DOC + CLASH)


def hard_rows():
    """Nulls in id and text, empty, blank, very long, tied and repeated rows."""
    rng = random.Random(1)
    vocab = ["w%d" % i for i in range(400)]
    long = "\n".join(" ".join(rng.choice(vocab) for _ in range(60)) + "." for _ in range(700))
    a = "One line of plain words that ends well.\nAnother line of plain words that ends well too, and goes on for a while."
    return [(1, None), (2, ""), (3, " \n\t\x0b\x0c\r\n "), (4, a), (5, a), (5, a), (6, long), (7, long + " end"), (None, a), (None, None),
            (8, "x"), (9, "é" * 5000), (10, "\n".join(["same line"] * 200)), (11, "1234 5678"), (-3, "a b c d"), (-3, "a b c d"),
            (12, "\U0001f600     tail"), (13, "a" * 20000 + "@"), (14, "9" * 20000), (15, "x\u0000y ￾")]


def doc_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def jaccard_groups(rows, size, threshold):
    """{doc_id: (set size, smallest id reachable)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        ws = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
        ws = doc_words(ws)
        s = {tuple(ws[k:k + size]) for k in range(len(ws) - size + 1)} or ({tuple(ws)} if ws else set())
        sets[i] = s
    boss = {i: i for i in sets}

    def find(x):
        while boss[x] != x:
            x = boss[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if not a or not b or min(len(a), len(b)) < threshold * max(len(a), len(b)):
                continue
            both = len(a & b)
            if 100 * both >= 100 * threshold * len(a | b) - 1e-6:
                x, y = find(i), find(j)
                boss[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}
