"""Operators over a global order: manifest, resampling, URL rules."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rsvpflow.llm import manifest, queries, ranges, resample, urls
from tests.conftest import SF_SMALL
from tests.llm.helpers import crc, docs_table, hard_rows

SF = "/root/testdata/sf0.01"


# ---------------------------------------------------------------- ranges

def test_numbers_of_a_hot_group(spark):
    rows = spark.range(0, 4000).selectExpr("case when id % 3 = 0 then 'hot' else concat('g', id % 50) end as g", "id % 7 as k", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ranges.numbered(ranges.ranged(rows, [F.col("g").asc(), F.col("k").asc()], "t"), "g").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append(r)
    assert len(got) == 4000 and len({r.part for r in groups["hot"]}) > 1
    for rs in groups.values():
        assert sorted(r.pos for r in rs) == list(range(len(rs))) and {r.n for r in rs} == {len(rs)}
        assert [r.k for r in sorted(rs, key=lambda r: r.pos)] == sorted(r.k for r in rs)


def test_equal_rows_are_spread(spark):
    rows = spark.range(0, 5000).selectExpr("'one' as g")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = ranges.ranged(rows, [F.col("g").asc()], "t").groupBy("part").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(parts) > 4 and max(r["count"] for r in parts) < 2000


# ---------------------------------------------------------------- manifest

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows, fan=8):
    """rows of (doc_id, source, lang, n_chars, text) -> multiset of result rows, from whole lists of nodes."""
    leaf = lambda r: H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r))

    def climb(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([H(*levels[-1][k:k + fan]) for k in range(0, len(levels[-1]), fan)])
        return levels

    def proof(levels, x):
        out = []
        for nodes in levels[:-1]:
            a = x // fan * fan
            out.append((nodes[a:x], nodes[x + 1:a + fan]))
            x //= fan
        return out

    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {g: climb([leaf(r) for r in groups[g]]) for g in langs}
    top = climb([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for q, g in enumerate(langs):
        for x, r in enumerate(groups[g]):
            steps = proof(trees[g], x) + proof(top, q)
            now = r
            if r[0] is not None and crc(r[0]) % 3 == 0 and r[4] is not None:
                now = (*r[:4], re.sub("[A-Z]", lambda m: m.group().lower(), r[4]))
            h = leaf(now)
            for a, b in steps:
                h = H(*a, h, *b)
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], H(*(s for a, b in steps for s in (*a, *b))), h, h == top[-1][0]))
    return out


def found(df):
    return sorted(map(tuple, df.select(F.col("key"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=str)


def tamper():
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 0


@pytest.mark.parametrize("clash", [False, True])
@pytest.mark.parametrize("block", [1 << 15, 24, 7])
def test_manifest_equals_plain_version(spark, monkeypatch, clash, block):
    """Also with blocks that cut runs, so that fetched and spanning nodes of several levels are in use."""
    rng = random.Random(3)
    rows = hard_rows() + [(100 + i, f"Text {i}", rng.choice(["en", "de", "En", "é", "", None])) for i in range(300)] + [(7, "lone", "xx")]
    rows = [(i, t if t is None else t.replace("\x00", " "), *r) for i, t, *r in rows]
    df = docs_table(spark, rows, clash)
    if block < 100:
        # the tasks get the block size with the module's own functions
        monkeypatch.setattr(manifest, "BLOCK", block)
    plain = [(r[0], "s", r[2] if len(r) > 2 else "en", len(r[1] or ""), r[1]) for r in rows]
    assert found(manifest.document_manifest(df, tamper()).proofs()) == sorted(plain_manifest(plain), key=str)


@pytest.mark.parametrize("n", [0, 1, 8, 9, 65])
def test_manifest_of_few(spark, n):
    rows = [(i, f"T{i}", "en") for i in range(n)]
    got = found(manifest.document_manifest(docs_table(spark, rows), tamper()).proofs())
    assert got == sorted(plain_manifest([(i, "s", "en", len(t), t) for i, t, _ in rows]), key=str)


def test_single_proofs_fold_to_the_root(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    for fan in (2, 8):
        got = manifest.document_manifest(docs, fan=fan).proofs(siblings=True).collect()
        assert len(got) == docs.count() and len({r.root for r in got}) == 1
        for r in got:
            assert r.verified and manifest.fold(r.leaf, r.siblings, r.pos, r.n, r.q, r.trees, fan) == r.root
            assert manifest.fold(H(r.leaf), r.siblings, r.pos, r.n, r.q, r.trees, fan) != r.root


def test_missing_nodes_are_minimal():
    """What a block asks for is what no leaf of it can derive, and all of it is used."""
    for n, lo, hi in ((1, 0, 1), (64, 0, 64), (100, 3, 5), (513, 17, 90), (513, 500, 513), (4097, 4096, 4097)):
        leaves = [H(str(i)).encode() for i in range(n)]
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([manifest._digest(levels[-1][k:k + 8]) for k in range(0, len(levels[-1]), 8)])
        asked = list(manifest._missing(lo, hi, n, 8))
        assert len(set(asked)) == len(asked)
        for level, i in asked:  # outside the block's own span
            assert i * 8 ** level >= hi or (i + 1) * 8 ** level <= lo
        runs, root = manifest._climb(lo, leaves[lo:hi], n, {c: levels[c[0]][c[1]] for c in asked}, 8)
        assert root == levels[-1][0]


# ---------------------------------------------------------------- resampling

def plain_features(text, lo, hi):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    ws = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return ws, [" ".join(ws[i:i + g]) for g in range(lo, hi + 1) for i in range(len(ws) - g + 1)]


def plain_resample(rows, target, lo=1, hi=1, buckets=10000, percent=10, min_words=20, seed=2024):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    docs = [(i, *plain_features(t, lo, hi)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in docs for f in fs)
    t = Counter(bucket(f) for x in target for f in plain_features(x, lo, hi)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    out = []
    for i, ws, fs in docs:
        g = [math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets)))) for b in map(bucket, fs)]
        w = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(ws)])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


@pytest.mark.parametrize("lo,hi", [(1, 1), (1, 3), (2, 2)])
def test_resample_equals_plain_version(spark, lo, hi):
    rng = random.Random(11)
    vocab = ["w%d" % i for i in range(200)] + ["Été", "日本", "A1", "x" * 90]
    rows = hard_rows() + [(100 + i, " -- ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for i in range(200)]
    target = ["w1 w2 W3", None, "", "été w1 w2"]
    df = docs_table(spark, rows, True)
    tg = spark.createDataFrame([(x, 1) for x in target], "text string, doc_id int")
    got = resample.resample(df, tg, lo, hi, buckets=997, percent=30, min_words=5)
    assert sorted(map(tuple, got.collect()), key=str) == plain_resample(rows, target, lo, hi, 997, 30, 5)


def test_resample_of_nothing(spark):
    docs = docs_table(spark, hard_rows())
    none = docs.limit(0)
    assert resample.resample(none, none).count() == 0
    rows = [(i, t) for i, t, *_ in hard_rows()]
    assert sorted(map(tuple, resample.resample(docs, none).collect()), key=str) == plain_resample(rows, [])


def test_crc_of_substrings():
    """Windows, lanes and long words: every n-gram's CRC equals that of its own bytes."""
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 3, 9, 700]))) for _ in range(400)).encode(), b"", None, b"one", b"--", b"z" * 5000]
    c = resample.Crc()
    for window in (1 << 22, 300):
        old, resample._WINDOW = resample._WINDOW, window
        try:
            n, got = resample.features(texts, 1, 4, 1 << 32, c)
        finally:
            resample._WINDOW = old
        for t, k, g in zip(texts, n, got):
            ws, fs = plain_features((t or b"").decode(), 1, 4)
            assert len(ws) == k and Counter(map(zlib.crc32, (f.encode() for f in fs))) == Counter(g.tolist())
    data = np.frombuffer(rng.randbytes(3000), dtype=np.uint8)
    run = c.running(data)
    a, b = np.array([0, 1, 511, 512, 513, 2999, 5]), np.array([3000, 1, 512, 2000, 1025, 3000, 6])
    assert c.substrings(run, a, b).tolist() == [zlib.crc32(data[i:j].tobytes()) for i, j in zip(a, b)]


# ---------------------------------------------------------------- URL rules

def plain_judge(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = re.sub("[A-Z]", lambda m: m.group().lower(), host)
    fit = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[4] if best else default


def test_url_rules_equal_plain_version(spark):
    """Hot host, nested hosts and paths, labels that sort around the dot, partitions that begin inside a host."""
    rng = random.Random(4)
    labels = ["a", "b", "a-b", "a0", "", "net", "com", "\x01", "\x00", "\x012", "é"]
    hosts = [".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))) for _ in range(120)]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/x/y", "/de/", "/de/x", "//", "/en/x/yy"]
    rules = list({(rng.choice(["block", "allow"]), h, p) for h in hosts[:60] for p in rng.sample(paths, 3) if h})
    made = [f"https://{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '?q=1', '#t', '?a://b'])}" for _ in range(1500)]
    made += ["HTTP://A.B.NET/en/x"] * 500 + [None, "", "a.b/c", "://", "http://", "x://a.b:80/en/", "http://u@a.b/en/"] * 3
    rows = [(None if i % 97 == 0 else i // 2, u) for i, u in enumerate(made)]
    pages = spark.createDataFrame([(*r, "k", 1, "h", "p", "v") for r in rows], "page_id long, url string, key string, at int, host string, path string, verdict string")
    rdf = spark.createDataFrame(rules + [("block", None, "/"), ("block", "", "/"), rules[0]], "verdict string, host string, path string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = urls.judge(pages, rdf)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(((i, *plain_judge(u, rules)) for i, u in rows), key=str)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_url_rules_of_nothing(spark):
    rules = spark.createDataFrame(queries.URL_RULES, "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.net/x"), (1, "http://a.net/x")], "page_id long, url string")
    assert urls.judge(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in urls.judge(pages, rules.limit(0), "block").collect()] == [(1, "a.net", "/x", None, "block")] * 2
    assert {r.rule for r in urls.judge(pages, rules).collect()} == {"net/"}
    # an empty path does not start with "/"
    bare = spark.createDataFrame([(2, "http://a.net"), (3, "http://a.net?x/")], "page_id long, url string")
    assert {tuple(r)[1:] for r in urls.judge(bare, rules).collect()} == {("a.net", "", None, "allow")}
