"""Operators between rows: extraction, decontamination, line dedup, packing, near duplicates."""

import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rsvpflow.llm import decontaminate, extract, lines, neardup, packing, queries
from tests.llm.helpers import docs_table, hard_rows, jaccard_groups

SF = "/root/testdata/sf0.01"


def read_docs(spark, sf=SF):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


# ---------------------------------------------------------------- decontamination

def plain_leaks(rows, items, size=5, threshold=0.8):
    cut = lambda t: {tuple(w[k:k + size]) for w in [re.findall(r"\w+", (t or "").lower())] for k in range(len(w) - size + 1)}
    sets = [(i, cut(t)) for i, t in items]
    out = []
    for d, t in rows:
        own = cut(t)
        out += [(d, i, len(s & own), len(s)) for i, s in sets if s and len(s & own) >= threshold * len(s) - 1e-9]
    return sorted(out, key=str)


def test_leaks_equal_brute_force(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op5_decontaminate(spark, SF).collect()
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got), key=str) == plain_leaks(read_docs(spark), items)


@pytest.mark.parametrize("block", [1_000_000, 1000])
def test_leaks_at_the_threshold(spark, block):
    rng = random.Random(8)
    word = lambda: "w%d" % rng.randint(0, 5000)
    items = [(i, " ".join(word() for _ in range(rng.randint(5, 60)))) for i in range(60)] + [(90, None), (91, ""), (92, "too short it"), (93, "a b c d e"), (93, "f g h i j k")]
    rows = hard_rows()
    for n in range(300):
        ws = rng.choice(items[:60])[1].split()
        for _ in range(rng.randint(0, 4)):
            ws[rng.randrange(len(ws))] = word()
        pad = [word() for _ in range(rng.randint(0, 800))]
        at = rng.randint(0, len(pad))
        rows.append((1000 + n, " ".join(pad[:at] + ws + pad[at:]).replace(" ", rng.choice([" ", "\n", ", "]))))
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id long")
    docs = docs_table(spark, rows, True)
    got = decontaminate.contamination(docs, bench, block_shingles=block).collect()
    want = plain_leaks(rows, items)
    assert sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in got), key=str) == want and len(want) > 50
    left = decontaminate.decontaminate(docs, bench, block_shingles=block)
    dirty = {d for d, *_ in want}
    assert left.columns == docs.columns and left.count() == sum(d not in dirty for d, _ in rows)
    assert decontaminate.contamination(docs.limit(0), bench).count() == 0
    assert decontaminate.contamination(docs, bench.limit(0)).count() == 0 and decontaminate.decontaminate(docs, bench.limit(0)).count() == len(rows)


# ---------------------------------------------------------------- line dedup

def plain_lines(rows, least):
    """Lines inside a run of ``least`` words or more that stands, line by line, in an earlier document."""
    docs = []
    for i, t in rows:
        at = [(p, x.split()) for p, x in enumerate((t or "").split("\n")) if x.encode().split()]
        docs.append((i, [" ".join(w) for _, w in at], [len(w) for _, w in at], [p for p, _ in at]))
    out = {}
    for i, key, size, pos in docs:
        gone = set()
        for e, early, _, _ in docs:
            if e >= i:
                continue
            for a in range(len(early)):
                for b in range(len(key)):
                    if early[a] == key[b] and not (a and b and early[a - 1] == key[b - 1]):
                        n = 0
                        while a + n < len(early) and b + n < len(key) and early[a + n] == key[b + n]:
                            n += 1
                        if sum(size[b:b + n]) >= least:
                            gone.update(pos[b:b + n])
        out[i] = gone
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(9)
    pool = [" ".join("l%d_%d" % (k, j) for j in range(rng.randint(1, 9))) for k in range(400)]
    rows, bodies = [], []
    for i in range(150):
        body = [rng.choice(pool) for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            if bodies:
                src = rng.choice(bodies)
                a = rng.randint(0, len(src))
                body[rng.randint(0, len(body)):0] = src[a:a + rng.randint(1, 8)]
        bodies.append(body)
        rows.append((i, rng.choice(["\n", "\n\n", " \n"]).join(body)))
    want = plain_lines(rows, 12)
    got = {r.doc_id: r for r in lines.dedup_lines(docs_table(spark, rows, True), 12).collect()}
    texts = dict(rows)
    n_more = 0
    for i, r in got.items():
        kept = [x for p, x in enumerate(texts[i].split("\n")) if p not in want[i]]
        n_more += r.text != "\n".join(kept)
    assert sum(map(len, want.values())) > 100
    assert n_more == 0


def test_line_dedup_moved_blocks_and_copies(spark):
    p, q, r = (" ".join(f"{c}{i}" for i in range(50)) for c in "pqr")
    rows = [(1, f"{p}\nx\n{q}"), (2, f"{q}\ny\n{p}\n{r}"), (3, f"{p}\nx\n{q}"), (3, f"{p}\nx\n{q}"), (4, f"z\n{r}\nz"), (None, r), (5, "short\nlines"), (6, "short\nlines")]
    got = sorted(((x.doc_id or 99, x.text) for x in lines.dedup_lines(docs_table(spark, rows)).collect()), key=str)
    assert got == sorted([(1, rows[0][1]), (2, f"y\n{r}"), (3, ""), (3, ""), (4, "z\nz"), (99, ""), (5, "short\nlines"), (6, "short\nlines")], key=str)
    table = docs_table(spark, rows, True)
    out = lines.rewrite(table)
    assert out.columns == table.columns and out.schema == table.schema
    assert sorted((x.doc_id, x.text, x.n_chars) for x in out.collect()) == [(1, rows[0][1], len(rows[0][1])), (2, f"y\n{r}", len(r) + 2), (4, "z\nz", 3), (5, "short\nlines", 11), (6, "short\nlines", 11)]


def test_line_dedup_rare_lines_below_the_floor(spark):
    rng = random.Random(17)
    line = lambda n: " ".join("r%d" % rng.randint(0, 10 ** 9) for _ in range(n))
    one, two, short, often = line(12), line(25), line(6), line(15)
    half = [line(6), line(7)]  # rare together
    rows = [(i, "\n".join([line(20), often, short, line(30)])) for i in range(8)]
    rows += [(20, f"{one}\nx y\n{two}"), (21, f"{line(9)}\n\n{two}\nz"), (22, f"q\n{one}\n" + "\n".join(half)), (23, "\n".join(half) + f"\n{one}\n{one}"), (23, "\n".join(half) + f"\n{one}\n{one}")]
    got = [(r.doc_id, r.text, r.n_removed) for r in lines.dedup_lines(docs_table(spark, rows, True), line_words=10, rare_docs=4).collect()]
    want = [(i, t, 0) for i, t in rows if i < 21] + [(21, rows[9][1].replace(f"\n{two}", ""), 1), (22, "q\n" + "\n".join(half), 1), (23, "", 4), (23, "", 4)]
    assert sorted(got) == sorted(want)


def test_line_dedup_query_leaves_no_rare_repeat(spark):
    left = defaultdict(set)
    for r in queries.op6_lines(spark, SF).collect():
        for x in {" ".join(x.split()) for x in r.text.split("\n")}:
            left[x].add(r.doc_id)
    held = defaultdict(set)
    for i, t in read_docs(spark):
        for x in (t or "").split("\n"):
            held[" ".join(x.split())].add(i)
    rare = [x for x in held if 10 <= len(x.split()) and 1 < len(held[x]) <= 100]
    assert len(rare) > 100 and all(len(left[x]) <= 1 for x in rare)


def test_line_dedup_hard_rows(spark):
    out = lines.dedup_lines(docs_table(spark, hard_rows(), True)).collect()
    assert len(out) == len(hard_rows())
    assert [r.text for r in out if r.doc_id == 7] == [""] or any(r.doc_id == 7 and r.n_removed for r in out)
    assert [r.text for r in out if r.doc_id == 1] == [None]
    assert lines.dedup_lines(docs_table(spark, hard_rows()).limit(0)).count() == 0


def test_patience_keeps_order():
    rng = random.Random(10)
    for _ in range(500):
        a, b = ([rng.randint(0, 12) for _ in range(rng.randint(0, 20))] for _ in range(2))
        got = lines.patience(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:]))


# ---------------------------------------------------------------- packing

def test_packing_is_exact(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    rows = read_docs(spark)[:400] + [(r[0] if r[0] != 5 else 5, r[1]) for r in hard_rows() if r[0] is None or r[0] > 0]
    rows = [(i if i is not None and i < 0 else (None if i is None else 10_000 + n), t) for n, (i, t) in enumerate(rows)]
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t in rows if i is not None}
    pieces = packing.pack(docs_table(spark, rows, True), queries.tokenizer_path("word_bpe_49k.json")).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_seq[p.sequence_id].append(p)
    for i, ids in want.items():
        got, at = [], 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            part = np.frombuffer(p.ids, "<u4").tolist()
            assert len(part) == p.length > 0
            got, at = got + part, at + p.length
        assert got == ids
    pad = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
        pad += 0 if at & (at - 1) == 0 else 2048 - at
    assert pad == 0
    assert sum(p.length for p in pieces if p.doc_id is None) == sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in rows if i is None)
    assert packing.pack(docs_table(spark, rows).limit(0), queries.tokenizer_path("word_bpe_49k.json")).count() == 0


def test_packing_query(spark):
    got = queries.op7_packing(spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in got} == {i for i, _ in read_docs(spark, "/root/testdata/sf0.001")}
    full = packing.pack(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), queries.tokenizer_path("word_bpe_49k.json"))
    assert {(r.doc_id, r.start, zlib.crc32(r.ids)) for r in full.collect()} == {(r.doc_id, r.start, r.ids_crc32) for r in got}


def test_hilbert_curve_visits_neighbours():
    side = np.arange(8)
    pts = np.stack(np.meshgrid(side, side, side), axis=-1).reshape(-1, 3)
    key = packing.hilbert_key(pts, 3)
    assert sorted(key.tolist()) == list(range(512))
    walk = pts[np.argsort(key)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


# ---------------------------------------------------------------- near duplicates

def test_near_duplicates_equal_brute_force_on_documents(spark):
    rows = read_docs(spark)
    want = jaccard_groups(rows, 4, 0.8)
    got = {r.doc_id: r for r in queries.op10_neardup(spark, SF).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in got.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    assert len(set(c for _, c in want.values())) < len(rows)


def test_near_duplicates_chains_and_tiles(spark, monkeypatch):
    rng = random.Random(12)
    rows, n = [], 0
    for g in range(3):
        base = ["g%d_%d" % (g, k) for k in range(60 + 40 * g)]
        variants = [base]
        for _ in range(60):  # copies of copies: many links hold only between members other than the smallest id
            ws = list(rng.choice(variants[-8:]))
            for _ in range(rng.randint(0, 2)):
                ws[rng.randrange(len(ws))] = "e%d" % rng.randint(0, 10 ** 6)
            variants.append(ws)
        rng.shuffle(variants)
        for ws in variants:
            rows.append((n, " ".join(w.upper() if rng.random() < 0.1 else w for w in ws)))
            n += 1
    rows += [(1000 + i, t) for i, t in enumerate(["", None, "a", "A", "a b", "a b c", "A B c", "a b c d", "İstanbul x", "istanbul x"])]
    monkeypatch.setattr(neardup, "TILE", 8)
    for size in (4, 5):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(docs_table(spark, rows, True), size=size).collect()}
        assert got == jaccard_groups(rows, size, 0.8)


def test_near_duplicates_hard_rows(spark):
    docs = docs_table(spark, hard_rows(), True)
    out = neardup.near_duplicates(docs).collect()
    assert len(out) == len(hard_rows())
    by = defaultdict(set)
    for r in out:
        by[r.doc_id].add((r.component_id, r.kept))
    assert by[5] == {(4, False)} and by[7] == {(6, False)} and by[6] == {(6, True)} and by[-3] == {(-3, True)} and by[2] == {(2, True)}
    assert by[None] == {(4, False), (None, True)}
    left = neardup.keep_first(docs)
    assert left.columns == docs.columns and sorted(r.doc_id or 99 for r in left.collect()) == sorted(i or 99 for i, _ in hard_rows() if i not in (5, 7))
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_paths_and_stars(spark):
    rng = random.Random(13)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)] + [(rng.randint(200, 300), rng.randint(200, 300)) for _ in range(60)]
    boss = {}
    find = lambda x: x if boss.get(x, x) == x else find(boss[x])
    for a, b in edges:
        a, b = find(a), find(b)
        boss[max(a, b)] = min(a, b)
    from rsvpflow.session import checkpoint_root

    checkpoint_root(spark)
    got = {r.node: r.component for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    for x in {v for e in edges for v in e}:
        assert got.get(x, x) == find(x)


# ---------------------------------------------------------------- extraction

def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>{body}</body></html>"


def test_blocks():
    got = lambda s: [t for t, _ in extract.blocks(s)]
    assert got("<p>a &amp; b&nbsp;c<br>d<p>e <b>f</b>g</p>h") == ["a & b c", "d", "e fg", "h"]
    assert got("<nav><p>x</p></nav><div class='side-bar sidebar'>x<p>y</div><article>k<footer>z</footer>m</article>") == ["k", "m"]
    assert got("<div class=ad>x<div>y</div></div><p class=\"main\">k</p><!-- <p>c --><p hidden>h<p>l<div id=comments><p>r</div>") == ["k", "l"]
    assert got("text &lt;b&gt; <a title='x > y'>link</a> <p") == ["text <b> link"]
    assert got(None) == [] and got("") == [] and got("<") == ["<"] and got("a < b") == ["a < b"]
    assert got("<script>" + "x" * 10) == [] and got("<ul><li>a<li>b</ul>") == ["a", "b"]
    assert got("<article><header><h1>T</h1></header>x</article><header>y</header>") == ["T", "x"]


def test_boilerplate_is_removed_across_pages_of_a_host(spark):
    rng = random.Random(14)
    rows = []
    for i in range(70):
        art = "\n".join(" ".join("a%d" % rng.randint(0, 9999) for _ in range(30)) for _ in range(3))
        body = "<div>Home News About Contact Jobs Press Help Terms of our site</div>" + "".join(f"<div>{x}</div>" for x in art.split("\n"))
        rows.append((i, f"http://big.example.com/{i}", page(body + "<div>Copyright of the big example company and of all its many partners</div>"), art))
    rows.append((100, "http://one.example.com/1", page("<div>only page of a host, kept whole</div>"), "only page of a host, kept whole"))
    rows += [(200, None, None, ""), (201, "no host", "", ""), (None, None, "plain", "plain"), (202, "http://big.example.com/0", rows[0][2], rows[0][3])]
    rows.append((203, "http://x.example.com/long", page("<p>" + "word " * 200000 + "</p>"), " ".join(["word"] * 200000)))
    table = spark.createDataFrame([(a, b, c, "h", 1) for a, b, c, _ in rows], "page_id long, url string, html string, host string, h long")
    got = {r.page_id: r for r in extract.main_text(table).collect()}
    assert len(got) == len(rows)
    for i, _, _, text in rows:
        assert got[i].text == text and got[i].n_chars == len(text)
    assert got[0].n_boilerplate == 2
    assert extract.main_text(table.limit(0)).count() == 0


@pytest.mark.parametrize("max_rows", [None, 3])
def test_boilerplate_is_decided_on_the_whole_host(spark, max_rows):
    rng = random.Random(16)
    fresh = lambda n: " ".join("u%d" % rng.randint(0, 10 ** 9) for _ in range(n))
    notice, rare, once, inside = (" ".join(f"{c}{i}" for i in range(12)) for c in ("notice", "rare", "once", "inside"))
    rows = []
    for i in range(66):  # 66 pages in chunks of 4: the last chunk has two; the rare notice is on 8 pages, one a chunk or two at most
        own = fresh(20)
        extra = (f"<div>{rare}</div>" if i % 8 == 0 and i < 64 else "") + (f"<div>{once}</div>" if i in (3, 40) else "")
        rows.append((i, f"http://a.example.com/{i}", page(f"<div>{own}</div><div>{notice}</div>{extra}"), own + (f"\n{once}" if i in (3, 40) else "")))
    for i in range(100, 110):  # each page is longer than a chunk
        own = fresh(3000)
        rows.append((i, f"http://long.example.com/{i}", page(f"<div>{own}</div><div>{notice}</div>"), own))
    for i in range(200, 240):  # articles only: on half of the pages or more a repeat goes, on fewer it stays
        own = fresh(20)
        rows.append((i, f"http://art.example.com/{i}", page(f"<article><p>{own}</p>" + (f"<p>{inside}</p>" if i % 4 else "") + (f"<p>{rare}</p>" if i % 4 == 1 else "") + "</article>"),
                     own + (f"\n{rare}" if i % 4 == 1 else "")))
    rows += [(300 + i, "http://twin.example.com/", page(f"<div>{once}</div><div>{rare}</div>"), f"{once}\n{rare}") for i in range(12)]  # one page, twelve times
    table = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").repartition(5)
    got = {r.page_id: r for r in extract.main_text(table, chunk_pages=4, chunk_chars=8000, max_rows=max_rows).collect()}
    assert len(got) == len(rows)
    assert {i for i, _, _, text in rows if got[i].text != text} == set()


def test_kept_sets_know_their_rows(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TASK_ROWS", 50)
    some = spark.range(40).repartition(4).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    kept, n, mark = neardup._kept(some)
    assert n == 40 == kept.count() and kept.rdd.getNumPartitions() == 1
    assert neardup._kept(some.repartition(3))[1:] == (40, mark) and neardup._kept(some.limit(0))[1] == 0
    path = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))  # above the bound
    assert neardup._kept(path)[0].rdd.getNumPartitions() > 1
    assert {r.component for r in neardup.components(path).collect()} == {0}


def test_wrappers_keep_the_article():
    got = lambda s: [t for t, _ in extract.blocks(s)]
    assert got("<form action=x><nav>n</nav><article><p>k</p></article><input><button>b</button></form>") == ["k"]
    assert got("<article class='post has-sidebar'>k</article><div class='post has-sidebar'>l</div>") == ["k", "l"]
    assert got("<main class=no-comments>k<div class=comments>r</div></main>") == ["k"]
    assert got("<div id=content class=share-page>k</div><div class='share'>s</div>") == ["k"]
    assert got("<aside><article>k</article></aside><aside>x</aside><form>y</form>") == ["k"]
    assert got("<form><h1>T</h1><p>a long text of the page</p></form><form><p>sign up</p></form>") == ["T", "a long text of the page"]
    assert got("<div class='site-footer'>x</div><ul class='comment-list'><li>r</ul><section id=cookie_banner>c</section>k") == ["k"]
    assert got("<article>k</article><section class=comments><article class=comment>r</article></section>")[0] == "k"
    assert got("<template><article>x</article></template><nav><h1>x</h1><p>xxxxxxxxxxxxxxxxxxxxxxxxx</nav>k") == ["k"]


def test_reader_comments_that_are_articles_go():
    got = lambda s: [t for t, _ in extract.blocks(s)]
    assert got("<article>k</article><section class=comments><article class=comment>r</article></section>") == ["k"]
    assert got("<article>k<ol class='comment-list'><li><article>a much longer reply</article></ol></article>") == ["k"]


def test_deep_and_unclosed_markup_takes_linear_time():
    import time

    begin = time.time()
    n = 40000
    assert [t for t, _ in extract.blocks("<div>" * n + "k" + "</span>" * n)] == ["k"]
    assert [t for t, _ in extract.blocks("<b>" * n + "<p>k" * 3 + "</i>" * n)] == ["k"] * 3
    assert [t for t, _ in extract.blocks("<p>k<span>" * n)] == ["k"] * n
    assert extract.blocks("<form><div class=ad>" * n + "x") == []
    assert len(extract.blocks("<form><h1>t</h1>" + "<div class=ad><p>x</p>" * n)) <= n + 1
    assert time.time() - begin < 20


def test_runs_equal_plain_counts():
    """Every window of the runs stands on enough pages, every window that does lies in a run, and runs go as far as they can."""
    rng = random.Random(21)
    for need in (1, 2, 3):
        streams = []
        for _ in range(6):
            x = [rng.choice((2, 3)) for _ in range(rng.randint(0, 40))]
            streams.append(np.array(x + [1, 0], dtype=np.uint64))
        d = extract.DEPTH
        on: dict[tuple, set] = {}
        for p, x in enumerate(streams):
            for i in range(len(x) - d):
                on.setdefault(tuple(x[i:i + d].tolist()), set()).add(p)
        good = {w for w, ps in on.items() if len(ps) >= need}
        runs = [np.frombuffer(r, np.uint64).tolist() for r in extract.maximal_runs(streams, need)]
        assert {tuple(r[i:i + d]) for r in runs for i in range(len(r) - d + 1)} == good
        want = set()
        for x in streams:
            x, i = x.tolist(), 0
            while i < len(x) - d:
                j = i
                while j < len(x) - d and tuple(x[j:j + d]) in good:
                    j += 1
                if j > i:
                    want.add(tuple(x[i:j + d - 1]))
                i = max(j, i + 1)
        assert {tuple(r) for r in runs} == want
    assert extract.maximal_runs([np.array([0], dtype=np.uint64)] * 3, 1) == set()


@pytest.mark.parametrize("max_rows", [None, 0])
def test_a_quoted_sentence_stays(spark, max_rows):
    """Seven of 400 pages without article quote a sentence: it stays, a notice on a fifth goes; also with joined sets."""
    rng = random.Random(22)
    quote, notice = (" ".join(f"{c}{i}" for i in range(14)) for c in ("quote", "notice"))
    rows = []
    for i in range(400):
        own = " ".join("u%d" % rng.randint(0, 10 ** 9) for _ in range(12))
        with_quote = i % 60 == 1
        rows.append((i, "http://q.example.com/%d" % i, page(f"<div>{own}</div>" + (f"<div>{quote}</div>" if with_quote else "") + (f"<div>{notice}</div>" if i % 5 == 0 else "")),
                     own + (f"\n{quote}" if with_quote else "")))
    rows += [(1000 + i, "nowhere", page(f"<div>{notice}</div>"), notice) for i in range(5)]
    table = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in extract.main_text(table, max_rows=max_rows).collect()}
    assert got == {i: text for i, _, _, text in rows}


def test_joined_sets_travel_once_a_slot(spark, monkeypatch):
    """Beyond the bounds the rows are those of pages and items once a slot, not one a token."""
    monkeypatch.setattr(extract, "SLOT_PAGES", 10)
    stored = spark.range(95).select(F.col("id").alias("rid"), F.lit(1).cast("long").alias("hk"), F.lit(b"").alias("blob"), F.lit(0).cast("long").alias("size"))
    sets = spark.createDataFrame([(1, b"a"), (1, b"b"), (2, b"c")], "hk long, item binary")
    slots = spark.createDataFrame([(1, 10), (2, 4)], "hk long, slots long")
    seen = []

    def row(cols, n, found, suffixes, out):
        out["rid"].append(cols["rid"][n])
        out["items"].append(len(found))

    real = extract.map_slices
    monkeypatch.setattr(extract, "map_slices", lambda df, *a, **k: seen.append(df.count()) or real(df, *a, **k))
    got = extract._beside(stored, sets, slots, lambda items: list(items), row, "rid long, items long", 0).collect()
    assert sorted(r.rid for r in got) == list(range(95)) and {r["items"] for r in got} == {2}
    assert seen[-1] == 95 + 2 * 10 + 4


def test_pages_equal_articles(spark):
    """Articles of the given pages by a plain reading of their one layout."""
    import html

    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op2_extract(spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        art = re.split(r"</article>", re.split(r"<article>", r.html, maxsplit=1)[1], maxsplit=1)[0]
        parts = re.split(r"</?(?:p|h1|br|li|ul|div|h2|td|tr|table)[^>]*>", art)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts]
        assert got[r.page_id].text == "\n".join(t for t in texts if t)
        assert got[r.page_id].n_chars == len(got[r.page_id].text)


def test_chunks_encode_like_the_library():
    from pathlib import Path

    from tokenizers import Tokenizer

    from rsvpflow.llm.batches import words

    blob = Path(queries.tokenizer_path("word_bpe_49k.json")).read_text(encoding="utf-8")
    tok, encode, rng = Tokenizer.from_str(blob), packing.chunk_encoder(blob, most=50), random.Random(15)
    bits = ["a", "the", "É", "é", "ñ", "'s", "'LL", "'", "1", "２", "½", "ª", "!", "?!", "<|endoftext|>", "<|", "|>", "ß", "İ", "ı", "Σ", "ς", "́",
            "é", " ", " ", "中", "😀", "ﬁ", "µ", "×", " ", "\n", "​", "ÿ", "Ā", "Ð", "\x00", "\x01", "\x1f", "\x7f", "\x85", "­", "﻿"]
    for _ in range(8000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(1, 12)))
        got = np.frombuffer(b"".join(encode[w] for w in words(text)), "<u4").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("tile", [128, 8])
def test_near_rounds_take_no_more_rows_than_they_spare(spark, monkeypatch, tile):
    """Buckets that a tile holds are asked for once; larger ones again only while that spares the tiles more than it takes."""
    rng = random.Random(21)
    rows = []
    for g in range(12):  # groups whose members lie at about the threshold of each other: few links, many open buckets
        base = ["g%d_%d" % (g, k) for k in range(90)]
        for _ in range(20):
            ws = list(base)
            for _ in range(rng.randint(1, 4)):
                ws[rng.randrange(len(ws))] = "e%d" % rng.randint(0, 10 ** 6)
            rows.append((len(rows), " ".join(ws)))
    monkeypatch.setattr(neardup, "TILE", tile)
    asked, inner = [], neardup._confirm
    monkeypatch.setattr(neardup, "_confirm", lambda pairs, *rest: asked.append(1) or inner(pairs, *rest))
    opened, tiles = [], neardup._open_links
    monkeypatch.setattr(neardup, "_open_links", lambda known, *rest: opened.append(known.count()) or tiles(known, *rest))
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs_table(spark, rows)).collect()}
    assert got == {i: c for i, (_, c) in jaccard_groups(rows, 5, 0.8).items()}
    assert opened and opened[0] > 0
    assert len(asked) == 1 if tile == 128 else 1 < len(asked) <= 4


def test_near_group_makes_rows_in_proportion(spark):
    """One group of n near copies of one text: rows that joins and generators make grow like n, not like its square."""
    rng = random.Random(5)
    base = ["w%d" % i for i in range(150)]

    def made(n):
        rows = []
        for i in range(n):
            ws = list(base)
            for _ in range(rng.randint(1, 6)):
                ws[rng.randrange(len(ws))] = "e%d" % rng.randint(0, 10 ** 6)
            rows.append((i, " ".join(ws)))
        docs = docs_table(spark, rows)
        asked = []
        inner = neardup._open_links

        def watch(known, *rest):
            asked.append(known.count())
            return inner(known, *rest)

        neardup._open_links = watch
        try:
            got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, size=4).collect()}
        finally:
            neardup._open_links = inner
        assert got == {i: c for i, (_, c) in jaccard_groups(rows, 4, 0.8).items()}
        return sum(asked)

    small, large = made(100), made(300)
    assert large <= 6 * small + 40 * 300  # at most the memberships of the group, whatever is left open
