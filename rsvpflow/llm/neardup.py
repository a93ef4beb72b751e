"""Near-duplicate groups by MinHash, exact confirmation and star components (operator 10).

1. A document's set is its distinct shingles of ``size`` words (A-Z lowered, ASCII blanks between words).  Equal sets form
   classes by a 128-bit digest; only the smallest id of a class goes on, so copies are never paired.
2. ``bands * rows`` universal hash minima per class, cut into bands; equal bands meet in buckets.  At a similarity of 0.8
   a pair misses all 40 bands of 5 with a chance of 1e-7.
3. In every bucket each class is paired with the smallest one only.  Pairs whose signatures agree too little are dropped
   (5 standard deviations below the threshold), the others are confirmed on their full sets.
4. Confirmed links make components by alternating large-star and small-star.
5. Where a bucket of more than one tile (step 6) still holds several components besides its centre, the members outside its
   largest one are paired with a fresh centre from that one, another in every bucket, and again as long as a round spares
   the tiles more rows than it takes: a group of near copies joins in a few linear rounds.  Classes already connected need
   no further comparison: it could not change a component.
6. What then is still open is compared in tiles of bounded size, by signature and then on full sets: the members outside
   the largest component of a bucket with each other, and with that component, either bucket by bucket or, where that
   sends fewer rows, once for all buckets that it is the largest of.  A tile returns no more links than join the
   components it can join.  So components are what all links above the threshold give, and the pairs of a group are
   never written out.

Defined cases: fewer than ``size`` words make one shingle of the whole sequence; no words or null text give an empty set,
linked with nothing; rows with one id are one node, linked by any of their texts; a null id never represents a class that
has another id, and is a group of its own (component null, kept) if none has; repeated rows give a result row each;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rsvpflow.llm.batches import fold_ascii, id_text, map_slices, starts_of
from rsvpflow.session import checkpoint_root

_MUL = np.uint64(0x9E3779B97F4A7C15)
TILE = 128
TILE_SHINGLES = 1 << 20
#: Rows of ids that one task takes; a set within it is not dealt over the session's shuffle partitions.
TASK_ROWS = 100_000


class _WordHash(dict):
    """64-bit hash of a word, kept for the words of the last slices; emptied when it holds ``most`` words."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        self.most = most

    def __missing__(self, w: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
        return h


def shingle_sets(texts: list[str | None], size: int, cache: _WordHash) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, set sizes): the sorted distinct shingle hashes of all texts end to end."""
    split = [fold_ascii(t).split() if t else [] for t in texts]
    lens = np.array([len(s) for s in split], dtype=np.int64)
    total = int(lens.sum())
    if not total:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    h = np.fromiter((cache[w] for ws in split for w in ws), dtype=np.uint64, count=total)
    doc = np.repeat(np.arange(len(texts)), lens)
    left = np.repeat(starts_of(lens) + lens, lens) - np.arange(total)  # words from here to the end of the text
    span = np.minimum(lens, size)[doc]
    start = np.flatnonzero(left >= span)
    x = np.zeros(len(start), np.uint64)
    for j in range(size):
        use = span[start] > j
        y = (x ^ h[np.minimum(start + j, total - 1)]) * _MUL
        x = np.where(use, y ^ (y >> np.uint64(31)), x)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    d = doc[start]
    order = np.lexsort((x, d))
    x, d = x[order], d[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = (x[1:] != x[:-1]) | (d[1:] != d[:-1])
    return x[new], np.bincount(d[new], minlength=len(texts))


def minima(x: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """(documents with a set, n) minima of ``n`` universal hashes ``a * x + b`` modulo 2**32."""
    rng = np.random.Generator(np.random.Philox(11))
    a = rng.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    low = (x ^ (x >> np.uint64(32))).astype(np.uint32)
    at = starts_of(sizes[sizes > 0])
    out = np.empty((len(at), n), np.uint32)
    for i in range(n):
        out[:, i] = np.minimum.reduceat(low * a[i] + b[i], at)
    return out


def _features(cols: dict, state: dict) -> dict:
    x, sizes = shingle_sets(cols["text"], state["size"], state["cache"])
    full = np.flatnonzero(sizes)
    out = {"doc_id": cols["doc_id"], "n_shingles": sizes, "key": [None] * len(sizes), "sig": [None] * len(sizes), "buckets": [None] * len(sizes)}
    if not len(full):
        return out
    m = minima(x, sizes, state["bands"] * state["rows"])
    bucket = np.empty((len(full), state["bands"]), np.uint64)
    for band in range(state["bands"]):
        h = np.full(len(full), band + 1, np.uint64)
        for j in range(state["rows"]):
            h = (h ^ m[:, band * state["rows"] + j].astype(np.uint64)) * _MUL
            h ^= h >> np.uint64(32)
        bucket[:, band] = h
    bucket, low, at = bucket.view(np.int64), (m & np.uint32(255)).astype(np.uint8), starts_of(sizes)
    for k, i in enumerate(full.tolist()):
        out["key"][i] = hashlib.blake2b(x[at[i]:at[i] + sizes[i]].tobytes(), digest_size=16).digest()
        out["sig"][i] = low[k].tobytes()
        out["buckets"][i] = bucket[k].tolist()
    return out


def _agree_share(share: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """Shares of equal bytes, of ``n``, that pairs at the threshold reach: five standard deviations of slack."""
    return share >= threshold - 5.3 * (threshold * (1 - threshold) / n) ** 0.5


def _kept(df: DataFrame) -> tuple[DataFrame, int, int | None]:
    """(checkpointed frame, its rows, a sum of row hashes); rows and sum are observed while it is written.

    A set of at most ``TASK_ROWS`` rows stays in one task, so the joins and groups after it need no exchange among themselves.
    """
    seen = Observation()
    kept = df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("mark")).checkpoint()
    n, mark = seen.get["n"], seen.get["mark"]
    return (kept.coalesce(1) if n <= TASK_ROWS else kept), n, mark


def components(edges: DataFrame) -> DataFrame:
    """(node, component): smallest node reachable, by alternating large-star and small-star over ``edges(a, b)``.

    Each step sends at most one row per edge end; the edges are cut from their lineage by a checkpoint per round.
    """
    e, *before = _kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct())

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        """Link each neighbour (larger ones, or smaller ones and the node itself) to the smallest of a neighbourhood."""
        if large:
            near = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            near = near.coalesce(1) if small else near  # two single tasks make one
        else:
            near = pairs
        least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        linked = near.join(least, "u")
        if large:
            out = linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
            out = out.coalesce(1) if small else out
        return out.filter("u != v").distinct()

    while True:
        small = before[0] <= TASK_ROWS
        e, *after = _kept(star(star(e, True), False))
        if after == before:
            break
        before = after
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, s): full shingle sets of the given ids, as sorted 64-bit hashes."""
    def sets(cols, cache):
        x, sizes = shingle_sets(cols["text"], size, cache)
        at = starts_of(sizes)
        return {"id": cols["id"], "s": [x[i:i + n].tobytes() for i, n in zip(at.tolist(), sizes.tolist())]}

    texts = docs.withColumnRenamed("doc_id", "id").join(ids, "id", "left_semi").select("id", "text")
    return map_slices(texts, sets, "id long, s binary", setup=_WordHash).filter("octet_length(s) > 0")


def _only(table: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """The rows of ``table`` that a join with at most ``n`` ids needs: few ids are sent to it, so no other row is shuffled."""
    return table.join(F.broadcast(ids), "id", "left_semi") if n <= TASK_ROWS else table


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()


def _confirm(pairs: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    pairs, n, _ = _kept(pairs)
    full = _only(full, _ends(pairs), 2 * n)

    def check(cols, _):
        out = {"a": [], "b": []}
        for a, b, x, y in zip(cols["a"], cols["b"], cols["sa"], cols["sb"]):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            if both >= threshold * (len(x) + len(y) - both) - 1e-9:
                out["a"].append(a)
                out["b"].append(b)
        return out

    one = full.select(F.col("id").alias("a"), F.col("s").alias("sa"))
    two = full.select(F.col("id").alias("b"), F.col("s").alias("sb"))
    return map_slices(pairs.join(two, "b").join(one, "a").select("a", "b", "sa", "sb"), check, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, bands: int = 40, rows: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable), kept."""
    checkpoint_root(docs.sparkSession)
    texts = id_text(docs)
    feats = map_slices(texts, _features, "doc_id long, n_shingles long, key binary, sig binary, buckets array<long>",
                       setup=lambda: {"size": size, "bands": bands, "rows": rows, "cache": _WordHash()}).checkpoint()
    # equal sets have equal signatures, so any member's will do; copies meet before the shuffle
    classes = (feats.filter("key is not null").groupBy("key")
               .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"), F.first("buckets").alias("buckets"))
               .checkpoint())
    sigs = classes.filter("rep is not null").select(F.col("rep").alias("id"), "n", "sig")

    banded = classes.filter("rep is not null").select(F.col("rep").alias("id"), F.explode("buckets").alias("bucket"))
    centres = banded.groupBy("bucket").agg(F.min("id").alias("c"), F.max("id").alias("last")).filter("c != last")
    star, _, _ = _kept(banded.join(centres.select("bucket", "c"), "bucket").filter("id != c"))
    ids, _, _ = _kept(star.select("id").unionByName(star.select(F.col("c").alias("id"))).distinct())
    sigs, _, _ = _kept(sigs.join(ids, "id", "left_semi"))

    def filter_signatures(cols, _):
        if not cols["a"]:
            return {"a": [], "b": [], "score": []}
        x, y = (np.frombuffer(b"".join(cols[c]), np.uint8).reshape(len(cols["a"]), -1) for c in ("sa", "sb"))
        score = (x == y).mean(axis=-1)
        ok = np.flatnonzero(_agree_share(score, x.shape[-1], threshold)).tolist()
        return {"a": [cols["a"][i] for i in ok], "b": [cols["b"][i] for i in ok], "score": [float(score[i]) for i in ok]}

    def likely_of(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, score) whose signatures agree enough."""
        signed = (pairs.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sb")), "b")
                  .join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sa")), "a"))
        return map_slices(signed.select("a", "b", "sa", "sb"), filter_signatures, "a long, b long, score double")

    likely = likely_of(star.select(F.col("c").alias("a"), F.col("id").alias("b")).distinct()).select("a", "b")
    full = _sets(texts, ids, size).checkpoint()  # once, for all confirmations
    links, _, _ = _kept(_confirm(likely, full, threshold))
    comp = components(links)

    links, still = _fresh_rounds(star, comp, links, likely_of, lambda pairs: _confirm(pairs, full, threshold))
    if still is not None:
        comp = components(links)
        more, n, _ = _kept(_open_links(still, comp, sigs, full, threshold))
        links = links.unionByName(more)
        comp = components(links) if n else comp
    else:
        comp = components(links)

    label = classes.select("key", "rep").join(comp.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("component", "rep").alias("component_id"))
    alone = comp.select(F.col("node").alias("doc_id"), F.col("component").alias("of"))
    found = feats.filter("key is not null").select("doc_id", "n_shingles", "key").join(label, "key").select("doc_id", "n_shingles", "component_id")
    none = (feats.filter("key is null").select("doc_id", "n_shingles").join(alone, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("of", "doc_id").alias("component_id")))
    return found.unionByName(none).withColumn("kept", F.expr("doc_id <=> component_id"))


def spanning_links(left: list, right: list, same: bool, threshold: float) -> list[tuple[int, int]]:
    """Links between members of different components that join all components which the given pairs can join.

    Members are (id, comp, sig, s); pairs are those of ``left`` and ``right`` (``same``: of one list with itself).
    Pairs whose signatures agree are compared on their full sets, but for those already joined through others here.
    """
    p, q = (np.stack([np.frombuffer(m["sig"], np.uint8) for m in side]) for side in (left, right))
    cp, cq = (np.array([m["comp"] for m in side]) for side in (left, right))
    score = np.stack([(p[i][None, :] == q).mean(axis=1) for i in range(len(left))])
    ok = _agree_share(score, p.shape[1], threshold) & (cp[:, None] != cq[None, :])
    if same:
        ok &= np.arange(len(left))[:, None] < np.arange(len(right))[None, :]
    i_all, j_all = np.nonzero(ok)
    if not len(i_all):
        return []
    sp, sq = ([np.frombuffer(m["s"], np.uint64) for m in side] for side in (left, right))
    common = None
    if len(i_all) > len(left) + len(right):  # many: all intersections at once, as a product of incidence matrices
        used = [sp[i] for i in range(len(left))] + [sq[j] for j in range(len(right))]
        words, inv = np.unique(np.concatenate(used), return_inverse=True)
        if len(words) * len(used) <= 1 << 24:
            m = np.zeros((len(used), len(words)), np.float32)
            m[np.repeat(np.arange(len(used)), [len(u) for u in used]), inv] = 1
            common = m[:len(left)] @ m[len(left):].T
            sizes = m.sum(axis=1)
            ok &= common >= threshold * (sizes[:len(left), None] + sizes[None, len(left):] - common) - 1e-4
            i_all, j_all = np.nonzero(ok)
    boss: dict[int, int] = {}

    def find(x):
        while boss.get(x, x) != x:
            x = boss[x]
        return x

    out = []
    for k in np.argsort(-score[i_all, j_all], kind="stable").tolist():
        i, j = int(i_all[k]), int(j_all[k])
        a, b = find(int(cp[i])), find(int(cq[j]))
        if a == b:
            continue
        both = round(float(common[i, j])) if common is not None else len(np.intersect1d(sp[i], sq[j], assume_unique=True))
        if both >= threshold * (len(sp[i]) + len(sq[j]) - both) - 1e-9:
            boss[max(a, b)] = min(a, b)
            out.append((left[i]["id"], right[j]["id"]))
    return out


def _fresh_rounds(star: DataFrame, comp: DataFrame, links: DataFrame, likely_of, confirmed) -> tuple[DataFrame, DataFrame | None]:
    """(links with those of the rounds, what is still open).

    A round pairs each member outside the largest component of its bucket with one member of that component, picked anew by
    a hash of bucket and round: no more pairs than memberships.  Of the pairs between two components only the one whose
    signatures agree best is confirmed: one link joins them.  Labels only fall, and components are taken from all links in the
    end.  Buckets that one tile holds are left to the tiles, which send each membership once as well.  The rounds end with one
    that links nothing or spares the tiles fewer rows than it took.  Open are the rows (bucket, id) of buckets that may hold
    several labels, None if there are none.
    """
    known = star.join(comp.select(F.col("node").alias("id"), "component"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("comp"))
    tiles = lambda n: F.ceil(n / TILE)
    m, o = F.col("top.n"), F.col("n") - F.col("top.n")
    rest, took, before, turn = None, 0, 0, 0
    while True:
        known, _, _ = _kept(known)
        per = known.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
        tops, _, _ = _kept(per.groupBy("bucket").agg(F.max(F.struct("n", "comp")).alias("top"), F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"))
                           .filter("k > 1").select("bucket", F.col("top.comp").alias("main"), "n", (m * tiles(o) + o * (tiles(m) + tiles(o))).alias("sent")))
        if rest is None:
            rest, n, _ = _kept(known.join(tops.select("bucket"), "bucket", "left_semi").select("bucket", "id"))
            if not n:
                return links, None
        large = tops.filter(F.col("n") > TILE)
        n, sent = large.agg(F.sum("n"), F.sum("sent")).first()
        if not n or turn and before - sent <= took:
            return links, rest
        took, before = n, sent
        still, _, _ = _kept(known.join(large.select("bucket", "main"), "bucket"))
        fresh = still.filter("comp = main").groupBy("bucket").agg(F.max_by("id", F.xxhash64("id", "bucket", F.lit(turn))).alias("f"))
        asked, _, _ = _kept(still.filter("comp != main").join(fresh, "bucket").select(
            F.least("f", "id").alias("a"), F.greatest("f", "id").alias("b"), "main", "comp").distinct())
        best = (likely_of(asked.select("a", "b").distinct()).join(asked, ["a", "b"]).groupBy("main", "comp")
                .agg(F.max(F.struct("score", "a", "b")).alias("p")).select("p.a", "p.b").distinct())
        found, linked, _ = _kept(confirmed(best))
        if not linked:
            return links, rest
        links = links.unionByName(found)
        # the larger label takes the smallest it is linked with; what that leaves apart meets again in the next round
        joined = asked.join(found, ["a", "b"], "left_semi")
        lower = (joined.select(F.greatest("main", "comp").alias("comp"), F.least("main", "comp").alias("to")).groupBy("comp").agg(F.min("to").alias("to")))
        known = still.select("bucket", "id", "comp").join(lower, "comp", "left").select("bucket", "id", F.coalesce("to", "comp").alias("comp"))
        turn += 1


def _open_links(known: DataFrame, comp: DataFrame, sigs: DataFrame, full: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between different components whose members share a bucket, from rows (bucket, id) of buckets that may hold
    several."""
    known = known.join(comp.select(F.col("node").alias("id"), "component"), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("comp"))
    known, _, _ = _kept(known)
    mixed = known.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("bucket")
    rows, _, _ = _kept(known.join(mixed, "bucket", "left_semi").join(sigs.select("id", "n"), "id"))
    per_comp = rows.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"), F.sum("n").alias("w"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("x"))
    per = per_comp.groupBy("bucket").agg(F.max(F.struct("n", "comp", "w")).alias("top"), F.sum("n").alias("n"), F.sum("w").alias("w"), F.sum("x").alias("x"))
    # buckets of one membership are compared once; a tile side has about TILE members and TILE_SHINGLES shingles
    parts = lambda n, w: F.greatest(F.ceil(n / TILE), F.ceil(w / TILE_SHINGLES)).cast("long")
    todo = per.groupBy("n", "x").agg(F.min_by(F.struct("bucket", "top", "w"), F.col("bucket")).alias("b")).select(
        F.col("b.bucket").alias("bucket"), F.col("b.top.comp").alias("main"), F.col("b.top.n").alias("m"), (F.col("n") - F.col("b.top.n")).alias("o"),
        parts(F.col("n") - F.col("b.top.n"), F.col("b.w") - F.col("b.top.w")).alias("nx"), parts(F.col("b.top.n"), F.col("b.top.w")).alias("ny"))
    todo, _, _ = _kept(todo)
    at = lambda n: F.pmod(F.xxhash64("id"), n)
    zero = F.lit(0).cast("long")
    spread, _, _ = _kept(rows.join(todo, "bucket").withColumn("rest", F.col("comp") != F.col("main")))
    # a largest component whose buckets would send more rows than the component itself is sent once, under its own label
    outside, _, _ = _kept(spread.filter("rest").select("main", "id", "comp", "n").distinct())
    inside = comp.select(F.col("node").alias("id"), F.col("component").alias("main")).join(outside.select("main").distinct(), "main").join(sigs.select("id", "n"), "id")
    size = lambda df, c, w: df.groupBy("main").agg(F.count(F.lit(1)).alias(c), F.sum("n").alias(w))
    whole = size(outside, "o", "wo").join(size(inside, "m", "wm"), "main").select("main", "o", "m", parts(F.col("o"), F.col("wo")).alias("nx"), parts(F.col("m"), F.col("wm")).alias("ny"))
    sent = todo.groupBy("main").agg(F.sum(F.col("m") * F.col("nx") + F.col("o") * F.col("ny")).alias("sent"))
    whole = whole.join(sent, "main").filter(F.col("m") * F.col("nx") + F.col("o") * F.col("ny") < F.col("sent")).select("main", "nx", "ny")
    whole, _, _ = _kept(whole)
    others = spread.filter("rest").withColumn("i", at(F.col("nx")))
    split = spread.join(whole.select("main"), "main", "left_anti")
    apart = split.filter("rest").withColumn("i", at(F.col("nx")))
    largest = split.filter("not rest").withColumn("i", at(F.col("ny")))
    far = outside.join(whole, "main").withColumn("i", at(F.col("nx")))
    core = inside.join(whole, "main").withColumn("i", at(F.col("ny")))

    def against(few, many, scope, bucket, theirs):
        """Tiles (x, -1 - y) of the few and the largest component."""
        one = few.select("*", F.explode(F.sequence(zero, F.col("ny") - 1)).alias("k")).select(
            F.lit(scope).alias("scope"), F.col(bucket).alias("bucket"), F.col("i").alias("x"), (-1 - F.col("k")).alias("y"), F.lit(False).alias("right"), "id", "comp")
        two = many.select("*", F.explode(F.sequence(zero, F.col("nx") - 1)).alias("k")).select(
            F.lit(scope).alias("scope"), F.col(bucket).alias("bucket"), F.col("k").alias("x"), (-1 - F.col("i")).alias("y"), F.lit(True).alias("right"), "id",
            F.col(theirs).alias("comp"))
        return one.unionByName(two)

    # tile (x, y), x <= y, of the others among themselves
    tiles = (others.select("*", F.explode(F.sequence(zero, F.col("nx") - 1)).alias("k"))
             .select(F.lit(0).alias("scope"), "bucket", F.least("i", "k").alias("x"), F.greatest("i", "k").alias("y"), (F.col("i") > F.col("k")).alias("right"), "id", "comp")
             .unionByName(against(apart, largest, 0, "bucket", "comp")).unionByName(against(far, core, 1, "main", "main")))
    # signature and set meet once per id, so what is dealt over the tiles is joined with one table
    tiles, n, _ = _kept(tiles)
    filled = tiles.join(sigs.select("id", "sig").join(_only(full, tiles.select("id").distinct(), n), "id"), "id")
    grouped = filled.groupBy("scope", "bucket", "x", "y").agg(F.collect_list(F.struct("right", "id", "comp", "sig", "s")).alias("members"))

    def compare(cols, _):
        out = []
        for x, y, members in zip(cols["x"], cols["y"], cols["members"]):
            left = [m for m in members if not m["right"]]
            right = left if x == y else [m for m in members if m["right"]]
            if left and right:
                out += spanning_links(left, right, x == y, threshold)
        return {"a": [min(e) for e in out], "b": [max(e) for e in out]}

    return map_slices(grouped, compare, "a long, b long", rows=64).distinct()


def keep_first(docs: DataFrame, size: int = 5, threshold: float = 0.8) -> DataFrame:
    """The documents, all columns, that are the smallest id of their near-duplicate group; null ids stay.

    Of repeated rows of a kept id all stay.
    """
    names = docs.columns
    inner = [f"_c{i}" for i in range(len(names))]
    key = inner[names.index("doc_id")]
    gone = near_duplicates(docs, size, threshold).filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    numbered = docs.toDF(*inner)
    return numbered.join(gone, numbered[key].cast("long") == F.col("_gone"), "left_anti").toDF(*names)
