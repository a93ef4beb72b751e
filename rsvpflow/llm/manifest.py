"""Merkle dataset manifest: one hash tree per group of rows, one tree over the groups' roots, and a proof per row.

Leaves lie in key order over range partitions, cut into blocks of consecutive leaves.  A first pass hashes what lies whole
inside a block and gives out its *frontier* (the largest finished nodes); the few nodes that span blocks are built level
by level from those in small aggregations.  The proofs are an octopus multiproof: from its own range a block knows which
node coordinates it cannot derive — on each level the rest of the first and of the last run, nothing else — asks for their
union once (one equi-join with the frontier and spanning nodes, a few dozen rows a block), derives all interior nodes that
its leaves share, and expands the single proofs locally.  No proof node is shuffled twice, none is sent per leaf.

``H`` is lower-case hex SHA-256 of the concatenated inputs, digests as hex text; ``fan`` consecutive nodes (the last run:
fewer, even one) become their H until one is left; a lone leaf is its tree's root.

Defined cases: null fields hash as ``-`` (an empty text as ``0:``); a null group is a tree of its own, the first one; null
ids come first in their group and are never counted as tampered with by the query; rows equal in group and id lie in order
of their leaf, wholly equal rows are leaves of their own; no rows give no rows; other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import arrow_schema
from rsvpflow.llm.ranges import numbered, placed, ranged, stored

#: Leaves of a block, a bound on a task's memory: it holds the leaves and shared nodes of one block at a time.
BLOCK = 1 << 15
_TOP = "#"  # the tree over the subroots; others are '' (null group) or '=' and the group
_NODE = "tree string, n long, level long, idx long, hash string"


def leaf_hash(values: Sequence[Column]) -> Column:
    """H of the values in order, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value as text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _digest(parts: Sequence[bytes]) -> bytes:
    return hashlib.sha256(b"".join(parts)).hexdigest().encode()


def _frontier(lo: int, cur: list[bytes], n: int, fan: int):
    """(level, index, hash) of the largest nodes that leaves ``lo ..`` of a tree of ``n`` finish by themselves."""
    level = 0
    while n > 1:
        hi = lo + len(cur)
        first, last = -(-lo // fan), -(-n // fan) if hi == n else hi // fan
        if last <= first:
            break
        for i in (*range(lo, first * fan), *range(min(last * fan, n), hi)):
            yield level, i, cur[i - lo]
        cur = [_digest(cur[k * fan - lo: min(k * fan + fan, n) - lo]) for k in range(first, last)]
        lo, n, level = first, -(-n // fan), level + 1
    for i, h in enumerate(cur):
        yield level, lo + i, h


def _missing(lo: int, hi: int, n: int, fan: int):
    """Coordinates (level, index) that leaves ``lo .. hi - 1`` need and cannot derive: what completes their outer runs."""
    level = 0
    while n > 1:
        end = min(-(-hi // fan) * fan, n)
        yield from ((level, i) for i in (*range(lo // fan * fan, lo), *range(hi, end)))
        lo, hi, n, level = lo // fan, -(-hi // fan), -(-n // fan), level + 1


def _climb(lo: int, cur: list[bytes], n: int, got: dict, fan: int) -> tuple[list[tuple[int, list[bytes]]], bytes]:
    """Per level the whole runs over the leaves ``lo ..`` (start, nodes), from them and the nodes fetched; and the root."""
    runs, level = [], 0
    while n > 1:
        hi = lo + len(cur)
        a, b = lo // fan * fan, min(-(-hi // fan) * fan, n)
        run = [got[level, i] for i in range(a, lo)] + cur + [got[level, i] for i in range(hi, b)]
        runs.append((a, run))
        cur = [_digest(run[i:i + fan]) for i in range(0, len(run), fan)]
        lo, n, level = a // fan, -(-n // fan), level + 1
    return runs, cur[0]


def _run(runs, level: int, x: int, fan: int) -> tuple[list[bytes], int]:
    """The run that holds node ``x`` of a level, and its place there."""
    a, nodes = runs[level]
    k = x // fan * fan - a
    return nodes[k:k + fan], x % fan


def _frontiers(rows: DataFrame, fan: int) -> DataFrame:
    """Frontier nodes of the runs of consecutive leaves that a task meets, blocks kept apart."""
    def run(batches):
        out = arrow_schema(_NODE)
        key, start, held = None, 0, []

        def done():
            found = [(key[1], key[3], lv, i, h.decode()) for lv, i, h in _frontier(start, held, key[3], fan)] if held else []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found) if found else [[]] * 5, out)], schema=out)

        for batch in batches:
            part, tree, pos, n, leaf = (batch.column(i).to_pylist() for i in range(5))
            for j, p in enumerate(pos):
                now = (part[j], tree[j], p // BLOCK, n[j])
                if now != key or p != start + len(held):
                    yield done()
                    key, start, held = now, p, []
                held.append(leaf[j].encode())
        yield done()

    return rows.select("part", "tree", "pos", "n", "leaf").mapInArrow(run, _NODE)


def _height(n: int, fan: int) -> int:
    level = 0
    while n > 1:
        n, level = -(-n // fan), level + 1
    return level


def _grown(frontier: DataFrame, fan: int) -> DataFrame:
    """``frontier`` and all nodes above it: one small aggregation a level, groups of at most ``fan`` rows."""
    most = frontier.agg(F.max("n")).first()[0] or 1
    levels, above = [], None
    for level in range(_height(most, fan) + 1):
        here = frontier.filter(F.col("level") == level)
        here = here if above is None else here.unionByName(above)
        levels.append(here)
        width = fan ** level
        runs = here.filter(F.col("n") > width).groupBy("tree", "n", F.expr(f"idx div {fan}").alias("idx")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "hash"))).alias("run"))
        up = runs.select("tree", "n", F.lit(level + 1).cast("long").alias("level"), "idx", F.sha2(F.array_join("run.hash", ""), 256).alias("hash"))
        if most > width:
            above = stored(up, "manifest-level")
    out = levels[0]
    for x in levels[1:]:
        out = out.unionByName(x)
    return out


class Manifest:
    """The trees over a table: ``leaves`` (part, tree, pos, n, key, leaf, altered), ``nodes`` (frontier and spanning nodes
    of all trees) and ``tops`` (tree, q, trees: the subroot's place in the top tree)."""

    def __init__(self, docs: DataFrame, key: Column, group: Column, leaf: Column, altered: Column | None = None, fan: int = 8):
        """``altered``: the leaf as it is found now, null where nothing is known to have changed."""
        tree = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
        rows = docs.select(tree.alias("tree"), key.cast("long").alias("key"), leaf.alias("leaf"),
                           (F.lit(None) if altered is None else altered).cast("string").alias("altered"))
        self.fan = fan
        order = [F.col("tree").asc(), F.col("key").asc_nulls_first(), F.col("leaf").asc()]
        self.leaves = numbered(ranged(rows, order, "manifest-leaves"), "tree")
        grown = _grown(stored(_frontiers(self.leaves, fan), "manifest-frontier"), fan)
        height = F.when(F.col("n") <= 1, 0)
        for level in range(1, 64):
            if fan ** level >= 1 << 62:
                break
            height = height.when(F.col("n") <= fan ** level, level)
        roots = grown.filter(F.col("level") == height).select("tree", "hash")
        tops = numbered(ranged(roots.withColumn("top", F.lit(_TOP)), [F.col("top").asc(), F.col("tree").asc()], "manifest-subroots"), "top")
        top_leaves = tops.select(F.lit(_TOP).alias("tree"), "n", F.lit(0).cast("long").alias("level"), F.col("pos").alias("idx"), "hash")
        self.tops = tops.select("tree", F.col("pos").alias("q"), F.col("n").alias("trees"))
        self.nodes = grown.unionByName(_grown(stored(top_leaves, "manifest-top"), fan))

    def proofs(self, siblings: bool = False) -> DataFrame:
        """Per row: key, leaf, subroot, root, proof_sha256, folded_root (from ``altered``, else the leaf), verified, and the
        place: pos of n leaves, q of so many trees; with ``siblings`` the proof itself (level by level, left to right)."""
        fan = self.fan
        leaves = self.leaves.withColumn("block", F.floor(F.col("pos") / BLOCK))
        segments = stored(leaves.groupBy("part", "tree", "block").agg(F.min("pos").alias("lo"), (F.max("pos") + 1).alias("hi"), F.max("n").alias("n"))
                          .join(self.tops, "tree"), "manifest-blocks")

        def wanted(batches):
            out = arrow_schema("part long, tree string, block long, kind long, of string, level long, idx long")
            for batch in batches:
                rows = []
                for s in batch.to_pylist():
                    head = (s["part"], s["tree"], s["block"])
                    rows += [(*head, 1, s["tree"], *c) for c in _missing(s["lo"], s["hi"], s["n"], fan)]
                    rows += [(*head, 2, _TOP, *c) for c in _missing(s["q"], s["q"] + 1, s["trees"], fan)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 7, out)], schema=out)

        want = segments.mapInArrow(wanted, "part long, tree string, block long, kind long, of string, level long, idx long")
        nodes = self.nodes.select(F.col("tree").alias("of"), "level", "idx", "hash")
        nothing = F.lit(None)

        def as_rows(df, **cols):
            names = ["part", "tree", "block", "kind", "level", "pos", "n", "hash", "key", "altered"]
            kinds = ["long", "string", "long", "long", "long", "long", "long", "string", "long", "string"]
            return df.select(*[cols.get(c, F.col(c) if c in df.columns else nothing).cast(k).alias(c) for c, k in zip(names, kinds)])

        heads = as_rows(segments, kind=F.lit(0), pos=F.col("q"), n=F.col("trees"))
        fetched = as_rows(want.join(nodes, ["of", "level", "idx"]), pos=F.col("idx"))
        own = as_rows(leaves, kind=F.lit(3), hash=F.col("leaf"))
        rows = placed(heads.unionByName(fetched).unionByName(own), segments, "tree", "block", "kind", "level", "pos")
        ddl = ("key long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, tree string, pos long, "
               "n long, q long, trees long" + (", siblings array<string>" if siblings else ""))
        return rows.mapInArrow(lambda batches: _expanded(batches, fan, siblings, arrow_schema(ddl)), ddl)


def _expanded(batches, fan: int, siblings: bool, out: pa.Schema):
    """Proofs of the rows of a task: per block a head, the nodes fetched, then its leaves, in order."""
    key = None
    head, got, top, own = None, {}, {}, []

    def done():
        if not own:
            return
        lo, n, (q, trees) = own[0][0], own[0][1], head
        runs, subroot = _climb(lo, [r[2] for r in own], n, got, fan)
        up, root = _climb(q, [subroot], trees, top, fan)
        tails = [(-1, [])] * (len(runs) + 1)  # the last parent's remaining siblings, per level

        def others(rs, level, x):
            nodes, j = _run(rs, level, x, fan)
            return nodes[:j] + nodes[j + 1:]

        over = [s for level in range(len(up)) for s in others(up, level, q // fan ** level)]

        def tail(level, x):
            if level == len(runs):
                return over
            if tails[level][0] != x:
                tails[level] = (x, others(runs, level, x) + tail(level + 1, x // fan))
            return tails[level][1]

        for at in range(0, len(own), 2048):
            cols = [[] for _ in out]
            for p, _, leaf, doc, changed in own[at:at + 2048]:
                proof = tail(0, p)
                h, x = changed or leaf, p
                for rs, y in ((runs, p), (up, q)):
                    for level in range(len(rs)):
                        nodes, j = _run(rs, level, y, fan)
                        h, y = _digest([*nodes[:j], h, *nodes[j + 1:]]), y // fan
                row = [doc, leaf, subroot, root, _digest(proof), h, h == root, key[1], x, n, q, trees] + ([proof] if siblings else [])
                for c, v in zip(cols, row):
                    c.append(v.decode() if isinstance(v, bytes) else [s.decode() for s in v] if isinstance(v, list) else v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)

    for batch in batches:
        for part, tree, block, kind, level, pos, n, h, doc, changed in zip(*[c.to_pylist() for c in batch.columns]):
            if (part, tree, block) != key:
                yield from done()
                key, got, top, own = (part, tree, block), {}, {}, []
            if kind == 0:
                head = (pos, n)
            elif kind == 3:
                own.append((pos, n, h.encode(), doc, changed.encode() if changed else None))
            else:
                (got if kind == 1 else top)[level, pos] = h.encode()
    yield from done()


def fold(leaf: str, siblings: Sequence[str], pos: int, n: int, q: int, trees: int, fan: int = 8) -> str:
    """The root that a leaf and its proof give; for whoever holds one row and the root."""
    h, rest = leaf, list(siblings)
    for x, size in ((pos, n), (q, trees)):
        while size > 1:
            j, width = x % fan, min(fan, size - x // fan * fan)
            run = rest[:width - 1]
            del rest[:width - 1]
            h = _digest([s.encode() for s in (*run[:j], h, *run[j:])]).decode()
            x, size = x // fan, -(-size // fan)
    return h


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_manifest(docs: DataFrame, tampered: Column | None = None, fan: int = 8) -> Manifest:
    """The manifest of a documents table; where ``tampered`` holds, the text is taken to be found with A-Z lowered."""
    cols = [F.col(c) for c in FIELDS]
    altered = None
    if tampered is not None:
        lowered = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
        altered = F.when(tampered, leaf_hash([*cols[:-1], lowered]))
    return Manifest(docs, F.col("doc_id"), F.col("lang"), leaf_hash(cols), altered, fan)
