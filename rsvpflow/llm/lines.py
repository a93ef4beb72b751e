"""Line dedup by pairwise alignment (operator 6).

A run of consecutive lines with ``min_words`` words or more that also stands, line by line, in an earlier document is
deleted from the later one.

1. Every line is hashed (blanks folded); lines without words are left out.  From every line starts a window and up to
   every line goes one, the shortest run of consecutive lines with ``min_words`` words.  Windows of lines are rare where single lines are not:
   a line that stands in a third of all documents shares no window unless its neighbours repeat as well.
2. Documents overlap through shared windows.  A later document is paired with the first holder of each window it
   shares: links are as many as shared windows, never all pairs of a group.
3. Each pair is aligned by patience diff (lines unique on both sides, longest increasing chain, recursion into the gaps),
   and aligned blocks of ``min_words`` words or more are marked.  A window of the pair that the alignment left over,
   such as a block that moved, is aligned with its first place in the earlier document and extended.
4. With ``line_words``, shorter repeats go as well: a window of ``line_words`` words or more, mostly a single line, that
   at most ``rare_docs`` documents hold leaves every document but the first that holds it.  Only what is short or
   frequent, as counted over all documents, stays.
5. The marks of all pairs and windows are united and the marked lines leave the later document.

Earlier means a smaller (doc_id, text hash); null ids come last.

Defined cases: null text stays null and an empty text empty; repeated rows (same id and text) are one document and each
of them gets the same result; rows with one id and different texts are different documents; extra columns are ignored;
an empty table gives an empty result.  A task holds the line hashes of the two documents of a pair.
"""

from __future__ import annotations

import bisect
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rsvpflow.llm.batches import id_text, map_slices, slices
from rsvpflow.operators.joins import fits_broadcast, key_join, materialized
from rsvpflow.session import checkpoint_root

SCHEMA = "doc_id long, text string, n_lines long, n_removed long"
_LAST = (1 << 63) - 1


def line_keys(text: str | None) -> tuple[list[int], list[int], list[int]]:
    """(hashes, word counts, positions) of the lines that have words."""
    keys, sizes, at = [], [], []
    for i, line in enumerate((text or "").split("\n")):
        ws = line.encode("utf-8", "replace").split()
        if ws:
            keys.append(int.from_bytes(hashlib.blake2b(b" ".join(ws), digest_size=8).digest(), "little", signed=True))
            sizes.append(len(ws))
            at.append(i)
    return keys, sizes, at


def windows(sizes: list[int], min_words: int) -> list[tuple[int, int]]:
    """[start, end) of the shortest runs with ``min_words`` words from each line and up to each line.

    Any longer run is the union of such windows inside it: a line too near to its end for a window of its own lies in
    the window that ends there.
    """
    out, end, total = set(), 0, 0
    for start in range(len(sizes)):
        while end < len(sizes) and total < min_words:
            total += sizes[end]
            end += 1
        if total < min_words:
            break
        out.add((start, end))
        total -= sizes[start]
    start, total = 0, 0
    for end in range(len(sizes)):
        total += sizes[end]
        while total - sizes[start] >= min_words:
            total -= sizes[start]
            start += 1
        if total >= min_words:
            out.add((start, end + 1))
    return sorted(out)


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched line pairs of two documents, increasing on both sides."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        alo, ahi, blo, bhi = todo.pop()
        while alo < ahi and blo < bhi and a[alo] == b[blo]:
            out.append((alo, blo))
            alo, blo = alo + 1, blo + 1
        while alo < ahi and blo < bhi and a[ahi - 1] == b[bhi - 1]:
            ahi, bhi = ahi - 1, bhi - 1
            out.append((ahi, bhi))
        if alo == ahi or blo == bhi:
            continue
        once: dict[int, int] = {}
        for i in range(alo, ahi):
            once[a[i]] = -1 if a[i] in once else i
        there: dict[int, int] = {}
        for j in range(blo, bhi):
            if b[j] in once:
                there[b[j]] = -1 if b[j] in there else j
        pairs = sorted((once[k], j) for k, j in there.items() if j >= 0 and once[k] >= 0)
        tails: list[int] = []
        chain: list[int] = []
        back: list[int] = []
        for n, (_, j) in enumerate(pairs):
            p = bisect.bisect_left(tails, j)
            back.append(chain[p - 1] if p else -1)
            if p == len(tails):
                tails.append(j)
                chain.append(n)
            else:
                tails[p], chain[p] = j, n
        anchors, n = [], chain[-1] if chain else -1
        while n >= 0:
            anchors.append(pairs[n])
            n = back[n]
        prev = (alo, blo)
        for i, j in reversed(anchors):
            todo.append((prev[0], i, prev[1], j))
            prev = (i, j)  # the anchor itself is the equal prefix of the next part
        if anchors:
            todo.append((prev[0], ahi, prev[1], bhi))
    return sorted(out)


def common_lines(early: list[int], late: list[int], sizes: list[int], min_words: int) -> set[int]:
    """Lines of the later document inside common blocks of ``min_words`` words or more."""
    marked: set[int] = set()
    matched = patience(early, late)
    lo = 0
    for k in range(1, len(matched) + 1):
        if k == len(matched) or matched[k] != (matched[k - 1][0] + 1, matched[k - 1][1] + 1):
            block = [j for _, j in matched[lo:k]]
            if sum(sizes[j] for j in block) >= min_words:
                marked.update(block)
            lo = k
    left = [(s, e) for s, e in windows(sizes, min_words) if not all(j in marked for j in range(s, e))]
    if left:
        first: dict[int, list[int]] = {}
        for i, h in enumerate(early):
            first.setdefault(h, []).append(i)
        done: set[tuple[int, ...]] = set()
        for s, e in left:
            if all(j in marked for j in range(s, e)):
                continue
            run = tuple(late[s:e])
            if run in done:  # no such window in the earlier document
                continue
            at = next((i for i in first.get(run[0], ()) if tuple(early[i:i + len(run)]) == run), None)
            if at is None:
                done.add(run)
                continue
            i, j = at + len(run), e
            while i < len(early) and j < len(late) and early[i] == late[j]:
                i, j = i + 1, j + 1
            marked.update(range(s, j))
    return marked


def _keyed(docs: DataFrame) -> DataFrame:
    return id_text(docs).select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("id"), F.xxhash64("text").alias("h"))


def _rare_windows(once: DataFrame, line_words: int, rare_docs: int) -> DataFrame:
    """(id, h, drop): positions of the lines in rare windows that an earlier document has; ``once`` has each document once."""
    def found(keys, sizes):
        raw, at = [k.to_bytes(8, "little", signed=True) for k in keys], {}
        for s, e in windows(sizes, line_words):
            w = int.from_bytes(hashlib.blake2b(b"".join(raw[s:e]), digest_size=8).digest(), "little", signed=True)
            at.setdefault(w, set()).update(range(s, e))
        return at

    def names(cols, _):
        out = {"id": [], "h": [], "w": []}
        for i, h, keys, sizes in zip(cols["id"], cols["h"], cols["keys"], cols["sizes"]):
            got = found(keys, sizes)
            out["id"] += [i] * len(got)
            out["h"] += [h] * len(got)
            out["w"] += got
        return out

    def places(cols, _):
        out = {"id": [], "h": [], "w": [], "drop": []}
        for i, h, keys, sizes, pos in zip(cols["id"], cols["h"], cols["keys"], cols["sizes"], cols["pos"]):
            for w, at in found(keys, sizes).items():
                for k, v in zip(out, (i, h, w, [pos[j] for j in sorted(at)])):
                    out[k].append(v)
        return out

    held = materialized(map_slices(once.select("id", "h", "keys", "sizes"), names, "id long, h long, w long")
                        .groupBy("w").agg(F.min(F.struct("id", "h")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"))
    # frequent windows go before the join: their rows would meet in one task
    light = key_join(map_slices(once, places, "id long, h long, w long, drop array<int>"), held.filter(F.col("n") > rare_docs).select("w"), "w", "left_anti")
    rare, small = fits_broadcast(held.filter(F.col("n") <= rare_docs).select("w", "first.id", "first.h").toDF("w", "fid", "fh"))
    return light.join(F.broadcast(rare) if small else rare, "w").filter("id != fid or h != fh").select("id", "h", "drop")


def removed_lines(docs: DataFrame, min_words: int = 40, line_words: int | None = None, rare_docs: int = 100) -> DataFrame:
    """(id, h, drop): positions of the lines that leave each later document that loses any."""
    checkpoint_root(docs.sparkSession)

    def read(cols, _):
        got = [line_keys(t) for t in cols["text"]]
        return {"id": cols["id"], "h": cols["h"], "keys": [g[0] for g in got], "sizes": [g[1] for g in got], "pos": [g[2] for g in got]}

    def cut(cols, _):
        out = {"id": [], "h": [], "w": []}
        for i, h, keys, sizes in zip(cols["id"], cols["h"], cols["keys"], cols["sizes"]):
            raw = [k.to_bytes(8, "little", signed=True) for k in keys]
            found = {hashlib.blake2b(b"".join(raw[s:e]), digest_size=16).digest() for s, e in windows(sizes, min_words)}
            out["id"] += [i] * len(found)
            out["h"] += [h] * len(found)
            out["w"] += found
        return out

    def align(cols, _):
        out = {"id": cols["id"], "h": cols["h"], "drop": []}
        for early, late, sizes, pos in zip(cols["early"], cols["keys"], cols["sizes"], cols["pos"]):
            out["drop"].append([pos[j] for j in sorted(common_lines(early, late, sizes, min_words))])
        return out

    # read three times below; small beside the texts
    lines = map_slices(_keyed(docs).select("id", "h", "text"), read,
                       "id long, h long, keys array<long>, sizes array<int>, pos array<int>").checkpoint()
    cut_from = map_slices(lines, cut, "id long, h long, w binary")
    doc = F.struct("id", "h")
    first = cut_from.groupBy("w").agg(F.min(doc).alias("first"), F.max(doc).alias("last")).filter("first != last")
    pairs = (cut_from.join(first, "w").filter(doc > F.col("first"))
             .select("id", "h", F.col("first.id").alias("fid"), F.col("first.h").alias("fh")).distinct())
    once = lines.dropDuplicates(["id", "h"])
    early = once.select(F.col("id").alias("fid"), F.col("h").alias("fh"), F.col("keys").alias("early"))
    both = pairs.join(early, ["fid", "fh"]).join(once, ["id", "h"]).select("id", "h", "early", "keys", "sizes", "pos")
    marks = map_slices(both, align, "id long, h long, drop array<int>", rows=256)
    if line_words is not None:
        marks = marks.unionByName(_rare_windows(once, line_words, rare_docs))
    return marks.select("id", "h", F.explode("drop").alias("p")).groupBy("id", "h").agg(F.collect_set("p").alias("drop"))


def _without(text: str | None, drop) -> str | None:
    gone = set(drop or ())
    return "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone) if gone and text is not None else text


def dedup_lines(docs: DataFrame, min_words: int = 40, line_words: int | None = None, rare_docs: int = 100) -> DataFrame:
    """One row per document: its text without the lines that an earlier document already has."""
    def write(cols, _):
        out = {f.split()[0]: [] for f in SCHEMA.split(", ")}
        for doc, text, drop in zip(cols["doc_id"], cols["text"], cols["drop"]):
            for k, v in zip(out, (doc, _without(text, drop), len(line_keys(text)[0]), len(drop or ()))):
                out[k].append(v)
        return out

    joined = _keyed(docs).join(removed_lines(docs, min_words, line_words, rare_docs), ["id", "h"], "left")
    return map_slices(joined.select("doc_id", "text", "drop"), write, SCHEMA)


def rewrite(docs: DataFrame, min_words: int = 40) -> DataFrame:
    """The documents, all columns, with deduplicated text; those that lost lines and keep no word are left out.

    ``n_chars``, if there, is counted anew for changed texts.
    """
    names = docs.columns
    inner = [f"_c{i}" for i in range(len(names))]  # by place: names may clash with the keys below
    at, count = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    keyed = docs.toDF(*inner).withColumns({
        "_id": F.coalesce(F.col(inner[names.index("doc_id")]).cast("long"), F.lit(_LAST)), "_h": F.xxhash64(F.col(inner[at]).cast("string"))})
    marks = removed_lines(docs, min_words).select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.col("drop").alias("_drop"))
    joined = keyed.join(marks, ["_id", "_h"], "left").select(*inner, "_drop")
    kinds = {f.name: f.dataType for f in docs.schema}

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1 << 20, 4096):
                cols = part.columns[:-1]
                drops = part.column(len(cols)).to_pylist()
                new = [_without(t, d) for t, d in zip(cols[at].to_pylist(), drops)]
                cols[at] = pa.array(new, cols[at].type)
                if count is not None:
                    old = cols[count].to_pylist()
                    cols[count] = pa.array([len(t) if d and t is not None else n for t, d, n in zip(new, drops, old)], cols[count].type)
                keep = pa.array([not d or bool((t or "").encode("utf-8", "replace").split()) for t, d in zip(new, drops)], pa.bool_())
                yield pa.RecordBatch.from_arrays(cols, names=inner).filter(keep)

    schema = T.StructType([T.StructField(i, kinds[n], True) for i, n in zip(inner, names)])
    return joined.mapInArrow(run, schema).toDF(*names)
