"""URL rules by a sort-merge range join.

A host's labels, reversed and each closed by a separator, make its canonical key: all subdomains of a rule's host lie in one
interval of keys behind the rule's own, and two such intervals are nested or apart.  Rules and URLs are sorted together over
range partitions (a rule before the URLs of its host); a sweep through each partition keeps the stack of rules whose interval
is open and asks them, innermost first, for the longest path prefix.  What is open where a partition begins comes from one
equi-join: the partition's first key has as many enclosing keys as labels.  The URLs of a hot host are dealt over partitions
by path and id; rules may be as many as the URLs, nothing is broadcast.

Of the rules that fit, the longest (host and path together) counts; among equally long ones the longer host, then ``block``.

Defined cases: a null URL, or one without ``://``, has an empty host and path, which no rule fits; URLs without a fitting
rule get ``default``; rules with a null or empty host fit nothing; a null path of a rule counts as ``/``; repeated rows are
judged each; no rows give no rows, no rules give ``default``; other columns play no part.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rsvpflow.llm.batches import arrow_schema
from rsvpflow.llm.ranges import placed, ranged

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SEP, _ESC = "\x00", "\x01"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path of a URL, both empty for null and for what has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + F.lit(3), F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _AZ, _az), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from the right, each closed by a character that none of them holds (escaped where one does)."""
    safe = F.replace(F.replace(host, F.lit(_ESC), F.lit(_ESC + "2")), F.lit(_SEP), F.lit(_ESC + "1"))
    return F.concat(F.array_join(F.reverse(F.split(safe, "[.]", -1)), _SEP), F.lit(_SEP))


_ROW = ["part", "at", "kind", "key", "host", "path", "page_id", "verdict"]
_OUT = "page_id long, host string, path string, rule string, verdict string"


def _sweep(batches, default: str):
    """Judges the URLs of a task: rows in order, the rules open at its begin first."""
    out = arrow_schema(_OUT)
    stack: list[tuple[str, str, dict, list]] = []  # (key, host, path -> verdict, path lengths, longest first)

    def longest(path: str):
        best = None
        for _, host, paths, sizes in reversed(stack):
            for size in sizes:
                if size <= len(path) and path[:size] in paths:
                    got = (len(host) + size, len(host), host + path[:size], paths[path[:size]])
                    best = got if best is None or got[:2] > best[:2] else best
                    break
        return best

    for batch in batches:
        cols = [[] for _ in out]
        for kind, key, host, path, page, verdict in zip(*[batch.column(batch.schema.names.index(c)).to_pylist() for c in _ROW[2:]]):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if kind == 1:
                if not stack or stack[-1][0] != key:
                    stack.append((key, host, {}, []))
                _, _, paths, sizes = stack[-1]
                if len(path) not in sizes:
                    sizes.append(len(path))
                    sizes.sort(reverse=True)
                paths[path] = verdict if paths.get(path, verdict) == verdict else "block"
            else:
                best = longest(path)
                for c, v in zip(cols, (page, host, path, best and best[2], best[3] if best else default)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, out)], schema=out)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url) under ``rules`` (verdict, host, path)."""
    host, path = host_path(F.col("url").cast("string"))
    urls = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.select(F.lit(2).alias("kind"), host_key(F.col("host")).alias("key"), "host", "path", "page_id", F.lit(None).cast("string").alias("verdict"))
    named = rules.filter(F.col("host") != "").select(F.translate("host", _AZ, _az).alias("host"), F.coalesce("path", F.lit("/")).alias("path"), "verdict").distinct()
    named = named.select(F.lit(1).alias("kind"), host_key(F.col("host")).alias("key"), "host", "path", F.lit(None).cast("long").alias("page_id"), "verdict")
    order = [F.col(c).asc() for c in ("key", "kind", "path", "page_id")]
    rows = ranged(urls.unionByName(named), order, "url-rules")
    # enclosing keys of each partition's first row, its own among them
    first = rows.groupBy("part").agg(F.min_by("key", "at").alias("first"))
    labels = F.split(F.col("first"), _SEP, -1)
    outer = first.select("part", F.explode(F.transform(F.sequence(F.lit(1), F.size(labels) - 1), lambda k: F.concat(
        F.array_join(F.slice(labels, F.lit(1), k), _SEP), F.lit(_SEP)))).alias("key"))
    open_at = named.join(outer, "key").withColumn("at", F.lit(-1).cast("long"))
    both = rows.select(*_ROW).unionByName(open_at.select(*_ROW))
    return placed(both, rows, "at", "key", "path").mapInArrow(lambda batches: _sweep(batches, default), _OUT)
