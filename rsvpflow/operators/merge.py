"""Merge / sync operators.

All are set-based rewrites of MySQL's ``INSERT IGNORE`` / ``ON DUPLICATE KEY
UPDATE`` / per-key DELETE:

* duplicates inside a batch are resolved with ``row_number()`` over the key
  ordered by an explicit ``seq`` column (Spark plans a partial
  ``WindowGroupLimit`` before the shuffle, so a hot key is cut to one row per
  map task before it moves);
* NULL keys never match (a UNIQUE index admits many NULLs), so NULL-key rows
  are routed *around* the join — they are also the most likely hot key;
* keys are compared as they are, by their lower case (``case_insensitive=True``) or under a collation
  (``case_insensitive="UNICODE_CI_AI"``: case- and accent-blind, as the default collation of the tables kept in step),
  in joins and in the windows that resolve duplicates alike; a stored key keeps its spelling;
* target and (deduplicated) source are full-outer-joined once on the key; the
  per-row action is derived in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

__all__ = ["keep_per_key", "insert_new_only", "upsert", "smart_sync", "sync", "sync_with_actions",
           "sync_action_counts", "deleted_keys"]

_MATCH = "__m"


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _key_expr(c: str, case_insensitive: bool | str) -> Column:
    """What a key is compared by: itself, its lower case, or itself under the named collation."""
    if isinstance(case_insensitive, str):
        return F.collate(F.col(c), case_insensitive)
    return F.lower(F.col(c)) if case_insensitive else F.col(c)


def free_name(base: str, *taken: Sequence[str]) -> str:
    """``base``, with underscores added until no column is called so (names ignore case)."""
    names = {c.lower() for cols in taken for c in cols}
    while base.lower() in names:
        base += "_"
    return base


def _first_ranked(df: DataFrame, window) -> DataFrame:
    rank = free_name("__rn", df.columns)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) == 1).drop(rank)


def _nonnull(keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def ranked_per_key(df: DataFrame, key: str | Sequence[str], seq: str | Sequence[str], keep: str = "first",
                   case_insensitive: bool | str = False, unique_seq: bool = False) -> DataFrame:
    """First (or last) row per key by ``seq`` among rows with a non-NULL key; ties broken by
    a full-row hash (left out, so that columns can be pruned, where ``unique_seq`` says there are none).  The result stays hash-partitioned by the key, so a following join on
    the same key adds no exchange."""
    keys = _keys(key)
    seqs = _keys(seq)
    order = [F.col(s).asc_nulls_first() if keep == "first" else F.col(s).desc_nulls_last() for s in seqs]
    tie = [] if unique_seq else [F.xxhash64(*[F.col(c) for c in df.columns])]
    w = Window.partitionBy(*[_key_expr(k, case_insensitive) for k in keys]).orderBy(*order, *tie)
    return _first_ranked(df.filter(_nonnull(keys)), w)


def keep_per_key(df: DataFrame, key: str | Sequence[str], seq: str | Sequence[str], keep: str = "first",
                 case_insensitive: bool | str = False, null_safe: bool = False, unique_seq: bool = False) -> DataFrame:
    """First (or last) row per key by ``seq``; ties broken by a full-row hash.

    With ``null_safe=False`` rows with a NULL key are all kept (UNIQUE semantics);
    with ``null_safe=True`` NULL is a key value like any other.
    """
    keys = _keys(key)
    if null_safe:
        seqs = _keys(seq)
        order = [F.col(s).asc_nulls_first() if keep == "first" else F.col(s).desc_nulls_last() for s in seqs]
        tie = [] if unique_seq else [F.xxhash64(*[F.col(c) for c in df.columns])]
        w = Window.partitionBy(*[_key_expr(k, case_insensitive) for k in keys]).orderBy(*order, *tie)
        return _first_ranked(df, w)
    ranked = ranked_per_key(df, keys, seq, keep, case_insensitive, unique_seq)
    return ranked.unionByName(df.filter(~_nonnull(keys)))


def new_rows(target: DataFrame, source: DataFrame, key: str | Sequence[str], seq: str,
             case_insensitive: bool | str = False) -> DataFrame:
    """The source rows that ``INSERT IGNORE`` would add: the first per key that the target lacks, and NULL keys."""
    keys = _keys(key)
    nn = _nonnull(keys)
    src = ranked_per_key(source, keys, seq, "first", case_insensitive)
    names = [free_name(f"__k{i}", source.columns) for i in range(len(keys))]
    tkeys = target.filter(nn).select(*[_key_expr(k, case_insensitive).alias(n) for n, k in zip(names, keys)])
    cond = [_key_expr(k, case_insensitive) == F.col(n) for n, k in zip(names, keys)]
    return src.join(tkeys, cond, "left_anti").unionByName(source.filter(~nn))


def insert_new_only(target: DataFrame, source: DataFrame, key: str | Sequence[str], seq: str,
                    case_insensitive: bool | str = False) -> DataFrame:
    """M1 (``INSERT IGNORE``): first source row per key wins, existing target rows win over
    incoming ones, NULL-key source rows are always inserted."""
    return target.unionByName(new_rows(target, source, key, seq, case_insensitive), allowMissingColumns=True)


def sync_with_actions(target: DataFrame, source: DataFrame, key: str | Sequence[str], seq: str,
                      delete_missing: bool = False, case_insensitive: bool | str = False,
                      audit_ts: Column | None = None, action_col: str = "_action") -> DataFrame:
    """Core of M2/M3: merged rows plus ``_action`` (``action_col``, no column of either table) in
    {inserted, updated, unchanged, deleted, kept, kept_null_key}.

    * source: last row per key by ``seq``; on a match every *source* column except the key
      overwrites the target (NULL included), target-only columns and the stored key keep
      their value;
    * ``delete_missing``: target keys absent from the source are marked ``deleted``
      (NULL target keys are never deleted, as ``key = NULL`` matches nothing);
      otherwise they are ``kept``;
    * ``audit_ts``: maintain ``Data_Insert_Time`` / ``Last_Updated`` (M10): insert time on
      insert only, update time only when a value changed.
    """
    keys = _keys(key)
    nn = _nonnull(keys)
    src = ranked_per_key(source, keys, seq, "last", case_insensitive)
    out_cols = list(target.columns) + [c for c in source.columns if c not in set(target.columns)]
    src_cols = set(source.columns)
    audit = audit_ts is not None
    if audit:
        for c in ("Data_Insert_Time", "Last_Updated"):
            if c not in out_cols:
                out_cols.append(c)
            src_cols.discard(c)

    # projections are built as SQL expression strings: one call per projection instead of
    # several per column (driver-side plan-building cost on wide tables)
    def q(c: str) -> str:
        return "`" + c.replace("`", "``") + "`"

    if action_col.lower() in {c.lower() for c in out_cols}:
        raise ValueError(f"a column is called {action_col!r}: name another action_col")

    def kx(c: str) -> str:
        if isinstance(case_insensitive, str):
            return f"collate({q(c)}, '{case_insensitive}')"
        return f"lower({q(c)})" if case_insensitive else q(c)

    t = target.filter(nn).selectExpr(*[f"{q(c)} AS {q('t_' + c)}" for c in target.columns],
                                     *[f"{kx(k)} AS {q(f'__k{i}')}" for i, k in enumerate(keys)])
    s = src.selectExpr(*[f"{q(c)} AS {q('s_' + c)}" for c in source.columns], f"true AS {q(_MATCH)}",
                       *[f"{kx(k)} AS {q(f'__j{i}')}" for i, k in enumerate(keys)])
    joined = t.join(s, [F.col(f"__k{i}") == F.col(f"__j{i}") for i in range(len(keys))], "full_outer")
    if audit:
        joined = joined.withColumn("__ts", audit_ts)
    in_t = "`__k0` IS NOT NULL"
    in_s = f"{q(_MATCH)} IS NOT NULL"
    diffs = [f"NOT ({q('t_' + c)} <=> {q('s_' + c)})" for c in sorted(src_cols)
             if c in target.columns and c not in keys]  # the update clause never touches the key
    changed = "(" + (" OR ".join(diffs) if diffs else "false") + ")"
    action = (f"CASE WHEN {in_t} AND {in_s} THEN (CASE WHEN {changed} THEN 'updated' ELSE 'unchanged' END) "
              f"WHEN {in_s} THEN 'inserted' ELSE '{'deleted' if delete_missing else 'kept'}' END")

    def pick(c: str) -> str:
        tc, sc = q("t_" + c), q("s_" + c)
        if audit and c == "Data_Insert_Time":
            return f"CASE WHEN {in_t} THEN {tc if c in target.columns else 'NULL'} ELSE `__ts` END"
        if audit and c == "Last_Updated":
            keep = tc if c in target.columns else "NULL"
            return (f"CASE WHEN {in_t} AND {in_s} AND NOT {changed} THEN {keep} "
                    f"WHEN {in_t} AND NOT ({in_s}) THEN {keep} ELSE `__ts` END")
        if c in keys and c in target.columns:
            # a matched row keeps its stored key (differs only in case under case_insensitive)
            return f"CASE WHEN {in_t} THEN {tc} ELSE {sc} END"
        if c in src_cols and c in target.columns:
            return f"CASE WHEN {in_s} THEN {sc} ELSE {tc} END"
        if c in src_cols:
            return sc
        return tc

    merged = joined.selectExpr(*[f"{pick(c)} AS {q(c)}" for c in out_cols], f"{action} AS {q(action_col)}")

    def passthrough(df: DataFrame, act: str) -> DataFrame:
        if audit:
            df = df.withColumn("__ts", audit_ts)
        cols = []
        for c in out_cols:
            if audit and c in ("Data_Insert_Time", "Last_Updated") and (act == "inserted" or c not in df.columns):
                # an untyped NULL widens to the audit column's type in the union
                cols.append(f"{'`__ts`' if act == 'inserted' else 'NULL'} AS {q(c)}")
            elif c in df.columns:
                cols.append(q(c))
            else:
                cols.append(f"NULL AS {q(c)}")
        return df.selectExpr(*cols, f"'{act}' AS {q(action_col)}")

    null_t = passthrough(target.filter(~nn), "kept_null_key")
    null_s = passthrough(source.filter(~nn), "inserted")
    return merged.unionByName(null_t, allowMissingColumns=True).unionByName(null_s, allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, key: str | Sequence[str], seq: str,
           case_insensitive: bool | str = False, audit_ts: Column | None = None) -> DataFrame:
    """M2 (``ON DUPLICATE KEY UPDATE``): last duplicate wins, every source column overwrites."""
    act = free_name("_action", target.columns, source.columns)
    return sync_with_actions(target, source, key, seq, False, case_insensitive, audit_ts, act).drop(act)


def smart_sync(target: DataFrame, source: DataFrame, key: str | Sequence[str], seq: str,
               case_insensitive: bool | str = False, audit_ts: Column | None = None) -> DataFrame:
    """M3: delete target keys missing from the source, then upsert."""
    act = free_name("_action", target.columns, source.columns)
    r = sync_with_actions(target, source, key, seq, True, case_insensitive, audit_ts, act)
    return r.filter(F.col(act) != "deleted").drop(act)


def sync(target: DataFrame, source: DataFrame, key: str | Sequence[str], seq: str, mode: str = "smart_sync",
         **kw) -> DataFrame:
    """M4: mode dispatch — ``insert`` (M1), ``upsert`` (M2), ``smart_sync`` (M3)."""
    if mode == "insert":
        return insert_new_only(target, source, key, seq, kw.get("case_insensitive", False))
    if mode == "upsert":
        return upsert(target, source, key, seq, **kw)
    if mode == "smart_sync":
        return smart_sync(target, source, key, seq, **kw)
    raise ValueError(f"unknown sync mode {mode!r}")


def sync_action_counts(actions: DataFrame, action_col: str = "_action") -> DataFrame:
    """Statement feedback as ``(action, row_count)``."""
    return actions.groupBy(F.col(action_col).alias("action")).agg(F.count(F.lit(1)).alias("row_count"))


def deleted_keys(target: DataFrame, source: DataFrame, key: str, case_insensitive: bool | str = False) -> DataFrame:
    """Distinct target keys absent from the non-NULL source keys (NULL never deleted)."""
    t = target.select(F.col(key)).filter(F.col(key).isNotNull()).distinct()
    k = free_name("__k", [key])
    s = source.select(_key_expr(key, case_insensitive).alias(k)).filter(F.col(k).isNotNull())
    return t.join(s, _key_expr(key, case_insensitive) == F.col(k), "left_anti")
