"""Composed jobs — the user entry points (K1–K8).

Jobs that change state never overwrite what they read: each run writes a new
snapshot folder ``<root>/v=<version>`` and the caller switches to it afterwards
(write-then-swap), so a failed or retried run leaves the previous snapshot whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rsvpflow.operators import audit as A
from rsvpflow.operators import contacts as C
from rsvpflow.operators import export as E
from rsvpflow.operators import filters as FL
from rsvpflow.operators import merge as M
from rsvpflow.operators import quality as Q
from rsvpflow.operators import reports as R
from rsvpflow.operators.grain import report_grain, reports_from
from rsvpflow.operators.joins import materialized
from rsvpflow.roles import ROLE_ORDER
from rsvpflow.sources import sinks as SK
from rsvpflow.sources import tables as T

__all__ = ["standardize_job", "load_and_sync", "rebuild_contacts_job", "apply_changes_job", "standardize", "reports", "reports_once",
           "export_cards_job", "find_duplicates", "reconcile", "replicate", "write_snapshot"]


def write_snapshot(df: DataFrame, root: str, version: int | str, partition_by: Sequence[str] = ()) -> str:
    """Write ``df`` as snapshot ``<root>/v=<version>`` (overwrite of that version only)."""
    path = f"{root.rstrip('/')}/v={version}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def load_and_sync(spark: SparkSession, source: DataFrame, target: DataFrame | None, key: str, seq: str,
                  mode: str = "smart_sync", audit_ts: Column | None = None, case_insensitive: bool | str = False
                  ) -> tuple[DataFrame, DataFrame]:
    """K1: clean headers + NaN->NULL on an incoming batch, evolve the target schema, then sync.

    Returns ``(result, action_counts)``; both lazy.  ``target=None`` = first load.  Column names ignore case and keep
    the target's spelling; ``key`` and ``seq`` may be given as in the raw header.  Mode ``insert`` counts source rows as
    ``inserted`` or ``ignored``.
    """
    src = T.nan_to_null(T.clean_headers(source))
    if target is None:
        target = spark.createDataFrame([], src.schema)
    src = T.align_names(src, target)
    target = T.evolve_schema(target, src)
    spelled = {c.lower(): c for c in src.columns}
    key, seq = (spelled[T.clean_header(c, 0, blank_rule=False).lower()] for c in (key, seq))
    if mode == "insert":
        new = M.new_rows(target, src, key, seq, case_insensitive)
        tally = (new.agg(F.count(F.lit(1)).alias("n")).select(F.explode(F.array(
            F.struct(F.lit("inserted").alias("action"), F.col("n").alias("n")), F.struct(F.lit("ignored").alias("action"), (-F.col("n")).alias("n")))).alias("x"))
            .select("x.*").unionByName(src.agg(F.count(F.lit(1)).alias("n")).select(F.lit("ignored").alias("action"), "n")))
        counts = tally.groupBy("action").agg(F.sum("n").alias("row_count"))
        return target.unionByName(new, allowMissingColumns=True), counts
    act = M.free_name("_action", target.columns, src.columns)
    acts = M.sync_with_actions(target, src, key, seq, delete_missing=(mode == "smart_sync"), case_insensitive=case_insensitive, audit_ts=audit_ts,
                               action_col=act)
    res = acts.filter(F.col(act) != "deleted").drop(act)
    return res, M.sync_action_counts(acts, act)


def rebuild_contacts_job(master: DataFrame, root: str, version: int | str, policy: str | None = None,
                         keep: str = "first") -> str:
    """K2: full rebuild of the derived contacts into a new snapshot (partitioned by role)."""
    c = C.rebuild_contacts(master)
    if policy:
        c = C.unique_contacts(c, policy, keep)
    return write_snapshot(c, root, version, ("role",))


def apply_changes_job(spark: SparkSession, root: str, changes: DataFrame, version: int) -> str:
    """K3: fold a change batch into snapshot ``v=version-1`` and write ``v=version``.

    The last event applied to each id is kept beside the snapshots (``applied/v=<version>``), so an older event that
    comes in a later batch changes nothing.  With a timed feed (``ts``) the snapshots carry Data_Insert_Time and
    Last_Updated (M10), and what the batch did is kept in ``counts/v=<version>`` (M12).
    """
    root = root.rstrip("/")
    current = spark.read.parquet(f"{root}/v={version - 1}")
    before = f"{root}/applied/v={version - 1}"
    applied = spark.read.parquet(before) if T.path_exists(spark, before) else None
    write_snapshot(C.applied_seq(applied, changes), f"{root}/applied", version)
    if "ts" in changes.columns:
        table, counts = A.apply_changes_audit(current, changes, applied=applied)
        write_snapshot(counts.coalesce(1), f"{root}/counts", version)
        return write_snapshot(table, root, version, ("role",))
    return write_snapshot(C.apply_changes(current, changes, applied=applied), root, version, ("role",))


def standardize(master: DataFrame, contacts: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """K4: names, response weight and label on master (and contacts)."""
    sm = C.standardize_master(master)
    return sm, (C.standardize_contacts(contacts) if contacts is not None else None)


def standardize_job(master: DataFrame, contacts: DataFrame, root: str, version: int | str) -> tuple[str, str]:
    """K4 as a stored table: standardise once per load, not once per report.

    Writes ``<root>/master/v=<version>`` and ``<root>/contacts/v=<version>`` (contacts partitioned
    by role).  Reports over the stored columns then get Parquet predicate pushdown for the
    dashboard filters (``Practice_Head IN (...)``) and role partition pruning, and the per-row
    title-casing runs once.
    """
    sm, sc = standardize(master, contacts)
    return (write_snapshot(sm, f"{root.rstrip('/')}/master", version),
            write_snapshot(sc, f"{root.rstrip('/')}/contacts", version, ("role",)))


def reports(master: DataFrame, contacts: DataFrame, filters: Mapping[str, Sequence[str]] | None = None,
            standardized: bool = False) -> dict[str, DataFrame]:
    """K5: every dashboard report under one filter spec (lazy DataFrames).

    Pass ``standardized=True`` with the tables written by ``standardize_job`` (the at-scale
    path); otherwise the inputs are standardised on the fly.
    """
    sm, sc = (master, contacts) if standardized else standardize(master, contacts)
    fm = FL.filter_master(sm, filters)
    fc = FL.cascade_filter(sc, fm)
    out = {
        "overview": R.overview(fm), "response_weights": R.response_weights(fm),
        "sector_perf": R.sector_performance(fm), "region_counts": R.region_counts(fm),
        "owner_stats_head": R.owner_stats(fm, "Practice_Head"), "owner_stats_partner": R.owner_stats(fm, "Partner"),
        "owner_totals": R.owner_totals(fm), "owner_response": R.owner_response(fm, fc),
        "owner_cross": R.owner_cross(fm), "owner_sector_rollup": R.owner_sector_rollup(fm),
        "role_kpis": R.role_kpis(fc), "role_responses": R.role_responses(fc), "role_region": R.role_region(fc),
        "cfo_sectors": R.cfo_sector_counts(fc), "metrics": R.metrics(fm), "invite_trend": R.invite_trend(fm),
        "funnel": R.funnel(fm), "filter_options": R.filter_options(sm),
    }
    return out


def reports_once(master: DataFrame, filters: Mapping[str, Sequence[str]] | None = None) -> dict[str, DataFrame]:
    """K5 in one pass: the reports of ``reports(master, fan_out(master), filters)``, rolled up from one stored aggregation
    of the master (``operators.grain``) instead of a scan per report; ``report_grain`` of a table can be kept and asked for
    any number of filter specs."""
    return reports_from(materialized(report_grain(C.standardize_master(master))), filters)


def export_cards_job(spark: SparkSession, details: DataFrame, ledger_path: str, out_path: str, batch_id: str,
                     batch_ts: Column | None = None) -> DataFrame:
    """K6: eligible -> cards -> files -> ledger (see ``operators.export.export_cards``)."""
    return E.export_cards(spark, details, ledger_path, out_path, batch_id, batch_ts)


def find_duplicates(contacts: DataFrame, top_phones: int = 20, top_people: int = 3) -> dict[str, DataFrame]:
    """Duplicate phones, their members, the top-N report and the per-role totals."""
    return {"dup_phones": Q.duplicate_phones(contacts), "dup_phone_people": Q.duplicate_phone_people(contacts),
            "dup_phones_top": Q.duplicate_phones_top(contacts, top_phones, top_people),
            "dup_phone_counts": Q.duplicate_phone_counts(contacts)}


def reconcile(master: DataFrame, derived: DataFrame, roles: Sequence[str] = ROLE_ORDER) -> dict[str, DataFrame]:
    """Master-vs-derived reconciliation, counts and rows."""
    expected = C.fan_out(master, roles)
    return {"reconcile": Q.reconcile_counts(expected, derived), "reconcile_rows": Q.reconcile_rows(expected, derived),
            "reconcile_bags": Q.reconcile_bags(expected, derived),
            "reconcile_registered": Q.reconcile_registered(expected, derived)}


def replicate(spark: SparkSession, tables: Mapping[str, DataFrame], dst_root: str) -> DataFrame:
    """K8: copy tables to a replica root; one status row per table."""
    return SK.replicate(spark, dict(tables), dst_root)
